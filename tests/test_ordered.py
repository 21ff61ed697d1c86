"""Tables in one order over all files."""

import random

import pytest
from pyspark.sql import functions as F

from sakuin.operators import search
from sakuin.plans.ordered import OrderedTable


@pytest.mark.parametrize("files", [1, 5])
def test_ranges_open_their_files_only(spark, tmp_path, files):
    r = random.Random(5)
    rows = [(None if k % 50 == 0 else f"{r.randrange(10**6):010d}", k) for k in range(400)] + [("0000500000", 1000 + k) for k in range(40)]
    table = OrderedTable(spark, f"{tmp_path}/t")
    with pytest.raises(ValueError):
        table.files()
    df = spark.createDataFrame(rows, "code string, n int")
    table.write(df, "code", "n", files=files)
    want = sorted(rows, key=lambda x: (x[0] or "", x[1]))
    assert [tuple(x) for x in table.in_order()] == want
    every = table.files()
    assert len(every) == files
    for low, high in [("0000100000", "0000200000"), ("0000500000", "0000500000"), (None, "0000050000"), ("0000990000", None), ("0000200000", "0000100000"), ("1", "2")]:
        inside = [x for x in want if x[0] is not None and (low is None or x[0] >= low) and (high is None or x[0] <= high)]
        assert [tuple(x) for x in table.in_order(low, high)] == inside
        assert sorted(map(tuple, table.between(low, high).collect())) == sorted(inside)
        assert low is None or table.before(low) == sum(c is None or c < low for c, _ in rows)
    if files > 1:
        assert len(table.files("0000100000", "0000110000")) <= 2 and not table.files("1", "2")
        opened = {x[0].rpartition("/")[2] for x in table.between("0000100000", "0000110000").select(F.input_file_name()).distinct().collect()}
        assert opened <= {f.rpartition("/")[2] for f in table.files("0000100000", "0000110000")}
    table.write(df.where("n < 3"), "code", "n")  # a new version takes the old one's place
    assert [x["n"] for x in table.in_order()] == [n for c, n in want if n < 3]
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("rows-")]) == 1
    table.write(df.limit(0), "code")
    assert not list(table.in_order()) and table.between("0", "1").count() == 0


def test_japanese_and_numeric_keys(spark, tmp_path):
    names = ["薬局", "さくら", "1号", "うめだ", "医院", "abc", "桜", "あい", "東京", "大阪", "梅田"]
    table = OrderedTable(spark, f"{tmp_path}/n")
    df = spark.createDataFrame([(n, k) for k, n in enumerate(names * 5)], "name string, n int").withColumn("key", search.name_key("name"))
    table.write(df, "key", "n", files=4)
    got = [x["name"] for x in table.in_order()]
    assert got[::5] == ["1号", "abc", "あい", "うめだ", "さくら", "医院", "桜", "大阪", "東京", "梅田", "薬局"]
    numbers = OrderedTable(spark, f"{tmp_path}/i")
    numbers.write(spark.range(1000).select(F.expr("pmod(id * 7919, 1009) - 500").alias("k")), "k", files=4)
    assert [x[0] for x in numbers.in_order(-10, 10)] == [k for k in range(-10, 11) if any((i * 7919) % 1009 - 500 == k for i in range(1000))]
    assert len(numbers.files(-10, 10)) <= 2

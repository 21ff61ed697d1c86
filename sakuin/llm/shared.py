"""Helpers that the corpus operators share: durable intermediate tables and keyed folds."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of characters other than ASCII white space.
SPACE = "[\\x20\\x09-\\x0D]+"


@lru_cache(maxsize=1)
def _local() -> str:
    return f"file://{tempfile.mkdtemp(prefix='sakuin-')}"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    On a cluster the session must name it. A local run without it has one machine: a temporary folder is made.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = _local()
    return found.rstrip("/")


def durable(df: DataFrame, name: str, options: dict | None = None) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: later jobs survive lost executors. options: of the writer."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Tables:
    """Durable tables of one operator, which it removes when tables written later hold all that it still needs. Called like durable."""

    def __init__(self):
        self._held: list[tuple[DataFrame, str]] = []

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        out = df.sparkSession.read.schema(df.schema).parquet(path)
        self._held.append((out, path))
        return out

    def remove(self, *some: DataFrame) -> None:
        for held in [h for h in self._held if any(h[0] is df for df in some)]:
            discard(held[0].sparkSession, held[1])
            self._held.remove(held)

    def remove_but(self, *kept: DataFrame) -> None:
        self.remove(*[df for df, _ in self._held if not any(df is k for k in kept)])


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the decimal doc_id, modulo folds; a null doc_id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % F.lit(folds), F.lit(0))


def bucketed(df: DataFrame, column: str, codec: str = "zstd") -> tuple[DataFrame, str]:
    """df as a table bucketed by a column, in the shared folder, and its name: later joins on the column move none of its rows.
    Drop the table when nothing reads it any more. codec: zstd is smaller on disk, snappy needs less native memory of executors."""
    spark, name = df.sparkSession, f"sakuin_{uuid.uuid4().hex}"
    size = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(size, column).option("path", f"{shared_dir(spark)}/{name}").option("compression", codec).saveAsTable(name)
    return spark.table(name), name


def forget(spark: SparkSession, name: str, files: bool = False) -> None:
    """Take a table out of the catalog. Its files stay in the shared folder, for recomputed tasks, unless no plan reads them any more."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if files:
        discard(spark, f"{shared_dir(spark)}/{name}")


def discard(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that a later written one replaces, so that disk use does not grow with the number of rounds."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)

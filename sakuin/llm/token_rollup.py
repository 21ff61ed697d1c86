"""Token counts by source, language and tokenizer version, kept up to date by signed deltas."""

from __future__ import annotations

import json
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sakuin.llm.shared import durable, shared_dir
from sakuin.llm.tokens import BPE, encoder

KEYS = ("source", "lang", "tokenizer")
_DELTA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


class TokenRollup:
    """Additive totals in a folder. A batch of changes is summed to signed deltas and written to a folder of its own; an entry in `live`
    names that folder, and the batch counts from the moment its decision exists: a file in `ids` that is written under another name
    and renamed without overwriting, so it is there in full or not at all, and of two writers of one batch one wins. A batch id that is
    decided changes nothing when it comes again, and what attempts left that lost or were never decided doesn't count.

    A compaction folds what counts into one entry. It is decided under the number of its generation, which follows from the compaction
    that it has seen, so of two that saw the same one wins and none folds a batch that another has folded. Readers list `live`, which is as
    long as what came since the last compaction; decisions are never listed, they are looked up by name, and stay for ever."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _file(self, name: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _exists(self, name: str) -> bool:
        store, path = self._file(name)
        return store.exists(path)

    def _remove(self, name: str) -> None:
        store, path = self._file(name)
        store.delete(path, True)

    def _read(self, name: str) -> dict:
        store, path = self._file(name)
        stream = store.open(path)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    @staticmethod
    def _key(batch: str) -> str:
        return uuid.uuid5(uuid.NAMESPACE_URL, batch).hex

    def _stage(self, content: dict):
        """The content in a file that no reader looks at."""
        store, path = self._file(f"staged/{uuid.uuid4().hex}")
        out = store.create(path, False)
        out.write(bytearray((json.dumps(content) + "\n").encode()))
        out.close()
        return path

    def _put(self, name: str, content: dict) -> bool:
        """Write a file that appears in full; False if it is there already."""
        staged = self._stage(content)
        store, path = self._file(name)
        store.mkdirs(path.getParent())
        fs = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        uri = store.makeQualified(path).toUri()
        context = fs.FileContext.getFileContext(uri, self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            context.rename(store.makeQualified(staged), store.makeQualified(path), self.spark.sparkContext._gateway.new_array(fs.Options.Rename, 0))
        except Exception:
            if store.exists(path):  # another writer was first
                store.delete(staged, True)
                return False
            raise
        return True

    def _decide(self, batch: str, content: dict) -> bool:
        """Enter an attempt and decide the batch for it; False, and the attempt is taken back, if it was decided before."""
        name = f"live/{self._key(batch)}-{uuid.uuid4().hex}"
        content = {"batch": batch, "name": name, **content}
        self._put(name, content)
        if self._put(f"ids/{self._key(batch)}", content):
            return True
        self._remove(name)
        self._remove(content["folder"])
        return False

    def entries(self) -> tuple[list[dict], list[dict]]:
        """What counts now, and what is left over: entries that a compaction has folded, or whose batch was decided for another attempt."""
        if not self._exists("live"):
            return [], []
        rows = [json.loads(r[0]) for r in self.spark.read.text(f"{self.path}/live").collect()]  # a line a batch since the last compaction
        decided, over = [], []
        for x in rows:
            decision = f"ids/{self._key(x['batch'])}"
            if self._exists(decision):
                (decided if self._read(decision)["name"] == x["name"] else over).append(x)
        folded = {name for x in decided for name in x.get("replaces", ())}
        over += [x for x in decided if x["name"] in folded]
        return sorted((x for x in decided if x["name"] not in folded), key=lambda x: x["name"]), over

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Commit one batch of changes; False if it was committed before.

        A change has the structs `before` and `after` (source, lang, tokenizer, n_tokens): an insert has no before, a delete no
        after, a revision both. Null sources, languages and versions are keys like any other; null counts are 0.
        """
        if self._exists(f"ids/{self._key(batch)}"):
            return False
        sides = F.explode(F.array(F.struct(F.lit(-1).alias("sign"), F.col("before").alias("row")), F.struct(F.lit(1).alias("sign"), F.col("after").alias("row"))))
        signed = changes.select(sides.alias("x")).where("x.row is not null").select("x.sign", "x.row.*")
        count = F.coalesce(F.col("n_tokens").cast("long"), F.lit(0).cast("long"))
        deltas = signed.groupBy(*KEYS).agg(F.sum("sign").cast("long").alias("n_docs"), F.sum(F.col("sign") * count).alias("n_tokens"))
        folder = f"deltas/{uuid.uuid4().hex}"
        deltas.write.parquet(f"{self.path}/{folder}")
        return self._decide(batch, {"folder": folder})

    def _sum(self, folders: list[str]) -> DataFrame:
        rows = self.spark.read.schema(_DELTA).parquet(*[f"{self.path}/{f}" for f in folders]) if folders else self.spark.createDataFrame([], _DELTA)
        return rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0 or n_tokens <> 0")

    def totals(self) -> DataFrame:
        """Current totals; keys without documents and tokens are left out."""
        return self._sum([x["folder"] for x in self.entries()[0]])

    def compact(self) -> bool:
        """Fold what counts now into one entry; False if there is too little to fold or another compaction was first.

        A batch that is committed meanwhile is in neither the folder nor the list, and counts beside it. What this compaction folds stays
        until the next one, for readers that have begun; what the one before left over goes now.
        """
        live, over = self.entries()
        if len(live) < 2:
            return False
        generation = 1 + max((x.get("generation", 0) for x in [*live, *over]), default=0)
        folder = f"deltas/{uuid.uuid4().hex}"
        self._sum([x["folder"] for x in live]).write.parquet(f"{self.path}/{folder}")
        if not self._decide(f"compaction {generation}", {"folder": folder, "generation": generation, "replaces": [x["name"] for x in live]}):
            return False
        for x in sorted(over, key=lambda x: x.get("generation", 0)):  # a compaction's entry after those that it hides
            self._remove(x["folder"])
            self._remove(x["name"])
        return True


def token_counts(docs: DataFrame, tokenizer: str = BPE) -> DataFrame:
    """(source, lang, n_chars, n_tokens) of every row's whole text; null text has none. Repeated rows count each for itself, an
    empty table gives none, and other columns are ignored."""

    def count(batches):
        for batch in batches:
            ids = encoder(tokenizer).ids
            texts = batch.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(t or "") for t in texts], pa.int64()), pa.array([len(ids(t)) if t else 0 for t in texts], pa.int64())], names=["source", "lang", "n_chars", "n_tokens"])

    return docs.select(F.col("source").cast("string"), F.col("lang").cast("string"), "text").mapInArrow(count, "source string, lang string, n_chars long, n_tokens long")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in with an estimate, are revised to their exact counts (sent twice), and empty ones are deleted."""
    counted = durable(token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet")), "counts")
    row = lambda tokenizer, n: F.struct("source", "lang", F.lit(tokenizer).alias("tokenizer"), n.cast("long").alias("n_tokens"))
    guess, exact = row("estimate", F.floor(F.col("n_chars") / 4)), row(BPE, F.col("n_tokens"))
    none = F.when(F.lit(False), exact)
    rollup = TokenRollup(spark, f"{shared_dir(spark)}/rollup-{uuid.uuid4().hex}")
    rollup.apply("load", counted.select(none.alias("before"), guess.alias("after")))
    revised = counted.select(guess.alias("before"), exact.alias("after"))
    rollup.apply("exact counts", revised)
    rollup.apply("exact counts", revised)
    rollup.apply("empty texts", counted.where("n_tokens = 0").select(exact.alias("before"), none.alias("after")))
    return rollup.totals()

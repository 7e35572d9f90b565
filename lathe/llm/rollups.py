"""Token counts as delta-maintained rollups.

A change row is signed: an insert adds a document's tokens to its group, a delete takes them away, and a revised count
adds the difference. A batch of changes is aggregated once to deltas per (source, language, tokenizer version) and
committed under its batch id; totals are the sum of the committed deltas, so they are maintained without reading any
document again. A commit is idempotent: the batch's folder is written by one Spark job and counts only with the job's
success marker, a batch that is already committed is left as it is, and one that broke off is written again.
``fold`` writes the sums of all committed batches, with the names of these batches, as one table; totals then read the newest
complete fold and the batches after it. Batch folders stay, as the record of what is committed.

Null source, language or version are groups of their own; null counts are 0 tokens. A revision of a document into another
group is a delete and an insert. Repeated change rows each count (repeat a batch, not its rows, to retry). An empty batch
commits no deltas. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GROUP = ("source", "lang", "tokenizer")
_SCHEMA = "source string, lang string, tokenizer string, d_docs long, d_tokens long"
CHANGES = ("insert", "delete", "revise")


def inserts(docs: DataFrame, tokens: Column, tokenizer: str) -> DataFrame:
    return docs.select(F.lit("insert").alias("change"), "source", "lang", F.lit(tokenizer).alias("tokenizer"),
                       F.lit(None).cast("long").alias("old_tokens"), tokens.cast("long").alias("new_tokens"))


def deletes(docs: DataFrame, tokens: Column, tokenizer: str) -> DataFrame:
    return docs.select(F.lit("delete").alias("change"), "source", "lang", F.lit(tokenizer).alias("tokenizer"),
                       tokens.cast("long").alias("old_tokens"), F.lit(None).cast("long").alias("new_tokens"))


def revisions(docs: DataFrame, old: Column, new: Column, tokenizer: str) -> DataFrame:
    return docs.select(F.lit("revise").alias("change"), "source", "lang", F.lit(tokenizer).alias("tokenizer"),
                       old.cast("long").alias("old_tokens"), new.cast("long").alias("new_tokens"))


def deltas(changes: DataFrame) -> DataFrame:
    """Signed sums of a batch per group, groups that do not change left out."""
    sign = F.when(F.col("change") == "insert", 1).when(F.col("change") == "delete", -1).otherwise(0)
    old = F.when(F.col("change").isin("delete", "revise"), F.coalesce("old_tokens", F.lit(0))).otherwise(0)
    new = F.when(F.col("change").isin("insert", "revise"), F.coalesce("new_tokens", F.lit(0))).otherwise(0)
    return (changes.where(F.col("change").isin(*CHANGES)).groupBy(*GROUP)
            .agg(F.sum(sign).cast("long").alias("d_docs"), F.sum(new - old).cast("long").alias("d_tokens"))
            .where("d_docs <> 0 or d_tokens <> 0"))


class TokenRollups:
    """Rollups kept in a folder, one sub-folder per committed batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._root = jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._child = lambda *parts: jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))

    def committed(self, batch: str) -> bool:
        return self._fs.exists(self._child(f"batch={batch}", "_SUCCESS"))

    def batches(self) -> list[str]:
        if not self._fs.exists(self._root):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._root)]
        return sorted(n[6:] for n in names if n.startswith("batch=") and self.committed(n[6:]))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch unless its id is committed already; True if it was applied."""
        if not batch or not batch.replace("-", "").replace("_", "").isalnum():
            raise ValueError(f"batch id {batch!r} is not a name")
        if self.committed(batch):
            return False
        deltas(changes).write.mode("overwrite").parquet(f"{self.path}/batch={batch}")
        return True

    def folds(self) -> list[int]:
        """Numbers of the complete folds, ascending."""
        if not self._fs.exists(self._root):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._root)]
        return sorted(int(n[5:]) for n in names if n.startswith("fold=") and self._fs.exists(self._child(n, "_SUCCESS")))

    def _folded(self) -> tuple[DataFrame | None, set[str]]:
        """(rows of the newest fold, the batches in it)."""
        folds = self.folds()
        if not folds:
            return None, set()
        rows = self.spark.read.schema(_SCHEMA + ", batch string").parquet(f"{self.path}/fold={folds[-1]}")
        return rows.where("batch is null").drop("batch"), {r["batch"] for r in rows.where("batch is not null").select("batch").collect()}

    def _sums(self) -> tuple[DataFrame, list[str]]:
        """(signed sums of all committed deltas, the batches in them)."""
        folded, done = self._folded()
        names = self.batches()
        parts = [] if folded is None else [folded]
        if later := [f"{self.path}/batch={b}" for b in names if b not in done]:
            parts.append(self.spark.read.schema(_SCHEMA).parquet(*later))
        all_ = parts[0] if parts else self.spark.createDataFrame([], _SCHEMA)
        for more in parts[1:]:
            all_ = all_.union(more)
        return all_.groupBy(*GROUP).agg(F.sum("d_docs").alias("d_docs"), F.sum("d_tokens").alias("d_tokens")), names

    def fold(self) -> int:
        """Fold all committed batches into one table; its number. Rows with a ``batch`` name what is folded, so sums and names
        are written by one job and count only together; a fold that broke off leaves totals as they are."""
        sums, names = self._sums()
        number = max(self.folds(), default=0) + 1
        held = self.spark.createDataFrame([(b,) for b in names], "batch string").select(
            *[F.lit(None).cast("string").alias(c) for c in GROUP], F.lit(0).cast("long").alias("d_docs"), F.lit(0).cast("long").alias("d_tokens"), "batch")
        (sums.where("d_docs <> 0 or d_tokens <> 0").withColumn("batch", F.lit(None).cast("string")).union(held)
         .write.mode("overwrite").parquet(f"{self.path}/fold={number}"))
        return number

    def totals(self) -> DataFrame:
        """``(source, lang, tokenizer, n_docs, n_tokens)``; groups that have come back to nothing are left out."""
        return (self._sums()[0].select(*GROUP, F.col("d_docs").alias("n_docs"), F.col("d_tokens").alias("n_tokens"))
                .where("n_docs <> 0 or n_tokens <> 0"))

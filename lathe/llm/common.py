"""Helpers shared by the corpus operators: table access, tables written to the shared folder, hot-key joins,
connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.session import checkpoint_dir

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()
_SPACES = "\t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the session's shared checkpoint folder and read it back: lineage ends there,
    a lost executor costs a re-read, and the optimizer knows the written size (it broadcasts by its own limit)."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c) -> Column:
    """A-Z lower-cased; every other character unchanged."""
    return F.translate(c, _UPPER, _LOWER)


def words(text, drop: str = "") -> Column:
    """Array of the runs of characters other than space and \\t-\\r, A-Z lower-cased; characters in ``drop`` vanish.
    Null text gives an empty array."""
    flat = F.translate(F.coalesce(text, F.lit("")), _UPPER + _SPACES + drop, _LOWER + " " * len(_SPACES))
    return F.array_remove(F.split(flat, " "), "")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no column of that name (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often ``body`` names it (the optimizer may copy a
    column's expression into each place that reads it, inside lambdas too)."""
    return F.transform(F.array(value), body)[0]


def salted_join(big: DataFrame, small: DataFrame, on: list[str], spread, salts: int = 16, how: str = "inner") -> DataFrame:
    """Equi-join in which a hot key of ``big`` is dealt over ``salts`` tasks: ``small`` is repeated once per salt.
    ``spread`` is a column of ``big`` that differs between the rows of one key."""
    b = big.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return b.join(s, [*on, "_salt"], how).drop("_salt")


def connected_components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every id in ``edges(a, b)``; the component is the smallest id reachable.

    Each round every node takes its smallest neighbour (or itself) as parent, parents are followed once more, and
    the edges are contracted to parents; rounds end when no edge joins two labels. Everything stays in tables in
    the shared folder; the driver sees one count per round. Null ids and self-loops are ignored; no edges give no
    rows."""
    e = materialize(edges.where("a is not null and b is not null and a <> b")
                    .select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct(), "cc-edges")
    labels = None
    while True:
        n = e.count()
        if n == 0 and labels is not None:
            return labels
        both = e.union(e.select(F.col("y").alias("x"), F.col("x").alias("y")))
        parent = materialize(both.groupBy(F.col("x").alias("id")).agg(F.min("y").alias("m"))
                             .select("id", F.least("id", "m").alias("p")), "cc-parent")
        up = parent.select(F.col("id").alias("p"), F.col("p").alias("pp"))
        parent = materialize(parent.join(up, "p").select("id", F.col("pp").alias("p")), "cc-parent")
        if labels is None:
            labels = parent.select("id", F.col("p").alias("component"))
        else:
            step = parent.select(F.col("id").alias("component"), "p")
            labels = materialize(labels.join(step, "component", "left")
                                 .select("id", F.coalesce("p", "component").alias("component")), "cc-labels")
        if n == 0:
            return labels
        px = parent.select(F.col("id").alias("x"), F.col("p").alias("px"))
        py = parent.select(F.col("id").alias("y"), F.col("p").alias("py"))
        e = materialize(e.join(px, "x").join(py, "y").where("px <> py")
                        .select(F.least("px", "py").alias("x"), F.greatest("px", "py").alias("y")).distinct(), "cc-edges")

"""Embedding near-dedup: spherical k-means cells, blocked cosine products inside cells, one representative kept.

Equal vectors collapse first. Centroids are fitted on a bounded, hash-chosen sample (``fit_rows``, a documented bound;
every vector is indexed). Each vector enters its ``probes`` nearest cells; a pair is compared in every cell both are in
and counted in the first of them, so recall depends only on whether two near vectors share one of their nearest cells
(tested at >= 0.9 against brute force; measured 1.0). Cells are cut into blocks of ``block`` vectors; a task holds one
pair of blocks and emits link counts and the components of the tile, never pairs, so work on a hot cell is spread and
no output grows with the square of a group.

A vector that is null, empty, zero, or holds null or non-finite parts links with nothing; so does a row without vec_id
(null component, kept). Rows that repeat a vec_id and its vector are one vector. Vectors of different lengths never
link. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathe.llm.common import connected_components, materialize

FIT_ROWS = 20_000
LENGTH_ROWS = 256
CELL_ROWS = 1_000
MAX_CELLS = 4_096
PROBES = 4
BLOCK = 1_024


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """``k`` unit centroids of the unit rows ``x`` (fewer if there are fewer rows). An empty cell keeps its centroid."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = np.concatenate([(x[i:i + 4096] @ c.T).argmax(axis=1) for i in range(0, len(x), 4096)])
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(norm > 0, total / np.where(norm > 0, norm, 1), c)
    return c


def _unit(vectors) -> np.ndarray:
    """Unit rows in double precision; scaled by the largest part first, so no square overflows or vanishes."""
    x = np.array(list(vectors), dtype=np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _assign(centroids: dict[int, np.ndarray], probes: int):
    def run(batches):
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                c = centroids.get(int(dim))
                x = _unit(part["embedding"])
                if c is None:
                    near = np.zeros((len(part), 1), dtype=np.int64)
                else:
                    p = min(probes, len(c))
                    near = np.empty((len(part), p), dtype=np.int64)
                    for i in range(0, len(part), 1024):
                        near[i:i + 1024] = np.argpartition(-(x[i:i + 1024] @ c.T), p - 1, axis=1)[:, :p]
                yield pd.DataFrame({"rep": part["rep"], "mult": part["mult"], "dim": part["dim"], "embedding": part["embedding"],
                                    "cells": list(np.sort(near, axis=1))})
    return run


def _tile(least: float):
    def run(key, pdf):
        _, cell, lo, hi = (int(k) for k in key)
        x = _unit(pdf["embedding"])
        rep, mult, own = pdf["rep"].to_numpy(), pdf["mult"].to_numpy(), pdf["own"].to_numpy()
        cells = np.array(list(pdf["cells"]))
        links = np.zeros(len(pdf), dtype=np.int64)
        label = np.arange(len(pdf))
        order = np.argsort(rep, kind="stable")
        x, rep, mult, own, cells = x[order], rep[order], mult[order], own[order], cells[order]
        left = np.flatnonzero(own == lo)
        right = np.flatnonzero(own == hi)
        near_i, near_j = [], []
        for at in range(0, len(left), 256):
            rows = left[at:at + 256]
            i, j = np.nonzero(x[rows] @ x[right].T >= least)
            i, j = rows[i], right[j]
            ok = i < j if lo == hi else i != j
            near_i.append(i[ok])
            near_j.append(j[ok])
        i, j = np.concatenate(near_i or [[]]).astype(int), np.concatenate(near_j or [[]]).astype(int)
        if not len(i):
            return pd.DataFrame({"rep": [], "links": [], "root": []}, dtype="int64")
        first = np.full(len(i), np.iinfo(np.int64).max)
        for a in range(cells.shape[1]):
            for b in range(cells.shape[1]):
                same = cells[i, a] == cells[j, b]
                first[same] = np.minimum(first[same], cells[i[same], a])
        mine = first == cell
        np.add.at(links, i[mine], mult[j[mine]])
        np.add.at(links, j[mine], mult[i[mine]])
        while True:  # rows are in rep order, so the smallest row number of a component is its smallest rep
            before = label.copy()
            np.minimum.at(label, i, before[j])
            np.minimum.at(label, j, before[i])
            label = label[label]
            if (label == before).all():
                break
        has = np.unique(np.concatenate((i, j)))
        return pd.DataFrame({"rep": rep[has], "links": links[has], "root": rep[label[has]]})
    return run


def fit_cells(reps: DataFrame, n: int, fit_rows: int = FIT_ROWS, cell_rows: int = CELL_ROWS) -> dict[int, np.ndarray]:
    """Centroids per vector length, from about ``fit_rows`` rows chosen by hash, shared among the lengths by their rows,
    but about ``LENGTH_ROWS`` of each length at least (all, if it has fewer), so no length goes without centroids."""
    totals = {r["dim"]: r["count"] for r in reps.groupBy("dim").count().collect()}  # one row per vector length
    least = F.lit(0)
    for dim, rows in totals.items():
        share = min(1.0, max(fit_rows / n, LENGTH_ROWS / rows))
        least = F.when(F.col("dim") == dim, F.lit(int(share * (1 << 62)))).otherwise(least)
    sample = reps.where(F.pmod(F.xxhash64("rep", F.lit("fit")), F.lit(1 << 62)) < least).select("rep", "dim", "embedding").toPandas()
    out = {}
    for dim, part in sample.sort_values("rep").groupby("dim"):
        total = totals[dim]
        out[int(dim)] = spherical_kmeans(_unit(part["embedding"]), int(max(1, min(MAX_CELLS, total // cell_rows))))
    return out


def embedding_groups(vectors: DataFrame, least: float = 0.95, probes: int = PROBES, fit_rows: int = FIT_ROWS,
                     cell_rows: int = CELL_ROWS, block: int = BLOCK) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per input row; see the module text."""
    vectors = vectors.select("vec_id", "embedding")
    e = F.col("embedding")
    finite = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    good = e.isNotNull() & (F.size(e) > 0) & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(e, lambda v: v != 0), F.lit(False))
    all_ = materialize(vectors.withColumn("good", F.col("vec_id").isNotNull() & F.coalesce(good, F.lit(False))), "emb-all")
    valid = all_.where("good").select("vec_id", "embedding").distinct()
    reps = materialize(valid.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("mult"))
                       .select("rep", "mult", F.size("embedding").alias("dim"), "embedding"), "emb-reps")
    n = reps.count()
    cents = fit_cells(reps, n, fit_rows, cell_rows)
    cells = materialize(reps.mapInPandas(_assign(cents, probes), "rep long, mult long, dim int, embedding array<float>, cells array<long>"
                                         .replace("array<float>", vectors.schema["embedding"].dataType.simpleString())), "emb-cells")
    spread = cells.withColumn("cell", F.explode("cells"))
    sizes = materialize(spread.groupBy("dim", "cell").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")), "emb-sizes")
    rows = (spread.join(sizes, ["dim", "cell"])
            .withColumn("own", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other"))
            .select("dim", "cell", "lo", "hi", "own", "rep", "mult", "embedding", "cells"))
    found = materialize(rows.groupBy("dim", "cell", "lo", "hi").applyInPandas(_tile(least), "rep long, links long, root long"), "emb-links")

    comps = connected_components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    per_rep = materialize(reps.select("rep", "mult", "embedding").join(links, "rep", "left")
                          .join(comps.withColumnRenamed("id", "rep"), "rep", "left")
                          .select("embedding", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("links"),
                                  F.coalesce("component", "rep").alias("component")), "emb-reps-out")
    shared = materialize(per_rep.where("links > 0"), "emb-linked")
    linked = all_.where("good").join(shared, "embedding").select("vec_id", "links", "component").distinct()
    # Rows that repeat a vec_id with other vectors share one node: smallest component, all links.
    per_id = materialize(linked.groupBy("vec_id").agg(F.sum("links").alias("links"), F.min("component").alias("component")), "emb-ids")
    return (all_.select("vec_id").join(per_id, "vec_id", "left")
            .select("vec_id", F.coalesce("links", F.lit(0).cast("long")).alias("n_links"),
                    F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


def keep_representatives(vectors: DataFrame, **options) -> DataFrame:
    """``vectors`` without the rows whose component has a smaller vec_id; all columns stay."""
    gone = materialize(embedding_groups(vectors, **options).where("not kept").select("vec_id").distinct(), "emb-gone")
    return vectors.join(gone, "vec_id", "left_anti")

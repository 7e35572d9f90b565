"""MinHash near-dedup by min-max hashing.

Each permutation of a document's shingle hashes gives two signature values, its minimum and its maximum, so a
signature of ``2 * permutations`` values costs half the hash evaluations; both are unbiased for the Jaccard
similarity. Bands of four values make candidates; every link is confirmed on the full shingle sets.

Plan: (1) one pass makes set size, a 128-bit set fingerprint, signature and band keys per document; (2) equal sets
collapse into one class (copies are never expanded into pairs); (3) in each band bucket every class is compared with
the bucket's smallest class (a star, linear in the bucket), filtered by the signatures and confirmed on full sets;
(4) in buckets of three or more classes that still hold several components, the classes outside the largest component
meet all others in blocks of ``block`` classes, where only pairs of different components are confirmed and only their
components leave the task; (5) connected components.

Null, empty or blank texts have no shingles and link with nothing. Rows that repeat a doc_id share its component
(their texts are compared each). A row without doc_id links with nothing: null component, kept. Extra columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathe.llm.common import connected_components, materialize
from lathe.llm.shingles import arrow_chunks, mix, shingle_sets

#: 48 permutations, 96 signature values, 24 bands of 4: a pair at similarity 0.8 is missed with probability
#: (1 - 0.8**4)**24 = 3e-6, and its signatures agree in under 60 % of the values with probability 4e-6.
PERMUTATIONS = 48
BAND = 4
SIGNATURE_FLOOR = 0.6
BLOCK = 512

_RNG = np.random.default_rng(7)
_A = _RNG.integers(0, 2**32, 512, dtype=np.uint32) | np.uint32(1)
_B = _RNG.integers(0, 2**32, 512, dtype=np.uint32)


def signatures(h: np.ndarray, first: np.ndarray, permutations: int) -> np.ndarray:
    """(documents, 2 * permutations) minima and maxima of ``permutations`` hashes of each document's shingles."""
    lo, hi = h.astype(np.uint32), (h >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(first), 2 * permutations), dtype=np.uint32)
    for k in range(permutations):
        v = lo * _A[k] + hi * _B[k]
        v ^= v >> np.uint32(15)
        out[:, 2 * k] = np.minimum.reduceat(v, first)
        out[:, 2 * k + 1] = np.maximum.reduceat(v, first)
    return out


def band_keys(sig: np.ndarray, band: int) -> np.ndarray:
    """One 64-bit key per band of ``band`` signature values."""
    n, width = sig.shape
    key = np.zeros((n, width // band), dtype=np.uint64)
    for k in range(band):
        key = mix(key + sig[:, k::band][:, :width // band].astype(np.uint64))
    return key


def _features(size: int, permutations: int, band: int):
    def run(batches):
        for batch in batches:
            for ids, docs in arrow_chunks(batch):
                h, d = shingle_sets(docs, size)
                n = np.bincount(d, minlength=len(docs))
                has = n > 0
                first = np.concatenate(([0], np.cumsum(n[has])))[:-1]
                s1, s2 = np.zeros(len(docs), dtype=np.uint64), np.zeros(len(docs), dtype=np.uint64)
                sigs, keys = np.zeros((0, 2 * permutations), np.uint16), np.zeros((0, 2 * permutations // band), np.int64)
                if len(first):
                    s1[has] = np.add.reduceat(mix(h), first)
                    s2[has] = np.add.reduceat(mix(~h), first)
                    sig = signatures(h, first, permutations)
                    sigs, keys = (sig & np.uint32(0xFFFF)).astype(np.uint16), band_keys(sig, band).view(np.int64)
                at = np.cumsum(has) - 1
                cut = np.concatenate(([0], np.cumsum(has) * keys.shape[1])).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(n, pa.int64()), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)),
                     pa.array([sigs[at[k]].tobytes() if has[k] else None for k in range(len(docs))], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(cut), pa.array(keys.ravel()))],
                    names=["doc_id", "n", "s1", "s2", "sig", "bands"])
    return run


def _sets(size: int):
    def run(batches):
        for batch in batches:
            for ids, docs in arrow_chunks(batch):
                h, d = shingle_sets(docs, size)
                n = np.bincount(d, minlength=len(docs))
                has = np.flatnonzero(n)
                cut = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
                s1 = np.add.reduceat(mix(h), cut[has]) if len(has) else np.empty(0, np.uint64)
                sets = pa.ListArray.from_arrays(pa.array(np.append(cut[has], cut[-1]).astype(np.int32)), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(has)), pa.array(s1.view(np.int64)), sets], names=["doc_id", "s1", "hashes"])
    return run


def _alike(floor: float):
    def run(batches):
        for pdf in batches:
            if len(pdf):
                a = np.frombuffer(b"".join(pdf.pop("sig_a")), dtype=np.uint16).reshape(len(pdf), -1)
                b = np.frombuffer(b"".join(pdf.pop("sig_b")), dtype=np.uint16).reshape(len(pdf), -1)
                yield pdf[(a == b).mean(axis=1) >= floor]
    return run


def _tile_links(floor: float, percent: int):
    """Components of one tile (stragglers against others): pairs of different components whose signatures agree are
    confirmed on the full sets, best first, and skipped once other links have joined them."""
    def run(pdf):
        sig = np.frombuffer(b"".join(pdf["sig"]), dtype=np.uint16).reshape(len(pdf), -1)
        comp, n, side = pdf["comp"].to_numpy(), pdf["n"].to_numpy(), pdf["straggler"].to_numpy()
        few, rest = np.flatnonzero(side), np.flatnonzero(~side)
        agree = np.empty((len(few), len(rest)), dtype=np.float32)
        for k, i in enumerate(few):
            agree[k] = (sig[rest] == sig[i]).mean(axis=1)
        ii, jj = np.nonzero((agree >= floor) & (comp[few][:, None] != comp[rest][None, :]))
        order = np.argsort(-agree[ii, jj], kind="stable")
        ii, jj = few[ii[order]], rest[jj[order]]
        sets = [np.asarray(x, dtype=np.int64) for x in pdf["hashes"]]
        root = {c: c for c in comp.tolist()}

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for i, j in zip(ii.tolist(), jj.tolist(), strict=True):
            x, y = find(int(comp[i])), find(int(comp[j]))
            if x == y or 100 * min(n[i], n[j]) < percent * max(n[i], n[j]):
                continue
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * both >= percent * (int(n[i]) + int(n[j]) - both):
                root[max(x, y)] = min(x, y)
        out = [(c, find(c)) for c in root if find(c) != c]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")
    return run


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, permutations: int = PERMUTATIONS,
                    band: int = BAND, floor: float = SIGNATURE_FLOOR, block: int = BLOCK) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per input row.

    ``size``: words in a shingle; ``percent``: least Jaccard similarity in percent; ``permutations``: hash
    evaluations per shingle (two signature values each); ``band``: values per band; ``floor``: least share of equal
    signature values before a pair is confirmed; ``block``: classes per side of a block in large buckets."""
    docs = docs.select("doc_id", "text")
    long = docs.schema["doc_id"].dataType.simpleString()
    feats = materialize(docs.mapInArrow(_features(size, permutations, band),
                                         f"doc_id {long}, n long, s1 long, s2 long, sig binary, bands array<long>"), "mm-feats")
    valid = feats.where("n > 0 and doc_id is not null")
    key = ["n", "s1", "s2"]
    copies = materialize(valid.groupBy(*key).agg(F.min("doc_id").alias("rep"), F.count("*").alias("c"))
                         .where("c > 1").drop("c"), "mm-copies")
    member = valid.select("doc_id", *key, "sig", "bands").join(copies, key, "left").withColumn("rep", F.coalesce("rep", "doc_id"))
    classes = materialize(member.where("doc_id = rep").select("rep", "n", "s1", "sig", "bands")
                          .dropDuplicates(["rep", "s1"]), "mm-classes")
    copy_edges = valid.join(copies, key).where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    who = F.struct("rep", "s1", "n").alias("who")
    spread = classes.select(who, F.posexplode("bands").alias("band", "key"))
    buckets = materialize(spread.groupBy("band", "key").agg(F.count("*").alias("m"), F.min("who").alias("pivot")).where("m > 1"), "mm-buckets")
    sat = materialize(spread.join(buckets, ["band", "key"]).select("band", "key", "m", "who", "pivot"), "mm-bucket-rows")

    close = "100 * least(a.n, b.n) >= {0} * greatest(a.n, b.n)".format(percent)
    pairs = sat.select(F.col("pivot").alias("a"), F.col("who").alias("b")).where("a <> b").where(close).distinct()
    sig = classes.select("rep", "s1", "sig")
    pairs = (pairs.join(sig.select(F.col("rep").alias("br"), F.col("s1").alias("bs"), F.col("sig").alias("sig_b")),
                        F.expr("b.rep = br and b.s1 = bs"))
             .join(sig.select(F.col("rep").alias("ar"), F.col("s1").alias("as_"), F.col("sig").alias("sig_a")),
                   F.expr("a.rep = ar and a.s1 = as_"))
             .select(F.expr("a.rep").alias("a"), F.expr("a.s1").alias("as"), F.expr("a.n").alias("an"),
                     F.expr("b.rep").alias("b"), F.expr("b.s1").alias("bs"), F.expr("b.n").alias("bn"), "sig_a", "sig_b"))
    pairs = materialize(pairs.mapInPandas(_alike(floor), f"a {long}, as long, an long, b {long}, bs long, bn long"), "mm-pairs")

    wanted = materialize(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b"))
                         .union(sat.where("m > 2").select("who.rep")).distinct(), "mm-wanted")
    text = docs.join(wanted.hint("shuffle_hash"), "doc_id", "left_semi")
    sets = materialize(text.mapInArrow(_sets(size), f"doc_id {long}, s1 long, hashes array<long>")
                       .dropDuplicates(["doc_id", "s1"]), "mm-sets")

    # One side of each pair at a time; the pivot's set moves once per pair, in tasks that AQE splits when a pivot is hot.
    sa = sets.select(F.col("doc_id").alias("a"), F.col("s1").alias("as"), F.col("hashes").alias("ha"))
    sb = sets.select(F.col("doc_id").alias("b"), F.col("s1").alias("bs"), F.col("hashes").alias("hb"))
    both = F.size(F.array_intersect("ha", "hb"))
    star = materialize(pairs.join(sb, ["b", "bs"]).join(sa, ["a", "as"]).withColumn("i", both)
                       .where(f"100 * i >= {percent} * (an + bn - i)").select("a", "b"), "mm-star")
    edges = star.union(copy_edges)
    comps = connected_components(edges)

    left = (sat.where("m > 2").select("band", "key", "who.rep", "who.s1", "who.n")
            .join(comps.select(F.col("id").alias("rep"), F.col("component").alias("comp")), "rep", "left")
            .withColumn("comp", F.coalesce("comp", "rep")))
    # A bucket's pairs inside its largest component need no test. Buckets with the same largest component are one group,
    # in which the classes outside it (stragglers) meet every class, once and not per band.
    top = (left.groupBy("band", "key", "comp").agg(F.count("*").alias("c"))
           .groupBy("band", "key").agg(F.max(F.struct(F.col("c"), -F.col("comp"))).alias("top"), F.count("*").alias("comps"))
           .where("comps > 1").select("band", "key", (-F.col("top.col2")).alias("main")))
    group = materialize(left.join(materialize(top, "mm-open"), ["band", "key"]).select("main", "rep", "s1", "n", "comp").distinct(), "mm-group")
    sizes = group.groupBy("main").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"),
                                      F.ceil(F.count_if(F.col("comp") != F.col("main")) / block).cast("int").alias("few"))
    rows = (group.join(materialize(sizes, "mm-sizes"), "main").join(sig, ["rep", "s1"]).join(sets.withColumnRenamed("doc_id", "rep"), ["rep", "s1"])
            .withColumn("h", F.xxhash64("rep", "s1")))
    cols = ["main", "x", "y", "n", "comp", "sig", "hashes", "straggler"]
    few = (rows.where("comp <> main").withColumn("straggler", F.lit(True)).withColumn("x", F.pmod("h", "few").cast("int"))
           .withColumn("y", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(*cols))
    rest = (rows.withColumn("straggler", F.lit(False)).withColumn("y", F.pmod("h", "blocks").cast("int"))
            .withColumn("x", F.explode(F.sequence(F.lit(0), F.col("few") - 1))).select(*cols))
    found = materialize(few.union(rest).groupBy("main", "x", "y").applyInPandas(_tile_links(floor, percent), "a long, b long"), "mm-tiles")
    more = connected_components(found).select(F.col("id").alias("component"), F.col("component").alias("c2"))
    comps = materialize(comps.union(found.select("a", F.col("a").alias("c")).join(comps.select(F.col("id").alias("a")), "a", "left_anti"))
                        .union(found.select("b", F.col("b").alias("c")).join(comps.select(F.col("id").alias("b")), "b", "left_anti"))
                        .distinct().join(more, "component", "left")
                        .select("id", F.coalesce("c2", "component").alias("component")), "mm-components")

    return (feats.select("doc_id", F.col("n").alias("n_shingles"))
            .join(comps.withColumnRenamed("id", "doc_id"), "doc_id", "left")
            .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
            .select("doc_id", "n_shingles", "component_id", "kept"))


def keep_representatives(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each component, its smallest doc_id; all columns stay. Of rows that repeat a kept doc_id
    one stays; rows without doc_id stay."""
    verdict = near_duplicates(docs, **options)
    gone = materialize(verdict.where("not kept").select("doc_id").distinct(), "mm-gone")
    docs = docs.join(gone.hint("shuffle_hash"), "doc_id", "left_anti")
    again = materialize(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "mm-repeated")
    if again.isEmpty():
        return docs
    return docs.join(again, "doc_id", "left_anti").unionByName(docs.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"]))

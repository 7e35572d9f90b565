"""Vector code compression: product codes whose nearest entries are found by Orchard search.

Components become whole numbers (``scale`` times the component, rounded down), vectors are cut into equal parts, and each
part has a codebook. For every entry a list of all entries, sorted by their distance from it, is kept. A search stands at
one entry, goes down its list, marks what it visits, and jumps to the list of an entry that is nearer; it ends where the
list is farther than twice the current distance, since no entry from there on can be as near. Searches of a block of
vectors go in step, ``AHEAD`` list places at a time. All arithmetic is in 64-bit whole numbers, so codes, errors and
codebooks depend neither on partitions nor on the order of rows.

Codebooks start as the parts of the first vectors by id. A round assigns all vectors; every task sends one sum and one count
per entry and component, Spark adds them up, and the driver gets one row per entry and component, whatever the number of
vectors. The last assignment writes the codes.

Rows whose vector is null, or holds null or non-finite components, are dropped. A component beyond 2^26 / ``scale`` in size counts as
that, so that no distance leaves 64 bits. Every vector length has its own codebooks; vectors whose length is no multiple
of ``parts``, or zero, have no code (null code, error and codebook hash). Rows without an id, or that repeat one, are
vectors of their own; the first vectors are ordered by id (null last), then components. With fewer vectors than entries
every one of them is an entry. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathe.llm.common import materialize, salted_join

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
AHEAD = 16
BLOCK = 4096
_LARGEST = 1 << 26


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances of the rows of ``a`` and ``b`` in whole numbers."""
    d = a - b
    return np.einsum("...i,...i->...", d, d)


class Orchard:
    """Nearest-entry search in one codebook (rows of whole numbers). ``order[e]`` lists all entries by (distance from e,
    index), ``far[e]`` their squared distances."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        d = np.stack([squared(entries, e) for e in entries])
        self.order = np.argsort(d, axis=1, kind="stable")
        self.far = np.take_along_axis(d, self.order, axis=1)
        # a start near the query: the entry whose component sum is nearest
        self.by_sum = np.argsort(entries.sum(axis=1), kind="stable")
        self.sums = entries.sum(axis=1)[self.by_sum]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the nearest entry of every row of ``x``, ties to the lower index; its squared distance)."""
        at, best = np.empty(len(x), dtype=np.int64), np.empty(len(x), dtype=np.int64)
        for lo in range(0, len(x), BLOCK):
            at[lo:lo + BLOCK], best[lo:lo + BLOCK] = self._block(x[lo:lo + BLOCK])
        return at, best

    def _block(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = len(self.entries)
        at = self.by_sum[np.minimum(np.searchsorted(self.sums, x.sum(axis=1)), k - 1)]
        best = squared(x, self.entries[at])
        visited = np.zeros((len(x), k), dtype=bool)
        visited[np.arange(len(x)), at] = True
        live, place = np.arange(len(x)), np.zeros(len(x), dtype=np.int64)
        while len(live):
            span = place[live, None] + np.arange(AHEAD)
            inside = span < k
            span = np.minimum(span, k - 1)
            here = at[live, None]
            entry = self.order[here, span]
            # squared: farther than twice the current distance means more than four times its square
            inside &= self.far[here, span] <= 4 * best[live, None]
            row, col = np.nonzero(inside & ~visited[live[:, None], entry])
            e, q = entry[row, col], live[row]
            visited[q, e] = True
            d = squared(x[q], self.entries[e])
            # the least (distance, index) of each row's new entries
            s = np.lexsort((e, d, row))
            row, e, d = row[s], e[s], d[s]
            head = np.flatnonzero(np.diff(row, prepend=-1))
            row, e, d, q = row[head], e[head], d[head], live[row[head]]
            better = (d < best[q]) | ((d == best[q]) & (e < at[q]))
            done = ~inside[:, -1]
            place[live] += AHEAD
            at[q[better]], best[q[better]] = e[better], d[better]
            place[q[better]] = 0  # the improved entry's list, from its start
            done[row[better]] = False
            live = live[~done]
        return at, best


def _by_length(batch: pa.RecordBatch):
    """(length, rows of that length, their parts' components) of a batch with columns ``dim`` and ``ints``."""
    dims = np.asarray(batch.column("dim"))
    for dim in np.unique(dims).tolist():
        rows = batch.filter(pa.array(dims == dim))
        yield dim, rows, np.asarray(rows.column("ints").flatten()).astype(np.int64).reshape(-1, dim)


def _sums(books: dict[int, list[np.ndarray]], parts: int):
    """Per task: (dim, part, entry, place, total); place -1 is the number of assigned parts."""
    def run(batches):
        total = {}
        search = {dim: [Orchard(b) for b in book] for dim, book in books.items()}
        for batch in batches:
            for dim, _, ints in _by_length(batch):
                for p, x in enumerate(np.split(ints, parts, axis=1)):
                    at, _ = search[dim][p].nearest(x)
                    t = total.setdefault((dim, p), np.zeros((len(books[dim][p]), x.shape[1] + 1), dtype=np.int64))
                    np.add.at(t, at, np.concatenate((np.ones((len(x), 1), dtype=np.int64), x), axis=1))
        for (dim, p), t in total.items():
            used = np.flatnonzero(t[:, 0])
            n = t.shape[1] * len(used)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, dim, dtype=np.int32)), pa.array(np.full(n, p, dtype=np.int32)), pa.array(np.repeat(used, t.shape[1]).astype(np.int32)),
                 pa.array(np.tile(np.arange(-1, t.shape[1] - 1, dtype=np.int32), len(used))), pa.array(t[used].ravel())],
                ["dim", "part", "entry", "place", "total"])
    return run


def _codes(books: dict[int, list[np.ndarray]], parts: int):
    def run(batches):
        search = {dim: [Orchard(b) for b in book] for dim, book in books.items()}
        for batch in batches:
            for dim, rows, ints in _by_length(batch):
                found = [search[dim][p].nearest(x) for p, x in enumerate(np.split(ints, parts, axis=1))]
                codes = np.stack([at for at, _ in found], axis=1).astype(np.int32)
                offsets = pa.array(np.arange(0, codes.size + 1, parts, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("vec_id"), rows.column("label"), rows.column("dim"), pa.ListArray.from_arrays(offsets, pa.array(codes.ravel())),
                     pa.array(np.sum([d for _, d in found], axis=0))], ["vec_id", "label", "dim", "codes", "error"])
    return run


def whole_numbers(vectors: DataFrame, parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """``(vec_id, label, dim, ints, coded)`` of the rows whose vector has only finite components; ``coded`` says that the length
    can be cut into ``parts``."""
    e = F.col("embedding")
    finite = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    ints = F.transform(e, lambda v: F.greatest(F.lit(-_LARGEST), F.least(F.lit(_LARGEST), F.floor(v.cast("double") * scale))).cast("int"))
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int").alias("label")
    return (vectors.where(e.isNotNull() & F.coalesce(finite, F.lit(False)))
            .select("vec_id", label, F.size(e).alias("dim"), ints.alias("ints"),
                    ((F.size(e) > 0) & (F.size(e) % parts == 0)).alias("coded")))


def fit_codebooks(ints: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> dict[int, list[np.ndarray]]:
    """Per vector length, the codebook of every part after ``rounds`` rounds of assignment and averaging over all rows of
    ``ints(vec_id, dim, ints)``."""
    books = {}
    for (dim,) in ints.select("dim").distinct().collect():  # lengths, not rows
        first = ints.where(F.col("dim") == dim).orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).collect()
        books[dim] = [b.copy() for b in np.split(np.array([r["ints"] for r in first], dtype=np.int64), parts, axis=1)]
    for _ in range(rounds if books else 0):
        sums = (ints.select("dim", "ints").mapInArrow(_sums(books, parts), "dim int, part int, entry int, place int, total long")
                .groupBy("dim", "part", "entry", "place").agg(F.sum("total").alias("total")).toPandas())
        for (dim, p), t in sums.groupby(["dim", "part"]):
            t = t.pivot(index="entry", columns="place", values="total").sort_index(axis=1)
            books[dim][p][t.index] = t.to_numpy()[:, 1:] // t[-1].to_numpy()[:, None]  # rounds down; unused entries stay
    return books


def codebook_hash(book: list[np.ndarray]) -> str:
    """sha256 of the components of all entries by part, entry and place, in decimal, comma-joined."""
    return hashlib.sha256(",".join(str(v) for part in book for v in part.ravel().tolist()).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: int = SCALE) -> tuple[DataFrame, dict[int, list[np.ndarray]]]:
    """(codes, codebooks): ``(vec_id, label, dim, codes, error)``, where ``codes`` is the entry of every part and ``error`` the squared
    distance from them, written to the shared folder; and the codebooks by vector length."""
    rows = materialize(whole_numbers(vectors, parts, scale), "codes-ints")
    coded = rows.where("coded").drop("coded")
    books = fit_codebooks(coded, parts, entries, rounds)
    kind, label = rows.schema["vec_id"].dataType.simpleString(), rows.schema["label"].dataType.simpleString()
    codes = coded.select("vec_id", "label", "dim", "ints").mapInArrow(
        _codes(books, parts), f"vec_id {kind}, label {label}, dim int, codes array<int>, error long")
    bare = rows.where("not coded").select("vec_id", "label", "dim", F.lit(None).cast("array<int>").alias("codes"),
                                          F.lit(None).cast("long").alias("error"))
    return materialize(codes.union(bare), "codes"), books


def hex_code(codes: Column) -> Column:
    """Two lower-case hex digits per part."""
    return F.array_join(F.transform(codes, lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")


def code_digests(codes: DataFrame, books: dict[int, list[np.ndarray]]) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)``: ``label_error`` is the error summed over the rows of equal label
    (nulls together). A common label's rows are dealt over many tasks in the join."""
    keyed = codes.withColumn("no_label", F.col("label").isNull()).withColumn("known", F.coalesce("label", F.lit(0).cast(codes.schema["label"].dataType)))
    total = keyed.groupBy("no_label", "known").agg(F.sum("error").alias("label_error"))
    sha = F.lit(None).cast("string")
    for dim, book in books.items():
        sha = F.when((F.col("dim") == dim) & F.col("codes").isNotNull(), F.lit(codebook_hash(book))).otherwise(sha)
    return (salted_join(keyed, total, ["no_label", "known"], F.struct("vec_id", "codes"))
            .select("vec_id", hex_code(F.col("codes")).alias("code"), "error", "label_error", sha.alias("codebooks_sha256")))


def decode(codes: DataFrame, books: dict[int, list[np.ndarray]], scale: int = SCALE) -> DataFrame:
    """``codes`` with ``approximation``, the vector that the code stands for (the middle of each component's step)."""
    kind, label = codes.schema["vec_id"].dataType.simpleString(), codes.schema["label"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for dim in np.unique(np.asarray(batch.column("dim"))).tolist():
                rows = batch.filter(pa.array(np.asarray(batch.column("dim")) == dim))
                code = np.asarray(rows.column("codes").flatten()).reshape(len(rows), -1)
                near = np.concatenate([b[code[:, p]] for p, b in enumerate(books[dim])], axis=1)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, near.size + 1, dim, dtype=np.int32)), pa.array(((near + 0.5) / scale).ravel()))
                yield pa.RecordBatch.from_arrays([*rows.columns, flat], [*rows.schema.names, "approximation"])
    return codes.where("codes is not null").select("vec_id", "label", "dim", "codes", "error").mapInArrow(
        run, f"vec_id {kind}, label {label}, dim int, codes array<int>, error long, approximation array<double>")

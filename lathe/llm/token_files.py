"""Token-id output: documents in ascending doc_id order, tokenized and written as coded segments; and reading them back.

File format: a Parquet table of segments. A segment is a run of whole documents of about ``SEGMENT_IDS`` ids, half as many more at
most (a longer document is a segment of its own; the last segments of a task share what is left evenly): ``shard, segment`` (their order is the order of the documents), ``doc_ids``,
``lengths`` (ids per document, end id included), ``n_ids`` and ``payload``, the coded ids with the crc32 of each block
(see range_coder). Segments are decoded independently of each other.

Each task reads one doc_id range, so no task sees more than its range, and holds two segments at a time. Null or empty
texts are the end id alone. Rows without doc_id come first. Rows that repeat a doc_id follow each other, ordered by text.
Extra columns are ignored; an empty table writes a table without segments.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lathe.llm.common import materialize
from lathe.llm.range_coder import decode, encode
from lathe.session import checkpoint_dir

SEGMENT_IDS = 1 << 22
BATCH_BYTES = 1 << 22
CACHED_CHUNKS = 500_000
CACHED_CHARS = 64
_SCHEMA = "shard int, segment int, doc_ids array<{0}>, lengths array<long>, n_ids long, payload binary"

# A byte-level vocabulary never joins across a space that follows a character other than white space: the text before
# that space and the text from it on are encoded independently. The class below holds all that any library counts as white space.
_LOOSE = r"[\t-\r\x1c-\x20\x{85}\p{Z}\x{180e}\x{200b}\x{feff}] "
_WHITE = "\\s\x85\u180e\u200b\ufeff"
_JOINT = re.compile(f"(?<![{_WHITE}]) ")
_ENDS_WHITE = re.compile(f"[{_WHITE}]")


class Encoder:
    """Ids of texts by a tokenizer file of the tokenizers library, special tokens not added. Texts for a byte-level
    vocabulary are split at spaces into chunks; a repeated chunk of at most ``CACHED_CHARS`` characters is encoded once
    and remembered (about ``CACHED_CHUNKS`` of them)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        spec = json.loads(self.tok.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self.chunked = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                        and spec.get("normalizer") is None)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.sizes = np.array([len(self.tok.id_to_token(i) or "") for i in range(self.tok.get_vocab_size())])  # bytes of each id
        self.clear()

    def clear(self) -> None:
        """Forget all chunks. ``number`` numbers the known chunks; the ids of chunk k are flat[first[k]:first[k + 1]]."""
        self.number: dict[str, int] = {"": 0}
        self.flat = np.empty(1 << 16, dtype=np.uint32)
        self.first = np.zeros(1 << 14, dtype=np.int64)

    def _ids(self, chunks: list[str]) -> np.ndarray:
        return np.array(self.tok.encode_batch_fast(["".join(chunks)], add_special_tokens=False)[0].ids, dtype=np.uint32)

    def _learn(self, new: list[str]) -> None:
        """Chunks that start with a space and do not end with white space are encoded side by side, as one text, and told
        apart by the bytes of their ids."""
        alone, joint = [], []
        for c in new:
            (joint if c[0] == " " and not _ENDS_WHITE.match(c[-1]) else alone).append(c)
        parts, counts = [], []
        for at in range(0, len(joint), 50_000):
            some = joint[at:at + 50_000]
            ids = self._ids(some)
            ends = np.cumsum(self.sizes[ids])
            stops = np.cumsum([len(c.encode()) for c in some])
            last = np.searchsorted(ends, stops)
            if not (ends[last] == stops).all():
                raise ValueError("the tokenizer joins ids across a space")
            parts.append(ids)
            counts.append(np.diff(last, prepend=-1))
        for c in alone:
            parts.append(self._ids([c]))
            counts.append([len(parts[-1])])
        k, ids, counts = len(self.number), np.concatenate(parts), np.concatenate(counts)
        used, more = int(self.first[k]), k + len(new) + 1
        if used + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.empty(used + len(ids), dtype=np.uint32)))
        if more > len(self.first):
            self.first = np.concatenate((self.first, np.zeros(more, dtype=np.int64)))
        self.flat[used:used + len(ids)] = ids
        self.first[k + 1:more] = used + np.cumsum(counts)
        self.number.update(zip(joint + alone, range(k, more), strict=False))

    def _chunks(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(number of every chunk of the texts in order, chunks per text)."""
        loose = np.asarray(pc.match_substring_regex(texts, _LOOSE))
        if loose.any():  # split where the space follows no other white space
            tight = pc.split_pattern(texts.filter(pa.array(~loose)), " ")
            lists = pa.concat_arrays([tight, pa.array([_JOINT.split(t) for t in texts.filter(pa.array(loose)).to_pylist()], tight.type)])
        else:
            lists = pc.split_pattern(texts, " ")
        counts = np.asarray(pc.list_value_length(lists)).astype(np.int64)
        coded = pc.list_flatten(lists).dictionary_encode()
        codes = np.asarray(coded.indices)
        starts = np.cumsum(counts) - counts
        later = [" " + c for c in coded.dictionary.to_pylist()]
        head = [later[k][1:] for k in codes[starts]]  # the first chunk of a text has no space before it
        new = list({*later, *head}.difference(self.number))
        if len(self.number) > CACHED_CHUNKS and 2 * len(new) > len(later):  # the texts have changed
            self.clear()
            new = list({*later, *head}.difference(self.number))
        full = len(self.number) > CACHED_CHUNKS
        kept = [c for c in new if len(c) <= CACHED_CHARS and not full]
        self.passing = new if full else [c for c in new if len(c) > CACHED_CHARS]
        for some in (kept, self.passing):
            if some:
                self._learn(some)
        at = np.array([self.number[c] for c in later], dtype=np.int64)[codes]
        at[starts] = [self.number[c] for c in head]
        if loose.any():  # back to the order of the texts
            order = np.argsort(np.concatenate((np.flatnonzero(~loose), np.flatnonzero(loose))))
            counts, starts = counts[order], starts[order]
            stop = np.cumsum(counts)
            at = at[np.repeat(starts - (stop - counts), counts) + np.arange(len(at))]
        return at, counts

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each followed by ``end``; ids per text). Null texts are empty."""
        texts = pc.fill_null(texts, "")
        alone = np.full(len(texts), not self.chunked)
        for s in self.special:
            alone |= np.asarray(pc.match_substring(texts, s))
        whole = {i: self._ids([texts[i].as_py()]) for i in np.flatnonzero(alone)}
        at, counts = self._chunks(pc.if_else(pa.array(alone), "", texts) if whole else texts)
        size = self.first[at + 1] - self.first[at]
        ends = np.concatenate(([0], np.cumsum(size)))
        body = self.flat[np.repeat(self.first[at] - ends[:-1], size) + np.arange(ends[-1])]
        for c in self.passing:
            del self.number[c]
        lengths = np.diff(ends[np.concatenate(([0], np.cumsum(counts)))]) + 1
        for i, ids in whole.items():
            lengths[i] = len(ids) + 1
        stop = np.cumsum(lengths)
        out = np.full(stop[-1], end, dtype=np.uint32)
        plain = np.ones(len(out), dtype=bool)
        plain[stop - 1] = False
        for i, ids in whole.items():
            plain[stop[i] - 1 - len(ids):stop[i] - 1] = False
            out[stop[i] - 1 - len(ids):stop[i] - 1] = ids
        out[plain] = body
        return out, lengths


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _write(path: str, end: int, segment_ids: int):
    def run(batches):
        kinds = None
        enc, shard, number = _encoder(path), TaskContext.get().partitionId(), 0
        docs, sizes, parts, held = [], [], [], 0

        def segment(most):
            """The next documents of at most ``most`` ids, one document at least."""
            nonlocal docs, sizes, parts, held, number
            k = max(1, int(np.searchsorted(np.cumsum(sizes), most, side="right")))
            n = sum(sizes[:k])
            out = pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip((shard, number, docs[:k], sizes[:k], n, encode(np.concatenate(parts[:k]))), kinds, strict=True)],
                ["shard", "segment", "doc_ids", "lengths", "n_ids", "payload"])
            docs, sizes, parts, held, number = docs[k:], sizes[k:], parts[k:], held - n, number + 1
            return out

        for batch in batches:
            kinds = [pa.int32(), pa.int32(), pa.list_(batch.schema.field("doc_id").type), pa.list_(pa.int64()), pa.int64(), pa.binary()]
            ids, texts, at = batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.string()), 0
            ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0)), dtype=np.int64)
            while at < len(texts):
                done = ends[at - 1] if at else 0
                stop = max(at + 1, int(np.searchsorted(ends, done + BATCH_BYTES, side="right")))
                got, lengths = enc.encode(texts.slice(at, stop - at), end)
                cut = np.concatenate(([0], np.cumsum(lengths)))
                for k in range(stop - at):
                    while held > 2 * segment_ids:
                        yield segment(segment_ids)
                    docs.append(ids[at + k])
                    sizes.append(int(lengths[k]))
                    parts.append(got[cut[k]:cut[k + 1]])
                    held += int(lengths[k])
                at = stop
        while docs:
            yield segment(held if held <= segment_ids * 3 // 2 else min(segment_ids, held // 2 + 1))
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, segment_ids: int = SEGMENT_IDS) -> None:
    """Tokenize ``docs`` (doc_id, text) with the tokenizer file ``tokenizer`` and write them to ``path``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_write(tokenizer, end_id, segment_ids), _SCHEMA.format(kind)).write.parquet(path)


def _read(kind: str):
    def run(batches):
        for pdf in batches:
            for shard, segment, docs, lengths, payload in zip(pdf["shard"], pdf["segment"], pdf["doc_ids"], pdf["lengths"], pdf["payload"], strict=True):
                ids = decode(payload)
                cut = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
                raw = ids.tobytes()
                yield pd.DataFrame({
                    "shard": shard, "segment": segment, "doc_id": pd.array([None if pd.isna(d) else d for d in docs], dtype="Int64"),
                    "at": cut[:-1], "n_tokens": np.diff(cut),
                    "ids_crc32": [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]})
    return run


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in the files at ``path``: ids of all documents before
    it, its ids, and their crc32 as little-endian 32-bit integers."""
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    sizes = files.select("shard", "segment", "n_ids")
    before = (sizes.groupBy("shard").agg(F.sum("n_ids").alias("n"))  # one row per shard; then windows inside shards
              .select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("shard_start")))
    inside = Window.partitionBy("shard").orderBy("segment")
    starts = materialize(sizes.withColumn("in_shard", F.sum("n_ids").over(inside) - F.col("n_ids")).join(before, "shard")
                         .select("shard", "segment", (F.col("shard_start") + F.col("in_shard")).alias("seg_start")), "tok-starts")
    rows = files.select("shard", "segment", "doc_ids", "lengths", "payload").mapInPandas(
        _read(kind), f"shard int, segment int, doc_id {kind}, at long, n_tokens long, ids_crc32 long")
    return (rows.join(starts, ["shard", "segment"])
            .select("doc_id", (F.col("seg_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, ids)``: the ids themselves."""
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches):
        for pdf in batches:
            for docs, lengths, payload in zip(pdf["doc_ids"], pdf["lengths"], pdf["payload"], strict=True):
                parts = np.split(decode(payload).astype(np.int32), np.cumsum(lengths)[:-1])
                yield pd.DataFrame({"doc_id": pd.array([None if pd.isna(d) else d for d in docs], dtype="Int64"), "ids": parts})
    return files.select("doc_ids", "lengths", "payload").mapInPandas(run, f"doc_id {kind}, ids array<int>")


def new_path(spark: SparkSession, name: str) -> str:
    """A path not used before in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"

"""Packing: the token ids of all documents are concatenated and cut into sequences of a fixed length.

Two passes give every document its global place without moving a text. Pass one tokenizes each input partition where it
lies and writes the ids with their place inside the partition; the partition totals (one row per task) become offsets by
a prefix sum. Pass two reads the ids back and cuts them at multiples of the length. Sequences inside a task's run are
whole; a sequence that crosses the end of a run leaves boundary records, which meet by sequence id (at most ``length`` ids
each). Nothing but the totals and the boundary records is shuffled, so a hot source or a long document costs no more than
its own ids. All sequences but the last are full, so padding is below one sequence in the whole corpus.

Documents follow each other as the table's partitions hold them: the order is that of the written ids, fixed once pass
one has ended. Null and empty texts are the end id alone. Rows that repeat a doc_id, or have none, are documents of
their own. Extra columns are ignored. An empty table gives no sequences.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lathe.llm.common import materialize

LENGTH = 2048
BATCH_BYTES = 1 << 23
CACHED_CHUNKS = 1_000_000
CACHED_CHARS = 64

#: A word vocabulary with this pattern never joins across white space; these are the white space characters told apart here.
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORD_END = "</w>"
_BREAKS = "[\n\r\t]"
#: A run of Latin-1 letters between ASCII marks is always cut at its ends by that pattern, if no mark is an apostrophe; special
#: tokens start with "<".
_MARKS = r"[!-&(-/:;=-@\[-`{-~]*"
_PLAIN = re.compile(f"({_MARKS})([A-Za-zÀ-ÖØ-öø-ÿ]+)({_MARKS})")


def _gather(flat: np.ndarray, first: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(runs ``at`` one after another, their lengths), where run k is flat[first[k]:first[k + 1]]."""
    size = first[at + 1] - first[at]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(first[at] - (ends - size), size) + np.arange(total)], size


class WordEncoder:
    """Ids of texts by a tokenizer file of the tokenizers library, special tokens not added. With a word vocabulary texts
    are split at white space; up to ``cached`` chunks are remembered with their ids (the second half of them only if a batch
    holds them twice), and each other distinct chunk of a batch is encoded once, a plain word once however it is written
    and marked. Any other kind of file encodes whole texts."""

    def __init__(self, path: str, cached: int = CACHED_CHUNKS):
        from tokenizers import Tokenizer
        self.tok, self.cached = Tokenizer.from_file(path), cached
        spec = json.loads(self.tok.to_str())
        self.vocabulary = self.tok.get_vocab_size()
        kinds = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        self.by_words = (kinds == ["NFC", "Replace", "Lowercase"] and pre[0].get("pattern") == {"Regex": _WORD_PATTERN} and len(pre) == 2
                         and pre[1].get("type") == "ByteLevel" and not pre[1].get("add_prefix_space") and not pre[1].get("use_regex")
                         and spec["model"].get("end_of_word_suffix") == _WORD_END
                         and not any(re.search(r"\s", t["content"]) or t["content"][0] != "<" or t["lstrip"] or t["rstrip"] or t["single_word"]
                                 for t in spec["added_tokens"]))
        if self.by_words:
            # lower-case Latin-1 letters pass the normalizer and the word pattern unchanged, so they may go to the model directly
            direct = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, pre[1]]}
            self.model = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": direct, "added_tokens": []}))
            self.ends = np.array([(self.tok.id_to_token(i) or "").endswith(_WORD_END) for i in range(self.vocabulary)])
        self.clear()

    def clear(self) -> None:
        self.keys = pa.array([], pa.string())
        self.flat, self.first = np.empty(0, dtype=np.int32), np.zeros(1, dtype=np.int64)

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of lower-case letters, encoded side by side: every word's last id, and no other, ends a word."""
        if not words:
            return np.empty(0, dtype=np.int32), np.empty(0, dtype=np.int64)
        some = [" ".join(words[k:k + 20_000]) for k in range(0, len(words), 20_000)]
        ids = np.concatenate([np.array(self.model.encode_batch_fast([t], add_special_tokens=False)[0].ids, dtype=np.int32) for t in some])
        size = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
        if len(size) != len(words):
            raise ValueError("the tokenizer does not end each word with an id of its own")
        return ids, size

    def _any(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not chunks:
            return np.empty(0, dtype=np.int32), np.empty(0, dtype=np.int64)
        got = self.tok.encode(chunks, is_pretokenized=True, add_special_tokens=False)
        return np.array(got.ids, dtype=np.int32), np.bincount(np.array(got.word_ids, dtype=np.int64), minlength=len(chunks))

    def _chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the distinct ``chunks`` one after another, ids per chunk)."""
        words: dict[str, int] = {}
        marks: dict[str, int] = {"": 0}
        parts, plain, rest = [], [], []
        for k, c in enumerate(chunks):
            m = _PLAIN.fullmatch(c)
            if m:
                plain.append(k)
                parts.append((marks.setdefault(m[1], len(marks)), words.setdefault(m[2].lower(), len(words)), marks.setdefault(m[3], len(marks))))
            else:
                rest.append(k)
        pieces = [self._any(list(marks)[1:]), self._words(list(words)), self._any([chunks[k] for k in rest])]
        flat = np.concatenate([ids for ids, _ in pieces])
        first = np.concatenate(([0, 0], np.cumsum(np.concatenate([size for _, size in pieces]))))  # run 0 is the empty mark
        order = np.empty((len(chunks), 3), dtype=np.int64)  # three runs a chunk: marks, word, marks
        order[plain] = np.array(parts, dtype=np.int64).reshape(-1, 3) + [0, len(marks), 0]
        order[rest] = np.stack((len(marks) + len(words) + np.arange(len(rest)), *[np.zeros(len(rest), dtype=np.int64)] * 2), axis=1)
        ids, size = _gather(flat, first, order.ravel())
        return ids, size.reshape(-1, 3).sum(axis=1)

    def _by_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lists = pc.split_pattern(pc.replace_substring_regex(texts, _BREAKS, " "), " ")
        per_text = np.asarray(pc.list_value_length(lists)).astype(np.int64)
        flat = pc.list_flatten(lists)
        known = pc.index_in(flat, self.keys)
        if known.null_count > len(flat) / 2 and len(self.keys) > self.cached / 2:  # the texts have changed
            self.clear()
            known = pc.index_in(flat, self.keys)
        missing = pc.is_null(known)
        new = flat.filter(missing).dictionary_encode()
        codes = np.asarray(new.indices)
        ids, size = self._chunks(new.dictionary.to_pylist())
        at = np.asarray(pc.fill_null(known, 0)).astype(np.int64)
        at[np.asarray(missing)] = len(self.keys) + codes
        first = np.concatenate((self.first, len(self.flat) + np.cumsum(size)))
        all_ids = np.concatenate((self.flat, ids))
        body, sizes = _gather(all_ids, first, at)
        room = self.cached - len(self.keys)
        least = 1 if room > self.cached / 2 else 2
        keep = (np.bincount(codes, minlength=len(size)) >= least) & (np.asarray(pc.utf8_length(new.dictionary)) <= CACHED_CHARS)
        keep = np.flatnonzero(keep)[:max(0, room)]
        if len(keep):
            kept, kept_size = _gather(all_ids, first, len(self.keys) + keep)
            self.keys = pa.concat_arrays([self.keys, new.dictionary.take(pa.array(keep))])
            self.first = np.concatenate((self.first, len(self.flat) + np.cumsum(kept_size)))
            self.flat = np.concatenate((self.flat, kept))
        ends = np.concatenate(([0], np.cumsum(sizes)))
        return body, np.diff(ends[np.concatenate(([0], np.cumsum(per_text)))])

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each followed by ``end``; ids per text, ``end`` included). Null texts are empty."""
        texts = pc.fill_null(texts, "")
        if self.by_words:
            body, sizes = self._by_words(texts)
        else:
            each = [e.ids for e in self.tok.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            sizes = np.array([len(x) for x in each], dtype=np.int64)
            body = np.array([i for x in each for i in x], dtype=np.int32)
        lengths = sizes + 1
        stop = np.cumsum(lengths)
        out = np.full(int(stop[-1]) if len(stop) else 0, end, dtype=np.int32)
        inside = np.ones(len(out), dtype=bool)
        inside[stop - 1] = False
        out[inside] = body
        return out, lengths


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def id_type(tokenizer: str) -> str:
    """Little-endian type of the written ids: two bytes where the vocabulary allows."""
    from tokenizers import Tokenizer
    return "<u2" if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else "<u4"


def _packed(ids: np.ndarray, ends: np.ndarray, kind: str) -> pa.Array:
    """Binary values that hold the runs of ``ids`` up to each of ``ends``."""
    raw = np.ascontiguousarray(ids.astype(kind))
    offsets = np.concatenate(([0], ends)) * raw.itemsize
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw)])


def _unpacked(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(all ids of a binary column one after another, ids per value)."""
    size = np.asarray(pc.binary_length(column)).astype(np.int64) // np.dtype(kind).itemsize
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, dtype=kind), size


def _tokenize(path: str, end: int, kind: str):
    def run(batches):
        enc, part, at = _encoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column("text").cast(pa.string())
            done = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0)), dtype=np.int64)
            row = 0
            while row < len(texts):
                before = done[row - 1] if row else 0
                stop = max(row + 1, int(np.searchsorted(done, before + BATCH_BYTES, side="right")))
                ids, n = enc.encode(texts.slice(row, stop - row), end)
                ends = np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part, dtype=np.int32)), pa.array(at + ends - n), batch.column("doc_id").slice(row, stop - row),
                     pa.array(n), _packed(ids, ends, kind)], ["part", "at", "doc_id", "n", "ids"])
                at += int(ends[-1])
                row = stop
    return run


def token_runs(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Pass one: ``(part, at, doc_id, n, ids)``, written to the shared folder. ``at`` counts the ids before the document in
    its partition; ``ids`` holds its ``n`` ids, ``end_id`` last, as numbers of ``id_type``."""
    kind, ids = docs.schema["doc_id"].dataType.simpleString(), id_type(tokenizer)
    if not 0 <= end_id < 1 << 8 * np.dtype(ids).itemsize:
        raise ValueError(f"the end id {end_id} does not fit the type of the ids, {ids}")
    return materialize(docs.select("doc_id", F.col("text").cast("string").alias("text"))
                       .mapInArrow(_tokenize(tokenizer, end_id, ids), f"part int, at long, doc_id {kind}, n long, ids binary"), "pack-tokens")


def _cut(length: int, kind: str, id_kind: pa.DataType):
    """Whole sequences, and the rest of each contiguous run as boundary records, from rows ``(g, doc_id, ids)`` where g
    is the global place of the document's first id."""
    piece = pa.struct([("doc_id", id_kind), ("start", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64())])

    def rows(g, start, doc, total, ids):
        """Arrow rows of the run whose pieces of documents lie at ``g`` (their ids before them ``start``)."""
        a, b = int(g[0]), int(g[0]) + len(ids)
        edges = np.arange(a // length * length, b, length)
        edges[0] = a
        cuts = np.union1d(g, edges)
        own = np.searchsorted(g, cuts, side="right") - 1
        size = np.diff(np.concatenate((cuts, [b])))
        pieces = pa.StructArray.from_arrays([doc.take(pa.array(own)), pa.array(cuts - g[own] + start[own]), pa.array(cuts % length), pa.array(size),
                                             pa.array(total[own])], fields=list(piece))
        by_edge = np.concatenate((np.searchsorted(cuts, edges), [len(cuts)])).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(edges // length), pa.array(edges % length), _packed(ids, np.concatenate((edges[1:] - a, [b - a])), kind),
             pa.ListArray.from_arrays(pa.array(by_edge), pieces)], ["sequence_id", "first", "ids", "pieces"])

    def run(batches):
        held = None  # the unfinished sequence at the end of the run so far: (g, start, doc, total, ids)
        for batch in batches:
            values, n = _unpacked(batch.column("ids"), kind)
            g, doc = np.asarray(batch.column("g")).astype(np.int64), batch.column("doc_id")
            if not len(g):
                continue
            ends = np.cumsum(n)
            breaks = np.concatenate(([0], np.flatnonzero(g[1:] != g[:-1] + n[:-1]) + 1, [len(g)]))
            for lo, hi in zip(breaks[:-1], breaks[1:], strict=True):
                now = (g[lo:hi], np.zeros(hi - lo, dtype=np.int64), doc.slice(lo, hi - lo), n[lo:hi], values[ends[lo] - n[lo]:ends[hi - 1]])
                if held is not None:
                    if int(held[0][0]) + len(held[4]) == int(now[0][0]):
                        now = tuple(pa.concat_arrays([x, y]) if isinstance(x, pa.Array) else np.concatenate((x, y)) for x, y in zip(held, now, strict=True))
                    else:
                        yield rows(*held)
                    held = None
                a, stop = int(now[0][0]), int(now[0][0]) + len(now[4])
                whole = stop // length * length
                if whole > a:
                    last = int(np.searchsorted(now[0], whole, side="left"))  # documents that start before the last edge
                    yield rows(*(x[:last] if not isinstance(x, pa.Array) else x.slice(0, last) for x in now[:4]), now[4][:whole - a])
                    if whole < stop:
                        own = last - 1 if last == len(now[0]) or int(now[0][last]) > whole else last
                        gg, ss = now[0][own:].copy(), now[1][own:].copy()
                        ss[0] += max(0, whole - int(gg[0]))
                        gg[0] = max(int(gg[0]), whole)
                        held = gg, ss, now[2].slice(own), now[3][own:], now[4][whole - a:].copy()
                else:
                    held = now
        if held is not None:
            yield rows(*held)
    return run


def _cut_of(length: int, kind: str):
    def run(batches):
        first = next(batches, None)
        if first is None:
            return

        def all_():
            yield first
            yield from batches
        yield from _cut(length, kind, first.schema.field("doc_id").type)(all_())
    return run


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH) -> DataFrame:
    """``(sequence_id, ids, pieces)``: the sequences in order, every one but the last ``length`` ids long, as numbers of
    ``id_type(tokenizer)`` (``id_arrays`` gives arrays). ``pieces`` lists ``(doc_id, start, offset, length, doc_tokens)`` by
    offset: the part of a document from its id ``start`` on lies at ``offset`` of the sequence."""
    runs = token_runs(docs, tokenizer, end_id)
    # one row per task of pass one: a broadcast of 16 bytes a task
    totals = runs.groupBy("part").agg(F.max(F.col("at") + F.col("n")).alias("n"))
    before = materialize(totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before")), "pack-offsets")
    kind, ids = runs.schema["doc_id"].dataType.simpleString(), id_type(tokenizer)
    cut = materialize(runs.join(F.broadcast(before), "part").select((F.col("before") + F.col("at")).alias("g"), "doc_id", "ids")
                      .mapInArrow(_cut_of(length, ids), "sequence_id long, first long, ids binary, pieces array<struct<"
                                  f"doc_id:{kind},start:long,offset:long,length:long,doc_tokens:long>>"), "pack-cut")
    full = F.length("ids") == length * np.dtype(ids).itemsize
    parts = F.sort_array(F.collect_list(F.struct("first", "ids", "pieces")))  # at most ``length`` ids in all
    joined = (cut.where(~full).groupBy("sequence_id").agg(parts.alias("parts"))
              .select("sequence_id", F.aggregate("parts", F.lit(b""), lambda all_, p: F.concat(all_, p["ids"])).alias("ids"),
                      F.flatten(F.col("parts.pieces")).alias("pieces")))
    return cut.where(full).select("sequence_id", "ids", "pieces").union(joined)


def id_arrays(sequences: DataFrame, tokenizer: str) -> DataFrame:
    """``sequences`` with ``ids`` as arrays of whole numbers."""
    kind = id_type(tokenizer)

    def run(batches):
        for batch in batches:
            ids, size = _unpacked(batch.column("ids"), kind)
            offsets = pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32))
            yield batch.set_column(1, "ids", pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))))
    pieces = sequences.schema["pieces"].dataType.simpleString()
    return sequences.select("sequence_id", "ids", "pieces").mapInArrow(run, f"sequence_id long, ids array<int>, pieces {pieces}")


def padded(arrays: DataFrame, pad_id: int, length: int = LENGTH) -> DataFrame:
    """The frame of ``id_arrays`` with ids filled up to ``length`` by ``pad_id``; a sequence whose own length is a power of two
    stays."""
    n = F.size("ids")
    short = (n < length) & (n.bitwiseAND(n - 1) != 0)
    return arrays.withColumn("ids", F.when(short, F.concat("ids", F.array_repeat(F.lit(pad_id), F.lit(length) - n))).otherwise(F.col("ids")))


def _digest(kind: str):
    def run(batches):
        for batch in batches:
            pieces = batch.column("pieces")
            ids, size = _unpacked(batch.column("ids"), kind)
            ids = np.ascontiguousarray(ids.astype("<u4"))
            starts = np.cumsum(size) - size
            sequence = np.asarray(pc.list_parent_indices(pieces)).astype(np.int64)
            flat = pieces.flatten()
            at = starts[sequence] + np.asarray(flat.field("offset"))
            stop = at + np.asarray(flat.field("length"))
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(at.tolist(), stop.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [flat.field("doc_id"), flat.field("start"), flat.field("length"), pa.array(crc, pa.int64()), flat.field("doc_tokens"),
                 pa.array(np.asarray(batch.column("sequence_id"))[sequence]), flat.field("offset")],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
    return run


def piece_digests(sequences: DataFrame, tokenizer: str) -> DataFrame:
    """One row per piece, from the ids in the sequences: ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset)``; the crc32 is of the ids as little-endian 32-bit integers."""
    kind = sequences.schema["pieces"].dataType.elementType["doc_id"].dataType.simpleString()
    return sequences.select("sequence_id", "ids", "pieces").mapInArrow(
        _digest(id_type(tokenizer)), f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")

"""Vectorised word-shingle hashing over a buffer of many documents (numpy, inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RNG = np.random.default_rng(20240611)
_ODD = np.uint64(1)
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = int(_RNG.integers(0, 2**62, dtype=np.uint64)) * 8 + 5
_INV = pow(_BASE, -1, 2**64)
_MULT = _RNG.integers(0, 2**64, 64, dtype=np.uint64) | _ODD
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
#: Bytes of text handled at once; one longer document is handled alone.
CHUNK = 1 << 18


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


_powers: dict[int, np.ndarray] = {}


def _pow(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK * 2)
        p = np.empty(size, dtype=np.uint64)
        p[0] = 1
        done = 1
        while done < size:  # doubling: p[done:2*done] = p[:done] * base**done
            step = min(done, size - done)
            p[done:done + step] = p[:step] * np.uint64(pow(base, done, 2**64))
            done += step
        _powers[base] = have = p
    return have[:n]


def chunks(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, encoded texts) groups of about CHUNK bytes, so memory does not follow the batch size."""
    at, held, size = 0, [], 0
    for i, t in enumerate(texts):
        b = t.encode("utf-8") if t else b""
        if held and size + len(b) > CHUNK:
            yield at, held
            at, held, size = i, [], 0
        held.append(b)
        size += len(b)
    if held:
        yield at, held


def arrow_chunks(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """(doc_ids, encoded texts) of runs of rows with about CHUNK bytes of text; nulls are empty."""
    ids, text = batch.column("doc_id"), batch.column("text")
    size = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(text):
        stop = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + CHUNK, side="right")))
        yield ids.slice(at, stop - at), [x or b"" for x in text.slice(at, stop - at).cast(pa.binary()).to_pylist()]
        at = stop


def word_hashes(docs: list[bytes], fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and document number of every word (run of non-space bytes), in order."""
    buf = np.frombuffer(b" ".join([*docs, b""]), dtype=np.uint8)
    if not len(buf):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    space = _SPACE[buf]
    edge = np.diff(np.concatenate(([True], space)).view(np.int8))
    start = np.flatnonzero(edge == -1)
    end = np.flatnonzero(edge == 1)
    if len(end) < len(start):
        end = np.append(end, len(buf))
    prefix = np.empty(len(buf) + 1, dtype=np.uint64)
    prefix[0] = 0
    np.cumsum(_BYTE[_FOLD[buf] if fold else buf] * _pow(_BASE, len(buf)), out=prefix[1:])
    h = (prefix[end] - prefix[start]) * _pow(_INV, len(buf))[start]
    ends = np.cumsum([len(d) + 1 for d in docs])
    return mix(h + (end - start).astype(np.uint64)), np.searchsorted(ends, start, side="right")


def shingle_sets(docs: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, sorted by (document, hash): values and their documents. A document
    with 1 to ``size`` - 1 words has one shingle, its whole word sequence; one without words has none."""
    w, d = word_hashes(docs)
    n = len(w)
    if not n:
        return w, d
    count = np.bincount(d, minlength=len(docs))
    if n >= size:
        h = np.zeros(n - size + 1, dtype=np.uint64)
        for k in range(size):
            h += w[k:n - size + 1 + k] * _MULT[k]
        ok = d[:n - size + 1] == d[size - 1:]
        h, hd = mix(h[ok]), d[:n - size + 1][ok]
    else:
        h, hd = np.empty(0, np.uint64), np.empty(0, np.int64)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        first = np.concatenate(([0], np.cumsum(count)))[short]
        s = count[short].astype(np.uint64) * _MULT[size]
        for k in range(size - 1):
            has = count[short] > k
            s[has] += w[first[has] + k] * _MULT[size + 1 + k]
        h, hd = np.concatenate((h, mix(s))), np.concatenate((hd, short))
    order = np.lexsort((h, hd))
    h, hd = h[order], hd[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (hd[1:] != hd[:-1])
    return h[new], hd[new]

"""Quality classifier on supervised subword embeddings.

A document is the average of learned vectors of its hashed features: words, word pairs (a word that repeats the one before
it is one common feature), and character n-grams of 3 and 4 bytes that do not run across white space (its edges count as
word ends). A softmax over two classes sits on top; both are trained by stochastic gradient descent in numpy on a bounded
sample of labelled rows (``fit_rows``, chosen by hash of doc_id). Because the output is linear in the average, scoring
needs one number per feature; every feature of the whole text counts.

Null or empty texts have no features: their average is the zero vector and the score is the softmax of the bias. Rows that
repeat are each scored. A null or unknown label is no training row; without labelled rows of both classes, all scores are
the share of label 1 among those there are (0.5 without any). Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathe.llm.common import fresh
from lathe.llm.shingles import _SPACE, chunks, mix, word_hashes

BITS = 18
DIM = 16
FIT_ROWS = 6_000
EPOCHS = 5
RATE = 2.0
_SAME = np.uint64(0x5A5A5A5A5A5A5A5A)


def features(docs: list[bytes], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document) of every feature of the documents."""
    shift = np.uint64(64 - bits)
    w, d = word_hashes(docs, fold=False)
    ids, owner = [(w >> shift).astype(np.int32)], [d]
    if len(w) > 1:
        ok = d[1:] == d[:-1]
        pair = mix(w[:-1] * np.uint64(0x9E3779B97F4A7C15) + w[1:])
        pair[w[1:] == w[:-1]] = _SAME
        ids.append((pair[ok] >> shift).astype(np.int32))
        owner.append(d[1:][ok])
    buf = np.frombuffer(b" " + b" ".join([*docs, b""]), dtype=np.uint8)
    ends = np.cumsum([len(x) + 1 for x in docs])
    space = _SPACE[buf]
    buf = np.where(space, np.uint8(32), buf)
    for n in (3, 4):
        if len(buf) < n:
            continue
        last = len(buf) - n + 1
        code = np.full(last, n, dtype=np.uint32)
        for k in range(n):
            code = code * np.uint32(0x01000193) ^ buf[k:last + k]
        inner = ~space[1:last + 1]
        for k in range(2, n - 1):
            inner &= ~space[k:last + k]
        at = np.flatnonzero(inner)
        code = code[at].astype(np.uint32) * np.uint32(0x9E3779B1)
        code ^= code >> np.uint32(15)
        ids.append((code * np.uint32(0x85EBCA6B) >> np.uint32(32 - bits)).astype(np.int32))
        owner.append(np.searchsorted(ends, at, side="right"))
    return np.concatenate(ids), np.concatenate(owner)


def _counted(texts: list[str], bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(distinct buckets, shares) per text."""
    out = []
    for _, docs in chunks(texts):
        ids, owner = features(docs, bits)
        order = np.argsort(owner, kind="stable")
        ids, cut = ids[order], np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(docs)))))
        for i in range(len(docs)):
            u, c = np.unique(ids[cut[i]:cut[i + 1]], return_counts=True)
            out.append((u, (c / max(1, c.sum())).astype(np.float32)))
    return out


def train(texts: list[str], labels: np.ndarray, bits: int = BITS, dim: int = DIM, epochs: int = EPOCHS, rate: float = RATE,
          seed: int = 11) -> tuple[np.ndarray, float]:
    """(score of each bucket, bias): logit of class 1 against class 0 is the features' mean score plus the bias."""
    labels = np.asarray(labels, dtype=np.int64)
    share = labels.mean() if len(labels) else 0.5
    if share in (0.0, 1.0) or not len(labels):
        return np.zeros(2**bits, np.float32), _logit(share)
    rng = np.random.default_rng(seed)
    emb = ((rng.random((2**bits, dim)) - 0.5) / dim).astype(np.float32)
    out, bias = np.zeros((2, dim), np.float32), np.zeros(2, np.float32)
    rows = _counted(texts, bits)
    total, done = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            lr = rate * (1 - done / total)
            done += 1
            ids, share_of = rows[i]
            hidden = share_of @ emb[ids]
            z = out @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = p @ out
            out -= lr * np.outer(p, hidden)
            bias -= lr * 0.1 * p
            if len(ids):  # a document's features move together, by their share of the largest
                emb[ids] -= np.outer(share_of * (lr / share_of.max()), back)
    return emb @ (out[1] - out[0]), float(bias[1] - bias[0])


def _logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return float(np.log(p / (1 - p)))


def score_texts(texts: list[str | None], table: np.ndarray, bias: float) -> np.ndarray:
    bits = int(len(table)).bit_length() - 1
    out = np.empty(len(texts))
    for at, docs in chunks(texts):
        ids, owner = features(docs, bits)
        n = np.bincount(owner, minlength=len(docs))
        total = np.bincount(owner, weights=table[ids], minlength=len(docs))
        out[at:at + len(docs)] = total / np.maximum(n, 1) + bias
    return 1 / (1 + np.exp(-np.clip(out, -60, 60)))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, fit_rows: int = FIT_ROWS) -> pd.DataFrame:
    """``(text, label)`` of about ``fit_rows`` labelled rows (all, if there are fewer), chosen by hash of doc_id: the same
    rows whatever the partitioning. ``allowed`` is a condition on doc_id."""
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).alias("label")).where(allowed).distinct()
    n = known.count()
    share = min(1.0, fit_rows / max(1, n))
    picked = known.where(F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 62)) < int(share * (1 << 62)))
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # at most about fit_rows ids
    return rows.toPandas().sort_values(["doc_id", "label"])


def score_documents(docs: DataFrame, model: tuple[np.ndarray, float], keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """The columns ``keep`` (all by default) of ``docs`` and the score as ``name``; an input column of that name is replaced."""
    keep = [c for c in (keep or docs.columns) if c != name]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(score_texts(text.tolist(), *shared.value))
    return docs.select(*keep, score("text").alias(name))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", allowed: Column | None = None, fit_rows: int = FIT_ROWS) -> tuple[np.ndarray, float]:
    rows = training_rows(docs, labels, label, F.lit(True) if allowed is None else allowed, fit_rows)
    return train(rows["text"].tolist(), rows["label"].to_numpy())


def keep_good(docs: DataFrame, model: tuple[np.ndarray, float], least: float = 0.5) -> DataFrame:
    """``docs`` without the documents that score below ``least``; all columns stay."""
    name = fresh(docs, "_quality")
    return score_documents(docs, model, name=name).where(F.col(name) >= least).select(*docs.columns)

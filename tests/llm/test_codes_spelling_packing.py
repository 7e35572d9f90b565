"""Vector codes, spelling variants and packing against brute force, and on nulls, empty and long texts, ties, repeats, clashing columns."""

import collections
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lathe.llm import packing, spelling, vector_codes
from lathe.llm import queries as Q
from lathe.llm.common import table

SMALL = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path(Q.WORD_TOKENIZER)
BYTES = public_tokenizers.path("byte_bpe_50k.json")


# 11 vector codes

@pytest.mark.parametrize("kind", ["spread", "clusters", "ties", "far"])
def test_orchard_finds_the_nearest_entry_and_the_lower_index(kind):
    rng = np.random.default_rng(5)
    if kind == "spread":
        entries, x = rng.integers(-500, 500, (256, 16)), rng.integers(-600, 600, (5000, 16))
    elif kind == "clusters":
        centres = rng.integers(-5000, 5000, (20, 8))
        entries = centres[rng.integers(0, 20, 200)] + rng.integers(-30, 30, (200, 8))
        x = centres[rng.integers(0, 20, 3000)] + rng.integers(-60, 60, (3000, 8))
    elif kind == "ties":
        entries, x = rng.integers(-2, 2, (64, 3)), rng.integers(-3, 3, (2000, 3))
    else:
        entries, x = rng.integers(-(1 << 26), 1 << 26, (40, 16)), rng.integers(-(1 << 26), 1 << 26, (500, 16))
    d = ((x[:, None, :] - entries[None]) ** 2).sum(axis=2)
    at, best = vector_codes.Orchard(entries).nearest(x)
    assert (at == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()


def test_orchard_measures_few_entries_in_clustered_codebooks(monkeypatch):
    rng = np.random.default_rng(6)
    centres = rng.integers(-5000, 5000, (32, 8))
    entries = np.repeat(centres, 8, axis=0) + rng.integers(-30, 30, (256, 8))
    x = centres[rng.integers(0, 32, 2000)] + rng.integers(-30, 30, (2000, 8))
    search, measured = vector_codes.Orchard(entries), []
    plain = vector_codes.squared
    monkeypatch.setattr(vector_codes, "squared", lambda a, b: measured.append(len(a)) or plain(a, b))
    search.nearest(x)
    assert sum(measured) < 2000 * 256 / 3


def brute_codes(rows, parts=4, entries=256, rounds=4):
    """(code, error) by row from (vec_id, vector) rows in the order of ids."""
    x = np.array([[math.floor(1024 * float(np.float32(c))) for c in v] for _, v in rows], dtype=np.int64)
    out, total, books = [], 0, []
    for part in np.split(x, parts, axis=1):
        book = part[:entries].copy()
        for step in range(rounds + 1):
            d = ((part[:, None, :] - book[None]) ** 2).sum(axis=2)
            at = d.argmin(axis=1)
            if step < rounds:
                for k in set(at.tolist()):
                    book[k] = [math.floor(int(s) / int((at == k).sum())) for s in part[at == k].sum(axis=0)]
        out.append(at)
        total = total + d.min(axis=1)
        books.append(book)
    return ["".join(f"{v:02x}" for v in r) for r in np.stack(out, axis=1)], total.tolist(), books


def test_codes_equal_brute_force_whatever_the_partitions(spark):
    vectors = table(spark, SMALL, "embeddings")
    rows = sorted((r.vec_id, r.embedding, r.label) for r in vectors.collect())
    code, error, books = brute_codes([r[:2] for r in rows])
    by_label = collections.Counter()
    for (_, _, label), e in zip(rows, error):
        by_label[label] += e
    want = {(r[0], c, e, by_label[r[2]], vector_codes.codebook_hash(books)) for r, c, e in zip(rows, code, error)}
    for parts in (1, 7):
        got = vector_codes.code_digests(*vector_codes.compress(vectors.repartition(parts)))
        assert {tuple(r) for r in got.collect()} == want


def test_codes_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 3.0, 4.0], 1), (2, [1.0, 2.0, 3.0, 4.0], None), (2, [5.0, -2.0, 3.0, 0.5], None), (None, [0.0, 0.0, 0.0, 0.0], 1), (3, None, 1),
            (4, [1.0, nan, 0.0, 0.0], 1), (5, [1.0, inf, 0.0, 0.0], 1), (6, [1.0, None, 0.0, 0.0], 1), (7, [1.0, 2.0, 3.0], 9), (8, [], 9),
            (9, [3e38, -3e38, 0.0, 1.0], 2), (10, [1.0] * 8, 2)]
    full = [(*r, 0, "x", 1, "c", 5) for r in rows]
    df = spark.createDataFrame(full, "vec_id long, embedding array<float>, label int, dim int, code string, part int, codes string, place int")
    got = {(r.vec_id, r.code): r for r in vector_codes.code_digests(*vector_codes.compress(df)).collect()}
    ids = sorted((k[0] is None, k[0] or 0) for k in got)
    assert [i for n, i in ids if not n] == [1, 2, 2, 7, 8, 9, 10] and sum(n for n, _ in ids) == 1
    assert got[7, None].error is None and got[8, None].codebooks_sha256 is None and got[7, None].label_error is None
    same = [r for r in got.values() if r.vec_id in (1, 2) and r.code == got[next(k for k in got if k[0] == 1)].code]
    assert {r.vec_id for r in same} == {1, 2}
    assert len({r.codebooks_sha256 for r in got.values()}) == 3  # two lengths, and none
    assert vector_codes.code_digests(*vector_codes.compress(df.where("vec_id > 99"))).count() == 0
    assert vector_codes.code_digests(*vector_codes.compress(df.drop("label").where("vec_id = 1"))).first().error == 0


def test_a_common_label_sums_exactly_and_decoding_is_near(spark):
    vectors = table(spark, SMALL, "embeddings").withColumn("label", F.when(F.col("vec_id") % 2 == 0, 7))
    codes, books = vector_codes.compress(vectors)
    got = vector_codes.code_digests(codes, books).collect()
    for even in (True, False):
        part = [r for r in got if (r.vec_id % 2 == 0) == even]
        assert {r.label_error for r in part} == {sum(r.error for r in part)}
    real = {r.vec_id: np.floor(1024 * np.array(r.embedding, dtype=np.float64)) for r in vectors.collect()}
    for r in vector_codes.decode(codes, books).collect():
        near = np.floor(np.array(r.approximation) * 1024)
        assert ((near - real[r.vec_id]) ** 2).sum() == r.error


# 12 spelling

def drawn(rows, draw=97):
    out = collections.Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % draw == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            out[w] += 1
    return out


def brute_groups(n):
    """{word: (n_near, form, root)} by trying every edit."""
    letters = sorted({c for w in n for c in w})

    def near(w):
        cuts = [(w[:i], w[i:]) for i in range(len(w) + 1)]
        made = {a + c + b for a, b in cuts for c in letters} | {a + b[1:] for a, b in cuts if b} | {a + c + b[1:] for a, b in cuts if b for c in letters}
        return (made - {w}) & n.keys()
    form, count = {}, {}
    for w in n:
        all_ = near(w)
        best = min(all_, key=lambda x: (-n[x], x), default=None)
        count[w], form[w] = len(all_), best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {w: (count[w], form[w], root(w)) for w in n}


def groups(spark, n):
    df = spark.createDataFrame([(w, k, 1, "x", "p") for w, k in n.items()] or [], "word string, n long, place int, edit string, prefix string")
    return {r.word: (r.n_near, r.form, r.root) for r in spelling.spelling_groups(df).collect()}


def test_spelling_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    n = {w: k for w, k in drawn(rows).items() if len(w) >= 5 and k >= 3}
    want = brute_groups(n)
    got = Q.QUERIES["op12_permuterm_spelling"](spark, SMALL).collect()
    assert {(r.word, r.n, r.n_near, r.form, r.root, r.form_n) for r in got} == {(w, n[w], *want[w][:2], want[w][2], n.get(want[w][1])) for w in n}
    assert any(f for _, f, _ in want.values())


def test_spelling_random_words_with_repeated_letters_and_the_mark(spark):
    rng = random.Random(3)
    for letters in ("ab", "ab$", "aé日$"):
        n = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 7))): rng.randint(1, 40) for _ in range(250)}
        assert groups(spark, n) == brute_groups(n)


def test_spelling_long_chains_ties_and_a_word_with_thousands_of_neighbours(spark):
    chain = {"a" * (5 + i): 2 ** i for i in range(40)}
    assert groups(spark, chain)["aaaaa"] == (1, "aaaaaa", "a" * 44)
    tie = {"abcde": 1, "abcdf": 9, "abcdd": 9, "zbcde": 9}
    assert groups(spark, tie)["abcde"] == (3, "abcdd", "abcdd")
    star = {"common": 10_000} | {"common"[:i] + chr(c) + "common"[i + 1:]: 1 for i in range(6) for c in range(0x4E00, 0x4E00 + 400)}
    got = groups(spark, star)
    assert got["common"] == (2400, None, "common") and got["一ommon"] == (400, "common", "common")


def test_spelling_edge_rows(spark):
    rows = [(1, "Colour colour, COLOUR! color"), (1, "Colour colour, COLOUR! color"), (None, "colour Étude"), (2, None), (3, ""), (4, "x" * 100_000), (5, "İstan 123 日本")]
    df = spark.createDataFrame([(*r, "w", 1, 2, "e") for r in rows], "doc_id long, text string, word string, n long, place int, edit string")
    got = collections.Counter(r.word for r in spelling.runs(df).collect())
    assert got == drawn(rows)
    assert "Étude" in got and got["x" * 100_000] == 1  # only A-Z are lower-cased
    assert collections.Counter(r.word for r in spelling.runs(df, draw=None).collect())["colour"] == 7
    assert groups(spark, {}) == {} and groups(spark, {"": 4, "a": 1}) == {"": (0, None, ""), "a": (0, None, "a")}
    nulls = spark.createDataFrame([(None, 3), ("abc", 3)], "word string, n long")
    assert [r.word for r in spelling.spelling_groups(nulls).collect()] == ["abc"]


# 13 packing

TEXTS = ["", None, "Hello, world!", "don't stop -- we'll (\"quoted\") see...", "A\tB\nC\r\n  D", "x'S 'tis 'em ''s", "café café H̱i ẖi", "a\x1cb a\x85b a​b a b",
         "<|endoftext|> in <|startoftext|>text <|ENDOFTEXT|>", "日本語の文 Жук ΣισΥΣ", "0641917ea4e9feb9 12.5 3,000", "end.\"Next\" (a)b [c] {d}", "!!! ??? ...", "w" * 5000, "\U0001f600 ok퟿",
         "≠ not.equal a≠b", " ".join(f"word{i}, Zulu{i % 7}." for i in range(6000))]


@pytest.mark.parametrize("path", [WORDS, BYTES])
@pytest.mark.parametrize("cached", [400_000, 20])
def test_word_encoder_equals_the_library(path, cached):
    tok, enc = Tokenizer.from_file(path), packing.WordEncoder(path, cached)
    assert enc.by_words == (path == WORDS)
    rng = random.Random(4)
    marks = " .,;:!?'\"()-\n\t̸́<|>"
    made = ["".join(rng.choice("abTSdmé " + marks) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    for texts in (TEXTS, made, list(reversed(TEXTS)), made[::3]):
        ids, n = enc.encode(pa.array(texts, pa.string()), 1)
        want = [tok.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
        assert n.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def unpack(sequences, length):
    """Check every sequence's pieces; ids of the documents by (doc_id, number of ids), in any order."""
    rows = sorted(sequences.collect(), key=lambda r: r.sequence_id)
    docs = collections.defaultdict(list)
    for k, r in enumerate(rows):
        assert r.sequence_id == k and (len(r.ids) == length or k == len(rows) - 1)
        at = 0
        for p in r.pieces:
            assert p.offset == at and p.length > 0
            docs[p.doc_id, p.doc_tokens].append((p.start, r.ids[at:at + p.length]))
            at += p.length
        assert at == len(r.ids)
    return docs


@pytest.mark.parametrize("parts,length", [(1, 64), (5, 64), (40, 2048), (3, 1)])
def test_packs_hold_every_document_once(spark, parts, length):
    texts = TEXTS if length > 1 else TEXTS[:12]
    df = spark.createDataFrame([(i, t, 5, "x", 3) for i, t in enumerate(texts)], "doc_id long, text string, at long, ids string, part int")
    docs = unpack(packing.id_arrays(packing.pack_documents(df.repartition(parts), WORDS, 1, length), WORDS), length)
    tok = Tokenizer.from_file(WORDS)
    assert sorted(d for d, _ in docs) == list(range(len(texts)))
    for (d, n), pieces in docs.items():
        ids = tok.encode(texts[d] or "", add_special_tokens=False).ids + [1]
        pieces.sort()
        assert n == len(ids) and [s for s, _ in pieces] == np.cumsum([0] + [len(x) for _, x in pieces])[:-1].tolist()
        assert [i for _, x in pieces for i in x] == ids


def test_packs_with_repeated_and_missing_ids_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "one two"), (1, "one two"), (None, "three"), (None, None)], "doc_id long, text string")
    rows = packing.pack_documents(df, WORDS, 1, 8).collect()
    assert sorted((p.doc_id or 0, p.length) for r in rows for p in r.pieces) == [(0, 1), (0, 2), (1, 3), (1, 3)]
    assert packing.pack_documents(df.where("doc_id > 5"), WORDS, 1, 8).count() == 0
    assert packing.piece_digests(packing.pack_documents(df.where("doc_id > 5"), WORDS, 1, 8), WORDS).count() == 0
    named = spark.createDataFrame([("a", "one"), ("b", "two")], "doc_id string, text string")
    assert sorted(r.doc_id for r in packing.piece_digests(packing.pack_documents(named, WORDS, 1, 8), WORDS).collect()) == ["a", "b"]


def test_padding_stops_at_a_power_of_two(spark):
    rows = [(0, list(range(8))), (1, [1, 2, 3]), (2, [1, 2, 3, 4]), (3, [5])]
    df = spark.createDataFrame([(i, x, []) for i, x in rows], "sequence_id long, ids array<int>, pieces array<struct<offset:long>>")
    got = {r.sequence_id: r.ids for r in packing.padded(df, 0, 8).collect()}
    assert got == {0: list(range(8)), 1: [1, 2, 3, 0, 0, 0, 0, 0], 2: [1, 2, 3, 4], 3: [5]}


def test_packing_query_equals_the_library(spark):
    tok, texts = Tokenizer.from_file(WORDS), {r.doc_id: r.text or "" for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()}
    got = Q.QUERIES["op13_concatenate_and_cut"](spark, SMALL).collect()
    ids = {d: np.array(tok.encode(t, add_special_tokens=False).ids + [1], dtype="<u4") for d, t in texts.items()}
    parts = collections.defaultdict(list)
    for r in got:
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length])
        parts[r.doc_id].append((r.start, r.length))
    for d, p in parts.items():
        assert [s for s, _ in sorted(p)] + [len(ids[d])] == np.cumsum([0] + [n for _, n in sorted(p)]).tolist()
    total = sum(len(x) for x in ids.values())
    assert parts.keys() == ids.keys() and max(r.sequence_id for r in got) == (total - 1) // 2048
    assert {(r.sequence_id, r.offset) for r in got} >= {(k, 0) for k in range((total - 1) // 2048 + 1)}

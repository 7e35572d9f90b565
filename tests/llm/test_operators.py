"""The corpus operators against brute force, and on nulls, empty and long texts, ties, repeats, clashing columns."""

import hashlib
import re
import zlib

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from lathe.llm import queries as Q
from lathe.llm import decontaminate, embedding_dedup, maglev, minmax_dedup, mixture, pii, quality, range_coder, rollups, token_files, url_rules
from lathe.llm.common import connected_components, table
from lathe.llm.range_coder import decode, encode

SMALL = "/root/testdata/sf0.001"
SPACE = r"[ \t-\r]+"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash with the operators' own."""
    def make(rows):
        full = [(i, t, "en", "src0", len(t or ""), 1, "x", 0.5, 7) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, n long, slot string, score double, h long")
    return make


@pytest.fixture(scope="session")
def small(spark):
    """(query name) -> rows of the query on the smallest tables."""
    held = {}

    def run(name):
        if name not in held:
            held[name] = Q.QUERIES[name](spark, "/root/testdata/sf0.001").collect()
        return held[name]
    return run


def lower(t):
    return t.translate({c: c + 32 for c in range(65, 91)})


def split(t):
    return [w for w in re.split(SPACE, lower(t or "")) if w]


# 1 sharding

def test_maglev_fill_matches_turn_taking_and_moves_little():
    names = [f"s{i}" for i in range(7)]
    prefs = {}
    for s in names:
        off, skip = maglev.preference(s, 101)
        prefs[s] = [(off + j * skip) % 101 for j in range(101)]
    want, turn = {}, 0
    while len(want) < 101:
        s = turn % 7
        want[next(p for p in prefs[names[s]] if p not in want)] = s
        turn += 1
    got = maglev.fill_table(names, 101)
    assert got == [want[i] for i in range(101)]
    counts = np.bincount(got)
    assert counts.max() - counts.min() <= 1
    big = maglev.fill_table(names, 65537)
    less = maglev.fill_table(names[:-1], 65537)
    assert sum(a != b for a, b in zip(big, less) if a != 6) < 0.1 * 65537
    with pytest.raises(ValueError):
        maglev.fill_table(names, 100)


def test_maglev_places_by_hash_nulls_spread_and_clashes_replaced(spark, docs_of):
    shards = [f"s{i}" for i in range(5)]
    out = maglev.assign_shards(docs_of([(i, "a") for i in range(50)] + [(None, f"t{i}") for i in range(40)] + [(3, "again")]), "doc_id", shards).collect()
    owner = maglev.fill_table(shards)
    for r in out:
        if r.doc_id is not None:
            h = xxhash.xxh64(int(r.doc_id).to_bytes(8, "little"), seed=42).intdigest()
            h = h - 2**64 if h >= 2**63 else h
            assert r.slot == h % maglev.SLOTS and r.shard == shards[owner[r.slot]]
    assert len(out) == 91 and len({r.shard for r in out if r.doc_id is None}) == 5
    assert maglev.assign_shards(docs_of([]), "doc_id", shards).count() == 0
    clash = docs_of([(1, "a"), (2, None)]).selectExpr("doc_id", "'mine' _slot", "'mine' _shard", "'mine' _own")
    assert [(r._slot, r._shard, r._own) for r in maglev.assign_shards(clash, "doc_id", shards).collect()] == [("mine",) * 3] * 2


# 2 mixing (exact SQL oracle in test_oracles)

def test_mixture_budget_shortage_and_edges(spark):
    rows = [(i, "w " * 10, "en", "src1") for i in range(40)] + [(100 + i, "w " * 10, "en", "src6") for i in range(4)] + [(200, None, "en", "src1"), (201, "", None, None), (202, "x y", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("mix_tokens", F.lit("clash"))
    out = mixture.select_mixture(docs, share=0.5, max_epochs=1, weights={("source", "src1"): 1, ("source", "src6"): 1}).collect()
    by = {}
    for r in out:
        by[r.source] = by.get(r.source, 0) + r.mix_tokens
    # 442 tokens, budget 221: the null leaf is full with 2; src6 is short (40 of its half) and src1 takes the rest.
    assert by[None] == 2 and by["src6"] == 40 and by["src1"] == 179
    cut = [r for r in out if 0 < r.mix_tokens < 10 and r.source == "src1"]
    assert [(r.mix_tokens, r.text) for r in cut] == [(9, "w " * 8 + "w")]
    assert all(r.doc_id not in (200, 201) for r in out)
    twice = mixture.select_mixture(docs.where("source = 'src6'"), share=2.5, max_epochs=3).collect()
    assert sorted({r.mix_epoch for r in twice}) == [0, 1, 2] and len(twice) == 10
    assert mixture.select_mixture(docs.limit(0)).count() == 0


def test_mixture_keeps_columns_with_the_names_of_its_own(spark):
    names = ["rest", "epochs", "cross", "before", "at", "take", "last", "taken", "mix_key", "mix_bucket", "mix_lang", "in_0", "tokens", "budget", "n"]
    docs = spark.range(30).select(F.col("id").alias("doc_id"), F.lit(" a\u00e9  b\tc ").alias("text"), F.lit("en").alias("lang"), F.lit("src1").alias("source"),
                                  F.lit(9).alias("n_chars"), *[F.lit(f"mine-{n}").alias(n) for n in names])
    out = mixture.select_mixture(docs, share=0.5, max_epochs=1)
    rows = out.collect()
    assert out.columns == [*docs.columns, "mix_domain", "mix_tokens", "mix_epoch"] and sum(r.mix_tokens for r in rows) == 45
    assert all(r[n] == f"mine-{n}" for r in rows for n in names)
    assert {(r.mix_tokens, r.text, r.n_chars) for r in rows} <= {(3, " a\u00e9  b\tc ", 9), (2, " a\u00e9  b", 6), (1, " a\u00e9", 3)}


# 3 personal data

KINDS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
         ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
         ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
         ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15)]


def digits(m):
    return re.sub("[^0-9]", "", m)


def luhn(d):
    return sum(int(c) if i % 2 == 0 else (int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) for i, c in enumerate(reversed(d))) % 10 == 0


def base_text(t):
    found = sorted((m.start(), k, m.end()) for k, (_, p, ok) in enumerate(KINDS) for m in re.finditer(p, t or "") if ok(m[0]))
    return ",".join(f"{KINDS[k][0]}:{a}:{b}" for a, k, b in found)


def test_pii_base_spans(spark, small, docs_of):
    texts = {r.doc_id: r.text for r in table(spark, SMALL, "documents").collect()}
    for r in small("op3_information_pii"):
        assert r.base_sha256 == hashlib.sha256(base_text(texts[r.doc_id]).encode()).hexdigest()
    hard = ["a@b.c.d@e.f x_y@z", "1.2.3.4.5.6.7.8 0256.1.1.1 00255.0.0.1", "4111 1111 1111 1111 4111-1111-1111-1112", "+1 (555) 123-4567 +123", "é\U0001F600 me@é.com me@x.com",
            None, "", "a\x01b\x02 q@w.e", "1" * 5000, "a." * 3000 + "@x.y", "+" + "1" * 11 + " 10.0.0.1", "x@" + "a." * 3000 + "b"]
    out = {r.doc_id: r for r in pii.sanitise(docs_of(list(enumerate(hard)) + [(1, hard[1])])).select("doc_id", pii.span_digest("base").alias("b"), "clean_text").collect()}
    for i, t in enumerate(hard):
        assert out[i].b == base_text(t), t[:50]
    assert out[0].clean_text == "[EMAIL]_y@z" or "[EMAIL]" in out[0].clean_text
    assert pii.sanitise(docs_of([])).count() == 0


def test_pii_query_counts_every_kind(spark, docs_of, tmp_path):
    texts = ["a@b.cd, e@f.gh, i@j.kl", "1.2.3.4 and 5.6.7.8", "4111 1111 1111 1111", "+1 (555) 123-4567 or +1 555 765 4321; x@y.zw", "", None]
    docs_of([*enumerate(texts), (None, texts[1]), (2, texts[2])]).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in Q.op3_information_pii(spark, str(tmp_path)).collect())
    want = [(base_text(t), *[base_text(t).count(f"{k}:") for k, _, _ in KINDS]) for t in [*texts, texts[1], texts[2]]]
    assert got == sorted((hashlib.sha256(b.encode()).hexdigest(), *n) for b, *n in want)
    assert [sum(w[k] for w in want) for k in range(1, 5)] == [4, 4, 2, 2]


def test_pii_disclosing_terms(spark, docs_of):
    rows = [(i, f"hello zanzibar person mail bob@x.com about common thing {i}") for i in range(4)] + [(10 + i, f"person about common thing hello {i}") for i in range(30)]
    out = {r.doc_id: r for r in pii.sanitise(docs_of(rows)).collect()}
    for i in range(4):  # zanzibar and mail are only ever near bob: removed; words found everywhere stay
        assert out[i].clean_text == f"hello  person  [EMAIL] about common thing {i}"
    assert out[10].clean_text == rows[4][1]


def test_pii_terms_anywhere_in_the_document(spark, docs_of):
    far = "filler and more filler of the common sort " * 5
    rows = [(i, f"zanzibar {far}bob@x.com {far}zanzibar, {far}(quagga) {i}") for i in range(4)] + [(10 + i, f"{far}{i}") for i in range(30)] + [(50, "quagga alone")]
    out = {r.doc_id: r for r in pii.sanitise(docs_of(rows)).collect()}
    for i in range(4):  # quagga is also seen without bob: generalised where he is, kept where he is not
        assert out[i].clean_text == f" {far}[EMAIL] {far}, {far}([TERM]) {i}"
    assert out[10].clean_text == rows[4][1] and out[50].clean_text == "quagga alone"
    many = " ".join(f"word{chr(97 + k % 26)} " for k in range(3 * pii.BLOCK + 1))
    got = spark.createDataFrame([(many,)], "t string").select(pii.matches(F.col("t"), r"[a-z]+").alias("m")).first().m
    assert [(m.start, m.value) for m in got] == [(m.start(), m[0]) for m in re.finditer(r"[a-z]+", many)]


def brute_terms(docs, generalise=pii.GENERALISE, remove=pii.REMOVE, support=pii.SUPPORT, common=pii.COMMON):
    """(base and added spans per document) by counting every pair in memory."""
    dense = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}"
    spaced = rf"[[\p{{L}}\p{{M}}\p{{N}}]--[{dense}]]"
    term = regex.compile(rf"(?V1){spaced}+(?:['\u2019-]{spaced}+)*|[{dense}]{{1,2}}")

    def keys(kind, v):
        d, v = digits(v), v.lower()
        if kind == 0:
            return {"email" + v, "~l" + v.split("@")[0], "~d" + v.split("@")[-1], "~s" + ".".join(v.split("@")[-1].split(".")[-2:])}
        if kind == 1:
            v = ".".join(str(int(x)) for x in v.split("."))
            return {"ip" + v, "~n" + v.rsplit(".", 1)[0], "~r" + v.rsplit(".", 2)[0]}
        return {"card" + d, "~i" + d[:6]} if kind == 2 else {"phone" + d, "~e" + d[:-4], "~a" + d[:-7]}
    held = []
    for t in docs:
        base = sorted((m.start(), k, m.end()) for k, (_, p, ok) in enumerate(KINDS) for m in re.finditer(p, t) if ok(m[0]))
        bare = list(t)
        for a, _, b in base:
            bare[a:b] = " " * (b - a)
        words = [(m.start(), m.end(), m[0].lower()) for m in term.finditer("".join(bare))]
        held.append((base, set().union(*[keys(k, t[a:b]) for a, k, b in base]), words))
    n = len(docs)
    df_t, df_e, both, in_texts, e_texts = {}, {}, {}, {}, {}
    for t, (_, es, words) in zip(docs, held, strict=True):
        for w in {w for *_, w in words}:
            df_t[w] = df_t.get(w, 0) + 1
            for e in es:
                both[e, w] = both.get((e, w), 0) + 1
                in_texts.setdefault((e, w), set()).add(t)
        for e in es:
            df_e[e] = df_e.get(e, 0) + 1
            e_texts.setdefault(e, set()).add(t)
    out = []
    for base, es, words in held:
        spans = list(base)
        for a, b, w in words:
            shares = [np.log(both[e, w] * n / (df_t[w] * df_e[e])) / np.log(n / df_e[e]) for e in es
                      if len(in_texts[e, w]) >= support and n > df_e[e] and (e[0] != "~" or df_e[e] * common <= n)]
            if shares and max(shares) >= generalise:
                spans.append((a, 5 if max(shares) >= remove else 4, b))
        out.append(",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans)))
    return out


def test_pii_terms_equal_brute_force(spark, docs_of):
    rng = np.random.default_rng(21)
    names = ["Kim", "Smith-Jones", "O\u2019Brien", "K48213", "ab", "x", "Zo\u00e9", "\u5c71\u7530\u592a\u90ce", "1999"]
    docs = []
    for i in range(240):
        w = [f"w{int(x)}" for x in np.minimum(rng.zipf(1.4, 25), 90)] + list(rng.choice(names, 2))
        if i % 6 == 0:
            k = int(rng.integers(0, 12))
            w.insert(int(rng.integers(0, 25)), str(rng.choice([f"u{i}@mail{k}.org", f"Bob{k}@h{i}.net", f"+1 555 {100 + k} {1000 + i}", f"+1-555-{100 + k}-{1000 + i % 12}",
                                                               f"10.0.{k}.{i % 250}", f"010.00.{k}.7", "4111 1111 1111 1111"])))
            w.append(f"secret{k}")
        docs.append(" ".join(map(str, w)))
    docs += docs[:12]
    got = {r.doc_id: r.s for r in pii.sanitise(docs_of(list(enumerate(docs)))).select("doc_id", pii.span_digest("spans").alias("s")).collect()}
    want = brute_terms(docs)
    assert [got[i] for i in range(len(docs))] == want
    assert sum(s.count("term:") for s in want) > 0 and sum(s.count("drop:") for s in want) > 0


def test_pii_query_adds_terms_on_the_tables(spark):
    rows = Q.op3_information_pii(spark, "/root/testdata/sf0.01").collect()
    texts = {r.doc_id: r.text for r in table(spark, "/root/testdata/sf0.01", "documents").collect()}
    ids = [r.doc_id for r in rows]
    assert [r.spans for r in rows] == brute_terms([texts[i] or "" for i in ids])
    assert sum(r.spans.count("term:") + r.spans.count("drop:") for r in rows) > 0


# 4 rollups (exact SQL oracle in test_oracles)

def test_rollups_are_idempotent_and_signed(spark, tmp_path, docs_of):
    store = rollups.TokenRollups(spark, f"file://{tmp_path}/r")
    assert store.totals().count() == 0
    d = docs_of([(1, "a b"), (2, None), (3, "c"), (3, "c")])
    n = F.coalesce(F.length("text"), F.lit(0))
    assert store.commit("one", rollups.inserts(d, n, "v1")) and not store.commit("one", rollups.inserts(d, n, "v1"))
    assert [tuple(r) for r in store.totals().collect()] == [("src0", "en", "v1", 4, 5)]
    store.commit("two", rollups.revisions(d.where("doc_id = 1"), n, n + 4, "v1"))
    store.commit("three", rollups.deletes(d.where("doc_id = 3"), n, "v1"))
    store.commit("none", rollups.inserts(d.limit(0), n, "v1"))
    assert [tuple(r) for r in store.totals().collect()] == [("src0", "en", "v1", 2, 7)]
    assert store.batches() == ["none", "one", "three", "two"]
    with pytest.raises(ValueError):
        store.commit("../x", rollups.inserts(d, n, "v1"))
    assert store.fold() == 1 and [tuple(r) for r in store.totals().collect()] == [("src0", "en", "v1", 2, 7)]
    assert not store.commit("one", rollups.inserts(d, n, "v1")) and store.commit("four", rollups.inserts(d.where("doc_id = 1"), n, "v1"))
    (tmp_path / "r" / "fold=2").mkdir()  # a fold that broke off
    assert [tuple(r) for r in store.totals().collect()] == [("src0", "en", "v1", 3, 10)]
    assert store.fold() == 2 and store.folds() == [1, 2] and [tuple(r) for r in store.totals().collect()] == [("src0", "en", "v1", 3, 10)]
    opened = "".join(store.totals().inputFiles())
    assert "fold=2" in opened and "batch=" not in opened
    empty = rollups.TokenRollups(spark, f"file://{tmp_path}/empty")
    assert empty.fold() == 1 and empty.totals().count() == 0


# 5 quality

def test_quality_held_out_accuracy_and_edges(spark, docs_of):
    from lathe.llm.queries import held_out, op5_subword_quality
    rows = {r.doc_id: r for r in op5_subword_quality(spark, "/root/testdata/sf0.01").collect()}
    labels = {r.doc_id: r.quality for r in table(spark, "/root/testdata/sf0.01", "labels").collect()}
    held = [(rows[i], q) for i, q in labels.items() if rows[i].held_out]
    assert all(rows[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in rows)
    assert len(held) > 80 and np.mean([r.predicted == q for r, q in held]) >= 0.97
    model = quality.train(["good text here", "BAD!! BAD!!"], np.array([1, 0]))
    out = quality.score_documents(docs_of([(1, None), (2, ""), (None, "x " * 50_000), (3, "BAD!! BAD!!"), (3, "BAD!! BAD!!")]), model).collect()
    assert len(out) == 5 and all(0 <= r.score <= 1 for r in out) and out[0].score == out[1].score
    assert quality.train([], np.array([]))[1] == 0.0
    mine = docs_of([(1, "good text here"), (2, "BAD!! BAD!!")]).withColumn("_quality", F.lit("mine")).withColumn("_QUALITY_", F.lit(1))
    assert {r._quality for r in quality.keep_good(mine, model).select("_quality").collect()} == {"mine"}
    assert docs_of([(None, "a")]).select(held_out().alias("h")).collect()[0].h is False


# 6 near-duplicates (exact SQL oracle in test_oracles)

def brute_groups(texts, size, percent=80):
    sets = {}
    for i, t in texts:
        w = split(t)
        sets[i] = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            m = min(label[a], label[b])
            changed |= label[a] != m or label[b] != m
            label[a] = label[b] = m
    return label, {i: len(s) for i, s in sets.items()}


def test_near_duplicates_hot_groups_and_edges(docs_of):
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(150):  # a large near-copy group, far from complete
        w = list(base)
        for k in rng.choice(120, 3, replace=False):
            w[k] = f"x{rng.integers(1_000_000)}"
        rows.append((i + 10, " ".join(w)))
    rows += [(500 + i, " ".join(base)) for i in range(60)] + [(600 + i, " ".join(f"u{rng.integers(9999)}" for _ in range(80))) for i in range(30)]
    rows += [(700, None), (701, ""), (702, " \t "), (703, "one two"), (704, "ONE two"), (705, "one"), (706, "long " * 20_000), (707, "long " * 19_000)]
    label, n = brute_groups(rows, 4)
    out = minmax_dedup.near_duplicates(docs_of(rows + [(703, "one two"), (None, "one two")]), size=4, block=32).collect()
    assert len(out) == len(rows) + 2
    for r in out:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.n_shingles, r.kept) == (label[r.doc_id], n[r.doc_id], label[r.doc_id] == r.doc_id), r
    kept = minmax_dedup.keep_representatives(docs_of(rows + [(703, "one two")]), size=4)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i in label if label[i] == i)
    assert minmax_dedup.near_duplicates(docs_of([])).count() == 0


def test_connected_components_long_chain(spark):
    edges = spark.range(200).selectExpr("id * 7 % 211 as a", "(id + 1) * 7 % 211 as b").unionByName(spark.createDataFrame([(900, 901), (901, 901), (None, 3)], "a long, b long"))
    out = {r.id: r.component for r in connected_components(edges).collect()}
    assert set(out.values()) == {0, 900} and out[901] == 900 and 3 in out
    assert connected_components(edges.limit(0)).count() == 0


# 7 token files

@pytest.mark.parametrize("n", [0, 1, 255, 4097, 30_000])
def test_range_coder_round_trip_and_damage(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 65536, n), np.minimum(rng.zipf(1.2, n), 65535), np.full(n, 65535), np.arange(n) % 50, rng.integers(0, 2**32, n),
                65_500 + np.arange(n) % 90):
        data = encode(ids)
        assert (decode(data) == ids).all()
        if n > 300:
            hurt = bytearray(data)
            hurt[-len(hurt) // 3] ^= 0x55
            with pytest.raises(ValueError):
                decode(bytes(hurt))
    for bad in (1 << 32, -1):
        with pytest.raises(ValueError):
            encode(np.array([bad]))


def test_blocks_do_not_depend_on_their_group(monkeypatch):
    ids = np.minimum(np.random.default_rng(4).zipf(1.3, 5 * range_coder.BLOCK + 17), 65535)
    want = encode(ids)
    monkeypatch.setattr(range_coder, "GROUP", 2)
    assert encode(ids) == want and (decode(want) == ids).all()
    # a block alone is coded as among others
    assert encode(ids[:range_coder.BLOCK])[28:] in want


def test_files_are_smaller_than_adaptive_order_0(spark):
    """8.6 bits an id is what adaptive order 0 alone takes in blocks of 4,096 ids of these documents."""
    import public_tokenizers
    out = token_files.new_path(spark, "test-tokens")
    token_files.write_tokens(table(spark, "/root/testdata/sf0.01", "documents"), out, public_tokenizers.path(Q.TOKENIZER), Q.END_ID)
    n, size = spark.read.parquet(out).agg(F.sum("n_ids"), F.sum(F.length("payload"))).first()
    assert 8 * size / n < 8.4


def test_token_files_equal_the_library(spark, docs_of):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    texts = [r.text for r in table(spark, SMALL, "documents").collect()]
    texts += [None, "", " ", "  two  spaces \n\n x ", "it's don't WE'LL", "日本語 mixed ascii", "<|endoftext|> a", "a" * 3000, "½ ²3 \x85\xa0z\x1c\x1dq", "é" * 2000, "tab\tnew\r\nline"]
    rows = [(5 * i % 1009, t) for i, t in enumerate(texts)] + [(0, "same id")]
    for segment in (1 << 22, 20_000):
        out = token_files.new_path(spark, "test-tokens")
        token_files.write_tokens(docs_of(rows + [(None, "no id")]), out, path, 2, segment_ids=segment)
        want, start = [], 0
        for i, t in sorted([(-1, "no id"), *rows], key=lambda r: (r[0], r[1] is not None, r[1] or "")):
            ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
            want.append((None if i < 0 else i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
            start += len(ids)
        got = sorted((tuple(r) for r in token_files.read_digests(spark, out).collect()), key=lambda r: r[1])
        assert got == want
    ids = {r.doc_id: r.ids for r in token_files.read_ids(spark, out).collect()}
    assert ids[5] == tok.encode(texts[1], add_special_tokens=False).ids + [2]
    out = token_files.new_path(spark, "test-tokens")
    token_files.write_tokens(docs_of([]), out, path)
    assert token_files.read_digests(spark, out).count() == 0


def test_chunks_encode_as_whole_texts(monkeypatch):
    import public_tokenizers
    import pyarrow as pa
    enc = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    white = [" ", "  ", "   ", "\n", " \n", "\n ", " \n ", "\t ", "\xa0", " \xa0 ", "\u2003 ", "\u200b ", "\ufeff ", "\x1c ", "\u180e  ", "\x85 "]
    texts = [f"{a}{w}{b}" for w in white for a in ("", "a", "Wort.", "日本", "don't") for b in ("", "b", "'s 12", "日本 x", "<|endoftext|> c")]
    texts += [None, "", "привет мир " * 40, "z" * 500 + " " + "z" * 500, "é" * 100 + " a a a"]
    want = [enc.tok.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    for cached in (token_files.CACHED_CHUNKS, 20):  # all chunks known; nearly all forgotten after each batch
        monkeypatch.setattr(token_files, "CACHED_CHUNKS", cached)
        for step in (len(texts), 7, 1):
            got = []
            for at in range(0, len(texts), step):
                ids, lengths = enc.encode(pa.array(texts[at:at + step], pa.string()), 2)
                got += [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])]
            assert got == want


# 8 URL rules (exact SQL oracle in test_oracles)

def test_url_rules_edges(spark):
    urls = ["https://WWW.Example.com/en/x", "http://example.com/en/", "http://a.example.com/en", "http://notexample.com/en/", "https://x.net/es/?a#b", "https://x.net?es/", "ftp://spam-farm.org/a", None, "",
            "nothing", "://com/", "http://com/ü", "http://a.com/casino", "http://a.org/casino/", "x://b.com/promo/12/click", "x://b.org/promo/12/click"]
    pages = spark.createDataFrame([(i, u, "c") for i, u in enumerate(urls)] + [(0, urls[0], "d")], "page_id long, url string, token string")
    out = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge_urls(pages).collect()}
    assert out[0] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert out[1] == ("example.com", "/en/", "example.com/en/", "block") and out[2] == ("a.example.com", "/en", "com/", "allow")
    assert out[3][2:] == ("com/", "allow") and out[4] == ("x.net", "/es/", "net/es/", "block") and out[5] == ("x.net", "", None, "allow")
    assert out[6][2:] == (None, "block") and out[7] == out[8] == out[9] == ("", "", None, "allow") and out[10][2:] == ("com/", "allow")
    assert out[11][2:] == ("com/", "allow") and out[12][2:] == ("com/", "allow") and out[13][2:] == (None, "block") and out[15][2:] == (None, "block")
    assert url_rules.judge_urls(pages).count() == len(urls) + 1 and url_rules.judge_urls(pages.limit(0)).count() == 0


# 9 embeddings (exact SQL oracle in test_oracles)

def test_embedding_groups_recall_hot_group_and_edges(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 16))
    x[300:600] = x[0] + rng.normal(size=(300, 16)) * 0.1  # a hot cell
    x[600:700] = x[1]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [float("nan")] * 16), (2004, [float("inf")] * 16), (2005, [1.0, None] * 8), (2006, x[1][:8].tolist()), (None, x[1].tolist()),
           (2007, (x[5] * 1e-300).tolist()), (3, x[3].tolist())]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows + odd], "vec_id long, embedding array<double>, rep int")
    out = embedding_dedup.embedding_groups(df, cell_rows=60, block=128).collect()
    u = np.vstack([x, x[5:6]])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    ids = [*range(900), 2007]
    near = u @ u.T >= 0.95
    label = np.arange(len(ids))
    while True:
        new = np.where(near, label[None, :], 10**6).min(axis=1)
        if (new == label).all():
            break
        label = new
    got = {r.vec_id: r for r in out}
    true = near.sum() - len(ids)
    found = sum(got[i].n_links for i in ids)
    assert len(out) == len(rows) + len(odd) and 0.9 * true <= found <= true
    assert np.mean([got[i].component_id == ids[label[k]] for k, i in enumerate(ids)]) > 0.9
    for i in range(2000, 2007):
        assert got[i].n_links == 0 and got[i].kept
    assert got[None].component_id is None and got[None].kept
    assert embedding_dedup.embedding_groups(df.limit(0)).count() == 0


def test_every_vector_length_has_centroids(spark):
    rows = [(i, [float(1 + i % 7), float(i % 11), 1.0]) for i in range(3_000)] + [(5_000 + i, [1.0, float(i)]) for i in range(5)] + [(9_000, [2.0])]
    v = spark.createDataFrame(rows, "rep long, embedding array<float>").withColumn("dim", F.size("embedding"))
    cells = embedding_dedup.fit_cells(v, 3_006, fit_rows=100, cell_rows=10)
    assert set(cells) == {1, 2, 3} and len(cells[3]) > 100
    got = {r.vec_id: r.n_links for r in embedding_dedup.embedding_groups(v.select(F.col("rep").alias("vec_id"), "embedding"), fit_rows=100).collect()}
    assert got[9_000] == 0 and sum(got[5_000 + i] for i in range(5)) > 0


# 10 decontamination

def test_contamination_brute_force_and_edges(spark, docs_of):
    rng = np.random.default_rng(9)
    item = [f"b{k}" for k in range(30)]
    short = "alpha beta gamma delta epsilon zeta"
    bench = spark.createDataFrame([(1, " ".join(item), 0), (2, short, 0), (3, "the of", 0), (4, None, 0), (5, " ".join(item), 0)], "item_id long, text string, pos int")

    def leak(subs):
        w = list(item)
        for k in subs:
            w[k] = "zzz"
        return "pre fix " * 5 + " ".join(w).upper().replace(" B7 ", " b7,\n") + " post" * 9
    rows = [(0, leak([])), (1, leak([4])), (2, leak([3, 15, 27])), (3, leak([1, 2, 3, 10, 11, 12, 20])), (4, " ".join(item[:12])), (5, "see " + short.title() + "."), (6, "alpha beta gamma delta epsilon"),
            (7, "the of " * 40), (11, "The, of"), (12, "some line\nthe of\nmore"), (13, "see the of"), (14, "beta gamma delta epsilon zeta and"), (8, None), (9, ""), (10, "fill " * 60_000 + " ".join(item)), (None, " ".join(item)), (1, leak([4]))]
    out = decontaminate.contamination(docs_of(rows), bench).collect()
    got = {r.doc_id: (r.contaminated, r.item_id) for r in out}
    assert len(out) == len(rows)
    # Five of an item's six words count wherever they stand, also at the text's start or end.
    assert {i for i, (c, _) in got.items() if c} == {0, 1, 2, 5, 6, 10, 11, 12, 14, None} and got[11] == got[12] == (True, 3) and got[0] == (True, 1) and got[5] == (True, 2)
    assert next(r.overlap for r in out if r.doc_id == 2) == 27 / 30
    kept = decontaminate.remove_contaminated(docs_of(rows), bench)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [3, 4, 7, 8, 9, 13] and "slot" in kept.columns
    shuffled = decontaminate.contamination(docs_of(rows), bench, broadcast_hashes=0).collect()
    assert sorted(map(str, shuffled)) == sorted(map(str, out))
    assert not any(r.contaminated for r in decontaminate.contamination(docs_of(rows), bench.limit(0)).collect())
    assert decontaminate.contamination(docs_of([]), bench).count() == 0
    _ = rng


def test_contamination_finds_scattered_substitutions(spark, docs_of):
    rng = np.random.default_rng(10)
    lengths = [*range(5, 32), 40, 45, 59]
    items = [[f"i{k}w{j}" for j in range(n)] for k, n in enumerate(lengths)]
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    rows, want = [], {}
    for k, w in enumerate(items):
        spare = len(w) * 2 // 10
        for subs in [rng.choice(len(w), s, replace=False) for s in (spare, spare, spare, spare, spare + 1)] + [range(4, len(w), 5), range(2, len(w), 5)]:
            laid = [x if j not in set(subs) else f"sub{j}" for j, x in enumerate(w)]
            text = [f"fill{x}" for x in rng.integers(0, 50, 30)]
            at = int(rng.integers(0, 31))
            want[len(rows)] = (k, (len(w) - len(subs)) / len(w))
            rows.append((len(rows), " ".join(text[:at] + laid + text[at:])))
    got = {r.doc_id: r for r in decontaminate.contamination(docs_of(rows), bench).collect()}
    for i, (k, overlap) in want.items():
        assert got[i].contaminated == (overlap >= 0.8), (i, lengths[k], overlap)
        assert overlap < 0.8 or (got[i].item_id, got[i].overlap, got[i].n_items) == (k, overlap, 1)


def test_seeds_cannot_be_blocked():
    import itertools
    for family in decontaminate.SEEDS:
        fewest = decontaminate.blocked_by(family, 11)
        for n in range(12):
            def hit(wrong):
                return any(not wrong & {i + k for k, c in enumerate(m) if c == "1"} for m in family for i in range(n - len(m) + 1))
            assert fewest[n] == next(s for s in range(n + 1) if any(not hit(set(w)) for w in itertools.combinations(range(n), s)))
    for least in (0.8, 0.5, 0.95):
        plan = decontaminate.seeds_for(list(range(5, 300)), least)
        assert sorted(n for held in plan.values() for n in held) == list(range(5, 300))


def test_contamination_on_tables(spark, small):
    strip = str.maketrans("", "", decontaminate.PUNCTUATION)
    items = [split((r.text or "").translate(strip)) for r in table(spark, SMALL, "benchmark").collect()]
    texts = {r.doc_id: " " + " ".join(split((r.text or "").translate(strip))) + " " for r in table(spark, SMALL, "documents").collect()}
    whole = {i for i, t in texts.items() if any(f" {' '.join(w)} " in t for w in items if len(w) >= 5)}
    assert all(len(w) >= 5 for w in items)
    assert {r.doc_id for r in small("op10_spaced_seed_decontamination") if r.overlap == 1.0} == whole


# pipeline

def test_pipeline_stages_hand_on_documents(spark):
    import corpus_pipeline as P
    docs = table(spark, SMALL, "documents")
    kept = {r.doc_id: r for r in docs.collect()}
    cols = docs.columns
    for name, stage in P.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SMALL).collect(), docs.schema)
        ids = [r.doc_id for r in docs.collect()]
        # Only the mixture may take a document more than once, up to its epochs.
        most = max(ids.count(i) for i in set(ids))
        assert docs.columns == cols and most <= (P.MIX_EPOCHS if name == "mixing" else 1) and set(ids) <= set(kept), name
        if name == "near_dedup":
            label, _ = brute_groups([(i, r.text) for i, r in kept.items()], 5)
            assert set(ids) == {i for i in kept if label[i] == i}
        kept = {i: kept[i] for i in ids}
    out = P.STAGES[-1][1](spark, docs, SMALL).collect()
    assert sorted(r.doc_id for r in out) == sorted(ids)
    assert sorted((r.doc_id, r.epoch) for r in out) == sorted((i, k) for i in set(ids) for k in range(ids.count(i)))
    assert sorted(tuple(r) for r in P.run(spark, SMALL).collect()) == sorted(tuple(r) for r in out)


def test_sanitising_broadcasts_by_rows_not_by_size_on_disk(spark, monkeypatch):
    """Tables of more rows than the bound are never broadcast, whatever their files' size, and results stay; documents without id too."""
    texts = [f"{w} wrote to anna{i}@mail{i}.example.org about project{i} twice" for i in range(6) for w in ("somebody", "nobody", "everybody")]
    docs = spark.createDataFrame([(None if k % 7 == 3 else k, t) for k, t in enumerate(texts)], "doc_id long, text string").unionByName(
        spark.createDataFrame([(100 + k, f"plain words of text {k}") for k in range(120)], "doc_id long, text string"))

    def rows():
        return sorted(map(str, pii.sanitise(docs).select("doc_id", pii.span_digest("spans"), "clean_text").collect()))
    want = rows()
    assert any("drop:" in r or "term:" in r for r in want)
    monkeypatch.setattr(pii, "BROADCAST_ROWS", 0)
    assert rows() == want
    found = pii.occurrences(docs)
    entities = found.select(F.explode("entities").alias("entity")).distinct()
    plan = pii.together(found.localCheckpoint(), entities.localCheckpoint())._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan

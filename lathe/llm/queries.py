"""The corpus operators as registered queries over the given tables, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.llm import (decontaminate, embedding_dedup, maglev, minmax_dedup, mixture, packing, pii, quality, rollups, spelling, token_files, url_rules,
                       vector_codes)
from lathe.llm.common import let, materialize, table, words

SHARDS = [f"shard-{i:03d}" for i in range(64)]
TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
WORD_TOKENIZER = "word_bpe_49k.json"
WORD_END_ID = 1
_WORD = r"[^\x20\x09-\x0D]+"
_PIECE = r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9\x09-\x0D\x20]"


def op1_maglev_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maglev.assign_shards(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", SHARDS)


def op2_hierarchical_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.select_mixture(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("mix_domain").alias("domain"), "lang", "source", F.col("mix_epoch").alias("epoch"), F.col("mix_tokens").alias("n_tokens"))


def op3_information_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.sanitise(table(spark, sf_dir, "documents"))
    counts = [pii.count_of("base", k).cast("long").alias(f"n_{k}") for k in pii.PATTERNS]
    return found.select("doc_id", *counts, F.sha2(pii.span_digest("base"), 256).alias("base_sha256"), pii.span_digest("spans").alias("spans"),
                        F.sha2("clean_text", 256).alias("clean_sha256"))


def op4_delta_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tokenizer versions are counted in (whitespace words; runs of letters or digits and single marks), the word counts of
    documents labelled good are revised by one (an end mark), documents labelled toxic are deleted, and the first batch
    is sent again."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", let(words(F.col("text")), F.size).cast("long").alias("w"),
                                                    F.regexp_count(text, F.lit(_PIECE)).cast("long").alias("p"))
    docs = materialize(docs, "roll-counts")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    known = materialize(docs.join(labels, "doc_id"), "roll-labelled")
    w, p = F.col("w"), F.col("p")
    good = known.where("quality = 1")
    toxic = known.where("toxic = 1").withColumn("w", F.when(F.col("quality") == 1, w + 1).otherwise(w))
    store = rollups.TokenRollups(spark, token_files.new_path(spark, "rollups"))
    first = rollups.inserts(docs, w, "words-1")
    store.commit("b1", first)
    store.commit("b2", rollups.inserts(docs, p, "pieces-1"))
    store.commit("b3", rollups.revisions(good, w, w + 1, "words-1"))
    store.commit("b4", rollups.deletes(toxic, w, "words-1").union(rollups.deletes(toxic, p, "pieces-1")))
    store.commit("b1", first)
    return store.totals()


def held_out(doc_id="doc_id") -> Column:
    """crc32 of the id's text, modulo 3, is 1; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op5_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "quality", ~held_out())
    return quality.score_documents(docs, model, ["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)


def op7_range_coded_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.new_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER), END_ID)
    return token_files.read_digests(spark, path)


def op8_rarest_token_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op9_spherical_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_groups(table(spark, sf_dir, "embeddings"))


def op10_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_orchard_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_digests(*vector_codes.compress(table(spark, sf_dir, "embeddings")))


def op12_permuterm_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(spelling.word_counts(spelling.runs(table(spark, sf_dir, "documents"))))


def op13_concatenate_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(WORD_TOKENIZER)
    return packing.piece_digests(packing.pack_documents(table(spark, sf_dir, "documents"), path, WORD_END_ID), path)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _mixing_sql() -> str:
    """Hierarchical budgeting in SQL: the same shares in whole numbers, level by level."""
    def weight(level: str) -> str:
        cases = " ".join(f"WHEN '{v}' THEN {w}" for (at, v), w in mixture.WEIGHTS.items() if at == level)
        return f"CASE {level} {cases} ELSE {mixture.DEFAULT_WEIGHT} END" if cases else str(mixture.DEFAULT_WEIGHT)

    domain = " ".join(f"WHEN regexp_matches(source, '{rule}') THEN '{name}'" for rule, name in mixture.DOMAINS)
    sql = f"""WITH d AS (SELECT doc_id, lang, source, coalesce(CASE {domain} ELSE 'general' END, '(none)') AS domain, coalesce(lang, '(none)') AS l,
  coalesce(source, '(none)') AS s, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS n FROM documents),
leaf AS (SELECT domain, l AS lang, s AS source, sum(n)::BIGINT AS tokens, sum(n)::BIGINT * {mixture.MAX_EPOCHS} AS cap FROM d WHERE n > 0 GROUP BY ALL),
b0 AS (SELECT 0 AS root, floor(coalesce(sum(tokens), 0) * {mixture.SHARE})::BIGINT AS budget FROM leaf)"""
    parent = ["root"]
    for k, level in enumerate(mixture.LEVELS, 1):
        up = ", ".join(parent)
        sql += f""",
c{k} AS (SELECT {up}, {level}, sum(cap)::HUGEINT AS cap, ({weight(level)})::HUGEINT AS weight FROM (SELECT 0 AS root, * FROM leaf) GROUP BY {up}, {level}),
o{k} AS (SELECT c.*, b.budget::HUGEINT AS budget, coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS before,
  sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS weight_from
  FROM c{k} c JOIN b{k - 1} b USING ({up}) WINDOW w AS (PARTITION BY {", ".join("c." + x for x in parent)} ORDER BY cap::DOUBLE / weight::DOUBLE, c.{level})),
f{k} AS (SELECT *, cap * weight_from <= weight * (budget - before) AS is_full FROM o{k}),
r{k} AS (SELECT *, greatest(budget - coalesce(sum(cap) FILTER (is_full) OVER w, 0), 0)::HUGEINT AS rest, coalesce(sum(weight) FILTER (NOT is_full) OVER w, 0)::HUGEINT AS rw
  FROM f{k} WINDOW w AS (PARTITION BY {up})),
g{k} AS (SELECT *, CASE WHEN is_full THEN cap ELSE weight * rest // rw END AS base, CASE WHEN is_full THEN -1 ELSE weight * rest % rw END AS part FROM r{k}),
b{k} AS (SELECT {up}, {level}, (base + CASE WHEN NOT is_full AND row_number() OVER (PARTITION BY {up} ORDER BY part DESC, {level})
  <= rest - coalesce(sum(base) FILTER (NOT is_full) OVER (PARTITION BY {up}), 0) THEN 1 ELSE 0 END)::BIGINT AS budget FROM g{k})"""
        parent.append(level)
    sql += f""",
p AS (SELECT leaf.domain, leaf.lang AS l, leaf.source AS s, budget // tokens AS epochs, budget % tokens AS rest FROM leaf JOIN b3 USING (domain, lang, source)),
q AS (SELECT d.*, epochs, rest, sum(n) OVER (PARTITION BY domain, l, s ORDER BY md5('{mixture.SEED}|' || epochs || '|' || coalesce(doc_id::VARCHAR, '')), doc_id, n
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS seen FROM d JOIN p USING (domain, l, s) WHERE n > 0),
t AS (SELECT *, epochs + CASE WHEN seen < rest THEN 1 ELSE 0 END AS take, CASE WHEN seen < rest THEN least(n, rest - seen) ELSE n END AS last FROM q),
e AS (SELECT *, unnest(range(take::BIGINT))::INT AS epoch FROM t WHERE take > 0)
SELECT doc_id, domain, lang, source, epoch, (CASE WHEN epoch = take - 1 THEN last ELSE n END)::BIGINT AS n_tokens FROM e"""
    return sql


_OP4_SQL = f"""WITH d AS (SELECT doc_id, source, lang, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS w, len(regexp_extract_all(coalesce(text, ''), '{_PIECE}')) AS p FROM documents),
k AS (SELECT d.*, quality, toxic FROM d JOIN labels USING (doc_id)),
x AS (SELECT source, lang, 'words-1' AS tokenizer, 1 AS dd, w AS dt FROM d UNION ALL SELECT source, lang, 'pieces-1', 1, p FROM d
UNION ALL SELECT source, lang, 'words-1', 0, 1 FROM k WHERE quality = 1
UNION ALL SELECT source, lang, 'words-1', -1, -(w + CASE WHEN quality = 1 THEN 1 ELSE 0 END) FROM k WHERE toxic = 1
UNION ALL SELECT source, lang, 'pieces-1', -1, -p FROM k WHERE toxic = 1)
SELECT source, lang, tokenizer, sum(dd)::BIGINT AS n_docs, sum(dt)::BIGINT AS n_tokens FROM x GROUP BY ALL HAVING sum(dd) <> 0 OR sum(dt) <> 0"""

_COMPONENTS_SQL = """both_ AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(id, comp) AS (SELECT a, least(a, min(b)) FROM both_ GROUP BY a UNION SELECT both_.b, reach.comp FROM reach JOIN both_ ON both_.a = reach.id),
comps AS (SELECT id, min(comp) AS comp FROM reach GROUP BY id)"""

_OP6_SQL = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) >= 4 THEN list_distinct([array_to_string(ws[i:i + 3], ' ') FOR i IN range(1, len(ws) - 2)])
  WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS sh FROM w),
u AS (SELECT doc_id, unnest(sh) AS h FROM s),
i AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM u x JOIN u y ON x.h = y.h AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM i JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * n >= 80 * (len(x.sh) + len(y.sh) - n)),
{_COMPONENTS_SQL}
SELECT s.doc_id, len(sh)::BIGINT AS n_shingles, coalesce(comp, s.doc_id) AS component_id, coalesce(comp, s.doc_id) = s.doc_id AS kept FROM s LEFT JOIN comps ON id = s.doc_id"""

_OP9_SQL = f"""WITH RECURSIVE v AS (SELECT vec_id, [x::DOUBLE FOR x IN embedding] AS e FROM embeddings),
g AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v WHERE len(e) > 0 AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN e]) AND list_bool_or([x <> 0 FOR x IN e])),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM g x JOIN g y ON x.vec_id < y.vec_id AND len(x.e) = len(y.e) AND list_dot_product(x.e, y.e) / (x.n * y.n) >= 0.95),
{_COMPONENTS_SQL}
SELECT vec_id, (SELECT count(*) FROM both_ WHERE a = vec_id)::BIGINT AS n_links, coalesce(comp, vec_id) AS component_id, coalesce(comp, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN comps ON id = vec_id"""


def _url_sql() -> str:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in url_rules.SITE_RULES)
    patterns = " OR ".join(f"regexp_matches(host || path, '{x}')" for x, _ in url_rules.PATTERNS)
    return f"""WITH u AS (SELECT page_id, row_number() OVER () AS rn, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rn, regexp_extract(rest, '^([^/?#]*)', 1) AS h0, regexp_extract(rest, '^([^?#]*)', 1) AS bare FROM u),
x AS (SELECT page_id, rn, translate(h0, '{_UPPER}', '{_LOWER}') AS host, substr(bare, length(h0) + 1) AS path FROM h),
r(verdict, rh, rp) AS (VALUES {rules}),
f AS (SELECT rn, arg_max(r.verdict, length(rh || rp)) AS verdict, arg_max(rh || rp, length(rh || rp)) AS rule FROM x JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY rn)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN {patterns} THEN 'block' ELSE 'allow' END) AS verdict FROM x LEFT JOIN f USING (rn)"""


def _codes_sql() -> str:
    """Product codes in SQL: every part against every entry. Whole numbers below 2^53 are exact in doubles."""
    sql = f"""WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rn, vec_id, label, [floor({vector_codes.SCALE} * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])),
p AS MATERIALIZED (SELECT rn, vec_id, part, e[part * len(e) // {vector_codes.PARTS} + 1:(part + 1) * len(e) // {vector_codes.PARTS}] AS x FROM v, range({vector_codes.PARTS}) t(part)),
b0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id, rn) - 1 AS entry, x AS c FROM p QUALIFY entry < {vector_codes.ENTRIES})"""
    for r in range(vector_codes.ROUNDS + 1):
        sql += f""",
a{r} AS MATERIALIZED (SELECT rn, part, any_value(x) AS x, arg_min(entry, d * {vector_codes.ENTRIES} + entry) AS entry, min(d) AS d
  FROM (SELECT rn, part, x, entry, list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c) AS d FROM p JOIN b{r} USING (part)) GROUP BY rn, part)"""
        if r < vector_codes.ROUNDS:
            sql += f""",
u{r} AS (SELECT part, entry, list(m ORDER BY i) AS c FROM (SELECT part, entry, i, floor(sum(y) / count(*)) AS m
  FROM (SELECT part, entry, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM a{r}) GROUP BY part, entry, i) GROUP BY part, entry),
b{r + 1} AS MATERIALIZED (SELECT part, entry, coalesce(u.c, b.c) AS c FROM b{r} b LEFT JOIN u{r} u USING (part, entry))"""
    last = vector_codes.ROUNDS
    return sql + f""",
s AS (SELECT sha256(string_agg(y::BIGINT::VARCHAR, ',' ORDER BY part, entry, i)) AS sha FROM (SELECT part, entry, unnest(c) AS y, generate_subscripts(c, 1) AS i FROM b{last})),
g AS (SELECT rn, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{last} GROUP BY rn)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, sha AS codebooks_sha256 FROM v JOIN g USING (rn), s"""


#: crc32 goes through the key's bits, lowest first, from 2^32 - 1 on; 3988292384 is its polynomial. Letters beyond ASCII take two bytes.
_OP12_SQL = f"""WITH RECURSIVE t AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '{spelling.RUN}')) AS w FROM documents),
k AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(w, '{_UPPER}', '{_LOWER}') AS w, count(*) AS n FROM t GROUP BY ALL),
u AS (SELECT w, n, [unicode(c) FOR c IN string_split(id || ':' || w, '')] AS points FROM k),
y AS (SELECT w, n, flatten([CASE WHEN c < 128 THEN [c] ELSE [195, c - 64] END FOR c IN points])::BIGINT[] AS bytes FROM u),
z AS (SELECT w, n, list_prepend(4294967295::BIGINT, flatten([[(b >> j) & 1 FOR j IN range(8)] FOR b IN bytes])) AS bits FROM y),
h AS (SELECT w, n, 4294967295 - list_reduce(bits, lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))) AS h FROM z),
d AS (SELECT CASE WHEN h % {spelling.DRAW} = 0 THEN substr(w, 1, (h % length(w))::BIGINT) || substr(w, (h % length(w))::BIGINT + 2) ELSE w END AS word, n FROM h),
c AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM d WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
x AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM c)),
near AS MATERIALIZED (SELECT a.word, b.word AS near, b.n FROM x a JOIN x b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
UNION SELECT x.word, c.word, c.n FROM x JOIN c ON x.rest = c.word UNION SELECT c.word, x.word, x.n FROM x JOIN c ON x.rest = c.word),
best AS (SELECT word, count(*) AS n_near, first(near ORDER BY n DESC, near) AS near, max(n) AS near_n FROM near GROUP BY word),
f AS MATERIALIZED (SELECT c.word, c.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 2 * c.n THEN near END AS form, CASE WHEN near_n >= 2 * c.n THEN near_n END AS form_n
  FROM c LEFT JOIN best USING (word)),
r(word, top, form) AS (SELECT word, word, form FROM f UNION ALL SELECT r.word, f.word, f.form FROM r JOIN f ON f.word = r.form)
SELECT f.word, f.form, r.top AS root, f.n, f.n_near, f.form_n FROM f JOIN r ON r.word = f.word AND r.form IS NULL"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_maglev_sharding, op2_hierarchical_mixing, op3_information_pii, op4_delta_rollups, op5_subword_quality, op6_minmax_near_dedup,
    op7_range_coded_tokens, op8_rarest_token_url_rules, op9_spherical_embedding_dedup, op10_spaced_seed_decontamination, op11_orchard_vector_codes,
    op12_permuterm_spelling, op13_concatenate_and_cut)}
ORACLES: dict[str, str] = {"op2_hierarchical_mixing": _mixing_sql(), "op4_delta_rollups": _OP4_SQL, "op6_minmax_near_dedup": _OP6_SQL,
                           "op8_rarest_token_url_rules": _url_sql(), "op9_spherical_embedding_dedup": _OP9_SQL,
                           "op11_orchard_vector_codes": _codes_sql(), "op12_permuterm_spelling": _OP12_SQL}

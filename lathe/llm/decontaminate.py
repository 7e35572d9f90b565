"""Benchmark decontamination by spaced-seed hashing (DataFrame functions only).

A seed is a fixed mask over a window of tokens; positions marked 0 are ignored, so a window whose substituted tokens
fall on ignored positions still hashes alike. Each item takes the first family of ``SEEDS`` that no substitutions leaving
``least`` of its tokens can block (``blocked_by``): every place where the item lies with at least that share of equal
tokens is hit. Hashes of all document windows are joined with those of the benchmark; around each hit the item is laid
over the document on the hit's diagonal and the equal positions are counted. An item's overlap is the largest share of
its tokens found equal on one diagonal, or on all diagonals together that hold a window equal under one of the ``MASKS`` of span
12 (words put in or left out shift the diagonal). A document is contaminated by an item with an overlap of at least ``least``;
a smaller overlap is a lower bound, from the hit diagonals alone.

Tokens are whitespace words with A-Z lower-cased and common punctuation dropped. Items of ``MIN_WORDS`` words or more may
reach over the document's ends. A shorter item would match ordinary prose: it counts, with overlap 1.0, where its words are those of
the whole text or of one of its lines. Repeated items count once, under their smallest item_id. Null or empty texts match nothing; null ids are kept as they
are. Repeated rows are each judged. Extra columns are ignored. An empty benchmark leaves every document clean; empty
documents give an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathe.llm.common import let, materialize, salted_join, words

MASKS = ("110110110110", "101101101101", "011011011011")
#: Seed families, heaviest first; the last one is blocked only by substituting every token.
SEEDS = (("11011",), ("11011", "1111"), ("11011", "1111", "10111", "11101"), ("111",), ("11",), ("1",))
MIN_WORDS = 5
LEAST = 0.8
PUNCTUATION = ".,;:!?\"'()[]"
#: A benchmark with at most this many window hashes (32 bytes each) is broadcast; a larger one is joined by shuffle. So many
#: hashes of texts with hits are broadcast too.
BROADCAST_HASHES = 2_000_000


def tokens(text) -> Column:
    """64-bit hashes of the normalised words of a text."""
    return F.transform(words(F.col(text), PUNCTUATION), lambda w: F.xxhash64(w))


def blocked_by(masks: tuple[str, ...], longest: int) -> list[int]:
    """For each length 0 to ``longest``, the fewest substitutions that leave no window equal under any of the masks."""
    seen = (1 << max(map(len, masks)) - 1) - 1
    fewest, least_by = {0: 0}, [0]
    for n in range(1, longest + 1):
        ahead: dict[int, int] = {}
        for last, count in fewest.items():
            for wrong in (0, 1):
                window = last << 1 | wrong
                if all(n < len(m) or window & int(m, 2) for m in masks):
                    ahead[window & seen] = min(ahead.get(window & seen, n), count + wrong)
        fewest = ahead
        least_by.append(min(fewest.values()))
    return least_by


def seeds_for(lengths: list[int], least: float) -> dict[tuple[str, ...], list[int]]:
    """Each item length under the first family of ``SEEDS`` that hits every place with ``least`` of the tokens equal."""
    plan: dict[tuple[str, ...], list[int]] = {}
    left = sorted(lengths)
    for family in SEEDS:
        fewest = blocked_by(family, left[-1]) if left else []
        plan[family] = [n for n in left if fewest[n] > n - max(1, math.ceil(least * n - 1e-9))]
        left = [n for n in left if n not in set(plan[family])]
    return {family: held for family, held in plan.items() if held}


def seed_hashes(tok: Column, masks: tuple[str, ...]) -> Column:
    """Hashes of the windows that start at each word under each mask, mask after mask (null for a window beyond the
    end, so each block has as many as there are words); null when there are no words."""
    n = F.size(tok)

    def windows(mask: str) -> Column:
        care = [k for k, c in enumerate(mask) if c == "1"]
        return F.transform(F.sequence(F.lit(0), n - 1),
                           lambda i: F.when(i + len(mask) <= n, F.xxhash64(F.lit(int(mask, 2)), *[F.get(tok, i + k) for k in care])))

    return F.when(n > 0, F.concat(*map(windows, masks)))


def _windows(df: DataFrame, keys: list[str], tok: Column, masks: tuple[str, ...]) -> DataFrame:
    """``(keys, pos, h)``, one row per window and mask."""
    hashes = let(tok, lambda t: seed_hashes(t, masks))
    # The outer form: the plain one adds a filter that computes the hashes a second time.
    df = df.select(*keys, let(hashes, lambda h: F.struct(h.alias("h"), F.size(h).alias("n"))).alias("x"))
    return (df.select(*keys, F.col("x.n").alias("n"), F.posexplode_outer("x.h").alias("at", "h")).where("h is not null")
            .select(*keys, F.expr(f"at % (n div {len(masks)})").alias("pos"), "h"))


def _laid(tok: Column, x: Column, masks: tuple[str, ...]) -> Column:
    """An item laid over a document on one diagonal: ``(item_id, len, n, wide)``, the number of equal positions, and the
    positions themselves where they hold a window under one of the masks."""
    span = len(masks[0])
    at = F.transform(F.sequence(F.lit(0), x["len"] - 1), lambda k: F.coalesce(_at(tok, x["diagonal"] + k) == F.get(x["item"], k), F.lit(False)))

    def window(same: Column, i: Column) -> Column:
        return F.array_contains(F.array(*[F.forall(F.array(*[F.get(same, i + k) for k, c in enumerate(m) if c == "1"]), lambda e: e) for m in masks]), True)

    def judged(same: Column) -> Column:
        n = F.size(F.filter(same, lambda e: e))
        held = (x["len"] >= span) & (n >= min(m.count("1") for m in masks))
        held = F.when(held, F.exists(F.sequence(F.lit(0), x["len"] - span), lambda i: window(same, i))).otherwise(F.lit(False))
        wide = F.when(held, F.filter(F.sequence(F.lit(0), x["len"] - 1), lambda k: F.get(same, k))).otherwise(F.array().cast("array<int>"))
        return F.struct(x["item_id"].alias("item_id"), x["len"].alias("len"), n.alias("n"), wide.alias("wide"))
    return let(at, judged)


def _whole_runs(docs: DataFrame, short: DataFrame) -> DataFrame:
    """``(doc_id, th, item_id, overlap)`` where the words of an item are those of a whole text or of one of its lines."""
    def runs(text: Column) -> Column:
        lines = F.transform(F.split(text, "\n"), lambda line: words(line, PUNCTUATION))
        few = F.filter(F.array_append(lines, words(text, PUNCTUATION)), lambda w: (F.size(w) > 0) & (F.size(w) < MIN_WORDS))
        return F.array_distinct(F.transform(few, lambda w: F.transform(w, lambda x: F.xxhash64(x))))
    held = docs.select("doc_id", "th", F.explode_outer(runs(F.col("text"))).alias("tok")).where("tok is not null")
    return salted_join(held, short.select("tok", "item_id"), ["tok"], F.struct("doc_id", "th")).select(
        "doc_id", "th", "item_id", F.lit(1.0).alias("overlap")).distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, least: float = LEAST,
                  broadcast_hashes: int = BROADCAST_HASHES) -> DataFrame:
    """``(doc_id, contaminated, overlap, item_id, n_items)``, one row per input row: the largest overlap with an item,
    the smallest item that reaches it, and the number of items at or above ``least`` (0.0, null and 0 without hits)."""
    docs = docs.select("doc_id", "text").withColumn("th", F.xxhash64("text"))
    items = (benchmark.select("item_id", tokens("text").alias("tok")).where(F.size("tok") > 0)
             .groupBy("tok").agg(F.min("item_id").alias("item_id")))
    items = materialize(items.withColumn("len", F.size("tok")), "decon-items")
    short, items = items.where(F.col("len") < MIN_WORDS), items.where(F.col("len") >= MIN_WORDS)
    plan = seeds_for([r["len"] for r in items.select("len").distinct().collect()], least)

    used = tuple(dict.fromkeys(m for family in plan for m in family)) or SEEDS[0]
    seeds = None
    for family, held in (plan or {SEEDS[0]: []}).items():
        of = _windows(items.where(F.col("len").isin(held)), ["item_id"], F.col("tok"), family).withColumnRenamed("pos", "ipos")
        seeds = of if seeds is None else seeds.union(of)
    seeds = materialize(seeds, "decon-seeds")
    side = F.broadcast(seeds) if seeds.count() <= broadcast_hashes else seeds
    hits = (_windows(docs, ["doc_id", "th"], tokens("text"), used).join(side, "h")
            .select("doc_id", "th", "item_id", (F.col("pos") - F.col("ipos")).alias("diagonal")).distinct())
    hits = materialize(hits, "decon-hits")
    with_item = salted_join(hits, items.withColumnRenamed("tok", "item"), ["item_id"], F.struct("doc_id", "th", "diagonal"))
    cands = materialize(with_item.groupBy("doc_id", "th").agg(F.collect_list(F.struct("item_id", "len", "diagonal", "item")).alias("cands")),
                        "decon-candidates")
    # Texts without hits stay where they are; only the others move to their candidates.
    near = materialize(hits.select("th").distinct(), "decon-near")
    hit = docs.join(F.broadcast(near), "th", "left_semi") if near.count() <= broadcast_hashes else docs
    r, c = hit.alias("r"), cands.alias("c")
    same = (F.col("r.doc_id").eqNullSafe(F.col("c.doc_id"))) & (F.col("r.th") == F.col("c.th"))
    laid = (r.join(c, same).select("r.doc_id", "r.th", F.explode_outer(let(tokens("r.text"), lambda tok: F.transform(
        "cands", lambda x: _laid(tok, x, masks)))).alias("x")).where("x.n > 0"))
    covered = F.greatest(F.max("n"), F.size(F.array_distinct(F.flatten(F.collect_list("wide")))))
    per_item = (laid.select("doc_id", "th", "x.*").groupBy("doc_id", "th", "item_id", "len")
                .agg(covered.alias("covered")).withColumn("overlap", F.col("covered") / F.col("len")))
    if not short.isEmpty():
        per_item = per_item.select("doc_id", "th", "item_id", "overlap").union(_whole_runs(docs, short))
    verdict = materialize(per_item.groupBy("doc_id", "th").agg(
        F.max("overlap").alias("overlap"), F.min(F.struct(-F.col("overlap"), F.col("item_id").alias("item_id")))["item_id"].alias("item_id"),
        F.count_if(F.col("overlap") >= least).alias("n_items")), "decon-verdict")
    d, v = docs.select("doc_id", "th").alias("d"), verdict.alias("v")
    same = (F.col("d.doc_id").eqNullSafe(F.col("v.doc_id"))) & (F.col("d.th") == F.col("v.th"))
    return d.join(v, same, "left").select(
        "d.doc_id", (F.coalesce("v.n_items", F.lit(0)) > 0).alias("contaminated"), F.coalesce("v.overlap", F.lit(0.0)).alias("overlap"),
        "v.item_id", F.coalesce("v.n_items", F.lit(0).cast("long")).alias("n_items"))


def _at(array: Column, i: Column) -> Column:
    """The element at ``i``, null outside the array (also below 0)."""
    return F.when(i >= 0, F.get(array, i))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows whose doc_id is contaminated; all columns stay. Rows without doc_id stay."""
    bad = materialize(contamination(docs, benchmark, **options).where("contaminated").select("doc_id").distinct(), "decon-bad")
    return docs.join(bad.hint("shuffle_hash"), "doc_id", "left_anti")

"""Mixing sources to target weights by hierarchical budgeting.

Leaves are (domain, language, source). A token budget runs down the tree: at each node it is shared among the children by
weight, a child's share is cut at its capacity (its tokens times ``max_epochs``), and what a short child leaves goes to its
siblings by weight; only what a whole node cannot hold is left to the node's own siblings, because a node's capacity is
that of its subtree. Shares are whole tokens: rounding remainders go to the largest fractions, ties by name.

A leaf repeats its documents for as many full epochs as its budget holds and takes, of one more epoch, the shortest prefix
of the seeded order (md5 of seed, epoch and doc_id) that holds the rest: the document in which the rest ends is cut after
its last token within it, so a leaf's tokens are its budget. The order of a leaf is cut into 4,096 buckets of the hash; whole buckets
before the crossing one need no sort, so a leaf with a third of all rows is no single task.

Null domain, language or source are the leaf value ``(none)``. Tokens are whitespace words; a null or empty text has none
and is never selected. Rows that repeat a doc_id each count. Extra columns stay. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lathe.llm.common import materialize

LEVELS = ("domain", "lang", "source")
SHARE = 0.5
MAX_EPOCHS = 4
SEED = 17
#: Domain of a source: a source without a rule is in domain ``general``. (expression over source, domain)
DOMAINS = ((r"^src(0|5|10|15)$", "web"), (r"^src(1|6|11|16)$", "books"), (r"^src(2|7|12|17)$", "code"))
#: Weights among siblings by (level, name); others weigh 10.
WEIGHTS = {("domain", "web"): 40, ("domain", "books"): 25, ("domain", "code"): 15, ("domain", "general"): 20,
           ("lang", "en"): 50, ("lang", "de"): 20, ("lang", "fr"): 20, ("lang", "es"): 10}
DEFAULT_WEIGHT = 10
WORD = r"[^\x20\x09-\x0D]++"
_BUCKET = 3  # hex digits


def domain_of(source: Column) -> Column:
    out = F.lit("general")
    for rule, name in reversed(DOMAINS):
        out = F.when(source.rlike(rule), F.lit(name)).otherwise(out)
    return out


def _weight(level: str, name: Column, weights: dict) -> Column:
    out = F.lit(DEFAULT_WEIGHT)
    for (at, value), w in weights.items():
        if at == level:
            out = F.when(name == value, F.lit(w)).otherwise(out)
    return out.cast("long")


def share_out(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``children`` (parent columns, ``name``, ``budget`` of the parent, ``cap``, ``weight``; whole numbers) with ``given``: the parent's
    budget shared by weight, no child above its cap, shortages to the siblings. A child of weight 0 gets nothing."""
    low = F.when(F.col("weight") > 0, F.col("cap")).otherwise(F.lit(0).cast("long"))
    kids = children.withColumn("cap", low)
    # In order of cap per weight the children that fill up come first; what is left is shared by the rest.
    order = [(F.col("cap") / F.greatest("weight", F.lit(1))).asc(), F.col(name).asc()]
    all_ = Window.partitionBy(*parent)
    up_to = all_.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kids = (kids.withColumn("cap_before", F.sum("cap").over(up_to) - F.col("cap"))
            .withColumn("weight_from", F.sum("weight").over(all_) - F.sum("weight").over(up_to) + F.col("weight"))
            .withColumn("full", (F.col("weight") == 0) | (F.expr("cap * cast(weight_from as decimal(38,0)) <= weight * cast(budget - cap_before as decimal(38,0))"))))
    rest_cap = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(all_)
    rest_weight = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(all_)
    kids = kids.withColumn("rest", F.greatest(F.col("budget") - rest_cap, F.lit(0))).withColumn("rest_weight", rest_weight)
    product = F.expr("weight * cast(rest as decimal(28,0))")
    kids = (kids.withColumn("floor", F.when(F.col("full"), F.col("cap")).otherwise(F.expr("cast((weight * cast(rest as decimal(28,0))) div rest_weight as long)")))
            .withColumn("part", F.when(F.col("full"), F.lit(-1).cast("decimal(38,0)")).otherwise(product % F.col("rest_weight").cast("decimal(28,0)"))))
    spare = F.col("rest") - F.sum(F.when(F.col("full"), 0).otherwise(F.col("floor"))).over(all_)
    rank = F.row_number().over(all_.orderBy(F.col("part").desc(), F.col(name).asc()))
    given = F.col("floor") + F.when(~F.col("full") & (rank <= spare), 1).otherwise(0)
    return kids.withColumn("given", given).select(*parent, name, F.col("given"))


def leaf_budgets(leaves: DataFrame, share: float, max_epochs: int, weights: dict) -> DataFrame:
    """``(domain, lang, source, tokens, budget)`` from ``(domain, lang, source, tokens)``; the root's budget is
    ``share`` of all tokens, rounded down."""
    caps = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    nodes = leaves.agg(F.floor(F.coalesce(F.sum("tokens"), F.lit(0)) * F.lit(share)).cast("long").alias("budget")).withColumn("root", F.lit(0))
    parent = ["root"]
    caps = caps.withColumn("root", F.lit(0))
    for level in LEVELS:
        kids = caps.groupBy(*parent, level).agg(F.sum("cap").alias("cap")).withColumn("weight", _weight(level, F.col(level), weights))
        nodes = share_out(kids.join(nodes, parent), parent, level).withColumnRenamed("given", "budget")
        parent = [*parent, level]
    return leaves.join(nodes.drop("root"), list(LEVELS))


def first_tokens(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th token."""
    pieces = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*+" + WORD), F.lit(0))
    return F.array_join(F.slice(pieces, F.lit(1), n.cast("int")), "")


def select_mixture(docs: DataFrame, share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED, weights: dict | None = None,
                   domain: Column | None = None) -> DataFrame:
    """The selected documents, once per epoch in which they are taken: the columns of ``docs`` and ``mix_domain``,
    ``mix_tokens`` (the tokens taken) and ``mix_epoch`` (0 for the first); columns of those names in ``docs`` are replaced.
    The text of a cut document ends after its last token taken, and its ``n_chars``, if there is such a column, is the length of that."""
    docs = docs.drop("mix_domain", "mix_tokens", "mix_epoch")
    # The columns of the data travel under numbers, so they cannot clash with the working columns.
    held = {c: f"in_{i}" for i, c in enumerate(docs.columns)}
    name = {c: F.coalesce(F.col(c), F.lit("(none)")) for c in ("lang", "source")}
    docs = docs.select(*[F.col(f"`{c}`").alias(h) for c, h in held.items()], F.coalesce(domain if domain is not None else domain_of(F.col("source")), F.lit("(none)")).alias("mix_domain"),
                       name["lang"].alias("mix_lang"), name["source"].alias("mix_source"), F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("mix_tokens"))
    leaf = ["mix_domain", "mix_lang", "mix_source"]
    sums = docs.where("mix_tokens > 0").groupBy(*leaf).agg(F.sum("mix_tokens").alias("tokens"))
    leaves = materialize(sums.select(*[F.col(c).alias(n) for c, n in zip(leaf, LEVELS, strict=True)], "tokens"), "mix-leaves")
    plan = leaf_budgets(leaves, share, max_epochs, WEIGHTS if weights is None else weights)
    plan = materialize(plan.select(*[F.col(n).alias(c) for c, n in zip(leaf, LEVELS, strict=True)],
                                   F.expr("cast(budget div tokens as int)").alias("epochs"), F.expr("budget % tokens").alias("rest")), "mix-plan")
    # The plan has one row per leaf; as a written table it is broadcast when Spark's own size limit allows, else shuffled.
    rows = docs.where("mix_tokens > 0").join(plan, leaf).withColumn(
        "mix_key", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("epochs").cast("string"), F.coalesce(F.col(held["doc_id"]).cast("string"), F.lit("")))))
    rows = rows.withColumn("mix_bucket", F.substring("mix_key", 1, _BUCKET))
    sizes = rows.where("rest > 0").groupBy(*leaf, "mix_bucket", "rest").agg(F.sum("mix_tokens").alias("n"))
    run = F.sum("n").over(Window.partitionBy(*leaf).orderBy("mix_bucket"))
    crossing = materialize(sizes.withColumn("before", run - F.col("n")).where("before < rest and before + n >= rest")
                           .select(*leaf, F.col("mix_bucket").alias("cross"), "before"), "mix-crossing")
    rows = rows.join(crossing, leaf, "left")
    full = rows.withColumn("take", F.when(F.col("mix_bucket") < F.col("cross"), F.col("epochs") + 1).otherwise(F.col("epochs")))
    whole = full.where("cross is null or mix_bucket <> cross").withColumn("last", F.col("mix_tokens"))
    seen = Window.partitionBy(*leaf, "mix_bucket").orderBy("mix_key", held["doc_id"], "mix_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = full.where("mix_bucket = cross").withColumn("at", F.col("before") + F.sum("mix_tokens").over(seen) - F.col("mix_tokens"))
    edge = edge.withColumn("take", F.when(F.col("at") < F.col("rest"), F.col("epochs") + 1).otherwise(F.col("epochs")))
    edge = edge.withColumn("last", F.when(F.col("at") < F.col("rest"), F.least("mix_tokens", F.col("rest") - F.col("at"))).otherwise(F.col("mix_tokens"))).drop("at")
    both = whole.unionByName(edge).where("take > 0")
    both = both.select(*held.values(), "mix_domain", "mix_tokens", "take", "last", F.explode(F.sequence(F.lit(0), F.col("take") - 1)).alias("mix_epoch"))
    both = both.withColumn("taken", F.when(F.col("mix_epoch") == F.col("take") - 1, F.col("last")).otherwise(F.col("mix_tokens")))
    cut = F.col("taken") < F.col("mix_tokens")
    text = F.when(cut, first_tokens(F.col(held["text"]), F.col("taken"))).otherwise(F.col(held["text"]))
    out = {c: F.col(h) for c, h in held.items()} | {"text": text}
    if "n_chars" in held:
        kind = docs.schema[held["n_chars"]].dataType
        out["n_chars"] = F.when(cut, F.length(text).cast(kind)).otherwise(F.col(held["n_chars"]))
    return both.select(*[v.alias(c) for c, v in out.items()], "mix_domain", F.col("taken").alias("mix_tokens"), "mix_epoch")

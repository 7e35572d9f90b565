"""URL filters: pattern rules indexed by their rarest literal token (DataFrame functions only).

A rule is a regular expression over ``host + path`` together with the literal tokens that any match must contain as
whole tokens (runs of a-z and 0-9). Each rule is filed under the token that is rarest in the URLs at hand. A URL's
distinct tokens fetch their candidate rules, and only those run their expressions; a rule without a literal token is a
candidate of every URL. Of the site rules that fit, the longest ``host + path`` decides; without one, a URL is blocked
if a pattern fits and allowed otherwise.

A null URL, or one without ``://``, has empty host and path: no rule fits, and it is allowed. Equal (page_id, url) rows
are judged once and returned once per row. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathe.llm.common import ascii_lower, materialize, salted_join

#: (verdict, host, path): a rule fits its host and all subdomains when the path starts with the rule's.
SITE_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
              ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: (expression over host + path, literal tokens it needs).
PATTERNS = ((r"(^|\.)spam-farm\.", ("spam", "farm")), (r"(^|\.)ad(server|click)\.", ()),
            (r"/(casino|betting)(/|$)", ()), (r"/tracker\.js$", ("tracker", "js")), (r"/promo/[0-9]+/click", ("promo", "click")))


def literal_tokens(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def url_parts(url) -> tuple[Column, Column]:
    """(host, path): host between the first ``://`` and ``/ ? #`` with A-Z lower-cased, path up to ``? #``."""
    u = F.coalesce(F.col(url), F.lit(""))
    found = F.locate("://", u)
    rest = F.when(found > 0, u.substr(found + 3, F.length(u))).otherwise(F.lit(""))
    bare = F.regexp_extract(rest, r"^([^?#]*)", 1)
    host = F.regexp_extract(bare, r"^([^/]*)", 1)
    return ascii_lower(host), bare.substr(F.length(host) + 1, F.length(bare))


def rule_table(spark, site_rules=SITE_RULES, patterns=PATTERNS) -> DataFrame:
    """``(rule_id, rule, verdict, regex, tokens)``; ``rule`` is null for patterns."""
    rows = []
    for verdict, host, path in site_rules:
        whole = re.findall("[a-z0-9]+(?=/)", path.lower())  # a path's last token may go on in the URL unless it ends in /
        rows.append((f"{host}{path}", verdict, rf"^([^/]*\.)?\Q{host}\E\Q{path}\E", literal_tokens(host) + whole))
    rows += [(None, "block", regex, list(tokens)) for regex, tokens in patterns]
    cols = [F.struct(F.lit(i).alias("rule_id"), F.lit(r).cast("string").alias("rule"), F.lit(v).alias("verdict"), F.lit(x).alias("regex"),
                     (F.array(*map(F.lit, t)) if t else F.array().cast("array<string>")).alias("tokens")) for i, (r, v, x, t) in enumerate(rows)]
    return spark.range(1).select(F.explode(F.array(*cols)).alias("r")).select("r.*")


def judge_urls(pages: DataFrame, site_rules=SITE_RULES, patterns=PATTERNS) -> DataFrame:
    """``(page_id, host, path, rule, verdict, n_candidates)``, one row per input row."""
    host, path = url_parts("url")
    pages = pages.select("page_id", "url")
    urls = materialize(pages.distinct().select("page_id", "url", host.alias("host"), path.alias("path")), "url-parts")
    tokens = F.array_distinct(F.regexp_extract_all(ascii_lower(F.concat("host", "path")), F.lit("[a-z0-9]+"), F.lit(0)))
    spread = urls.select("page_id", "url", "host", "path", F.explode(F.array_append(tokens, F.lit(""))).alias("token"))
    frequency = materialize(spread.groupBy("token").count(), "url-tokens")
    rules = rule_table(pages.sparkSession, site_rules, patterns)
    filed = (rules.select("rule_id", F.explode_outer("tokens").alias("token")).join(frequency, "token", "left")
             .groupBy("rule_id").agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), F.coalesce("token", F.lit("")).alias("token"))).alias("rarest"))
             .select("rule_id", "rarest.token"))
    index = materialize(rules.join(filed, "rule_id").select("token", "rule", "verdict", "regex"), "url-index")
    tried = salted_join(spread, index, ["token"], F.struct("page_id", "url"))
    fits = F.expr("concat(host, path) rlike regex")
    best = F.max(F.when(F.col("fits") & F.col("rule").isNotNull(), F.struct(F.length("rule").alias("l"), "verdict", "rule")))
    judged = materialize(tried.withColumn("fits", fits).groupBy("page_id", "url").agg(
        best.alias("best"), F.bool_or(F.col("fits") & F.col("rule").isNull()).alias("pattern"), F.count("*").alias("n_candidates")), "url-judged")
    p, j = pages.select("page_id", "url", host.alias("host"), path.alias("path")).alias("p"), judged.alias("j")
    same = F.col("p.page_id").eqNullSafe(F.col("j.page_id")) & F.col("p.url").eqNullSafe(F.col("j.url"))
    return p.join(j, same, "left").select(
        "p.page_id", "p.host", "p.path", F.col("j.best.rule").alias("rule"),
        F.coalesce("j.best.verdict", F.when(F.col("j.pattern"), F.lit("block")), F.lit("allow")).alias("verdict"),
        F.coalesce("j.n_candidates", F.lit(0).cast("long")).alias("n_candidates"))


def keep_allowed(pages: DataFrame, **options) -> DataFrame:
    """``pages`` without the rows of a (page_id, url) that is blocked; all columns stay."""
    host, path = url_parts("url")
    bad = materialize(judge_urls(pages, **options).where("verdict = 'block'").select("page_id", "host", "path").distinct(), "url-blocked").alias("b")
    p = pages.alias("p")
    same = F.col("p.page_id").eqNullSafe(F.col("b.page_id")) & (host == F.col("b.host")) & (path == F.col("b.path"))
    return p.join(bad, same, "left_anti")

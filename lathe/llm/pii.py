"""Information-theoretic sanitisation of personal data (DataFrame functions only).

Protected entities are the personal values found by pattern: e-mail, IP, card (Luhn) and phone numbers, however they are written
(letters in lower case, numbers as their digits). A value that stands in one text alone gives no statistics, so its parts are
entities too: local part, domain and last two labels of the domain of an e-mail, first three and first two parts of an IP, first
six digits of a card, all but the last four and all but the last seven digits of a phone number. A part that more than one in ``COMMON`` documents hold identifies nobody and is none. Terms that accompany
an entity can give it away even when the value itself is masked. Over the whole corpus, a term t discloses an entity e by

    PMI(t; e) / IC(e) = log(df(t, e) * N / (df(t) * df(e))) / log(N / df(e)),

the share of e's information that seeing t reveals (1: t occurs only with e). Both df count documents: t counts as with e
when one document holds both, however far apart. In every document that holds e, each occurrence of a term at or above
``generalise`` becomes ``[TERM]``, at or above ``remove`` it vanishes; pairs seen in fewer than ``support`` different texts are no
evidence. Terms are all words outside the entities, of letters and digits with inner hyphens and apostrophes; of scripts written
without spaces, pieces of two characters. Case does not tell terms apart.

Offsets are code points, end exclusive. Null or empty texts have no spans. Rows are judged by (doc_id, text); repeated
rows each get their result. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathe.llm.common import let, materialize, salted_join

#: Kinds in the order that breaks ties between spans with one start.
KINDS = ("email", "ip", "card", "phone", "term", "drop")
# Fixed patterns, written so that matching is linear: a run of local-part or digit characters is entered at its start or
# where the last match ended, and groups are possessive (nothing after them could use what they give back).
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
_DENSE = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
_SPACED = rf"[\p{{L}}\p{{M}}\p{{N}}&&[^{_DENSE}]]"
TERM = rf"{_SPACED}++(?:['\u2019-]{_SPACED}++)*+|[{_DENSE}]{{1,2}}"
_OPEN, _CLOSE = "\x01", "\x02"
#: Matches of a text are put together in blocks of this many: appending to one long array copies it each time.
BLOCK = 500
GENERALISE, REMOVE, SUPPORT, COMMON = 0.75, 0.999, 2, 20
#: Hashes of texts with terms to replace are broadcast up to this many, and entities and flagged terms up to so many rows. Size on
#: disk, by which the planner would choose, says little of rows in the driver's memory: a file of words may hold ten times its size.
BROADCAST_TEXTS = 1_000_000
BROADCAST_ROWS = 100_000


def _plain(text: Column) -> Column:
    """The text without the two characters used as marks (one character for another: offsets stay)."""
    return F.translate(F.coalesce(text, F.lit("")), _OPEN + _CLOSE, "\x03\x03")


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, value) of the leftmost non-overlapping matches in a text without marks."""
    parts = F.split(F.regexp_replace(text, pattern, f"{_OPEN}$0{_CLOSE}"), _OPEN)

    empty = F.array().cast("array<struct<start:int,value:string>>")

    def block(at: Column, p: Column) -> Column:
        return F.aggregate(p, F.struct(at.alias("at"), empty.alias("out")),
                           lambda acc, x: F.struct((acc["at"] + F.length(x) - 1).alias("at"),
                                                   F.array_append(acc["out"], F.struct(acc["at"].alias("start"), F.substring_index(x, _CLOSE, 1).alias("value"))).alias("out")))

    def walk(p: Column) -> Column:
        starts = F.sequence(F.lit(2), F.greatest(F.size(p), F.lit(2)), F.lit(BLOCK))
        step = F.aggregate(starts, F.struct(F.length(p[0]).alias("at"), F.array().cast("array<array<struct<start:int,value:string>>>").alias("out")),
                           lambda acc, i: let(block(acc["at"], F.slice(p, i, F.lit(BLOCK))),
                                              lambda b: F.struct(b["at"].alias("at"), F.array_append(acc["out"], b["out"]).alias("out"))))
        return F.flatten(step["out"])
    return F.when(text.rlike(pattern), let(parts, walk)).otherwise(F.array().cast("array<struct<start:int,value:string>>"))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True when the digit string passes the Luhn sum."""
    n = F.length(digits)

    def part(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when((n - i) % 2 == 1, twice).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + part(i)) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(f"^(?:{_BYTE}\\.){{3}}{_BYTE}$")
    if kind == "card":
        return let(_digits(value), lambda d: F.when(F.length(d).between(14, 19), luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Array of (start, kind, end, value), kind as an index into KINDS, sorted by start, then kind."""
    def of(kind: str, plain: Column) -> Column:
        found = F.filter(matches(plain, PATTERNS[kind]), lambda m: valid(kind, m["value"]))
        return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
                                                     (m["start"] + F.length(m["value"])).alias("end"), m["value"].alias("value")))
    return let(_plain(text), lambda plain: F.array_sort(F.concat(*[of(k, plain) for k in PATTERNS])))


def _blanked(text: Column, base: Column) -> Column:
    """The text between two spaces, each character of its entities a space."""
    def step(acc: Column, s: Column) -> Column:
        first = F.greatest(acc["at"], s["start"])
        out = F.concat(acc["out"], F.array(F.substring(text, acc["at"] + 1, first - acc["at"]), F.repeat(F.lit(" "), F.greatest(s["end"] - first, F.lit(0)))))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))
    done = F.aggregate(base, F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")), step)
    bare = F.when(F.size(base) == 0, text).otherwise(let(done, lambda d: F.concat(F.array_join(d["out"], ""), F.substring(text, d["at"] + 1, F.length(text)))))
    return F.concat(F.lit(" "), bare, F.lit(" "))


def _entities(base: Column) -> Column:
    """Distinct keys of the entities and their parts; those of parts begin with ``~``."""
    def key(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}:"), value)

    def keys(kind: Column, v: Column, d: Column) -> Column:
        address = F.regexp_replace(v, r"(?<![0-9])0+(?=[0-9])", "")
        return (F.when(kind == 0, F.array(key("email", v), key("~local", F.substring_index(v, "@", 1)), key("~domain", F.substring_index(v, "@", -1)),
                                         key("~site", F.substring_index(F.substring_index(v, "@", -1), ".", -2))))
                .when(kind == 1, F.array(key("ip", address), key("~net", F.substring_index(address, ".", 3)), key("~range", F.substring_index(address, ".", 2))))
                .when(kind == 2, F.array(key("card", d), key("~issuer", F.substring(d, 1, 6))))
                .otherwise(F.array(key("phone", d), key("~exchange", F.substring(d, F.lit(1), F.length(d) - 4)),
                                    key("~area", F.substring(d, F.lit(1), F.length(d) - 7)))))
    return F.array_distinct(F.flatten(F.transform(base, lambda s: keys(s["kind"], F.lower(s["value"]), _digits(s["value"])))))


def occurrences(docs: DataFrame) -> DataFrame:
    """``(doc_id, th, entities, terms)`` of the documents that hold entities; terms as an array of (start, end, term)."""
    def terms(t: Column, base: Column) -> Column:
        return F.transform(matches(_blanked(t, base), TERM), lambda m: F.struct(
            (m["start"] - 1).alias("start"), (m["start"] - 1 + F.length(m["value"])).alias("end"), F.lower(m["value"]).alias("term")))

    def held(t: Column, base: Column) -> Column:
        return F.when(F.size(base) > 0, F.struct(_entities(base).alias("entities"), terms(t, base).alias("terms")))
    found = let(_plain(F.col("text")), lambda t: let(base_spans(t), lambda base: held(t, base)))
    # The outer form: a filter on the column would compute it a second time.
    return (docs.select("doc_id", F.xxhash64("text").alias("th"), F.explode_outer(F.array(found)).alias("o"))
            .where("o is not null").select("doc_id", "th", "o.*").dropDuplicates(["doc_id", "th"]))


def _joined(big: DataFrame, small: DataFrame, on: list[str], spread: Column) -> DataFrame:
    """``big`` joined with the written table ``small``, which is broadcast once where it has few rows and else never: hot keys
    of ``big`` are then dealt over several tasks."""
    if small.count() <= BROADCAST_ROWS:
        return big.join(F.broadcast(small), on)
    return salted_join(big, small.hint("merge"), on, spread)


def together(found: DataFrame, entities: DataFrame) -> DataFrame:
    """``(doc_id, th, entity, start, end, term)``: all terms of the documents that hold one of the entities."""
    few = entities.count() <= BROADCAST_ROWS
    held = found.select("doc_id", "th", F.explode("entities").alias("entity"), *(["terms"] if few else []))
    held = _joined(held, entities.select("entity"), ["entity"], F.col("doc_id"))
    if not few:  # a document's terms move once, not with each of its entities
        kept = held.groupBy("doc_id", "th").agg(F.collect_list("entity").alias("kept")).hint("merge").alias("k")
        same = F.col("f.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("f.th") == F.col("k.th"))
        held = found.alias("f").join(kept, same).select("f.doc_id", "f.th", F.explode("k.kept").alias("entity"), "f.terms")
    return held.select("doc_id", "th", "entity", F.explode("terms").alias("t")).select("doc_id", "th", "entity", "t.*")


def disclosing_terms(docs: DataFrame, found: DataFrame, entities: DataFrame, generalise: float, remove: float, support: int) -> DataFrame:
    """``(entity, term, kind)`` of the pairs whose disclosed share reaches a threshold. ``entities`` has the number of all
    documents as ``n``."""
    pairs = (together(found, entities).select("doc_id", "th", "entity", "term").distinct()
             .groupBy("entity", "term").agg(F.count("*").alias("df_te"), F.count_distinct("th").alias("texts")).where(F.col("texts") >= support))
    pairs = materialize(pairs, "pii-pairs")
    all_terms = let(_plain(F.col("text")), lambda t: let(base_spans(t), lambda base: F.regexp_extract_all(F.lower(_blanked(t, base)), F.lit(TERM), F.lit(0))))
    df_t = (docs.select(F.explode_outer(F.array_distinct(all_terms)).alias("term"))
            .where("term is not null").groupBy("term").agg(F.count("*").alias("df_t")))
    # An inner join: a semi-join would be moved below the aggregation and shuffle every word of every document.
    terms = df_t.join(pairs.select("term").distinct().hint("merge"), "term")
    share = F.log(F.col("df_te") * F.col("n") / (F.col("df_t") * F.col("df_e"))) / F.log(F.col("n") / F.col("df_e"))
    small = F.broadcast(entities) if entities.count() <= BROADCAST_ROWS else entities.hint("merge")
    return (pairs.join(terms.hint("merge"), "term").join(small, "entity").where("n > df_e")
            .withColumn("share", share).where(F.col("share") >= generalise)
            .select("entity", "term", F.when(F.col("share") >= remove, KINDS.index("drop")).otherwise(KINDS.index("term")).alias("kind")))


def _rewrite(text: Column, spans: Column) -> Column:
    """The text with its spans replaced, first span first; what a span shares with an earlier one is already gone."""
    labels = F.array(F.lit("[EMAIL]"), F.lit("[IP]"), F.lit("[CARD]"), F.lit("[PHONE]"), F.lit("[TERM]"), F.lit(""))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        keep = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        out = F.concat(acc["out"], F.array(keep, F.get(labels, s["kind"])))
        return F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), out.alias("out"))).otherwise(
            F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out")))
    done = F.aggregate(spans, start, step)
    return let(done, lambda d: F.concat(F.array_join(d["out"], ""), F.substring(text, d["at"] + 1, F.length(text))))


def sanitise(docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE, support: int = SUPPORT,
             common: int = COMMON) -> DataFrame:
    """``(doc_id, base, spans, clean_text)``, one row per input row: base and all spans as arrays of (start, kind, end),
    and the text with entities masked and disclosing terms generalised or removed."""
    docs = docs.select("doc_id", "text")
    found = materialize(occurrences(docs), "pii-occurrences")
    # Entities in fewer texts have no pair with support.
    entities = materialize(found.select("th", F.explode("entities").alias("entity")).groupBy("entity")
                           .agg(F.count("*").alias("df_e"), F.count_distinct("th").alias("texts")).where(F.col("texts") >= support).drop("texts")
                           .withColumn("n", F.lit(docs.count()).cast("long")).where((F.substring("entity", 1, 1) != "~") | (F.col("df_e") * common <= F.col("n"))),
                           "pii-entities")
    flagged = materialize(disclosing_terms(docs, found, entities, generalise, remove, support), "pii-flagged")
    hits = _joined(together(found, entities), flagged, ["entity", "term"], F.struct("doc_id", "start"))
    extra = materialize(hits.groupBy("doc_id", "th", "start", "end").agg(F.max("kind").alias("kind"))
                        .groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "kind", "end")).alias("extra")), "pii-extra")
    # Texts without terms to replace stay where they are; only the others move to their terms.
    docs = docs.withColumn("th", F.xxhash64("text"))
    near = materialize(extra.select("th").distinct(), "pii-near")
    few = near.count() <= BROADCAST_TEXTS
    d, x = (docs.join(F.broadcast(near), "th", "left_semi") if few else docs).alias("d"), extra.hint("merge").alias("x")
    same = F.col("d.doc_id").eqNullSafe(F.col("x.doc_id")) & (F.col("d.th") == F.col("x.th"))
    rows = d.join(x, same, "left").select("d.doc_id", "d.text", "x.extra")
    if few:
        rest = docs.join(F.broadcast(near), "th", "left_anti")
        rows = rows.union(rest.select("doc_id", "text", F.lit(None).cast(extra.schema["extra"].dataType).alias("extra")))
    base = F.transform(base_spans(F.col("text")), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    more = F.coalesce("extra", F.array().cast("array<struct<start:int,kind:int,end:int>>"))
    spans = let(base, lambda b: F.struct(b.alias("base"), F.array_sort(F.concat(b, more)).alias("spans")))
    both = let(spans, lambda s: F.struct(s["base"].alias("base"), s["spans"].alias("spans"), _rewrite(F.coalesce("text", F.lit("")), s["spans"]).alias("clean_text")))
    return rows.select("doc_id", both.alias("o")).select("doc_id", "o.*")


def count_of(spans, kind: str) -> Column:
    """Number of spans of a kind (``filter`` hands a second parameter of its function, even one with a default, the index)."""
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind)))


def span_digest(spans) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

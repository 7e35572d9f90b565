"""Spelling variants: words one inserted, deleted or replaced character apart, found by permuterm rotations.

Each word is written as all rotations of ``word + mark``. The rotation that starts behind character i ends in that
character, so what comes before it is a prefix that skips the edited character: words that differ by a replacement at i
share it, and the word without that character is the prefix itself. Rotations are sorted within their prefix ranges (a
window by prefix and place of the mark), each range is scanned once, and every member gets its number of neighbours there
and the best neighbour other than itself, so no pair is written out. A range has at most one member per character of the
alphabet and one more, whatever the corpus, so no range is hot. A word without its i-th character is the same for every i
in a run of equal characters; it is counted at the first one.

Words are compared by code point. Null texts hold no words; a null id counts as an empty text in the draw of deletions;
repeated rows count again; empty words and null words are ignored; an empty table gives no words. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lathe.llm.common import ascii_lower, materialize

RUN = r"[A-Za-zÀ-ÿ]+"
MARK = "$"
#: One of so many (id, run) keys loses a character: a fixed, seedless source of misspellings.
DRAW = 97


def runs(docs: DataFrame, draw: int | None = DRAW) -> DataFrame:
    """``(word)``, one row per maximal run of letters, A-Z lower-cased. With ``draw``, a run whose key ``id:run`` has a
    crc32 h divisible by it loses its code point h modulo its length."""
    out = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), 0)).alias("word")) \
              .select("doc_id", ascii_lower(F.col("word")).alias("word"))
    if draw is None:
        return out.select("word")
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word"))
    h = F.crc32(key.cast("binary"))
    at = (h % F.length("word")).cast("int")
    cut = F.concat(F.substring(F.col("word"), F.lit(1), at), F.substring(F.col("word"), at + 2, F.length("word")))
    return out.select(F.when(h % draw == 0, cut).otherwise(F.col("word")).alias("word"))


def word_counts(words: DataFrame, least_length: int = 5, least_count: int = 3) -> DataFrame:
    """``(word, n)`` of the words of at least ``least_length`` code points that occur ``least_count`` times or more."""
    return (words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= least_count))


def rotations(words: DataFrame) -> DataFrame:
    """``(prefix, place, edit, n)`` of ``words(word, n)``: ``prefix`` is a rotation, without its last character ``edit`` if
    it has one; ``place`` characters follow the mark in it, which tells the mark from the same character in a word."""
    w, size = F.col("word"), F.length("word")
    whole = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(
        F.concat(w.substr(i + 1, size), F.lit(MARK), w.substr(F.lit(1), i)).alias("prefix"), i.alias("place"), F.lit(None).cast("string").alias("edit")))
    wild = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(
        F.concat(w.substr(i + 2, size), F.lit(MARK), w.substr(F.lit(1), i)).alias("prefix"), i.alias("place"), w.substr(i + 1, F.lit(1)).alias("edit")))
    return words.where("word <> ''").select("n", F.explode(F.concat(whole, wild)).alias("r")).select("r.prefix", "r.place", "r.edit", "n")


def neighbours(words: DataFrame) -> DataFrame:
    """``(word, n_near, near, near_n)`` of the words in ``words(word, n)`` that have a neighbour: their number, and the one
    of largest n (ties: the smallest)."""
    group = Window.partitionBy("prefix", "place")
    head = F.length("prefix") - F.col("place") - 1  # characters of the word behind the edited one
    word = F.concat(F.substring(F.col("prefix"), head + 2, F.col("place")), F.coalesce("edit", F.lit("")),
                    F.substring(F.col("prefix"), F.lit(1), head))
    # no count for the whole word where the character before the edited one equals it: they met there already
    first = F.col("edit").isNotNull() & ((F.col("place") == 0) | (F.col("edit") != F.substring(F.col("prefix"), -1, 1)))
    ranged = (rotations(words).withColumn("members", F.count("*").over(group)).where("members > 1")
              .withColumn("word", word).withColumn("first", first))
    scan = group.orderBy(F.col("n").desc(), "word").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wilds, met = F.count("edit").over(group), F.count_if("first").over(group)
    hit = F.struct("word", "n")
    best = (ranged.withColumn("one", F.first(hit).over(scan)).withColumn("two", F.nth_value(hit, 2).over(scan))
            .withColumn("wilds", wilds).withColumn("met", met))
    near = F.when(F.col("one.word") == F.col("word"), F.col("two")).otherwise(F.col("one"))
    count = F.when(F.col("edit").isNull(), F.col("met")).otherwise(
        F.col("wilds") - 1 + F.when(F.col("first") & (F.col("members") > F.col("wilds")), 1).otherwise(0))
    found = best.select("word", count.alias("count"), near.alias("near"))
    # largest n first, then the smallest word: max_by over (n, -) needs the reverse order of words, so min_by over (-n, word)
    return (found.groupBy("word").agg(F.sum("count").alias("n_near"), F.min(F.struct((-F.col("near.n")).alias("m"), F.col("near.word").alias("word"))).alias("near"))
            .select("word", "n_near", F.col("near.word").alias("near"), (-F.col("near.m")).alias("near_n")))


def spelling_groups(words: DataFrame, ratio: int = 2) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of ``words(word, n)``. The form is the best neighbour if it occurs at least
    ``ratio`` times as often; the root is where following forms ends, the word itself if it has none."""
    words = materialize(words.where("word is not null").select("word", "n"), "spell-words")
    near = words.join(neighbours(words), "word", "left")
    is_form = F.col("near_n") >= ratio * F.col("n")
    forms = materialize(near.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                    F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n")), "spell-forms")
    # every step at least doubles n, so a chain has at most 63 steps and six rounds of doubling end it
    up = materialize(forms.where("form is not null").select("word", F.col("form").alias("top")), "spell-up")
    while True:
        over = up.select(F.col("word").alias("top"), F.col("top").alias("next"))
        step = materialize(up.join(over, "top", "left").select("word", F.coalesce("next", "top").alias("top"), F.col("next").isNotNull().alias("moved")), "spell-up")
        up = step.select("word", "top")
        if step.where("moved").isEmpty():
            break
    return forms.join(up, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("top", "word").alias("root"))

"""Line-first cleaning with DataFrame functions only.

Every line is judged by punctuation, navigation and boilerplate rules; failing lines go; a document that
loses too much of its words that way, or breaks a rule on the whole text, is rejected.

Defined results: a null text counts as empty; empty and blank texts have no words and fail the minimum.
Repeated rows are judged alike and each stays a row. Extra columns play no part. An empty table gives an
empty result. Very long texts are judged whole: all steps are linear or n log n in the words of the row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, pick

# Symbols that mark broken text, and phrases of page furniture and licences.
SYMBOLS = "#*$%&|<>"
SEPARATORS = "|»›>•·"
SENTENCE_MARKS = ".,;:!?…。、！？؟।"
BOILERPLATE = (
    "all rights reserved", "licensed under", "released under the", "distributed under", "terms of use",
    "terms of service", "privacy policy", "cookie policy", "use cookies", "enable javascript",
    "lorem ipsum", "subscribe to our", "sign up for", "click here", "powered by",
)
NAVIGATION = (
    "home", "menu", "login", "log in", "sign in", "sign up", "register", "search", "contact", "contact us",
    "about", "about us", "next", "previous", "back to top", "skip to content", "share", "read more", "sitemap",
)


@dataclass(frozen=True)
class LineRules:
    """Limits. Shares are in percent so that comparisons stay in whole numbers."""

    min_words: int = 20
    max_repeated_words: int = 30      # percent of words in windows that occur more than once
    window: int = 8
    min_kept_words: int = 50          # percent of words that must survive line cleaning
    symbols_per_100_words: int = 50   # a line with more fails the punctuation rule
    separators: int = 3               # a line with so many separators that make up
    separator_share: int = 20         # this percent of its words or more is navigation


def _quoted(phrases: tuple[str, ...]) -> str:
    return "|".join(p.replace(".", r"\.") for p in phrases)


def _count(text: Column, characters: str) -> Column:
    """How many of the characters a text holds; most texts hold none, which a plain scan tells."""
    pattern = "[" + "".join("\\" + c if c in "[]^\\-&" else c for c in characters) + "]"
    return F.when(text.rlike(pattern), F.regexp_count(text, F.lit(pattern))).otherwise(F.lit(0))


def repeated_words(words: Column, width: int) -> Column:
    """Words covered by windows of ``width`` words that occur at least twice in the array.

    Window hashes and their positions are sorted; neighbours with equal hashes are repeats; the covered
    words are summed along the sorted positions. Nothing leaves the row, and rows without an equal pair,
    seen by a hash set, skip all of that. Two seeds make 128 bits, so distinct windows stay distinct.
    """
    count = F.size(words) - F.lit(width - 1)
    hashes = F.transform(F.sequence(F.lit(1), count), lambda i: F.xxhash64(F.slice(words, i, width)))

    def covered(found: Column) -> Column:
        pairs = F.array_sort(F.transform(
            found, lambda h, i: F.struct(
                h.alias("h"), F.xxhash64(F.lit(7), F.slice(words, i + 1, width)).alias("g"), i.alias("i"))))
        return F.aggregate(
            F.array(pairs), F.lit(0), lambda total, p: total + _cover(_repeats(p), width))

    # aggregate() over one-element arrays names an intermediate value, so it is computed once.
    return F.when(count < 2, F.lit(0)).otherwise(F.aggregate(
        F.array(hashes), F.lit(0),
        lambda total, h: total + F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))))


def _repeats(pairs: Column) -> Column:
    """Sorted positions of the entries that equal a neighbour."""
    def same(a: Column, b: Column) -> Column:
        return (a["h"] == b["h"]) & (a["g"] == b["g"])

    nexts = F.slice(pairs, 2, F.size(pairs))
    to_next = F.zip_with(pairs, nexts, lambda a, b: F.coalesce(same(a, b), F.lit(False)))
    from_last = F.concat(F.array(F.lit(False)), F.slice(to_next, 1, F.size(pairs) - 1))
    flagged = F.zip_with(pairs, F.zip_with(to_next, from_last, lambda a, b: a | b),
                         lambda p, f: F.when(f, p["i"]))
    return F.array_sort(F.filter(flagged, lambda i: i.isNotNull()))


def _cover(positions: Column, width: int) -> Column:
    """Number of words under windows that start at the sorted positions."""
    start = F.struct(F.lit(0).alias("n"), F.lit(-(1 << 30)).alias("last"))
    return F.aggregate(
        positions, start,
        lambda acc, i: F.struct(
            (acc["n"] + F.least(F.lit(width), i - acc["last"])).cast("int").alias("n"), i.alias("last")),
        lambda acc: acc["n"])


def line_passes(line: Column, n_words: Column, rules: LineRules) -> Column:
    """The rules of one line with at least one word."""
    low = F.lower(F.trim(line))
    punctuation = line.rlike(f"[{SENTENCE_MARKS}]") & (
        _count(line, SYMBOLS) * 100 <= n_words * rules.symbols_per_100_words)
    separators = _count(line, SEPARATORS)
    navigation = low.rlike(rf"^[^a-z]*(?:{_quoted(NAVIGATION)})[^a-z]*$") | (
        (separators >= rules.separators) & (separators * 100 >= n_words * rules.separator_share))
    boilerplate = low.rlike(_quoted(BOILERPLATE))
    return punctuation & ~navigation & ~boilerplate


def words_by_line(frame: DataFrame, text: str) -> DataFrame:
    """Adds ``line`` (the lines of the text) and ``line_words`` (the words of each).

    A text without white space but spaces and line feeds is split at single spaces, which needs no pattern.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    at = F.when(value.rlike(r"[\t\x0B\f\r]"), F.lit(SPACE)).otherwise(F.lit(" "))
    return frame.withColumn("line", F.split(value, "\n")).withColumn("_at", at).withColumn(
        "line_words", F.transform("line", lambda x: F.filter(F.split(x, F.col("_at")), lambda w: w != F.lit("")))).drop("_at")


def clean_lines(frame: DataFrame, text: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """Adds ``lines`` (line, words, passes), ``cleaned`` (passing lines) and ``kept_words``, and the words by line.

    Blank lines stay where they are: they hold nothing to judge.
    """
    split = words_by_line(frame, text)
    judged = F.zip_with("line", F.transform("line_words", lambda w: F.size(w)), lambda x, n: F.struct(
        x.alias("line"), n.alias("words"), ((n == 0) | line_passes(x, n, rules)).alias("passes")))
    with_lines = split.withColumn("lines", judged).drop("line")
    passing = F.filter("lines", lambda x: x["passes"])
    return (with_lines
            .withColumn("cleaned", F.array_join(F.transform(passing, lambda x: x["line"]), "\n"))
            .withColumn("kept_words", F.aggregate(passing, F.lit(0), lambda n, x: n + x["words"])))


def judge(documents: DataFrame, rules: LineRules = LineRules(), doc_id: str = "doc_id",
          text: str = "text") -> DataFrame:
    """One row per document: its measures, the cleaned text, and whether it is kept."""
    docs = pick(documents, doc_id=doc_id, text=text)
    value = F.coalesce(F.col("text"), F.lit(""))
    measured = clean_lines(docs, "text", rules).withColumn("words", F.flatten("line_words")).drop("line_words")
    with_word = F.transform(F.filter("lines", lambda x: x["words"] > 0), lambda x: x["line"])
    measured = measured.select(
        "doc_id", "cleaned", "kept_words", "lines",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _count(value, SYMBOLS).cast("long").alias("n_symbols"),
        (F.size(with_word) - F.size(F.array_distinct(with_word))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words"), rules.window).cast("long").alias("n_repeat_words"),
        F.size(F.filter("lines", lambda x: ~x["passes"])).cast("long").alias("n_failed_lines"))
    base_failed = (F.col("n_words") < rules.min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeated_words)
    return (measured
            .withColumn("base_failed", base_failed)
            .withColumn("kept", ~base_failed & (
                F.col("kept_words") * 100 >= F.col("n_words") * rules.min_kept_words))
            .drop("lines"))

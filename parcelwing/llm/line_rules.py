"""Quality rules: figures of each text, and the frequency of its lines across documents.

Built from DataFrame functions alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwing.llm.common import plain, set_apart, stored, text_key

BLANKS = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MIN_LINE_DOCS = 10          # a line may stand in so many texts of a host, whatever the host's size
MAX_LINE_PERCENT = 5        # and in so many percent of the host's texts
MAX_LINE_DOCS = 1_000       # but in no more texts than this, however large the host
MAX_REMOVED_PERCENT = 70    # a text that loses more of its words is depleted


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"[ \t\n\x0B\f\r]+", -1), lambda w: w != "")


def _has_word(line: Column) -> Column:
    return F.length(_without(line, BLANKS)) > 0


def _repeated_words(windows: str, many: Column) -> Column:
    """Words that lie in a window whose hash occurs twice or more.

    Positions of the repeated windows, in order, each add the words that the
    one before has not covered.
    """
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    paired = F.zip_with(
        F.concat(F.array(F.lit(None).cast("struct<h: bigint, i: int>")), placed), placed,
        lambda before, here: F.struct(before.alias("b"), here.alias("c")))
    inner = F.filter(paired, lambda p: p["b"].isNotNull() & p["c"].isNotNull() & (p["b"]["h"] == p["c"]["h"]))
    both = F.flatten(F.transform(inner, lambda p: F.array(p["b"]["i"], p["c"]["i"])))
    starts = F.sort_array(F.array_distinct(both))
    covered = F.aggregate(
        starts, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda state, at: F.struct(
            (state["n"] + F.least(at - state["last"], F.lit(WINDOW))).alias("n"), at.alias("last")))
    return F.when(many, covered["n"]).otherwise(F.lit(0).cast("long"))


def text_figures(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; a null text has no words."""
    text = F.coalesce(F.col("_text"), F.lit(""))
    step = docs.withColumns({"_words": _words(text), "_lines": F.filter(F.split(text, "\n", -1), _has_word)})
    step = step.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(_without(text, BLANKS)).cast("long"),
        "n_symbols": (F.length(text) - F.length(_without(text, SYMBOLS))).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_windows": F.when(F.size("_words") >= WINDOW, F.transform(
            F.sequence(F.lit(1), F.size("_words") - (WINDOW - 1)),
            lambda i: F.xxhash64(F.slice("_words", i, WINDOW)))).otherwise(F.array().cast("array<bigint>")),
    })
    step = step.withColumn("_many", F.size(F.array_distinct("_windows")) < F.size("_windows"))
    step = step.withColumn("n_repeat_words", _repeated_words("_windows", F.col("_many")))
    return step.drop("_words", "_lines", "_windows", "_many")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def normal_line(line: Column) -> Column:
    """A-Z as a-z, runs of blanks as one space, none at the ends."""
    return F.trim(F.regexp_replace(F.translate(line, UPPER, LOWER), r"[ \t\n\x0B\f\r]+", " "))


def frequent_lines(docs: DataFrame) -> DataFrame:
    """Of each text with a line that is frequent on its host: _host, _key, _cut, _lost.

    _cut tells by position, to the last such line, which lines go; _lost whether
    too many words go with them.

    Equal texts count as one document. Lines are hashed once, in the row, and
    stored as one row per distinct text, in order; lines travel without the
    text's key to be counted, a line that a third of all documents share as
    partial sums.
    """
    hashed = F.transform(F.split("_text", "\n", -1), lambda line: F.struct(
        F.xxhash64(normal_line(line)).alias("line"), F.size(_words(line)).alias("words")))
    texts = stored(docs.filter("_text is not null").select("_host", "_key", hashed.alias("lines")).groupBy(
        "_host", "_key").agg(F.first("lines").alias("lines")), "lines")
    with_words = F.filter("lines", lambda line: line["words"] > 0)
    placed = texts.select("_host", "_key", F.posexplode("lines").alias("at", "l")).filter("l.words > 0").select(
        "_host", "_key", "at", F.col("l.line").alias("line"), F.col("l.words").alias("words"))
    hosts = texts.groupBy("_host").agg(F.count(F.lit(1)).alias("texts"))
    spread = texts.select("_host", F.explode(F.array_distinct(F.transform(with_words, lambda line: line["line"]))).alias(
        "line")).groupBy("_host", "line").agg(F.count(F.lit(1)).alias("docs"))
    # stored first: where the list is short, Spark sends it to the lines and these stay where they are
    frequent = stored(spread.filter(F.col("docs") > MIN_LINE_DOCS).join(hosts, "_host").filter(
        (100 * F.col("docs") > MAX_LINE_PERCENT * F.col("texts")) | (F.col("docs") > MAX_LINE_DOCS)).select("_host", "line", F.lit(1).alias("cut")), "frequent")
    marked = placed.join(frequent, ["_host", "line"], "left")
    lost = marked.groupBy("_host", "_key").agg(
        F.sum("words").alias("all"), F.sum(F.when(F.col("cut").isNotNull(), F.col("words"))).alias("removed"),
        F.sort_array(F.collect_list(F.when(F.col("cut").isNotNull(), F.col("at")))).alias("ats"))
    before = F.concat(F.array(F.lit(-1)), F.slice("ats", 1, F.size("ats") - 1))
    flags = F.flatten(F.zip_with(before, "ats", lambda last, at: F.concat(
        F.array_repeat(F.lit(False), at - last - 1), F.array(F.lit(True)))))
    return lost.filter(F.size("ats") > 0).select("_host", "_key", flags.alias("_cut"), (
        F.col("removed") * 100 > MAX_REMOVED_PERCENT * F.col("all")).alias("_lost"))


def clean_text() -> Column:
    """The text without its frequent lines; other lines, blank ones too, stay as they are."""
    left = F.filter(F.split("text", "\n", -1), lambda _, at: ~F.coalesce(F.get("_cut", at), F.lit(False)))
    return F.when(F.col("_cut").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))


def line_rules(docs: DataFrame, host: str = "source") -> DataFrame:
    """docs with the figures, base_failed, kept and clean_text.

    kept is false for a text that fails the base rules or is depleted: over 70 %
    of its words stand in frequent lines: over 10 and over 5 % of its host's
    distinct texts hold them, or over 1,000. clean_text is the text without these
    lines; the figures are those of the whole text. A null host is a host of its own. A null or empty text has no
    words and fails. Rows repeat as they came. Columns of docs keep their values,
    except those named like a result, which are replaced.
    """
    results = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "clean_text")
    passed, named = set_apart(docs, results)
    prepared = docs.select(*passed, F.col("text").alias("_text"), text_key().alias("_key"), F.concat(
        F.when(F.col(plain(host)).isNull(), F.lit("0")).otherwise(F.lit("1")),
        F.coalesce(F.col(plain(host)).cast("string"), F.lit(""))).alias("_host"))
    frequent = frequent_lines(prepared.select("_text", "_key", "_host"))
    figures = text_figures(prepared).withColumn("base_failed", base_failed()).drop("_text")
    judged = figures.join(frequent, ["_host", "_key"], "left")
    verdict = ~F.col("base_failed") & ~F.coalesce("_lost", F.lit(False))
    return judged.withColumns({"kept": verdict, "clean_text": clean_text()}).select(
        *named, *results)

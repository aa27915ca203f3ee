"""Quality rules: per-document statistics and cross-document line frequency, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.llm.cluster import cut

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A line of a host found in more than so many documents is boilerplate.
LINE_LIMIT = 25
#: A document is depleted if less than this percentage of its characters stays.
MIN_LEFT_PERCENT = 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _let(value: Column, body) -> Column:
    """body(value) with value computed once, as a lambda variable."""
    return F.element_at(F.transform(F.array(value), body), 1)


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def repeated_window_words(words: Column, width: int = 3) -> Column:
    """How many words lie in a window of `width` words that occurs twice or more.

    Every window becomes one long: its hash above, its place below in as many
    bits as the place needs. Sorting brings equal windows together, so the cost
    is that of a sort, whatever repeats; neighbours of one hash count if their
    words agree, so that hashes shortened by long texts find nothing false.
    """

    def windows(v: Column) -> Column:
        w, bits = v["w"], v["bits"]
        return F.when(
            F.size(w) >= width,
            F.transform(
                F.sequence(F.lit(0), F.size(w) - width),
                lambda i: F.call_function(
                    "shiftleft", F.xxhash64(*[F.get(w, i + k) for k in range(width)]), bits
                ).bitwiseOR(i.cast("long")),
            ),
        ).otherwise(F.array().cast("array<bigint>"))

    def places(v: Column) -> Column:
        s, bits, w = v["s"], v["bits"], v["w"]
        low = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1

        def same(x: Column, at: Column) -> Column:
            other = F.get(s, at)
            alike = F.call_function("shiftright", x, bits) == F.call_function("shiftright", other, bits)
            for k in range(width):
                here, there = (F.get(w, (y.bitwiseAND(low) + k).cast("int")) for y in (x, other))
                alike = alike & (here == there)
            return F.coalesce(alike, F.lit(False))

        repeated = F.filter(s, lambda x, j: same(x, j - 1) | same(x, j + 1))
        return F.sort_array(F.transform(repeated, lambda x: x.bitwiseAND(low)))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, j: F.coalesce(F.least(F.get(p, j + 1) - x, F.lit(width)), F.lit(width)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    bits = F.length(F.bin(F.size(words).cast("long"))).cast("int")
    return _let(
        F.struct(words.alias("w"), bits.alias("bits")),
        lambda v: _let(
            F.struct(F.sort_array(windows(v)).alias("s"), v["bits"].alias("bits"), v["w"].alias("w")),
            lambda u: _let(places(u), covered),
        ),
    )


def normalised_line(line: Column) -> Column:
    return F.trim(F.translate(F.regexp_replace(line, SPACE, " "), UPPER, LOWER))


def line_features(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """The statistics of each document and, per line with a word, its key within the host and its length."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
        text.alias("body"),
    )
    parts = base.select(
        "doc_id",
        "host",
        "body",
        split_words(F.col("body")).alias("words"),
        F.filter(F.split("body", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    keyed = F.transform(
        "lines",
        lambda x: _let(
            normalised_line(x), lambda y: F.struct(F.xxhash64("host", y).alias("key"), F.length(y).alias("size"))
        ),
    )
    return parts.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("body", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (F.length("body") - F.length(F.translate("body", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_window_words(F.col("words")).alias("n_repeat_words"),
        keyed.alias("line_keys"),
    )


def frequent_lines(features: DataFrame, limit: int) -> DataFrame:
    """Keys of lines in more than `limit` documents of a host, and the smallest document with each.

    A document counts once for each of its lines. Partial counts leave one row of
    a line per task, so one that a third of all documents share costs no more.
    """
    lines = features.select("doc_id", F.explode(F.array_distinct("line_keys.key")).alias("key"))
    return (
        lines.groupBy("key")
        .agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first"))
        .where(F.col("n_docs") > limit)
    )


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    line_limit: int = LINE_LIMIT,
    min_left_percent: int = MIN_LEFT_PERCENT,
    spare_first: bool = False,
) -> DataFrame:
    """One row per document: the statistics, base_failed, kept, n_removed_chars and removed_lines.

    A line, ASCII-lowercased and with runs of white space as one space, is
    boilerplate if more than `line_limit` documents of its host hold it, and all of
    them lose it; with spare_first the one with the smallest id keeps it, which
    suits a corpus whose copies are still to be removed. A document is depleted if
    less than `min_left_percent` of the characters of its normalised lines stay. kept is false for depleted documents and those that
    fail the base rules. removed_lines holds the keys of the lines it loses (null
    if none). Null and empty texts have no words and fail; a null host counts as
    one host; ids must be unique and not null, other columns are ignored.
    """
    features = cut(line_features(docs, id_col, text_col, host_col))
    frequent = frequent_lines(features, line_limit)
    lines = features.select("doc_id", F.explode("line_keys").alias("line")).select("doc_id", "line.*")
    lost = (
        lines.join(frequent, "key")
        .where(F.col("doc_id") != F.col("first") if spare_first else F.lit(True))
        .groupBy("doc_id")
        .agg(
            F.sum("size").cast("long").alias("n_removed_chars"),
            F.sort_array(F.collect_set("key")).alias("removed_lines"),
        )
    )
    out = features.join(lost, "doc_id", "left")
    total = F.aggregate("line_keys.size", F.lit(0).cast("long"), lambda a, x: a + x)
    removed = F.coalesce("n_removed_chars", F.lit(0).cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    depleted = 100 * (total - removed) < min_left_percent * total
    return out.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"),
        removed.alias("n_removed_chars"),
        "removed_lines",
    )


def without_lines(text: Column, host: Column, removed_lines: Column) -> Column:
    """The text without the lines whose keys are listed; unchanged if none is."""
    host = F.coalesce(host.cast("string"), F.lit(""))
    left = F.filter(
        F.split(text, "\n"),
        lambda x: ~(
            x.rlike(r"[^\x20\x09-\x0D]") & F.array_contains(removed_lines, F.xxhash64(host, normalised_line(x)))
        ),
    )
    return F.when(removed_lines.isNull(), text).otherwise(F.array_join(left, "\n"))

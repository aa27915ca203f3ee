"""Spelling variants by anagram keys: words whose sums of letter powers differ by one letter added, removed or exchanged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.llm.cluster import cut

#: Runs that count as words, and the letters that occur in them once A-Z are lower-cased.
RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABET = LOWER + "".join(map(chr, range(0xC0, 0x100)))
POWER = 5


def letter_value(letter: Column) -> Column:
    """A letter's place in the alphabet to the fifth power: sums of few letters hardly ever agree by chance."""
    place = F.instr(F.lit(ALPHABET), letter).cast("long")
    return place * place * place * place * place


def typos(doc_id: Column, word: Column, every: int) -> Column:
    """word, or, where `every` divides h, the crc32 of `<doc_id>:<word>`, word without its code point h % length."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = (h % F.length(word)).cast("int")
    cut_out = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    return F.when(h % every == 0, cut_out).otherwise(word)


def count_words(docs: DataFrame, min_length: int, min_count: int, typo_every: int | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word and n, its occurrences in all texts, of the words of enough code points and occurrences."""
    # Only runs of at least min_length can become a word; counts are summed before and after the exchange.
    run = F.explode(F.regexp_extract_all(F.translate(text_col, UPPER, LOWER), F.lit(RUN), F.lit(0)))
    runs = docs.select(F.col(id_col).alias("doc"), run.alias("word")).where(F.length("word") >= min_length)
    if typo_every:
        runs = runs.select(typos(F.col("doc"), F.col("word"), typo_every).alias("word")).where(F.length("word") >= min_length)
    return runs.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def anagram_keys(words: DataFrame) -> DataFrame:
    """Rows (key, side, half, word, n, whole) that words near each other share.

    A word stands under its own key (whole) and under that of each of its letters
    removed, so an exchange meets at what both lack, and an addition or a removal
    where the one's own key is the other's without a letter. What lies on the side
    away from the changed letter is the same in both, which keeps the words of one
    key apart: of a word of length k without one letter, place h = (k - 1) // 2 and
    those before it are one half, the rest the other. Each letter counts once for
    each half, so a word has a row for two halves of each letter at most, however
    long it is; halves go by their hash, since near() compares the words.
    """
    letters = F.split("word", "")
    size = F.length("word")
    keyed = words.select("word", "n", letters.alias("letters"), size.alias("size")).withColumn(
        "key", F.aggregate("letters", F.lit(0).cast("long"), lambda total, letter: total + letter_value(letter))
    )
    h = F.floor((F.col("size") - 1) / 2).cast("int")
    # A letter removed at one of the first h + 1 places leaves the rest behind it, one removed later what is before place h.
    behind, ahead = F.substring("word", h + 2, F.col("size")), F.substring("word", F.lit(1), h)
    of = {"behind": F.array_distinct(F.slice("letters", F.lit(1), h + 1)), "ahead": F.array_distinct(F.slice("letters", h + 2, F.col("size")))}

    def entries(side: str, half: Column) -> Column:
        def entry(letter: Column) -> Column:
            return F.struct(
                (F.col("key") - letter_value(letter)).alias("key"), F.lit(side == "ahead").alias("ahead"), F.xxhash64(half).alias("half"), F.lit(False).alias("whole")
            )

        return F.transform(of[side], entry)

    middle = F.floor(F.col("size") / 2).cast("int")
    own = [
        F.struct(F.col("key"), F.lit(is_ahead).alias("ahead"), F.xxhash64(half).alias("half"), F.lit(True).alias("whole"))
        for is_ahead, half in ((False, F.substring("word", middle + 1, F.col("size"))), (True, F.substring("word", F.lit(1), middle)))
    ]
    every = F.concat(F.array(*own), entries("behind", behind), entries("ahead", ahead))
    return keyed.select(F.inline(every), "word", "n", "size")


def near_words(words: DataFrame) -> DataFrame:
    """word, n, near, near_n: each two words that one inserted, deleted or replaced code point tells apart, in both orders.

    Rows may repeat. `words` must hold each word once.
    """
    keys = anagram_keys(words)
    a, b = keys.alias("a"), keys.alias("b")
    meet = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("key", "ahead", "half")]
    fits = (
        (F.col("a.word") != F.col("b.word"))
        # Both lack a letter, or the one is the other without it.
        & ((~F.col("a.whole") & ~F.col("b.whole") & (F.col("a.size") == F.col("b.size"))) | (F.col("a.size") == F.col("b.size") + 1) & F.col("b.whole") & ~F.col("a.whole")
           | (F.col("b.size") == F.col("a.size") + 1) & F.col("a.whole") & ~F.col("b.whole"))
        & one_apart(F.col("a.word"), F.col("b.word"))
    )
    return a.join(b, [*meet, fits]).select(F.col("a.word").alias("word"), F.col("b.word").alias("near"), F.col("b.n").alias("near_n"))


def one_apart(a: Column, b: Column) -> Column:
    """Whether one code point inserted, deleted or replaced makes a of b, in time linear in their length."""
    return F.levenshtein(a, b, 1) == 1


def spelling_forms(words: DataFrame, ratio: int = 5) -> DataFrame:
    """word, form, root, n, n_near and form_n of a table of distinct words with their counts n.

    form: of the near words (see near_words) the one of largest n, of equals the
    first in code-point order, if that n is at least ratio times the word's; null
    otherwise. root follows forms to the last and is the word itself without one.
    A word of any length has at most two rows for each letter of the alphabet. An
    empty table gives no rows.
    """
    near = near_words(words)
    # One exchange by word serves the repeats and the sums.
    near = near.repartition("word").dropDuplicates(["word", "near"])
    best = near.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    )
    found = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best.near")).alias("form"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), -F.col("best.less")).alias("form_n"),
    )
    found = cut(found)
    roots = follow(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")), chain_length(found, ratio))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def chain_length(found: DataFrame, ratio: int) -> int:
    """How many forms can follow one another: each has ratio times the count of the one before it."""
    least, most = found.where("form IS NOT NULL").agg(F.min("n"), F.max("form_n")).first()
    steps = 0
    while least is not None and least < most:
        least, steps = least * ratio, steps + 1
    return steps


def follow(step: DataFrame, length: int) -> DataFrame:
    """word, root of a table that leads each word one step on, in rounds that double how far it leads."""
    reached = 1
    while reached < length:
        onward = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = cut(step.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
        reached *= 2
    return step


def spelling_variants(
    docs: DataFrame, min_length: int = 6, min_count: int = 5, typo_every: int | None = None, ratio: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Words of all texts, their near words and the more frequent form each is likely meant for; see spelling_forms.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased, of at least
    min_length code points and min_count occurrences. With `typo_every` given, every
    so many-th occurrence, by a hash of its document's id, lacks a letter first,
    which plants misspellings to be found. Null texts have no words, a null id
    hashes like an empty one, repeated rows count each, other columns are ignored.
    """
    words = cut(count_words(docs, min_length, min_count, typo_every, id_col, text_col))
    return spelling_forms(words, ratio)

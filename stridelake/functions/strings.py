"""Names, clauses and phrases."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stridelake.functions.scalars import col

# Wording of a summary clause that reports a deficit.
ABNORMAL_PHRASES = [
    "重度异常", "中度异常", "轻度异常", "明显不对称性", "节律不规则", "不对称", "不规则", "减慢", "迟疑", "受限", "不稳", "下降",
]


def safe_name(text: Column | str) -> Column:
    """Runs of other characters than letters, digits, `_`, `.` and `-` as one `_`, none at the ends."""
    return F.regexp_replace(F.regexp_replace(col(text).cast("string"), r"[^A-Za-z0-9_.-]+", "_"), r"^_+|_+$", "")


def sequence_stem(subset: Column | str, subject: Column | str, trial: Column | str) -> Column:
    return F.concat_ws("__", safe_name(subset), safe_name(subject), safe_name(trial))


def identity_from_stem(stem: Column | str) -> tuple[Column, Column, Column]:
    """Subset, subject and trial of a stem; what is missing is null."""
    parts = F.split(col(stem), "__", 3)
    return F.get(parts, 0), F.get(parts, 1), F.get(parts, 2)


def first_known(*names: Column | str) -> Column:
    """The first value that isn't blank."""
    return F.coalesce(*[F.nullif(F.trim(col(n).cast("string")), F.lit("")) for n in names])


def or_na(text: Column | str) -> Column:
    return F.coalesce(first_known(text), F.lit("NA"))


def split_clauses(text: Column | str) -> tuple[Column, Column]:
    """The header up to the first full-width colon, or else the first colon ("" without one), and the clauses after it."""
    text = F.trim(F.coalesce(col(text), F.lit("")))
    mark = F.when(F.contains(text, F.lit("：")), "：").when(F.contains(text, F.lit(":")), ":")
    at = F.coalesce(F.call_function("instr", text, mark), F.lit(0))
    header = F.when(at > 0, F.concat(F.trim(F.substring(text, F.lit(1), at - 1)), mark)).otherwise(F.lit(""))
    body = F.regexp_replace(F.substring(text, at + 1, F.length(text)), "。+$", "")
    clauses = F.transform(F.split(body, "[、；]"), lambda x: F.trim(x))
    return header, F.filter(clauses, lambda x: x != "")


def has_phrase(text: Column | str, phrases: list[str] = ABNORMAL_PHRASES) -> Column:
    found = F.lit(False)
    for phrase in phrases:
        found = found | F.contains(col(text), F.lit(phrase))
    return F.coalesce(found, F.lit(False))


def summary_sentence(prefix: str, phrases: list[Column]) -> Column:
    """The prefix and the phrases that aren't null; empty if all are."""
    known = F.array_compact(F.array(*phrases))
    return F.when(F.size(known) > 0, F.concat(F.lit(prefix), F.array_join(known, "、"), F.lit("。"))).otherwise(F.lit(""))

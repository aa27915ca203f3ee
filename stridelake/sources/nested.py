"""Values at any depth of JSON texts, and segments read from JSON with defaults and reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.sources.contracts import first_failure


def depth(json: str | Column) -> Column:
    """How deep objects and arrays of a JSON text lie within each other; 0 for a single value."""
    json = F.col(json) if isinstance(json, str) else json
    # Escapes first, so that each string ends at the next quote.
    plain = F.regexp_replace(F.regexp_replace(json, r"\\.", ""), '"[^"]*"', "")
    signs = F.split(F.regexp_replace(plain, r"[^\[\]{}]", ""), "")

    def step(state: Column, sign: Column) -> Column:
        now = state["now"] + F.when(sign.isin("{", "["), 1).when(sign.isin("}", "]"), -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(state["most"], now).alias("most"))

    return F.aggregate(signs, F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")), step, lambda s: s["most"])


def find_nested(json: str | Column, key: str) -> Column:
    """The value of key in the first object that has it, as text; null where none has a value.

    An object's own key comes before what lies in its other values, these in the
    order of the text. An object that has the key as null gives nothing and isn't
    searched further, its neighbours are. Strings are given without quotes, other
    values as JSON. Null, and texts that don't start with a JSON value or whose value
    repeats a key within an object, give null; texts within strings, and what
    follows the value, are not searched.

    All objects of a level are replaced by what they hold at once, in place, so
    the first value found in the end is the first in order.
    """
    json = F.col(json) if isinstance(json, str) else json
    item = lambda found, text: F.struct(found.alias("found"), text.alias("text"))
    none = F.array().cast("array<struct<found: boolean, text: string>>")

    def may_hold(text: Column) -> Column:
        # An escaped name has a backslash.
        return F.contains(text, F.lit(f'"{key}"')) | F.contains(text, F.lit("\\"))

    def children(texts: Column, values: Column) -> Column:
        pairs = F.arrays_zip(texts.alias("text"), values.alias("value"))
        opens = lambda p: F.substring(p["text"], 1, 1).isin("{", "[") & may_hold(p["text"])
        inner = F.filter(pairs, lambda p: F.coalesce(opens(p) & (F.schema_of_variant(p["value"]) != "STRING"), F.lit(False)))
        return F.transform(inner, lambda p: item(F.lit(False), p["text"]))

    def expanded(text: Column) -> Column:
        texts, values = F.from_json(text, "map<string, string>"), F.from_json(text, "map<string, variant>")
        own = F.element_at(texts, F.lit(key))
        of_object = F.when(
            F.map_contains_key(texts, key), F.when(own.isNull(), none).otherwise(F.array(item(F.lit(True), own)))
        ).otherwise(children(F.map_values(texts), F.map_values(values)))
        of_array = children(F.from_json(text, "array<string>"), F.from_json(text, "array<variant>"))
        return F.coalesce(F.when(text.startswith("{"), of_object).when(text.startswith("["), of_array), none)

    def level(items: Column) -> Column:
        return F.flatten(F.transform(items, lambda i: F.when(i["found"], F.array(i)).otherwise(expanded(i["text"]))))

    whole = F.when(F.try_parse_json(json).isNotNull(), F.trim(F.translate(json, "\t\r\n", "   ")))
    levels = F.when(depth(whole) > 0, F.sequence(F.lit(1), depth(whole))).otherwise(F.array().cast("array<int>"))
    items = F.aggregate(levels, F.array(item(F.lit(False), whole)), lambda items, _: level(items))
    return F.get(F.filter(items, lambda i: i["found"]), F.lit(0))["text"]


# Fields of a segment, and those of its part `quality`.
TEXTS = ("segment_id", "label", "source_rule")
FRAMES = {"start_frame": 0, "end_frame": -1}
NUMBERS = ("start_time_sec", "end_time_sec", "duration_sec", "confidence")
QUALITY = {
    "quality_valid_frame_ratio": "valid_frame_ratio", "quality_representation_score_mean": "representation_quality_score_mean",
    "quality_hesitation_overlap_ratio": "hesitation_overlap_ratio",
}
BLANK = ("null", "false", "0", "0.0", '""', "[]", "{}")


def _blank(value: Column) -> Column:
    return value.isNull() | F.to_json(value).isin(*BLANK) | F.is_variant_null(value)


def _text(value: Column) -> Column:
    """A value as text: truth values and null as True, False and None, lists and objects as JSON."""
    json = F.to_json(value)
    named = F.when(F.is_variant_null(value), "None").when(json == "true", "True").when(json == "false", "False")
    return F.coalesce(named, F.try_variant_get(value, "$", "string"), json)


def segment_records(documents: DataFrame, keys: list[str], json: str = "payload") -> DataFrame:
    """Segments of one JSON document per row: keys, place (from 0), their fields, and reason, `ok` or why a segment can't be used.

    A document holds a list `segments` of objects. Fields that are missing, and
    blank ones (null, false, 0, or empty), get `` for texts, 0 for numbers, false,
    or no entries; start_frame is 0 and end_frame -1 only where they are missing. A
    single value in the place of a list is its only entry, a `quality` that isn't an
    object counts as empty. Numbers may stand in texts; fractions of frames are cut.

    What isn't JSON or holds no such list is a row with a null place; quarantine()
    sets those with a reason apart. An empty list gives no rows.
    """
    document = F.try_parse_json(F.col(json))
    df = documents.select(*keys, F.col(json).alias("_json"), document.alias("_document"))
    df = df.withColumn("_list", F.try_variant_get("_document", "$.segments", "array<variant>"))
    df = df.where(F.coalesce(F.size("_list") > 0, F.lit(True)) | F.col("_list").isNull())
    df = df.select(*keys, "_document", "_list", F.posexplode_outer("_list").alias("place", "_segment"))
    part = lambda name, of="_segment": F.try_variant_get(F.col(of), f"$.{name}", "variant")
    df = df.withColumns({f"_{n}": part(n) for n in (*TEXTS, *FRAMES, *NUMBERS, "quality", "used_for_extraction", "hesitation_overlap_frames", "auxiliary_overlap_labels")})
    df = df.withColumns({f"_{n}": part(o, "_quality") for n, o in {**QUALITY, "quality_status": "status", "quality_reasons": "reasons"}.items()})

    def text(name: str) -> Column:
        return F.when(_blank(F.col(f"_{name}")), "").otherwise(_text(F.col(f"_{name}")))

    def number(name: str, kind: str = "double") -> Column:
        return F.when(_blank(F.col(f"_{name}")), F.lit(0).cast(kind)).otherwise(F.try_variant_get(f"_{name}", "$", kind))

    def entries(name: str, null: Column) -> Column:
        value = F.col(f"_{name}")
        items = F.try_variant_get(value, "$", "array<variant>")
        empty = F.array().cast("array<string>")
        return F.when(value.isNull(), empty).when(F.is_variant_null(value), null).otherwise(F.coalesce(F.transform(items, _text), F.array(_text(value))))

    fields = {n: text(n) for n in TEXTS}
    fields |= {n: F.when(F.col(f"_{n}").isNull(), F.lit(d).cast("long")).otherwise(F.try_variant_get(f"_{n}", "$", "long")) for n, d in FRAMES.items()}
    fields |= {n: number(n) for n in (*NUMBERS, *QUALITY)}
    fields |= {
        "hesitation_overlap_frames": number("hesitation_overlap_frames", "long"), "used_for_extraction": ~_blank(F.col("_used_for_extraction")),
        "quality_status": text("quality_status"), "quality_reasons": entries("quality_reasons", F.array(F.lit("None"))),
        "auxiliary_overlap_labels": entries("auxiliary_overlap_labels", F.array().cast("array<string>")),
    }
    df = df.withColumns(fields)
    shape = F.schema_of_variant("_segment")
    rules = [("not JSON", F.col("_document").isNull()), ("no list of segments", F.col("_list").isNull()), ("segment is not an object", ~F.coalesce(shape.startswith("OBJECT"), F.lit(False)))]
    rules += [(f"{n} is not a number", F.col(n).isNull()) for n in (*FRAMES, *NUMBERS, *QUALITY, "hesitation_overlap_frames")]
    return df.select(*keys, "place", *fields, first_failure(rules).alias("reason"))

"""Near-duplicate detection: fast similarity sketching, banding, exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stridelake.llm import words as W
from stridelake.llm.cluster import cut, release, text_slices
from stridelake.llm.components import connected_components

BANDS, ROWS = 30, 4
PIVOT_ROUNDS = 1


def fast_similarity_sketch(shingles: np.ndarray, counts: np.ndarray, coordinates: int, seed: int = 1) -> np.ndarray:
    """Sketches of many sets at once, one row each; equal coordinates estimate the Jaccard similarity.

    In round i < t every element of a set falls into a hashed bin with a value in
    [i, i + 1); in round t + j all of them fall into bin j, so that 2t rounds fill
    every bin. A bin keeps its smallest value, and a set stops once all its bins
    are full, which large sets reach in the first rounds. Empty sets keep the
    largest value everywhere.
    """
    t = coordinates
    out = np.full(len(counts) * t, np.iinfo(np.uint64).max, np.uint64)
    owner = np.repeat(np.arange(len(counts)), counts)
    elements = shingles
    for step in range(2 * t):
        if not len(elements):
            break
        salt = np.uint64((seed * 0x9E3779B97F4A7C15 + step * 0xC2B2AE3D27D4EB4F) & (2**64 - 1))
        drawn = W.mix(elements ^ salt)
        places = (drawn % np.uint64(t)).astype(np.int64) if step < t else np.full(len(elements), step - t)
        values = (np.uint64(step) << np.uint64(48)) | (W.mix(drawn) >> np.uint64(16))
        np.minimum.at(out, owner * t + places, values)
        unfilled = (out.reshape(-1, t) == np.iinfo(np.uint64).max).any(axis=1)
        going = unfilled[owner]
        elements, owner = elements[going], owner[going]
    return out.reshape(-1, t)


def distinct_shingles(values: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles of each text, and how many a text has."""
    data, offsets = W.buffers(values)
    data = W.LOWER[data]
    starts, ends, counts = W.spans(data, offsets)
    with np.errstate(over="ignore"):
        hashes = W.word_hashes(data, starts, ends)
    hashes, counts = W.shingle_hashes(hashes, counts, width)
    text = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((hashes, text))
    hashes = hashes[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[fresh], np.bincount(text[fresh], minlength=len(counts)).astype(np.int64)


def _per_set(ufunc: np.ufunc, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(counts), np.uint64)
    full = counts > 0
    if full.any():
        out[full] = ufunc.reduceat(hashes, (np.cumsum(counts) - counts)[full])
    return out


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, two 64-bit keys of the whole set, and one key per band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                hashes, counts = distinct_shingles(part.column(1), width)
                with np.errstate(over="ignore"):
                    first = _per_set(np.add, W.mix(hashes + np.uint64(1)), counts)
                    second = _per_set(np.add, W.mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), counts)
                    sketch = fast_similarity_sketch(hashes, counts, bands * rows)
                    keys = np.zeros((len(counts), bands), np.uint64)
                    for r in range(rows):
                        keys = W.mix(keys * np.uint64(0xD6E8FEB86659FD93) + sketch[:, r::rows])
                    keys = W.mix(keys + np.arange(bands, dtype=np.uint64))
                flat = pa.array(keys.view(np.int64).ravel())
                bounds = pa.array(np.arange(0, keys.size + 1, bands, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(counts),
                        pa.array(first.view(np.int64)),
                        pa.array(second.view(np.int64)),
                        pa.ListArray.from_arrays(bounds, flat),
                    ],
                    ["doc_id", "n_shingles", "key1", "key2", "bands"],
                )

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(
        run, "doc_id long, n_shingles long, key1 long, key2 long, bands array<long>"
    )


def _shingle_sets(docs: DataFrame, id_col: str, text_col: str, width: int, wanted: DataFrame) -> DataFrame:
    """doc_id and sorted shingle hashes of the documents in wanted(doc_id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                hashes, counts = distinct_shingles(part.column(1), width)
                bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                sets = pa.ListArray.from_arrays(pa.array(bounds), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), sets], ["doc_id", "shingles"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.join(wanted, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(
        run, "doc_id long, shingles array<long>"
    )


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """pairs(a, b) with `linked`: whether 100 * intersection >= percent * union on the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            linked = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = (v[i].values.to_numpy(zero_copy_only=False).view(np.uint64) for v in (left, right))
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    continue
                small, large = (x, y) if len(x) < len(y) else (y, x)
                at = np.searchsorted(large, small)
                at[at == len(large)] = 0
                both = int((large[at] == small).sum())
                linked[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(linked)], ["a", "b", "linked"]
            )

    with_a = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("left")), "a")
    both = with_a.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("right")), "b")
    return both.select("a", "b", "left", "right").mapInArrow(run, "a long, b long, linked boolean")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Shingles are runs of `width` words, ASCII-lowercased; a shorter text is one
    shingle, and null or blank texts have none and are linked with nothing.
    Documents with equal sets are one node. Nodes that share a band key are
    compared with a few pivots of their bucket on full sets, which joins most of a
    large group without its pairs. Nodes of buckets that then still span several
    components are compared across components wherever their rarest shingles
    meet, which leaves out no possible link. Two sets at the threshold share no band with a
    probability of (1 - 0.8^4)^30, about 1e-7. A document is kept if it has the
    smallest id of its component. Ids must be unique and not null; other columns
    are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    sketch = cut(sketches(docs, id_col, text_col, width, bands, rows))
    nodes = (
        sketch.where("n_shingles > 0")
        .groupBy("key1", "key2")
        .agg(F.min(F.struct("doc_id", "n_shingles", "bands")).alias("s"))
        .select("key1", "key2", "s.*")
        .withColumnRenamed("doc_id", "node")
    )
    nodes = cut(nodes)
    release(spark)
    entries = nodes.select("node", F.col("n_shingles").alias("n"), F.explode("bands").alias("band"))
    shared = (
        entries.groupBy("band")
        .agg(F.count("*").alias("size"))
        .where("size > 1")
    )
    reach = F.sum("size").over(Window.partitionBy("node")).alias("reach")
    members = cut(entries.join(shared, "band").select("band", "node", "n", "size", reach))
    release(spark)
    sets = cut(
        _shingle_sets(
            docs, id_col, text_col, width, members.select(F.col("node").alias("doc_id")).distinct()
        )
    )
    fits = f"100 * least(n, m) >= {percent} * greatest(n, m)"
    release(spark)

    tried = None
    components = nodes.select("node", F.col("node").alias("component"))
    for step in range(PIVOT_ROUNDS):
        here = _unsettled(members, components, again=step > 0)
        pivot = here.where("node = pivot").select(
            "band", F.col("node").alias("b"), F.col("n").alias("m"), F.col("component").alias("apart")
        )
        pairs = here.withColumnRenamed("node", "a").join(pivot, "band").where(f"component <> apart AND {fits}")
        tried = _tried(tried, pairs, sets, percent)
        release(spark)
        components = _components(members, tried)
    here = cut(_unsettled(members, components).select("node", "n", "component").distinct())
    prefixes = cut(_prefixes(here, sets, percent))
    release(spark)
    mixed = (
        prefixes.groupBy("shingle")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("shingle")
    )
    prefixes = prefixes.join(mixed, "shingle")
    other = prefixes.select(
        "shingle",
        F.col("node").alias("b"),
        F.col("n").alias("m"),
        F.col("component").alias("apart"),
        F.col("at").alias("there"),
    )
    # What the two can share from their first common shingle on must reach what a link needs.
    enough = f"{100 + percent} * least(n - at, m - there) >= {percent} * (n + m)"
    pairs = prefixes.withColumnRenamed("node", "a").join(other, "shingle")
    pairs = pairs.where(f"component < apart AND {enough} AND {fits}")
    components = _components(members, _tried(tried, pairs, sets, percent))
    by_node = nodes.join(components, "node", "left").select(
        "key1", "key2", F.coalesce("component", "node").alias("component")
    )
    with_sets = sketch.where("n_shingles > 0").join(by_node, ["key1", "key2"])
    alone = sketch.where("n_shingles = 0").withColumn("component", F.col("doc_id"))
    out = with_sets.select("doc_id", "n_shingles", "component").union(
        alone.select("doc_id", "n_shingles", "component")
    )
    return out.select(
        "doc_id",
        "n_shingles",
        F.col("component").alias("component_id"),
        (F.col("doc_id") == F.col("component")).alias("kept"),
    )


def _components(members: DataFrame, tried: DataFrame) -> DataFrame:
    linked = connected_components(tried.where("linked"))
    nodes = members.select("node").distinct()
    return cut(nodes.join(linked, "node", "left").select("node", F.coalesce("component", "node").alias("component")))


def _tried(before: DataFrame | None, pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs compared so far and these, each once."""
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    if before is None:
        return cut(_confirm(pairs, sets, percent))
    fresh = _confirm(pairs.join(before.select("a", "b"), ["a", "b"], "left_anti"), sets, percent)
    return cut(before.union(fresh))


def _unsettled(members: DataFrame, components: DataFrame, again: bool = True) -> DataFrame:
    """Members of buckets that span components; pivot is the node there that shares most buckets with most nodes.

    Once the best node has been compared (again), the next pivot comes from
    outside its component.
    """
    placed = members.join(components, "node")
    best = F.struct("reach", "node", "component")
    spans = (
        placed.groupBy("band")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.max(best).alias("best"))
        .where("low <> high")
        .select("band", "best")
    )
    placed = placed.join(spans, "band")
    candidate = F.struct("reach", "node")
    outside = F.when(F.col("component") != F.col("best.component"), candidate) if again else candidate
    pivots = placed.groupBy("band").agg(F.max(outside).alias("top")).select("band", F.col("top.node").alias("pivot"))
    return placed.select("band", "node", "n", "component").join(pivots, "band")


def _prefixes(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """For each node its rarest shingles in order, as many as sets that agree to `percent` must share one of.

    A set of n shingles that is linked shares at least percent * n / 100 of them,
    so one of its n - ceil(percent * n / 100) + 1 rarest lies among the rarest of
    the other set too: pairs that share none of these can't be linked.
    """
    all_of = nodes.join(sets, nodes.node == sets.doc_id).select(
        "node", "n", "component", F.explode("shingles").alias("shingle")
    )
    often = all_of.groupBy("shingle").agg(F.count("*").alias("times"))
    ranked = (
        all_of.join(often, "shingle")
        .groupBy("node")
        .agg(
            F.first("n").alias("n"),
            F.first("component").alias("component"),
            F.sort_array(F.collect_list(F.struct("times", "shingle"))).alias("order"),
        )
    )
    rarest = F.expr(f"slice(order, 1, cast(n - (({percent} * n + 99) div 100) + 1 AS int)).shingle")
    return ranked.select("node", "n", "component", F.posexplode(rarest).alias("at", "shingle"))

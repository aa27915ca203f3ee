"""Approximate nearest neighbours with a hash-prefix forest."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TREES = 48
#: A string has so many digits; each names the largest of AXES rotated components and its sign.
DIGITS, AXES = 12, 8
#: The climb of a shard is set so that this share of the neighbours of sampled queries is found there.
RECALL = 0.97
#: Queries of a shard that are also searched in full, to set its climb.
SAMPLE_QUERIES = 64
#: The most bytes of vectors in a shard and the fewest vectors that one is made for; the most bytes of queries that visit it at once.
SHARD_BYTES, SHARD_VECTORS, QUERY_BYTES = 32 << 20, 2048, 16 << 20
#: Queries whose ranges are looked up together.
TOGETHER = 512


def takes_part(vector: Column) -> Column:
    """Not null, without null or non-finite components, and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def rotations(dims: int, trees: int, digits: int, seed: int) -> np.ndarray:
    """For each tree the axes of its digits, side by side, cut from random orthogonal matrices."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(trees):
        columns: list[np.ndarray] = []
        while sum(c.shape[1] for c in columns) < digits * AXES:
            q, r = np.linalg.qr(rng.normal(size=(dims, dims)))
            columns.append(q * np.where(np.diag(r) < 0, -1.0, 1.0))
        out.append(np.concatenate(columns, axis=1)[:, : digits * AXES])
    return np.stack(out).astype(np.float32)


def hash_strings(vectors: np.ndarray, turns: np.ndarray) -> np.ndarray:
    """One string per vector and tree, first digit in the highest bits."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    scaled = (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)
    bits = np.uint64((2 * AXES - 1).bit_length())
    out = np.zeros((len(vectors), len(turns)), np.uint64)
    for t, turn in enumerate(turns):
        for i in range(0, len(vectors), 4096):
            turned = (scaled[i : i + 4096] @ turn).reshape(-1, turn.shape[1] // AXES, AXES)
            axis = np.abs(turned).argmax(axis=2)
            positive = np.take_along_axis(turned, axis[:, :, None], axis=2)[:, :, 0] > 0
            for digit in (2 * axis + positive).T.astype(np.uint64):
                out[i : i + 4096, t] = (out[i : i + 4096, t] << bits) | digit
    return out


@dataclass
class Forest:
    """Sorted arrays of strings, one per tree, over the vectors of a shard."""

    ids: np.ndarray
    rows: np.ndarray
    turns: np.ndarray
    digits: int

    def __post_init__(self) -> None:
        self.bits = (2 * AXES - 1).bit_length()
        self.codes = hash_strings(self.rows, self.turns)
        self.order = np.argsort(self.codes, axis=0).astype(np.int32)
        self.sorted = np.take_along_axis(self.codes, self.order, axis=0)
        self.norms = np.einsum("ij,ij->i", self.rows, self.rows)

    def ranges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """[level, query, tree] -> where the strings that share the query's first `level` digits begin and end in sorted order."""
        begin = np.zeros((self.digits + 1, *codes.shape), np.int32)
        end = np.full((self.digits + 1, *codes.shape), len(self.ids), np.int32)
        for level in range(1, self.digits + 1):
            shift = np.uint64(self.bits * (self.digits - level))
            low = codes >> shift << shift
            high = low | ((np.uint64(1) << shift) - np.uint64(1))
            for t in range(codes.shape[1]):
                begin[level, :, t] = np.searchsorted(self.sorted[:, t], low[:, t], "left")
                end[level, :, t] = np.searchsorted(self.sorted[:, t], high[:, t], "right")
        return begin, end

    def held(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """[query, step] -> how many strings lie below a query's prefixes after each step of the climb.

        The climb starts at the longest prefixes and takes all trees in turn a
        digit higher, then again, until every prefix is empty.
        """
        sizes = (end - begin).astype(np.int64)[::-1]
        longer = np.concatenate([np.zeros_like(sizes[:1]), sizes[:-1]])
        steps = np.cumsum(sizes, axis=2) + longer.sum(axis=2, keepdims=True) - np.cumsum(longer, axis=2)
        return np.moveaxis(steps, 0, 1).reshape(sizes.shape[1], -1)

    def nearest(self, some: np.ndarray, point: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact distances of the k nearest of these rows, ties to the smaller id."""
        if len(some) > 4 * k:
            with np.errstate(over="ignore", invalid="ignore"):
                own = float(point @ point)
                rough = self.norms[some] + own - 2 * (self.rows[some] @ point)
            if np.isfinite(rough).all():
                slack = 1e-9 * (own + self.norms[some].max())
                some = some[rough <= np.partition(rough, k - 1)[k - 1] + slack]
        near = distances(self.rows[some], point)
        first = np.lexsort((self.ids[some], near))[:k]
        return self.ids[some][first], near[first]

    def wanted(self, asks: np.ndarray, points: np.ndarray, codes: np.ndarray, k: int, recall: float) -> int:
        """How many strings a climb must hold to find the given share of the k nearest vectors of these queries.

        The rank is rounded up as for one more neighbour than was seen, so that a
        few queries are answered in full.
        """
        held = self.held(*self.ranges(codes))
        needed = []
        for q in range(len(asks)):
            others = np.flatnonzero(self.ids != asks[q])
            found = np.isin(self.ids, self.nearest(others, points[q], k)[0])
            differ = self.codes[found] ^ codes[q]
            level = np.zeros(differ.shape, np.int64)
            for d in range(1, self.digits + 1):
                level += differ >> np.uint64(self.bits * (self.digits - d)) == 0
            step = ((self.digits - level) * codes.shape[1] + np.arange(codes.shape[1])).min(axis=1)
            needed.append(held[q][step])
        if not (total := sum(map(len, needed))):
            return 1
        rank = min(int(np.ceil(recall * (total + 1))), total)
        return int(np.sort(np.concatenate(needed))[rank - 1])

    def search(self, asks: np.ndarray, points: np.ndarray, k: int, recall: float, sample: int) -> list[tuple[np.ndarray, ...]]:
        """(query, id, distance) arrays of the k nearest found to each query."""
        codes = hash_strings(points, self.turns)
        drawn = np.argsort((asks.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(0x5851F42D4C957F2D), kind="stable")[:sample]
        wanted = self.wanted(asks[drawn], points[drawn], codes[drawn], k, recall)
        trees, out = codes.shape[1], []
        for i in range(0, len(asks), TOGETHER):
            begin, end = self.ranges(codes[i : i + TOGETHER])
            enough = self.held(begin, end) >= wanted
            step = np.where(enough.any(axis=1), enough.argmax(axis=1), enough.shape[1] - 1)
            for q, (level, tree) in enumerate(zip(self.digits - step // trees, step % trees, strict=True)):
                below = np.zeros(len(self.ids), bool)
                for t in range(trees):
                    # Trees that the last round didn't reach are still at the longer prefix.
                    at = level if t <= tree else level + 1
                    if at <= self.digits:
                        below[self.order[begin[at, q, t] : end[at, q, t], t]] = True
                asked = asks[i + q]
                below &= self.ids != asked
                ids, near = self.nearest(np.flatnonzero(below), points[i + q], k)
                out.append((np.full(len(ids), asked), ids, near))
        return out


def nearest_neighbours(
    vectors: DataFrame,
    queries: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 10,
    trees: int = TREES,
    digits: int = DIGITS,
    recall: float = RECALL,
    sample: int = SAMPLE_QUERIES,
    seed: int = 5,
) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of the k nearest found to each row that `queries` selects.

    Vectors are dealt by a hash of their id to shards of bounded size. A shard
    keeps, for every tree, its strings of digits in sorted order. A query descends
    to the longest prefixes it shares with any of them and climbs a digit at a
    time, in one tree after another, until its prefixes hold enough strings; the
    vectors of these are compared exactly. How many are enough is no constant: at
    most `sample` of a shard's queries are searched there in full too, and the climb
    is set so that it finds `recall` of their neighbours. Each shard's best are
    ranked together.

    Vectors that are null, zero, or hold null or non-finite components take no
    part, nor do those of another length than the most frequent one (the smallest
    of equals). Equal vectors tie, the smaller id first. Ids must be unique and not
    null; other columns are ignored, and an empty table gives no rows.
    """
    kind = vectors.schema[vector_col].dataType.elementType.simpleString()
    kind = kind if kind in ("float", "double") else "double"
    valid = vectors.where(takes_part(F.col(vector_col).cast("array<double>")) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vector_col).cast(f"array<{kind}>").alias("vector"),
        F.coalesce(queries, F.lit(False)).alias("asks"),
    )
    sizes = valid.groupBy(F.size("vector").alias("dims")).agg(F.count("*").alias("n"), F.count_if("asks").alias("asked"))
    head = sizes.orderBy(F.desc("n"), "dims").first()
    dims, n, asked = (head["dims"], head["n"], head["asked"]) if head else (1, 0, 0)
    valid = valid.where(F.size("vector") == dims)
    wide = -(-8 * dims * n // SHARD_BYTES)
    spread = min(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // SHARD_VECTORS)
    shards, blocks = max(wide, spread, 1), max(-(-8 * dims * asked // QUERY_BYTES), 1)

    def everywhere(name: str, count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)

    def dealt(count: int, salt: str) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(count)).cast("int")

    placed = valid.select("id", "vector", dealt(shards, "shard").alias("shard"), everywhere("block", blocks))
    sent = valid.where("asks").select("id", "vector", dealt(blocks, "block").alias("block"), everywhere("shard", shards))

    def search(here: pa.Table, questions: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        if here.num_rows and questions.num_rows:
            # The order of rows must not depend on how they came.
            forest = Forest(*_columns(here, dims), rotations(dims, trees, digits, seed), digits)
            found = forest.search(*_columns(questions, dims), k, recall, sample)
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pa.table([pa.array(np.concatenate(x)) for x in zip(none, *found, strict=True)], names=["query_id", "vec_id", "score"])

    found = (
        placed.groupBy("shard", "block")
        .cogroup(sent.groupBy("shard", "block"))
        .applyInArrow(search, "query_id long, vec_id long, score double")
    )
    ranked = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def distances(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, summed in the order of the components."""
    total = np.zeros(len(rows))
    for d in range(rows.shape[1]):
        step = rows[:, d] - point[d]
        total += step * step
    return np.sqrt(total)


def _columns(table: pa.Table, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors, in order of the ids."""
    vectors = table.column("vector").combine_chunks()
    rows = vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.float64)
    ids = table.column("id").to_numpy()
    order = np.argsort(ids, kind="stable")
    return ids[order], rows[order]

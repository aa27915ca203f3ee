"""Packed token matrices: best-fit-decreasing with a segment tree over residual capacities."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridelake.llm.cluster import sound_text, text_slices

CAPACITY = 2048
#: A task packs what it has read once it holds so many ids.
SHARD_IDS = 2_000_000

SCHEMA = (
    "sequence_id string, n_ids int, doc_ids array<bigint>, pieces array<int>, "
    "cu_seqlens array<int>, ids binary, positions binary"
)


class CapacityTree:
    """How many open bins have each residual capacity, with search for the smallest that suffices."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.counts = [0] * (2 * self.leaves)

    def add(self, residual: int, times: int) -> None:
        at = self.leaves + residual
        while at:
            self.counts[at] += times
            at >>= 1

    def smallest_from(self, size: int) -> int:
        """The least residual >= size of an open bin, or -1."""
        counts, at = self.counts, self.leaves + size
        if counts[at]:
            return size
        while at > 1:
            if not at & 1 and counts[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if counts[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return -1


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Indices of the pieces in each bin, longest first."""
    tree = CapacityTree(capacity)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins: list[list[int]] = []
    order = np.argsort(-sizes, kind="stable")
    for i, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        residual = tree.smallest_from(size)
        if residual < 0:
            number, residual = len(bins), capacity
            bins.append([])
        else:
            number = open_bins[residual].pop()
            tree.add(residual, -1)
        bins[number].append(i)
        if left := residual - size:
            open_bins[left].append(number)
            tree.add(left, 1)
    return bins


@lru_cache(maxsize=4)
def rank_encoding(path: str, pattern: str):
    """A tiktoken encoding from a file of base64 tokens and ranks."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _pack(doc_ids: list[int], arrays: list[np.ndarray], capacity: int, pad_id: int) -> pa.RecordBatch:
    owner, piece, parts = [], [], []
    for doc, ids in zip(doc_ids, arrays, strict=True):
        for k in range(0, len(ids), capacity):
            owner.append(doc)
            piece.append(k // capacity)
            parts.append(ids[k : k + capacity])
    bins = best_fit_decreasing(np.array([len(p) for p in parts]), capacity)
    matrix = np.full((len(bins), capacity), pad_id, "<u2")
    positions = np.zeros((len(bins), capacity), "<u2")
    edges = []
    for row, members in enumerate(bins):
        at = [0]
        for i in members:
            n = len(parts[i])
            matrix[row, at[-1] : at[-1] + n] = parts[i]
            positions[row, at[-1] : at[-1] + n] = np.arange(n)
            at.append(at[-1] + n)
        edges.append(at)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([f"{owner[b[0]]}:{piece[b[0]]}" for b in bins]),
            pa.array([e[-1] for e in edges], pa.int32()),
            pa.array([[owner[i] for i in b] for b in bins], pa.list_(pa.int64())),
            pa.array([[piece[i] for i in b] for b in bins], pa.list_(pa.int32())),
            pa.array(edges, pa.list_(pa.int32())),
            pa.array([r.tobytes() for r in matrix], pa.binary()),
            pa.array([r.tobytes() for r in positions], pa.binary()),
        ],
        ["sequence_id", "n_ids", "doc_ids", "pieces", "cu_seqlens", "ids", "positions"],
    )


def packed_shards(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = 50256,
) -> DataFrame:
    """One row per sequence: a row of the id matrix with its segments.

    A document's ids end with end_id; documents of more than `capacity` ids are
    cut into pieces in order, so joining pieces by document restores all ids.
    ids and positions are `capacity` little-endian 16-bit numbers, padded with
    end_id and 0; cu_seqlens are the bounds of the segments, at which positions
    start anew; doc_ids and pieces name the segments, the first of which names
    the sequence. Each task packs about SHARD_IDS ids at a time, so nothing is
    shuffled. A null or empty text is one segment that holds end_id alone; ids must
    be unique and below 2^63, and repeated texts are packed like others. Other
    columns are ignored, and an empty table gives no rows.
    """
    if not 1 <= capacity < 1 << 16 or not 0 <= end_id < 1 << 16:
        raise ValueError("capacity and ids must fit 16 bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = rank_encoding(ranks_path, pattern).encode_ordinary
        names: list[int] = []
        arrays: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for part in text_slices(batch, "text"):
                for doc, text in zip(part.column(0).to_pylist(), sound_text(part.column(1)).to_pylist(), strict=True):
                    names.append(doc)
                    arrays.append(np.array([*encode(text or ""), end_id], np.uint16))
                    held += len(arrays[-1])
                if held >= SHARD_IDS:
                    yield _pack(names, arrays, capacity, end_id)
                    names, arrays, held = [], [], 0
        if names:
            yield _pack(names, arrays, capacity, end_id)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, SCHEMA)


def write_matrices(sequences: DataFrame, path: str) -> None:
    """Write packed sequences as Parquet, the id and position rows as raw binary values."""
    sequences.write.parquet(path)

"""Packing of tokenised documents into fixed-length sequences, by the sum-of-squares rule."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridelake.llm.cluster import text_slices
from stridelake.llm.tokens import word_tokenizer
from stridelake.llm.words import mix

CAPACITY = 2048
#: Documents packed together, on average; the open sequences that a group ends with are a small share of its own.
GROUP_DOCUMENTS = 40_000
#: Text that is encoded at once: numpy holds about fifty bytes for each byte of it.
ENCODED_BYTES = 1 << 20


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, taken in order.

    A piece goes where the sum of squared numbers of open bins per residual gap
    becomes smallest, a new bin included; of equals it takes the smallest gap that
    is left. Full bins count for nothing.
    """
    counts = np.zeros(capacity + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    opened = 0
    far = np.iinfo(np.int64).max
    for i, size in enumerate(sizes.tolist()):
        if size == capacity:
            bins[i], offsets[i] = opened, 0
            opened += 1
            continue
        held = counts[size:capacity]
        change = 2 * (counts[: capacity - size] - held + 1)
        change[0] = 1 - 2 * held[0]
        change[held == 0] = far
        best = int(change.argmin())
        if change[best] <= 2 * counts[capacity - size] + 1:
            gap = size + best
            number = stacks[gap].pop()
            counts[gap] -= 1
        else:
            gap, number = capacity, opened
            opened += 1
        bins[i], offsets[i] = number, capacity - gap
        left = gap - size
        if left:
            stacks[left].append(number)
            counts[left] += 1
    return bins, offsets


def packing_order(lengths: np.ndarray, docs: np.ndarray, pieces: np.ndarray, capacity: int) -> np.ndarray:
    """Pieces of over a tenth of the capacity longest first, then the short ones mixed by a hash, which fill what is left."""
    with np.errstate(over="ignore"):
        mixed = mix(docs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + pieces.astype(np.uint64))
    short = lengths * 10 <= capacity
    return np.lexsort((pieces, docs, np.where(short, mixed, 0), np.where(short, 0, -lengths), short))


def token_pieces(
    docs: DataFrame, id_col: str, text_col: str, tokenizer: str, capacity: int, end_id: int, with_ids: bool
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids.

    A document's ids end with end_id; only those of more than `capacity` ids are cut.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_tokenizer(tokenizer)
        for batch in batches:
            for part in text_slices(batch, "text", ENCODED_BYTES):
                ids, counts = encoder.encode(part.column(1))
                ids = np.insert(ids, np.cumsum(counts), end_id).astype("<u4")
                counts = counts + 1
                pieces = -(-counts // capacity)
                owner = np.repeat(np.arange(len(counts)), pieces)
                number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                starts = number * capacity
                lengths = np.minimum(counts[owner] - starts, capacity)
                edges = np.concatenate([[0], np.cumsum(lengths)])
                view = memoryview(ids).cast("B")
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
                arrays = [
                    part.column(0).take(pa.array(owner)),
                    pa.array(number.astype(np.int32)),
                    pa.array(starts),
                    pa.array(lengths),
                    pa.array(crc, pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids.view(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document: where its ids lie in which sequence of at most `capacity` ids.

    `tokenizer` is the path of a lower-casing word BPE file. Pieces are dealt by a
    hash of document and piece to groups of about GROUP_DOCUMENTS documents, so a
    very long document spreads too, and each group is packed in packing_order. A
    null or empty text is one piece that holds end_id alone. Ids must be unique;
    repeated texts are packed like others, other columns are ignored, and an empty
    table gives no rows.
    """
    pieces = token_pieces(docs, id_col, text_col, tokenizer, capacity, end_id, with_ids)
    groups = max(1, -(-docs.count() // GROUP_DOCUMENTS))
    placed = pieces.withColumn("pack", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)).cast("int"))

    def run(table: pa.Table) -> pa.Table:
        columns = (table.column(c).to_numpy() for c in ("length", "doc_id", "piece"))
        table = table.take(pa.array(packing_order(*columns, capacity)))
        bins, offsets = sum_of_squares(table.column("length").to_numpy(), capacity)
        first = table.column("pack")[0].as_py() << 40
        table = table.drop_columns(["pack"])
        return table.append_column("sequence_id", pa.array(bins + first)).append_column("offset", pa.array(offsets))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return placed.groupBy("pack").applyInArrow(run, f"{schema}, sequence_id long, offset long")

"""Alignment of the tokens of two tokenizers over one text, through a dictionary of the groups in which they meet.

A group is what lies between two neighbouring byte offsets at which tokens of both
end. Two tokens are linked where their bytes overlap, which only tokens of one
group can, so all that depends on a group alone is worked out once per distinct
group of the corpus.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridelake.llm.bpe import ranges
from stridelake.llm.bytepairs import KNOWN, KNOWN_PIECE, read_json_ranks
from stridelake.llm.cluster import cut, sound_text, text_slices, trim

MARK = "▁"
#: Texts whose groups share one dictionary, in bytes; a longer text has one of its own.
SLICE_BYTES = 32 << 20
#: Texts are cut into groups so many bytes at a time.
PART_BYTES = 2 << 20
#: Groups of up to so many tokens are interned by sorting, larger ones one by one.
SMALL = 10
#: Units that are met for the first time are aligned so many at once.
UNITS_AT_ONCE = 1 << 12
#: Groups or pairs in one row of a slice's dictionary.
ROW_GROUPS = 1 << 16
#: Cuts a text before each space that follows something else than white space: tokens of neither side cross such a place.
UNITS = re.compile(r" *[^ ]+(?:(?<!\S) +[^ ]+)*| +")


def intern(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Number each group by its ids: the numbers, and for each the packed 32-bit count of A ids, A ids and B ids."""
    first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    numbers = np.empty(len(n_a), np.int64)
    keys: list[bytes] = []
    shapes = n_a * (SMALL + 1) + n_b
    small = n_a + n_b <= SMALL
    for shape in np.unique(shapes[small]).tolist():
        rows = np.flatnonzero(small & (shapes == shape))
        k, m = divmod(shape, SMALL + 1)
        table = np.empty((len(rows), 1 + k + m), np.int32)
        table[:, 0] = k
        table[:, 1 : 1 + k] = a[first_a[rows][:, None] + np.arange(k)]
        table[:, 1 + k :] = b[first_b[rows][:, None] + np.arange(m)]
        unique, back = np.unique(table.view(np.dtype((np.void, table.itemsize * table.shape[1]))).ravel(), return_inverse=True)
        numbers[rows] = len(keys) + back
        keys += [x.tobytes() for x in unique]
    large: dict[bytes, int] = {}
    for r in np.flatnonzero(~small).tolist():
        i, j = first_a[r], first_b[r]
        key = np.concatenate([[n_a[r]], a[i : i + n_a[r]], b[j : j + n_b[r]]]).astype(np.int32).tobytes()
        numbers[r] = large.setdefault(key, len(keys) + len(large))
    return numbers, keys + list(large)


class TokenizerPair:
    """Both tokenizers, and a dictionary of the groups met so far: name -> number, and the number of tokens on each side."""

    def __init__(self, bytes_file: str, pieces_file: str, pattern: str) -> None:
        import sentencepiece
        import tiktoken

        ranks = read_json_ranks(bytes_file)
        # Gives the ids of the tokenizers library, which merges by the same ranks, in less time.
        self.a = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces_file)
        size = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(size)]
        if any(MARK in p.lstrip(MARK) for i, p in enumerate(pieces) if not self.b.is_byte(i)):
            raise ValueError(f"{pieces_file} has pieces across words")
        self.mark = self.b.piece_to_id(MARK)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.a_bytes = {i: token for token, i in ranks.items()}
        self.a_sizes = np.zeros(max(self.a_bytes) + 1, np.int64)
        self.a_sizes[list(self.a_bytes)] = [len(x) for x in self.a_bytes.values()]
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        self.clear()

    def clear(self) -> None:
        """Forget all groups and units."""
        self.known: dict[bytes, int] = {}
        self.names: list[str] = []
        self.n_a: list[int] = []
        self.n_b: list[int] = []
        self._forget()

    def _forget(self) -> None:
        #: Unit of text -> its row; the numbers of a row's groups are values[bounds[row] : bounds[row + 1]].
        self.units: dict[str, int] = {}
        self.values, self.bounds = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _number(self, key: bytes) -> int:
        """The number of a packed group, a new one where it isn't known."""
        number = self.known.get(key)
        if number is None:
            number = self.known[key] = len(self.known)
            n, *ids = memoryview(key).cast("i").tolist()
            self.names.append(",".join(map(str, ids[:n])) + "|" + ",".join(map(str, ids[n:])))
            self.n_a.append(n)
            self.n_b.append(len(ids) - n)
        return number

    def _align(self, units: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Groups of units that begin with a space and but for the last end without white space, all in one text.

        Their tokens are those of each alone. Gives arrays of numbers and of how
        many each unit has. Where the tokens don't give the text back, units are
        tried one by one, and such a unit is -1.
        """
        text = "".join(units)
        whole = text.encode("utf-8", "replace")
        a = self.a.encode_ordinary(text)
        b = self.b.encode(text[1:]) if len(text) > 1 else [self.mark]
        if b"".join(map(self.a_bytes.__getitem__, a)) != whole or b"".join(map(self.b_bytes.__getitem__, b)) != whole:
            if len(units) == 1:
                return [(np.array([-1], np.int32), np.array([1]))]
            return [x for unit in units for x in self._align([unit])]
        a, b = np.array(a, np.int32), np.array(b, np.int32)
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        ends = np.intersect1d(a_ends, b_ends, assume_unique=True)
        n_a = np.diff(np.searchsorted(a_ends, ends) + 1, prepend=0)
        n_b = np.diff(np.searchsorted(b_ends, ends) + 1, prepend=0)
        numbers, keys = intern(a, b, n_a, n_b)
        numbers = np.array([self._number(k) for k in keys], np.int32)[numbers]
        unit_ends = np.cumsum([len(u) if u.isascii() else len(u.encode("utf-8", "replace")) for u in units])
        return [(numbers, np.diff(np.searchsorted(ends, unit_ends) + 1, prepend=0))]

    def groups(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Numbers of the groups of a space and each text; None where there is no text or the bytes of either's tokens are not that."""
        cut = [UNITS.findall(" " + t) if t else [] for t in texts]
        if len(self.bounds) > KNOWN or len(self.values) > 8 * KNOWN:
            self._forget()
        new = [u for u in set(chain.from_iterable(cut)) if u not in self.units]
        alone = [u for u in new if u[-1].isspace() or MARK in u]
        single = set(alone)
        together = [u for u in new if u not in single]
        parts = [x for u in alone for x in self._align([u])]
        for i in range(0, len(together), UNITS_AT_ONCE):
            parts += self._align(together[i : i + UNITS_AT_ONCE])
        self.units.update(zip(chain(alone, together), range(len(self.bounds) - 1, len(self.bounds) - 1 + len(new)), strict=True))
        if parts:
            self.values = np.concatenate([self.values, *(x[0] for x in parts)])
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(np.concatenate([x[1] for x in parts]))])
        rows = np.fromiter(map(self.units.__getitem__, chain.from_iterable(cut)), np.int64)
        sizes = self.bounds[rows + 1] - self.bounds[rows]
        numbers = self.values[ranges(self.bounds[rows], sizes)]
        edges = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0, *map(len, cut)])].tolist()
        for unit in new:
            if len(unit) > KNOWN_PIECE:
                del self.units[unit]
        found = (numbers[i:j] for i, j in zip(edges, edges[1:], strict=False))
        return [x if len(x) and x.min() >= 0 else None for x in found]


@lru_cache(maxsize=2)
def tokenizer_pair(bytes_file: str, pieces_file: str, pattern: str) -> TokenizerPair:
    """One per Python worker."""
    return TokenizerPair(bytes_file, pieces_file, pattern)


def overlaps(a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in a and b of each two tokens whose bytes overlap, and the byte at which that overlap ends.

    Between two neighbouring ends of either side lies one overlap, and each lies there once.
    """
    a_ends, b_ends = np.cumsum(a_sizes[a]), np.cumsum(b_sizes[b])
    ends = np.union1d(a_ends, b_ends)
    return np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends), ends


def group_links(names: list[str], pair: TokenizerPair) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place in names, A id and B id of each link of the groups `a1,a2|b1`."""
    if not names:
        return (np.zeros(0, np.int64),) * 3
    flat = np.array(",".join(names).replace("|", ",").split(","), np.int64)
    bars = [n.index("|") for n in names]
    n_a = np.array([n.count(",", 0, bar) + 1 for n, bar in zip(names, bars, strict=True)], np.int64)
    n_b = np.array([n.count(",", bar) + 1 for n, bar in zip(names, bars, strict=True)], np.int64)
    starts = np.cumsum(n_a + n_b) - n_a - n_b
    a, b = flat[ranges(starts, n_a)], flat[ranges(starts + n_a, n_b)]
    i, j, ends = overlaps(a, b, pair.a_sizes, pair.b_sizes)
    group_ends = np.cumsum(np.add.reduceat(pair.a_sizes[a], np.cumsum(n_a) - n_a))
    return np.searchsorted(group_ends, ends), a[i], b[j]


class _Slice:
    """Documents that share one dictionary: what each holds of its groups, and how many of them hold each linked pair."""

    def __init__(self, number: int, pair: TokenizerPair) -> None:
        if len(pair.known) > KNOWN:
            pair.clear()
        self.number, self.pair, self.bytes, self.rows = number, pair, 0, 0
        self.docs: list[pa.Array] = []
        self.columns: list[list] = [[], [], [], []]
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, part: pa.RecordBatch) -> None:
        found = self.pair.groups(sound_text(part.column(1)).to_pylist())
        names = self.pair.names
        n_a, n_b = np.array(self.pair.n_a, np.int64), np.array(self.pair.n_b, np.int64)
        for row, numbers in enumerate(found, self.rows):
            if numbers is None:
                values = (0, 0, 0, "")
            else:
                listed = ";".join(map(names.__getitem__, numbers.tolist()))
                values = (int(n_a[numbers].sum()), int(n_b[numbers].sum()), len(numbers), hashlib.sha256(listed.encode()).hexdigest())
                number, times = np.unique(numbers, return_counts=True)
                self.held.append((np.full(len(number), row, np.int32), number, times.astype(np.int32)))
            for column, value in zip(self.columns, values, strict=True):
                column.append(value)
        self.docs.append(part.column(0))
        self.rows += len(found)
        self.bytes += part.column(1).nbytes

    def batches(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """A row per document, then rows of the dictionary: names of groups, and pairs with their numbers of documents."""
        empty = {f.name: f.type for f in schema}

        def batch(n: int, columns: dict[str, pa.Array]) -> pa.RecordBatch:
            columns["slice"] = pa.array(np.full(n, self.number, np.int64))
            return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(n, t) for c, t in empty.items()], schema=schema)

        if not self.rows:
            return
        none = (np.zeros(0, np.int32),) * 3
        owner, numbers, times = (np.concatenate([h[k] for h in [none, *self.held]]) for k in range(3))
        used, numbers = np.unique(numbers, return_inverse=True)
        names = [self.pair.names[i] for i in used.tolist()]
        edges = np.searchsorted(owner, np.arange(self.rows + 1))
        both = np.stack([numbers.astype(np.int32), times])
        packed = [both[:, i:j].tobytes() for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
        ids = pa.chunked_array(self.docs).combine_chunks()
        columns = dict(zip(["n_a", "n_b", "n_groups", "groups_sha256"], self.columns, strict=True))
        for i in range(0, self.rows, 4096):
            part = {k: pa.array(v[i : i + 4096], empty[k]) for k, v in columns.items()}
            part |= {"id": ids[i : i + 4096], "held": pa.array(packed[i : i + 4096], pa.binary())}
            yield batch(len(part["id"]), part)
        for i in range(0, len(names), ROW_GROUPS):
            some = ";".join(names[i : i + ROW_GROUPS])
            yield batch(1, {"base": pa.array([i], pa.int32()), "groups": pa.array([some], pa.string())})
        pairs, counts = self._pairs(names, owner, numbers)
        for i in range(0, len(pairs), ROW_GROUPS):
            p = pairs[i : i + ROW_GROUPS]
            lists = {"a": p >> 32, "b": p & 0xFFFFFFFF, "docs": counts[i : i + ROW_GROUPS]}
            yield batch(1, {k: pa.array([v.astype(np.int32)], empty[k]) for k, v in lists.items()})

    def _pairs(self, names: list[str], owner: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Linked pairs and how many documents hold each: one time each, however many of their groups do."""
        group, a, b = group_links(names, self.pair)
        pairs, at = np.unique(a << 32 | b, return_inverse=True)
        code = np.unique(group << 32 | at)
        group, at = code >> 32, code & 0xFFFFFFFF
        first = np.searchsorted(group, np.arange(len(names) + 1))
        in_groups = np.bincount(at, minlength=len(pairs))
        counts = np.zeros(len(pairs), np.int64)
        # Documents of a pair that one group alone links are those of the group.
        single = np.flatnonzero(in_groups[at] == 1)
        counts[at[single]] = np.bincount(numbers, minlength=len(names))[group[single]]
        many = in_groups[at] > 1
        kept = np.concatenate([[0], np.cumsum(many)])[first]
        sizes = (kept[1:] - kept[:-1])[numbers]
        seen = np.unique(np.repeat(owner.astype(np.int64), sizes) << 32 | at[many][ranges(kept[numbers], sizes)])
        return pairs, counts + np.bincount(seen & 0xFFFFFFFF, minlength=len(pairs))


def _sliced(docs: DataFrame, kind: str, files: tuple[str, str, str], slice_bytes: int) -> DataFrame:
    """Documents and dictionaries of slices; a slice lies within one partition."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ddl = (
        f"slice long, id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, held binary, "
        "a array<int>, b array<int>, docs array<int>, base int, groups string"
    )
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pair = tokenizer_pair(*files)
        number = TaskContext.get().partitionId() << 32
        part = _Slice(number, pair)
        for batch in batches:
            for texts in text_slices(batch, "text", min(PART_BYTES, slice_bytes)):
                if part.rows and part.bytes + texts.column(1).nbytes > slice_bytes:
                    yield from part.batches(schema)
                    number += 1
                    part = _Slice(number, pair)
                part.add(texts)
        yield from part.batches(schema)
        trim()

    return docs.mapInArrow(run, ddl)


def _links(groups: DataFrame, files: tuple[str, str, str]) -> DataFrame:
    """group, a, b and how often the group links these ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizer_pair(*files)
        for batch in batches:
            for part in text_slices(batch, "group", PART_BYTES):
                group, a, b = group_links(part.column(0).to_pylist(), pair)
                table = np.stack([group, a << 32 | b], 1)
                order = np.lexsort((table[:, 1], table[:, 0]))
                table = table[order]
                new = np.append(True, (table[1:] != table[:-1]).any(axis=1)) if len(table) else np.zeros(0, bool)
                at = np.flatnonzero(new)
                times = np.diff(np.append(at, len(table)))
                group, code = table[at, 0], table[at, 1]
                columns = [part.column(0).take(pa.array(group)), *(pa.array(x.astype(np.int32)) for x in (code >> 32, code & 0xFFFFFFFF, times))]
                yield pa.RecordBatch.from_arrays(columns, ["group", "a", "b", "times"])

    return groups.mapInArrow(run, "group string, a int, b int, times int")


def align_tokens(
    docs: DataFrame,
    bytes_file: str,
    pieces_file: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """One row per document: how its tokens of two tokenizers meet, and how common its links are.

    A: `bytes_file`, a tokenizers file of byte-level BPE cut by `pattern`, over a
    space and the text. B: `pieces_file`, a SentencePiece model, over the text.
    Columns: the id, n_a, n_b, n_groups, n_links, n_best (links whose number of
    documents is the highest of their A id), count_sum (numbers of documents summed
    over links) and groups_sha256 of the groups `a1,a2|b1` joined by semicolons.

    A null or empty text, and one that either's tokens don't give back byte by byte
    (U+2581 in it, for one), has no tokens: zeros and ''. Repeated rows count each
    as a document of its own; ids may repeat or be null; other columns are ignored;
    an empty table gives no rows; texts are aligned whole.

    Documents are dealt to slices of slice_bytes of text, each with a dictionary of its
    distinct groups. What travels are the groups and pairs of slices, once each,
    and back to the slice what each group is worth; so a group of all documents
    is one row per slice.
    """
    files = (bytes_file, pieces_file, pattern)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = cut(_sliced(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), kind, files, slice_bytes))

    pairs = rows.where("docs IS NOT NULL").select(F.inline(F.arrays_zip("a", "b", "docs")))
    counts = cut(pairs.groupBy("a", "b").agg(F.sum("docs").alias("docs")))
    # One row per token of A at most, whatever the corpus.
    best = F.broadcast(counts.groupBy("a").agg(F.max("docs").alias("most")))
    counts = counts.join(best, "a").select("a", "b", "docs", (F.col("docs") == F.col("most")).cast("long").alias("best"))

    listed = rows.where("groups IS NOT NULL").select("slice", "base", F.posexplode(F.split("groups", ";")).alias("at", "group"))
    listed = listed.select("slice", (F.col("base") + F.col("at")).alias("number"), "group")
    times = F.col("times").cast("long")
    worth = (
        _links(listed.select("group").distinct(), files)
        .join(counts, ["a", "b"])
        .groupBy("group")
        .agg(F.sum(times).alias("n_links"), F.sum(times * F.col("best")).alias("n_best"), F.sum(times * F.col("docs")).alias("count_sum"))
    )
    back = listed.join(worth, "group").select(F.col("slice").alias("of"), "number", "n_links", "n_best", "count_sum")
    kept = ["id", "n_a", "n_b", "n_groups", "groups_sha256"]
    texts = rows.where("n_groups IS NOT NULL").select("slice", *kept, "held")

    def total(left: pa.Table, right: pa.Table) -> pa.Table:
        """Worths of a slice's groups, summed over what its documents hold."""
        order = np.argsort(right.column("number").to_numpy())
        values = np.stack([right.column(c).to_numpy()[order] for c in ("n_links", "n_best", "count_sum")])
        sums = np.zeros((3, left.num_rows), np.int64)
        for i, held in enumerate(left.column("held").to_pylist()):
            if held:
                number, n = np.frombuffer(held, np.int32).reshape(2, -1)
                sums[:, i] = values[:, number] @ n.astype(np.int64)
        out = left.select(kept)
        for column, value in zip(("n_links", "n_best", "count_sum"), sums, strict=True):
            out = out.append_column(column, pa.array(value))
        trim()
        return out

    schema = f"id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, n_links long, n_best long, count_sum long"
    out = texts.groupBy("slice").cogroup(back.groupBy("of")).applyInArrow(total, schema)
    return out.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

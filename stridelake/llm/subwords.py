"""SentencePiece BPE encoding and decoding with seeded merge-dropout, in bulk."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridelake.llm import words as W
from stridelake.llm.bpe import MergeTable, Skip, merge, ranges
from stridelake.llm.cluster import sound_text, text_slices

MARK = "▁"
#: Occurrences are drawn and merged so many at a time.
SLICE = 1 << 17


def candidate_hash(left: np.ndarray, right: np.ndarray, place: np.ndarray, step: int) -> np.ndarray:
    pair = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
    return W.mix(pair + place.astype(np.uint64) * np.uint64(0x165667B19E3779F9) + np.uint64(step))


class UndroppedCache:
    """What words are merged into where nothing is skipped, and the hashes of the candidates met on the way, by their 64-bit hash."""

    def __init__(self, limit: int = 1 << 18) -> None:
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.known: dict[int, int] = {}
        self.values, self.bounds = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.candidates, self.edges = np.zeros(0, np.uint64), np.zeros(1, np.int64)

    def numbers(self, hashes: np.ndarray, make: Callable[[np.ndarray], tuple[np.ndarray, ...]]) -> np.ndarray:
        """Each word's place in the arrays; make(rows) merges the words at these rows, all different."""
        if len(self.known) > self.limit:
            self.clear()
        unique, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        get = self.known.get
        number = np.array([get(h, -1) for h in unique.tolist()], np.int64)
        fresh = np.flatnonzero(number < 0)
        if len(fresh):
            values, bounds, candidates, edges = make(first[fresh])
            number[fresh] = len(self.bounds) - 1 + np.arange(len(fresh))
            self.known.update(zip(unique[fresh].tolist(), number[fresh].tolist(), strict=True))
            self.values = np.concatenate([self.values, values])
            self.bounds = np.concatenate([self.bounds, bounds[1:] + self.bounds[-1]])
            self.candidates = np.concatenate([self.candidates, candidates])
            self.edges = np.concatenate([self.edges, edges[1:] + self.edges[-1]])
        return number[back]


class PieceModel:
    """A BPE model file with byte fallback and without normalisation, as arrays.

    Merges never cross from a letter to a word mark, so a unit is a run of spaces
    with the letters after it. The table holds every split of every piece, ranked
    by the piece's score.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.library.get_piece_size()
        self.pieces = [self.library.id_to_piece(i) for i in range(size)]
        plain = [
            i for i in range(size)
            if not (self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i) or self.library.is_unused(i))
        ]
        known = {self.pieces[i]: i for i in plain}
        if any(MARK in p.lstrip(MARK) for p in known):
            raise ValueError(f"{path} has pieces across words")
        self.bytes = np.array([self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.byte_of = np.full(size, -1, np.int32)
        self.byte_of[self.bytes] = np.arange(256)
        self.letters = np.full(0x110000, -1, np.int32)
        for piece, i in known.items():
            if len(piece) == 1:
                self.letters[ord(piece)] = i
        #: A letter without a piece stands for itself, above all ids, until it becomes bytes.
        self.offset = size
        rank = {i: k for k, i in enumerate(sorted(plain, key=lambda i: (-self.library.get_score(i), i)))}
        splits = [
            (known[p[:k]], known[p[k:]], rank[i], i)
            for p, i in known.items()
            for k in range(1, len(p))
            if p[:k] in known and p[k:] in known
        ]
        left, right, ranks, merged = (np.array(x, np.int64) for x in zip(*splits, strict=True))
        self.table = MergeTable(left, right, ranks.astype(np.int32), merged.astype(np.int32))
        self.surface = [
            bytes([self.byte_of[i]]) if self.byte_of[i] >= 0 else p.replace(MARK, " ").encode() if p in known else b""
            for i, p in enumerate(self.pieces)
        ]
        self.cache = UndroppedCache()

    def encode(
        self, texts: pa.Array, keys: np.ndarray, dropout: float, seed: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after another, and the number of each text's.

        A candidate merge is skipped if a hash of the seed, the key of the text,
        the word's place there, the two pieces, their place and the step at which
        the agenda gets it falls below `dropout`, so each occurrence of a word is
        drawn by itself. One that skips none of the candidates that the undropped
        word meets ends as that word does, which is kept; all others are merged.
        Without dropout the ids are the library's.
        """
        data, offsets = W.buffers(texts)
        filled = np.diff(offsets) > 0
        # The library puts one space before a text; here it becomes a byte of its own.
        wide = np.full(len(data) + int(filled.sum()), 0x20, np.uint8)
        shift = np.cumsum(filled)
        wide[np.arange(len(data)) + np.repeat(shift, np.diff(offsets))] = data
        offsets = offsets + np.concatenate([[0], shift])
        if not len(wide):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        space = wide == 0x20
        first = space.copy()
        first[1:] &= ~space[:-1]
        first[offsets[:-1][filled]] = True
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(wide))
        text = np.searchsorted(offsets, starts, side="right") - 1
        cache = self.cache
        with np.errstate(over="ignore"):
            hashes = W.word_hashes(wide, starts, ends)
            own = cache.numbers(hashes, lambda rows: self._undropped(wide, starts[rows], ends[rows]))
            begin, sizes = cache.bounds[own], cache.bounds[own + 1] - cache.bounds[own]
            if not dropout > 0:
                return cache.values[ranges(begin, sizes)], np.bincount(text, sizes, minlength=len(texts)).astype(np.int64)
            place = (starts - offsets[text]).astype(np.uint64)
            drawn = W.mix(W.mix(keys.astype(np.uint64)[text] ^ np.uint64(seed)) + place)
            least = np.uint64(min(int(dropout * 2.0**64), 2**64 - 1))
            salted = W.mix(drawn ^ np.uint64((seed * 0xC2B2AE3D27D4EB4F + 1) & (2**64 - 1)))
            met = cache.edges[own + 1] - cache.edges[own]
            split = np.zeros(len(starts), bool)
            for i in range(0, len(starts), SLICE):
                m = met[i : i + SLICE]
                chosen = cache.candidates[ranges(cache.edges[own[i : i + SLICE]], m)]
                skipped = W.mix(np.repeat(salted[i : i + SLICE], m) ^ chosen) < least
                split[i : i + SLICE][np.repeat(np.arange(len(m)), m)[skipped]] = True

            def skip(key, left, right, place, step):
                return W.mix(key ^ candidate_hash(left, right, place, step)) < least

            parts, at = [cache.values], len(cache.values)
            apart = np.flatnonzero(split)
            for i in range(0, len(apart), SLICE):
                rows = apart[i : i + SLICE]
                values, bounds = self._units(wide, starts[rows], ends[rows], salted[rows], skip)
                begin[rows], sizes[rows] = bounds[:-1] + at, np.diff(bounds)
                parts.append(values)
                at += len(values)
        return np.concatenate(parts)[ranges(begin, sizes)], np.bincount(text, sizes, minlength=len(texts)).astype(np.int64)

    def _undropped(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """Values and bounds of the merged words, then the hashes of all candidates that each meets, and their bounds."""
        words, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]

        def note(key, left, right, place, step):
            words.append(key.astype(np.int64))
            hashes.append(candidate_hash(left, right, place, step))
            return np.zeros(len(left), bool)

        values, bounds = self._units(data, starts, ends, np.arange(len(starts), dtype=np.uint64), note)
        word = np.concatenate(words)
        edges = np.concatenate([[0], np.cumsum(np.bincount(word, minlength=len(starts)))])
        return values, bounds, np.concatenate(hashes)[np.argsort(word, kind="stable")], edges

    def _units(
        self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray, skip: Skip
    ) -> tuple[np.ndarray, np.ndarray]:
        raw = data[ranges(starts, ends - starts)]
        edges = np.concatenate([[0], np.cumsum(ends - starts)])
        lead = (raw & 0xC0) != 0x80
        points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), "<u4").astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(lead)])[edges]
        symbols = np.where(points == ord(MARK), -1, self.letters[points])
        symbols = np.where(points == 0x20, self.letters[ord(MARK)], symbols)
        symbols = np.where(symbols < 0, points + self.offset, symbols).astype(np.int32)
        values, bounds = merge(symbols, bounds, self.table, keys, skip)
        odd = np.flatnonzero(values >= self.offset)
        if not len(odd):
            return values, bounds
        fallback = [[int(self.bytes[b]) for b in chr(v - self.offset).encode()] for v in values[odd].tolist()]
        widths = np.ones(len(values), np.int64)
        widths[odd] = [len(f) for f in fallback]
        at = np.concatenate([[0], np.cumsum(widths)])
        out = np.zeros(at[-1], np.int32)
        usual = np.ones(len(values), bool)
        usual[odd] = False
        out[at[:-1][usual]] = values[usual]
        out[ranges(at[odd], widths[odd])] = np.array([x for f in fallback for x in f], np.int32)
        return out, at[bounds]

    def decode(self, ids: list[int]) -> str:
        """The text that the ids came from."""
        surface = self.surface
        return b"".join([surface[i] for i in ids]).decode("utf-8", "replace")[1:]


@lru_cache(maxsize=4)
def piece_model(path: str) -> PieceModel:
    """One per Python worker, with its caches."""
    return PieceModel(path)


def encode_with_dropout(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    dropout: float = 0.1,
    seed: int = 1,
) -> DataFrame:
    """One row per document: doc_id, n_ids and ids.

    ids vary with the seed and with where a word stands, and always decode to the
    text, character by character; bytes that aren't UTF-8 stand as U+FFFD. Null and empty texts have no ids; null ids count
    as key 0; repeated rows give repeated rows, other columns are ignored, and an
    empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for batch in batches:
            for part in text_slices(batch, "text"):
                keys = part.column(0).fill_null(0).to_numpy(zero_copy_only=False)
                ids, counts = model.encode(sound_text(part.column(1)), keys, dropout, seed)
                bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts), lists], ["doc_id", "n_ids", "ids"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, n_ids long, ids array<int>")


def decode_ids(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and the text of its ids; null or empty ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for batch in batches:
            texts = [model.decode(ids) if ids else "" for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    source = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
    return source.mapInArrow(run, "doc_id long, text string")

"""Byte-level BPE encoding and decoding: longest matches of an automaton, with backtracking where two tokens would not stay apart."""

from __future__ import annotations

import base64
import json
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridelake.llm.cluster import sound_text, text_slices
from stridelake.llm.tokens import byte_letters

#: Pieces and token pairs that a worker remembers; past it the memory starts anew. Longer pieces are not kept.
KNOWN = 1 << 18
KNOWN_PIECE = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a file with one base64 token and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def read_json_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a tokenizers file of byte-level BPE; added tokens, which text never becomes, are left out."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if spec["model"]["type"] != "BPE" or spec["normalizer"] is not None or spec["pre_tokenizer"]["type"] != "ByteLevel":
        raise ValueError(f"{path} is not a byte-level BPE file")
    added = {t["id"] for t in spec["added_tokens"]}
    byte_of = {letter: b for b, letter in enumerate(byte_letters())}
    return {bytes(map(byte_of.__getitem__, t)): i for t, i in spec["model"]["vocab"].items() if i not in added}


class _Pieces(dict):
    """Piece of text -> its ids; what isn't known is encoded and kept."""

    def __init__(self, encode) -> None:
        self.encode = encode

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.encode(piece.encode("utf-8", "replace"))
        if len(piece) <= KNOWN_PIECE:
            if len(self) >= KNOWN:
                self.clear()
            self[piece] = ids
        return ids


class BytePairs:
    """Merges by rank, lowest first and leftmost of equals, found without running them.

    A row of tokens is what the merges end with if each is what its own bytes end
    with and no two neighbours would have merged across their border. So the
    longest token that fits is taken at each place, a shorter one where it can't
    stand beside the token before it, and a place from where nothing fits is never
    tried again: time is linear in the bytes.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, whole_pieces: bool = True) -> None:
        """whole_pieces: a piece that is a token takes its id, whether or not merges reach it."""
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing or any(ranks[bytes([b])] > 255 for b in range(256)):
            raise ValueError("ranks must begin with the 256 single bytes")
        self.ranks, self.whole_pieces = ranks, whole_pieces
        self.surface = {i: token for token, i in ranks.items()}
        self.sizes = {i: len(token) for token, i in ranks.items()}
        self.findall = regex.compile(pattern).findall
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.joined: dict[tuple[int, int], int] = {}
        self._apart: dict[tuple[int, int], bool] = {}
        automaton = ahocorasick.Automaton()
        reached: set[bytes] = set()
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1 and not self._learn(token, rank, reached):
                continue
            reached.add(token)
            automaton.add_word(token.decode("latin-1"), (rank, len(token) - 1))
        automaton.make_automaton()
        self.automaton = automaton
        self._apart.clear()
        #: The longest token that a token begins with.
        self.shorter = {
            ranks[t]: next((ranks[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in reached), -1) for t in reached
        }
        self.pieces = _Pieces(self.merged)

    def _learn(self, token: bytes, rank: int, reached: set[bytes]) -> bool:
        """Find the two tokens that the last merge of a token joins; false if merges never end with it."""
        for k in range(1, len(token)):
            a, b = token[:k], token[k:]
            if a in reached and b in reached and self.apart(self.ranks[a], self.ranks[b]):
                a, b = self.ranks[a], self.ranks[b]
                self.left[rank], self.right[rank], self.joined[a, b] = a, b, rank
                self._apart.pop((a, b), None)
                return True
        return False

    def apart(self, a: int, b: int) -> bool:
        """Whether a followed by b stays so.

        Undoes merges next to the border, latest first, and asks of each pair that
        met there whether it would have merged before the one just undone. Of one
        rank the left merge comes first.
        """
        key = (a, b)
        known = self._apart.get(key)
        if known is not None:
            return known
        before = 1 << 62
        while True:
            if self.joined.get((a, b), before) < before:
                found = False
                break
            if max(a, b) < 256:
                found = True
                break
            if a > b:
                before, a = a, self.right[a]
            else:
                before, b = b + 1, self.left[b]
        if len(self._apart) >= KNOWN:
            self._apart.clear()
        self._apart[key] = found
        return found

    def merged(self, piece: bytes) -> tuple[int, ...]:
        """The ids of one piece."""
        if self.whole_pieces and piece in self.ranks:
            return (self.ranks[piece],)
        n = len(piece)
        longest = [-1] * n
        # Matches come by their end, so the longest one of a start is the last.
        for end, (token, before) in self.automaton.iter(piece.decode("latin-1")):
            longest[end - before] = token
        sizes, shorter, apart = self.sizes, self.shorter, self.apart
        dead = bytearray(n + 1)
        out: list[int] = []
        at = 0
        token = longest[0] if n else -1
        while at < n:
            end = at + sizes[token]
            if not dead[end] and (not out or apart(out[-1], token)):
                out.append(token)
                at = end
                token = longest[at] if at < n else -1
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                dead[at] = 1
                token = out.pop()
                at -= sizes[token]
        return tuple(out)

    def encode(self, text: str) -> array:
        """The ids of a text, its pieces cut by the pattern, as unsigned 32-bit numbers."""
        return array("I", chain.from_iterable(map(self.pieces.__getitem__, self.findall(text))))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.surface.__getitem__, ids))


@lru_cache(maxsize=4)
def byte_pairs(path: str, pattern: str) -> BytePairs:
    """One per Python worker, with what it remembers."""
    return BytePairs(read_ranks(path), pattern)


def encode_documents(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, n_tokens and packed_ids, little-endian unsigned 32-bit ids one after another.

    `ranks` is the path of a rank file on every executor; `pattern` cuts a text
    into pieces, which are merged each by itself, special tokens being plain text.
    A null or empty text has no ids; repeated rows and ids, null ids included, give
    a row each; other columns are ignored and an empty table gives no rows. Texts
    of any length are encoded whole, in linear time; what isn't UTF-8 becomes
    U+FFFD.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_pairs(ranks, pattern)
        for batch in batches:
            for part in text_slices(batch, "text"):
                ids = [encoder.encode(text or "") for text in sound_text(part.column(1)).to_pylist()]
                sizes = pa.array([len(x) for x in ids], pa.int64())
                packed = pa.array([x.tobytes() for x in ids], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), sizes, packed], ["id", "n_tokens", "packed_ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, f"id {kind}, n_tokens long, packed_ids binary").withColumnRenamed("id", id_col)


def decode_documents(encoded: DataFrame, ranks: str, pattern: str, packed_col: str = "packed_ids") -> DataFrame:
    """The rows of encoded with `decoded`, the bytes of packed_ids, in place of a column of that name; null stays null."""
    rest = [c for c in encoded.columns if c not in (packed_col, "decoded")]
    fields = [f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in (*rest, packed_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = byte_pairs(ranks, pattern)
        for batch in batches:
            for part in text_slices(batch, packed_col):
                packed = part.column(len(rest)).to_pylist()
                decoded = [None if x is None else decoder.decode(memoryview(x).cast("I")) for x in packed]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(decoded, pa.binary())], [*part.schema.names, "decoded"])

    return encoded.select(*rest, packed_col).mapInArrow(run, ", ".join([*fields, "decoded binary"]))

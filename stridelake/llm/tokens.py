"""Token ids of many texts at once for a lower-casing word BPE vocabulary file."""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

from stridelake.llm import words as W
from stridelake.llm.bpe import MergeTable, SegmentCache, merge, ranges

END = "</w>"


def byte_letters() -> list[str]:
    """The public byte-to-letter convention: visible Latin-1 characters stand for themselves, the rest follow from U+0100."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + rest.index(b)) for b in range(256)]


class WordTokenizer:
    """The ids that the tokenizers library gives for this file without special tokens, merged in bulk.

    ASCII words without an apostrophe or `<` are cut into letters, single digits
    and the rest on bytes. Other words are normalised and cut by the file's own
    pattern once per distinct word; words with the text of an added token go
    through the library.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [s["type"] for s in spec["normalizer"]["normalizers"]]
        model = spec["model"]
        if steps != ["NFC", "Replace", "Lowercase"] or model["type"] != "BPE" or model["end_of_word_suffix"] != END:
            raise ValueError(f"{path} is not a lower-casing word BPE file")
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] + "|\n")
        self.added = [t["content"] for t in spec["added_tokens"]]
        vocabulary = model["vocab"]
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        left, right, merged = (
            np.array([vocabulary[f(p)] for p in pairs], np.int64)
            for f in (lambda p: p[0], lambda p: p[1], lambda p: p[0] + p[1])
        )
        self.table = MergeTable(left, right, np.arange(len(pairs), dtype=np.int32), merged.astype(np.int32))
        letters = byte_letters()
        self.inner = np.array([vocabulary[c] for c in letters], np.int32)
        self.last = np.array([vocabulary[c + END] for c in letters], np.int32)
        self.kind = np.full(256, 3, np.uint8)
        self.kind[[*range(65, 91), *range(97, 123)]] = 1
        self.kind[[*range(48, 58)]] = 2
        self.odd = np.zeros(256, bool)
        self.odd[128:] = True
        self.odd[[0x27, 0x3C]] = True
        self.words, self.pieces = SegmentCache(), SegmentCache()

    def _merged(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = ends - starts
        at = ranges(starts, sizes)
        symbols = self.inner[data[at]]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        symbols[bounds[1:] - 1] = self.last[data[ends - 1]]
        return merge(symbols, bounds, self.table)

    def _odd_words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words without ASCII white space, all cut in one pass over their join."""
        raw = b"\n".join(texts)
        text = raw.decode("utf-8", "replace")
        whole = {}
        if any(t in text for t in self.added):
            words = text.split("\n")
            for i, word in enumerate(words):
                if any(t in word for t in self.added):
                    whole[i] = self.library.encode(word, add_special_tokens=False).ids
                    words[i] = ""
            text = "\n".join(words)
        # Letters are lowered one by one, so a final sigma is like any other.
        text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()
        parts = [p.encode("utf-8") for p in self.pattern.findall(text)]
        sizes = np.array([len(p) for p in parts], np.int64)
        data = np.frombuffer(b"".join(parts), np.uint8)
        ends = np.cumsum(sizes)
        breaks = data[ends - 1] == 0x0A if len(parts) else np.zeros(0, bool)
        kept = ~breaks
        values, bounds = self._merged(data, (ends - sizes)[kept], ends[kept])
        per_word = np.bincount(np.cumsum(breaks)[kept], minlength=len(texts))
        bounds = bounds[np.concatenate([[0], np.cumsum(per_word)])]
        if whole:
            lists = [whole[i] if i in whole else values[bounds[i] : bounds[i + 1]] for i in range(len(texts))]
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
            values = np.concatenate([np.asarray(x, np.int32) for x in lists])
        return values, bounds

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after another, and the number of each text's."""
        data, offsets = W.buffers(texts)
        starts, ends, per_text = W.spans(data, offsets)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        data = W.LOWER[data]
        odd = np.add.reduceat(self.odd[data], np.stack([starts, np.minimum(ends, len(data) - 1)], 1).ravel())[::2] > 0
        odd |= self.odd[data[ends - 1]]
        with np.errstate(over="ignore"):
            sums = W.prefix_sums(data)
            plain = np.flatnonzero(~odd)
            a, b = starts[plain], ends[plain]
            inside = ranges(a, b - a)
            kinds = self.kind[data[inside]]
            first = np.append(True, (kinds[1:] != kinds[:-1]) | (kinds[1:] == 2))
            word_edges = np.cumsum(b - a)
            first[word_edges[:-1]] = True
            at = np.flatnonzero(first)
            piece_starts = inside[at]
            piece_ends = inside[np.append(at[1:], len(inside)) - 1] + 1
            ids, sizes = self.pieces.look_up(
                W.word_hashes(data, piece_starts, piece_ends, sums),
                lambda rows: self._merged(data, piece_starts[rows], piece_ends[rows]),
            )
            per_piece_word = np.searchsorted(word_edges, at, side="right")
            plain_sizes = np.bincount(per_piece_word, sizes, minlength=len(plain)).astype(np.int64)
            rest = np.flatnonzero(odd)
            original = W.buffers(texts)[0]
            raw = original.tobytes()
            odd_ids, odd_sizes = self.words.look_up(
                W.word_hashes(original, starts[rest], ends[rest]),
                lambda rows: self._odd_words([raw[starts[rest[r]] : ends[rest[r]]] for r in rows]),
            )
        total = np.zeros(len(starts), np.int64)
        total[plain], total[rest] = plain_sizes, odd_sizes
        begin = np.cumsum(total) - total
        out = np.zeros(int(total.sum()), np.int32)
        out[ranges(begin[plain], plain_sizes)] = ids
        out[ranges(begin[rest], odd_sizes)] = odd_ids
        edges = np.concatenate([[0], np.cumsum(total)])[np.concatenate([[0], np.cumsum(per_text)])]
        return out, np.diff(edges)


@lru_cache(maxsize=4)
def word_tokenizer(path: str) -> WordTokenizer:
    """One per Python worker, with its caches."""
    return WordTokenizer(path)

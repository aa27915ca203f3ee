"""Removal of byte strings that an earlier document holds, by longest previous factors over partitioned suffixes.

Suffixes whose first `length` bytes agree must meet in one place to be compared.
Each is dealt by the smallest hashed k-gram (its anchor) in that prefix, which
neighbouring suffixes mostly share, so that one short context stands for a whole
run of suffixes. A first exchange of 32-bit anchor hashes finds the anchors that
several documents hold; contexts travel for these alone. Where contexts of one
anchor meet, their suffixes are sorted, and the previous and next smaller
document in suffix order decide whether an earlier copy exists.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.llm import words as W
from stridelake.llm.cluster import trimmed

GRAM = 20
CHUNK_BYTES = 8 << 20
#: Bytes whose windows are hashed at once; a dozen arrays of eight times this length live at a time.
SLICE = 1 << 18
WINDOWS_AT_ONCE = 400_000
#: Anchors found in more chunks than this travel as single suffixes, dealt by all their bytes.
HOT_CHUNKS = 128


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The little-endian value of the 8 bytes from each place on (zeros beyond the end)."""
    n = len(data)
    padded = np.zeros(n + 16, np.uint8)
    padded[:n] = data
    out = np.empty((n + 7) // 8 * 8, np.uint64)
    for k in range(8):
        part = out[k::8]
        part[:] = np.frombuffer(padded.data, "<u8", len(part), k)
    return out[:n]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each place on."""
    e = eight_bytes(data)
    out = e * np.uint64(0x9E3779B97F4A7C15)
    n = len(e)
    for k, factor in ((8, 0xC2B2AE3D27D4EB4F), (GRAM - 8, 0x165667B19E3779F9)):
        out[: max(n - k, 0)] += e[k:] * np.uint64(factor)
    return W.mix(out)


def anchor_runs(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows that share an anchor: hash, anchor place, first and last window start, index of the text."""
    found: list[tuple[np.ndarray, ...]] = []
    width = length - GRAM + 1
    place_bits = np.uint64(22)
    low = (np.uint64(1) << place_bits) - np.uint64(1)
    for begin in range(0, len(data), SLICE):
        stop = min(begin + SLICE, len(data))
        hashes = gram_hashes(data[begin : min(stop + length, len(data))])
        keys = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        span, have = 1, keys
        while span * 2 <= width:
            have = np.minimum(have[:-span], have[span:]) if len(have) > span else have[:0]
            span *= 2
        rest = width - span
        if rest:
            have = np.minimum(have[:-rest], have[rest:]) if len(have) > rest else have[:0]
        have = have[: stop - begin]
        starts = np.arange(begin, begin + len(have))
        text = np.searchsorted(offsets, starts, side="right") - 1
        ok = starts + length <= offsets[np.minimum(text + 1, len(offsets) - 1)]
        starts, text, places = starts[ok], text[ok], (have[ok] & low).astype(np.int64)
        if not len(starts):
            continue
        first = np.ones(len(starts), bool)
        first[1:] = (places[1:] != places[:-1]) | (text[1:] != text[:-1])
        at = np.flatnonzero(first)
        last = np.append(at[1:], len(starts)) - 1
        found.append((hashes[places[at]], places[at] + begin, starts[at], starts[last], text[at]))
    if not found:
        empty = np.zeros(0, np.int64)
        return empty.astype(np.uint64), empty, empty, empty, empty
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def contexts(data: np.ndarray, places: np.ndarray, lows: np.ndarray, highs: np.ndarray, length: int) -> np.ndarray:
    """One row of bytes per run: place of the anchor, number of windows less 1, then the bytes from the first window to the last's end."""
    wide = 2 * length - GRAM
    out = np.zeros((len(places), (wide + 2 + 7) // 8 * 8), np.uint8)
    out[:, 0] = places - lows
    out[:, 1] = highs - lows
    padded = np.concatenate([data, np.zeros(wide, np.uint8)])
    steps = np.arange(wide)
    for i in range(0, len(places), 20_000):
        rows = slice(i, i + 20_000)
        block = padded[lows[rows, None] + steps]
        block[steps >= (highs[rows] - lows[rows])[:, None] + length] = 0
        out[rows, 2 : wide + 2] = block
    return out


def row_hashes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    columns = rows.view(np.uint64)
    one, two = np.full(len(rows), 1, np.uint64), np.full(len(rows), 2, np.uint64)
    for k in range(columns.shape[1]):
        one = W.mix(one ^ columns[:, k])
        two = W.mix(two * np.uint64(0xD6E8FEB86659FD93) + columns[:, k])
    return one, two


def group_rows(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order that brings equal keys together, and the group of each row (numbered in that order)."""
    order = np.lexsort(keys[::-1])
    fresh = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        fresh[1:] |= s[1:] != s[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(fresh)
    return order, group


def smaller_neighbours(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the nearest place before and after it with a smaller value, or -1.

    All places step together: one that isn't settled skips to where the place it
    looks at has got to, all of what lies between being no smaller.
    """

    def before(v: np.ndarray) -> np.ndarray:
        at = np.arange(len(v)) - 1
        going = np.flatnonzero((at >= 0) & (v[at] >= v))
        while len(going):
            at[going] = at[at[going]]
            going = going[at[going] >= 0]
            going = going[v[at[going]] >= v[going]]
        return at

    left = before(values)
    right = before(values[::-1])[::-1]
    return left, np.where(right >= 0, len(values) - 1 - right, -1)


def longest_previous_factors(common: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """For suffixes in sorted order, the longest prefix that each shares with one of a smaller rank.

    common[i] is the prefix that suffixes i - 1 and i share. The best earlier match
    is the previous or the next smaller rank in suffix order; what they share is
    the least common prefix on the way, found by doubling.
    """
    n = len(ranks)
    left, right = smaller_neighbours(ranks)
    levels = [common.copy()]
    while 1 << len(levels) <= n:
        half = 1 << (len(levels) - 1)
        levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
    best = np.zeros(n, common.dtype)
    here = np.arange(n)
    for a, b, some in ((left + 1, here, left >= 0), (here + 1, right, right >= 0)):
        at = np.flatnonzero(some)
        level = np.frexp((b[at] - a[at] + 1).astype(np.float64))[1] - 1
        for k in np.unique(level):
            rows = at[level == k]
            best[rows] = np.maximum(best[rows], np.minimum(levels[k][a[rows]], levels[k][b[rows] + 1 - (1 << k)]))
    return best


def earlier_windows(rows: np.ndarray, docs: np.ndarray, anchors: np.ndarray, length: int) -> np.ndarray:
    """For distinct contexts, a bit per window: whether a context of a smaller document holds it too."""
    masks = np.zeros(len(rows), np.uint32)
    order = np.argsort(anchors, kind="stable")
    sizes = rows[order, 1].astype(np.int64) + 1
    edges = np.flatnonzero(np.append(True, anchors[order][1:] != anchors[order][:-1]))
    alone = np.diff(np.append(edges, len(order))) == 1
    ends = np.append(edges[1:], len(order))
    i = 0
    total = np.concatenate([[0], np.cumsum(sizes)])
    while i < len(edges):
        j = i + 1
        while j < len(edges) and total[ends[j]] - total[edges[i]] <= WINDOWS_AT_ONCE:
            j += 1
        pick = order[edges[i] : ends[j - 1]]
        pick = pick[np.repeat(~alone[i:j], (ends - edges)[i:j])]
        i = j
        if not len(pick):
            continue
        count = rows[pick, 1].astype(np.int64) + 1
        owner = np.repeat(pick, count)
        window = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        columns = []
        for b in range(0, length, 8):
            value = np.zeros(len(owner), np.uint64)
            for k in range(b, min(b + 8, length)):
                value = (value << np.uint64(8)) | rows[owner, 2 + window + k]
            columns.append(value)
        suffixes = np.lexsort(columns[::-1])
        shared = np.zeros(len(owner), np.int16)
        going = np.ones(len(owner), bool)
        going[0] = False
        for c, b in zip(columns, range(0, length, 8), strict=True):
            s = c[suffixes]
            same = np.append(False, s[1:] == s[:-1])
            shared[going & same] = min(b + 8, length)
            going &= same
        ranks = docs[owner[suffixes]]
        hit = suffixes[longest_previous_factors(shared, ranks) >= length]
        np.bitwise_or.at(masks, owner[hit], (np.uint32(1) << window[hit].astype(np.uint32)))
    return masks


class _Chunk:
    """The texts of one chunk in order of their ids, and its runs; whole copies of earlier texts count as empty."""

    def __init__(self, table: pa.Table, length: int, copies: list[bytes], runs: bool = True) -> None:
        ids = table.column("_id").to_numpy()
        self.order = np.argsort(ids, kind="stable")
        self.ids = ids[self.order]
        self.table = table.take(pa.array(self.order))
        gone = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(x, np.int64) for x in copies]])
        self.copied = np.isin(self.ids, gone)
        if runs:
            body = self.table.column("_body").combine_chunks()
            self.table = self.table.set_column(
                self.table.column_names.index("_body"), "_body", pc.if_else(pa.array(self.copied), "", body)
            )
        self.data, self.offsets = W.buffers(self.table.column("_body"))
        self.length = length
        if runs:
            with np.errstate(over="ignore"):
                self.hashes, self.places, self.lows, self.highs, self.texts = anchor_runs(
                    self.data, self.offsets, length
                )

    def by_bucket(self, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Bucket, sorted distinct 32-bit values, whether several texts hold each, and the value's index per run with the runs' places."""
        bucket = (self.hashes % np.uint64(buckets)).astype(np.int64)
        value = (self.hashes // np.uint64(buckets)).astype(np.uint32)
        order = np.lexsort((self.texts, value, bucket))
        for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            if not len(part):
                continue
            v, t = value[part], self.texts[part]
            fresh = np.append(True, v[1:] != v[:-1])
            index = np.cumsum(fresh) - 1
            several = np.zeros(index[-1] + 1, bool)
            several[index[1:][~fresh[1:] & (t[1:] != t[:-1])]] = True
            yield int(bucket[part[0]]), v[fresh], several, np.stack([part, index])


def _bits(x: np.ndarray) -> bytes:
    return np.packbits(x).tobytes()


def _unbits(x: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(x, np.uint8), count=n).astype(bool)


def _packed(x: np.ndarray) -> bytes:
    """Bytes of x, as differences if it has one dimension, compressed."""
    if x.ndim == 1:
        x = np.diff(x, prepend=x.dtype.type(0))
        x = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T)
    return pa.Codec("zstd", compression_level=6).compress(x.tobytes(), asbytes=True)


def _unpacked(x: bytes, shape: tuple[int, ...], kind: type) -> np.ndarray:
    size = int(np.prod(shape)) * np.dtype(kind).itemsize
    flat = np.frombuffer(pa.decompress(x, decompressed_size=size, codec="zstd", asbytes=True), np.uint8)
    if len(shape) > 1:
        return flat.reshape(shape)
    return np.cumsum(np.ascontiguousarray(flat.reshape(-1, shape[0]).T).view(kind).ravel(), dtype=kind)


_VALUES = "bucket int, chunk int, n long, vals binary, several binary"
_ANSWERS = "chunk int, bucket int, shared binary, hot binary"
_CONTEXTS = "bucket int, chunk int, n long, rows binary, docs binary, runs long, owner binary, lows binary, texts binary"
_MASKS = "chunk int, n long, lows binary, masks binary"
#: In place of a bucket, for the ids of whole copies; in marks their number is below zero.
COPIES = -1
#: Less a chunk's number, in place of a bucket for what that chunk knows by itself.
LOCAL = -2


def _announce(buckets: int, length: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(table: pa.Table, copies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _table([], ["bucket", "chunk", "n", "vals", "several"], "iilbb")
        chunk = _Chunk(table, length, copies.column("shared").to_pylist())
        number = table.column("_chunk")[0].as_py()
        out = [
            (b, number, len(v), v.tobytes(), _bits(several)) for b, v, several, _ in chunk.by_bucket(buckets)
        ]
        return _table(out, ["bucket", "chunk", "n", "vals", "several"], "iilbb")

    return run


def _answer(hot_chunks: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        counts = table.column("n").to_pylist()
        values = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in table.column("vals")])
        several = np.concatenate(
            [_unbits(x.as_py(), n) for x, n in zip(table.column("several"), counts, strict=True)]
        )
        _, group, times = np.unique(values, return_inverse=True, return_counts=True)
        shared = (times > 1) | (np.bincount(group, several) > 0)
        hot = times > hot_chunks
        out, at = [], 0
        for chunk, n in zip(table.column("chunk").to_pylist(), counts, strict=True):
            own = group[at : at + n]
            at += n
            out.append((chunk, table.column("bucket")[0].as_py(), _bits(shared[own]), _bits(hot[own])))
        return _table(out, ["chunk", "bucket", "shared", "hot"], "iibb")

    return run


def _send(buckets: int, length: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        names = ["bucket", "chunk", "n", "rows", "docs", "runs", "owner", "lows", "texts"]
        replies = {r["bucket"]: r for r in answers.to_pylist()}
        copies = replies.pop(COPIES, None)
        if not replies or not table.num_rows:
            return _table([], names, "iilbblbbb")
        chunk = _Chunk(table, length, [copies["shared"]] if copies else [])
        picked, burst = [], []
        for b, v, _, (part, index) in chunk.by_bucket(buckets):
            shared, hot = (_unbits(replies[b][k], len(v)) for k in ("shared", "hot"))
            picked.append(part[shared[index] & ~hot[index]])
            burst.append(part[hot[index]])
        picked, burst = np.concatenate(picked), np.concatenate(burst)
        size = chunk.highs[burst] - chunk.lows[burst] + 1
        each = np.repeat(burst, size)
        single = chunk.lows[each] + np.arange(len(each)) - np.repeat(np.cumsum(size) - size, size)
        runs = np.concatenate([picked, each])
        lows = np.concatenate([chunk.lows[picked], single])
        highs = np.concatenate([chunk.highs[picked], single])
        if not len(runs):
            return _table([], names, "iilbblbbb")
        sort = np.lexsort((lows, chunk.texts[runs]))
        runs, lows, highs = runs[sort], lows[sort], highs[sort]
        is_single = (sort >= len(picked))
        with np.errstate(over="ignore"):
            rows = contexts(chunk.data, chunk.places[runs], lows, highs, length)
            one, two = row_hashes(rows)
        bucket = (np.where(is_single, one, chunk.hashes[runs]) % np.uint64(buckets)).astype(np.int64)
        order, group = group_rows(bucket.astype(np.uint64), one, two)
        fresh = np.append(True, np.diff(group[order]) > 0)
        lead = order[fresh]
        number = table.column("_chunk")[0].as_py()
        out = []
        # Runs are in order of their documents, so a group's first row is of its smallest one here. All later documents
        # of this chunk have every window earlier, whatever other chunks hold: only the first document's runs travel.
        later = chunk.texts[runs] > chunk.texts[runs[lead]][group]
        if later.any():
            whole = ((np.uint64(1) << (highs[later] - lows[later] + 1).astype(np.uint64)) - np.uint64(1)).astype(np.uint32)
            out.append(
                (
                    LOCAL - number, number, int(later.sum()), b"", b"", 0, _packed(whole), _packed(lows[later].astype(np.uint32)), b"",
                )
            )
            order = order[~later[order]]
        edges = np.append(np.flatnonzero(np.append(True, np.diff(group[order]) > 0)), len(order))
        for g in np.split(np.arange(len(lead)), np.flatnonzero(np.diff(bucket[lead])) + 1):
            mine = np.sort(order[edges[g[0]] : edges[g[-1] + 1]])
            heads = lead[g]
            out.append(
                (
                    int(bucket[heads[0]]), number, len(heads), _packed(rows[heads]),
                    _packed(chunk.ids[chunk.texts[runs[heads]]]), len(mine),
                    _packed((group[mine] - g[0]).astype(np.uint32)), _packed(lows[mine].astype(np.uint32)),
                    _packed(chunk.ids[chunk.texts[runs[mine]]]),
                )
            )
        return _table(out, names, "iilbblbbb")

    return run


def _judge(length: int) -> Callable[[pa.Table], pa.Table]:
    wide = (2 * length - GRAM + 2 + 7) // 8 * 8

    def run(table: pa.Table) -> pa.Table:
        sent = table.to_pylist()
        if sent[0]["bucket"] < 0:
            out = [(r["chunk"], r["n"], r["lows"], r["owner"]) for r in sent]
            return _table(out, ["chunk", "n", "lows", "masks"], "ilbb")
        rows = np.concatenate([_unpacked(r["rows"], (r["n"], wide), np.uint8) for r in sent])
        docs = np.concatenate([_unpacked(r["docs"], (r["n"],), np.int64) for r in sent])
        with np.errstate(over="ignore"):
            one, two = row_hashes(rows)
            order, group = group_rows(one, two)
            lead = order[np.append(True, np.diff(group[order]) > 0)]
            least = np.full(len(lead), np.iinfo(np.int64).max)
            np.minimum.at(least, group, docs)
            distinct = rows[lead]
            gram = np.zeros((len(lead), 24), np.uint8)
            gram[:, :GRAM] = np.take_along_axis(
                distinct, distinct[:, :1].astype(np.int64) + 2 + np.arange(GRAM), axis=1
            )
            anchors = row_hashes(gram)[0]
        found = earlier_windows(distinct, least, anchors, length)
        whole = ((np.uint64(1) << (distinct[:, 1].astype(np.uint64) + np.uint64(1))) - np.uint64(1)).astype(np.uint32)
        out, at = [], 0
        for r in sent:
            own = group[at : at + r["n"]]
            at += r["n"]
            here = own[_unpacked(r["owner"], (r["runs"],), np.uint32)]
            held = _unpacked(r["texts"], (r["runs"],), np.int64)
            masks = np.where(held > least[here], whole[here], found[here])
            some = masks != 0
            if some.any():
                lows = _unpacked(r["lows"], (r["runs"],), np.uint32)[some]
                out.append((r["chunk"], int(some.sum()), _packed(lows), _packed(masks[some])))
        return _table(out, ["chunk", "n", "lows", "masks"], "ilbb")

    return run


def _whole_characters(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """gone less the bytes of characters that aren't gone as a whole; a character of UTF-8 has up to three bytes behind its first."""
    inner = (data & 0xC0) == 0x80
    if not inner.any():
        return gone
    whole = gone.copy()
    for _ in range(3):
        whole[:-1] = gone[:-1] & (~inner[1:] | whole[1:])
    for _ in range(3):
        whole[1:] = np.where(inner[1:], whole[:-1], whole[1:])
    return whole


def _finish(length: int, whole_characters: bool, carried: list[str]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(table: pa.Table, marks: pa.Table) -> pa.Table:
        sent = marks.to_pylist()
        chunk = _Chunk(table, length, [r["lows"] for r in sent if r["n"] < 0], runs=False)
        n = len(chunk.data)
        steps = np.zeros(n + 1, np.int32)
        sizes = np.diff(chunk.offsets)
        copied = chunk.copied & (sizes >= length)
        np.add.at(steps, chunk.offsets[:-1][copied], 1)
        np.add.at(steps, chunk.offsets[1:][copied], -1)
        # Runs were placed as if whole copies were empty.
        placed = np.concatenate([[0], np.cumsum(np.where(chunk.copied, 0, sizes))])
        for r in sent:
            if r["n"] < 0:
                continue
            lows = _unpacked(r["lows"], (r["n"],), np.uint32).astype(np.int64)
            masks = _unpacked(r["masks"], (r["n"],), np.uint32)
            text = np.searchsorted(placed, lows, side="right") - 1
            lows += chunk.offsets[text] - placed[text]
            for k in range(length - GRAM + 1):
                at = lows[(masks >> np.uint32(k)) & np.uint32(1) == 1] + k
                np.add.at(steps, at, 1)
                np.add.at(steps, at + length, -1)
        np.cumsum(steps, out=steps)
        gone = steps[:-1] > 0
        if whole_characters and n:
            gone = _whole_characters(chunk.data, gone)
        stay = chunk.data[~gone]
        # The places of the counts of steps, which are no longer needed.
        steps[0] = 0
        np.cumsum(~gone, out=steps[1:])
        left = steps[chunk.offsets]
        del steps
        first = gone.copy()
        first[1:] &= ~gone[:-1]
        edges = chunk.offsets[1:-1]
        edges = edges[edges < n]
        first[edges] = gone[edges]
        last = gone.copy()
        last[:-1] &= ~gone[1:]
        last[edges[edges > 0] - 1] = gone[edges[edges > 0] - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        per_text = np.searchsorted(starts, chunk.offsets)
        base = np.repeat(chunk.offsets[:-1], np.diff(per_text))
        spans = pa.ListArray.from_arrays(
            pa.array(per_text.astype(np.int32)),
            pa.StructArray.from_arrays(
                [pa.array(starts - base), pa.array(ends - base)], ["start", "end"]
            ),
        )
        kept = pa.Array.from_buffers(
            pa.large_binary(), len(chunk.ids), [None, pa.py_buffer(left.astype(np.int64)), pa.py_buffer(stay.tobytes())]
        ).cast(pa.binary())
        if whole_characters:
            kept = kept.cast(pa.string())
        arrays = [chunk.table.column(c) for c in ["_id", *carried]]
        return pa.table([*arrays, pa.array(np.diff(chunk.offsets)), spans, kept], names=["_id", *carried, "_n", "_spans", "_kept"])

    return run


_KINDS = {"i": pa.int32(), "l": pa.int64(), "b": pa.binary()}


def _table(rows: list[tuple], names: list[str], kinds: str) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.table([pa.array(list(c), _KINDS[k]) for c, k in zip(columns, kinds, strict=True)], names=names)


def _whole_copies(texts: DataFrame) -> DataFrame:
    """Per chunk the ids of texts that equal one with a smaller id, as packed little-endian longs.

    The smallest id of a text is found by partial aggregation, so a text that a
    third of all documents repeat costs one row per task.
    """

    def run(table: pa.Table) -> pa.Table:
        ids = np.sort(table.column("id").to_numpy())
        return _table(
            [(table.column("chunk")[0].as_py(), COPIES, ids.tobytes(), b"")], ["chunk", "bucket", "shared", "hot"], "iibb"
        )

    keyed = texts.where("body <> ''").select("chunk", "id", F.unhex(F.sha2("body", 256)).alias("key"))
    firsts = keyed.groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    copied = keyed.join(firsts, "key").where("id <> first").select("chunk", "id")
    return copied.groupBy("chunk").applyInArrow(run, _ANSWERS)


def remove_earlier_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 50,
    whole_characters: bool = False,
    carry: list[str] | None = None,
    chunk_bytes: int = CHUNK_BYTES,
    hot_chunks: int = HOT_CHUNKS,
) -> DataFrame:
    """One row per document: the id, the columns in carry, n_bytes, removed_spans and kept.

    Every byte is removed that lies in a string of `length` bytes which also
    starts in a document with a smaller id; strings are judged on the input, and
    matches never cross documents. kept is binary, or with whole_characters a
    string from which only wholly covered characters have gone. Null texts count
    as empty; ids must be unique and not null; repeated texts lose all but the
    copy with the smallest id, unless shorter than `length`. An empty table gives
    no rows, and columns of any name may stand beside id and text. A chunk of
    about chunk_bytes of text is what one task holds; raise it with the memory of
    the workers, since every chunk sends a row to every bucket.
    """
    if not GRAM + 8 <= length <= GRAM + 31:
        raise ValueError(f"length must be from {GRAM + 8} to {GRAM + 31}")
    carry = carry or []
    size = docs.select(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    pieces = max(1, -(-size // chunk_bytes))
    buckets = -(-pieces // 2)
    names = [f"_c{i}" for i in range(len(carry))]
    doc = F.col(id_col).cast("long")
    chunk: Column = F.pmod(F.xxhash64(doc, F.lit("chunk")), F.lit(pieces)).cast("int")
    source = docs.select(
        chunk.alias("_chunk"),
        doc.alias("_id"),
        F.col(text_col).alias("_body"),
        *[F.col(c).alias(n) for c, n in zip(carry, names, strict=True)],
    ).repartition("_chunk")
    copies = _whole_copies(docs.select(chunk.alias("chunk"), doc.alias("id"), F.col(text_col).alias("body")))
    values = source.groupBy("_chunk").cogroup(copies.groupBy("chunk")).applyInArrow(trimmed(_announce(buckets, length)), _VALUES)
    answers = values.groupBy("bucket").applyInArrow(trimmed(_answer(hot_chunks)), _ANSWERS)
    replies = answers.unionByName(copies)
    sent = (
        source.groupBy("_chunk").cogroup(replies.groupBy("chunk")).applyInArrow(trimmed(_send(buckets, length)), _CONTEXTS)
    )
    marks = sent.groupBy("bucket").applyInArrow(trimmed(_judge(length)), _MASKS)
    marks = marks.unionByName(
        copies.select("chunk", F.lit(-1).cast("long").alias("n"), F.col("shared").alias("lows"), F.col("hot").alias("masks"))
    )
    kinds = "".join(f", {n} {docs.schema[c].dataType.simpleString()}" for c, n in zip(carry, names, strict=True))
    out = (
        source.groupBy("_chunk")
        .cogroup(marks.groupBy("chunk"))
        .applyInArrow(
            trimmed(_finish(length, whole_characters, names)),
            f"_id long{kinds}, _n long, _spans array<struct<start: long, end: long>>, "
            f"_kept {'string' if whole_characters else 'binary'}",
        )
    )
    return out.select(
        F.col("_id").alias(id_col),
        *[F.col(n).alias(c) for c, n in zip(carry, names, strict=True)],
        F.col("_n").alias("n_bytes"),
        F.col("_spans").alias("removed_spans"),
        F.col("_kept").alias("kept"),
    )

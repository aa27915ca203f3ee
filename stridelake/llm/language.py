"""Language identification: averaged hashed subword embeddings under a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.llm.cluster import sound_text, text_slices

UNKNOWN = "und"
WIDTHS = (2, 3, 4)
BUCKETS = 1 << 16
#: The fit reads about so many labelled rows in all, dealt evenly over languages, and so many characters of each.
SAMPLE_ROWS, SAMPLE_CHARS = 2400, 20_000
#: The fit learns so many languages, the most frequent ones.
MAX_LANGUAGES = 1000
LETTER = regex.compile(r"\p{L}")

#: Bytes that separate words: all ASCII but letters.
_BYTE = np.arange(256, dtype=np.uint8)
_BYTE[:128][~np.array([chr(i).isalpha() for i in range(128)])] = 0x20


def subwords(texts: list[str]) -> tuple[list[np.ndarray], list[tuple[np.ndarray, np.ndarray]]]:
    """For each width the bucket of every byte n-gram of the letters, and the first and end place of each text's."""
    raw = [b" " + t.lower().encode("utf-8", "replace") + b" " for t in texts]
    data = _BYTE[np.frombuffer(b"".join(raw), np.uint8)]
    owner = np.repeat(np.arange(len(raw)), [len(x) for x in raw])
    blank = data == 0x20
    keep = np.ones(len(data), bool)
    keep[1:] = ~(blank[1:] & blank[:-1] & (owner[1:] == owner[:-1]))
    data, owner = data[keep].astype(np.uint32), owner[keep]
    bounds = np.searchsorted(owner, np.arange(len(raw) + 1))
    grams, places = [], []
    for width in WIDTHS:
        n = max(len(data) - width + 1, 0)
        hashed = np.full(n, width * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        for k in range(width):
            hashed = (hashed ^ data[k : k + n]) * np.uint32(0x01000193)
            hashed ^= hashed >> np.uint32(15)
        grams.append((hashed % np.uint32(BUCKETS)).astype(np.int64))
        places.append((bounds[:-1], np.maximum(bounds[1:] - width + 1, bounds[:-1])))
    return grams, places


@dataclass(frozen=True)
class LanguageModel:
    """Scores per bucket (embedding times output layer), bias, calibrated temperature and least accepted score."""

    languages: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    least_score: float = 0.0

    def logits(self, texts: list[str]) -> np.ndarray:
        out = np.tile(self.bias.astype(np.float64), (len(texts), 1))
        grams, places = subwords(texts)
        total, count = np.zeros_like(out), np.zeros(len(texts))
        for hashed, (first, end) in zip(grams, places, strict=True):
            some = end > first
            if some.any():
                values = self.table[hashed]
                values = np.vstack([values, np.zeros((1, values.shape[1]), values.dtype)])
                pairs = np.stack([first[some], end[some]], 1).ravel()
                total[some] += np.add.reduceat(values, pairs, axis=0)[::2]
                count += end - first
        return out + total / np.maximum(count, 1)[:, None]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        known = [t or "" for t in texts]
        lettered = np.array([bool(LETTER.search(t)) for t in known], bool)
        if not self.languages:
            return [UNKNOWN] * len(known), np.zeros(len(known))
        z = self.logits(known) / self.temperature
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        names = [self.languages[k] if ok else UNKNOWN for k, ok in zip(best, lettered, strict=True)]
        return names, np.where(lettered, p[np.arange(len(best)), best], 0.0)

    def accepts(self, names: list[str], scores: np.ndarray) -> np.ndarray:
        return (scores >= self.least_score) & (np.array(names, object) != UNKNOWN)


def fit(
    texts: list[str], labels: list[str], dims: int = 16, epochs: int = 4, rate: float = 8.0, seed: int = 7
) -> LanguageModel:
    """Stochastic gradient descent on four fifths of the rows; the last fifth calibrates.

    The temperature is the one with the least log loss there. The least accepted
    score lies halfway between chance and the lowest score of those rows that are
    named rightly, for the few that a larger sample would name with less; it never
    exceeds what turns away 99 % of texts of random letters, which are of no
    language. No rows give a model without languages.
    """
    languages = tuple(sorted(set(labels)))
    if not languages:
        return LanguageModel((), np.zeros((BUCKETS, 1), np.float32), np.zeros(1))
    rng = np.random.default_rng(seed)
    targets = np.array([languages.index(x) for x in labels])
    order = rng.permutation(len(texts))
    held, taught = order[: len(order) // 5], order[len(order) // 5 :]
    features = {}
    for i in taught:
        grams, places = subwords([texts[i]])
        ids, times = np.unique(
            np.concatenate([g[a[0] : b[0]] for g, (a, b) in zip(grams, places, strict=True)]), return_counts=True
        )
        features[i] = ids.astype(np.uint16), (times / max(times.sum(), 1)).astype(np.float32)
    inputs = rng.normal(0, 0.1, (BUCKETS, dims)).astype(np.float32)
    outputs = rng.normal(0, 0.1, (dims, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    steps, done = epochs * len(taught), 0
    for _ in range(epochs):
        for i in rng.permutation(taught):
            ids, share = features[i]
            now = rate * (1 - done / steps)
            done += 1
            hidden = share @ inputs[ids]
            z = hidden @ outputs + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[targets[i]] -= 1
            back = outputs @ p
            outputs -= 0.1 * now * np.outer(hidden, p)
            bias -= 0.01 * now * p
            inputs[ids] -= now * np.outer(share, back)
    model = LanguageModel(languages, inputs @ outputs, bias)
    return _calibrated(model, [texts[i] for i in held], targets[held]) if len(held) else model


def _calibrated(model: LanguageModel, texts: list[str], targets: np.ndarray) -> LanguageModel:
    z = np.vstack([model.logits(texts[i : i + 256]) for i in range(0, len(texts), 256)])
    right = np.arange(len(targets)), targets

    def shares(t: float) -> np.ndarray:
        p = np.exp((z - z.max(axis=1, keepdims=True)) / t)
        return p / p.sum(axis=1, keepdims=True)

    grid = [0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0]
    best = min(grid, key=lambda t: float(-np.log(shares(t)[right] + 1e-12).mean()))
    p = shares(best)
    scores = p.max(axis=1)[p.argmax(axis=1) == targets]
    model = LanguageModel(model.languages, model.table, model.bias, best)
    rng = np.random.default_rng(len(texts))
    letters = np.array(sorted({c for t in texts for c in t.lower() if c.isalpha()}) or ["a"])
    strange = [" ".join("".join(rng.choice(letters, n)) for n in rng.integers(2, 10, 60)) for _ in range(200)]
    chance = 1 / len(model.languages)
    least = min((chance + float(scores.min())) / 2, float(np.quantile(model.predict(strange)[1], 0.99))) if len(scores) else 0.0
    return LanguageModel(model.languages, model.table, model.bias, best, least)


def is_held_out(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % 3 == 1


def fit_on(docs: DataFrame, id_col: str, text_col: str, lang_col: str, rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Fit on about `rows` labelled rows that aren't held out, the same number of each language where it has them.

    Rows are drawn by a hash of their id at a rate that the counts per language
    set, so that the sample stays bounded at any size and doesn't depend on order.
    """
    labelled = docs.where(
        F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull() & ~is_held_out(F.col(id_col))
    )
    counts = labelled.groupBy(F.col(lang_col).alias("lang")).count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    if not counts:
        return fit([], [])
    share = rows / len(counts)
    limits = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(int(min(1.0, share / r["count"]) * 2**30)))])
    drawn = labelled.where(
        F.pmod(F.xxhash64(F.col(id_col), F.lit("language")), F.lit(2**30)) < limits[F.col(lang_col)]
    ).select(F.col(id_col).alias("doc_id"), F.substring(F.col(text_col), 1, SAMPLE_CHARS).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    sample = sorted(drawn.collect(), key=lambda r: (r["doc_id"], r["text"], r["lang"]))
    return fit([r["text"] for r in sample], [r["lang"] for r in sample])


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    model: LanguageModel | None = None,
) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, accepted.

    Without a model, one is fitted on labelled rows of docs (see fit_on); only
    the text enters a prediction. A null text or one without a letter is `und`
    with score 0. accepted is false for these and for scores under the calibrated
    least one. Null languages aren't learnt, repeated rows give repeated rows, an
    empty table gives none, and other columns are ignored.
    """
    model = model or fit_on(docs, id_col, text_col, lang_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        for batch in batches:
            for part in text_slices(batch, "text", 1 << 20):
                names, scores = found.predict(sound_text(part.column(2)).to_pylist())
                accepted = found.accepts(names, scores)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(scores), pa.array(accepted)],
                    ["doc_id", "held_out", "lang_pred", "score", "accepted"],
                )

    source = docs.select(
        F.col(id_col).alias("doc_id"), is_held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text")
    )
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, accepted boolean")


def accepted_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    model: LanguageModel | None = None,
) -> DataFrame:
    """The rows of docs, all columns as they are, whose language isn't rejected (see identify); nothing is shuffled.

    Rows with a null text or one without a letter are rejected; null or repeated
    ids and nulls in other columns change nothing.
    """
    model = model or fit_on(docs, id_col, text_col, lang_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        for batch in batches:
            for part in text_slices(batch, text_col, 1 << 19):
                names, scores = found.predict(sound_text(part.column(place)).to_pylist())
                yield part.filter(pa.array(found.accepts(names, scores)))

    return docs.mapInArrow(run, docs.schema)

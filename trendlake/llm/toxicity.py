"""Toxicity: a convolutional text classifier on hashed word embeddings, trained in numpy.

A word is a run of letters and digits of the lower-cased text. Its vector is the sum of
hashed embeddings of the word and of its first four, five and seven bytes, so inflected forms of
a known stem score alike. Filters of several widths run over the words; each filter's
maximum over the whole text, at least 0, feeds a logistic layer. Thresholds are
calibrated by language on documents the weights haven't seen, and logits are shifted so
that score 0.5 is the threshold. The language is guessed from the text's own function
words: labels, lang, source and doc_id are no inputs of a score.

Training set: of each class the ``train_rows`` labelled rows, not held out and of at most
``train_chars`` characters, whose doc_ids have the smallest hashes (documented bounds:
the driver holds at most their product). The first embedding column starts from the
classes' smoothed log odds of each bucket on these rows, and the first filter of each
width reads it; stochastic gradients refine all weights. Everything is seeded.

Scoring is a map over Arrow batches without a shuffle. Whole texts are read, in pieces of
bounded size that overlap by the widest filter, so memory doesn't follow a text's length.

Defined results: null, empty or wordless text: all maxima are 0 (one fixed score). Null
labels are not learned from. Without labelled rows of both classes: score 0, predicted
0 everywhere. Null doc_id: crc32 of the empty string, so held out. Repeated rows: same
score each. Empty table: empty result. Extra columns are ignored by the report and
kept by the filter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.llm.hashing import CHUNK, Words, chunks, folded, mix
from trendlake.llm.tasks import map_batches

BUCKETS = 1 << 16
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8  # of each width
PREFIXES = (4, 5, 7)  # bytes
PRIOR = 2.0  # documents a bucket is taken to have been seen in beforehand
TRAIN_ROWS = 3000  # of each class
TRAIN_CHARS = 20_000
EPOCHS = 4
BATCH = 32
RATE = 0.05
CALIBRATION = 3  # every third training row calibrates instead
LEAST = 20  # calibration rows of each class that a language needs for a threshold of its own
GROUP = CHUNK // 4  # bytes of short texts scored together

# Function words that tell the corpus languages apart.
FUNCTION_WORDS = {
    "en": ["the", "of", "and", "to", "is", "was", "for", "with", "that", "this", "are", "by"],
    "de": ["der", "die", "das", "und", "ist", "nicht", "von", "den", "im", "mit", "zu", "sich"],
    "fr": ["le", "la", "les", "des", "du", "et", "est", "une", "dans", "pour", "avec", "sur"],
    "es": ["el", "los", "las", "del", "y", "una", "que", "por", "con", "para", "su", "se"],
}
LANGS = list(FUNCTION_WORDS)
_KNOWN = sorted((int(Words(w.encode()).hashes()[0]), LANGS.index(lang)) for lang, ws in FUNCTION_WORDS.items() for w in ws)
_KNOWN_HASH = np.array([h for h, _ in _KNOWN], np.uint64)
_KNOWN_LANG = np.array([i for _, i in _KNOWN], np.int64)


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def buckets(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of at most CHUNK bytes: [word, 1 + prefixes] buckets (0: none), language numbers (-1: none)
    and first bytes of the words."""
    w = Words(data)
    out = np.zeros((len(w.start), 1 + len(PREFIXES)), np.int64)
    whole = w.hashes()
    out[:, 0] = 1 + whole % np.uint64(BUCKETS - 1)
    for k, size in enumerate(PREFIXES, 1):
        long = np.flatnonzero(w.end - w.start > size)
        s = w.start[long]
        out[long, k] = 1 + mix(w.hashes(s, s + size) + np.uint64(k)) % np.uint64(BUCKETS - 1)
    at = np.minimum(np.searchsorted(_KNOWN_HASH, whole), len(_KNOWN_HASH) - 1)
    return out, np.where(_KNOWN_HASH[at] == whole, _KNOWN_LANG[at], -1), w.start


def units(texts: list[str | None]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, buckets, languages, row number within rows of each word) of short texts together and
    of long ones in pieces; a later piece begins with the last words of the one before it."""
    rows: list[int] = []
    held: list[bytes] = []

    def joined() -> tuple:
        ids, lang, start = buckets(b"\n".join(held))
        return rows, ids, lang, np.searchsorted(np.cumsum([len(d) + 1 for d in held]), start, "right")

    for row, text in enumerate(texts):
        data = folded(text)
        if len(data) > GROUP:
            tail = np.zeros((0, 1 + len(PREFIXES)), np.int64)
            for a, b in chunks(data):
                ids, lang, _ = buckets(data[a:b])
                ids = np.concatenate([tail, ids])
                yield [row], ids, np.concatenate([np.full(len(tail), -1), lang]), np.zeros(len(ids), np.int64)
                tail = ids[len(ids) - min(len(ids), max(WIDTHS) - 1):]
            continue
        if sum(map(len, held)) + len(held) + len(data) > GROUP:
            yield joined()
            rows, held = [], []
        rows.append(row)
        held.append(data)
    if held:
        yield joined()


@dataclass
class Model:
    embedding: np.ndarray
    filters: dict[int, np.ndarray]  # width -> [width * DIM, FILTERS]
    weights: np.ndarray
    bias: float = 0.0
    shift: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGS)))

    def embed(self, ids: np.ndarray) -> np.ndarray:
        return sum(self.embedding[ids[:, k]] for k in range(ids.shape[1]))

    def pooled(self, e: np.ndarray, doc: np.ndarray, n: int, places: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """[text, filter] maxima (at least 0) and, if asked for, the word where each begins (-1: none)."""
        top = np.zeros((n, len(WIDTHS) * FILTERS), np.float32)
        where = np.full(top.shape, -1, np.int64)
        for k, w in enumerate(WIDTHS):
            m = len(e) - w + 1
            if m < 1:
                continue
            inside = np.flatnonzero(doc[:m] == doc[w - 1:])
            if not len(inside):
                continue
            out = sum(e[j:j + m] @ self.filters[w][j * DIM:(j + 1) * DIM] for j in range(w))[inside]
            d = doc[inside]
            first = np.flatnonzero(np.concatenate(([True], d[1:] != d[:-1])))
            most = np.maximum.reduceat(out, first, axis=0)
            cell = slice(k * FILTERS, (k + 1) * FILTERS)
            top[d[first], cell] = np.maximum(most, 0)
            if places:
                again = np.repeat(most, np.diff(np.append(first, len(d))), axis=0)
                at = np.minimum.reduceat(np.where(out == again, inside[:, None], len(e)), first, axis=0)
                where[d[first], cell] = np.where(most > 0, at, -1)
        return top, where

    def logits(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The texts' logits before the shift, and their languages."""
        top = np.zeros((len(texts), len(self.weights)), np.float32)
        said = np.zeros((len(texts), len(LANGS)), np.int64)
        for rows, ids, lang, doc in units(texts):
            part, _ = self.pooled(self.embed(ids), doc, len(rows))
            top[rows] = np.maximum(top[rows], part)
            known = lang >= 0
            np.add.at(said, (np.array(rows)[doc[known]], lang[known]), 1)
        return top @ self.weights + self.bias, said.argmax(axis=1)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        z, lang = self.logits(texts)
        return 1 / (1 + np.exp(-np.clip(z - self.shift[lang], -30, 30).astype(np.float64)))


def start_model(ids: list[np.ndarray], y: np.ndarray, rng: np.random.Generator) -> Model:
    n = np.array([(1 - y).sum(), y.sum()], np.float64)
    seen = np.repeat(PRIOR * n[:, None] / n.sum(), BUCKETS, axis=1)  # so an unseen bucket has odds 0
    for x, label in zip(ids, y):
        seen[int(label), np.unique(x)] += 1
    odds = np.log(seen[1] / n[1]) - np.log(seen[0] / n[0])
    odds[0] = 0
    e = rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32)
    e[:, 0] = odds / 2
    e[0] = 0
    filters = {w: rng.normal(0, 0.3, (w * DIM, FILTERS)).astype(np.float32) for w in WIDTHS}
    for w in WIDTHS:
        filters[w][:, 0] = 0
        filters[w][::DIM, 0] = 1 / w
    weights = rng.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32)
    weights[::FILTERS] = 1
    return Model(e, filters, weights, -2.0)


def fit(texts: list[str], y: np.ndarray, epochs: int = EPOCHS, seed: int = 1) -> Model:
    """Stochastic gradients with per-weight rates (Adagrad); only the words where a maximum begins move."""
    rng = np.random.default_rng(seed)
    ids = [np.concatenate([i for _, i, _, _ in units([t])]).astype(np.int32) for t in texts]
    model = start_model(ids, y, rng)
    seen = {id(p): np.full(p.shape, 0.1, np.float32) for p in (model.embedding, model.weights, *model.filters.values())}

    def move(p: np.ndarray, grad: np.ndarray, rows: np.ndarray | slice = slice(None)) -> None:
        g = seen[id(p)]
        g[rows] += grad * grad
        p[rows] -= RATE * grad / np.sqrt(g[rows])

    for _ in range(epochs):
        order = rng.permutation(len(ids))
        for at in range(0, len(order), BATCH):
            some = order[at:at + BATCH]
            x = np.concatenate([ids[i] for i in some])
            doc = np.repeat(np.arange(len(some)), [len(ids[i]) for i in some])
            e = model.embed(x)
            top, where = model.pooled(e, doc, len(some), places=True)
            z = np.clip(top @ model.weights + model.bias, -30, 30)
            err = ((1 / (1 + np.exp(-z)) - y[some]) / len(some)).astype(np.float32)
            back = err[:, None] * model.weights
            d_e = np.zeros_like(e)
            for k, w in enumerate(WIDTHS):
                d_f = np.zeros_like(model.filters[w])
                row, f = np.nonzero(where[:, k * FILTERS:(k + 1) * FILTERS] >= 0)
                begin, g = where[row, k * FILTERS + f], back[row, k * FILTERS + f]
                for j in range(w):
                    block = slice(j * DIM, (j + 1) * DIM)
                    np.add.at(d_f[block].T, f, g[:, None] * e[begin + j])
                    np.add.at(d_e, begin + j, g[:, None] * model.filters[w][block].T[f])
                move(model.filters[w], d_f)
            moved = np.flatnonzero(d_e.any(axis=1))
            rows, back_to = np.unique(x[moved], return_inverse=True)
            grad = np.zeros((len(rows), DIM), np.float32)
            for k in range(x.shape[1]):
                np.add.at(grad, back_to.reshape(len(moved), -1)[:, k], d_e[moved])
            grad[rows == 0] = 0
            move(model.embedding, grad, rows)
            move(model.weights, err @ top)
            model.bias -= RATE * float(err.sum())
    return model


def best_threshold(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The middle of the gap between two logits whose threshold has the best weighted F1."""
    order = np.argsort(-z, kind="stable")
    z, hit, miss = z[order], (y * weight)[order].cumsum(), ((1 - y) * weight)[order].cumsum()
    f1 = 2 * hit / (hit + miss + hit[-1])
    last = np.append(z[1:] < z[:-1], True)  # a threshold can't part equal logits
    i = int(np.argmax(np.where(last, f1, -1)))
    return float((z[i] + z[i + 1]) / 2) if i + 1 < len(z) else float(z[i] - 1)


def calibrate(model: Model, texts: list[str], y: np.ndarray, share: float) -> None:
    """Sets each language's threshold; ``share``: how often label 1 is among all labelled rows."""
    z, lang = model.logits(texts)
    weight = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    model.shift[:] = best_threshold(z, y, weight)
    for k in range(len(LANGS)):
        own = lang == k
        if min(y[own].sum(), (1 - y[own]).sum()) >= LEAST:
            model.shift[k] = best_threshold(z[own], y[own], weight[own])


def train(docs: DataFrame, labels: DataFrame, text: str = "text", train_rows: int = TRAIN_ROWS,
          train_chars: int = TRAIN_CHARS) -> Model | None:
    """The model of the labelled rows that aren't held out; None without rows of both classes."""
    marked = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_y")).filter("_y is not null")
    marked = marked.groupBy("_id").agg(F.max("_y").alias("_y")).filter(~held_out(F.col("_id")))
    counts = {r["_y"]: r["count"] for r in marked.groupBy("_y").count().collect()}
    if not (counts.get(0) and counts.get(1)):
        return None
    rows = []
    for y in (0, 1):
        # twice as many ids as needed, as some have no text or a very long one
        some = marked.filter(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(2 * train_rows)
        got = (docs.select(F.col("doc_id").alias("_d"), F.col(text).alias("_t")).filter(F.length("_t") <= train_chars)
               .join(some, F.col("_d") == F.col("_id")).groupBy("_d").agg(F.min("_t").alias("_t"))
               .orderBy(F.xxhash64("_d"), "_d").limit(train_rows).select("_d", "_t"))
        rows += [(zlib.crc32(str(r["_d"]).encode()), r["_t"], y) for r in got.collect()]
    rows.sort()
    y = np.array([r[2] for r in rows])
    if len(set(y.tolist())) < 2:
        return None
    held = np.arange(len(rows)) % CALIBRATION == 0
    texts = [r[1] for r in rows]
    model = fit([t for t, h in zip(texts, held) if not h], y[~held])
    if 0 < y[held].sum() < held.sum():
        calibrate(model, [t for t, h in zip(texts, held) if h], y[held], counts[1] / (counts[0] + counts[1]))
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", **options) -> DataFrame:
    """doc_id, held_out, score, predicted per row of ``docs``."""
    model = train(docs, labels, text, **options)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(text).alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = model.scores(batch.column("text").to_pylist()) if model else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(s, pa.float64()),
                 pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return map_batches(rows, score, f"doc_id {dict(rows.dtypes)['doc_id']}, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that aren't predicted toxic."""
    model = train(docs, labels, text, **options)
    if model is None:
        return docs
    at = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.scores(batch.column(at).to_pylist()) < 0.5))

    return map_batches(docs, keep, docs.schema)

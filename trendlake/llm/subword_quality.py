"""Quality classifier: hashed word and character n-gram vectors, averaged, with a softmax output.

Features of a text, each hashed to one of ``BUCKETS`` learned vectors, in three kinds:

- words: each word and each pair of neighbouring words (a word after itself is one feature,
  whatever the word);
- characters: the stretches of 3 to 5 code points of a word and the spaces around it;
- outlines: a word's sequence of character classes (runs of lower-case, upper-case letters
  and digits count once, a mark stands for itself), its length class and whether a line
  begins before it; alone and with one or two words before.

A document's vector is the mean over the kinds of the mean vector of the kind's features.
A softmax layer gives the two classes. Both are learned in numpy by stochastic gradients,
a document at a time, with per-weight rates (Adagrad).

Training set: of each class the ``train_rows`` labelled rows, not held out and of at most
``train_chars`` characters, whose doc_ids have the smallest hashes (documented bounds: the
driver holds at most their product). A third of them isn't learned from but sets the
output's offset, so that score 0.3 parts the classes best there. Everything is seeded.

Scoring is a map over Arrow batches without a shuffle. As the output is linear in the
vectors, each bucket's share of the output is worked out once, and a feature costs one
lookup. Whole texts are read, in pieces of bounded size that carry the two words before
(a word of over ``PIECE`` characters counts as several).

Defined results: null, empty or wordless text: no features, so the offset alone gives one
fixed score. Null labels are not learned from; several labels of a document: the largest.
Without labelled rows of both classes: score 1, predicted 1 everywhere. Null doc_id: crc32
of the empty string, so held out. Repeated rows: same score each. Empty table: empty
result. Extra columns are ignored by the report and kept by the filter.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.llm.hashing import FACTOR, mix
from trendlake.llm.tasks import map_batches
from trendlake.llm.text import WS
from trendlake.llm.toxicity import held_out

BUCKET_BITS = 17
BUCKETS = 1 << BUCKET_BITS
DIM = 8
GRAMS = (3, 4, 5)
KINDS = 3
TRAIN_ROWS = 2000  # of each class
TRAIN_CHARS = 20_000
EPOCHS = 6
RATE = 0.3
CALIBRATION = 3  # every third training row calibrates instead
LIMIT = 0.3  # score from which a document is predicted good
PIECE = 1 << 16  # characters of text worked on at a time

_SHIFT = np.uint64(64 - BUCKET_BITS)
_PLACES = [np.uint64(pow(int(FACTOR), k + 1, 1 << 64)) for k in range(max(GRAMS))]
_REPEATED = np.uint64(0x5DEECE66D)
WORD = re.compile(r"[^\x20\x09-\x0D]+")

# Character classes of the outlines: white space 0, letters and digits by kind, any other ASCII character itself.
SPACE, LOWER, UPPER, DIGIT = 0, 1, 2, 3
CLASS = np.arange(129, dtype=np.uint8)
CLASS[[32, *range(9, 14)]] = SPACE
CLASS[ord("a"):ord("z") + 1] = LOWER
CLASS[ord("A"):ord("Z") + 1] = UPPER
CLASS[ord("0"):ord("9") + 1] = DIGIT
CLASS[[0, 1, 2, 3]] = 4
CLASS[128] = LOWER  # anything beyond ASCII


def bucket(h: np.ndarray) -> np.ndarray:
    return (h * FACTOR >> _SHIFT).astype(np.int64)


def spans_hashed(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each span of ``values`` (uint64), whatever its place."""
    back = np.uint64(pow(int(FACTOR), -1, 1 << 64))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(np.cumprod(np.full(len(values), FACTOR), dtype=np.uint64) * (values + np.uint64(1)), out=total[1:])
    inverse = np.cumprod(np.full(len(values) + 1, back), dtype=np.uint64)
    return mix((total[end] - total[start]) * inverse[start])


def features(text: str, ends: np.ndarray, skip: int = 0, line_first: bool = True) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, text of each) of each kind, of texts that each end in a line feed.

    ``ends``: where each ends; ``skip``: so many first words are there for the words after them only;
    ``line_first``: whether a line begins before the first word.
    """
    code = np.frombuffer(f"\n{text}".encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = CLASS[np.minimum(code, 128)]
    gap = kind == SPACE
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    start, end = edge[::2], edge[1::2]
    doc = np.concatenate(([0], np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))))  # of each place
    word_doc = doc[start]
    feeds = np.concatenate(([0], np.cumsum(code == 10, dtype=np.int32)))
    code = np.where(gap, 32, code).astype(np.uint64)

    word = spans_hashed(code, start, end)
    pair = np.where(word[1:] == word[:-1], _REPEATED, mix(word[:-1] * FACTOR + word[1:]))
    same = word_doc[1:] == word_doc[:-1]
    second = np.flatnonzero(same)  # a word follows in the same text
    second = second[second + 1 >= skip]
    words = [(word[skip:], word_doc[skip:]), (pair[second], word_doc[second])]

    grams = []
    if skip < len(start):
        first = start[skip] - 1
        spaces = np.concatenate(([0], np.cumsum(gap, dtype=np.int32)))
        h = code[first:] * _PLACES[0]
        for n in range(2, max(GRAMS) + 1):
            m = max(len(code) - first - n + 1, 0)
            h = h[:m] + code[first + n - 1:] * _PLACES[n - 1]
            if n in GRAMS:  # no space but at the ends
                inside = np.flatnonzero(spaces[first + n - 1:first + n - 1 + m] == spaces[first + 1:first + 1 + m])
                grams.append((h[inside] + np.uint64(n), doc[first + 1 + inside]))

    change = np.append(True, kind[1:] != kind[:-1]) & ~gap
    place = np.cumsum(change) - change
    outline = spans_hashed(kind[change].astype(np.uint64), place[start], place[end])
    size = np.minimum(np.log2(end - start).astype(np.uint64), np.uint64(4))
    line = np.append(line_first, feeds[start[1:]] != feeds[end[:-1]])[:len(start)].astype(np.uint64)
    outline = mix(outline + size * _PLACES[1] + line * _PLACES[2])
    two = mix(outline[:-1] * FACTOR + outline[1:])
    third = np.flatnonzero(same[1:] & same[:-1])
    third = third[third + 2 >= skip]
    outlines = [(outline[skip:], word_doc[skip:]), (two[second], word_doc[second]),
                (mix(two[third] * FACTOR + outline[third + 2]), word_doc[third])]
    return [tuple(np.concatenate(x) for x in zip(*parts)) if parts else (np.empty(0, np.uint64), np.empty(0, np.int64))
            for parts in (words, grams, outlines)]


def pieces(texts: list[str | None]) -> Iterator[tuple[list[int], str, np.ndarray, int, bool]]:
    """(rows, then the arguments of ``features``) of short texts together and of long ones in pieces."""
    rows: list[int] = []
    held: list[str] = []

    def joined() -> tuple[list[int], str, np.ndarray, int, bool]:
        return rows, "\n".join(held) + "\n", np.cumsum([len(t) + 1 for t in held]), 0, True

    for row, text in enumerate(texts):
        text = text or ""
        if len(text) > PIECE:
            at = context = skip = 0
            while at < len(text):
                cut = len(text) if at + PIECE >= len(text) else last_space(text, at, at + PIECE)
                found = [(m.start(), m.end()) for m in WORD.finditer(text, context, cut)]
                line = context == 0 or bool(found) and "\n" in text[context:found[0][0]]
                yield [row], text[context:cut] + "\n", np.array([cut - context + 1]), skip, line
                if cut < len(text) and text[cut] not in WS:  # within a word
                    context, skip = cut, 0
                elif len(found) > 2:
                    context, skip = found[-3][1], 2
                else:
                    skip = len(found)
                at = cut
            continue
        if held and sum(map(len, held)) + len(held) + len(text) > PIECE:
            yield joined()
            rows, held = [], []
        rows.append(row)
        held.append(text)
    if held:
        yield joined()


def last_space(text: str, a: int, b: int) -> int:
    """The last place in (a, b] before a space (none: ``b``, within a word)."""
    return next((i for i in range(b, a, -1) if text[i] in WS), b)


@dataclass
class Model:
    vectors: np.ndarray  # [BUCKETS, DIM]
    weights: np.ndarray  # [DIM, 2]
    bias: np.ndarray  # [2]
    offset: float = 0.0

    def __post_init__(self) -> None:
        self.shares = self.vectors @ (self.weights[:, 1] - self.weights[:, 0])  # of each bucket in the logit

    def logits(self, texts: list[str | None]) -> np.ndarray:
        total = np.zeros((len(texts), KINDS))
        count = np.zeros((len(texts), KINDS))
        for rows, *part in pieces(texts):
            for k, (h, doc) in enumerate(features(*part)):
                total[rows, k] += np.bincount(doc, self.shares[bucket(h)], len(rows))
                count[rows, k] += np.bincount(doc, minlength=len(rows))
        return (total / np.maximum(count, 1)).mean(axis=1) + self.bias[1] - self.bias[0] + self.offset

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -30, 30)))


def averages(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A document's buckets and their weights in its mean."""
    ids, weights = [], []
    for _, *part in pieces([text]):
        for k, (h, _) in enumerate(features(*part)):
            ids.append(bucket(h))
            weights.append(np.full(len(h), k, np.float64))
    kinds = np.concatenate(weights).astype(np.int64) if weights else np.empty(0, np.int64)
    per_kind = 1 / np.maximum(np.bincount(kinds, minlength=KINDS), 1) / KINDS
    rows, back = np.unique(np.concatenate(ids) if ids else np.empty(0, np.int64), return_inverse=True)
    return rows.astype(np.int32), np.bincount(back, per_kind[kinds], len(rows)).astype(np.float32)


def fit(texts: list[str], y: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = 1) -> Model:
    """Softmax regression on averaged vectors, both learned, a document at a time."""
    rng = np.random.default_rng(seed)
    docs = [averages(t) for t in texts]
    vectors = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    weights = rng.normal(0, 0.5, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen_vectors = np.full((BUCKETS, 1), 1e-6, np.float32)
    seen_weights = np.full(weights.shape, 1e-2, np.float32)
    for _ in range(epochs):
        for i in rng.permutation(len(docs)):
            rows, share = docs[i]
            own = vectors[rows]
            mean = share @ own
            z = mean @ weights + bias
            p = np.exp(z - z.max())
            err = p / p.sum()
            err[y[i]] -= 1
            back = share[:, None] * (weights @ err)
            grad = np.outer(mean, err)
            seen_vectors[rows] += (back * back).mean(axis=1, keepdims=True)
            vectors[rows] = own - rate * back / np.sqrt(seen_vectors[rows])
            seen_weights += grad * grad
            weights -= 0.1 * rate * grad / np.sqrt(seen_weights)
            bias -= 0.1 * rate * err
    return Model(vectors, weights, bias)


def best_threshold(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The middle of the widest gap between logits that parts the classes with the least weighted error."""
    order = np.argsort(z, kind="stable")
    z, y, weight = z[order], y[order], weight[order]
    # error of a threshold before each place: good ones below it, bad ones from it on
    error = np.concatenate(([0], np.cumsum(weight * y))) + np.concatenate((np.cumsum((weight * (1 - y))[::-1])[::-1], [0]))
    low, high = np.concatenate(([z[0] - 2], z)), np.concatenate((z, [z[-1] + 2]))
    error[low == high] = np.inf  # a threshold can't part equal logits
    best = np.flatnonzero(error <= error.min() + 1e-9)
    i = best[np.argmax((high - low)[best])]
    return float((low[i] + high[i]) / 2)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", train_rows: int = TRAIN_ROWS,
          train_chars: int = TRAIN_CHARS) -> Model | None:
    """The model of the labelled rows that aren't held out; None without rows of both classes."""
    marked = labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_y")).filter("_y is not null")
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
        weight = np.where(y[held] == 1, counts[1] / (y == 1).sum(), counts[0] / (y == 0).sum())
        z = model.logits([t for t, h in zip(texts, held) if h])
        model.offset = float(np.log(LIMIT / (1 - LIMIT))) - best_threshold(z, y[held], weight)
    return model


def score_quality(docs: DataFrame, labels: DataFrame, text: str = "text", **options) -> DataFrame:
    """doc_id, held_out, score, predicted per row of ``docs``."""
    model = train(docs, labels, text, **options)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(text).alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = model.scores(batch.column("text").to_pylist()) if model else np.ones(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(s, pa.float64()),
                 pa.array((s >= LIMIT).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return map_batches(rows, score, f"doc_id {dict(rows.dtypes)['doc_id']}, held_out boolean, score double, predicted int")


def without_poor(docs: DataFrame, labels: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are predicted good."""
    model = train(docs, labels, text, **options)
    if model is None:
        return docs
    at = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.scores(batch.column(at).to_pylist()) >= LIMIT))

    return map_batches(docs, keep, docs.schema)

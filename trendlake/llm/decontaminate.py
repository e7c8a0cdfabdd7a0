"""Benchmark decontamination by a random-walk embedding of edit distance.

Finds benchmark items inside documents with at most ``max_edit`` of the item's words
edited (inserted, deleted, replaced). Words are runs of letters and digits of the
lower-cased text (every non-ASCII character counts as a letter).

1. Item-sized windows. A document's words are hashed in bulk; a window of an item's
   length starts where enough word 3-grams line up with it. An item of L words edited k
   times keeps at least L - 2 - 3k of its 3-grams within k places of one alignment
   (L - 1 - 2k 2-grams for items under six words), so no window within reach is left out.
2. Embedding. Each window and item goes through ``WALKS`` shared random walks (CGK): at
   step j it writes its current word and moves on by a bit drawn from (walk, j, word).
   A walk over L words ends after about 2L steps, so ``REACH`` L steps are taken. Few edits leave
   the walks in step for most of the way, so edit distance becomes Hamming distance.
3. Bit-sampling LSH. For each walk ``SAMPLES`` keys of some sampled places (``sample_bits``: the
   more edits, the fewer places); a key with a place behind a walk's end is left out, so keys
   hold words only. A window and an item of its length that agree in one key are a
   candidate. ``tests/llm`` measure this step alone: recall above 0.99 at the largest
   allowed distance for items of 1 to 200 words, and few unrelated strings with a common key.
4. Every candidate is verified by the exact edit distance of the item to the best
   stretch of the document around the window.

Plan: a map over Arrow batches of documents without any shuffle. Benchmark items are
read in blocks of at most ``BLOCK_WORDS`` words (in whole items); each block is one pass,
its index goes with the tasks. Nothing depends on the number of documents but the scan.
The driver builds one index a block (some 150 keys an item), so this is for benchmarks of some million words.

Defined results: null or empty documents and items hold no words and match nothing.
Repeated rows: each gives its own result rows. An item found several times in a
document: one row, with the least distance, then the first place. Very long texts are
read whole. Empty tables: empty result. Extra columns are ignored by the report and kept by the filter.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from trendlake.llm.hashing import CHUNK, FACTOR, folded, mix, word_hashes
from trendlake.llm.tasks import map_batches

MAX_EDIT = 0.2
WALKS = 24
SAMPLES = 6
REACH = 1.5  # sampled places lie within the first REACH * L steps of a walk over L words
BLOCK_WORDS = 1_000_000
_BITMAP_BITS = 24


def allowed_edits(n: int, max_edit: float = MAX_EDIT) -> int:
    return int(max_edit * n + 1e-9)


def _grams(h: np.ndarray, q: int) -> np.ndarray:
    out = h[:len(h) - q + 1].copy() if len(h) >= q else h[:0].copy()
    for k in range(1, q):
        out = out * FACTOR + h[k:len(h) - q + 1 + k]
    return out


def walk_embed(x: np.ndarray, length: np.ndarray, steps: int, walks: int = WALKS) -> tuple[np.ndarray, np.ndarray]:
    """Rows of word hashes (padded to a width) -> [row, walk, step] symbols by ``walks`` random walks, and
    whether the walk still stood on a word then."""
    rows, walk = np.arange(len(x))[:, None], np.arange(walks, dtype=np.uint64) * np.uint64(1_000_003)
    i = np.zeros((len(x), walks), np.int64)
    out = np.zeros((len(x), walks, steps), np.uint64)
    inside = np.zeros(out.shape, np.bool_)
    for j in range(steps):
        on = i < length[:, None]
        symbol = np.where(on, x[rows, np.minimum(i, x.shape[1] - 1)], np.uint64(0))
        out[:, :, j], inside[:, :, j] = symbol, on
        coin = mix(symbol + (walk + np.uint64(j)) * np.uint64(0x632BE59BD9B4E019))
        i += on & ((coin & np.uint64(1)) == 1)
    return out, inside


def sample_bits(n: int) -> int:
    """Places in a key for items of ``n`` words. Measured: with more, recall at a fifth of the words
    edited falls below 0.99; with fewer, strings that share common words collide more often."""
    return 8 if n < 5 else 5 if n < 10 else 4 if n < 40 else 3


@functools.lru_cache(maxsize=4096)
def sampled_places(n: int) -> np.ndarray:
    """[walk, sample, sample_bits(1)] places for items of ``n`` words: distinct ones as far as the walk has
    them, the rest of the last axis repeats the first."""
    reach = max(1, int(REACH * n))
    bits = min(sample_bits(n), reach)
    drawn = np.random.default_rng(n).random((WALKS, SAMPLES, reach)).argsort(axis=2)[:, :, :bits]
    return np.concatenate([drawn, np.repeat(drawn[:, :, :1], sample_bits(1) - bits, axis=2)], axis=2)


def lsh_keys(x: np.ndarray, length: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Rows of word hashes (padded) -> WALKS * SAMPLES keys each, whatever the padding; 0: no key.

    ``size`` is the length of the items looked for, ``length`` the words there are (fewer where
    a document ends). A key holds the size and the sampled places of one walk."""
    number = np.arange(1, WALKS * SAMPLES + 1, dtype=np.uint64).reshape(WALKS, SAMPLES)
    keys = np.empty((len(x), WALKS, SAMPLES), np.uint64)
    order = np.argsort(size, kind="stable")  # rows of like sizes together, so a long one widens few others
    for at in range(0, len(x), 256):
        rows = order[at:at + 256]
        n = size[rows]
        places = np.stack([sampled_places(int(k)) for k in n])
        e, inside = walk_embed(x[rows, :int(n.max())], length[rows], int(places.max()) + 1)
        key = np.broadcast_to(number, (len(rows), WALKS, SAMPLES)) + n.astype(np.uint64)[:, None, None] * FACTOR
        whole = np.ones(key.shape, np.bool_)
        for k in range(places.shape[3]):
            key = mix(key * FACTOR + np.take_along_axis(e, places[..., k], axis=2))
            whole &= np.take_along_axis(inside, places[..., k], axis=2)
        keys[rows] = np.where(whole, key | np.uint64(1), np.uint64(0))
    return keys.reshape(len(x), WALKS * SAMPLES)


def best_stretch(item: np.ndarray, text: np.ndarray, most: int) -> tuple[int, int, int] | None:
    """(distance, start, length) of the stretch of ``text`` closest to ``item``, within ``most`` edits:
    least distance, then first start, then longest."""
    n = len(item)
    cost = [(0, j, 0) for j in range(len(text) + 1)]  # distance, start, -end: of an empty prefix
    for i in range(1, n + 1):
        word, above = item[i - 1], cost
        cost = [(i, 0, 0)]
        for j in range(1, len(text) + 1):
            d, s = min((above[j - 1][0] + (text[j - 1] != word), above[j - 1][1]),
                       (above[j][0] + 1, above[j][1]), (cost[j - 1][0] + 1, cost[j - 1][1]))
            cost.append((d, s, -j))
    d, s, e = min((d, s, -j) for j, (d, s, _) in enumerate(cost))
    return (int(d), int(s), int(-e - s)) if d <= most else None


class Index:
    """A block of items: their word hashes, gram postings and LSH keys."""

    def __init__(self, items: list[tuple[object, str | None]], max_edit: float = MAX_EDIT):
        hashed = [(i, word_hashes(folded(t))[0]) for i, t in items]
        hashed = [(i, h) for i, h in hashed if len(h)]
        self.ids = [i for i, _ in hashed]
        self.words = [h for _, h in hashed]
        self.size = np.array([len(h) for h in self.words], np.int64)
        self.edits = np.array([allowed_edits(n, max_edit) for n in self.size], np.int64)
        self.grams: dict[int, tuple] = {}
        q_of = np.where(self.size >= 6, 3, np.minimum(self.size, 2))
        self.least = np.maximum(1, self.size - (q_of - 1) - q_of * self.edits)
        for q in (1, 2, 3):
            rows = [(g, i, o) for i in np.flatnonzero(q_of == q) for o, g in enumerate(_grams(self.words[i], q))]
            if rows:
                value, item, offset = (np.array(c, t) for c, t in zip(zip(*rows), (np.uint64, np.int64, np.int64)))
                order = np.argsort(value, kind="stable")
                value, item, offset = value[order], item[order], offset[order]
                bitmap = np.zeros(1 << _BITMAP_BITS, np.bool_)
                bitmap[value >> np.uint64(64 - _BITMAP_BITS)] = True
                self.grams[q] = (np.packbits(bitmap), value, item, offset)
        self.keys: dict[int, list[int]] = {}
        if self.ids:
            width = int(self.size.max())
            padded = np.stack([np.pad(h, (0, width - len(h))) for h in self.words])
            for i, row in enumerate(lsh_keys(padded, self.size, self.size).tolist()):
                for k in set(row) - {0}:
                    self.keys.setdefault(k, []).append(i)

    def seeds(self, h: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Rows (document, item, diagonal) of the grams shared by a document and an item."""
        found = []
        for q, (packed, value, item, offset) in self.grams.items():
            g = _grams(h, q)
            bit = g >> np.uint64(64 - _BITMAP_BITS)
            at = np.flatnonzero((packed[bit >> np.uint64(3)] >> (np.uint8(7) - (bit & np.uint64(7)).astype(np.uint8))) & np.uint8(1))
            at = at[doc[at] == doc[at + q - 1]]
            low, high = np.searchsorted(value, g[at], "left"), np.searchsorted(value, g[at], "right")
            n = high - low
            post = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
            p = np.repeat(at, n)
            found.append(np.stack([doc[p], item[post], p - offset[post]], axis=1))
        return np.concatenate(found) if found else np.empty((0, 3), np.int64)

    def windows(self, h: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Rows (document, start, length) where enough grams of an item line up."""
        s = self.seeds(h, doc)
        if len(s):  # first by document and item, which leaves almost nothing
            _, group, count = np.unique(s[:, 0] * len(self.ids) + s[:, 1], return_inverse=True, return_counts=True)
            s = s[count[group] >= self.least[s[:, 1]]]
        if not len(s):
            return np.empty((0, 3), np.int64)
        s = s[np.lexsort((s[:, 2], s[:, 1], s[:, 0]))]
        group = np.cumsum(np.concatenate(([0], np.any(s[1:, :2] != s[:-1, :2], axis=1))))
        span = np.int64(1) << 40
        line = group * span + s[:, 2] + (span >> 1)
        first = np.arange(len(s))
        last = np.searchsorted(line, line + self.edits[s[:, 1]], "right")
        good = last - first >= self.least[s[:, 1]]
        step = np.zeros(len(s) + 1, np.int64)  # every diagonal of a qualifying band is a window
        np.add.at(step, first[good], 1)
        np.add.at(step, last[good], -1)
        s = s[np.cumsum(step[:-1]) > 0]
        return np.unique(np.stack([s[:, 0], s[:, 2], self.size[s[:, 1]]], axis=1), axis=0)

    def leaks(self, texts: list[str | None]) -> list[tuple[int, object, int, int, int]]:
        """(row, item_id, start word, words, distance) of the items found in the texts."""
        out: dict[tuple[int, int], tuple[int, int, int]] = {}
        group: list[tuple[int, bytes]] = []
        size = 0
        for row, text in enumerate(texts):
            data = folded(text)
            group.append((row, data))
            size += len(data) + 1
            if size >= CHUNK // 2 or row == len(texts) - 1:
                self._scan(group, out)
                group, size = [], 0
        return [(row, self.ids[i], *v[1:], v[0]) for (row, i), v in sorted(out.items())]

    def _scan(self, group: list[tuple[int, bytes]], out: dict) -> None:
        h, start = word_hashes(b"\n".join(data for _, data in group))
        doc = np.searchsorted(np.cumsum([len(data) + 1 for _, data in group]), start, "right")
        found = self.windows(h, doc)
        if not len(found):
            return
        begin = np.searchsorted(doc, np.arange(len(group)), "left")[found[:, 0]]
        end = np.searchsorted(doc, np.arange(len(group)), "right")[found[:, 0]]
        a = np.clip(found[:, 1], begin, None)
        n = found[:, 2]
        x = h[np.minimum(a[:, None] + np.arange(n.max()), len(h) - 1)]
        keys = lsh_keys(x, np.minimum(n, end - a), n).tolist()
        for (d, _, size), at, first, last, row in zip(found.tolist(), a.tolist(), begin.tolist(), end.tolist(), keys):
            for i in sorted({i for k in row for i in self.keys.get(k, ()) if self.size[i] == size}):
                most, item = int(self.edits[i]), self.words[i]
                if at + size <= last and np.array_equal(h[at:at + size], item):
                    best, low = (0, 0, size), at
                else:
                    low, high = max(at - most, first), min(at + size + 2 * most, last)
                    if np.isin(item, h[low:high]).sum() < size - most:  # each word not there costs an edit
                        continue
                    best = best_stretch(item.tolist(), h[low:high].tolist(), most)
                if best:
                    new = (best[0], low + best[1] - first, best[2])
                    key = (group[d][0], i)
                    if key not in out or new < out[key]:
                        out[key] = new


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[object, str | None]]]:
    """The items in blocks of about ``block_words`` words, dealt by a hash of the item."""
    # a word takes at least two characters with its separator, so this bounds the words from above
    total = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    n = 1 + total // 2 // block_words
    b = benchmark.select("item_id", "text").withColumn("_b", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    for k in range(n):
        yield [(r["item_id"], r["text"]) for r in b.filter(F.col("_b") == k).collect()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", max_edit: float = MAX_EDIT,
               block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, item_id, start_word, n_words, distance: the items found in the documents."""
    rows = docs.select("doc_id", F.col(text).alias("text"))
    kinds = dict(rows.dtypes)["doc_id"], dict(benchmark.dtypes)["item_id"]
    out = None
    for items in blocks(benchmark, block_words):
        index = Index(items, max_edit)

        def scan(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = index.leaks(batch.column("text").to_pylist())
                cols = list(zip(*found)) if found else [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(cols[0], pa.int64())),
                     pa.array(cols[1], arrow_item), *[pa.array(c, pa.int64()) for c in cols[2:]]],
                    ["doc_id", "item_id", "start_word", "n_words", "distance"])

        arrow_item = to_arrow_type(benchmark.schema["item_id"].dataType)
        part = map_batches(rows, scan, f"doc_id {kinds[0]}, item_id {kinds[1]}, start_word bigint, n_words bigint, distance bigint")
        out = part if out is None else out.union(part)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", max_edit: float = MAX_EDIT,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    at = docs.columns.index(text)
    for items in blocks(benchmark, block_words):
        index = Index(items, max_edit)

        def scan(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bad = {row for row, *_ in index.leaks(batch.column(at).to_pylist())}
                yield batch.filter(pa.array([i not in bad for i in range(batch.num_rows)], pa.bool_()))

        docs = map_batches(docs, scan, docs.schema)
    return docs

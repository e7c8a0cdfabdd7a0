"""Periodic runs of words: suffix classes united by decreasing LCP.

A run is a stretch of consecutive words with smallest period q, of at least ``min_length``
words and ``exponent`` periods, that no neighbouring word extends keeping period q.

Two positions x < y are in one class at level l if the l words from each are equal. All
documents of a slice are sorted together (a word of one document never equals a word of
another, and each ends in a symbol of its own): prefix doubling on the positions whose
words occur again, then the LCP of each two neighbours in suffix order. Kruskal's order
follows: pairs by decreasing LCP unite classes by union-find, each class an ordered set of
positions, the smaller set going into the larger. Where a union at level l makes x < y
neighbours in their set, lcp(x, y) is l, and at distance d = y - x <= l the l + d words
from x have period d; it is the smallest one, as any smaller would have put a position
between them. With different words before x and y nothing extends the stretch: a run.
Each run begins such a pair, so none is missed. Pairs below the least LCP that a run
needs (5 words for 6 words and 4 periods) are never united.

Plan: a map over Arrow batches, no shuffle; slices of ``SLICE`` bytes (one text at least)
bound the memory. Defined results: null, empty or wordless text: no run, empty collapsed
text. Repeated rows: same result each. Very long texts are read whole. Null doc_id: as
given (the query takes crc32 of the empty string). Empty table: empty result. Extra
columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.llm.tasks import map_batches
from trendlake.llm.text import let, words

MIN_LENGTH = 6
EXPONENT = 4
SLICE = 4 << 20  # bytes of texts sorted together
BLOCK = 1024  # positions in a block of an ordered set

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class Positions:
    """An ordered set in blocks, so that adding to a large one moves one block only."""

    __slots__ = ("blocks", "heads", "size")

    def __init__(self, x: int):
        self.blocks, self.heads, self.size = [[x]], [x], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def around(self, x: int) -> tuple[int, int]:
        """The members next to ``x``, a non-member (-1: none)."""
        b = max(bisect_right(self.heads, x) - 1, 0)
        block = self.blocks[b]
        i = bisect_left(block, x)
        before = block[i - 1] if i else -1
        if i < len(block):
            return before, block[i]
        return before, self.heads[b + 1] if b + 1 < len(self.heads) else -1

    def add(self, x: int) -> None:
        b = max(bisect_right(self.heads, x) - 1, 0)
        block = self.blocks[b]
        block.insert(bisect_left(block, x), x)
        self.size += 1
        self.heads[b] = block[0]
        if len(block) > 2 * BLOCK:
            self.blocks.insert(b + 1, block[BLOCK:])
            self.heads.insert(b + 1, block[BLOCK])
            del block[BLOCK:]


def neighbours(symbol: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(x, y, LCP) of neighbours in suffix order that share ``least`` symbols or more.

    Every text in ``symbol`` ends in a symbol that occurs nowhere else. ``ranks[k]`` tells
    equal stretches of 2**k symbols by equal numbers, which are places in suffix order.
    """
    n = len(symbol)
    order = np.argsort(symbol, kind="stable")
    sorted_ = symbol[order]
    new = np.append(True, sorted_[1:] != sorted_[:-1])[:n]
    rank = np.empty(n, np.int64)
    ranks: list[np.ndarray] = []
    begin = np.flatnonzero(new)
    place = begin
    share = order
    while True:
        group = np.cumsum(new) - 1
        rank[order] = place[group]
        ranks.append(rank.astype(np.int32))
        size = np.diff(np.append(begin, len(order)))
        again = size[group] > 1
        if 1 << (len(ranks) - 1) <= least:
            share = order[again]
        order = order[again]
        if not len(order):
            break
        # what shares 2**k symbols has no end symbol among them, so the next stretch is inside
        old, follow = rank[order], rank[order + (1 << (len(ranks) - 1))]
        by = np.argsort(old * n + follow, kind="stable")
        order, old, follow = order[by], old[by], follow[by]
        new_old = np.append(True, old[1:] != old[:-1])
        new = new_old | np.append(True, follow[1:] != follow[:-1])
        begin = np.flatnonzero(new)
        group_begin = np.flatnonzero(new_old)[np.cumsum(new_old)[begin] - 1]
        place = old[begin] + begin - group_begin
    share = share[np.argsort(rank[share])]
    x, y = share[:-1], share[1:]
    lcp = np.zeros(len(x), np.int64)
    for k in reversed(range(len(ranks))):
        lcp += (ranks[k][x + lcp] == ranks[k][y + lcp]).astype(np.int64) << k
    enough = lcp >= least
    return x[enough], y[enough], lcp[enough]


def least_lcp(min_length: int, exponent: int) -> int:
    return min(max(min_length - q, (exponent - 1) * q) for q in range(1, min_length + 1))


def runs(symbol: np.ndarray, min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs in ``symbol`` (see ``neighbours``)."""
    x, y, lcp = neighbours(symbol, max(1, least_lcp(min_length, exponent)))
    by = np.argsort(-lcp, kind="stable")
    parent: dict[int, int] = {}
    members: dict[int, Positions] = {}
    found = []

    def root(p: int) -> int:
        if p not in parent:
            parent[p], members[p] = p, Positions(p)
            return p
        while parent[p] != p:
            parent[p] = p = parent[parent[p]]
        return p

    for a, b, level in zip(x[by].tolist(), y[by].tolist(), lcp[by].tolist()):
        a, b = root(a), root(b)
        large, small = members[a], members[b]
        if large.size < small.size:
            a, b, large, small = b, a, small, large
        parent[b] = a
        del members[b]
        seeds = []
        last = -1  # member of the smaller set before p
        last_after = -2  # the larger set's member after it
        for p in small:
            before, after = large.around(p)
            if last_after >= 0 and (after < 0 or last_after < p):
                seeds.append((last, last_after))
            if before > last:
                seeds.append((before, p))
            last, last_after = p, after
        if last_after >= 0:
            seeds.append((last, last_after))
        for p in small:
            large.add(p)
        for p, q in seeds:
            d = q - p
            if (exponent - 1) * d <= level and level + d >= min_length and symbol[p - 1] != symbol[q - 1]:
                found.append((p, level + d, d))
    return sorted(found, key=lambda r: (r[0], r[2]))


def slices(texts: list[bytes]) -> Iterator[list[bytes]]:
    some, size = [], 0
    for t in texts:
        if some and size + len(t) > SLICE:
            yield some
            some, size = [], 0
        some.append(t)
        size += len(t)
    if some:
        yield some


def slice_runs(texts: list[bytes], min_length: int, exponent: int) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    """Each text's runs and collapsed text."""
    split = [t.split() for t in texts]  # bytes split at space and \x09-\x0D
    size = np.array([len(w) for w in split], np.int64)
    code = pa.array([w for ws in split for w in ws], pa.binary()).dictionary_encode()
    offset = np.cumsum(size + 1) - size - 1  # one end symbol after each text
    n = int((size + 1).sum())
    inside = np.ones(n, np.bool_)
    inside[offset + size] = False
    symbol = np.empty(n, np.int64)
    number = np.arange(len(texts))
    symbol[inside] = np.repeat(number * len(code.dictionary), size) + np.asarray(code.indices, np.int64)
    symbol[offset + size] = -1 - number
    by_text: dict[int, list[tuple[int, int, int]]] = {}
    found = runs(symbol, min_length, exponent)
    for at, (p, length, period) in zip(np.searchsorted(offset, [r[0] for r in found], "right") - 1, found):
        by_text.setdefault(int(at), []).append((p - int(offset[at]), length, period))
    for k, ws in enumerate(split):
        own = by_text.get(k, [])
        if own:
            step = np.zeros(len(ws) + 1, np.int64)
            for p, length, period in own:
                step[p + period] += 1
                step[p + length] -= 1
            ws = list(compress(ws, (np.cumsum(step[:-1]) == 0).tolist()))
        yield own, b" ".join(ws)


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
              exponent: int = EXPONENT) -> DataFrame:
    """key, runs (array of start, length, period by start, then period), collapsed (the text's
    words without those that a run holds after its first period, joined by one space)."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for some in slices(batch.column("text").to_pylist()):
                got = list(slice_runs(some, min_length, exponent))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(at, len(some)),
                     pa.array([[dict(zip(("start", "length", "period"), r)) for r in own] for own, _ in got], pa.list_(RUN)),
                     pa.array([c for _, c in got], pa.binary()).cast(pa.string())], ["key", "runs", "collapsed"])
                at += len(some)

    schema = f"key {dict(rows.dtypes)['key']}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return map_batches(rows, find, schema).withColumnRenamed("key", key)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the texts (by crc32 of the doc_id) repeat a stretch up to their end."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))

    def repeated(w: Column) -> Column:
        n, g = F.size(w).cast("bigint"), F.floor(h / 10)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        tail = F.flatten(F.array_repeat(F.slice(w, (a + 1).cast("int"), p.cast("int")), F.ceil((n - a) / p).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, F.lit(1), a.cast("int")), F.slice(tail, F.lit(1), (n - a).cast("int"))), " "))

    return docs.select("doc_id", F.when(h % 10 == 0, let(words(F.col("text")), repeated)).otherwise(F.col("text")).alias("text"))


def run_digests(docs: DataFrame) -> DataFrame:
    """Per document: the number of runs, the longest one, and digests of the runs and the collapsed text."""
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("a"), r["start"].alias("start"), r["period"].alias("period"))))
    found = find_runs(with_planted_runs(docs)).withColumn("_longest", longest)
    length = -F.col("_longest.a")
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("_longest.start").alias("start"), length.alias("length"),
        F.col("_longest.period").alias("period"), F.floor(1000 * length / F.col("_longest.period")).alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") == 0, "").otherwise(F.concat(listed, F.lit("\n"))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))

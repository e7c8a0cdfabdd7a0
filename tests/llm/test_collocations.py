import os
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from tests.llm import messy
from trendlake.llm import collocations as c

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def plain(rows, min_count, max_words=5, percent=100, limit=2000):
    """rows: (lang, text)."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(str.maketrans(UPPER, LOWER))):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, max_words + 1):
                f.update((lang, tuple(w[i:i + m])) for i in range(len(w) - m + 1))
    often = {k: a for k, a in f.items() if a >= min_count and len(k[1]) > 1}
    hidden = set()
    for (lang, p), a in often.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                q = (lang, p[i:i + m])
                if 100 * a >= percent * f[q]:
                    hidden.add(q)
    out = {}
    for (lang, p), a in often.items():
        if (lang, p) not in hidden:
            score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]], n[lang]))
    return {(lang, i, p.decode(), -a, left, right, total, -score) for lang, found in out.items()
            for i, (score, a, p, left, right, total) in enumerate(sorted(found)[:limit], 1)}


def sentences(seed, n, words):
    r = random.Random(seed)
    fixed = ["new york stock exchange", "in spite of", "New York", "état de l'art", "of the"]
    out = []
    for _ in range(n):
        w = []
        for _ in range(r.randint(0, 30)):
            w.append(r.choice(fixed) if r.random() < 0.3 else r.choice(words))
            w.append(r.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "! ", "\x0b", "\r\n"]))
        out.append((r.choice(["en", "de", None, "und"]), "".join(w)))
    return out


@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"percent": 60, "max_words": 4}), (3, {"limit": 7})])
def test_equals_brute_force(spark, seed, options):
    rows = sentences(seed, 400, messy.vocabulary(seed, 12)) + [("en", None), ("en", ""), (None, " \t\n"), ("x", "lone")]
    rows += [("en", "a b " * 300)] * 2 + [("fr", "a " * 400)]
    percent = options.pop("percent", 100)
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = {tuple(r) for r in c.collocations(docs, min_count=8, subsumed_percent=percent, **options).collect()}
    assert got == plain(rows, 8, percent=percent, **options) and got


def test_messy_rows(spark):
    rows = messy.rows(2)
    got = {tuple(r) for r in c.collocations(messy.frame(spark, 2), min_count=5).collect()}
    assert got == plain([(r[2], r[1]) for r in rows], 5) and got
    assert c.collocations(messy.empty(spark)).collect() == []
    assert c.collocations(messy.frame(spark, 2), min_count=10**6).collect() == []


def test_slices_segments_and_shared_bits_change_nothing(spark, monkeypatch):
    """Tiny slices (long texts cut between words), short rows, all prefixes hot, hashes that nearly all meet."""
    rows = sentences(5, 150, messy.vocabulary(5, 8)) + [("en", "x" * 500 + " of the " * 60), ("de", "lonely" * 100)]
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(2)
    want = plain(rows, 6)
    langs, texts = ["en" if x is None else x for x, _ in rows], [t.encode() for _, t in rows]
    monkeypatch.setattr(c, "SLICE", 100)
    monkeypatch.setattr(c, "ROW", 2)
    monkeypatch.setattr(c, "HOT", 10**9)
    for size in (1, 2, 3):
        n = sum(int(c.Slice(*s).may_begin.sum()) for s in c.slices(langs, texts, size))
        assert n == sum(len(t.translate(c.FOLD).split()) for t in texts)
    full = c.Frequent(8, *(c.np.full(1, 255, c.np.uint8) for _ in range(2)))
    for size in (2, 5):
        count, home = Counter(), {}
        for s in c.slices(langs, texts, size):
            for r in c.Slice(*s).stripes(size, full, 5).to_pylist():
                assert r["part"] < 5
                entries = [(lang, p, w) for lang, p, ws in zip(r["lang"], r["prefix"], r["words"]) for w in ws.split(" ")]
                for (lang, p, w), k in zip(entries, r["counts"], strict=True):
                    count[lang, p + " " + w] += k
                    home.setdefault((lang, p, w), set()).add(r["part"])
        every = Counter()
        for lang, t in zip(langs, texts):
            for piece in t.translate(c.FOLD).decode().split("\n"):
                w = piece.split()
                every.update((lang, " ".join(w[i:i + size])) for i in range(len(w) - size + 1))
        assert count == every and all(len(parts) == 1 for parts in home.values())
    assert c.Frequent.has(c.np.array([4], c.np.uint8), c.np.array([2, 3], c.np.uint64), 8).tolist() == [True, False]


def test_bundles_added_over_batches():
    rows = [(0, ["en", "en"], ["a", "b"], ["x y", "x"], [1, 2, 1]), (0, ["en"], ["a"], ["y"], [5]), (1, ["en", "fr"], ["", ""], ["x z", "x"], [4, 4, 1]),
            (1, ["en"], [""], ["q"], [1]), (3, ["en"], ["c"], ["x"], [9])]
    names = ["part", "lang", "prefix", "words", "counts"]
    schema = pa.schema([("part", pa.int32())] + [(n, pa.list_(pa.string())) for n in names[1:4]] + [("counts", pa.list_(pa.int32()))])
    for size in (1, 2, 3, 6):
        batches = [pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows[i:i + size]], schema) for i in range(0, len(rows), size)]
        got = [tuple(r.values()) for b in c.added(iter(batches), 4) for r in b.to_pylist()]
        assert sorted((a, b, t, sorted(zip(w, n))) for a, b, t, w, n in got) == [
            ("en", "", 9, [("x", 4), ("z", 4)]), ("en", "a", 8, [("y", 7)]), ("en", "c", 9, [("x", 9)]), ("fr", "", 1, [])]


def test_memory_of_a_task():
    """A task's memory doesn't grow with its batches: texts and bundles are taken from them piece by piece."""
    rng = np.random.default_rng(1)
    words = np.array([f"word{i}" for i in range(20_000)])
    texts = [" ".join(words[rng.integers(0, len(words), 1000)]).encode() for _ in range(2400)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array(texts, pa.binary())], ["lang", "text"])
    del texts
    tracemalloc.start()
    try:
        total = sum(pc.sum(b["counts"].flatten()).as_py() for b in c.counted(iter([batch]), 1, None, 64))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert total == 2400 * 1000
    assert peak < 100e6

    n, size = 2000, 500
    several = pa.array([" ".join(words[i:i + size]) for i in range(n)])
    at = pa.array(np.arange(n + 1, dtype=np.int32))
    one = lambda values: pa.ListArray.from_arrays(at, pa.array(values))
    bundles = pa.RecordBatch.from_arrays(
        [pa.array(np.arange(n, dtype=np.int32) // 50), one(["en"] * n), one([f"p{i}" for i in range(n)]),
         pa.ListArray.from_arrays(at, several),
         pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * size), pa.array(np.full(n * size, 7, np.int32)))],
        ["part", "lang", "prefix", "words", "counts"])
    usual, pool = pa.default_memory_pool(), pa.proxy_memory_pool(pa.default_memory_pool())
    pa.set_memory_pool(pool)
    try:
        got = {(r["prefix"], r["total"], len(r["words"])) for b in c.added(iter([bundles]), 7) for r in b.to_pylist()}
        peak = pool.max_memory()
    finally:
        pa.set_memory_pool(usual)
    assert got == {(f"p{i}", 7 * size, size) for i in range(n)}
    assert peak < 50e6


def test_driver_holds_one_bitmap(spark, tmp_dir):
    """The bitmap comes to the driver page by page; the hot phrases, under HOT, don't take as much again."""
    rows = [("en", f"w{i} of", 150 if i else 10**6) for i in range(2000)]
    path = f"{tmp_dir}/phrases"
    spark.createDataFrame(rows, "lang string, phrase string, a bigint").repartition(8).write.parquet(path)
    phrases, words = spark.read.parquet(path), 10**8
    tracemalloc.start()
    try:
        got = c.bitmaps(phrases, c.MAX_BITS // 32, words)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got.bits == c.MAX_BITS and len(got.found) == c.MAX_BITS // 8
    assert peak < 1.3 * c.MAX_BITS / 8

    texts = [p.encode() for _, p, _ in rows]
    known = c.Slice(["en"] * len(texts), texts, 10**9).phrase_hashes(2)  # pairs over two texts lie between
    known = known[::2]
    assert c.Frequent.has(got.found, known, got.bits).all() and np.unpackbits(got.found).sum() <= len(rows)
    assert c.Frequent.has(got.hot, known, 8 * len(got.hot)).tolist() == [a * c.HOT > words for _, _, a in rows]


def test_no_bitmap_stays_broadcast(spark, monkeypatch):
    made, plain_broadcast = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: made.append(plain_broadcast(self, value)) or made[-1])
    docs = spark.createDataFrame([("en", "new york stock exchange")] * 9, "lang string, text string")
    assert c.collocations(docs, min_count=8).count() == 1
    assert len(made) == 5 and not any(os.path.exists(b._path) for b in made)


def test_tables_of_phrases_are_not_broadcast(spark, tmp_dir):
    """Their Parquet files may be below the threshold where the rows, dealt out by salt, don't fit the driver."""
    shorter, striped = [(f"w{i}", 200, [], []) for i in range(50)], [(f"w{i}", ["w0", "w1"], [150, 120]) for i in range(50)]
    spark.createDataFrame(shorter, "phrase string, a bigint, heads array<bigint>, tails array<bigint>").withColumn("lang", F.lit("en")).write.parquet(f"{tmp_dir}/1")
    spark.createDataFrame(striped, "prefix string, words array<string>, counts array<bigint>").withColumn("lang", F.lit("en")).write.parquet(f"{tmp_dir}/2")
    found = c.longer(spark.read.parquet(f"{tmp_dir}/2"), spark.read.parquet(f"{tmp_dir}/1"), 2)
    got = {tuple(map(str, r)) for r in found.collect()}
    assert got == {("en", f"w{i} {w}", w, str(a), "[200]", "[200]") for i in range(50) for w, a in (("w0", 150), ("w1", 120))}
    assert found.count() == 100 and "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_scores_beyond_64_bits(spark):
    rows = [(10**12 + 7, 10**13 + 1, [10**12 + 9, 3 * 10**12], [2 * 10**12, 10**12 + 8])]
    got = spark.createDataFrame(rows, "a bigint, n bigint, heads array<bigint>, tails array<bigint>").select(F.expr("*"), c.lowest_cut().alias("cut")).first()
    a, n, heads, tails = rows[0]
    score, k = min((1000 * a * n // (x * y), k) for k, (x, y) in enumerate(zip(heads, tails), 1))
    assert (got["cut"]["score"], got["cut"]["k"]) == (score, k)

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm import messy
from trendlake.llm import subword_quality as q
from trendlake.sources.tables import table

SF = "/root/testdata/sf0.01"


def outline(word, line):
    kinds = "".join("a" if c > "\x7f" or c.islower() else "A" if c.isupper() else "9" if c.isdigit() else "c" if c < "\x04" else c for c in word)
    return re.sub(r"(.)\1+", r"\1", kinds, flags=re.S), min(len(word).bit_length() - 1, 4), line


def plain(text):
    """The features of a text, by kind."""
    found = [(m.group(), m.start()) for m in q.WORD.finditer(text)]
    w = [x for x, _ in found]
    words = w + [("again",) if a == b else (a, b) for a, b in zip(w, w[1:])]
    grams = [f" {x} "[i:i + n] for x in w for n in q.GRAMS for i in range(len(x) + 3 - n)]
    ends = [0] + [at + len(x) for x, at in found]
    lines = [k == 0 or "\n" in text[ends[k]:at] for k, (_, at) in enumerate(found)]
    one = [outline(x, a) for x, a in zip(w, lines)]
    return [Counter(words), Counter(grams), Counter(one + list(zip(one, one[1:])) + list(zip(one, one[1:], one[2:])))]


def hashed(text):
    out = [Counter() for _ in range(q.KINDS)]
    for _, *part in q.pieces([text]):
        for k, (h, _) in enumerate(q.features(*part)):
            out[k].update(h.tolist())
    return out


def test_features_equal_the_plain_ones():
    texts = [t or "" for t in messy.texts(1)[:40]] + ["A b", "aa aa aa", "x", "THE!! END!! 12,3$$$\n\nNew | old\tÉté", "a\x01b\x02 \x0b c"]
    seen = [{} for _ in range(q.KINDS)]
    for t in texts:
        for k, (want, got) in enumerate(zip(plain(t), hashed(t))):
            assert sorted(want.values()) == sorted(got.values()), (k, t[:60])
            for f in want:  # a feature has one hash wherever it stands
                seen[k].setdefault(f, set(got)).intersection_update(got)
    assert all(len(hs) for s in seen for hs in s.values())


@pytest.mark.parametrize("piece", [7, 64, 300])
def test_pieces_change_nothing(monkeypatch, piece):
    texts = [t or "" for t in messy.texts(2)[:30]] + ["word " * 200, "  lead and tail  \n ", "long" * 300 + " end of it all"]
    whole = [hashed(t) for t in texts]
    monkeypatch.setattr(q, "PIECE", piece)
    for t, want in zip(texts, whole):
        if max(map(len, q.WORD.findall(t)), default=0) < piece:  # a longer word is cut
            assert hashed(t) == want


def test_scores_are_the_softmax_of_averages(monkeypatch):
    texts = messy.texts(3)[:40]
    r = np.random.default_rng(0)
    m = q.Model(r.normal(size=(q.BUCKETS, q.DIM)), r.normal(size=(q.DIM, 2)), r.normal(size=2), 0.5)
    for t, s in zip(texts, m.scores(texts)):
        means = []
        for k in hashed(t or ""):
            ids = [int(q.bucket(np.array([h], np.uint64))[0]) for h, n in k.items() for _ in range(n)]
            means.append(m.vectors[ids].mean(axis=0) if ids else np.zeros(q.DIM))
        z = np.mean(means, axis=0) @ m.weights + m.bias + [0, 0.5]
        assert abs(s - np.exp(z[1]) / np.exp(z).sum()) < 1e-9
        rows, share = q.averages(t or "")
        assert np.allclose(share @ m.vectors[rows], np.mean(means, axis=0), atol=1e-5)


def test_threshold_has_the_least_error():
    r = np.random.default_rng(2)
    for _ in range(50):
        z, y, w = r.integers(0, 12, 20) / 2.0, r.integers(0, 2, 20), r.random(20)
        cost = lambda c: (w * np.where(z >= c, 1 - y, y)).sum()
        assert cost(q.best_threshold(z, y, w)) <= min(cost(c) for c in np.arange(-1, 8, 0.25)) + 1e-9


def test_learning_reduces_the_loss_and_is_repeatable():
    good, poor = [f"a plain sentence of words {i}" for i in range(40)], [f"BUY!! NOW!! {i}$$$ BUY!!" for i in range(40)]
    y = np.array([1] * 40 + [0] * 40)
    m = q.fit(good + poor, y)
    s = m.scores(["another plain sentence", "BUY!! IT!! $$$"])
    assert s[0] > 0.9 > 0.1 > s[1]
    assert np.array_equal(q.fit(good + poor, y).vectors, m.vectors)


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = {r["doc_id"]: r for r in q.score_quality(docs, labels).collect()}
    assert len(got) == docs.count()
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1
    held = [(r["quality"], got[r["doc_id"]]["predicted"]) for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    assert sum(y == p for y, p in held) >= 0.95 * len(held) and len(held) > 40
    kept = q.without_poor(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["predicted"]}


def test_messy_rows(spark):
    docs = messy.frame(spark)
    labels = spark.createDataFrame([(i, None if i % 7 == 0 else i % 2, 0) for i in range(60)] + [(3, 1, 0), (None, 1, 0)],
                                   "doc_id bigint, quality int, toxic int")
    got = q.score_quality(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == len(messy.rows()) and all(0 <= r["score"] <= 1 for r in rows)
    by_text = {}
    for r, m in zip(rows, docs.collect()):
        by_text.setdefault(m["text"] or "", set()).add(r["score"])
    assert all(len(s) == 1 for s in by_text.values())
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [True]
    assert q.score_quality(messy.empty(spark), labels).collect() == []
    one = q.score_quality(docs, labels.filter("quality = 1")).collect()
    assert {(r["score"], r["predicted"]) for r in one} == {(1.0, 1)}
    assert q.without_poor(docs, labels.limit(0)).count() == len(rows)

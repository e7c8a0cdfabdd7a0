import random

import numpy as np

from tests.llm import messy
from trendlake.llm import decontaminate as d
from trendlake.llm import hashing


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j - 1] + (x != y), last[j] + 1, row[j - 1] + 1))
    return row[-1]


def best_in(item, words):
    """Least edit distance of the item to any stretch of the words (brute force)."""
    return min(edit_distance(item, words[a:b]) for a in range(len(words) + 1)
               for b in range(a, min(len(words), a + 2 * len(item)) + 1))


def edited(r, words, k, voc):
    x = list(words)
    for _ in range(k):
        op, p = r.randrange(3), r.randrange(len(x))
        if op == 0:
            x[p] = r.choice(voc)
        elif op == 1:
            x.insert(p, r.choice(voc))
        elif len(x) > 1:
            x.pop(p)
    return x


def test_best_stretch_is_exact():
    r = random.Random(1)
    for _ in range(150):
        item = [r.randrange(6) for _ in range(r.randint(1, 7))]
        text = [r.randrange(6) for _ in range(r.randint(0, 10))]
        want = best_in(item, text)
        got = d.best_stretch(item, text, len(item))
        assert got[0] == want
        assert edit_distance(item, text[got[1]:got[1] + got[2]]) == want


def test_recall_and_precision_at_the_largest_distance():
    r = random.Random(2)
    voc = messy.vocabulary(9, 3000)
    items = [(i, " ".join(r.choices(voc, k=r.randint(4, 60)))) for i in range(150)]
    index = d.Index(items)
    texts, planted = [], []
    for i, t in items:
        words = t.split()
        k = d.allowed_edits(len(words))
        texts.append(" ".join(r.choices(voc, k=r.randint(0, 80)) + edited(r, words, k, voc) + r.choices(voc, k=r.randint(0, 80))))
        planted.append((len(texts) - 1, i))
        texts.append(" ".join(r.choices(voc, k=200)))  # clean
    found = index.leaks(texts)
    pairs = {(row, i) for row, i, *_ in found}
    assert len(pairs & set(planted)) >= 0.99 * len(planted)
    by_id = dict(items)
    for row, i, start, n, distance in found:
        words, item = texts[row].split(), by_id[i].split()
        assert edit_distance(item, words[start:start + n]) == distance <= d.allowed_edits(len(item))


def hashes(words):
    return hashing.word_hashes(hashing.folded(" ".join(words)))[0]


def test_windows_lose_nothing():
    r = random.Random(3)
    voc = messy.vocabulary(4, 30)  # few words, so grams repeat
    items = [(i, " ".join(r.choices(voc, k=r.randint(3, 20)))) for i in range(40)]
    index = d.Index(items)
    checked = 0
    for _ in range(60):
        text = edited(r, r.choice(items)[1].split(), r.randint(0, 4), voc) + r.choices(voc, k=20)
        h = hashes(text)
        windows = {(int(a), int(n)) for _, a, n in index.windows(h, np.zeros(len(h), np.int64))}
        found = {i: dist for _, i, _, _, dist in index.leaks([" ".join(text)])}
        for i, item in items:
            words = item.split()
            most = d.allowed_edits(len(words))
            best = d.best_stretch(words, text, most)
            if best:
                checked += 1
                assert any(n == len(words) and abs(a - best[1]) <= most for a, n in windows)
                assert best[0] <= found.get(i, best[0]) <= most
            else:
                assert i not in found
    assert checked > 40


def zipf(rng, voc, n):
    p = 1 / np.arange(10, 10 + len(voc))  # the commonest word: about 1 in 60
    return list(rng.choice(voc, n, p=p / p.sum()))


def test_lsh_alone_recalls_and_selects():
    """All item-sized windows around a planted passage, without the 3-gram step."""
    r, rng = random.Random(5), np.random.default_rng(5)
    voc = messy.vocabulary(9, 3000)
    missed = planted = 0
    for n in (1, 2, 4, 5, 6, 9, 10, 20, 39, 40, 60, 120, 200):
        common = 0
        for _ in range(30):
            item, k = zipf(rng, voc, n), d.allowed_edits(n)
            text = r.choices(voc, k=k) + edited(r, item, k, voc) + r.choices(voc, k=n + k)
            h = hashes(text)
            own = d.lsh_keys(hashes(item)[None], np.array([n]), np.array([n]))
            x = np.stack([h[a:a + n] for a in range(2 * k + 1)])
            keys = d.lsh_keys(x, np.full(len(x), n), np.full(len(x), n))
            planted += 1
            missed += not ((keys == own) & (own != 0)).any()
            other = np.stack([hashes(zipf(rng, voc, n)) for _ in range(20)])
            theirs = d.lsh_keys(other, np.full(20, n), np.full(20, n))
            common += ((theirs == own) & (own != 0)).any(axis=1).sum()
        assert common <= 0.05 * 600, (n, common)
    assert missed <= 0.01 * planted


def test_walks_keep_equal_windows_equal_whatever_the_padding():
    x = np.arange(1, 11, dtype=np.uint64)[None]
    a = d.lsh_keys(x, np.array([10]), np.array([10]))
    b = d.lsh_keys(np.pad(x, ((0, 0), (0, 20))), np.array([10]), np.array([10]))
    assert np.array_equal(a, b)
    mixed = d.lsh_keys(np.pad(np.concatenate([x, x]), ((0, 0), (0, 20))), np.array([10, 10]), np.array([10, 30]))
    assert np.array_equal(a[0], mixed[0]) and not set(mixed[1].tolist()) & set(a[0].tolist()) - {0}


def test_every_size_has_keys():
    for n in range(1, 9):
        x = np.stack([hashes([f"w{i}x{k}" for k in range(n)]) for i in range(50)])
        assert (d.lsh_keys(x, np.full(50, n), np.full(50, n)) != 0).any(axis=1).all(), n


def test_long_texts_in_chunks(monkeypatch):
    text = " ".join(messy.vocabulary(1) * 20)
    data = hashing.folded(text)
    whole = hashing.word_hashes(data)
    monkeypatch.setattr(hashing, "CHUNK", 100)
    parts = hashing.word_hashes(data)
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts))
    assert len(hashing.word_hashes(b"x" * 350)[0]) == 4  # a run longer than a chunk


def test_messy_documents_and_items_in_blocks(spark):
    docs = messy.frame(spark)
    texts = messy.texts()
    long, other = texts[20].split(), texts[-1].split()[100:140]
    items = [(1, " ".join(long[:12])), (2, None), (3, ""), (4, " ".join(other).upper()), (5, "not in any document at all, ever"),
             (None, " ".join(texts[25].split()[:9]))]
    bench = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "item_id as doc_id", "1 as fp")
    one = sorted((r["doc_id"] is None, r["doc_id"], r["item_id"] is None, r["item_id"], r["distance"]) for r in d.find_leaks(docs, bench).collect())
    many = sorted((r["doc_id"] is None, r["doc_id"], r["item_id"] is None, r["item_id"], r["distance"])
                  for r in d.find_leaks(docs, bench, block_words=5).collect())
    assert one == many
    hit = [(x[1], x[3]) for x in one]
    assert hit.count((20, 1)) == 3 and (len(texts) - 1, 4) in hit and (25, None) in hit  # row 20 stands there three times
    kept = d.without_leaks(docs, bench)
    assert kept.schema == docs.schema
    bad = {x[1] for x in one}
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r[0]) for r in messy.rows() if r[0] not in bad)


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert d.find_leaks(messy.frame(spark), bench).count() == 0
    assert d.without_leaks(messy.frame(spark), bench).count() == len(messy.rows())
    some = spark.createDataFrame([(1, "some words to look for")], "item_id bigint, text string")
    assert d.find_leaks(messy.empty(spark), some).count() == 0

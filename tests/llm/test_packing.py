import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as vocabularies
import pytest

from tests.llm import messy
from trendlake.llm import packing as p
from trendlake.llm import queries

VOCABULARY = vocabularies.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encoder():
    return p.Encoder(VOCABULARY, vocabularies.path("byte_bpe_50k.tiktoken"), vocabularies.PATTERN)


def test_ids_equal_the_tokenizer(encoder):
    r = random.Random(1)
    bits = [" ", " ", "  ", "a", "bc", "é", "\n", "\n\n", " \n", "\t", "1", "'s", "'", "\xa0", "!", "...", "<|endoftext|>", "字", " ", "😀"]
    for t in messy.texts()[:40] + ["".join(r.choices(bits, k=r.randint(1, 14))) for _ in range(3000)]:
        assert encoder(t).tolist() == encoder.slow.encode(t or "", add_special_tokens=False).ids


def test_remembered_pieces_are_bounded(encoder):
    encoder.REMEMBERED = 50
    try:
        t = messy.texts()[-1]
        assert encoder(t).tolist() == encoder.slow.encode(t, add_special_tokens=False).ids
        encoder("two words")
        assert len(encoder.known) <= 51
    finally:
        del encoder.REMEMBERED


def plain_cost(places, cost, size):
    best = {0: 0}
    for q, c in zip(places, cost):
        best[q] = c + min(v + size - (q - o) for o, v in best.items() if q - o <= size)
    return best[places[-1]]


def test_cuts_are_optimal():
    r = random.Random(2)
    for _ in range(300):
        size = r.randint(4, 12)
        places, at = [], 0
        for _ in range(r.randint(1, 25)):
            at += r.randint(1, size)
            places.append(at)
        cost = [r.choice([0, 1, 3]) for _ in places]
        cuts = p.best_cuts(places, cost, size)
        assert cuts[-1] == places[-1] and all(b - a <= size for a, b in zip([0, *cuts], cuts))
        price = dict(zip(places, cost))
        assert sum(price[b] + size - (b - a) for a, b in zip([0, *cuts], cuts)) == plain_cost(places, cost, size)


def test_candidates_leave_no_wide_gap():
    for n, ends in ((1, []), (1000, []), (1000, [3, 500, 1000]), (40, [39])):
        places, cost = p.candidate_cuts(np.array(ends, np.int64), n)
        assert places[-1] == n and cost[-1] == 0 and (np.diff(places) > 0).all()
        assert max(np.diff(np.concatenate(([0], places)))) <= p.STRIDE


def test_pieces_restore_every_document(spark, encoder):
    rows = messy.rows()
    got = [r.asDict() for r in queries.pack(messy.frame(spark)).collect()]
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    copies = defaultdict(list)
    for r in rows:
        copies[r[0]].append(np.append(encoder(r[1]), np.uint32(1)).astype("<u4"))
    assert set(by_doc) == set(copies)
    for doc_id, ids in copies.items():
        pieces = sorted(by_doc[doc_id], key=lambda x: x["start"])
        assert all(x["doc_tokens"] == len(ids[0]) for x in pieces)
        assert sum(x["length"] for x in pieces) == len(ids) * len(ids[0])
        for x in pieces:
            assert x["ids_crc32"] == zlib.crc32(ids[0][x["start"]:x["start"] + x["length"]].tobytes())
    for pieces in by_sequence.values():
        pieces.sort(key=lambda x: x["offset"])
        at = 0
        for x in pieces:
            assert x["offset"] == at
            at += x["length"]
        assert at <= p.SIZE


def test_little_padding_and_order(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = queries.pack(docs).collect()
    used = defaultdict(int)
    for r in got:
        used[r["sequence_id"]] += r["length"]
    padding = sum(p.SIZE - n for n in used.values() if n & (n - 1))
    assert padding < 0.015 * sum(used.values())
    got.sort(key=lambda r: (r["sequence_id"], r["offset"]))
    assert [r["doc_id"] for r in got] == sorted(r["doc_id"] for r in got)


@pytest.mark.parametrize("kind", ["hashes", "gaps", "large", "null"])
def test_sparse_and_large_ids(spark, encoder, kind):
    """Few documents share an id's neighbourhood, or ids reach 2**40; sequences fill up all the same."""
    r = random.Random(3)
    ids = {"hashes": sorted(r.randrange(-1 << 63, 1 << 63) for _ in range(400)), "gaps": [1000 * i for i in range(400)],
           "large": [(1 << 40) + (i << 33) for i in range(400)], "null": [None] * 200 + list(range(-600, -400))}[kind]
    voc = messy.vocabulary()
    rows = [(i, " ".join(r.choices(voc, k=r.randint(1, 60))) + ".") for i in ids]
    got = queries.pack(spark.createDataFrame(r.sample(rows, len(rows)), "doc_id bigint, text string").repartition(8)).collect()
    used = defaultdict(int)
    for x in got:
        used[x["sequence_id"]] += x["length"]
    tokens = sum(len(encoder(t)) + 1 for _, t in rows)
    assert sum(used.values()) == tokens and sorted(used) == list(range(len(used)))
    assert len(used) <= 1.05 * tokens / p.SIZE + 1
    got.sort(key=lambda x: (x["sequence_id"], x["offset"]))
    found = [x["doc_id"] for x in got]
    assert found == sorted(found, key=lambda i: (i is not None, i or 0)) and set(found) == set(ids)


def test_repeats_of_one_row_are_spread_and_ids_may_be_strings(spark, encoder, monkeypatch):
    monkeypatch.setattr(p, "RUN_TOKENS", 5000)
    voc = messy.vocabulary()
    rows = [(None, " ".join(voc[:20]))] * 2000 + [(f"id{i}", " ".join(voc[i % 50:i % 50 + 20])) for i in range(2000)]
    sizes = []
    real = p.stored
    monkeypatch.setattr(p, "stored", lambda df, name: sizes.append(real(df, name)) or sizes[-1])
    got = queries.pack(spark.createDataFrame(rows, "doc_id string, text string").repartition(8)).collect()
    assert sum(r["length"] for r in got) == sum(len(encoder(t)) + 1 for _, t in rows)
    assert {r["doc_id"] for r in got} == {i for i, _ in rows}
    per = [r["count"] for r in sizes[0].filter("start = 0").groupBy("part").count().collect()]
    assert len(per) > 3 and max(per) < 2000 / 1.5


def test_runs_go_on_numbering_over_partitions(spark, encoder, monkeypatch):
    monkeypatch.setattr(p, "RUN_TOKENS", 3000)
    r = random.Random(4)
    voc = messy.vocabulary()
    rows = [(r.randrange(1 << 62), " ".join(r.choices(voc, k=r.randint(1, 200)))) for _ in range(300)]
    got = queries.pack(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted({x["sequence_id"] for x in got}) == list(range(max(x["sequence_id"] for x in got) + 1))
    got.sort(key=lambda x: (x["sequence_id"], x["offset"]))
    assert [x["doc_id"] for x in got] == sorted(x["doc_id"] for x in got)
    assert sum(x["length"] for x in got) == sum(len(encoder(t)) + 1 for _, t in rows)


def test_empty_table(spark):
    assert queries.pack(messy.empty(spark)).count() == 0

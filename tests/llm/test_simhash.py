import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tests.llm import messy
from trendlake.llm import simhash as s


def plain(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(prints, bits=4):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_fingerprints_and_components(spark):
    rows = messy.rows()
    got = s.simhash_components(messy.frame(spark)).collect()
    assert len(got) == len(rows)
    prints = [plain(r[1]) for r in rows]
    found = roots(prints)
    least = {}
    for r, root in zip(rows, found):
        if r[0] is not None:
            least[root] = min(least.get(root, r[0]), r[0])
    want = sorted((r[0] is None, r[0] or 0, format(p, "016x"), least.get(root)) for r, p, root in zip(rows, prints, found)
                  if least.get(root) is not None)
    assert sorted((r[0] is None, r[0] or 0, r[1], r[2]) for r in got if r[2] is not None) == want


def families(seed, n, size):
    """Fingerprints in clusters and chains of few differing bits, and lone ones."""
    r = random.Random(seed)
    out = []
    for _ in range(n):
        x = r.getrandbits(64)
        for _ in range(r.randint(1, size)):
            out.append(x)
            for _ in range(r.randint(1, 5)):
                x ^= 1 << r.randrange(64)
    return sorted(set(out))


def as_frame(spark, prints):
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    return spark.createDataFrame([(x,) for x in signed], "fp bigint")


def check_components(spark, prints, **options):
    got = {r["node"]: r["root"] for r in s.components(s.links(as_frame(spark, prints), **options)).collect()}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    groups = {}
    for x, root in zip(signed, roots(prints)):
        groups.setdefault(root, []).append(x)
    want = {x: min(g) for g in groups.values() for x in g if x != min(g)}
    assert got == want


def test_links_lose_nothing(spark):
    check_components(spark, families(1, 60, 8))


def test_parts_follow_the_number_of_fingerprints():
    assert s.parts_for(0) == s.parts_for(10_000_000) == 6 and s.parts_for(20_000_000) == 7
    assert [s.parts_for(10 ** k) for k in range(6, 12)] == sorted(s.parts_for(10 ** k) for k in range(6, 12))
    # evenly spread fingerprints: the largest cell of each choice of parts stays bounded
    fp = np.random.default_rng(1).integers(0, 1 << 64, 1_000_000, dtype=np.uint64)
    low, high = fp & np.uint64(0x5555555555555555), (fp >> np.uint64(1)) & np.uint64(0x5555555555555555)
    code = ((low & high) << np.uint64(1)) | low | high
    for mask in s.part_masks(4, 7)[:6]:
        assert np.unique(code & np.uint64(mask % (1 << 64)), return_counts=True)[1].max() < 200


def test_hot_cells_are_split_and_lose_nothing(spark):
    r = random.Random(5)
    base = r.getrandbits(64)
    dense = {base}
    while len(dense) < 300:  # one cluster around a base
        x = base
        for _ in range(r.randint(1, 4)):
            x ^= 1 << r.randrange(64)
        dense.add(x)
    check_components(spark, sorted(dense), block=16)


def test_links_grow_with_the_rows_not_their_pairs(spark):
    r = random.Random(6)
    base = r.getrandbits(64)
    dense = {base ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)}  # all within four bits
    assert s.links(as_frame(spark, sorted(dense))).count() <= 15 * len(dense)


def test_embedding_is_a_lower_bound(spark):
    r = random.Random(7)
    prints = [r.getrandbits(64) for _ in range(300)]
    codes = [x[0] & (1 << 64) - 1 for x in as_frame(spark, prints).select(s.embed(F.col("fp"))).collect()]
    counts = [[(p >> 2 * k & 3).bit_count() for k in range(32)] for p in prints]
    for i in range(0, 300, 7):
        for j in range(300):
            l1 = sum(abs(a - b) for a, b in zip(counts[i], counts[j]))
            assert (codes[i] ^ codes[j]).bit_count() == l1 <= (prints[i] ^ prints[j]).bit_count()


def test_long_texts_in_blocks():
    text = " ".join(messy.vocabulary(1) * 500)
    assert s.fingerprint(text.encode()) == plain(text)
    assert s.fingerprint(None) == s.fingerprint(b" \n") == 0


def test_keep_first(spark):
    docs = messy.frame(spark)
    kept = s.keep_first(docs)
    assert kept.schema == docs.schema
    rows = kept.collect()
    report = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in s.simhash_components(docs).collect()}
    groups = set(report.values())
    assert len(rows) == len(groups)
    assert len({r["doc_id"] for r in rows}) == len(rows)
    assert np.all([report[r["doc_id"], format(plain(r["text"]), "016x")] == r["doc_id"] for r in rows])


def test_keep_first_tells_components_without_ids_apart(spark):
    voc = messy.vocabulary(8)
    a, b, c = (" ".join(voc[k:k + 60]) for k in (0, 100, 200))
    rows = [(None, a), (None, a), (None, b), (7, c), (None, c)]
    kept = s.keep_first(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == sorted([(0, a), (0, b), (7, c)])


def test_empty_table(spark):
    assert s.simhash_components(messy.empty(spark)).count() == 0
    assert s.keep_first(messy.empty(spark)).count() == 0

import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import messy
from trendlake.llm import periodic_runs as p


def smallest_period(w):
    return next(q for q in range(1, len(w) + 1) if all(w[i] == w[i + q] for i in range(len(w) - q)))


def plain_runs(w, min_length=6, exponent=4):
    """Every stretch that keeps a period, by scanning each period."""
    out = set()
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(min_length, exponent * q) and smallest_period(w[i:i + length]) == q:
                out.add((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def symbols(texts):
    code = {}
    return np.array([code.setdefault((k, x), len(code)) for k, t in enumerate(texts) for x in [*t, None]])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab", max_size=60) | st.text("abc", max_size=30), max_size=4),
       st.sampled_from([(6, 4), (2, 2), (3, 2), (6, 3), (1, 5)]))
def test_runs_equal_the_scan(texts, limits):
    got = p.runs(symbols(texts), *limits)
    want, at = [], 0
    for t in texts:
        want += [(at + s, n, q) for s, n, q in plain_runs(t, *limits)]
        at += len(t) + 1
    assert got == sorted(want, key=lambda r: (r[0], r[2]))


def test_nested_and_long_runs():
    r = random.Random(4)
    for unit in ("a", "ab", "aab" * 5 + "c", "".join(r.choices("abcd", k=50))):
        t = "x" + unit * 40 + unit[:len(unit) // 2] + "yy" + "ab" * 9
        assert p.runs(symbols([t])) == plain_runs(t)
    assert p.runs(symbols(["a" * 50_000])) == [(0, 50_000, 1)]


def test_ordered_set_equals_a_sorted_list(monkeypatch):
    monkeypatch.setattr(p, "BLOCK", 2)
    r = random.Random(1)
    values = r.sample(range(1000), 300)
    have, got = [values[0]], p.Positions(values[0])
    for x in values[1:]:
        below, above = [y for y in have if y < x], [y for y in have if y > x]
        assert got.around(x) == (max(below, default=-1), min(above, default=-1))
        got.add(x)
        have.append(x)
        assert list(got) == sorted(have) and got.size == len(have)


def plain_digest(doc_id, text):
    w = (text or "").encode().split()
    n, h = len(w), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        q = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % q] for i in range(n)]
    found = plain_runs(w) if n < 3000 else p.runs(symbols([w]))
    drop = {i for s, length, q in found for i in range(s + q, s + length)}
    top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (doc_id, len(found), top[0], top[1], top[2], 1000 * top[1] // top[2] if found else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in drop)).hexdigest())


def key(row):
    return tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in row)


def test_query_equals_brute_force(spark):
    rows = messy.rows(3)
    got = [tuple(r) for r in p.run_digests(messy.frame(spark, 3)).collect()]
    assert sorted(got, key=key) == sorted((plain_digest(r[0], r[1]) for r in rows), key=key)
    assert sum(r[1] > 0 for r in got) > 3 and len({r[4] for r in got}) > 3
    assert p.run_digests(messy.empty(spark)).collect() == []


def test_small_slices_change_nothing():
    texts = [(t or "").encode() for t in messy.texts(5)]
    whole = list(p.slice_runs(texts, 6, 4))
    cut = [r for t in texts for r in p.slice_runs([t], 6, 4)]
    assert whole == cut

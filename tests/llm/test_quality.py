import re
import time
from collections import Counter, defaultdict

from tests.llm import messy
from trendlake.llm import quality as q

WORD = re.compile("[^\x20\x09-\x0D]+")


def norm(line):
    return re.sub("[0-9]", "0", " ".join(WORD.findall(line.lower())))


def brute(docs, max_docs, min_left):
    """docs: (doc_id, text, source) -> report rows."""
    per = []
    holders = defaultdict(set)
    for doc_id, text, source in docs:
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        per.append(lines)
        for x in lines:
            holders[source, norm(x)].add(text)
    out = []
    for (doc_id, text, source), lines in zip(docs, per):
        t = text or ""
        w = WORD.findall(t)
        windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
        count = Counter(windows)
        covered = {i + k for i, x in enumerate(windows) if count[x] > 1 for k in range(8)}
        gone = [x for x in lines if len(holders[source, norm(x)]) > max_docs]
        left = len(w) - sum(len(WORD.findall(x)) for x in gone)
        failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        out.append((doc_id, len(w), sum(map(len, w)), sum(c in q.SYMBOLS for c in t), len(lines) - len(set(lines)),
                    len(covered), failed, len(gone), left, not failed and left >= min_left * len(w)))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def test_report_matches_brute_force(spark):
    got = q.line_frequency_quality(messy.frame(spark), max_docs=2, min_left=0.9).collect()
    want = brute([(r[0], r[1], r[3]) for r in messy.rows()], 2, 0.9)
    assert order(map(tuple, got)) == order(want)
    assert any(r["n_removed_lines"] for r in got) and any(not r["base_failed"] and not r["kept"] for r in got)


def test_copies_of_one_document_are_no_boilerplate(spark):
    voc = messy.vocabulary(3)
    body = " ".join(voc[:60]) + "\n" + " ".join(voc[60:70])
    rows = [(i, body, "en", "s", 1) + (0,) * (len(messy.SCHEMA) - 5) for i in range(50)]
    got = q.line_frequency_quality(spark.createDataFrame(rows, messy.SCHEMA)).collect()
    assert all(r["kept"] and r["n_removed_lines"] == 0 for r in got)


def test_menu_and_long_footer_of_many_documents_go(spark):
    voc = messy.vocabulary(5, 4000)
    menu, footer = "home news shop contact", " ".join(voc[:60])
    bodies = [" ".join(voc[100 + 18 * i:118 + 18 * i]) + "\n" + " ".join(voc[200 + 17 * i:212 + 17 * i]) for i in range(200)]
    rows = [(i, f"{menu}\n{b}\n{footer}", "en", "s", 1) + (0,) * (len(messy.SCHEMA) - 5) for i, b in enumerate(bodies)]
    docs = spark.createDataFrame(rows, messy.SCHEMA)
    assert {r["n_removed_lines"] for r in q.line_frequency_quality(docs).collect()} == {2}
    kept = {r["doc_id"]: r["text"] for r in q.clean(docs, min_left=0.2).collect()}
    assert kept == dict(enumerate(bodies))


def test_many_removed_lines_of_one_document_take_linear_time(spark):
    lines = [f"kept word{k:x} and more" if k % 3 else f"gone {chr(97 + k % 26) * (1 + k // 26 % 40)} q{k // 1040:o}" for k in range(96_000)]
    text = "\n".join(lines)
    docs = spark.createDataFrame([(1, text, "s")], "doc_id bigint, text string, source string")
    assert q.clean(docs, max_docs=0, min_left=0.0).first()["text"] == ""
    started = time.time()
    two = spark.createDataFrame([(1, text, "s"), (2, "\n".join(lines[::3]), "s")], "doc_id bigint, text string, source string")
    got = {r["doc_id"]: r["text"] for r in q.clean(two, max_docs=1, min_left=0.0).collect()}
    assert got[1] == "\n".join(x for k, x in enumerate(lines) if k % 3) and time.time() - started < 40


def test_clean_removes_lines_and_keeps_columns(spark):
    docs = messy.frame(spark)
    got = q.clean(docs, max_docs=2, min_left=0.3)
    assert got.schema.names == docs.schema.names and got.dtypes == docs.dtypes
    report = {r[0]: r for r in brute([(r[0], r[1], r[3]) for r in messy.rows()], 2, 0.3)}
    rows = got.collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in messy.rows() if report[r[0]][-1])
    for r in rows:
        assert len(WORD.findall(r["text"])) == report[r["doc_id"]][8]
        assert r["n_chars"] == len(r["text"])
        assert r["kept"] == 6  # an extra column of the same name as ours


def test_empty_table(spark):
    assert q.line_frequency_quality(messy.empty(spark)).count() == 0
    assert q.clean(messy.empty(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = q.line_frequency_quality(messy.frame(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan

import importlib
import re
import subprocess
import sys
from collections import Counter, defaultdict
from pathlib import Path

import corpus_pipeline as cp
import __spark_entry__ as entry
from tests.llm import messy
from tests.llm.test_simhash import plain, roots
from trendlake.llm import decontaminate, packing, quality, queries, toxicity
from trendlake.llm.text import stored
from trendlake.sources.tables import table

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


def test_stages_and_registration():
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "toxicity", "simhash_near_dedup", "benchmark_decontamination", "packing"]
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1


def test_each_stage_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    before = {r["doc_id"]: r for r in docs.collect()}

    kept = stored(cp.STAGES[0][1](spark, docs, SF), "t0")
    report = {r["doc_id"]: r for r in quality.line_frequency_quality(docs).collect()}
    after = {r["doc_id"]: r for r in kept.collect()}
    assert kept.columns == columns and set(after) == {d for d, r in report.items() if r["kept"]}
    for d, r in after.items():
        lost = Counter(before[d]["text"].split("\n")) - Counter(r["text"].split("\n"))
        assert sum(lost.values()) == report[d]["n_removed_lines"] and r["n_chars"] == len(r["text"])

    before, docs = after, kept
    kept = stored(cp.STAGES[1][1](spark, docs, SF), "t1")
    scores = {r["doc_id"]: r["predicted"] for r in toxicity.score_toxicity(docs, table(spark, SF, "labels")).collect()}
    after = {r["doc_id"]: r for r in kept.collect()}
    assert kept.columns == columns and set(after) == {d for d, p in scores.items() if not p}

    before, docs = after, kept
    kept = stored(cp.STAGES[2][1](spark, docs, SF), "t2")
    after = {r["doc_id"]: r for r in kept.collect()}
    ids = sorted(before)
    groups = defaultdict(list)
    for d, root in zip(ids, roots([plain(before[d]["text"]) for d in ids])):
        groups[root].append(d)
    assert kept.columns == columns and sorted(after) == sorted(min(g) for g in groups.values())

    before, docs = after, kept
    kept = stored(cp.STAGES[3][1](spark, docs, SF), "t3")
    after = {r["doc_id"]: r for r in kept.collect()}
    items = [" ".join(re.findall(r"\w+", r["text"].lower())) for r in table(spark, SF, "benchmark").collect()]
    holds = {d for d, r in before.items() if any(x in " ".join(re.findall(r"\w+", r["text"].lower())) for x in items)}
    assert kept.columns == columns and not holds & set(after)
    found = {r["doc_id"] for r in decontaminate.find_leaks(docs, table(spark, SF, "benchmark")).collect()}
    assert set(after) == set(before) - found and holds <= found

    pieces = cp.STAGES[4][1](spark, kept, SF)
    assert pieces.columns == list(packing.COLUMNS)
    tokens = defaultdict(int)
    for r in pieces.collect():
        tokens[r["doc_id"]] += r["length"]
    assert set(tokens) == set(after)


def test_run_gives_the_last_stage(spark):
    got = cp.run(spark, SF)
    assert got.columns == list(packing.COLUMNS) and got.count() > 0


def test_messy_and_empty_documents_pass_every_stage(spark):
    for docs in (messy.frame(spark), messy.empty(spark)):
        for name, stage in cp.STAGES:
            out = stored(stage(spark, docs, SF), "t")
            if name != "packing":
                assert out.schema.names == messy.SCHEMA.names
                docs = out
        assert (out.count() > 0) == (docs.count() > 0)


def test_entry_works_without_the_corpus_folders(tmp_path):
    code = ("import sys, importlib.abc\n"
            "class Gone(importlib.abc.MetaPathFinder):\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name.startswith('trendlake.llm') or name == 'corpus_pipeline':\n"
            "            raise ModuleNotFoundError(name, name=name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e\n"
            "assert not any(k.startswith('op') or k == 'pipeline' for k in e.queries()), sorted(e.queries())\n"
            "assert len(e.queries()) > 30 and e.oracle_sql()\n")
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_the_corpus_operators():
    for f in ROOT.rglob("*.py"):
        inside = "llm" in f.relative_to(ROOT).parts or f.name in ("corpus_pipeline.py", "__spark_entry__.py")
        assert inside or "trendlake.llm" not in f.read_text() or f.name.startswith("."), f
    assert importlib.import_module("trendlake.llm.queries").REGISTRY is queries.REGISTRY

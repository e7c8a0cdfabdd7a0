"""Quality rules: cross-document line frequency.

A line (lower-cased, white space collapsed, digits read as 0) is boilerplate of a
host when more than ``max_docs`` different documents of that host hold it. Such
lines are removed, and a document left with under ``min_left`` of its words is
depleted and rejected, as is one that fails the base limits.

Documents are told apart by their whole text, so exact copies count once and a group of
them doesn't turn its own text into boilerplate, while a footer or menu below many
different bodies is counted in each. Near copies are different documents: a line that more than ``max_docs``
of them share is removed like any other.

Plan: all expressions are Spark's own. Lines are hashed inside the row, exploded
to (host, hash, document key, place), stored (numbers only), pre-aggregated before each shuffle and counted in
two steps (distinct documents, then a count), so neither a hot host nor a hot line
gathers its rows in one task. The lines above the limit are stored; their join
back is broadcast only if Spark finds the stored table small, else it is a
sort-merge join whose hot partitions AQE splits.

Defined results: null or empty text, or one without words: zero counts, fails the
base limits. Null host: a host of its own. Repeated rows: each judged alike and
returned as often as given; they count as one document. Empty table: empty
result. Extra columns don't matter; clashing names are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.llm.text import WS, WS_RUN, let, stored, text_key, words

WINDOW = 8  # words of a repeated window
MAX_DOCS = 20
MIN_LEFT = 0.3
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"


def lines_with_words(text: Column) -> Column:
    """The \\n-split lines that hold a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"),
                    lambda line: F.btrim(line, F.lit(WS)) != "")


def normalised(line: Column) -> Column:
    flat = F.regexp_replace(F.btrim(F.lower(line), F.lit(WS)), WS_RUN, " ")
    return F.regexp_replace(flat, "[0-9]", "0")


def repeated_words(tokens: Column, k: int = WINDOW) -> Column:
    """Words that lie in a ``k``-word window found twice or more in the text.

    Windows are compared by a 64-bit hash of their words' 64-bit hashes. Without a
    repeated window the sort is skipped. All steps are (near) linear in the text.
    """
    def covered(windows: Column) -> Column:
        order = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = let(order, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda e, j: F.coalesce(F.get(s, j - 1)["h"] == e["h"], F.lit(False))
                     | F.coalesce(F.get(s, j + 1)["h"] == e["h"], F.lit(False))),
            lambda e: e["i"])))
        return let(again, lambda p: F.aggregate(
            F.transform(p, lambda x, j: F.least(F.lit(k), F.coalesce(F.get(p, j + 1) - x, F.lit(k)))),
            F.lit(0), lambda total, x: total + x))

    def of_hashes(h: Column) -> Column:
        n = F.size(h)
        windows = F.transform(F.sequence(F.lit(0), n - k),
                              lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)]))
        return F.when(n < k, F.lit(0)).otherwise(let(windows, lambda w: F.when(
            F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w))))

    return let(F.transform(tokens, lambda w: F.xxhash64(w)), of_hashes)


def base_columns(text: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) of a text."""
    t = F.coalesce(text, F.lit(""))
    counts = let(words(t), lambda w: F.struct(F.size(w).cast("long").alias("n"),
                                              repeated_words(w).cast("long").alias("r")))
    dups = let(lines_with_words(t), lambda x: F.size(x) - F.size(F.array_distinct(x)))
    return {"n_words": counts["n"],
            "word_chars": F.length(F.translate(t, WS, "")).cast("long"),
            "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": dups.cast("long"),
            "n_repeat_words": counts["r"]}


def document_lines(docs: DataFrame, text: str, host: str) -> DataFrame:
    """One row per line with a word: ``_id``, ``_host``, ``_key``, ``at`` (its place among all lines),
    ``h``, ``w`` (words)."""
    lines = F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x, i: F.struct(
        i.alias("at"), F.btrim(x, F.lit(WS)).alias("line")))
    entries = F.transform(F.filter(lines, lambda x: x["line"] != ""), lambda x: F.struct(
        F.size(F.split(x["line"], WS_RUN)).alias("w"), normalised(x["line"]).alias("line"), x["at"].alias("at")))
    # the key first: beside the generator it would be computed anew for every line
    d = docs.select(F.col("doc_id").alias("_id"), F.col(host).alias("_host"),
                    text_key(F.col(text)).alias("_key"), entries.alias("_e"))
    d = d.select("_id", "_host", "_key", F.inline("_e"))
    return d.select("_id", "_host", "_key", "at", F.xxhash64("line").alias("h"), "w")


def boilerplate_lines(lines: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """(``_host``, ``h``) of the lines in more than ``max_docs`` documents of a host."""
    documents = lines.groupBy("_host", "h", "_key").agg(F.lit(1).alias("_one"))
    counts = documents.groupBy("_host", "h").agg(F.count(F.lit(1)).alias("n_docs"))
    return counts.filter(F.col("n_docs") > max_docs)


def removed_lines(docs: DataFrame, text: str = "text", host: str = "source",
                  max_docs: int = MAX_DOCS) -> DataFrame:
    """Per document with a line above the limit: ``_id``, ``_host``, ``_key`` and ``removed`` (places and
    words of these lines). Repeated rows give one row here."""
    lines = stored(document_lines(docs, text, host), "document_lines")
    frequent = stored(boilerplate_lines(lines, max_docs).select(F.col("_host").alias("_fh"), F.col("h").alias("_f")),
                      "frequent_lines")
    hit = lines.join(frequent, lines["_host"].eqNullSafe(frequent["_fh"]) & (lines["h"] == frequent["_f"]))
    return hit.groupBy("_id", "_host", "_key").agg(F.collect_set(F.struct("at", "w")).alias("removed"))


def judge(docs: DataFrame, text: str = "text", host: str = "source", max_docs: int = MAX_DOCS,
          min_left: float = MIN_LEFT, carry: list[str] | None = None) -> DataFrame:
    """One row per document: ``_id``, ``_key``, the base columns, ``base_failed``, ``n_removed_lines``,
    ``words_left``, ``removed`` (null: no line) and ``kept``; plus ``carry`` columns of ``docs``.
    """
    removed = removed_lines(docs, text, host, max_docs).select(
        F.col("_id").alias("_rid"), F.col("_host").alias("_rhost"), F.col("_key").alias("_rkey"), "removed")
    base = docs.select(*[F.col(c) for c in carry or []], F.col("doc_id").alias("_id"),
                       F.col(host).alias("_host"), text_key(F.col(text)).alias("_key"),
                       *[c.alias(f"_{n}") for n, c in base_columns(F.col(text)).items()])
    j = base.join(removed, base["_id"].eqNullSafe(removed["_rid"]) & base["_host"].eqNullSafe(removed["_rhost"])
                  & (base["_key"] == removed["_rkey"]), "left")
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda a, e: a + e["w"])
    j = j.withColumns({
        "n_removed_lines": F.coalesce(F.when(F.col("removed").isNotNull(), F.size("removed")), F.lit(0)).cast("long"),
        "words_left": F.col("_n_words") - F.coalesce(gone, F.lit(0)),
        "base_failed": (F.col("_n_words") < MIN_WORDS)
        | (100 * F.col("_n_repeat_words") > MAX_REPEAT_PERCENT * F.col("_n_words"))})
    return j.withColumn("kept", ~F.col("base_failed") & (F.col("words_left") >= min_left * F.col("_n_words"))) \
        .drop("_rid", "_rhost", "_rkey")


def line_frequency_quality(docs: DataFrame, **options) -> DataFrame:
    """The report: doc_id, base counts, base_failed, n_removed_lines, words_left, kept."""
    out = judge(docs, **options)
    return out.select(F.col("_id").alias("doc_id"),
                      *[F.col(f"_{n}").alias(n) for n in
                        ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                      "base_failed", "n_removed_lines", "words_left", "kept")


def clean(docs: DataFrame, text: str = "text", host: str = "source", max_docs: int = MAX_DOCS,
          min_left: float = MIN_LEFT) -> DataFrame:
    """``docs`` without rejected documents and without the removed lines (n_chars follows the text)."""
    renamed = docs.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(docs.columns)],
                          *[F.col(c).alias(n) for c, n in (("doc_id", "doc_id"), (text, "_text"), (host, "_source"))])
    names = [f"_c{i}" for i in range(len(docs.columns))]
    j = judge(renamed, "_text", "_source", max_docs, min_left, carry=[*names, "_text"]).filter("kept")
    # the places that stay by a set difference, so the work is linear in the lines
    rest = let(F.split("_text", "\n"), lambda lines: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.transform("removed", lambda e: e["at"])),
        lambda i: F.get(lines, i)), "\n"))
    new = F.when(F.col("removed").isNull(), F.col("_text")).otherwise(rest)
    made = {text: new, "n_chars": F.length(new).cast(dict(docs.dtypes).get("n_chars", "bigint"))}
    return j.select(*[made.get(c, F.col(n)).alias(c) for c, n in zip(docs.columns, names)])

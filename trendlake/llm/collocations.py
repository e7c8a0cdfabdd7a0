"""Phrase collocations by stripes: every prefix keys a counter of its next words.

Level m counts phrases of m words. A task makes the stripes of a slice of texts: for each
(language, prefix of m - 1 words) the associative counter of next words. Stripes meet by
(language, prefix, segment) and are added element by element; they travel in bundles, a
part of the keys by hash each, as most stripes of a slice are short. That structure gives all:

- extensions: the entries of at least ``min_count`` are the frequent phrases;
- prefix totals: the empty prefix's stripe sums to n, and the entry of a phrase is the
  total of the next level's stripe whose prefix it is, joined once a stripe; so each phrase
  carries the counts of all its beginnings, and of all its endings by the phrase
  without its first word;
- subsumption maxima: a stripe's largest entry is the best extension of its prefix to the
  right, the largest entry over stripes that end alike the best one to the left. Counts
  only fall as phrases grow, so a longer phrase that subsumes implies one by a single word.

A phrase is frequent only if the phrases without its first and without its last word are.
Tasks test that by a bitmap of phrase hashes of at most ``MAX_BITS`` bits (a power of two
by the number of frequent phrases), which is broadcast and destroyed after its level. Phrases
that share a bit only cost counting; words are compared as strings, so results are exact at any size.
The driver holds one bitmap and reads it page by page. Tables of phrases meet by merge joins: a broadcast
would bring them to the driver whole, and a few MB of Parquet are hundreds there, 16 times dealt out by salt.

Hot prefixes (a share of over 1/``HOT`` of all words, under ``HOT`` of a size, known to the tasks
by a second, small bitmap) and the empty prefix are dealt to segments by their next word, so no
task gathers a whole language. Texts are read in slices of ``SLICE`` bytes; a longer text
is cut between words, each part followed by the next words that its phrases need.

The cut of a phrase with the smallest floor(1000 * a * n / (l * r)) counts, computed in
decimals of 38 digits. Each language's first ``limit`` come from the firsts of hashed parts.

Defined results: null language: ``und``; null, empty or wordless texts add nothing; repeated
rows count each. Empty table, or no frequent phrase: empty result. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlake.llm.hashing import FACTOR, mix
from trendlake.llm.tasks import map_batches
from trendlake.llm.text import stored

MAX_WORDS = 5
MIN_COUNT = 100
SUBSUMED_PERCENT = 100
LIMIT = 2000
SLICE = 4 << 20  # bytes of text counted together: a task holds some 30 times as much
ROW = 1024  # entries of a bundle, beyond the last stripe's
ENTRIES = 1 << 17  # of bundles added at once, beyond the last bundle's
READ = 64  # texts taken from a batch at once
PARTS_LEAST, PART_WORDS = 4096, 1 << 18  # parts of the stripes: so many, or one for so many words of the texts
FIRST_SEGMENTS = 1024  # of the empty prefix
SEGMENTS = 64  # of a hot prefix
HOT = 500
SALTS = 16
RANKED_PARTS = 64  # of a language, for its first phrases
MIN_BITS, MAX_BITS = 1 << 20, 1 << 28
HOT_BITS = 1 << 20
PAGE = 32768  # bits of one of Spark's bitmaps

# Upper-case letters and the characters that end a piece or a word.
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + b".,;:!?\x0a\x0b\x0c\x0d" + b"\t",
                       b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 10 + b" ")
NEXT_WORDS = {m: re.compile(rb"(?:[ \n]*[^ \n]+){0,%d}" % (m - 1)) for m in range(1, 33)}

# a bundle of stripes of one part; each stripe's words joined by spaces, the counts of all in a row
BUNDLE = "part int, lang array<string>, prefix array<string>, words array<string>, counts array<int>"


@dataclass
class Frequent:
    """Bitmaps of the hashes of frequent (``bits`` bits) and of hot phrases of one size."""
    bits: int
    found: np.ndarray
    hot: np.ndarray

    @staticmethod
    def has(bitmap: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
        at = h & np.uint64(bits - 1)
        return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(np.bool_)


def first_of_runs(*columns: np.ndarray) -> np.ndarray:
    """Where a run of rows that are alike in all columns begins."""
    change = np.zeros(max(len(columns[0]) - 1, 0), np.bool_)
    for c in columns:
        change |= c[1:] != c[:-1]
    return np.flatnonzero(np.append(True, change)[:len(columns[0])])


def string_hashes(strings: pa.Array) -> np.ndarray:
    values = np.empty(len(strings), object)
    values[:] = strings.to_pylist()
    return pd.util.hash_array(values, categorize=False)


def extended(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase with one more word."""
    return mix(h * FACTOR + word)


def values(column: pa.Array) -> Iterator:
    for at in range(0, len(column), READ):
        yield from column.slice(at, READ).to_pylist()


def slices(langs: Iterable[str], texts: Iterable[bytes], size: int) -> Iterator[tuple[list[str], list[bytes], int]]:
    """(languages, folded texts, bytes in which a phrase may begin) of at most SLICE bytes or so."""
    some: tuple[list[str], list[bytes]] = ([], [])
    held = 0
    for lang, text in zip(langs, texts):
        text = text.translate(FOLD)
        if held and held + len(text) > SLICE:
            yield *some, held
            some, held = ([], []), 0
        if len(text) > SLICE:
            at = 0
            while at < len(text):
                cut = max(text.rfind(b" ", at, at + SLICE), text.rfind(b"\n", at, at + SLICE)) + 1
                if at + SLICE >= len(text):
                    cut = len(text)
                elif cut <= at:  # a word longer than a slice
                    ends = [e for e in (text.find(b" ", at + SLICE), text.find(b"\n", at + SLICE)) if e >= 0]
                    cut = min(ends) + 1 if ends else len(text)
                yield [lang], [text[at:NEXT_WORDS[size].match(text, cut).end()]], cut - at
                at = cut
            continue
        some[0].append(lang)
        some[1].append(text)
        held += len(text) + 1
    if some[0]:
        yield *some, held


class Slice:
    """The words of some texts, numbered, with what phrase each word may begin."""

    def __init__(self, langs: list[str], texts: list[bytes], limit: int):
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        gap = (data == 32) | (data == 10)
        edge = np.flatnonzero(np.diff(np.concatenate(([True], gap)).view(np.int8)))  # where words begin and end
        start, end = edge[::2], edge[1::2]
        size = end - start
        offset = np.zeros(len(start) + 1, np.int32)
        np.cumsum(size, out=offset[1:])
        words = pa.Array.from_buffers(pa.string(), len(start), [None, pa.py_buffer(offset), pa.py_buffer(data[~gap])])
        code = words.dictionary_encode()
        self.words, self.code = code.dictionary, np.asarray(code.indices, np.int64)
        self.hashes = string_hashes(self.words)
        self.piece = np.cumsum(data == 10, dtype=np.int32)[start]
        text_end = np.cumsum([len(t) + 1 for t in texts])
        lang = pa.array(langs, pa.string()).dictionary_encode()
        self.langs = lang.dictionary
        self.lang = np.repeat(np.asarray(lang.indices, np.int64), np.diff(np.searchsorted(start, text_end), prepend=0))
        self.lang_hashes = string_hashes(self.langs)
        self.may_begin = start < limit

    def phrase_hashes(self, size: int) -> np.ndarray:
        """Of the phrases of ``size`` words from each word that has enough words after it."""
        m = max(len(self.code) - size + 1, 0)
        h = self.lang_hashes[self.lang[:m]]
        for j in range(size):
            h = extended(h, self.hashes[self.code[j:j + m]])
        return h

    def begins(self, size: int, frequent: Frequent | None) -> tuple[np.ndarray, np.ndarray]:
        """Words where a phrase of ``size`` words begins that may be frequent, and whether its prefix is hot."""
        m = max(len(self.code) - size + 1, 0)
        ok = self.may_begin[:m].copy()
        if size > 1:
            ok &= self.piece[:m] == self.piece[size - 1:]
            h = self.phrase_hashes(size - 1)
            known = frequent.has(frequent.found, h, frequent.bits)
            ok &= known[:m] & known[1:m + 1]
            at = np.flatnonzero(ok)
            return at, frequent.has(frequent.hot, h[at], 8 * len(frequent.hot))
        at = np.flatnonzero(ok)
        return at, np.ones(len(at), np.bool_)

    def stripes(self, size: int, frequent: Frequent | None, parts: int) -> pa.RecordBatch:
        """The slice's stripes in bundles by part."""
        at, hot = self.begins(size, frequent)
        count_of_words = max(len(self.words), 1)
        prefix = self.lang[at]
        for j in range(size - 1):  # numbers of equal prefixes; each step stays below words * words
            prefix = np.unique(prefix * count_of_words + self.code[at + j], return_inverse=True)[1]
        key, first, count = np.unique(prefix * count_of_words + self.code[at + size - 1], return_index=True, return_counts=True)
        one = at[first]
        word = self.code[one + size - 1]
        segment = np.where(hot[first], self.hashes[word] % np.uint64(FIRST_SEGMENTS if size == 1 else SEGMENTS), 0).astype(np.int32)
        prefix = key // count_of_words
        stripe_hash = self.phrase_hashes(size - 1)[one] + segment.astype(np.uint64)
        part = (mix(stripe_hash) % np.uint64(parts)).astype(np.int32)
        by = np.lexsort((segment, prefix, part))
        prefix, one, word, segment, count, part = prefix[by], one[by], word[by], segment[by], count[by], part[by]

        stripe = first_of_runs(part, prefix, segment)  # each one's first entry
        row = first_of_runs(part[stripe], stripe // ROW)  # each one's first stripe
        entry_at = pa.array(np.append(stripe, len(word)).astype(np.int32))
        stripe_at = pa.array(np.append(row, len(stripe)).astype(np.int32))
        begin = one[stripe]
        before = [self.words.take(pa.array(self.code[begin + j])) for j in range(size - 1)]
        prefixes = pc.binary_join_element_wise(*before, " ") if before else pa.array([""] * len(stripe), pa.string())
        joined = pc.binary_join(pa.ListArray.from_arrays(entry_at, self.words.take(pa.array(word))), " ")
        counts_at = pa.array(np.append(stripe[row], len(word)).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array(part[stripe[row]]), pa.ListArray.from_arrays(stripe_at, self.langs.take(pa.array(self.lang[begin]))),
             pa.ListArray.from_arrays(stripe_at, prefixes), pa.ListArray.from_arrays(stripe_at, joined),
             pa.ListArray.from_arrays(counts_at, pa.array(count.astype(np.int32)))],
            ["part", "lang", "prefix", "words", "counts"])


def counted(batches: Iterator[pa.RecordBatch], size: int, frequent: Frequent | None, parts: int) -> Iterator[pa.RecordBatch]:
    """The bundles of batches of lang, text."""
    for batch in batches:
        for langs, some, limit in slices(values(batch.column("lang")), values(batch.column("text")), size):
            yield from rows_of(Slice(langs, some, limit).stripes(size, frequent, parts))


def rows_of(bundles: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, bundles.num_rows, 1000):
        yield bundles.slice(at, 1000)


def by_entries(bundles: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """``bundles`` in pieces of ``ENTRIES`` entries or so."""
    end = np.cumsum(np.asarray(pc.list_value_length(bundles.column("counts")), np.int64))
    at = done = 0
    while at < bundles.num_rows:
        to = int(np.searchsorted(end, done + ENTRIES)) + 1
        yield bundles.slice(at, to - at)
        at, done = to, int(end[min(to, len(end)) - 1])


def added(batches: Iterator[pa.RecordBatch], min_count: int) -> Iterator[pa.RecordBatch]:
    """Bundles sorted by part, their stripes added element by element: total and entries of at least ``min_count``."""
    by = ["lang", "prefix", "word"]
    held: pa.Table | None = None  # sums of the part that may go on

    def summed(t: pa.Table) -> pa.Table:
        t = t.group_by(["part", *by], use_threads=False).aggregate([("count", "sum")])
        return t.rename_columns(["part", *by, "count"])

    def emit(t: pa.Table) -> Iterator[pa.RecordBatch]:
        if not t.num_rows:
            return
        t = t.take(pc.sort_indices(t, [("lang", "ascending"), ("prefix", "ascending")])).combine_chunks()
        lang, prefix, count = t["lang"].combine_chunks(), t["prefix"].combine_chunks(), np.asarray(t["count"])
        change = np.asarray(pc.or_(pc.not_equal(lang[1:], lang[:-1]), pc.not_equal(prefix[1:], prefix[:-1])))
        first = np.flatnonzero(np.append(True, change))
        enough = count >= min_count
        kept = np.add.reduceat(enough, first, dtype=np.int64)
        shown = np.flatnonzero((kept > 0) | np.asarray(pc.equal(prefix.take(pa.array(first)), "")))
        offset = pa.array(np.append(0, np.cumsum(kept[shown])).astype(np.int32))  # those left out have no entry
        at = pa.array(first[shown])
        yield pa.RecordBatch.from_arrays(
            [lang.take(at), prefix.take(at), pa.array(np.add.reduceat(count, first)[shown]),
             pa.ListArray.from_arrays(offset, t["word"].combine_chunks().filter(pa.array(enough))),
             pa.ListArray.from_arrays(offset, pa.array(count[enough]))],
            ["lang", "prefix", "total", "words", "counts"])

    for batch in (some for whole in batches for some in by_entries(whole)):
        words = pc.split_pattern(batch.column("words").flatten(), " ")  # a list for each stripe
        stripe = pc.list_parent_indices(words)
        row = pc.list_parent_indices(batch.column("words")).take(stripe)
        t = pa.table({"part": batch.column("part").take(row), "lang": batch.column("lang").flatten().take(stripe),
                      "prefix": batch.column("prefix").flatten().take(stripe), "word": words.flatten(),
                      "count": batch.column("counts").flatten().cast(pa.int64())})
        t = summed(t if held is None else pa.concat_tables([held, t]))
        on = pc.equal(t["part"], batch.column("part")[-1])
        held = t.filter(on)
        yield from emit(t.filter(pc.invert(on)))
    if held is not None:
        yield from emit(held)


def stripes(texts: DataFrame, size: int, shared: Broadcast, parts: int, min_count: int) -> DataFrame:
    """lang, prefix, total, words, counts: the entries of at least ``min_count``, by segment."""
    bundles = map_batches(texts, lambda batches: counted(batches, size, shared.value, parts), BUNDLE).repartition("part").sortWithinPartitions("part")
    return map_batches(bundles, lambda batches: added(batches, min_count),
                       "lang string, prefix string, total bigint, words array<string>, counts array<bigint>")


def phrase_hash_column(phrases: DataFrame) -> DataFrame:
    """The hash that the tasks know a phrase by."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = string_hashes(batch.column("lang"))
            lists = pc.split_pattern(batch.column("phrase"), " ")
            size = np.asarray(pc.list_value_length(lists), np.int64)
            word = string_hashes(lists.flatten())
            first = np.cumsum(size) - size
            for j in range(int(size.max(initial=0))):
                has = size > j
                h[has] = extended(h[has], word[first[has] + j])
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["h"])

    return map_batches(phrases.select("lang", "phrase"), hashed, "h bigint")


def bitmaps(phrases: DataFrame, count: int, words: int) -> Frequent:
    """The bitmaps of ``phrases``; ``count`` of them, ``words`` words in all texts."""
    bits = min(max(1 << (32 * count - 1).bit_length(), MIN_BITS), MAX_BITS)
    at = F.col("h").bitwiseAND(bits - 1)
    marked = phrase_hash_column(phrases).select((at / PAGE).cast("int").alias("page"), (at % PAGE).alias("bit"))
    pages = stored(marked.groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bitmap")), "bitmaps")
    out = Frequent(bits, np.zeros(bits // 8, np.uint8), np.zeros(min(bits, HOT_BITS) // 8, np.uint8))
    for page, bitmap in pages.toLocalIterator():
        out.found[page * PAGE // 8:(page + 1) * PAGE // 8] = np.frombuffer(bitmap, np.uint8)
    hot = phrase_hash_column(phrases.filter(F.col("a") * HOT > words)).select(F.col("h").bitwiseAND(8 * len(out.hot) - 1))
    for at, in hot.collect():  # under HOT rows
        out.hot[at >> 3] |= 1 << (at & 7)
    return out


def salted(df: DataFrame, by: str) -> DataFrame:
    return df.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(SALTS)))


def every_salt(df: DataFrame) -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))


def longer(striped: DataFrame, shorter: DataFrame, size: int) -> DataFrame:
    """The frequent phrases of ``size`` words with the counts of all their beginnings and endings."""
    begin = shorter.select("lang", F.col("phrase").alias("prefix"), F.concat("heads", F.array("a")).alias("heads"))
    end = every_salt(shorter.select("lang", F.col("phrase").alias("suffix"), F.concat(F.array("a"), "tails").alias("tails")))
    kept = F.substring_index("prefix", " ", -(size - 2))  # the prefix without its first word
    suffix = F.col("word") if size == 2 else F.concat(kept, F.lit(" "), "word")
    entries = (striped.filter(F.size("words") > 0).join(begin.hint("merge"), ["lang", "prefix"])
               .select("lang", "prefix", "heads", F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("counts").alias("a"))))
               .select("lang", F.concat("prefix", F.lit(" "), "word").alias("phrase"), "a", "heads", suffix.alias("suffix")))
    return salted(entries, "phrase").join(end.hint("merge"), ["lang", "suffix", "salt"]).select("lang", "phrase", "suffix", "a", "heads", "tails")


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", max_words: int = MAX_WORDS,
                     min_count: int = MIN_COUNT) -> tuple[DataFrame, list[DataFrame], list[DataFrame | None]]:
    """Totals (lang, n); for each size the frequent phrases (lang, phrase, a, heads, tails); and for each
    size the best extensions (lang, phrase, ext) of its phrases, None where no longer phrase is frequent."""
    texts = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"),
                        F.col(text).cast("binary").alias("text")).filter(F.col("text").isNotNull())
    levels: list[DataFrame] = []
    best: list[DataFrame | None] = []
    frequent = totals = None
    words = 0
    for size in range(1, max_words + 1):
        parts = max(PARTS_LEAST, words // PART_WORDS)
        shared = docs.sparkSession.sparkContext.broadcast(frequent)
        frequent = None
        striped = stored(stripes(texts, size, shared, parts, min_count), f"stripes{size}")
        shared.destroy()
        if size == 1:
            totals = stored(striped.groupBy("lang").agg(F.sum("total").alias("n")), "totals")
            words = totals.agg(F.sum("n")).first()[0] or 0
            none = F.array().cast("array<bigint>")
            found = striped.select("lang", F.inline(F.arrays_zip(F.col("words").alias("phrase"), F.col("counts").alias("a"))))
            found = found.select("lang", "phrase", "a", none.alias("heads"), none.alias("tails"))
        else:
            found = longer(striped, levels[-1], size)
        found = stored(found, f"phrases{size}")
        count = found.count()
        if size > 1:
            if not count:
                best.append(None)
                break
            right = striped.filter(F.size("words") > 0).groupBy("lang", F.col("prefix").alias("phrase")).agg(F.max(F.array_max("counts")).alias("ext"))
            left = found.groupBy("lang", F.col("suffix").alias("phrase")).agg(F.max("a").alias("ext"))
            best.append(right.union(left).groupBy("lang", "phrase").agg(F.max("ext").alias("ext")))
        levels.append(found)
        if size < max_words:
            frequent = bitmaps(found, count, words)
    return totals, levels, [*best, None][:len(levels)]


def lowest_cut() -> Column:
    """The cut (score, k, l, r) with the lowest score, of ties the smallest k; exact up to 38 digits."""
    return F.expr("""array_min(transform(sequence(1, size(heads)), k -> named_struct(
        'score', (cast(1000 as decimal(4,0)) * cast(a as decimal(19,0)) * cast(n as decimal(18,0)))
                 div (cast(heads[k - 1] as decimal(19,0)) * cast(tails[k - 1] as decimal(18,0))),
        'k', k, 'l', heads[k - 1], 'r', tails[k - 1])))""")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", max_words: int = MAX_WORDS,
                 min_count: int = MIN_COUNT, subsumed_percent: int = SUBSUMED_PERCENT, limit: int = LIMIT) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``limit`` phrases of two words or more."""
    totals, levels, best = frequent_phrases(docs, text, lang, max_words, min_count)
    found = None
    for phrases, longest in list(zip(levels, best))[1:]:
        own = phrases.select("lang", "phrase", "a", "heads", "tails")
        if longest is not None:
            own = (own.join(longest.hint("merge"), ["lang", "phrase"], "left")
                   .filter(F.col("ext").isNull() | (100 * F.col("ext") < subsumed_percent * F.col("a"))).drop("ext"))
        found = own if found is None else found.union(own)
    if found is None:
        return docs.sparkSession.createDataFrame([], "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint")
    scored = (salted(found, "phrase").join(every_salt(totals), ["lang", "salt"]).withColumn("cut", lowest_cut())
              .select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.hash("phrase"), F.lit(RANKED_PARTS))
    first = scored.withColumn("part", part).withColumn("_row", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    ranked = first.filter(F.col("_row") <= limit).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    return ranked.filter(F.col("rank") <= limit).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

"""SimHash near-duplicates by a segment-popcount embedding.

Fingerprint: of the lower-cased (A-Z) words' 4-word shingles (repeats included, joined
by one space; fewer words: the whole sequence; none: fingerprint 0), a bit is 1 if set
in over half the shingles' XXH64 (seed 42).

Linking at ``max_bits`` differing bits:

1. Equal fingerprints are one class, so copies never meet each other.
2. Embedding: a fingerprint is cut into 32 segments of two bits; each segment becomes its
   bit count 0..2, written as 00, 01, 11. The Hamming distance of two such codes is the
   Manhattan distance of the count vectors, and that is at most the Hamming distance of
   the fingerprints.
3. Grid range-join: the 32 segments form ``parts`` parts, at least ``max_bits + 2``. A Manhattan
   distance of at most ``max_bits`` leaves ``parts - max_bits`` parts without any difference, so a class is
   dealt to one cell per choice of that many parts (15 pairs of six for four bits); linked classes share a
   cell. The number of parts follows from the number of classes (``parts_for``), so that cells of
   evenly spread fingerprints stay small: 6 up to 16 million, 7 up to 300 million.
4. In a cell, pairs under the Manhattan bound are verified by their exact Hamming distance.
   What leaves a task is a star per linked group within its rows, never all pairs. A
   cell of more than ``block`` classes is split into blocks and each pair of blocks is a
   group of its own, so one hot cell becomes many tasks of bounded size; no pair is lost.
5. Links become components by alternating large-star and small-star joins on tables of
   a few rows per linked class, written to the shared checkpoint folder each round.

Bounded by design: a task holds one group (at most two blocks) and one Arrow batch; the
driver holds two numbers per round.

Defined results: null, empty or wordless text: fingerprint 0, linked like any other. Null
doc_id: takes part, and the component's id is its smallest non-null doc_id. Repeated
rows: same result each. Empty table: empty result. Extra columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.llm.tasks import map_batches
from trendlake.llm.text import stored, text_key

SHINGLE = 4
MAX_BITS = 4
SEED = 42
BLOCK = 4096
SALTS = 16
CELL = 256  # fingerprints expected in a cell
_ODD = 0x5555555555555555


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of UTF-8 text as an unsigned 64-bit number."""
    words = (text or b"").lower().split()  # bytes: A-Z only, and exactly the six ASCII spaces
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-shingle] + 1))
    digest = xxhash.xxh64_intdigest
    n = len(starts)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # bounded memory for very long texts
        spans = zip(starts[at:at + (1 << 16)].tolist(), ends[shingle - 1 + at:shingle - 1 + at + (1 << 16)].tolist())
        h = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, key, fp): fp as a signed long; key tells the texts of equal doc_ids apart."""
    rows = docs.select("doc_id", text_key(F.col(text)).alias("key"), F.col(text).cast("binary").alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column("text")), "<u8", batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(fp.view(np.int64))], ["doc_id", "key", "fp"])

    return map_batches(rows, hashed, f"doc_id {dict(rows.dtypes)['doc_id']}, key bigint, fp bigint")


def embed(fp: Column) -> Column:
    """The 32 two-bit segments' bit counts as unary codes (00, 01, 11) in one long."""
    low, high = fp.bitwiseAND(F.lit(_ODD)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(_ODD))
    return F.shiftleft(low.bitwiseAND(high), 1).bitwiseOR(low.bitwiseOR(high))


def parts_for(n: int, max_bits: int = MAX_BITS) -> int:
    """Number of parts such that ``n`` fingerprints give cells of about ``CELL`` at most: a cell agrees in
    parts - max_bits parts, and a segment's bit count holds 1.5 bits. More parts mean more cells a row."""
    parts = max_bits + 2
    while parts < 4 * max_bits and n / 2.0 ** (48 * (parts - max_bits) / parts) > CELL:
        parts += 1
    return parts


def part_masks(max_bits: int = MAX_BITS, parts: int | None = None) -> list[int]:
    """One bit mask (signed) per choice of parts that must agree."""
    parts = parts or max_bits + 2
    edges = [round(i * 32 / parts) for i in range(parts + 1)]
    single = [sum(3 << (2 * s) for s in range(a, b)) for a, b in zip(edges, edges[1:])]
    chosen = [sum(c) for c in itertools.combinations(single, parts - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def linked_in_groups(group: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars (member, centre) of the links within each run of equal ``group`` values (sorted)."""
    low, high = fp & np.uint64(_ODD), (fp >> np.uint64(1)) & np.uint64(_ODD)
    code = ((low & high) << np.uint64(1)) | low | high
    root = np.arange(len(fp))
    i, k = np.arange(len(fp)), 0
    found_a, found_b = [], []
    while True:
        k += 1
        i = i[i + k < len(fp)]
        i = i[group[i + k] == group[i]]
        if not len(i):
            break
        near = i[np.bitwise_count(code[i] ^ code[i + k]) <= max_bits]  # Manhattan distance of the counts
        near = near[np.bitwise_count(fp[near] ^ fp[near + k]) <= max_bits]
        found_a.append(near)
        found_b.append(near + k)
        if sum(map(len, found_a)) > 1 << 20:  # keep the links of a dense group small
            _merge(root, np.concatenate(found_a), np.concatenate(found_b))
            found_a, found_b = [], []
    if found_a:
        _merge(root, np.concatenate(found_a), np.concatenate(found_b))
    member = np.flatnonzero(root != np.arange(len(root)))
    return fp[member], fp[root[member]]


def _merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of the linked rows; afterwards root[i] is the smallest row of i's group."""
    while len(a):
        ra, rb = root[a], root[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        differ = low != high
        if not differ.any():
            return
        np.minimum.at(root, high[differ], low[differ])
        while not np.array_equal(root, up := root[root]):
            root[:] = up
        a, b = a[differ], b[differ]


def links(classes: DataFrame, max_bits: int = MAX_BITS, parts: int | None = None, block: int = BLOCK) -> DataFrame:
    """Star links (u, v) that span the components of the distinct fingerprints ``fp``."""
    masks = part_masks(max_bits, parts)
    cells = classes.select("fp", F.posexplode(F.array(*[F.lit(m) for m in masks])).alias("part", "mask")).select(
        "fp", F.xxhash64("part", embed(F.col("fp")).bitwiseAND(F.col("mask"))).alias("cell"))
    hot = cells.groupBy("cell").count().filter(F.col("count") > block).select(
        F.col("cell").alias("_hot"), F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    dealt = cells.join(hot, F.col("cell") == F.col("_hot"), "left")
    own = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("blocks"))
    pairs = F.when(F.col("blocks").isNull(), F.array(F.struct(F.lit(0).cast("bigint").alias("x"), F.lit(0).cast("bigint").alias("y")))) \
        .otherwise(F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("blocks").cast("bigint") - 1),
                               lambda j: F.struct(F.least(own, j).alias("x"), F.greatest(own, j).alias("y"))))
    grouped = dealt.select("fp", "cell", F.inline(pairs)).select("fp", F.xxhash64("cell", "x", "y").alias("g"))
    spark = classes.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    grouped = grouped.repartition(n, "g").sortWithinPartitions("g", "fp")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def star(group, fp):
            u, v = linked_in_groups(group, fp.view(np.uint64), max_bits)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

        held_g = held_fp = np.empty(0, np.int64)
        for batch in batches:
            g = np.concatenate([held_g, batch.column("g").to_numpy(zero_copy_only=False)])
            fp = np.concatenate([held_fp, batch.column("fp").to_numpy(zero_copy_only=False)])
            if not len(g):
                continue
            cut = int(np.searchsorted(g, g[-1]))  # the last group may go on in the next batch
            held_g, held_fp = g[cut:], fp[cut:]
            if cut:
                yield star(g[:cut], fp[:cut])
        if len(held_g):
            yield star(held_g, held_fp)

    return map_batches(grouped, linked, "u bigint, v bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every linked node but the roots: root is the component's smallest node."""
    def settled(e: DataFrame) -> tuple[DataFrame, tuple]:
        e = stored(e.distinct(), "links")
        return e, e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    def with_least(e: DataFrame, least: Column) -> DataFrame:
        """Each (u, v) with ``m`` of its u; a centre's many links are dealt to several tasks by a salt.

        A merge join by hint: Spark's size estimate of the salted side leaves its copies out."""
        m = e.groupBy("u").agg(least.alias("m")).withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        return e.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(m.hint("merge"), ["u", "s"])

    e, state = settled(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    while True:
        both = with_least(e.union(e.select("v", "u")), F.least(F.min("v"), F.col("u")))
        e, _ = settled(both.filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        down = with_least(e, F.min("v"))
        small = down.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e, now = settled(small.union(down.select("u", F.col("m").alias("v"))))
        if now == state:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def near_duplicates(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    parts: int | None = None, block: int = BLOCK) -> DataFrame:
    """(doc_id, key, fp, root, component_id) per row of ``docs``; root: the component's smallest fingerprint
    (component_id is null where all its doc_ids are)."""
    prints = stored(fingerprints(docs, text, shingle), "fingerprints")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    found = components(links(classes.select("fp"), max_bits, parts or parts_for(classes.count(), max_bits), block))
    joined = classes.join(found, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    ids = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = joined.select(F.col("fp").alias("_fp"), "root").join(ids, "root").select("_fp", "root", "component_id")
    return prints.join(labels, F.col("fp") == F.col("_fp")).select("doc_id", "key", "fp", "root", "component_id")


def simhash_components(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """doc_id, fingerprint (16 lower-case hex digits), component_id per row of ``docs``."""
    out = near_duplicates(docs, text, **options)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with one row per component: that of its smallest doc_id (then text key)."""
    found = near_duplicates(docs, text, **options)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "key")).alias("s"))
    # plain equalities, so the join and the removal of repeated rows share one shuffle of the texts
    def row(doc_id: Column, key: Column) -> list[Column]:
        return [F.coalesce(doc_id, F.lit(0)).alias("_d"), doc_id.isNull().alias("_n"), key.alias("_k")]

    named = docs.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(docs.columns)],
                        *row(F.col("doc_id"), text_key(F.col(text))))
    kept = named.join(first.select(*row(F.col("s.doc_id"), F.col("s.key"))), ["_d", "_n", "_k"], "left_semi")
    kept = kept.dropDuplicates(["_d", "_n", "_k"])
    return kept.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)])

"""Packing: order-preserving dynamic programming over document and sentence ends.

Documents, in order of doc_id, form one stream of token ids (each ends with ``end_id``),
which is cut into windows of at most ``size`` tokens. A cut costs the padding its window
needs plus a truncation penalty: none at a document's end, ``SENTENCE`` at a sentence's
end inside a document, ``MIDDLE`` elsewhere (offered only within a stretch of over ``STRIDE``
tokens without an end, every ``STRIDE`` tokens). With positions p and penalty c(p), the
least cost of cutting at p is

    best(p) = c(p) + size - p + min over cuts q in [p - size, p) of (best(q) + q),

a sliding-window minimum, kept in a monotone queue: linear in the number of cuts.

The stream is divided into runs that are packed independently. The texts are range-partitioned
by doc_id (whatever values and type it has; repeats of a row by their place in the input too) and sorted; a partition's rows are cut into runs, each
up to a document's end past ``RUN_TOKENS`` tokens or ``RUN`` documents. Only a run's last
window may be short for want of text. There are no more partitions than the text fills with
about ``RUN_TOKENS`` tokens each, so runs cost well under 1 % of padding. A task holds one run
at a time. One shuffle deals the texts; tokens never move. The pieces (numbers only) are
stored with their partition, and sequences are numbered from 0 by partition and place.

Ids: the byte-level BPE vocabulary file given, by tiktoken's rank file of the same
vocabulary where both exist (equal ids, several times faster), else by tokenizers.
A text that spells a special token goes through tokenizers.

Defined results: null or empty text: the end id alone. Null doc_id: first in
the order. Rows of one doc_id: in the order of their texts' hash. Repeated rows: packed as often as given, one after the other (their pieces differ in
place only). Very long texts span many windows. Empty table: empty result. Extra
columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import itertools
import json
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from trendlake.llm.tasks import map_batches
from trendlake.llm.text import stored

SIZE = 2048
END_ID = 1
SENTENCE = 8
MIDDLE = 16
STRIDE = 32
RUN = 1 << 17  # documents of a run
RUN_TOKENS = 1 << 20
TOKEN_BYTES = 4  # about; for the number of partitions only
_SPACES = re.compile(r" \s")
COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


class Encoder:
    """Token ids of texts, and which ids end a sentence.

    With ranks, a text is encoded by its pieces between spaces, and the ids of a piece are
    remembered (up to ``REMEMBERED`` pieces, then anew). The splitting pattern never joins
    what stands before a space with what follows it, unless the space is followed by more
    white space; such texts are encoded whole.
    """

    REMEMBERED = 200_000

    def __init__(self, vocabulary: str, ranks: str | None, pattern: str | None):
        self.vocabulary, self.fast = vocabulary, None
        self.known: dict[str, bytes] = {}
        with open(vocabulary, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f).get("added_tokens", [])]
        if ranks:
            import tiktoken
            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
            pieces = {i: t for t, i in table.items()}
        else:  # in the byte alphabet of such vocabularies a line feed is U+010A and a space U+0120
            pieces = {i: t.replace("\u010a", "\n").replace("\u0120", " ").encode() for t, i in self.slow.get_vocab().items()}
        self.ends = np.zeros(max(pieces) + 1 + len(self.special), np.bool_)
        self.spaced = self.ends.copy()
        for i, piece in pieces.items():
            self.ends[i] = piece.rstrip(b"\"')")[-1:] in (b".", b"!", b"?", b"\n")
            self.spaced[i] = piece[:1] == b" "

    @functools.cached_property
    def slow(self):
        """The tokenizers' own; loaded only where a text needs it."""
        from tokenizers import Tokenizer
        return Tokenizer.from_file(self.vocabulary)

    def __call__(self, text: str | None) -> np.ndarray:
        text = text or ""
        if self.fast is None or any(s in text for s in self.special):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4")
        if " " not in text or _SPACES.search(text) or text.endswith(" "):
            return np.array(self.fast.encode_ordinary(text), "<u4")
        first, *rest = text.split(" ")
        if len(self.known) > self.REMEMBERED:
            self.known.clear()
        known = self.known
        new = [w for w in dict.fromkeys(rest) if w not in known]
        if new:
            ids = np.array(self.fast.encode_ordinary(" " + " ".join(new)), "<u4")
            at = np.flatnonzero(self.spaced[ids])
            if len(at) != len(new):
                return np.array(self.fast.encode_ordinary(text), "<u4")
            raw, cut = ids.tobytes(), (4 * at).tolist() + [4 * len(ids)]
            known.update(zip(new, map(raw.__getitem__, map(slice, cut, cut[1:]))))
        head = np.array(self.fast.encode_ordinary(first), "<u4").tobytes()
        return np.frombuffer(head + b"".join(map(known.__getitem__, rest)), "<u4")


def candidate_cuts(ends: np.ndarray, n: int | np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
    """Places where a stream may be cut and their penalties; ``ends``: the places behind a sentence, ``n``:
    the places behind a document (increasing), free of charge. The last of these is the stream's end."""
    n = np.atleast_1d(n)
    at = np.union1d(ends[(ends > 0) & (ends < n[-1])], n).astype(np.int64)
    before = np.concatenate(([0], at[:-1]))
    more = (at - before - 1) // stride  # places within the stretch before each end
    first = np.cumsum(more + 1) - (more + 1)
    step = np.arange(len(at) + more.sum()) - np.repeat(first, more + 1) + 1
    last = step > np.repeat(more, more + 1)
    places = np.where(last, np.repeat(at, more + 1), np.repeat(before, more + 1) + step * stride)
    cost = np.full(len(places), MIDDLE)
    cost[last] = np.where(np.isin(at, n), 0, SENTENCE)
    return places, cost


def best_cuts(places: list[int], cost: list[int], size: int = SIZE) -> list[int]:
    """The places of the cheapest cutting of [0, places[-1]] (increasing, last included); of equally
    cheap windows the longest. Consecutive places lie at most ``size`` apart."""
    at, least, came = [0, *places], [0] * (len(places) + 1), [0] * (len(places) + 1)  # least: best + place
    queue: deque[int] = deque([0])  # numbers of places, least increasing
    for k, (p, c) in enumerate(zip(places, cost), 1):
        while at[queue[0]] < p - size:
            queue.popleft()
        came[k] = queue[0]
        value = least[k] = least[queue[0]] + size + c
        while queue and least[queue[-1]] > value:
            queue.pop()
        queue.append(k)
    out, k = [], len(at) - 1
    while k:
        out.append(at[k])
        k = came[k]
    return out[::-1]


def pack_run(docs: list[tuple[object, np.ndarray]], ends: np.ndarray, first_sequence: int,
             size: int = SIZE) -> Iterator[tuple]:
    """The pieces (COLUMNS) of a run of (doc_id, ids), windows numbered from ``first_sequence``."""
    behind = np.concatenate([ends[ids] for _, ids in docs]).nonzero()[0] + 1
    places, cost = candidate_cuts(behind, np.cumsum([len(ids) for _, ids in docs]), min(STRIDE, size))
    cuts = best_cuts(places.tolist(), cost.tolist(), size)
    at, window, begin = 0, 0, 0  # place in the run, number and place of the window
    for doc_id, ids in docs:
        start = 0
        while start < len(ids):
            if at == cuts[window]:
                window, begin = window + 1, at
            n = min(len(ids) - start, cuts[window] - at)
            yield (doc_id, start, n, zlib.crc32(ids[start:start + n].tobytes()), len(ids),
                   first_sequence + window, at - begin)
            start, at = start + n, at + n


def pack_documents(docs: DataFrame, vocabulary: str, ranks: str | None = None, pattern: str | None = None,
                   text: str = "text", size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    rows = docs.select("doc_id", F.col(text).alias("text"))
    total = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).first()
    n = (total["rows"] + (total["bytes"] or 0) // TOKEN_BYTES) // RUN_TOKENS
    n = max(1, min(n, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    # the row number divides the repeats of one row among partitions
    rows = rows.withColumns({"h": F.xxhash64("text"), "copy": F.monotonically_increasing_id()})
    rows = rows.repartitionByRange(n, "doc_id", "h", "copy").sortWithinPartitions("doc_id", "h")
    rows = rows.select("doc_id", "text", F.spark_partition_id().alias("part"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(vocabulary, ranks, pattern)
        held: list[tuple[object, np.ndarray]] = []
        tokens, part, number = 0, 0, 0  # number: of the next sequence, in its partition from 0

        def flush() -> pa.RecordBatch:
            cols = list(zip(*pack_run(held, encode.ends, number, size)))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], kind), *[pa.array(c, pa.int64()) for c in cols[1:]],
                                               pa.array([part] * len(cols[0]), pa.int32())], [*COLUMNS, "part"])

        for batch in batches:
            for doc_id, words, part in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "part"))):
                ids = np.append(encode(words), np.uint32(end_id)).astype("<u4")
                held.append((doc_id, ids))
                tokens += len(ids)
                if tokens >= RUN_TOKENS or len(held) >= RUN:
                    out = flush()
                    yield out
                    number = out.column("sequence_id")[-1].as_py() + 1
                    held, tokens = [], 0
        if held:
            yield flush()

    kind = to_arrow_type(rows.schema["doc_id"].dataType)
    pieces = stored(map_batches(rows, pack, f"doc_id {dict(rows.dtypes)['doc_id']}, "
                                + ", ".join(f"{c} bigint" for c in COLUMNS[1:]) + ", part int"), "pieces")
    counts = sorted(map(tuple, pieces.groupBy("part").agg(F.max("sequence_id") + 1).collect()))
    ends = list(itertools.accumulate((c for _, c in counts), initial=0))
    firsts = docs.sparkSession.createDataFrame([(part, first) for (part, _), first in zip(counts, ends)], "part int, first bigint")
    # one row per partition
    return pieces.join(F.broadcast(firsts), "part").select(
        *[(F.col(c) + F.col("first")).alias(c) if c == "sequence_id" else c for c in COLUMNS])

"""Token counts: count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton enumerates the vocabulary pieces that end at each character of
a text; dynamic programming carries the best score and the piece count of the best
segmentation, nothing else. Rules of the unigram tokenizers:

- spaces become U+2581, and one is put before the text;
- a character that is no piece by itself may stand as unknown at the least piece score
  minus 10; ``unknown="bytes"`` counts its UTF-8 bytes (byte fallback), ``"run"`` counts
  a run of unknown characters as one token;
- of equally good segmentations up to a character, the one whose last piece begins first
  stays (pieces come longest first, and only a strictly better one replaces).

A text is cut before each U+2581 that follows another character; where no piece has one
inside, no piece crosses such a cut, so the parts' counts and scores add up (other
vocabularies run on whole texts). Parts are remembered up to
``REMEMBERED``, then anew, so memory is bounded.

Plan: a map over Arrow batches, no shuffle. Defined results: null: null count and score;
empty text: the dummy prefix alone is dropped, count 0 and score 0. Repeated rows: same
result each. Very long texts are read whole. Empty table: empty result. Extra columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.llm.tasks import map_batches

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED = 300_000


def sentencepiece_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a sentencepiece model's ordinary pieces."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]


class Counter:
    """(count, score) of texts under a vocabulary."""

    def __init__(self, vocabulary: list[tuple[str, float]], unknown: str = "bytes", remembered: int = REMEMBERED):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), float(score)))
        self.automaton.make_automaton()
        self.worst = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.run = {"bytes": False, "run": True}[unknown]
        # a run of unknown characters could cross a cut only where the space is unknown too
        self.whole = (any(SPACE in piece.lstrip(SPACE) for piece, _ in vocabulary)
                      or self.run and SPACE not in {piece for piece, _ in vocabulary})
        self.known: dict[str, tuple[int, float]] = {}
        self.remembered = remembered

    def viterbi(self, part: str) -> tuple[int, float]:
        n = len(part)
        best: list[float | None] = [None] * (n + 1)
        count = [0] * (n + 1)
        unknown = [False] * (n + 1)
        best[0] = 0.0
        single = [False] * n

        def settle(e: int) -> None:  # the unknown character as last candidate for place e
            if single[e - 1]:
                return
            score = best[e - 1] + self.worst
            if best[e] is None or score > best[e]:
                best[e], unknown[e] = score, True
                count[e] = count[e - 1] + (not unknown[e - 1] if self.run else
                                           len(part[e - 1].encode("utf-8", "surrogatepass")))

        done = 0
        for end, (size, score) in self.automaton.iter(part):
            e = end + 1
            while done < end:
                done += 1
                settle(done)
            if size == 1:
                single[end] = True
            score += best[e - size]
            if best[e] is None or score > best[e]:
                best[e], count[e], unknown[e] = score, count[e - size] + 1, False
        while done < n:
            done += 1
            settle(done)
        return int(count[n]), best[n]

    def __call__(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        if self.whole:
            return self.viterbi(SPACE + text.replace(" ", SPACE))
        if "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
            parts = re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + text.replace(" ", SPACE))
        else:
            parts = [SPACE + w for w in text.split(" ")]
        if len(self.known) > self.remembered:
            self.known.clear()
        known = self.known
        for p in parts:
            if p not in known:
                known[p] = self.viterbi(p)
        counts, scores = zip(*map(known.__getitem__, parts))
        return sum(counts), sum(scores)


def count_tokens(docs: DataFrame, vocabulary: list[tuple[str, float]], key: str = "doc_id", text: str = "text",
                 unknown: str = "bytes") -> DataFrame:
    """key, n_tokens, score (of the best segmentation) per row of ``docs``."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary, unknown)
        for batch in batches:
            found = [(None, None) if t is None else counter(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array([c for c, _ in found], pa.int64()),
                 pa.array([s for _, s in found], pa.float64())], ["key", "n_tokens", "score"])

    out = map_batches(rows, count, f"key {dict(rows.dtypes)['key']}, n_tokens bigint, score double")
    return out.withColumnRenamed("key", key)

"""Chat formatting: multi-party perspective rotation.

For every participant of a conversation the dialogue is rendered with that speaker as the
assistant and all others as named users; a mask marks the characters to learn from (the
assistant's texts and their end marks). System turns are context in every rendering and
no participant. A speaker is the role of a turn (or any column named by ``speaker``).

Turns are ordered by turn number and named by their place from 0, so sparse, negative or
timestamp numbers render as dense ones do. A conversation is one rendering per participant, up to
``part`` turns; a longer one gives a row for every ``part`` successive places, so no task ever
gathers more. ``first_turn`` is the place of a part's first turn; each later part opens with the
conversation's first system turn, and its mask counts from the part's own start.

Texts and names can't forge the format's marks: "<", any backslashes and "|" get one backslash
more before the "|" (taking one away restores the text); names also have "|>" treated so and
line ends spelled as \\n and \\r.

Plan: Spark expressions only. Repeated turns are dropped by a distinct aggregation over the
whole row and stored once; conversations above ``part`` turns are found with partial aggregation. Only their turns
are numbered: range-partitioned by (conversation, turn, hash) and stored, numbered within each
(partition, conversation) and shifted by the counts of the partitions before, so a hot conversation is spread. Each
part is collected and rendered within its row. The join of parts and participants is on the
conversation (its output, one row per part and participant, is the result itself).

Defined results: null conv_id: one conversation of its own. Null speaker: named "unknown".
Null text: empty. Null turn: before all others. Equal turn numbers: ordered by a hash of
speaker and text, then by these. Repeated rows: one turn. Only system turns: no participant, no row.
Empty table: empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlake.llm.text import stored

PART = 1024
SYSTEM = "system"
END = "<|end|>\n"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def escaped_name(name: Column) -> Column:
    flat = F.replace(F.replace(escaped(name), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))
    return F.regexp_replace(flat, r"\|(\\*)>", r"|\\$1>")


def opening(speaker: Column, me: Column) -> Column:
    return (F.when(speaker == SYSTEM, F.lit("<|system|>\n")).when(speaker == me, F.lit("<|assistant|>\n"))
            .otherwise(F.concat(F.lit("<|user name="), escaped_name(speaker), F.lit("|>\n"))))


def turns(conversations: DataFrame, speaker: str = "role") -> DataFrame:
    """Distinct turns: conv_id, turn, h, speaker, text."""
    d = conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"),
                             F.coalesce(F.col(speaker), F.lit("unknown")).alias("speaker"),
                             F.coalesce("text", F.lit("")).alias("text")).distinct()
    return d.withColumn("h", F.xxhash64("speaker", "text"))


def numbered(d: DataFrame) -> DataFrame:
    """``d`` with ``place``, the turns of a conversation numbered from 0."""
    d = stored(d.repartitionByRange("conv_id", "turn", "h", "speaker").withColumn("_pid", F.spark_partition_id()), "ranges")
    counts = d.groupBy("conv_id", "_pid").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(F.col("conv_id").alias("_c"), F.col("_pid").alias("_p"),
                          F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy("conv_id", "_pid").orderBy("turn", "h", "speaker", "text")
    d = d.withColumn("_own", F.row_number().over(own) - 1)
    j = d.join(shift, d["conv_id"].eqNullSafe(shift["_c"]) & (d["_pid"] == shift["_p"]))
    return j.withColumn("place", F.col("_own") + F.col("_before")).drop("_own", "_before", "_pid", "_c", "_p")


def parted(d: DataFrame, part: int = PART) -> DataFrame:
    """conv_id, part, first_turn, t (its turns in order) of the stored turns ``d``."""
    sizes = d.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > part)
    long = stored(sizes.select(F.col("conv_id").alias("_long")), "long_conversations")
    same = d["conv_id"].eqNullSafe(long["_long"])
    turn = F.struct("turn", "h", "speaker", "text")
    whole = d.join(long, same, "left_anti").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t")).select(
        "conv_id", F.lit(0).cast("bigint").alias("part"), F.lit(0).cast("bigint").alias("first_turn"), "t")
    cut = stored(numbered(d.join(long, same, "left_semi")).withColumn("part", F.floor(F.col("place") / part)), "places")
    system = cut.filter(F.col("speaker") == SYSTEM).groupBy(F.col("conv_id").alias("_sc")).agg(
        F.min(turn).alias("_system"))
    pieces = cut.groupBy("conv_id", "part").agg(F.min("place").alias("first_turn"), F.sort_array(F.collect_list(turn)).alias("t"))
    j = pieces.join(system, pieces["conv_id"].eqNullSafe(system["_sc"]), "left")
    # where the first system turn stands in this part or a later one, nothing is repeated
    again = F.col("_system").isNotNull() & (F.col("_system") < F.get("t", F.lit(0)))
    return whole.unionByName(j.select("conv_id", "part", "first_turn", F.when(
        again, F.concat(F.array("_system"), F.col("t"))).otherwise(F.col("t")).alias("t")))


def render(parts: DataFrame) -> DataFrame:
    """Adds ``rendered`` and ``spans`` (its character ranges to learn from) to rows with ``t`` (sorted turns)
    and ``perspective`` (the speaker who is the assistant)."""
    pieces = F.transform("t", lambda x: F.struct(
        opening(x["speaker"], F.col("perspective")).alias("head"), F.concat(escaped(x["text"]), F.lit(END)).alias("body"),
        ((x["speaker"] == F.col("perspective")) & (x["speaker"] != SYSTEM)).alias("own")))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<a:bigint,b:bigint>>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        a = s["at"] + F.length(x["head"])
        b = a + F.length(x["body"])
        span = F.array(F.struct(a.alias("a"), b.alias("b")))
        return F.struct(b.alias("at"), F.when(x["own"], F.concat(s["out"], span)).otherwise(s["out"]).alias("out"))

    return parts.withColumn("_p", pieces).withColumns({
        "rendered": F.array_join(F.transform("_p", lambda x: F.concat(x["head"], x["body"])), ""),
        "spans": F.aggregate("_p", start, step, lambda s: s["out"])}).drop("_p")


def rotate(conversations: DataFrame, speaker: str = "role", part: int = PART) -> DataFrame:
    """conv_id, perspective, part, first_turn, n_turns, n_own, rendered, mask ("from:to" ranges), mask_chars."""
    d = stored(turns(conversations, speaker), "turns")
    parts = parted(d, part)
    people = d.filter(F.col("speaker") != SYSTEM).select(F.col("conv_id").alias("_conv"), F.col("speaker").alias("perspective")).distinct()
    out = render(parts.join(people, parts["conv_id"].eqNullSafe(people["_conv"])))
    return out.select("conv_id", "perspective", "part", "first_turn", F.size("t").cast("bigint").alias("n_turns"),
                      F.size("spans").cast("bigint").alias("n_own"), "rendered",
                      F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["a"], s["b"])), ",").alias("mask"),
                      F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["b"] - s["a"]).alias("mask_chars"))

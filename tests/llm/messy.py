"""A small table of documents with every awkward case, and clashing extra columns."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())]
                      + [T.StructField(n, T.LongType()) for n in
                         ("key", "fp", "h", "_id", "_key", "removed", "kept", "block", "score", "label", "_c0", "_t",
                          "component_id", "n_words", "g", "_b", "_text", "_k")])


def vocabulary(seed=0, n=400):
    r = random.Random(seed)
    return ["".join(r.choices("abcdefghijklmnopqrstuvwxyzéü", k=r.randint(2, 9))) for _ in range(n)]


def texts(seed=0, n=60):
    r = random.Random(seed)
    voc = vocabulary(seed)
    out = [None, "", "  \n\t ", "one", "Two Words", "a b c d", "x\x00y   İstanbul K 字 😀 \xa0 end", "\n\n\n",
           "MIT License", "the apache LICENSE, version 2.0; General  Public\nLicense", "aaaa " * 50, "same line\n" * 30]
    footer = "Shared footer line number 7"
    for i in range(n):
        lines = [" ".join(r.choices(voc, k=r.randint(3, 25))) for _ in range(r.randint(1, 6))]
        if i % 2:
            lines.append(footer)
        out.append(".\n".join(lines))
    base = out[-1]
    out += [base, base, base.upper(), base + " tail"]  # copies and near copies
    out.append(" ".join(r.choices(voc, k=30_000)))  # a very long one
    return out


def rows(seed=0):
    found = [(i, t, "en" if i % 3 else None, f"s{i % 3}" if i % 5 else None, None if t is None or i % 4 else len(t))
             for i, t in enumerate(texts(seed))]
    found += [(None, "a text without id " * 6, "en", "s1", 3), found[20], found[20], found[0]]
    return [r + tuple(range(len(SCHEMA) - 5)) for r in found]


def frame(spark, seed=0):
    return spark.createDataFrame(rows(seed), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)

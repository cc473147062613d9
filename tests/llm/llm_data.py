"""Small tables with every awkward case, and a collector."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, kept string, shard string, mark string, `a.b` string"


def awkward_texts() -> list[str | None]:
    draw = random.Random(5)
    words = [w.strip() for w in "the of and tion anble rethe ónde süß éaux 12 x' #a* | !! Thon".split()]
    prose = [" ".join(draw.choice(words) for _ in range(draw.randint(1, 120))) for _ in range(30)]
    long = " ".join(draw.choice(words) + str(draw.randint(0, 99)) for _ in range(4000))
    shared = " ".join(draw.choice(words) + str(draw.randint(0, 999)) for _ in range(90))
    return [None, "", " ", "\n\n\t", "a", "<|endoftext|>x<|startoftext|>", "日本 ΑΣ İ 🎉 é", "z" * 3000, "ab " * 700,
            long, long, long + " tail", shared + "\n" + prose[0], prose[1] + "\n" + shared, shared, *prose, prose[3],
            prose[3], prose[4] + " end"]


def awkward(spark, repeats: bool = True):
    """Documents with null and empty texts, long ones, copies, repeated rows, a null identifier and extra columns."""
    rows = [(k * 7 + 1, text, "k", None, "m", "dot") for k, text in enumerate(awkward_texts())]
    if repeats:
        rows += [rows[20], (None, "one without identifier", None, None, None, None), (None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(frame) -> list[dict]:
    return [row.asDict(recursive=True) for row in frame.collect()]

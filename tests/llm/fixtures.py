"""Documents that hold every awkward case, beside real ones of the smallest data."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def sample(spark: SparkSession, n: int = 120) -> list[tuple[int, str]]:
    rows = spark.read.parquet(f"{DATA}/documents.parquet").where(f"doc_id < {n}").select("doc_id", "text").collect()
    return [(r.doc_id, r.text) for r in rows]


def made(seed: int = 7) -> list[tuple[int, str | None]]:
    """Missing, empty and very long texts, copies, near copies, shared passages, odd white space and characters."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    base, passage = say(120), say(60)
    texts: list[str | None] = [None, "", "   \n\t ", "one", "two words", " ".join(base), " ".join(base), "  ".join(base), " ".join(base).upper()]
    for k in range(1, 9):
        near = list(base)
        for _ in range(k):
            near[rng.randrange(len(near))] = "new%d" % rng.randrange(1000)
        texts.append(" ".join(near))
    texts += [" ".join(say(50) + passage + say(40)) for _ in range(4)]
    texts += [" ".join(["ab", "cd"] * 100), " ".join(["same"] * 300), " ".join(say(6000)), "x" * 50_000, "  a b \U0001f600 Z\r\nQ\x0bR\x1cS"]
    texts += ["\n".join(["Line one of the text", "Line one of the text", "Line onne of the text", "", "short", "shart", "L2"]), "Line two of the text\nLine ome of the text"]
    texts += ["Released under the MIT License.", "GNU General Public License, version 3 and CC BY-NC 4.0; Apache License, Version 2.0", "apache licensee mit  LICENSE mit-license éMIT License"]
    return [(1000 + i, t) for i, t in enumerate(texts)]


def frame(spark: SparkSession, docs) -> DataFrame:
    return spark.createDataFrame([(d, t, None, "src", None) for d, t in docs], SCHEMA).repartition(5)


def clashing(df: DataFrame) -> DataFrame:
    """Extra columns with names the operators use themselves."""
    from pyspark.sql import functions as F

    names = ("row", "n", "id", "kept", "bucket", "component_id", "__row", "key", "a", "b", "start", "label", "hash", "size", "words")
    return df.withColumns({name: F.lit("x") for name in names})

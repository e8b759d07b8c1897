"""Odd inputs that every operator must take: nulls, empty and long texts, repeated rows, clashing names."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma".split()


def prose(seed: int, words: int) -> str:
    """Repeatable text without long repeats."""
    state, out = seed * 7919 + 13, []
    for k in range(words):
        state = (state * 6364136223846793005 + 1442695040888963407) % 2**64
        out.append(WORDS[(state >> 33) % len(WORDS)] + str((state >> 40) % 97))
        if k % 17 == 16:
            out[-1] += "."
        if k % 60 == 59:
            out[-1] += "\n"
    return " ".join(out).replace("\n ", "\n")


ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "two words"),
    (6, prose(6, 300)),
    (7, prose(6, 300)),  # an exact copy
    (7, prose(6, 300)),  # a row listed twice
    (8, prose(8, 120)),
    (8, prose(9, 120)),  # one doc_id, two texts
    (None, prose(10, 100)),
    (None, prose(10, 100)),
    (11, "é" * 500 + "漢字" * 100 + "🙂"),
    (12, prose(12, 30_000)),
    (13, "\x00 nul \x85   separators"),
    (2**62, prose(13, 50)),
    (-5, prose(14, 50)),
]

CLASHING = ("key", "block", "t", "label", "hub", "score", "numbers", "row", "rest", "added", "n", "tie", "batch", "kept")


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows (doc_id, text) with the columns of documents, and more whose names operators use inside."""
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    frame = frame.select("doc_id", "text", F.lit(None).cast("string").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    return frame.withColumns({c: F.lit(f"own {c}") for c in CLASHING})


def odd(spark: SparkSession) -> DataFrame:
    return documents(spark, ODD)


def empty(spark: SparkSession) -> DataFrame:
    return documents(spark, ODD).limit(0)

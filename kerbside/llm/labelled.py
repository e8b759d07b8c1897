"""What the two text classifiers share: labelled rows of bounded number, and calibration.

A model is fitted on at most about `FIT_ROWS` labelled rows, chosen by a hash of their doc_id, so
fitting costs the same at any size; scoring reads every row. Every fifth of them is kept from the fit
and calibrates the scores.
"""

from __future__ import annotations

from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import cut, id_text, near

FIT_ROWS = 20_000


def sample(documents: DataFrame, labels: DataFrame, label_col: str, rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, label, calibrates, text) of labelled rows. Labels other than 0 and 1 are left out; of
    several labels of a document the largest counts."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("label"))
    known = cut(known.filter("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label")))
    total = known.count()
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    if total > rows:
        known = known.filter(place < 1_000_000 * rows // total)
    known = known.withColumn("calibrates", F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(5)) == 0)
    return id_text(documents).join(near(cut(known), 2 * rows), "doc_id").select("doc_id", "label", "calibrates", "text")




def calibration(scored: DataFrame) -> IsotonicRegressionModel:
    """From (raw, label): the share of label 1 at each raw value, never falling, in column `share`."""
    return IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="share").fit(scored.select("raw", "label"))

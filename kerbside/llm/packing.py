"""Packing documents into padded batches: optimal length buckets and token budgets.

All lengths are gathered to one histogram, and dynamic programming over it chooses the bucket bounds
with the least padding in total. Inside a bucket documents follow each other by doc_id and fill batches
of as many as fit the token budget when each is padded to the bucket's bound. Lengths are words, any
column, or with a tokenizer's file the exact number of its tokens.

Lengths up to `EXACT` are entries of the histogram by themselves, longer ones share an entry where six
leading bits are equal, so it has at most a few thousand entries, whatever the texts are. An entry has the
number, the sum and the longest of its lengths: the padding of a split is exact, and only splits inside
an entry are left out. The bound of a bucket is its longest length.

Results: null and empty texts have length 0 and are packed as documents of bound 0 or more. A document
longer than the budget is a batch of its own. Rows without doc_id come last in their bucket; rows that
share a doc_id follow each other by length, then by a hash of the text.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm import bpe
from kerbside.llm.common import cut, near, text_column

BUCKETS = 16
BUDGET = 32_768
EXACT = 1024
#: Rows of a range that is numbered by itself, on average, and ranges up to which their sizes are broadcast.
RANGE_ROWS = 65_536
RANGES = 1_000_000


def word_count(text_col: str = "text") -> Column:
    """Words, the length of `pack` unless it is given another: runs of anything but ASCII white space."""
    return F.regexp_count(text_column(text_col), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def rounded(length: Column) -> Column:
    """The entry of a length: itself, or beyond `EXACT` rounded up to six bits behind the leading one."""
    octave = F.floor(F.log2(F.greatest(length.cast("double"), F.lit(float(EXACT))) / EXACT))
    step = (F.lit(EXACT / 64.0) * F.pow(F.lit(2.0), octave)).cast("long")
    return F.when(length <= EXACT, length).otherwise(F.floor((length + step - 1) / step).cast("long") * step)


def bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int, sums: np.ndarray | None = None) -> list[int]:
    """The upper bounds of at most `buckets` buckets with the least padding, exactly. Entries have a longest
    length, a count, and a sum of lengths if these are not all equal.

    With the entries in order, a bucket is a run of them and pads each to its last one.
    """
    order = np.argsort(lengths)
    length, count = lengths[order].astype(np.float64), counts[order].astype(np.float64)
    n = len(length)
    if n <= buckets:
        return [int(x) for x in length]
    rows = np.concatenate([[0.0], np.cumsum(count)])
    tokens = np.concatenate([[0.0], np.cumsum(count * length if sums is None else sums[order].astype(np.float64))])
    best = np.full(n + 1, np.inf)
    best[0] = 0.0
    cuts = []
    for _ in range(buckets):
        ahead, cut_at = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        ahead[0] = 0.0
        for j in range(1, n + 1):
            cost = best[:j] + length[j - 1] * (rows[j] - rows[:j]) - (tokens[j] - tokens[:j])
            cut_at[j] = int(np.argmin(cost))
            ahead[j] = cost[cut_at[j]]
        best = ahead
        cuts.append(cut_at)
    found, j = [], n
    for cut_at in reversed(cuts):
        if j:
            found.append(int(length[j - 1]))
            j = int(cut_at[j])
    return found[::-1]


def pack(documents: DataFrame, length: Column | None = None, buckets: int = BUCKETS, budget: int = BUDGET, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, bucket, bucket_length, batch, slot) of every row; batches are numbered from 0 in
    each bucket, slots from 0 in each batch. `tokenizer` is a JSON file on every executor."""
    spark = documents.sparkSession
    if length is not None and tokenizer is not None:
        raise ValueError("either a length or a tokenizer")
    key, tie = F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_column(text_col)).alias("tie")
    if tokenizer is not None:
        rows = cut(bpe.sizes(documents.select(key, tie, text_column(text_col).alias("text")), tokenizer))
    else:
        tokens = word_count(text_col) if length is None else F.coalesce(length.cast("long"), F.lit(0))
        rows = cut(documents.select(key, tokens.alias("n_tokens"), tie))
    entry = [F.count("*").alias("n"), F.max("n_tokens").alias("longest"), F.sum("n_tokens").alias("tokens")]
    histogram = rows.groupBy(rounded(F.col("n_tokens")).alias("entry")).agg(*entry).collect()  # a few thousand rows at most
    lengths, counts, sums = (np.array([r[c] for r in histogram], np.int64) for c in ("longest", "n", "tokens"))
    ends = bounds(lengths, counts, buckets, sums) or [0]

    fits = F.filter(F.lit(ends).cast("array<long>"), lambda end: end >= F.col("n_tokens"))
    placed = rows.withColumn("bucket_length", fits[0]).withColumn("bucket", (F.lit(len(ends)) - F.size(fits)).cast("int"))
    placed = placed.withColumn("key", F.coalesce("doc_id", F.lit((1 << 63) - 1)))
    # A row's place is its range, in the upper bits, and its position there; its number in the bucket is its
    # distance from the bucket's first place in the range, and the rows of the bucket in ranges before.
    order = ["bucket", "key", "n_tokens", "tie"]
    ranges = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(counts.sum()) // RANGE_ROWS))
    ranged = placed.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    ranged = cut(ranged.withColumn("range", F.shiftright("place", 33)))
    sizes = ranged.groupBy("bucket", "range").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before = F.sum("n").over(Window.partitionBy("bucket").orderBy("range")) - F.col("n")
    shifts = near(cut(sizes.select("bucket", "range", (before - F.col("first")).alias("shift"))), RANGES)
    number = F.col("place") + F.col("shift")
    room = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(budget) / F.greatest("bucket_length", F.lit(1).cast("long"))))
    return ranged.join(shifts, ["bucket", "range"]).select(
        "doc_id", "n_tokens", "bucket", "bucket_length", F.floor(number / room).cast("long").alias("batch"), (number % room).cast("int").alias("slot")
    )

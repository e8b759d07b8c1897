"""Importance resampling of documents towards a target text, on hashed word features.

Features are runs of 1 to `longest` words; a feature's bucket is the CRC-32 of its UTF-8 bytes modulo
the number of buckets. A bucket's gain is the log ratio of its smoothed shares in the target and in the
documents; a document's weight is the mean gain of its features, and Gumbel noise drawn from a hash of
its doc_id turns the largest scores into a draw without replacement.

The vocabulary has a head and a tail. The head, frequent words and frequent pairs, is found in one scan
with bounded memory: each task keeps the features whose share in it may reach `SHARE` (lossy counting),
so a feature with that share of all rows is kept by one task at least. Its exact CRC states go to every
executor, at most `HEAD` of them of at most `LONGEST` bytes each. All other features take their CRC
directly, a longer one from the state of its beginning. The head only saves work: both feed the same
exact bucket totals. Each task adds up its buckets, so a word that fills a third of the rows leaves it as
one number. Ranks come from ranges of the scores, sorted apart and shifted by the rows before them.

Results: a null text has no features. Rows without doc_id draw their noise from the empty id; rows that
share a doc_id are scored and ranked one by one, equal ones in any order. Without documents, or with
too few of `least_words`, nothing is drawn; an empty target has all its totals at zero.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import cut, id_text, lowered, near, slices, utf8, words

BUCKETS = 10_000
#: Share of the features of a task from which one is sent as part of the head.
SHARE = 1e-5
HEAD = 1 << 16
LONGEST = 64
#: Partitions up to which their sizes are sent to all executors.
PARTITIONS = 1_000_000

_BREAKS = np.ones(256, bool)
_BREAKS[0x30:0x3A] = False  # 0-9
_BREAKS[0x61:0x7B] = False  # a-z
_BREAKS[0x80:] = False  # all but ASCII


def _words(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
    """The words of a batch in order, lower-cased, and their rows."""
    buffer, offsets = utf8(batch.column("text"))
    buffer = lowered(buffer)
    start, end, row = words(buffer, offsets, _BREAKS)
    at = np.concatenate([[0], np.cumsum(end - start)])
    solid = buffer[~_BREAKS[buffer]]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(at), pa.py_buffer(solid)]), row


def _levels(batch: pa.RecordBatch, longest: int) -> Iterator[tuple[int, list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each length: the distinct features, of each its beginning and last word (positions among the
    distinct features of the length before and among the distinct words), of each occurrence its
    feature and row."""
    found, row = _words(batch)
    encoded = found.dictionary_encode()
    single, last = encoded.dictionary.to_pylist(), encoded.indices.to_numpy().astype(np.int64)
    texts, code, owner = single, last, row
    yield 1, texts, np.zeros(0, np.int64), np.arange(len(texts)), code, owner
    for length in range(2, longest + 1):
        inside = np.flatnonzero(row[length - 1 :] == row[: len(row) - length + 1]) if len(row) >= length else np.zeros(0, np.int64)
        place = np.full(len(row), -1, np.int64)
        place[starts if length > 2 else np.arange(len(row))] = code
        joined, code = np.unique(place[inside] * max(len(single), 1) + last[inside + length - 1], return_inverse=True)
        begin, end = np.divmod(joined, max(len(single), 1))
        texts = [texts[a] + b" " + single[b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
        starts = inside
        yield length, texts, begin, end, code, row[inside]


def head(documents: DataFrame, longest: int = 1, share: float = SHARE, most: int = HEAD) -> dict[bytes, int]:
    """CRC states of the most frequent words, and pairs if there are such features.

    A task drops a feature once its count, with what may have been dropped before, is no more than
    `share` of what the task has read: it holds few times 1 / share of them, however long it runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bound: dict[bytes, int] = {}
        seen = 0
        for batch in slices(batches):
            before = int(share * seen)
            for _, texts, _, _, code, _ in _levels(batch, min(longest, 2)):
                seen += len(code)
                for text, n in zip(texts, np.bincount(code, minlength=len(texts)).tolist(), strict=True):
                    if len(text) <= LONGEST:
                        bound[text] = bound.get(text, before) + n
            if len(bound) > 4 / share:
                bound = {t: n for t, n in bound.items() if n > share * seen}
        bound = {t: n for t, n in bound.items() if n > share * seen}
        yield pa.RecordBatch.from_arrays([pa.array(bound.keys(), pa.binary()), pa.array(bound.values(), pa.int64())], ["feature", "n"])

    found = id_text(documents).select("text").mapInArrow(run, "feature binary, n long")
    frequent = found.groupBy("feature").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "feature").limit(most)
    return {bytes(r.feature): crc32(r.feature) for r in frequent.collect()}


def _states(batch: pa.RecordBatch, longest: int, known: dict[bytes, int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of each length: the CRC state of every occurrence of a feature, and its row."""
    single: list[bytes] = []
    before: list[int] = []
    for length, texts, begin, end, code, row in _levels(batch, longest):
        if length == 1:
            single = texts
            states = [known[t] if t in known else crc32(t) for t in texts]
        else:
            states = [
                known[t] if t in known else crc32(b" " + single[b], before[a])
                for t, a, b in zip(texts, begin.tolist(), end.tolist(), strict=True)
            ]
        before = states
        yield length, np.array(states, np.int64)[code], row


def totals(documents: DataFrame, known: dict[bytes, int], longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    states = documents.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in slices(batches):
            for _, state, _ in _states(batch, longest, states.value):
                sums += np.bincount(state % buckets, minlength=buckets)
        filled = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(sums[filled])], ["bucket", "n"])

    texts = id_text(documents.withColumn("doc_id", F.lit(None))).select("text")
    out = np.zeros(buckets, np.int64)
    for r in texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of the smoothed shares of each bucket, rounded down."""
    n, all_source, all_target = len(source), int(source.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * float(all_source + n) / ((s + 1) * float(all_target + n))))
            for s, t in zip(source.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def _noise(seed: int, doc_id: int | None) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(documents: DataFrame, known: dict[bytes, int], gain: np.ndarray, longest: int = 1, seed: int = 2024) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row."""
    shared = documents.sparkSession.sparkContext.broadcast((known, gain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states, gain = shared.value
        for batch in slices(batches):
            n = batch.num_rows
            n_words = n_features = sums = np.zeros(n, np.int64)
            for length, state, row in _states(batch, longest, states):
                counts = np.bincount(row, minlength=n)
                n_words = counts if length == 1 else n_words
                n_features = n_features + counts
                sums = sums + np.bincount(row, gain[state % len(gain)], n).astype(np.int64)  # whole numbers, exact below 2^53
            weight = np.where(n_features > 0, sums // np.maximum(n_features, 1), 0)
            noise = np.array([_noise(seed, i) for i in batch.column("doc_id").to_pylist()], np.int64)
            columns = [batch.column("doc_id"), *map(pa.array, (n_words, n_features, weight, weight + noise))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight", "score"])

    return id_text(documents).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def ranked(rows: DataFrame, percent: int, least_words: int) -> DataFrame:
    """Append `rank` from 1 by falling score, then doc_id, to the drawn rows; null to all others."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("score"), F.asc("doc_id"), "n_words", "n_features", "weight"]
    able = rows.filter(F.col("n_words") >= least_words)
    # A row's place is its partition, in the upper bits, and its position there.
    sorted_ = able.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = cut(sorted_.withColumn("place", F.monotonically_increasing_id()))
    # One row a partition.
    sizes = placed.groupBy(F.shiftright("place", 33).alias("part")).agg(F.count("*").alias("rows"))
    drawn = (sizes.agg(F.sum("rows")).first()[0] or 0) * percent // 100
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = near(cut(sizes.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("shift"))), PARTITIONS)
    placed = placed.withColumn("part", F.shiftright("place", 33)).join(shifts, "part")
    rank = F.col("shift") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    placed = placed.select(*rows.columns, F.when(rank <= drawn, rank).alias("rank"))
    return placed.unionByName(rows.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long")))


def resample(
    documents: DataFrame, target: DataFrame, longest: int = 1, percent: int = 10, least_words: int = 20, buckets: int = BUCKETS, seed: int = 2024
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of `documents`, of which `percent`
    of a hundred with at least `least_words` words are drawn towards the texts of `target`."""
    known = head(documents, longest)
    gain = gains(totals(documents, known, longest, buckets), totals(target, known, longest, buckets))
    return ranked(cut(scored(documents, known, gain, longest, seed)), percent, least_words)

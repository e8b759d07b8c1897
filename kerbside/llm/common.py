"""Byte-level helpers shared by the text operators: Arrow batches as UTF-8 buffers, hashes, words.

Tasks see text as one contiguous UTF-8 buffer with offsets, so hashing and splitting run in numpy
over many documents at once. Work is cut into slices of about `SLICE` bytes; a longer text is a
slice of its own, so memory follows the longest text and not the size of a partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.session import Scratch, ensure_checkpoint_dir

SLICE = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
#: A random 64-bit value for each byte; the seed is part of every stored hash.
_TABLE = np.random.default_rng(20240229).integers(0, 2**64, 256, dtype=np.uint64)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_powers: dict[str, np.ndarray] = {}


def small_batches(spark: SparkSession) -> None:
    """Fewer rows in an Arrow batch than Spark's default, as rows are whole documents: 10,000 of them
    would be held several times over, inside and outside of the JVM, by every task."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def text_column(name: str = "text") -> Column:
    """The text, empty where it is missing."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def id_text(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns that the operators read, under fixed names; other columns cannot clash."""
    return documents.select(F.col(id_col).cast("long").alias("doc_id"), text_column(text_col).alias("text"))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(which: str, n: int) -> np.ndarray:
    """The first n powers of the base or of its inverse modulo 2^64; kept for buffers of usual size."""
    have = _powers.get(which)
    if have is None or len(have) < n:
        base = _BASE if which == "base" else pow(_BASE, -1, 1 << 64)
        have, size = np.ones(max(n, SLICE + 1), np.uint64), 1
        while size < len(have):
            more = min(size, len(have) - size)
            np.multiply(have[:more], np.uint64(pow(base, size, 1 << 64)), out=have[size : size + more])
            size += more
        if n <= 2 * SLICE:
            _powers[which] = have
    return have[:n]


class Rolling:
    """Hashes of any byte ranges of a buffer from one running sum."""

    def __init__(self, buffer: np.ndarray):
        n = len(buffer)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[buffer] * _power("base", n), out=self.sums[1:])
        self.inverse = _power("inverse", n + 1)

    def windows(self, length: int) -> np.ndarray:
        """The hash of the bytes [i, i + length) for every i."""
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[length:] - self.sums[:n]) * self.inverse[:n])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and the offsets of its rows, from zero."""
    array = array.cast(pa.large_string())
    _, offsets, data = array.buffers()
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about `size` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = utf8(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
            last = max(first + 1, last)
            yield batch.slice(first, last - first)
            first = last


def lowered(buffer: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all other bytes as they are."""
    return _LOWER[buffer]


def words(buffer: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = _WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of bytes that are not in the table `breaks`: ASCII white space."""
    solid = ~breaks[buffer]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[firsts] = solid[firsts]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    lasts = firsts[1:] - 1
    ends[lasts] = solid[lasts]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(offsets, start, side="right") - 1


def sequences(buffer: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every `size` consecutive words, in order.

    A row with fewer words has its whole sequence as one; a row without words has none.
    """
    start, end, row = words(buffer, offsets)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    word = Rolling(buffer).ranges(start, end)
    n_rows = len(offsets) - 1
    counts = np.bincount(row, minlength=n_rows)
    first = np.zeros(n_rows + 1, np.int64)
    np.cumsum(counts, out=first[1:])
    total = len(word)
    hashed = np.zeros(total, np.uint64)
    left = first[row + 1] - np.arange(total)  # words from here to the end of the row
    for k in range(size):
        nxt = np.zeros(total, np.uint64)
        nxt[: total - k] = word[k:]
        step = mix(hashed * np.uint64(0xD6E8FEB86659FD93) + nxt + np.uint64(k + 1))
        hashed = step if k == 0 else np.where(left > k, step, hashed)
    keep = (left >= size) | ((counts[row] < size) & (left == counts[row]))
    return row[keep], hashed[keep]


def shingles(buffer: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of `size` consecutive words without regard to case (A-Z), by row, then hash."""
    row, hashed = sequences(_LOWER[buffer], offsets, size)
    order = np.lexsort((hashed, row))
    row, hashed = row[order], hashed[order]
    new = runs(row, hashed)
    return row[new], hashed[new]


def let_go() -> None:
    """Give Arrow's spare memory back: workers are reused, and hold it otherwise until they end."""
    pa.default_memory_pool().release_unused()


def by_bucket(bucket: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """The positions of the entries of each bucket that has any."""
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(n + 1))
    for b in np.flatnonzero(np.diff(edges)):
        yield int(b), order[edges[b] : edges[b + 1]]


def runs(*keys: np.ndarray) -> np.ndarray:
    """True where a sorted sequence of keys changes, its first entry included."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        same = np.ones(len(new) - 1, bool)
        for key in keys:
            same &= key[1:] == key[:-1]
        new[1:] = ~same
    return new


def text_bytes(documents: DataFrame, text_col: str = "text") -> int:
    """UTF-8 bytes of all texts: one number that sizes the buckets of a job."""
    return documents.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0


def cut(frame: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder: lost executors cost no more than a read."""
    ensure_checkpoint_dir(frame.sparkSession)
    return frame.checkpoint()


def in_blocks(rows: DataFrame, key: str, blocks: int) -> DataFrame:
    """Append `block`: consecutive ranges of the key (a long, not null) with about equally many rows.

    The bounds are quantiles; they are all that passes through the driver.
    """
    shares = [k / blocks for k in range(1, blocks)] or [0.5]
    bounds = rows.agg(F.percentile_approx(key, shares, max(10_000, 20 * blocks))).first()[0]
    splits = [float("-inf"), *sorted({float(b) for b in bounds or [0]}), float("inf")]
    placed = rows.withColumn("place", F.col(key).cast("double"))
    placed = Bucketizer(splits=splits, inputCol="place", outputCol="block").transform(placed)
    return placed.withColumn("block", F.col("block").cast("int")).drop("place")


def near(frame: DataFrame, bound: int) -> DataFrame:
    """Mark a cut table for a broadcast join if it has at most `bound` rows; else Spark joins by key."""
    return F.broadcast(frame) if frame.count() <= bound else frame


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of the edges (a, b): the smallest id that it reaches.

    Alternates two steps until every node points at its smallest: each node hands its larger
    neighbours to its smallest one, then its smaller ones. Groups are only aggregated, never gathered;
    both sides of each join are cut tables, so a node with very many edges is split by Spark. The
    tables of a round are deleted after the next one.
    """

    def oriented(frame: DataFrame) -> DataFrame:
        return frame.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()

    def state(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    spark = edges.sparkSession
    with ExitStack() as rounds:
        last = rounds.enter_context(Scratch(spark))
        links = last.cut(oriented(edges))
        before = state(links)
        while before[0]:
            now = rounds.enter_context(Scratch(spark))
            with Scratch(spark) as scratch:
                both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
                least = scratch.cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("w")))
                links = scratch.cut(oriented(both.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("w").alias("b"))))
                least = scratch.cut(links.groupBy("u").agg(F.min("v").alias("w")))
                smaller = links.join(least, "u").select(F.col("v").alias("a"), F.col("w").alias("b"))
                links = now.cut(oriented(smaller.unionByName(least.select(F.col("u").alias("a"), F.col("w").alias("b")))))
            last.__exit__()
            last = now
            after = state(links)
            if after == before:
                break
            before = after
        # Every node hangs on its smallest by now; that one has no edge down and names itself.
        named = links.select(F.col("u").alias("id"), F.col("v").alias("component"))
        return cut(named.unionByName(links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()))

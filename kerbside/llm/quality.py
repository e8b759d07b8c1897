"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic scores.

Statistics of a text (lengths, character classes, repetition) are standardised and mapped by random
cosines, whose inner products approximate a Gaussian kernel. Ridge regression on them needs only sums
of products: each partition sums its own, Spark adds them up by row of the matrix, and the driver
solves one small system. Isotonic regression on rows that the fit has not seen turns raw values into
shares of label 1.

Results: a null text is an empty text; every text gets a score, the empty one that of its statistics
(all zero). Without labelled rows every score is 0.5; if all have one label, it is that label.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import Rolling, cut, id_text, mix, runs, slices, utf8, words
from kerbside.llm.labelled import FIT_ROWS, calibration, sample

FEATURES = 256
RIDGE = 1e-3
#: Width of the kernel in standard deviations, times the root of the number of statistics.
WIDTH = 0.6
SEED = 8
#: Partitions of the labelled rows, and so the number of partial sums.
PARTS = 8

_CLASSES = {
    "upper": range(65, 91),
    "letter": [*range(65, 91), *range(97, 123), *range(128, 256)],
    "digit": range(48, 58),
    "stop": b".?!,;:",
    "symbol": b"#$%&*+/<=>@\\^_`{|}~",
    "shout": b"!",
    "bar": b"|",
    "wide": range(128, 256),
    "quote": b"\"'()[]-",
}


def _share(flags: np.ndarray, offsets: np.ndarray, of: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(of, 1)


def _distinct(row: np.ndarray, hashed: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row: the number of different values, and how often the most frequent one occurs."""
    order = np.lexsort((hashed, row))
    row, hashed = row[order], hashed[order]
    first = np.flatnonzero(runs(row, hashed))
    counts = np.diff(np.append(first, len(row)))
    most = np.zeros(n)
    np.maximum.at(most, row[first], counts)
    return np.bincount(row[first], minlength=n), most


def statistics(buffer: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of numbers for each text."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    columns = [np.log1p(size)]
    for members in _CLASSES.values():
        table = np.zeros(256, bool)
        table[list(members)] = True
        columns.append(_share(table[buffer], offsets, size))
    start, end, row = words(buffer, offsets)
    count = np.bincount(row, minlength=n)
    some = np.maximum(count, 1)
    columns.append(np.log1p(count))
    length = end - start
    mean = np.bincount(row, length, minlength=n) / some
    columns += [mean, np.sqrt(np.maximum(np.bincount(row, length**2, minlength=n) / some - mean**2, 0))]
    if len(start):
        rolling = Rolling(buffer)
        hashed = rolling.ranges(start, end)
        different, most = _distinct(row, hashed, n)
        again = np.zeros(len(row), bool)
        again[1:] = (hashed[1:] == hashed[:-1]) & (row[1:] == row[:-1])
        triple = row[2:] == row[:-2]
        three = mix(hashed[2:] * np.uint64(3) + mix(hashed[1:-1] * np.uint64(5) + mix(hashed[:-2])))
        different3, most3 = _distinct(row[2:][triple], three[triple], n)
        some3 = np.maximum(np.bincount(row[2:][triple], minlength=n), 1)
        columns += [different / some, most / some, np.bincount(row, again, minlength=n) / some, different3 / some3, most3 / some3]
        last, head = buffer[end - 1], buffer[start]
        odd = np.zeros(256, bool)
        odd[list(b"#$%&*+/<=>@\\^_`{|}~!")] = True
        capital = np.zeros(256, bool)
        capital[65:91] = True
        all_caps = capital[head] & capital[buffer[np.minimum(start + 1, end - 1)]]
        columns += [np.bincount(row, f, minlength=n) / some for f in (odd[last], capital[head], all_caps, buffer[end - 1] == 46)]
    else:
        columns += [np.zeros(n)] * 9
    lines = np.bincount(np.searchsorted(offsets, np.flatnonzero(buffer == 10), side="right") - 1, minlength=n) + 1
    columns += [np.log1p(size / lines), np.log1p(lines)]
    return np.stack(columns, axis=1).astype(np.float64)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    at: np.ndarray
    share: np.ndarray
    constant: float | None = None

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return mapped((stats - self.mean) / self.scale) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(stats), self.constant)
        return np.clip(np.interp(self.raw(stats), self.at, self.share), 0.0, 1.0)


def mapped(standard: np.ndarray) -> np.ndarray:
    """Cosines in random directions, with a constant; far outliers are cut to ten deviations."""
    random = np.random.default_rng(SEED)
    n = standard.shape[1]
    directions = random.standard_normal((n, FEATURES)) / (WIDTH * np.sqrt(n))
    phase = random.uniform(0, 2 * np.pi, FEATURES)
    cosines = np.sqrt(2 / FEATURES) * np.cos(np.clip(standard, -10, 10) @ directions + phase)
    return np.concatenate([cosines, np.ones((len(standard), 1))], axis=1)


def _rows(frame: DataFrame) -> DataFrame:
    """(label, calibrates, stats) of labelled rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            stats = statistics(*utf8(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("calibrates"), pa.array(list(stats))], ["label", "calibrates", "stats"])

    return frame.mapInArrow(run, "label double, calibrates boolean, stats array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def fit(documents: DataFrame, labels: DataFrame, label_col: str = "quality", rows: int = FIT_ROWS) -> Model:
    known = cut(_rows(sample(documents, labels, label_col, rows)).repartition(PARTS))
    seen = known.groupBy("calibrates").agg(F.count("*").alias("n"), F.sum("label").alias("ones")).collect()
    total, ones = sum(r.n for r in seen), sum(r.ones for r in seen)
    nothing = np.zeros(0)
    if not total or ones in (0, total):
        return Model(nothing, nothing, nothing, nothing, nothing, ones / total if total else 0.5)
    # Few labelled rows may leave one part without rows of its own: then it uses all.
    ready = known.filter("NOT calibrates") if any(not r.calibrates for r in seen) else known
    held = known.filter("calibrates") if any(r.calibrates for r in seen) else known

    moments = ready.select(F.posexplode("stats").alias("k", "x")).groupBy("k").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("scale"))
    moments = sorted(moments.collect())  # a row for each statistic
    mean = np.array([m["mean"] for m in moments])
    scale = np.array([m["scale"] if m["scale"] > 1e-9 else 1.0 for m in moments])

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The partition's sums of products, a row of the matrix each; the label is the last column."""
        sums = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            z = mapped((_matrix(batch.column("stats")) - mean) / scale)
            sums += z.T @ np.concatenate([z, batch.column("label").to_numpy()[:, None]], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(FEATURES + 1)), pa.array(list(sums))], ["k", "sums"])

    def added(table: pa.Table) -> pa.Table:
        return pa.table({"k": table.column("k")[:1], "sums": pa.array([np.sum(table.column("sums").to_pylist(), axis=0)])})

    partial = ready.select("stats", "label").mapInArrow(products, "k long, sums array<double>")
    system = np.array([r["sums"] for r in sorted(partial.groupBy("k").applyInArrow(added, "k long, sums array<double>").collect())])
    weights = np.linalg.solve(system[:, :-1] + RIDGE * np.eye(FEATURES + 1), system[:, -1])
    model = Model(mean, scale, weights, nothing, nothing)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(model.raw(_matrix(batch.column("stats")))), batch.column("label")], ["raw", "label"])

    shares = calibration(cut(held.select("stats", "label").mapInArrow(raw, "raw double, label double")))
    model.at, model.share = shares.boundaries.toArray(), shares.predictions.toArray()
    return model


def score(documents: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(statistics(*utf8(batch.column("text")))))], ["doc_id", "score"])

    return id_text(documents, id_col, text_col).mapInArrow(run, "doc_id long, score double")

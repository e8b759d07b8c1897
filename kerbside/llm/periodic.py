"""Periodic runs of words: maximal stretches that repeat with their smallest period three times or more.

Sparse diagonals over growing word sequences: a run of period q is a diagonal at lag q, on which every
word equals the one q before it. A word has many earlier occurrences, and a single one does not tell
which lag will last. So lags are looked for by scale: at scale k (8, 16, 32, ...) the entries are the
sequences of k words, and the lags those above k / 2 up to k (all up to 8 at the first). There the
nearest earlier occurrence of an entry is the only one that counts: inside a run of smallest period
q <= k an equal sequence of k words nearer than q would make the period smaller. Each entry therefore
adds one to the match length of one active diagonal, or ends it, and a diagonal that ends long enough is
a run, whole and with its smallest period: a run of three periods has two such entries at least.

Entries that do not recur in their document drop out of all larger scales, so common prose is settled at
the first. The work is n log n for any text, one that is nothing but repeats included, and a task holds
the words of about a megabyte of texts, or of one longer text.

Results: a null or white text has no words and no runs. Each row is taken by itself; repeated rows and
rows without doc_id are as good as any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kerbside.llm.common import Rolling, id_text, mix, runs, slices, utf8, words

#: Words in the entries of the first scale; LEAST and TIMES must leave every run one of them at least.
FIRST = 8
LEAST, TIMES = 24, 3

_STEP = np.uint64(0xD6E8FEB86659FD93)
_SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, text string"


def _nearest(entry: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the entries at rising positions: the lag to the nearest earlier equal one (0: none), and
    whether any other is equal."""
    order = np.argsort(entry, kind="stable")
    again = ~runs(entry[order])
    lag = np.zeros(len(at), np.int64)
    lag[order[again]] = at[order[again]] - at[order[np.flatnonzero(again) - 1]]
    other = again.copy()
    other[:-1] |= again[1:]
    shared = np.zeros(len(at), bool)
    shared[order[other]] = True
    return lag, shared


def found(word: np.ndarray, row: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """(row, start, length, period) of all runs of word hashes that stand row by row, in order."""
    if least < 2 * FIRST or times < 3:
        raise ValueError("runs must have at least 16 words and three periods")
    total = len(word)
    counts = np.bincount(row)
    first = np.cumsum(counts) - counts
    size = counts[row]
    left = first[row] + size - np.arange(total)
    entry, width = word.copy(), 1
    while width < FIRST:
        ahead = max(total - width, 0)
        entry[:ahead] = mix(entry[:ahead] * _STEP + entry[width:] + np.uint64(width))
        width *= 2
    at = np.flatnonzero((left >= width) & (size >= least))
    out = []
    while len(at):
        lag, shared = _nearest(mix(entry[at] * _STEP + row[at].astype(np.uint64)), at)
        active = (lag > (width // 2 if width > FIRST else 0)) & (lag <= width)
        here, lags = at[active], lag[active]
        if len(here):
            begins = np.flatnonzero(np.concatenate([[True], (np.diff(here) != 1) | (np.diff(lags) != 0)]))
            ends = np.append(begins[1:], len(here)) - 1
            period = lags[begins]
            start = here[begins] - period
            length = here[ends] + width - start
            long = length >= np.maximum(least, times * period)
            start, length, period = start[long], length[long], period[long]
            out.append(np.stack([row[start], start - first[row[start]], length, period], axis=1))
        # A sequence of twice the words recurs only if both its halves do.
        recurs = np.zeros(total + width, bool)
        recurs[at[shared]] = True
        further = at[shared & recurs[at + width] & (left[at] >= 2 * width) & (size[at] > times * width)]
        entry[further] = mix(entry[further] * _STEP + entry[further + width] + np.uint64(width))
        at, width = further, 2 * width
    if not out:
        return np.zeros((0, 4), np.int64)
    out = np.concatenate(out)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _collapsed(batch: pa.RecordBatch, least: int, times: int) -> pa.RecordBatch:
    buffer, offsets = utf8(batch.column("text"))
    start, end, row = words(buffer, offsets)
    n, total = batch.num_rows, len(start)
    counts = np.bincount(row, minlength=n)
    first = np.cumsum(counts) - counts
    all_runs = found(Rolling(buffer).ranges(start, end), row, least, times) if total else np.zeros((0, 4), np.int64)
    owner, begin, length, period = all_runs.T

    # Words in a run behind its first period are dropped.
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, first[owner] + begin + period, 1)
    np.add.at(change, first[owner] + begin + length, -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)

    # Their bytes, each with a blank behind it, which the last of a row loses again.
    size = end[kept] - start[kept] + 1
    last = np.append(row[kept][1:] != row[kept][:-1], True) if len(kept) else np.zeros(0, bool)
    stop = np.cumsum(size - last)
    source = np.arange(stop[-1] if len(stop) else 0) + np.repeat(start[kept] - stop + (size - last), size - last)
    text = np.append(buffer, np.uint8(32))[source]
    text[stop[~last] - 1] = 32
    ends = np.zeros(n, np.int64)
    ends[row[kept][last]] = stop[last]
    edges = np.concatenate([[0], np.maximum.accumulate(ends)])

    listed = pa.StructArray.from_arrays([pa.array(x) for x in (begin, length, period)], ["start", "length", "period"])
    per_row = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int32)
    out = pa.LargeStringArray.from_buffers(n, pa.py_buffer(edges), pa.py_buffer(text)).cast(pa.string())
    columns = [batch.column("doc_id"), pa.array(counts), pa.ListArray.from_arrays(pa.array(per_row), listed), out]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "text"])


def collapse(documents: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """(doc_id, n_words, runs, text) of every row: its runs of at least `least` words and `times` periods,
    by start, then period; and the words that no run holds behind its first period, joined by blanks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield _collapsed(batch, least, times)

    return id_text(documents).mapInArrow(run, _SCHEMA)

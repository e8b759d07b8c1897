"""Repeated byte strings: depth-limited radix grouping of suffixes, most significant digit first.

Every byte that lies in a `WINDOW`-byte string which also starts earlier (smaller doc_id, or the
same document further left) is a repeat. Ordering all suffixes through `WINDOW` bytes would bring
equal strings together; the order between different strings is of no use, so a digit is the hash of
a stretch of bytes and each pass only splits groups:

1. The first digit of a window is its smallest `DIGIT`-byte hash (leftmost if equal). Windows with
   the same one stand side by side, so they travel as one record, an anchor: about one for each 35
   bytes. Anchors whose digit is unique are done: none of their windows repeats.
2. The next digit covers all bytes under an anchor's windows. Where it is equal, all windows are
   equal: all but the first record of such a group are repeats. If a group holds several of them,
   its first records go on, cut into chunks of `CHUNK` windows whose digit is the 93 bytes they share.
3. What is left of those is compared window by window, through the full depth of `WINDOW` bytes.

Equal groups at full depth are exactly the repeated windows. A digit is 64 bits and is compared
only inside a group that agrees on the digit before, so records agree on 128 bits.

Records travel as packed arrays by hash bucket; a task drops what is already repeated inside its own
records first, so a string that stands in a third of all documents reaches a bucket once per task.

Results: a null text is an empty text. A row without doc_id ranks after all others. Rows that share a
doc_id are documents of their own if their texts differ, ranked by a hash of the text, and are one
document listed several times if their texts are equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm.common import Rolling, by_bucket, mix, runs, slices, text_column, utf8

WINDOW = 100
DIGIT = 24
CHUNK = 8
_WIDTH = WINDOW - DIGIT + 1
#: A stretch of text that is hashed at once; longer texts are cut, all windows stay whole.
SEGMENT = 1 << 20
_POSITION = np.uint64(24)  # bits for a position in a stretch, below the bits of a digit
#: Records that a task gathers before it packs them.
GATHERED = 300_000
#: Text bytes for each bucket of records.
BUCKET_BYTES = 8 << 20

_BLOB = "bucket long, key binary, span binary, doc binary, t binary, at binary, n binary, shift binary, done binary"
_FIELDS = ("key", "span", "doc", "t", "at", "n", "shift")
_TYPES = {"key": np.uint64, "span": np.uint64, "doc": np.int64, "t": np.int64, "at": np.int64, "n": np.uint8, "shift": np.uint8}
_FOUND = "pending boolean, doc long, t long, at long, n int, shift int"


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each `width` neighbours, from minima inside blocks of that width."""
    out = len(values) - width + 1
    blocks = np.concatenate([values, np.full(-len(values) % width, ~np.uint64(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:out], ahead[width - 1 : width - 1 + out])


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(batch, bytes, offsets, row of each stretch, its first byte in the row); stretches of one row
    overlap so that each window lies in exactly one of them."""
    for batch in batches:
        buffer, offsets = utf8(batch.column("text"))
        rows, begins, ends = [], [], []
        for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            while b - a >= WINDOW:
                rows.append(row)
                begins.append(a)
                ends.append(min(b, a + SEGMENT + WINDOW - 1))
                a += SEGMENT
        first = 0
        while first < len(rows):
            last, total = first, 0
            while last < len(rows) and (last == first or total + ends[last] - begins[last] <= SEGMENT):
                total += ends[last] - begins[last]
                last += 1
            sizes = np.array(ends[first:last]) - np.array(begins[first:last])
            starts = np.concatenate([[0], np.cumsum(sizes)])
            pieces = np.concatenate([buffer[begins[k] : ends[k]] for k in range(first, last)])
            row = np.array(rows[first:last])
            yield batch, pieces, starts, row, np.array(begins[first:last]) - offsets[row]
            first = last


def _anchors(buffer: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """First two digits of all windows of the stretches; `piece` and `at` say where the windows begin."""
    rolling = Rolling(buffer)
    digits = rolling.windows(DIGIT)
    ordered = (digits >> _POSITION << _POSITION) | np.arange(len(digits), dtype=np.uint64)
    least = (_least(ordered, _WIDTH) & ((np.uint64(1) << _POSITION) - np.uint64(1))).astype(np.int64)
    inside = np.zeros(len(buffer) + 1, np.int8)
    inside[offsets[:-1]] += 1
    inside[offsets[1:] - WINDOW + 1] -= 1
    at = np.flatnonzero(np.cumsum(inside[: len(least)]))
    anchor = least[at]
    piece = np.searchsorted(offsets, at, side="right") - 1
    first = np.flatnonzero(runs(anchor, piece))
    n = np.diff(np.append(first, len(at)))
    at, anchor = at[first], anchor[first]
    shift = anchor - at
    span = rolling.ranges(at, at + n + WINDOW - 1) + mix(shift.astype(np.uint64))
    return {"key": digits[anchor], "span": span, "piece": piece[first], "at": at, "n": n, "shift": shift}


class _Packer:
    """Gathers records of a task and packs them by bucket, without those that the task itself repeats."""

    def __init__(self, buckets: int):
        self.buckets, self.parts, self.size, self.turn = buckets, [], 0, 0

    def add(self, **fields: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(fields)
        self.size += len(fields["key"])
        if self.size >= GATHERED:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        got = {f: np.concatenate([p[f] for p in self.parts]).astype(_TYPES[f]) for f in _FIELDS}
        self.parts, self.size = [], 0
        ranked, first, later, order = _ranked(got)
        done = _covered(*(ranked[f][later].astype(np.int64) for f in ("doc", "t", "at", "n")))
        kept = np.sort(order[first])  # in reading order: neighbours differ little and pack well
        got = {f: v[kept] for f, v in got.items()}
        bucket = ((got["key"] >> np.uint64(20)) % np.uint64(self.buckets)).astype(np.int64)
        rows = list(by_bucket(bucket, self.buckets))
        # Repeats found here need no bucket; they are dealt evenly over the rows that go out.
        shares = np.array_split(done, len(rows), axis=0)
        self.turn += 1
        columns: dict[str, list] = {name: [] for name in ("bucket", *_FIELDS, "done")}
        for k, (b, at) in enumerate(rows):
            columns["bucket"].append(b)
            for f in _FIELDS:
                values = got[f][at]
                columns[f].append((np.diff(values, prepend=values.dtype.type(0)) if f in ("doc", "t") else values).tobytes())
            columns["done"].append(shares[(k + self.turn * 7) % len(rows)].tobytes())
        arrays = [pa.array(columns["bucket"], pa.int64()), *(pa.array(columns[f], pa.binary()) for f in (*_FIELDS, "done"))]
        yield pa.RecordBatch.from_arrays(arrays, ["bucket", *_FIELDS, "done"])


def _ranked(got: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Records by digits and place; which of them come first, which repeat a first one, and their
    former order. A record with the place of the first is the same text listed again and is neither."""
    order = np.lexsort((got["at"], got["t"], got["doc"], got["span"], got["key"]))
    got = {f: v[order] for f, v in got.items()}
    first = runs(got["key"], got["span"])
    leader = np.flatnonzero(first)[np.cumsum(first) - 1]
    later = np.zeros(len(first), bool)
    for f in ("doc", "t", "at"):
        later |= got[f] != got[f][leader]
    return got, first, later, order


def _covered(doc: np.ndarray, t: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Windows joined to rows (doc, t, first window, number of windows) where they follow each other."""
    if not len(doc):
        return np.zeros((0, 4), np.int64)
    order = np.lexsort((at, t, doc))
    doc, t, at, n = doc[order], t[order], at[order], n[order]
    new = runs(doc, t)
    new[1:] |= at[1:] > at[:-1] + n[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return np.stack([doc[first], t[first], at[first], at[last] + n[last] - at[first]], axis=1)


def _resolve(table: pa.Table) -> pa.Table:
    """Records of one bucket: those that follow an equal record are repeats; the first records of a
    group with several different ones are pending, for the next digit decides."""
    blobs = {f: table.column(f).to_pylist() for f in (*_FIELDS, "done")}
    got = {}
    for f in _FIELDS:
        parts = [np.frombuffer(b, _TYPES[f]) for b in blobs[f]]
        got[f] = np.concatenate([np.cumsum(p) for p in parts] if f in ("doc", "t") else parts)
    got, first, again, _ = _ranked(got)
    repeats = _covered(*(got[f][again].astype(np.int64) for f in ("doc", "t", "at", "n")))
    repeats = np.concatenate([repeats, np.frombuffer(b"".join(blobs["done"]), np.int64).reshape(-1, 4)])
    key = got["key"][first]
    starts = np.flatnonzero(runs(key))
    sizes = np.diff(np.append(starts, len(key)))
    open_ = np.flatnonzero(first)[np.repeat(sizes > 1, sizes)]
    n_done, n_open = len(repeats), len(open_)
    join = lambda done, f: np.concatenate([done, got[f][open_].astype(np.int64)])
    return pa.table(
        {
            "pending": pa.array(np.repeat([False, True], [n_done, n_open])),
            "doc": join(repeats[:, 0], "doc"),
            "t": join(repeats[:, 1], "t"),
            "at": join(repeats[:, 2], "at"),
            "n": pa.array(join(repeats[:, 3], "n").astype(np.int32)),
            "shift": pa.array(join(np.zeros(n_done, np.int64), "shift").astype(np.int32)),
        }
    )


def _first_pass(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(buckets)
        for batch, buffer, offsets, row, begins in _segments(batches):
            doc, t = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "t"))
            found = _anchors(buffer, offsets)
            piece = found.pop("piece")
            found["at"] = found["at"] - offsets[piece] + begins[piece]
            yield from packer.add(doc=doc[row[piece]], t=t[row[piece]], **found)
        yield from packer.flush()

    return run


def _next_pass(buckets: int, chunk: int):
    """Cut pending records into chunks of windows; `chunk` 1 compares single windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(buckets)
        for batch in batches:
            buffer, offsets = utf8(batch.column("text"))
            doc, t = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "t"))
            for row in range(batch.num_rows):
                raw = np.array(batch.column("pending")[row].as_py(), np.int64).reshape(-1, 3)
                raw = raw[np.argsort(raw[:, 0])]
                text = buffer[offsets[row] : offsets[row + 1]]
                # Long texts hold far more bytes than pending windows need: hash stretches around those.
                for begin, end, part in _near(raw, len(text)):
                    found = _cut(Rolling(text[begin:end]), part - np.array([begin, 0, 0]), chunk)
                    found["at"] = found["at"] + begin
                    size = len(found["at"])
                    yield from packer.add(doc=np.repeat(doc[row], size), t=np.repeat(t[row], size), **found)
        yield from packer.flush()

    return run


def _near(pending: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Stretches of a text that hold all bytes of the pending windows."""
    first = 0
    while first < len(pending):
        begin = int(pending[first, 0])
        last = int(np.searchsorted(pending[:, 0], begin + SEGMENT, side="right"))
        part = pending[first:last]
        yield begin, min(length, int((part[:, 0] + part[:, 1]).max()) + WINDOW - 1), part
        first = last


def _cut(rolling: Rolling, pending: np.ndarray, chunk: int) -> dict[str, np.ndarray]:
    """Windows by their distance to the anchor, `chunk` of them at a time: the digit that such windows
    share lies at fixed places around the anchor, wherever the chunk itself is cut off."""
    at, n, shift = pending.T
    windows = np.repeat(at, n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
    anchor = np.repeat(at + shift, n)
    if chunk == 1:
        span = rolling.ranges(windows, windows + WINDOW)
        return {"key": mix(span + np.uint64(1)), "span": span, "at": windows, "n": np.ones(len(windows), np.int64), "shift": anchor - windows}
    group = (anchor - windows) // chunk
    first = np.flatnonzero(runs(np.repeat(np.arange(len(at)), n), group))
    size = np.diff(np.append(first, len(windows)))
    begin, anchor, group = windows[first], anchor[first], group[first]
    core = anchor - chunk * group
    shift = anchor - begin
    key = rolling.ranges(core, core - chunk + 1 + WINDOW) + mix(group.astype(np.uint64) + np.uint64(7))
    span = rolling.ranges(begin, begin + size + WINDOW - 1) + mix(shift.astype(np.uint64))
    return {"key": key, "span": span, "at": begin, "n": size, "shift": shift}


def keyed(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """(doc_id, doc, t, text, rest) and the number of text bytes. `doc` ranks rows, without nulls; `t`
    tells rows of one doc_id apart and is only computed where some doc_id is missing or repeated;
    `rest` is the whole row without its text."""
    others = [F.col(f"`{c}`") for c in documents.columns if c != text_col]
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), text_column(text_col).alias("text"), F.struct(*others).alias("rest"))
    seen = rows.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size"))
    most, missing, size = seen.agg(F.max("n"), F.max(F.col("doc_id").isNull()), F.sum("size")).first()
    apart = F.xxhash64("text") if missing or (most or 0) > 1 else F.lit(0).cast("long")
    doc = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    return rows.select("doc_id", doc.alias("doc"), apart.alias("t"), "text", "rest"), size or 0


def repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, doc, t, text, rest, starts, sizes) of every row: the repeated windows, as first window and
    number of windows in a row; they may touch. Null where nothing repeats."""
    spark = documents.sparkSession
    rows, size = keyed(documents, id_col, text_col)
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    # Three joins with the same columns and key: Spark shuffles the texts once and reuses the exchange.
    found = []
    packed = rows.select("doc", "t", "text").mapInArrow(_first_pass(buckets), _BLOB)
    for chunk in (CHUNK, 1, 0):
        resolved = packed.groupBy("bucket").applyInArrow(_resolve, _FOUND)
        found.append(resolved)
        if not chunk:
            break
        pending = resolved.filter("pending").groupBy("doc", "t").agg(F.flatten(F.collect_list(F.array(F.col("at"), F.col("n").cast("long"), F.col("shift").cast("long")))).alias("pending"))
        packed = rows.join(pending.hint("shuffle_hash"), ["doc", "t"]).select(*rows.columns, "pending").mapInArrow(_next_pass(buckets, chunk), _BLOB)
    done = found[0].unionByName(found[1]).unionByName(found[2]).filter("NOT pending")
    done = done.groupBy("doc", "t").agg(F.collect_list("at").alias("starts"), F.collect_list("n").alias("sizes"))
    return rows.join(done.hint("shuffle_hash"), ["doc", "t"], "left").select(*rows.columns, "starts", "sizes")


def _removed(starts: list[int], sizes: list[int]) -> list[tuple[int, int]]:
    """Byte ranges of the windows, joined where they touch."""
    at = np.array(starts, np.int64)
    end = at + np.array(sizes, np.int64) + WINDOW - 1
    order = np.argsort(at, kind="stable")
    at, end = at[order], np.maximum.accumulate(end[order])
    new = np.ones(len(at), bool)
    new[1:] = at[1:] > end[:-1]
    first = np.flatnonzero(new)
    return list(zip(at[first].tolist(), end[np.append(first[1:], len(at)) - 1].tolist(), strict=True))


def cut_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, removed array<struct<begin, end>>, kept binary, rest): each text without its
    repeats; `rest` holds the other columns."""
    return _without(documents, id_col, text_col, T.BinaryType())


def _without(documents: DataFrame, id_col: str, text_col: str, kept_type: T.DataType) -> DataFrame:
    """What is kept as bytes, or as a string without characters that were cut in two."""
    rows = repeats(documents, id_col, text_col).select("doc_id", "text", "starts", "sizes", "rest")
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    as_text = isinstance(kept_type, T.StringType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=2 * SEGMENT):
            lengths, spans, kept = [], [], []
            for text, starts, sizes in zip(*(batch.column(c).to_pylist() for c in ("text", "starts", "sizes")), strict=True):
                raw = text.encode("utf-8")
                removed = _removed(starts, sizes) if starts is not None else []
                edges = [0, *(x for span in removed for x in span), len(raw)]
                left = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                kept.append(left.decode("utf-8", "ignore") if as_text else left)
                spans.append([{"begin": a, "end": b} for a, b in removed])
                lengths.append(len(raw))
            arrays = [batch.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.string() if as_text else pa.binary())]
            yield pa.RecordBatch.from_arrays([*arrays, batch.column("rest")], ["doc_id", "n_bytes", "removed", "kept", "rest"])

    span = T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())])
    fields = [("doc_id", T.LongType()), ("n_bytes", T.LongType()), ("removed", T.ArrayType(span)), ("kept", kept_type)]
    return rows.mapInArrow(run, T.StructType([*(T.StructField(*f) for f in fields), rows.schema["rest"]]))


def without_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with repeats cut from their texts. A character that is cut in two goes as a whole; a null
    text stays null, and a text that is nothing but repeats becomes empty."""
    rows = _without(documents.withColumn(_NULL, F.col(text_col).isNull()), id_col, text_col, T.StringType())
    text = F.when(~F.col(f"rest.`{_NULL}`"), F.col("kept"))
    return rows.select(*(text.alias(c) if c == text_col else F.col(f"rest.`{c}`") for c in documents.columns))


_NULL = "text was null"

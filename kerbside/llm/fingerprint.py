"""Document fingerprints: a homomorphic multiset hash over paragraphs.

A paragraph is what stands between line breaks, if it is not only white space. Each one is hashed to a
wide vector, and a document's fingerprint is the sum of its paragraphs' vectors, every lane modulo
2^32. Sums do not depend on order, and paragraphs can be added or taken away without the rest of
the text (`add`, `subtract`). The vector has two parts:

* `EXACT` lanes filled by an extendable-output hash of the paragraph: equal sums mean equal multisets
  of paragraphs, but for chance.
* `SKETCH` lanes to which each run of three words in the paragraph adds plus or minus one, in a lane
  and with a sign that its hash chooses. The squared difference of two such parts estimates in how
  many runs two texts differ, so `likeness` works on fingerprints alone, also after edits.

Likeness is 1 - |a - b|^2 / (|a|^2 + |b|^2), from 0 to 1: 1 for equal fingerprints, also of two empty
texts, and 0 if only one is empty. Its standard error is about 0.09 (`SKETCH` = 128).

Results: a null text is an empty text, whose fingerprint is all zero. Rows are ordered by falling
doc_id, rows without one last; rows that share a doc_id by their texts.
"""

from __future__ import annotations

import base64
import hashlib
import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import SLICE, id_text, in_blocks, sequences, slices, utf8

EXACT = 32
SKETCH = 128
WORDS = 3
#: Text bytes of a block of neighbouring documents.
BLOCK_BYTES = 8 << 20
#: Text bytes that a task gathers before it packs them.
GATHERED_BYTES = 24 << 20


def vectors(texts: list[bytes]) -> np.ndarray:
    """One row of lanes (uint32) for each UTF-8 text."""
    out = np.zeros((len(texts), EXACT + SKETCH), np.uint32)
    owner, paragraphs = [], []
    for k, text in enumerate(texts):
        for paragraph in text.split(b"\n"):
            if paragraph.strip():
                owner.append(k)
                paragraphs.append(paragraph)
    if not paragraphs:
        return out
    of = np.array(owner)
    digests = b"".join([hashlib.shake_128(p).digest(4 * EXACT) for p in paragraphs])
    first = np.flatnonzero(np.diff(of, prepend=-1))
    out[of[first], :EXACT] = np.add.reduceat(np.frombuffer(digests, np.uint32).reshape(-1, EXACT), first, axis=0)
    offsets = np.zeros(len(paragraphs) + 1, np.int64)
    np.cumsum([len(p) for p in paragraphs], out=offsets[1:])
    row, hashed = sequences(np.frombuffer(b"".join(paragraphs), np.uint8), offsets, WORDS)
    lane = of[row] * SKETCH + (hashed % np.uint64(SKETCH)).astype(np.int64)
    sign = np.where(hashed >> np.uint64(40) & np.uint64(1), 1.0, -1.0)
    sums = np.bincount(lane, sign, minlength=len(texts) * SKETCH)
    out[:, EXACT:] = sums.astype(np.int64).astype(np.uint32).reshape(-1, SKETCH)
    return out


def add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The fingerprint of all paragraphs of both."""
    return a + b


def subtract(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The fingerprint of a's paragraphs without b's."""
    return a - b


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """From 0 to 1 for each row of two sets of fingerprints."""
    sketch = lambda x: x[..., EXACT:].astype(np.int32).astype(np.float64)
    total = (sketch(a) ** 2).sum(-1) + (sketch(b) ** 2).sum(-1)
    apart = (sketch(a - b) ** 2).sum(-1)
    value = 1 - apart / np.where(total > 0, total, 1)
    return np.where((a == b).all(-1), 1.0, np.where(total > 0, np.clip(value, 0, 1), 0.0))


def encoded(lanes: np.ndarray) -> list[str]:
    return [base64.b64encode(row.tobytes()).decode() for row in lanes.astype("<u4")]


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint binary: little-endian lanes) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lanes = vectors(_bytes(batch.column("text"))).astype("<u4")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in lanes], pa.binary())], ["doc_id", "fingerprint"])

    return id_text(documents, id_col, text_col).mapInArrow(run, "doc_id long, fingerprint binary")


def _bytes(column: pa.Array) -> list[bytes]:
    buffer, offsets = utf8(column)
    raw = buffer.tobytes()
    return [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a task by block, each share compressed as a whole: half the bytes of a row-wise shuffle."""
    held: dict[int, list[tuple]] = {}
    size = 0

    def flush() -> pa.RecordBatch:
        shares = [zlib.compress(pickle.dumps(rows), 3) for rows in held.values()]
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(shares, pa.binary())], ["block", "share"])

    for batch in slices(batches):
        columns = (batch.column(c).to_pylist() for c in ("block", "guest", "key", "doc_id"))
        for block, *row in zip(*columns, _bytes(batch.column("text")), strict=True):
            held.setdefault(block, []).append(tuple(row))
            size += len(row[-1])
        if size > GATHERED_BYTES:
            yield flush()
            held, size = {}, 0
    if held:
        yield flush()


def in_turn(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(block, share): rows as `_packed` packs them, every row in the block of its doc_id's range.

    Blocks are ranges of doc_id of about equal size, so there is no global sort in one task; only
    the bounds of blocks, one pair of numbers for each, pass through the driver. The first row of a
    block is also a guest in the block before it, and that of the first block in the last one.
    """
    spark = documents.sparkSession
    rows = id_text(documents, id_col, text_col).withColumn("key", F.coalesce("doc_id", F.lit(-(1 << 63))))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BLOCK_BYTES))
    rows = in_blocks(rows, "key", blocks)
    firsts = dict(rows.groupBy("block").agg(F.max("key")).collect())  # a row for each block
    filled = sorted(firsts)
    host = {b: filled[(k + 1) % len(filled)] for k, b in enumerate(filled)}  # the block before b in falling order
    first_of, host_of = ([table.get(b, -1) for b in range(max(filled, default=0) + 1)] for table in (firsts, host))
    at = F.col("block") + 1
    goes_to = F.when(F.col("key") == F.element_at(F.lit(first_of).cast("array<long>"), at), F.array("block", F.element_at(F.lit(host_of).cast("array<int>"), at)))
    rows = rows.select(F.posexplode(F.coalesce(goes_to, F.array("block"))).alias("guest", "block"), "key", "doc_id", "text")
    return rows.mapInArrow(_packed, "block int, share binary")


def edits(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document against its edited text, whose second half is the start of the next document, and
    against that document: (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next)."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def results(ids: list, texts: list[bytes]) -> pa.Table:
        """Of all rows but the last; each row's next is the row behind it."""
        lanes = vectors(texts)
        edited, sizes = [], []
        for raw, following in zip(texts, texts[1:], strict=False):
            text = raw.decode("utf-8")
            half = len(text) // 2
            sizes.append(len(text))
            edited.append((text[: len(text) - half] + following.decode("utf-8")[:half]).encode("utf-8"))
        changed = vectors(edited)
        columns = [
            pa.array(ids[:-1], pa.int64()),
            pa.array(sizes, pa.int64()),
            pa.array([hashlib.sha256(t).hexdigest() for t in edited], pa.string()),
            pa.array(encoded(lanes[:-1]), pa.string()),
            pa.array(encoded(changed), pa.string()),
            pa.array(likeness(lanes[:-1], changed), pa.float64()),
            pa.array(likeness(lanes[:-1], lanes[1:]), pa.float64()),
        ]
        return pa.table(columns, names)

    def run(table: pa.Table) -> pa.Table:
        # Plain rows that this job has packed itself; by falling key, guests last.
        rows = [row for share in table.column("share").to_pylist() for row in pickle.loads(zlib.decompress(share))]
        rows.sort(key=lambda r: (r[0], -r[1], r[3]))
        own = sum(1 for r in rows if not r[0])
        rows = rows[: own + 1]
        parts, first = [], 0
        while first < own:  # about a slice at a time
            last, size = first + 1, len(rows[first][3])
            while last < own and size < SLICE:
                size += len(rows[last][3])
                last += 1
            parts.append(results([r[2] for r in rows[first : last + 1]], [r[3] for r in rows[first : last + 1]]))
            first = last
        return pa.concat_tables(parts)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return in_turn(documents, id_col, text_col).groupBy("block").applyInArrow(run, schema)

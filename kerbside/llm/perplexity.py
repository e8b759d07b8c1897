"""Quality rules: plain counts of a text, and its perplexity under an n-gram model of its own language.

The model is learnt from all different texts, each once. It is a modified Kneser-Ney model over sequences of up to five bytes (white space as one blank,
missing bytes before the beginning as zero), one for each language. Spark counts: each task adds up its
sequences, and one shuffle adds those up. Shorter sequences count the different bytes before them. Three
discounts for each order and language come from the counts of counts; what they free goes to the next
shorter order, down to equal shares for all bytes. Bytes and not words, as their sequences fit a table
that many documents share, so that no text is predicted from its own counts alone.

The model is a table (language, size, kind, gram, value): log probabilities of sequences and log weights of
contexts. To score it becomes two arrays, sorted 64-bit hashes and their values, that go to every executor if
the table has at most `MODEL_ROWS` rows. A larger one goes there in parts of about as many, one after the other:
all that a sequence may ask for beyond one byte and its predecessor has the same two bytes before the last, so
each part scores the sequences with its own two, and texts add up what the parts give. Beyond `PARTS` of them the
sequences of each document are joined with the table by key, which moves many times the text. A sequence that
the model has not seen is scored by its longest known end.

A text that passes the plain rules is kept if its log perplexity lies within the band of its language:
from the 10th percentile to the 90th, over different texts that pass them, and `REACH` times as far beyond
as these lie from the median (or half as far as the other one does, so that a large group of near copies
cannot close the band around itself).

Results: a null text has no words and fails. A missing language is a language of its own. Rows are judged
one by one. Of rows with one text those with the smallest doc_id are learnt (all, if none has one); in the
percentiles a text counts once. An empty table gives none.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import Rolling, cut, mix, near, runs, slices, text_column, utf8, words

ORDER = 5
LEAST_WORDS, REPEATED = 50, 50
#: Distances beyond the 10th and 90th percentile, and the least distance as a share of the median.
REACH, LEAST_REACH = 2.0, 0.02
#: The least discount, so that every context leaves something to sequences not seen.
LEAST_TAKEN = 0.1
MODEL_ROWS = 4_000_000
#: Parts of a larger model that go to every executor; the documents are read once for each.
PARTS = 16
LANGUAGES = 100_000
#: Texts that occur several times whose hashes are sent to all executors at once.
COPIED_ROWS = 500_000
#: Different sequences that a task gathers before it passes them on.
GATHERED = 2_000_000

_ODD = np.uint64(0xD6E8FEB86659FD93)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _typed(documents: DataFrame) -> DataFrame:
    """(doc_id, lang, text) under fixed names; other columns cannot clash."""
    lang = F.col("lang").cast("string") if "lang" in documents.columns else F.lit("")
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(lang, F.lit("")).alias("lang"), text_column().alias("text"))


def different(documents: DataFrame, most: int = COPIED_ROWS) -> list[DataFrame]:
    """(doc_id, lang, text) without copies of a text with a smaller doc_id, by parts of about `most` texts that occur
    several times: one part, unless there are more of them. Only their hashes move, never the texts."""
    rows = _typed(documents).withColumn("hash", F.xxhash64("lang", "text"))
    copied = cut(rows.groupBy("hash").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")).filter("rows > 1").drop("rows"))
    parts, out = max(1, -(-copied.count() // most)), []
    for k in range(parts):
        mine = F.pmod(F.col("hash"), F.lit(parts)) == k
        joined = rows.filter(mine).join(F.broadcast(copied.filter(mine)), "hash", "left")
        out.append(joined.filter("first IS NULL OR doc_id = first").select("doc_id", "lang", "text"))
    return out


def _grams(buffer: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The last `order` bytes at every byte of every row, the newest lowest, and the rows."""
    n = len(buffer)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    white = _WHITE[buffer]
    spare = np.zeros(n, bool)
    spare[1:] = white[1:] & white[:-1] & (row[1:] == row[:-1])
    row = row[~spare]
    data = np.where(white, np.uint8(32), buffer)[~spare].astype(np.int64)
    first = np.searchsorted(row, np.arange(len(offsets) - 1))
    into = np.arange(len(row)) - first[row]
    gram = data.copy()
    for back in range(1, order):
        gram[back:] += np.where(into[back:] >= back, data[: len(data) - back], 0) << (8 * back)
    return gram, row


def _distinct(gram: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different (group, gram) as one number each, the number of times each occurs, and which of them
    stands at every place."""
    encoded = pa.array((group.astype(np.int64) << (8 * ORDER)) + gram).dictionary_encode()
    keys, code = encoded.dictionary.to_numpy(), encoded.indices.to_numpy()
    return keys, np.bincount(code, minlength=len(keys)), code


def counted(documents: DataFrame, order: int) -> DataFrame:
    """(lang, gram, n): how often each sequence of `order` bytes occurs in the texts of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        size = limit = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, n = (np.concatenate(x) for x in zip(*kept, strict=True))
            order_ = np.argsort(keys)
            keys = keys[order_]
            first = np.flatnonzero(runs(keys))
            return keys[first], np.add.reduceat(n[order_], first)

        def sent(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            lang = pa.DictionaryArray.from_arrays(pa.array(keys >> (8 * ORDER)), pa.array(list(names), pa.string())).cast(pa.string())
            return pa.RecordBatch.from_arrays([lang, pa.array(keys & ((1 << 8 * ORDER) - 1)), pa.array(n)], ["lang", "gram", "n"])

        for batch in slices(batches):
            gram, row = _grams(*utf8(batch.column("text")), order)
            if not len(gram):
                continue
            language = np.array([names.setdefault(x, len(names)) for x in batch.column("lang").to_pylist()])
            kept.append(_distinct(gram, language[row])[:2])
            size += len(kept[-1][0])
            if size > max(GATHERED, limit):
                kept = [merged()]
                size = len(kept[0][0])
                limit = 2 * size
            if size > 2 * GATHERED or len(names) > LANGUAGES:
                yield sent(*merged())
                kept, size, limit = [], 0, 0
                names.clear()
        if kept:
            keys, n = merged()
            for k in range(0, len(keys), 1 << 16):
                yield sent(keys[k : k + (1 << 16)], n[k : k + (1 << 16)])

    return _typed(documents).mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _discounts(table: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3): what is taken from counts of one, two, and three or more."""
    times = [F.count_if(F.col("n") == k).alias(f"n{k}") for k in (1, 2, 3, 4)]
    share = F.col("n1") / F.greatest(F.col("n1") + 2 * F.col("n2"), F.lit(1))

    def taken(k: int) -> Column:
        less = F.when(F.col(f"n{k}") > 0, (k + 1) * share * F.col(f"n{k + 1}") / F.nullif(F.col(f"n{k}"), F.lit(0)))
        return F.least(F.greatest(k - F.coalesce(less, F.lit(0.0)), F.lit(LEAST_TAKEN)), F.lit(float(k))).alias(f"d{k}")

    return table.groupBy("lang").agg(*times).select("lang", *(taken(k) for k in (1, 2, 3)))


def fit(documents: DataFrame | Sequence[DataFrame], order: int = ORDER) -> DataFrame:
    """The model as a table (lang, size, kind, gram, value): kind `p` has the log probability of the last byte of
    a sequence after the others, kind `w` the log weight that a context leaves to its end. The documents may
    come in parts, which are counted one after the other."""
    if not 2 <= order <= ORDER:
        raise ValueError(f"sequences have 2 to {ORDER} bytes")
    parts = [documents] if isinstance(documents, DataFrame) else documents
    counts = [cut(counted(part, order)) for part in parts]
    tables = {order: counts[0] if len(counts) == 1 else cut(reduce(DataFrame.unionByName, counts).groupBy("lang", "gram").agg(F.sum("n").alias("n")))}
    for size in range(order - 1, 0, -1):
        ends = F.col("gram").bitwiseAND(F.lit((1 << 8 * size) - 1))
        tables[size] = cut(tables[size + 1].groupBy("lang", ends.alias("gram")).agg(F.count("*").alias("n")))
    out, shorter = None, None
    for size in range(1, order + 1):
        taken = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        table = tables[size].join(near(cut(_discounts(tables[size])), LANGUAGES), "lang")
        table = table.select("lang", "gram", "n", taken.alias("taken"), F.shiftright("gram", 8).alias("context"))
        weights = table.groupBy("lang", "context").agg(F.sum("n").alias("total"), (F.sum("taken") / F.sum("n")).alias("weight"))
        table = table.join(weights, ["lang", "context"])
        if shorter is None:
            below = table.withColumn("below", F.lit(1 / 256))
        else:
            end = F.col("gram").bitwiseAND(F.lit((1 << 8 * (size - 1)) - 1))
            below = table.withColumn("end", end).join(shorter.select("lang", F.col("gram").alias("end"), F.col("p").alias("below")), ["lang", "end"])
        shorter = cut(below.select("lang", "gram", ((F.col("n") - F.col("taken")) / F.col("total") + F.col("weight") * F.col("below")).alias("p")))
        rows = shorter.select("lang", F.lit(size).alias("size"), F.lit("p").alias("kind"), "gram", F.log("p").alias("value"))
        left = weights.select("lang", F.lit(size - 1).alias("size"), F.lit("w").alias("kind"), F.col("context").alias("gram"), F.log("weight").alias("value"))
        out = rows.unionByName(left) if out is None else out.unionByName(rows).unionByName(left)
    return cut(out)


def _salt(lang: str, size: int, kind: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{kind}{size}{lang}".encode(), digest_size=8).digest(), "little")


@dataclass
class Arrays:
    """The model as sorted hashes of (language, size, kind, gram), and a value for each."""

    order: int
    hashed: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, model: DataFrame) -> Arrays:
        """Hashed and packed in tasks, so that the driver only joins and sorts numbers."""

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                keys = list(zip(*(batch.column(c).to_pylist() for c in ("lang", "size", "kind")), strict=True))
                salts = {k: _salt(*k) for k in set(keys)}
                salt = np.array([salts[k] for k in keys], np.uint64)
                hashed = mix(batch.column("gram").to_numpy().astype(np.uint64) * _ODD + salt)
                packed = [hashed.tobytes(), batch.column("value").to_numpy().tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in packed] + [pa.array([max(k[1] for k in keys)], pa.int32())], ["hashed", "value", "size"])

        rows = model.mapInArrow(pack, "hashed binary, value binary, size int").collect()
        hashed = np.frombuffer(b"".join(r.hashed for r in rows), np.uint64)
        at = np.argsort(hashed)
        return cls(max([r.size for r in rows], default=2), hashed[at], np.frombuffer(b"".join(r.value for r in rows))[at])

    def _found(self, grams: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashed = mix(grams.astype(np.uint64) * _ODD + salt)
        at = np.minimum(np.searchsorted(self.hashed, hashed), len(self.hashed) - 1)
        return self.hashed[at] == hashed, self.values[at]

    def scores(self, grams: np.ndarray, group: np.ndarray, names: list[str]) -> np.ndarray:
        """Log probabilities of the last bytes of sequences, each in the language of its group."""
        out, added, todo = np.zeros(len(grams)), np.zeros(len(grams)), np.arange(len(grams) if len(self.hashed) else 0)
        missing = np.ones(len(grams), bool)
        for size in range(self.order, 0, -1):
            salt = {k: np.array([_salt(x, size - (k == "w"), k) for x in names], np.uint64) for k in "pw"}
            ends = grams[todo] & ((1 << 8 * size) - 1)
            known, value = self._found(ends, salt["p"][group[todo]])
            out[todo[known]] = value[known] + added[todo[known]]
            missing[todo[known]] = False
            todo, ends = todo[~known], ends[~known]
            if not len(todo):
                break
            known, value = self._found(ends >> 8, salt["w"][group[todo]])
            added[todo[known]] += value[known]
        out[missing] = added[missing] - np.log(256)
        return out


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _again(row: np.ndarray, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether an equal entry stands before in the row, and whether one stands anywhere else in it."""
    key = mix(hashed * _ODD + row.astype(np.uint64))
    order = np.argsort(key, kind="stable")
    same = ~runs(key[order])
    other = same.copy()
    other[:-1] |= same[1:]
    before, any_ = np.zeros(len(row), bool), np.zeros(len(row), bool)
    before[order], any_[order] = same, other
    return before, any_


def plain_counts(buffer: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of the plain rules, and a hash of each text."""
    n = len(offsets) - 1
    rolling = Rolling(buffer)
    start, end, row = words(buffer, offsets)
    count = np.bincount(row, minlength=n)
    solid = ~_WHITE[buffer]

    newline = np.flatnonzero(buffer == 10)
    owner = np.searchsorted(offsets, newline, side="right") - 1
    line_row = np.concatenate([np.arange(n), owner])
    begins, ends = np.concatenate([offsets[:-1], newline + 1]), np.concatenate([offsets[1:], newline])
    begins, ends = begins[np.lexsort((begins, line_row))], ends[np.lexsort((ends, line_row))]
    line_row = np.sort(line_row)
    sums = np.concatenate([[0], np.cumsum(solid, dtype=np.int64)])
    filled = sums[ends] > sums[begins]
    line_row, begins, ends = line_row[filled], begins[filled], ends[filled]
    earlier, _ = _again(line_row, rolling.ranges(begins, ends)) if len(line_row) else (np.zeros(0, bool), None)

    repeated = np.zeros(len(row), bool)
    if len(row) > 2:
        word = rolling.ranges(start, end)
        window = np.flatnonzero(row[2:] == row[:-2])
        triple = mix(word[window + 2] * np.uint64(3) + mix(word[window + 1] * np.uint64(5) + mix(word[window])))
        hit = window[_again(row[window], triple)[1]]
        for k in range(3):
            repeated[hit + k] = True
    return {
        "digest": rolling.ranges(offsets[:-1], offsets[1:]).view(np.int64) if len(buffer) else np.zeros(n, np.int64),
        "n_words": count,
        "word_chars": _per_row(solid & ((buffer & 0xC0) != 0x80), offsets),
        "n_symbols": _per_row(_SYMBOL[buffer], offsets),
        "n_dup_lines": np.bincount(line_row[earlier], minlength=n),
        "n_repeat_words": np.bincount(row[repeated], minlength=n),
    }


def _measured(documents: DataFrame, arrays: Arrays | None) -> DataFrame:
    """(doc_id, lang, digest, the plain counts, n_bytes, logs) of every row; without a model the last two are zero."""
    shared = documents.sparkSession.sparkContext.broadcast(arrays)
    names = ["digest", *_COUNTS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            buffer, offsets = utf8(batch.column("text"))
            counts = plain_counts(buffer, offsets)
            if shared.value is None:
                n_bytes, logs = np.zeros(batch.num_rows, np.int64), pa.array(np.zeros(batch.num_rows))
            else:
                gram, row = _grams(buffer, offsets, shared.value.order)
                lang = batch.column("lang").dictionary_encode()
                keys, _, code = _distinct(gram, lang.indices.to_numpy()[row])
                scores = shared.value.scores(keys & ((1 << 8 * ORDER) - 1), keys >> (8 * ORDER), lang.dictionary.to_pylist())
                n_bytes = np.bincount(row, minlength=batch.num_rows)
                logs = pa.array(np.bincount(row, scores[code], batch.num_rows).astype(np.float64))  # whole numbers without rows
            columns = [batch.column("doc_id"), batch.column("lang"), *(pa.array(counts[c]) for c in names), pa.array(n_bytes), logs]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", *names, "n_bytes", "logs"])

    return _typed(documents).mapInArrow(run, f"doc_id long, lang string, {', '.join(f'{c} long' for c in names)}, n_bytes long, logs double")


def _part_of(end: Column | np.ndarray, parts: int) -> Column | np.ndarray:
    """The part of a large model that has the sequences with these two bytes before the last."""
    return end * 40_503 % 65_521 % parts


def _dealt(documents: DataFrame, model: DataFrame, order: int, groups: int, parts: int) -> DataFrame:
    """(lang, digest, n_bytes, logs) of every different text, by parts of the model: `groups` of languages, and `parts` of
    each, which have all sequences up to two bytes."""
    before = F.when(F.col("kind") == "p", F.shiftright("gram", 8)).otherwise(F.col("gram")).bitwiseAND(F.lit(0xFFFF))
    short = F.col("size") < F.when(F.col("kind") == "p", 3).otherwise(2)
    own, sums = F.pmod(F.xxhash64("lang"), F.lit(groups)), []
    for group in range(groups):
        for part in range(parts):
            arrays = Arrays.of(model.filter((own == group) & (short | (_part_of(before, parts) == part))))
            sums.append(_partly(_typed(documents).filter(own == group), arrays, order, parts, part))
    # Copies of a text only add to both sums.
    return reduce(DataFrame.unionByName, sums).groupBy("lang", "digest").agg(F.sum("n_bytes").alias("n_bytes"), F.sum("logs").alias("logs"))


def _partly(typed: DataFrame, arrays: Arrays, order: int, parts: int, part: int) -> DataFrame:
    """(lang, digest, n_bytes, logs): of each text the bytes that this part of the model scores, and their sum."""
    shared = typed.sparkSession.sparkContext.broadcast(arrays)
    mine = _part_of(np.arange(1 << 16), parts) == part

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            buffer, offsets = utf8(batch.column("text"))
            gram, row = _grams(buffer, offsets, order)
            chosen = mine[(gram >> 8) & 0xFFFF]
            gram, row = gram[chosen], row[chosen]
            if not len(gram):
                continue
            lang = batch.column("lang").dictionary_encode()
            keys, _, code = _distinct(gram, lang.indices.to_numpy()[row])
            scores = shared.value.scores(keys & ((1 << 8 * ORDER) - 1), keys >> (8 * ORDER), lang.dictionary.to_pylist())
            digest = Rolling(buffer).ranges(offsets[:-1], offsets[1:]).view(np.int64)
            n_bytes = np.bincount(row, minlength=batch.num_rows)
            columns = [batch.column("lang"), *map(pa.array, (digest, n_bytes, np.bincount(row, scores[code], batch.num_rows)))]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "digest", "n_bytes", "logs"])

    found = cut(typed.mapInArrow(run, "lang string, digest long, n_bytes long, logs double"))
    shared.destroy()
    return found


def _sequences(documents: DataFrame, order: int) -> DataFrame:
    """(lang, digest, gram, n): the different sequences of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            buffer, offsets = utf8(batch.column("text"))
            gram, row = _grams(buffer, offsets, order)
            if len(gram):
                keys, n, _ = _distinct(gram, row)
                digest = pa.array(Rolling(buffer).ranges(offsets[:-1], offsets[1:]).view(np.int64))
                row, gram = pa.array(keys >> (8 * ORDER)), pa.array(keys & ((1 << 8 * ORDER) - 1))
                yield pa.RecordBatch.from_arrays([batch.column("lang").take(row), digest.take(row), gram, pa.array(n)], ["lang", "digest", "gram", "n"])

    return _typed(documents).mapInArrow(run, "lang string, digest long, gram long, n long")


def _joined(documents: DataFrame, model: DataFrame, order: int) -> DataFrame:
    """(lang, digest, n_bytes, logs) of every different text, by joins with the model."""
    # Copies of a text only add to both sums.
    every = cut(_sequences(documents, order).groupBy("lang", "digest", "gram").agg(F.sum("n").alias("n")))
    asked = every.select("lang", "gram").distinct().withColumn("value", F.lit(None).cast("double")).withColumn("added", F.lit(0.0))
    for size in range(order, 0, -1):
        def part(kind: str, of: int) -> DataFrame:
            return model.filter((F.col("kind") == kind) & (F.col("size") == of)).select("lang", F.col("gram").alias("end"), F.col("value").alias("found"))

        end = F.col("gram").bitwiseAND(F.lit((1 << 8 * size) - 1))
        asked = asked.withColumn("end", end).join(part("p", size), ["lang", "end"], "left")
        asked = asked.withColumn("value", F.coalesce("value", F.col("found") + F.col("added"))).drop("found")
        asked = asked.withColumn("end", F.shiftright("end", 8)).join(part("w", size - 1), ["lang", "end"], "left")
        asked = asked.withColumn("added", F.col("added") + F.coalesce("found", F.lit(0.0))).drop("found", "end")
    asked = cut(asked.select("lang", "gram", F.coalesce("value", F.col("added") - F.log(F.lit(256.0))).alias("value")))
    return every.join(asked, ["lang", "gram"]).groupBy("lang", "digest").agg(F.sum("n").alias("n_bytes"), F.sum(F.col("n") * F.col("value")).alias("logs"))


def measured(documents: DataFrame, model: DataFrame, order: int = ORDER, most: int = MODEL_ROWS) -> DataFrame:
    """(doc_id, lang, digest, the plain counts, loss) of every row: `loss` is the log perplexity of a byte, null
    for an empty text."""
    sizes = model.groupBy("size", "kind").count().collect()
    total, short = sum(r["count"] for r in sizes), sum(r["count"] for r in sizes if r["size"] < 2 + (r["kind"] == "p"))
    if total <= most:
        rows = _measured(documents, Arrays.of(model))
    else:
        # So many groups of languages that short sequences are half of a part at most.
        groups = math.ceil(max(1, 2 * short / most))
        parts = math.ceil(max(1, (total - short) / (groups * most - short)))
        known = _dealt(documents, model, order, groups, parts) if groups * parts <= PARTS else _joined(documents, model, order)
        rows = _measured(documents, None).drop("n_bytes", "logs").join(known, ["lang", "digest"], "left")
    return rows.select("doc_id", "lang", "digest", *_COUNTS, F.when(F.col("n_bytes") > 0, -F.col("logs") / F.col("n_bytes")).alias("loss"))


def bands(rows: DataFrame) -> DataFrame:
    """(lang, lower, upper) of log perplexities, from different texts that pass the plain rules."""
    single = rows.filter(~failed() & F.col("loss").isNotNull()).groupBy("lang", "digest").agg(F.min("loss").alias("loss"))
    spread = single.groupBy("lang").agg(F.percentile_approx("loss", [0.1, 0.5, 0.9], 10_000).alias("at"))
    low, mid, high = (F.col("at")[k] for k in range(3))
    least = LEAST_REACH * mid
    below = F.greatest(mid - low, (high - mid) / 2, least)
    above = F.greatest(high - mid, (mid - low) / 2, least)
    return spread.select("lang", (low - REACH * below).alias("lower"), (high + REACH * above).alias("upper"))


def failed() -> Column:
    """The plain rules: too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words"))


def judged(documents: DataFrame, order: int = ORDER) -> DataFrame:
    """(doc_id, the plain counts, base_failed, kept, perplexity) of every row, by a model of all of them."""
    rows = cut(measured(documents, fit(different(documents), order), order))
    fenced = rows.join(near(cut(bands(rows)), LANGUAGES), "lang", "left")
    inside = F.coalesce(F.col("loss").between(F.col("lower"), F.col("upper")), F.lit(False))
    return fenced.select("doc_id", *_COUNTS, failed().alias("base_failed"), (~failed() & inside).alias("kept"), F.exp("loss").alias("perplexity"))

"""Toxicity classifier: boosted trees over dense features, with isotonic scores.

Features of a text count what its words are, not where they come from: densities of two lexicons, how
near their words stand to second-person pronouns, capitals, punctuation, and words that are spelled
around a filter. One lexicon is a fixed list of insults; the other is learnt: words, and beginnings of
words (`PREFIXES` bytes), whose share of toxic labelled texts is far above that of others. Spelling is
undone for tokens with digits, signs or long runs of one letter inside, before they are looked up.

Boosted trees are fitted on a bounded sample (see `labelled`), isotonic regression on rows that the
trees have not seen gives the shares of label 1. Scoring needs one pass over the texts.

Results: a null text is an empty text; every text gets a score. Without labelled rows every score is
0.5; if all have one label, it is that label.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import Rolling, cut, id_text, mix, runs, slices, text_column, utf8, words
from kerbside.llm.labelled import FIT_ROWS, calibration, sample
from kerbside.session import ensure_checkpoint_dir

#: Insults of common use, and pronouns of the second person.
INSULTS = """clown coward creep crap damn dumb dumbass failure filth fool freak garbage hate idiot idiotic
imbecile jerk kill liar loser lunatic moron moronic pathetic pig psycho rubbish scum shit stupid sucker
trash ugly useless vermin vile worthless disgusting dummkopf arschloch abschaum connard salaud crétin
estúpido imbécil basura""".split()
PRONOUNS = "you your yours yourself u ur du dich dir dein deine tu te toi ton vous votre tú ti usted vosotros".split()
PREFIXES = (4, 5, 6)
#: A learnt unit stands in this many toxic texts at least, with a share this much above that of others.
LEAST = 4
LIFT = 12.0
#: Learnt units kept, best first.
LEARNT = 20_000
NEAR = 5
ROUNDS = 30
DEPTH = 3
SEED = 9

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
#: Signs and digits that stand for letters; other signs between letters are left out.
_SPELLED = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l", "+": "t"})
_BETWEEN = np.zeros(256, bool)
_BETWEEN[list(b"0134578@$!|+*.-_#%")] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def _folded(buffer: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and for the letters of Latin-1."""
    out = _FOLD[buffer]
    second = np.zeros(len(buffer), bool)
    second[1:] = (buffer[:-1] == 0xC3) & (buffer[1:] >= 0x80) & (buffer[1:] <= 0x9E) & (buffer[1:] != 0x97)
    out[second] += 32
    return out


def _letter_runs(buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of letters."""
    blanked = np.where(_LETTER[buffer], buffer, np.uint8(32))
    return words(blanked, offsets)


def _hash_words(texts: list[str]) -> np.ndarray:
    raw = [t.encode() for t in texts]
    buffer = _folded(np.frombuffer(b"".join(raw), np.uint8))
    edges = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return Rolling(buffer).ranges(edges[:-1], edges[1:])


def _units(rolling: Rolling, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(words, hash) for whole words and for each length of beginnings."""
    yield np.arange(len(start)), rolling.ranges(start, end)
    for n in PREFIXES:
        long = np.flatnonzero(end - start > n)
        yield long, mix(rolling.ranges(start[long], start[long] + n) + np.uint64(n))


def _respelled(buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """Row and undone spelling of tokens with signs between letters or three equal letters in a row."""
    letter = _LETTER[buffer]
    odd = np.zeros(len(buffer), bool)
    if len(buffer) > 2:
        sign = _BETWEEN[buffer]
        behind = letter[2:].copy()  # a letter after the sign, or after one more
        behind[:-1] |= sign[2:-1] & letter[3:]
        between = sign[1:-1] & letter[:-2] & behind
        tripled = letter[1:-1] & (buffer[1:-1] == buffer[:-2]) & (buffer[1:-1] == buffer[2:]) & (buffer[1:-1] < 128)
        odd[1:-1] = between | tripled
    start, end, row = words(buffer, offsets)
    if not odd.any() or not len(start):
        return np.zeros(0, np.int64), []
    hit = np.unique(np.searchsorted(start, np.flatnonzero(odd), side="right") - 1)
    raw = buffer.tobytes()
    out = []
    for k in hit:
        text = raw[start[k] : end[k]].decode("utf-8", "replace").lower().strip(".,;:!?\"'()*-_").translate(_SPELLED)
        plain = "".join(c for c in text if c.isalpha())
        out.append("".join(c for k, c in enumerate(plain) if k < 2 or not c == plain[k - 1] == plain[k - 2]))
    # "idiooot" may be meant with one letter or with two.
    return np.concatenate([row[hit], row[hit]]), out + ["".join(c for k, c in enumerate(t) if k == 0 or c != t[k - 1]) for t in out]


@dataclass
class Lexicon:
    """Sorted hashes of learnt units with their weights, of the fixed insults, and of pronouns."""

    learnt: np.ndarray
    weight: np.ndarray
    fixed: np.ndarray
    pronouns: np.ndarray

    def lookup(self, hashed: np.ndarray) -> np.ndarray:
        if not len(self.learnt):
            return np.zeros(len(hashed))
        at = np.minimum(np.searchsorted(self.learnt, hashed), len(self.learnt) - 1)
        return np.where(self.learnt[at] == hashed, self.weight[at], 0.0)


def features(buffer: np.ndarray, offsets: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    """One row of numbers for each text."""
    n = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1)
    start, end, row = _letter_runs(buffer, offsets)
    count = np.maximum(np.bincount(row, minlength=n), 1)
    total = lambda at, values=None: np.bincount(at, values, minlength=n).astype(np.float64)
    weight, fixed, pronoun = np.zeros(len(start)), np.zeros(len(start), bool), np.zeros(len(start), bool)
    if len(start):
        rolling = Rolling(_folded(buffer))
        for k, (which, hashed) in enumerate(_units(rolling, start, end)):
            weight[which] = np.maximum(weight[which], lexicon.lookup(hashed))
            if not k:
                fixed, pronoun = np.isin(hashed, lexicon.fixed), np.isin(hashed, lexicon.pronouns)
    hit = np.flatnonzero((weight > 0) | fixed)
    at = np.flatnonzero(pronoun)
    close = np.zeros(len(hit), bool)
    if len(hit) and len(at):
        for side in (0, -1):
            other = at[np.clip(np.searchsorted(at, hit) + side, 0, len(at) - 1)]
            close |= (np.abs(other - hit) <= NEAR) & (row[other] == row[hit])
    again, spelled = _respelled(buffer, offsets)
    undone = np.zeros(len(again))
    if spelled:
        hashed = _hash_words(spelled)
        undone = np.maximum(lexicon.lookup(hashed), np.isin(hashed, lexicon.fixed).astype(float) * 4)
    strongest = np.zeros(n)
    np.maximum.at(strongest, row, weight)
    np.maximum.at(strongest, again, undone)
    upper = (buffer >= 65) & (buffer <= 90)
    place = np.repeat(np.arange(n), np.diff(offsets))
    columns = [
        np.minimum(total(row[weight > 0]), 50),
        total(row[weight > 0]) / count,
        total(row, weight) / count,
        strongest,
        np.minimum(total(row[fixed]), 50),
        total(row[fixed]) / count,
        np.minimum(total(row[hit][close]), 50),
        total(again[undone > 0]),
        total(again) / 2 / count,
        total(place, upper) / size,
        total(place, _PUNCTUATION[buffer]) / size,
        total(place, buffer == 33) / size,
        np.log1p(np.bincount(row, minlength=n)),
    ]
    return np.stack(columns, axis=1)


def _added(units: np.ndarray, *counts: np.ndarray) -> list[np.ndarray]:
    """Each unit once, with the sums of its counts."""
    order = np.argsort(units, kind="stable")
    begin = np.flatnonzero(runs(units[order]))
    return [units[order][begin], *(np.add.reduceat(c[order], begin) for c in counts)]


def learn(known: DataFrame) -> Lexicon:
    """Units of the labelled rows (label, text) that mark toxic texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many texts of each label hold a unit, added up over about a million units at a time."""
        held, size = [], 0
        for batch in slices(batches):
            buffer, offsets = utf8(batch.column("text"))
            label = batch.column("label").to_numpy().astype(np.int64)
            start, end, row = _letter_runs(buffer, offsets)
            if not len(start):
                continue
            rows, units = zip(*((row[which], hashed) for which, hashed in _units(Rolling(_folded(buffer)), start, end)), strict=True)
            rows, units = np.concatenate(rows), np.concatenate(units)
            order = np.lexsort((rows, units))
            once = order[runs(units[order], rows[order])]
            held.append(_added(units[once], label[rows[once]], 1 - label[rows[once]]))
            size += len(held[-1][0])
            if size > 1_000_000:
                held = [_added(*(np.concatenate(c) for c in zip(*held, strict=True)))]
                if len(held[0][0]) > 500_000:
                    yield packed(held.pop())
                size = sum(len(h[0]) for h in held)
        if held:
            yield packed(_added(*(np.concatenate(c) for c in zip(*held, strict=True))))

    def packed(sums: list[np.ndarray]) -> pa.RecordBatch:
        units, toxic, clean = sums
        return pa.RecordBatch.from_arrays([pa.array(units.view(np.int64)), pa.array(toxic), pa.array(clean)], ["unit", "toxic", "clean"])

    sizes = known.agg(F.sum("label"), F.count("*")).first()
    toxic, clean = sizes[0] or 0, sizes[1] - (sizes[0] or 0)
    seen = known.select("label", "text").mapInArrow(run, "unit long, toxic long, clean long").groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    lift = (F.col("toxic") + 0.5) / (toxic + 1) / ((F.col("clean") + 0.5) / (clean + 1))
    best = seen.withColumn("lift", lift).filter((F.col("toxic") >= LEAST) & (F.col("lift") >= LIFT)).orderBy(F.desc("lift"), "unit").limit(LEARNT).collect()
    units = np.array([r["unit"] for r in best], np.int64).view(np.uint64)
    order = np.argsort(units)
    weights = np.log(np.array([r["lift"] for r in best], np.float64))
    return Lexicon(units[order], weights[order], np.sort(_hash_words(INSULTS)), np.sort(_hash_words(PRONOUNS)))


@dataclass
class Model:
    lexicon: Lexicon | None = None
    trees: GBTClassificationModel | None = None
    shares: IsotonicRegressionModel | None = None
    constant: float | None = None


def _featured(frame: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The rows with the features of each text; only the texts go through Python."""

    def numbers(texts: pa.Array) -> pa.Array:
        parts = [pa.array([], pa.list_(pa.float64()))]
        for batch in slices(iter([pa.RecordBatch.from_arrays([texts], ["text"])])):
            parts.append(pa.array(list(features(*utf8(batch.column("text")), lexicon)), pa.list_(pa.float64())))
        return pa.concat_arrays(parts)

    return frame.withColumn("numbers", F.arrow_udf(numbers, "array<double>")("text"))


def fit(documents: DataFrame, labels: DataFrame, label_col: str = "toxic", rows: int = FIT_ROWS) -> Model:
    ensure_checkpoint_dir(documents.sparkSession)
    known = cut(sample(documents, labels, label_col, rows).select("label", "calibrates", "text"))
    seen = {r["calibrates"]: r for r in known.groupBy("calibrates").agg(F.count("*").alias("n"), F.sum("label").alias("ones")).collect()}
    total, ones = sum(r["n"] for r in seen.values()), sum(r["ones"] for r in seen.values())
    if not total or ones in (0, total):
        return Model(constant=ones / total if total else 0.5)
    # Few labelled rows may leave the fit without one of the labels, or nothing to calibrate on.
    mixed = False in seen and 0 < seen[False]["ones"] < seen[False]["n"]
    ready = known.filter("NOT calibrates") if mixed else known
    lexicon = learn(ready)
    numbers = cut(_featured(known, lexicon).select("label", "calibrates", array_to_vector("numbers").alias("features")))
    trees = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, stepSize=0.2, seed=SEED, minInstancesPerNode=3)
    trees = trees.fit(numbers.filter("NOT calibrates") if mixed else numbers)
    held = numbers.filter("calibrates") if True in seen and mixed else numbers
    return Model(lexicon, trees, calibration(cut(_raw(held, trees).select("raw", "label"))))


def _raw(frame: DataFrame, trees: GBTClassificationModel) -> DataFrame:
    return trees.transform(frame).withColumn("raw", vector_to_array("probability")[1])


def score(documents: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    rows = id_text(documents, id_col, text_col)
    if model.constant is not None:
        return rows.select("doc_id", F.lit(float(model.constant)).alias("score"))
    return _scored(rows, model).select("doc_id", "score")


def _scored(rows: DataFrame, model: Model) -> DataFrame:
    raw = _raw(_featured(rows, model.lexicon).drop("text").withColumn("features", array_to_vector("numbers")), model.trees)
    return model.shares.transform(raw).withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "share")))


def clean(documents: DataFrame, model: Model, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows whose score is below the threshold, all columns as they are."""
    if model.constant is not None:
        return documents if model.constant < threshold else documents.limit(0)
    rows = documents.select(F.struct("*").alias("row"), text_column(text_col).alias("text"))
    return _scored(rows, model).filter(F.col("score") < threshold).select("row.*")

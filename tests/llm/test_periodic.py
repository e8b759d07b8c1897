"""Periodic runs of words against a check of all lags."""

import hashlib
import re
import zlib
from collections import Counter

import cases
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kerbside.llm import periodic, queries


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def runs_by_hand(w, least=24, times=3):
    """Every lag from the smallest: stretches that a smaller one has found are skipped."""
    known = {}
    for q in range(1, len(w) // times + 1):
        equal = 0
        for i in range(q, len(w) + 1):
            if i < len(w) and w[i] == w[i - q]:
                equal += 1
                continue
            if equal + q >= max(least, times * q):
                known.setdefault((i - equal - q, equal + q), q)
            equal = 0
    return sorted((s, n, q) for (s, n), q in known.items())


def kept_by_hand(w, runs):
    dropped = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(x for k, x in enumerate(w) if k not in dropped)


def found(words, **options):
    codes = np.array([zlib.crc32(x.encode()) * 7919 + 5 for x in words], np.uint64)
    return [tuple(r[1:]) for r in periodic.found(codes, np.zeros(len(words), np.int64), **options).tolist()]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text("ab", min_size=1, max_size=9), st.integers(1, 40)), max_size=6))
def test_runs_of_two_letters(pieces):
    w = [c for text, n in pieces for c in text * n][:400]
    assert found(w) == runs_by_hand(w)
    assert found(w, least=16, times=4) == runs_by_hand(w, 16, 4)


def test_a_slice_of_fewer_words_than_a_first_sequence():
    assert all(found(["a"] * n) == [] for n in range(12))


def test_runs_inside_runs_and_at_every_scale():
    word = lambda k: f"w{k}"
    inner = ["x"] * 30 + [word(k) for k in range(11)]  # a run of period one in every period of another
    w = [word(90)] + inner * 4 + [word(91)]
    assert (1, 164, 41) in found(w) and (1, 30, 1) in found(w) and found(w) == runs_by_hand(w)
    for q in [*range(1, 36), 63, 64, 65, 127, 128, 129, 200]:
        for length in (max(24, 3 * q) - 1, max(24, 3 * q), 5 * q + 3):
            w = [word(k + 1000) for k in range(9)] + [word(k % q) for k in range(length)] + [word(k + 2000) for k in range(9)]
            assert found(w) == runs_by_hand(w), (q, length)


def test_overlapping_runs():
    w = list("aab" * 10 + "aabaab" * 2 + "baa" * 12 + "ab" * 30 + "a" * 50 + "abcabcabd" * 6)
    assert found(w) == runs_by_hand(w) and len(found(w)) > 4


def test_words_of_other_rows_do_not_count():
    word = np.array([5] * 20 + [5] * 30 + [6, 5] * 11, np.uint64)
    row = np.repeat([0, 1, 3], [20, 30, 22])
    assert periodic.found(word, row).tolist() == [[1, 0, 30, 1]]
    with pytest.raises(ValueError):
        periodic.found(word, row, times=2)


def test_odd_documents(spark):
    rows = [*cases.ODD, (20, "same " * 100), (21, "\n\ta b\x0bc " * 30 + "end"), (22, "é 漢 " * 40 + cases.prose(1, 50) + " x" * 24), (23, "y " * 23)]
    got = periodic.collapse(cases.documents(spark, rows))
    assert got.columns == ["doc_id", "n_words", "runs", "text"]
    expected = Counter()
    for i, text in rows:
        w = words_of(text)
        runs = runs_by_hand(w) if len(w) < 1000 else []
        expected[i, len(w), tuple(runs), kept_by_hand(w, runs)] += 1
    assert Counter((r.doc_id, r.n_words, tuple(tuple(x) for x in r.runs), r.text) for r in got.collect()) == expected
    assert sum(len(k[2]) for k in expected) == 4
    assert periodic.collapse(cases.empty(spark)).count() == 0


def test_a_long_text_of_repeats_is_linear():
    w = np.tile(np.arange(7, dtype=np.uint64) * np.uint64(99991), 200_000)
    assert periodic.found(w, np.zeros(len(w), np.int64)).tolist() == [[0, 0, 1_400_000, 7]]


def looped(i, text):
    w = words_of(text)
    h, n = (zlib.crc32(str(i).encode()), len(w)) if i is not None else (1, 0)
    if h % 10 == 0 and n:
        a = (h // 10) % n
        p = 1 + (n - a) // (3 + (h // 10) % 8)
        w = w[:a] + [w[a + (j - a) % p] for j in range(a, n)]
    return w


def check(frame, rows):
    expected = Counter()
    for i, text in rows:
        w = looped(i, text)
        runs = runs_by_hand(w)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
        milli = 1000 * best[1] // best[2] if runs else None
        digests = (hashlib.sha256(t.encode()).hexdigest() for t in ("".join(f"{s},{n},{q}\n" for s, n, q in runs), kept_by_hand(w, runs)))
        expected[i, len(runs), *best, milli, *digests] += 1
    assert Counter(tuple(r) for r in frame.collect()) == expected
    return sum(n for k, n in expected.items() if k[1])


def test_op12_on_a_table(spark, sf_dir, tmp_path):
    whole = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = queries.op12_periodic(spark, sf_dir)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2
    rows = [(r.doc_id, r.text) for r in whole.collect()]
    assert {r.doc_id for r in got.collect()} == {i for i, _ in rows}
    short = {i for i, text in rows if len(text or "") < 6000}
    assert check(got.filter(got.doc_id.isin(short)), [r for r in rows if r[0] in short]) >= 5

    odd = [(i, t) for i, t in cases.ODD if len(t or "") < 5000] + [(k, "\v a  b\tc " * 12) for k in range(40)]
    cases.documents(spark, odd).write.parquet(str(tmp_path / "documents.parquet"))
    check(queries.op12_periodic(spark, str(tmp_path)), odd)

"""Importance resampling against plain Python and SQL."""

import hashlib
import math
import re
import zlib
from collections import Counter

import cases
import pytest

import oracle_check
from kerbside.llm import queries, resample

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def features_of(text, longest):
    w = words_of(text)
    return Counter(" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1))


def bucket(feature, buckets):
    return zlib.crc32(feature.encode()) % buckets


def by_hand(rows, target, longest=1, percent=10, least_words=20, buckets=10_000):
    """A multiset of (doc_id, n_features, weight, score), and the ranks of each in order."""
    source, aim = Counter(), Counter()
    for table, sums in ((rows, source), (target, aim)):
        for _, text in table:
            for f, n in features_of(text, longest).items():
                sums[bucket(f, buckets)] += n
    all_s, all_t = sum(source.values()), sum(aim.values())
    out = []
    for i, text in rows:
        features = features_of(text, longest)
        n = sum(features.values())
        total = 0
        for f, k in features.items():
            b = bucket(f, buckets)
            total += k * math.floor(1000 * math.log((aim[b] + 1) * (all_s + buckets) / ((source[b] + 1) * (all_t + buckets))))
        weight = total // n if n else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(words_of(text)), n, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= least_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[1:]))
    drawn = len(able) * percent // 100
    return Counter((*r, k + 1) for k, r in enumerate(able[:drawn])) + Counter((*r, None) for r in able[drawn:]) + Counter(
        (*r, None) for r in out if r[1] < least_words
    )


def as_rows(frame):
    return Counter((r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in frame.collect())


@pytest.mark.parametrize(("longest", "percent"), [(1, 10), (2, 60), (3, 100)])
def test_odd_documents(spark, longest, percent):
    target = [(1, cases.prose(8, 80)), (2, None), (3, "漢字 É é")]
    got = resample.resample(cases.odd(spark), cases.documents(spark, target), longest, percent, buckets=97)
    assert as_rows(got) == by_hand(cases.ODD, target, longest, percent, buckets=97)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]


def test_the_head_changes_nothing(spark):
    rows = [(k, f"{cases.prose(k, 60)} the The of {'common words ' * (k % 7)}") for k in range(80)]
    documents, target = cases.documents(spark, rows), cases.documents(spark, rows[:9])
    known = resample.head(documents, 2, share=0.01)
    assert {b"the", b"common", b"words", b"common words", b"words common"} <= set(known)
    assert all(state == zlib.crc32(feature) for feature, state in known.items())
    few = dict(sorted(known.items())[:3])
    sums = [resample.totals(documents, k, 2, 50).tolist() for k in ({}, few, known)]
    assert sums[0] == sums[1] == sums[2] and sum(sums[0]) == sum(sum(features_of(t, 2).values()) for _, t in rows)
    assert as_rows(resample.resample(documents, target, 2, 25)) == by_hand(rows, rows[:9], 2, 25)


def test_the_head_holds_every_frequent_word_however_its_rows_lie(spark):
    rows = [(k, " ".join(f"w{k}x{j}" for j in range(400)) + (" often" * 8 if k % 3 else " rare" * (k == 0))) for k in range(60)]
    known = resample.head(cases.documents(spark, rows), 1, share=0.005, most=10)
    assert list(known) == [b"often"]


def test_empty_tables(spark):
    nothing = cases.empty(spark)
    assert resample.resample(nothing, cases.odd(spark)).count() == 0
    assert as_rows(resample.resample(cases.odd(spark), nothing)) == by_hand(cases.ODD, [])
    short = [(k, "too short") for k in range(5)]
    assert as_rows(resample.resample(cases.documents(spark, short), nothing)) == by_hand(short, [])


def test_many_equal_scores_are_ranked_by_doc_id(spark):
    rows = [(None, cases.prose(1, 30)) for _ in range(40)] + [(k, cases.prose(1, 30)) for k in range(40)]
    got = as_rows(resample.resample(cases.documents(spark, rows), cases.empty(spark), percent=100))
    assert got == by_hand(rows, [], percent=100)


def test_op11_on_the_table(spark, sf_dir):
    got = queries.op11_resample(spark, sf_dir)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in got.dtypes} == {"bigint"}
    assert oracle_check.compare(oracle_check.database(sf_dir), got, queries.SQL["op11_resample"]) == []
    tables = ([(r[0], r.text) for r in spark.read.parquet(f"{sf_dir}/{t}.parquet").collect()] for t in ("documents", "benchmark"))
    assert Counter(tuple(r) for r in got.collect()) == Counter((i, n, w, s, k) for i, _, n, w, s, k in by_hand(*tables).elements())

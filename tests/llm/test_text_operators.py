"""Fingerprints, repeated strings, the Jaccard join and packing against brute force."""

import base64
import collections
import hashlib
import re
from pathlib import Path

import cases
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from kerbside.llm import fingerprint, ngram_join, packing, queries, substrings
from kerbside.session import shared_root


def texts_of(rows):
    return [(i, t or "") for i, t in rows]


# --- fingerprints ---


def test_fingerprints_are_sums_of_paragraphs():
    a, b, c = b"one two three four", b"five six seven", b"eight"
    whole, parts = fingerprint.vectors([b"\n".join([a, b, c])])[0], fingerprint.vectors([a, b, c])
    assert (whole == fingerprint.add(fingerprint.add(parts[0], parts[1]), parts[2])).all()
    assert (whole == fingerprint.vectors([b"\n".join([c, a, b])])[0]).all()  # any order
    assert (fingerprint.subtract(whole, parts[1]) == fingerprint.vectors([a + b"\n" + c])[0]).all()
    assert (whole != fingerprint.vectors([b"\n".join([a, b, c, c])])[0]).any()  # a multiset, not a set
    assert not fingerprint.vectors([b"", b" \n "]).any()


def test_likeness_follows_the_shared_part():
    base = [cases.prose(k, 60) for k in range(10)]
    full = "\n".join(base).encode()
    for kept in range(0, 11, 2):
        other = "\n".join(base[:kept] + [cases.prose(100 + k, 60) for k in range(kept, 10)]).encode()
        lanes = fingerprint.vectors([full, other])
        assert fingerprint.likeness(lanes[0], lanes[1]) == pytest.approx(kept / 10, abs=0.25)
    zero = fingerprint.vectors([b"", b"x"])
    assert fingerprint.likeness(zero[0], zero[0]) == 1 and fingerprint.likeness(zero[0], zero[1]) == 0


def edited_by_hand(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    out = []
    for k, (i, text) in enumerate(order):
        half = len(text) // 2
        out.append((i, len(text), hashlib.sha256((text[: len(text) - half] + order[(k + 1) % len(order)][1][:half]).encode()).hexdigest()))
    return collections.Counter(out)


def test_edits_of_odd_documents(spark):
    got = fingerprint.edits(cases.odd(spark)).collect()
    assert collections.Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == edited_by_hand(texts_of(cases.ODD))
    by_id = collections.defaultdict(set)
    for r in got:
        by_id[r.doc_id].add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert len(base64.b64decode(r.fingerprint)) == 4 * (fingerprint.EXACT + fingerprint.SKETCH)
    assert by_id[6] == by_id[7] and by_id[1] == by_id[2] == by_id[3]
    assert fingerprint.edits(cases.empty(spark)).count() == 0
    alone = fingerprint.edits(cases.documents(spark, [(5, "abcd")])).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abab").hexdigest()


def test_op1_on_the_table(spark, sf_dir):
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = queries.op1_fingerprint(spark, sf_dir).collect()
    assert collections.Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == edited_by_hand(rows)
    assert np.mean([r.near_edited for r in got]) > 0.4 > 0.1 > np.mean([r.near_next for r in got])
    assert {r.doc_id: r.fingerprint for r in got} == {
        r.doc_id: base64.b64encode(r.fingerprint).decode() for r in fingerprint.fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    }


# --- repeated strings ---


def repeats_by_hand(rows):
    """Rows (doc_id, text), repeated rows once; the order among texts of one doc_id is that of the operator."""
    seen, out = set(), {}
    for key, text in rows:
        raw = text.encode()
        removed = bytearray(len(raw))
        for p in range(len(raw) - 99):
            window = raw[p : p + 100]
            if window in seen:
                removed[p : p + 100] = b"\1" * 100
            seen.add(window)
        kept = bytes(c for c, r in zip(raw, removed, strict=True) if not r)
        spans = sum(1 for k in range(len(raw)) if removed[k] and (not k or not removed[k - 1]))
        out[key] = (len(raw), sum(removed), spans, kept)
    return out


def cut(frame):
    return [(r.doc_id, (r.n_bytes, sum(s.end - s.begin for s in r.removed), len(r.removed), bytes(r.kept))) for r in substrings.cut_repeats(frame).collect()]


def test_repeats_of_planted_strings(spark):
    rng = np.random.default_rng(3)
    letters = lambda n: "".join(rng.choice(list("abcdeé \n"), n))
    shared = [letters(n) for n in (99, 100, 101, 150, 400, 3000)]
    rows = [(i, "".join(letters(int(rng.integers(0, 120))) + shared[int(rng.integers(len(shared)))][int(rng.integers(0, 60)) :] for _ in range(4))) for i in range(60)]
    rows += [(100, "ab" * 900), (101, "x" * 5000), (102, "ab" * 300 + "x" * 300), (103, rows[5][1]), (104, rows[5][1][1:])]
    assert dict(cut(cases.documents(spark, rows))) == repeats_by_hand(rows)


def test_repeats_across_segments(spark, monkeypatch):
    monkeypatch.setattr(substrings, "SEGMENT", 700)
    monkeypatch.setattr(substrings, "GATHERED", 50)
    text = cases.prose(1, 800)
    rows = [(1, text), (2, cases.prose(2, 300) + text[1000:4000] + cases.prose(3, 300)), (3, text[:2000] * 3)]
    assert dict(cut(cases.documents(spark, rows))) == repeats_by_hand(rows)


def test_repeats_of_odd_documents(spark):
    got = cut(cases.odd(spark))
    assert len(got) == len(cases.ODD)
    by_id = collections.defaultdict(list)
    for i, result in got:
        by_id[i].append(result)
    whole = cases.prose(6, 300).encode()
    assert by_id[6] == [(len(whole), 0, 0, whole)]
    assert by_id[7] == [(len(whole), len(whole), 1, b"")] * 2  # listed twice, judged once
    assert by_id[1] == by_id[2] == [(0, 0, 0, b"")]
    assert sorted(r[1] for r in by_id[8]) == [0, 0]  # two texts of one doc_id without a common string
    assert [r[1] for r in by_id[None]] == [0, 0]  # the same row twice
    assert by_id[11] == [repeats_by_hand([(11, cases.ODD[12][1])])[11]] and by_id[11][0][2] == 2  # inside one document
    assert substrings.cut_repeats(cases.empty(spark)).count() == 0


def test_texts_without_repeats_stay_texts(spark):
    frame = substrings.without_repeats(cases.odd(spark))
    assert frame.columns == cases.odd(spark).columns and frame.schema["text"].dataType.typeName() == "string"
    rows = frame.collect()
    assert [r.text for r in rows if r.doc_id == 1] == [None]
    assert all(r.hub == "own hub" and r.rest == "own rest" for r in rows)
    assert [r.text for r in rows if r.doc_id == 4] == ["one"]
    assert all("�" not in (r.text or "") for r in rows)


def test_op3_on_the_table(spark, sf_dir):
    rows = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    expected = {i: (n, m, s, hashlib.sha256(kept).hexdigest()) for i, (n, m, s, kept) in repeats_by_hand(rows).items()}
    got = queries.op3_substrings(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == expected


# --- Jaccard join ---


def shingle_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1)))


def groups_by_hand(rows, size, percent):
    sets = collections.defaultdict(list)
    for i, text in rows:
        sets[i].append(shingle_set(text, size))
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                u, v = root(a), root(b)
                parent[max(u, v)] = min(u, v)
    return collections.Counter((i, len(s), root(i)) for i in sets for s in sets[i])


def joined(frame, size, percent):
    return collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.linked(frame, size, percent).collect())


def changed(text, edits, seed):
    words = text.split(" ")
    rng = np.random.default_rng(seed)
    for at in rng.integers(0, len(words), edits):
        words[int(at)] = f"new{rng.integers(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_groups_of_near_copies(spark, size, percent):
    rng = np.random.default_rng(size)
    rows = []
    for family in range(12):
        base = cases.prose(family + 50, int(rng.integers(3, 160)))
        rows += [changed(base, int(rng.integers(0, 6)), 31 * family + k) for k in range(12)]
    passage = cases.prose(999, 40)
    rows += [cases.prose(2000 + k, 30) + " " + passage + " " + cases.prose(3000 + k, int(rng.integers(1, 40))) for k in range(40)]
    rows += [" ".join(cases.WORDS[: k % 9]) for k in range(30)] + [f"short {k % 3}" for k in range(9)]
    rows = list(enumerate(rows))
    assert joined(cases.documents(spark, rows), size, percent) == groups_by_hand(rows, size, percent)


def test_a_crowd_of_near_copies_needs_all_rounds(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    base = cases.prose(77, 110)
    rows = [(k, changed(base, 1 + k % 5, k)) for k in range(160)] + [(500 + k, base) for k in range(20)]
    assert joined(cases.documents(spark, rows), 4, 85) == groups_by_hand(rows, 4, 85)


def test_groups_of_odd_documents(spark):
    rows = [r for r in texts_of(cases.ODD) if r[0] is not None]
    expected = groups_by_hand(rows, 4, 85)
    expected[(None, 97, None)] = 2
    assert joined(cases.odd(spark), 4, 85) == expected
    assert ngram_join.linked(cases.empty(spark)).count() == 0
    blank = cases.documents(spark, [(1, ""), (2, None)])
    assert joined(blank, 4, 85) == collections.Counter([(1, 0, 1), (2, 0, 2)])


def test_one_of_each_group_stays(spark):
    kept = ngram_join.without_copies(cases.odd(spark))
    assert kept.columns == cases.odd(spark).columns
    ids = collections.Counter(r.doc_id for r in kept.collect())
    # Two different texts of one doc_id are two documents.
    assert 7 not in ids and ids[6] == ids[1] == ids[2] == 1 and ids[8] == ids[None] == 2
    assert ngram_join.without_copies(cases.empty(spark)).count() == 0


def test_only_copies_go_where_doc_ids_repeat(spark):
    first, other = cases.prose(40, 90), cases.prose(41, 90)
    rows = [(5, None), (5, first), (6, other), (6, cases.prose(42, 90)), (7, changed(first, 1, 3)), (8, other), (8, other), (9, "own"), (9, "own"), (None, first)]
    kept = ngram_join.without_copies(cases.documents(spark, rows)).collect()
    assert collections.Counter((r.doc_id, r.text) for r in kept) == collections.Counter([*rows[:4], (9, "own"), (None, first)])
    assert all(r.hub == "own hub" for r in kept)


def passages(n, shared, own):
    """Texts around one passage, no two of which link: all other words are their own."""
    passage = cases.prose(4242, shared)
    word = lambda k, j: f"w{k}x{j}"
    return [(k, " ".join([*(word(k, j) for j in range(own // 2)), passage, *(word(k, j) for j in range(own // 2, own))])) for k in range(n)]


@pytest.mark.parametrize(("size", "percent", "shared"), [(4, 85, 44), (5, 80, 36)])
def test_a_shared_passage_makes_few_candidates(spark, monkeypatch, size, percent, shared):
    """Most of every text is the same passage: few of the documents meet any other."""
    met = []
    blocks = ngram_join._blocks
    monkeypatch.setattr(ngram_join, "_blocks", lambda around, *rest: met[-1].append(around.count()) or blocks(around, *rest))
    for n in (500, 2000):
        met.append([])
        rows = passages(n, shared, 66 - shared) + [(n + k, changed(text, 1, k)) for k, (_, text) in enumerate(passages(20, shared, 66 - shared))]
        got = joined(cases.documents(spark, rows), size, percent)
        linked_ = {i: c for i, _, c in got if i != c}
        shingled = {i: shingle_set(t, size) for i, t in rows}
        near = {n + k: k for k in range(20) if 100 * len(shingled[k] & shingled[n + k]) >= percent * len(shingled[k] | shingled[n + k])}
        assert len(got) == n + 20 and linked_ == near
    assert max(met[1]) <= 300 < 2000, met


def test_scratch_tables_are_deleted(spark):
    root = Path(shared_root(spark))
    before = {p.name for p in root.glob("scratch-*")}
    ngram_join.linked(cases.documents(spark, passages(30, 20, 40) + [(90, cases.prose(3, 50)), (91, cases.prose(3, 50))])).collect()
    assert {p.name for p in root.glob("scratch-*")} == before


def test_op4_on_the_table(spark, sf_dir):
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in queries.op4_ngram_join(spark, sf_dir).collect())
    assert got == groups_by_hand(rows, 4, 85)


# --- packing ---


def least_padding(lengths, counts, buckets):
    """Padding of the best bounds, by trying every split."""
    best = {0: 0}
    for _ in range(buckets):
        reach = dict(best)
        for start, cost in best.items():
            for end in range(start + 1, len(lengths) + 1):
                total = cost + sum((lengths[end - 1] - x) * c for x, c in zip(lengths[start:end], counts[start:end], strict=True))
                reach[end] = min(reach.get(end, total), total)
        best = reach
    return best[len(lengths)]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 500), st.integers(1, 50), min_size=1, max_size=9), st.integers(1, 6))
def test_bounds_are_optimal(histogram, buckets):
    lengths = sorted(histogram)
    counts = [histogram[x] for x in lengths]
    ends = packing.bounds(np.array(lengths), np.array(counts), buckets)
    assert len(ends) <= buckets and ends == sorted(set(ends)) and ends[-1] == lengths[-1]
    padding = sum((min(e for e in ends if e >= x) - x) * c for x, c in zip(lengths, counts, strict=True))
    assert padding == least_padding(lengths, counts, buckets)


def test_lengths_round_up_a_little(spark):
    values = [*range(0, 1200), 5000, 70_001, 10**6 + 1, 2**40 + 1]
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    for r in frame.select("v", packing.rounded(frame.v).alias("r")).collect():
        assert r.r >= r.v and r.r - r.v <= (r.v / 64 if r.v > packing.EXACT else 0)


def check_packing(rows, ends_from, budget):
    by_bucket = collections.defaultdict(list)
    for r in rows:
        assert r.n_tokens <= r.bucket_length
        by_bucket[r.bucket, r.bucket_length].append(r)
    assert len({b for b, _ in by_bucket}) == len(by_bucket) <= ends_from
    for (_, length), members in by_bucket.items():
        room = max(1, budget // max(1, length))
        members.sort(key=lambda r: (r.batch, r.slot))
        assert [(r.batch, r.slot) for r in members] == [(k // room, k % room) for k in range(len(members))]
        ids = [r.doc_id for r in members if r.doc_id is not None]
        assert ids == sorted(ids) and all(r.doc_id is None for r in members[len(ids) :])


def test_packing_odd_documents(spark):
    rows = packing.pack(cases.odd(spark), buckets=4, budget=700).collect()
    assert len(rows) == len(cases.ODD)
    check_packing(rows, 4, 700)
    assert packing.pack(cases.empty(spark)).count() == 0
    by_chars = packing.pack(cases.odd(spark), length=F.col("n_chars"), buckets=3, budget=10_000).collect()
    assert {r.n_tokens for r in by_chars if r.doc_id == 1} == {0}


def test_packing_counts_tokens(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = cases.ODD + [(20, "漢字" * 2000), (21, "QUJD" * 3000)]
    frame = cases.documents(spark, rows)
    expected = collections.Counter((i, len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    for got in (packing.pack(frame, tokenizer=path).collect(), corpus_pipeline.pack(spark, frame, "").collect()):
        assert collections.Counter((r.doc_id, r.n_tokens) for r in got) == expected
        check_packing(got, packing.BUCKETS, packing.BUDGET)
    assert packing.pack(cases.empty(spark), tokenizer=path).count() == 0
    with pytest.raises(ValueError):
        packing.pack(frame, length=F.col("n_chars"), tokenizer=path)


def test_op5_on_the_table(spark, sf_dir):
    rows = queries.op5_packing(spark, sf_dir).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in texts.items()}
    check_packing(rows, packing.BUCKETS, packing.BUDGET)
    # The padding of the best bounds over all lengths, but for splits inside an entry of long ones.
    lengths, counts = np.unique([r.n_tokens for r in rows], return_counts=True)
    ends = packing.bounds(lengths, counts, packing.BUCKETS)
    best = sum((min(e for e in ends if e >= n) - n) * c for n, c in zip(lengths.tolist(), counts.tolist(), strict=True))
    assert best <= sum(r.bucket_length - r.n_tokens for r in rows) <= 1.01 * best
    assert {r.bucket_length for r in rows} <= set(lengths.tolist())


def test_rows_without_doc_id_are_spread(spark, monkeypatch):
    """They are one key, but no range holds them all."""
    monkeypatch.setattr(packing, "RANGE_ROWS", 100)
    frame = cases.documents(spark, [(None, cases.prose(k, 20 + k % 50)) for k in range(1500)])
    parts = []
    monkeypatch.setattr(packing, "near", lambda f, n: parts.append(f.count()) or f)
    check_packing(packing.pack(frame).collect(), packing.BUCKETS, packing.BUDGET)
    assert parts[0] >= 12

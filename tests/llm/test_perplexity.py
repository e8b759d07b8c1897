"""Quality rules: plain counts and the language model against plain Python."""

import math
import re
from collections import Counter, defaultdict

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.llm import perplexity, queries


def plain(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = defaultdict(list)
    for k in range(len(words) - 2):
        windows[tuple(words[k : k + 3])].append(k)
    repeated = {k + j for at in windows.values() if len(at) > 1 for k in at for j in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


def fails(counts):
    return counts[0] < 50 or 100 * counts[4] > 50 * counts[0]


def bytes_of(text, order):
    """The last `order` bytes at every byte, white space as one blank, zeros before the beginning."""
    raw = bytes(order - 1) + re.sub(rb"[\x20\x09-\x0D]+", b" ", (text or "").encode())
    return [raw[k - order + 1 : k + 1] for k in range(order - 1, len(raw))]


class Model:
    """Interpolated modified Kneser-Ney by its textbook formulas."""

    def __init__(self, texts, order):
        self.order, self.counts = order, {order: Counter(g for t in texts for g in bytes_of(t, order))}
        for size in range(order - 1, 0, -1):
            self.counts[size] = Counter(g[1:] for g in self.counts[size + 1])
        self.after, self.discounts = {}, {}
        for size, table in self.counts.items():
            n = Counter(table.values())
            y = n[1] / max(n[1] + 2 * n[2], 1)
            self.discounts[size] = [0.0] + [min(max(k - ((k + 1) * y * n[k + 1] / n[k] if n[k] else 0), 0.1), k) for k in (1, 2, 3)]
            self.after[size] = defaultdict(list)
            for g, c in table.items():
                self.after[size][g[:-1]].append(c)
        self.known = {}

    def p(self, gram):
        if not gram:
            return 1 / 256
        if gram not in self.known:
            size = len(gram)
            counts, taken = self.after[size].get(gram[:-1]), self.discounts[size]
            lower = self.p(gram[1:])
            if counts:
                total, c = sum(counts), self.counts[size][gram]
                lower = (c - taken[min(c, 3)]) / total + sum(taken[min(x, 3)] for x in counts) / total * lower
            self.known[gram] = lower
        return self.known[gram]

    def loss(self, text):
        grams = bytes_of(text, self.order)
        return -sum(math.log(self.p(g)) for g in grams) / len(grams) if grams else None


def judged_by_hand(rows, order):
    """A list of (doc_id, counts, base_failed, kept, perplexity) of rows (doc_id, lang, text)."""
    by_text = defaultdict(list)
    for i, lang, text in rows:
        by_text[lang, text or ""].append(i)
    by_lang = defaultdict(list)
    for (lang, text), ids in by_text.items():
        known = [i for i in ids if i is not None]
        by_lang[lang] += [text] * (known.count(min(known)) if known else len(ids))
    models, fences = {}, {}
    for lang, texts in by_lang.items():
        models[lang] = Model(texts, order)
        losses = sorted(models[lang].loss(t) for t in set(texts) if not fails(plain(t)))
        if losses:
            low, mid, high = (losses[max(math.ceil(q * len(losses)) - 1, 0)] for q in (0.1, 0.5, 0.9))
            below, above = max(mid - low, (high - mid) / 2, 0.02 * mid), max(high - mid, (mid - low) / 2, 0.02 * mid)
            fences[lang] = (low - 2 * below, high + 2 * above)
    out = []
    for i, lang, text in rows:
        counts, loss = plain(text), models[lang].loss(text)
        kept = not fails(counts) and fences[lang][0] <= loss <= fences[lang][1]
        out.append((i, counts, fails(counts), kept, None if loss is None else math.exp(loss)))
    return out


def check(frame, rows, order):
    got = [(r.doc_id, tuple(r[c] for c in perplexity._COUNTS), r.base_failed, r.kept, r.perplexity) for r in frame.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:4], r[4] or 0)
    got, expected = sorted(got, key=key), sorted(judged_by_hand(rows, order), key=key)
    assert [r[:4] for r in got] == [r[:4] for r in expected]
    assert [r[4] is None for r in got] == [r[4] is None for r in expected]
    assert np.allclose([r[4] or 1 for r in got], [r[4] or 1 for r in expected], rtol=1e-9)
    return expected


def corpus():
    rows = [(k, "en", cases.prose(k, 60 + k)) for k in range(60)] + [(100 + k, "zu", cases.prose(k, 80).upper() + " é漢") for k in range(12)]
    rows += [(200 + k, "en", cases.prose(5, 70)) for k in range(40)]  # copies of one text
    rows += [(300, "en", " ".join(chr(33 + 7 * k % 90) * 3 + chr(40 + 11 * k % 80) for k in range(80))), (301, "en", "a\n\na\n b \na\n" * 30)]
    return rows


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(corpus(), "doc_id long, lang string, text string").repartition(5).cache()


@pytest.mark.parametrize("order", [2, 5])
def test_perplexity_is_that_of_the_formulas(table, order):
    expected = check(perplexity.judged(table, order), corpus(), order)
    verdicts = {r[0]: r[2:4] for r in expected}
    assert verdicts[300] == (False, False) and verdicts[301][0]
    assert sum(v[1] for v in verdicts.values()) == len(verdicts) - 2


def test_probabilities_after_a_context_add_up_to_one(table):
    model = perplexity.fit(table, 3)
    arrays = perplexity.Arrays.of(model)
    for context in (b"al", b"\0\0", b"zz", b"e "):
        grams = np.array([(context[0] << 16) + (context[1] << 8) + b for b in range(256)])
        assert np.exp(arrays.scores(grams, np.zeros(256, int), ["en"])).sum() == pytest.approx(1)
    assert np.allclose(arrays.scores(np.arange(4), np.zeros(4, int), ["unknown"]), -math.log(256))
    assert {r.kind for r in model.collect()} == {"p", "w"} and model.filter("isnan(value) OR value > 1e-9").count() == 0


def test_unseen_sequences_are_scored_by_their_known_end(spark, table):
    model = perplexity.fit(table, 4)
    new = [(1, "en", "alpha12 qqq zeta " * 9), (2, "zu", cases.prose(3, 20)), (3, "xx", "any"), (4, "en", None), (4, "en", "漢")]
    frame = spark.createDataFrame(new, "doc_id long, lang string, text string")
    by_lang = {lang: Model([t for _, x, t in corpus() if x == lang], 4) for lang in ("en", "zu", "xx")}
    expected = sorted((i, round(x, 9)) for i, lang, t in new if (x := by_lang[lang].loss(t)) is not None)
    for most in (perplexity.MODEL_ROWS, 10):  # as arrays, by joins
        got = perplexity.measured(frame, model, 4, most).collect()
        assert sorted((r.doc_id, round(r.loss, 9)) for r in got if r.loss is not None) == expected and len(got) == 5


def test_a_large_model_is_joined(table, monkeypatch):
    monkeypatch.setattr(perplexity.measured, "__defaults__", (perplexity.ORDER, 100))
    check(perplexity.judged(table, 3), corpus(), 3)


@pytest.mark.parametrize(("order", "most"), [(5, 9_000), (5, 3_000), (3, 900)])
def test_a_large_model_is_dealt_in_parts(table, monkeypatch, order, most):
    dealt, used = perplexity._dealt, []
    monkeypatch.setattr(perplexity, "_dealt", lambda *a: used.append(a[-2:]) or dealt(*a))
    monkeypatch.setattr(perplexity, "_joined", None)  # moves every sequence of every text
    monkeypatch.setattr(perplexity.measured, "__defaults__", (perplexity.ORDER, most))
    check(perplexity.judged(table, order), corpus(), order)
    assert len(used) == 1 and used[0][0] * used[0][1] > 1


def test_copies_beyond_a_broadcast_are_left_out_in_parts(spark):
    rows = [(k, "en", cases.prose(k // 2, 40)) for k in range(80)] + [(None, "en", cases.prose(90, 40))] * 2 + [(99, None, "alone")]
    frame = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(5)
    whole, parts = perplexity.different(frame), perplexity.different(frame, 9)
    assert len(whole) == 1 and len(parts) == 5
    found = sorted((r.doc_id or -1, r.lang, r.text) for part in parts for r in part.collect())
    assert found == sorted((i or -1, lang or "", t) for i, lang, t in rows if i is None or i % 2 == 0 or i == 99)
    assert not any("SortMergeJoin" in part._jdf.queryExecution().executedPlan().toString() for part in parts)
    one, several = ({(r.size, r.kind, r.lang, r.gram): r.value for r in perplexity.fit(x, 3).collect()} for x in (whole, parts))
    assert one.keys() == several.keys() and all(abs(one[k] - several[k]) < 1e-12 for k in one)


def test_sums_of_a_task_are_passed_on_in_parts(table, monkeypatch):
    whole = {(r.lang, r.gram): r.n for r in perplexity.counted(table, 4).collect()}
    monkeypatch.setattr(perplexity, "GATHERED", 300)
    assert {(r.lang, r.gram): r.n for r in perplexity.counted(table, 4).collect()} == whole
    assert sum(whole.values()) == sum(len(bytes_of(t, 4)) for _, _, t in corpus())


def test_odd_documents(spark):
    documents = cases.odd(spark).withColumn("lang", F.when(F.col("doc_id") < 8, F.lit("x")).when(F.col("doc_id") < 13, F.lit("")))
    rows = [(i, "x" if i is not None and i < 8 else "", t) for i, t in cases.ODD]
    check(perplexity.judged(documents), rows, 5)
    assert perplexity.judged(cases.empty(spark)).count() == 0
    blank = cases.documents(spark, [(1, None), (2, ""), (None, None)])
    assert [(r.n_words, r.base_failed, r.kept, r.perplexity) for r in perplexity.judged(blank).collect()] == [(0, True, False, None)] * 3


def test_near_copies_do_not_close_the_band(spark):
    rows = [(k, "en", cases.prose(k, 90)) for k in range(80)]
    rows += [(1000 + k, "en", f"{cases.prose(7, 200)} {k}") for k in range(240)]
    got = perplexity.judged(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    assert got.filter("NOT kept").count() == 0


def test_op13_on_the_table(spark, sf_dir):
    rows = [(r.doc_id, r.lang, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = queries.op13_perplexity(spark, sf_dir)
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["boolean"] * 2 + ["double"]
    expected = check(got, rows, 5)
    able = [r for r in expected if not r[2]]
    assert 0.8 < np.mean([r[3] for r in able]) < 1

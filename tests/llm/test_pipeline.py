"""The corpus pipeline, stage by stage, against plain Python, and with odd documents."""

import collections

import cases
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kerbside.llm import queries
from kerbside.llm.pii import base_spans
from test_text_operators import changed, check_packing, groups_by_hand, repeats_by_hand


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Documents with planted copies, passages, personal data and insults, and labels for some."""
    directory = str(tmp_path_factory.mktemp("corpus"))
    passage = cases.prose(555, 60)
    rows = [(k, cases.prose(k, 90)) for k in range(60)]
    rows += [(100 + k, changed(rows[k][1], 1, k)) for k in range(8)] + [(120 + k, rows[k][1]) for k in range(5)]
    rows += [(140 + k, f"{cases.prose(700 + k, 50)} {passage} {cases.prose(800 + k, 50)}") for k in range(6)]
    rows += [(160 + k, f"{cases.prose(900 + k, 30)} you idiot and scum, you moron {cases.prose(950 + k, 20)}") for k in range(30)]
    rows += [(200, cases.prose(990, 40) + " write to a.b@c.example.com or +1 (555) 555-0100")]
    documents = cases.documents(spark, rows)
    documents.write.parquet(f"{directory}/documents.parquet")
    labels = [(k, 0) for k in range(60)] + [(160 + k, 1) for k in range(20)]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{directory}/labels.parquet")
    return directory, dict(rows)


def test_stages_do_what_they_say(spark, corpus, tmp_path):
    directory, texts = corpus
    names = [name for name, _ in corpus_pipeline.STAGES]
    docs, kept = spark.read.parquet(f"{directory}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, directory)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != names[-1]:
            assert docs.columns == columns
        kept[name] = docs.collect()
    clean = {r.doc_id: r.text for r in kept["toxicity"]}
    assert clean == {i: t for i, t in texts.items() if not 160 <= i < 190}
    single = {r.doc_id: r.text for r in kept["ngram_join"]}
    assert single == {i: clean[i] for i in sorted({c for _, _, c in groups_by_hand(list(clean.items()), 5, 80)})}
    cut = {r.doc_id: r.text for r in kept["substrings"]}
    assert cut == {i: kept_[3].decode() for i, kept_ in repeats_by_hand(sorted(single.items())).items()}
    assert all(r.n_chars == len(r.text) for r in kept["substrings"])
    masked = {r.doc_id: r.text for r in kept["pii"]}
    assert masked[200].endswith("write to [EMAIL] or [PHONE]") and not any(base_spans(t) for t in masked.values())
    assert {i: t for i, t in masked.items() if i != 200} == {i: t for i, t in cut.items() if i != 200}
    assert sorted(r.doc_id for r in kept["packing"]) == sorted(masked)
    check_packing(kept["packing"], 16, 32_768)


def test_run_equals_its_stages(spark, corpus):
    directory, texts = corpus
    rows = corpus_pipeline.run(spark, directory).collect()
    assert len(rows) == len({r.doc_id for r in rows}) and {r.doc_id for r in rows} <= set(texts)
    check_packing(rows, 16, 32_768)


def test_stages_take_odd_documents(spark, corpus):
    directory, _ = corpus
    for make in (cases.odd, cases.empty):
        docs = make(spark)
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, directory)
            assert docs.columns == columns, name
        rows = docs.collect()
        ids = collections.Counter(r.doc_id for r in rows)
        assert (ids[1], ids[2], ids[7], ids[None]) == ((1, 1, 0, 2) if make is cases.odd else (0, 0, 0, 0))
        assert all(r.label == "own label" for r in rows)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, directory).count() == len(rows)


def test_every_operator_has_a_query():
    assert [sum(name.startswith(f"op{n}_") for name in queries.QUERIES) for n in range(1, 11)] == [1] * 10

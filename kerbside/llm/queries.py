"""Named queries of the text operators: each applies its operator to a whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import ann, bpe, fingerprint, html_text, ngram_join, packing, periodic, perplexity, pii, quality, resample, substrings, toxicity
from kerbside.llm.common import small_batches


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are."""
    return fingerprint.edits(_table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text; `n_added` counts the spans that the bootstrapped patterns found."""
    return pii.find(_table(spark, sf_dir, "documents")).select(
        "doc_id",
        *(pii.counted(F.col("base"), kind).alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"),
        pii.written(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_added"),
    )


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text without byte strings that stand earlier in the table."""
    return substrings.cut_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["begin"]).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that are linked by similar sets of four-word shingles."""
    return ngram_join.linked(_table(spark, sf_dir, "documents"), words=4, percent=85)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length bucket, batch and slot of every document, by words."""
    return packing.pack(_table(spark, sf_dir, "documents"))


def pack_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by tokens of the 50k vocabulary, as the pipeline packs."""
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer=public_tokenizers.path("byte_bpe_50k.json"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest vectors of every twentieth one."""
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def _held_out(divisor: int, remainder: int) -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor == remainder


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text, learnt from labelled rows outside the held-out fifth."""
    documents, held = _table(spark, sf_dir, "documents"), _held_out(5, 0)
    model = quality.fit(documents, _table(spark, sf_dir, "labels").filter(~held), "quality")
    return quality.score(documents, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text, learnt from labelled rows outside the held-out third."""
    documents, held = _table(spark, sf_dir, "documents"), _held_out(3, 1)
    model = toxicity.fit(documents, _table(spark, sf_dir, "labels").filter(~held), "toxic")
    return toxicity.score(documents, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and the text that they decode to, as digests."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoded = bpe.decode(bpe.encode(_table(spark, sf_dir, "documents"), path), path)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tenth of the documents that importance resampling draws towards the benchmark."""
    drawn = resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def _looped(documents: DataFrame) -> DataFrame:
    """(doc_id, text), in which every tenth document, by a hash of its id, repeats some of its words up to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    white = "[\\x20\\x09-\\x0D]+"
    bare = F.regexp_replace(F.regexp_replace("text", f"^{white}", ""), f"{white}$", "")
    split = F.when((h % 10 == 0) & (bare != ""), F.split(bare, white))
    rows = documents.select("doc_id", "text", F.floor(h / 10).alias("g"), split.alias("words")).withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.expr("int(g % n)")).withColumn("p", F.expr("1 + int((n - a) div (3 + g % 8))"))
    loop = F.flatten(F.expr("array_repeat(slice(words, a + 1, p), 1 + int((n - a) div p))"))
    looped = F.array_join(F.concat(F.expr("slice(words, 1, a)"), F.slice(loop, 1, F.col("n") - F.col("a"))), " ")
    return rows.select("doc_id", F.when(F.col("words").isNotNull(), looped).otherwise(F.col("text")).alias("text"))


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words, the one that repeats most often, and what collapsing them leaves."""
    found = periodic.collapse(_looped(_table(spark, sf_dir, "documents")))

    def by_exponent(x: F.Column, y: F.Column) -> F.Column:
        longer, shorter = x["length"] * y["period"], y["length"] * x["period"]
        return F.when(longer != shorter, F.when(longer > shorter, -1).otherwise(1)).when(x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1)).otherwise(F.when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0))

    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.get(F.array_sort("runs", by_exponent), F.lit(0))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )


def op13_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain counts of every text, and whether these and its perplexity let it pass."""
    return perplexity.judged(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_fingerprint": op1_fingerprint,
    "op2_pii": op2_pii,
    "op3_substrings": op3_substrings,
    "op4_ngram_join": op4_ngram_join,
    "op5_packing": op5_packing,
    "pack_tokens": pack_tokens,
    "op6_html_text": op6_html_text,
    "op7_neighbours": op7_neighbours,
    "op8_quality": op8_quality,
    "op9_toxicity": op9_toxicity,
    "op10_bpe": op10_bpe,
    "op11_resample": op11_resample,
    "op12_periodic": op12_periodic,
    "op13_perplexity": op13_perplexity,
}

# What the pages of the test tables need: their articles hold headings and paragraphs with inline tags.
_ARTICLE = """
SELECT page_id, url, text, length(text) AS n_chars FROM (
  SELECT page_id, url, coalesce(array_to_string(list_filter(list_transform(
      string_split_regex(regexp_extract(html, '<article>(.*)</article>', 1, 's'), '</?(?:h1|p)>'),
      lambda b: trim(regexp_replace(regexp_replace(replace(replace(replace(
        regexp_replace(regexp_replace(b, '<br>', ' ', 'g'), '<[^>]*>', '', 'g'),
        '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g'), '\\s+', ' ', 'g'))),
    lambda b: b <> ''), chr(10) || chr(10)), '') AS text
  FROM pages)
"""

_NEIGHBOURS = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL),
pairs AS (
  SELECT q.vec_id AS query_id, x.vec_id, list_inner_product(q.e, x.e) AS score
  FROM v q JOIN v x ON q.vec_id <> x.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

# CRC-32 byte by byte, once for each distinct word.
_RESAMPLE = """
WITH crc AS (
  SELECT list(list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
  FROM (SELECT unnest(range(256)) AS b)),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
occurs AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(w) AS w FROM d) GROUP BY ALL),
aims AS (SELECT w, count(*) AS n FROM (SELECT unnest(w) AS w FROM b) GROUP BY ALL),
hashed AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(octet_length(encode(w))),
        lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT)),
      lambda c, x: xor(c >> 8, crc.t[xor(c & 255, x) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT w FROM occurs UNION SELECT DISTINCT w FROM aims), crc),
s AS (SELECT bucket, sum(n) AS s FROM occurs JOIN hashed USING (w) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS t FROM aims JOIN hashed USING (w) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM occurs) + 10000)
      / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM aims) + 10000)))) AS gain
  FROM s FULL JOIN t USING (bucket)),
weights AS (
  SELECT doc_id, sum(n)::BIGINT AS n_features, floor(sum(n * gain) / sum(n))::BIGINT AS weight
  FROM occurs JOIN hashed USING (w) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN weights USING (doc_id)),
places AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS able
  FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * able // 100 THEN place END AS rank
FROM scored LEFT JOIN places USING (doc_id)
"""

SQL: dict[str, str] = {"op6_html_text": _ARTICLE, "op7_neighbours": _NEIGHBOURS, "op11_resample": _RESAMPLE}

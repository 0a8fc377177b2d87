"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import fresh
from tidemark.llm.language import classify, held_out, learn
from tidemark.llm.lines import dedup_lines
from tidemark.llm.mixing import mix, with_own_topic
from tidemark.llm.negatives import hard_negatives
from tidemark.llm.packing import pack
from tidemark.llm.pii import KINDS, find_pii, listed, of_kind
from tidemark.llm.quality import BASE, POLICIES, ledger, passes
from tidemark.llm.scoring import held_out as left_for_test
from tidemark.llm.scoring import learn_quality, score_quality
from tidemark.llm.sharding import shard
from tidemark.llm.simhash import simhash_components
from tidemark.llm.spelling import group_variants, vocabulary
from tidemark.llm.vectors import vector_links
from tidemark.llm.wrappers import main_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 23 by jump consistent hashing of doc_id."""
    return shard(table(spark, sf_dir, "documents"), "doc_id", "text", 24)


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of all documents."""
    groups = simhash_components(table(spark, sf_dir, "documents"), "doc_id", "text")
    return groups.select(
        "doc_id",
        F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of at most 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"), "doc_id", "text")


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule ledger of all documents, with the verdict of policy v1."""
    rows = ledger(table(spark, sf_dir, "documents"), "doc_id", "text")
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~passes(BASE)).alias("base_failed"),
        (passes(BASE) & passes(POLICIES["v1"])).alias("kept"),
        F.col("failed").alias("failed_rules"),
    )


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(~held_out("doc_id")), "doc_id", "text", "lang")
    found = classify(docs.select("doc_id", "text"), "doc_id", "text", model)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "accepted")


FORM = "form"


def document_mix(docs: DataFrame, *, without: tuple[str, ...] = (), **options) -> DataFrame:
    """Documents with their drawing probabilities for tempered shares of sources, languages and topics.

    A struct with topic and tokens is added under ``FORM``, or that name with lines where it is taken;
    columns in ``without`` are left behind once the topics are known.
    """
    form = fresh(docs, FORM)
    by = {"source": F.col("source"), "lang": F.col("lang"), "topic": F.col(form)["topic"]}
    formed = with_own_topic(docs, "text", form, without=without)
    return mix(formed, "doc_id", by, F.col(form)["tokens"], **options)


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The draw of all documents, with factors raked to the target marginals."""
    drawn = document_mix(table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text"), without=("text",))
    return drawn.select(
        "doc_id", "source", "lang", F.col(FORM)["topic"].alias("topic"), F.col(FORM)["tokens"].alias("n_tokens"),
        "cell_factor", "probability", "drawn",
    )


@query
def op9_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all embeddings at cosine 0.9 or more."""
    found = vector_links(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return found.withColumnRenamed("component", "component_id")


@query
def op5_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    found = main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"), "url", "html")
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that repeat an earlier line of the corpus."""
    found = dedup_lines(table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select("doc_id", F.col("n_removed_lines").alias("n_removed"), F.col("text").alias("text"))


ORACLES["op1_line_dedup"] = r"""
WITH occ AS (
  SELECT doc_id, pos, lines[pos] AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL) d,
       unnest(range(1, len(lines) + 1)) AS r(pos)
  WHERE regexp_matches(lines[pos], '[^\x20\x09-\x0D]')),
cls AS (
  SELECT line, min((doc_id, pos)) AS first,
         list_filter(list_distinct(regexp_split_to_array(lower(line), '[\x20\x09-\x0D]+')), lambda w: w <> '') AS ws
  FROM occ GROUP BY line),
ids AS (SELECT row_number() OVER () AS id, line, first, ws, len(ws) AS n FROM cls),
tok AS (SELECT id, n, unnest(ws) AS w FROM ids),
df AS (SELECT w, count(*) AS c FROM tok GROUP BY w),
pre AS (
  SELECT id, n, w FROM tok JOIN df USING (w)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY c, w) <= n - (4 * n + 4) // 5 + 1),
near AS (
  SELECT DISTINCT a.id AS x, b.id AS y FROM pre a JOIN pre b
  ON a.w = b.w AND a.id < b.id AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)),
sim AS (
  SELECT a.first AS xf, b.first AS yf, a.line AS xl, b.line AS yl
  FROM near JOIN ids a ON a.id = x JOIN ids b ON b.id = y
  WHERE 9 * len(list_intersect(a.ws, b.ws)) >= 4 * (a.n + b.n)),
later AS (SELECT DISTINCT CASE WHEN xf > yf THEN xl ELSE yl END AS line FROM sim),
gone AS (
  SELECT o.doc_id, o.pos FROM occ o JOIN cls USING (line) LEFT JOIN later l ON l.line = o.line
  WHERE l.line IS NOT NULL OR (o.doc_id, o.pos) <> cls.first),
per AS (SELECT doc_id, list(pos) AS gone FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(p.gone), 0)::BIGINT AS n_removed,
       CASE WHEN p.gone IS NULL THEN d.text ELSE array_to_string(
         list_filter(string_split(d.text, chr(10)), lambda l, i: NOT list_contains(p.gone, i)), chr(10)) END AS text
FROM documents d LEFT JOIN per p USING (doc_id)
"""


@query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: counts and digest of the rules' spans, and all spans."""
    found = find_pii(table(spark, sf_dir, "documents"), "doc_id", "text")
    counts = [F.size(of_kind(F.col("base"), kind)).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near words of all frequent words of the documents, and the forms they are variants of."""
    words = vocabulary(table(spark, sf_dir, "documents"), "doc_id", "text", slip_every=199)
    return group_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth embedding, among all; some labels are shifted first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", label, F.col("vec_id") % 50 == 0)


ORACLES["op12_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.other)::INTEGER AS rank,
       s.other AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.other) <= 3
"""


@query
def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document, learned from the labels of rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = learn_quality(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "quality", left_out=left_for_test("doc_id"))
    found = score_quality(docs, "doc_id", "text", model)
    return found.select("doc_id", left_for_test("doc_id").alias("held_out"), "score", "predicted", "difference")


# The checksum is worked out from its table, as the other database has no function for it.
ORACLES["op11_spelling_variants"] = r"""
WITH RECURSIVE bits(i, c, k) AS (
  SELECT i, i::BIGINT, 0 FROM range(256) r(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS tab FROM bits WHERE k = 8),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (
  SELECT w, c, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
           string_split(coalesce(doc_id::VARCHAR, '') || ':' || w, ''),
           lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT] ELSE [195::BIGINT, (ord(x) - 64)::BIGINT] END))),
           lambda a, b: xor(a >> 8, tab[xor(a & 255, b) + 1])), 4294967295::BIGINT) AS h
  FROM runs, crc),
slipped AS (
  SELECT CASE WHEN h % 199 = 0
              THEN left(w, h % length(w)) || right(w, length(w) - 1 - h % length(w)) ELSE w END AS word, c
  FROM hashed),
vocab AS (SELECT word, sum(c)::BIGINT AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
cut AS (SELECT word, n, p, left(word, p) AS l, right(word, length(word) - p - 1) AS r FROM vocab, unnest(range(length(word))) u(p)),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.p = b.p AND a.l = b.l AND a.r = b.r AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM cut a JOIN vocab b ON b.word = a.l || a.r
  UNION
  SELECT b.word, a.word, a.n FROM cut a JOIN vocab b ON b.word = a.l || a.r),
best AS (
  SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM near GROUP BY word),
form AS (
  SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near,
         CASE WHEN near_n >= 5 * v.n THEN near END AS form, CASE WHEN near_n >= 5 * v.n THEN near_n END AS form_n
  FROM vocab v LEFT JOIN best USING (word)),
walk(word, reached) AS (
  SELECT word, word FROM form
  UNION ALL
  SELECT walk.word, form.form FROM walk JOIN form ON walk.reached = form.word WHERE form.form IS NOT NULL)
SELECT f.word, f.form, w.reached AS root, f.n, f.n_near, f.form_n
FROM form f JOIN walk w USING (word) JOIN form e ON e.word = w.reached AND e.form IS NULL
"""

"""The registered queries of the operators, with oracle SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.llm.bpe import bpe_digests
from lakestar.llm.centroids import cluster
from lakestar.llm.common import read_table
from lakestar.llm.decontaminate import benchmark_hits
from lakestar.llm.exact_dedup import exact_duplicates
from lakestar.llm.jaccard_join import near_duplicates
from lakestar.llm.language import identify_languages
from lakestar.llm.quality import score_quality
from lakestar.llm.resample import resample
from lakestar.llm.secret_scan import scan_secrets
from lakestar.llm.substring_dedup import repeated_words
from lakestar.llm.token_store import read_tokens, write_tokens
from lakestar.llm.url_rules import GLOBS, RULES, judge_urls
from lakestar.llm.wordpiece import token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query under its name, with its oracle if it has one."""

    def add(query):
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def in_first_snapshot(column: str = "doc_id"):
    """The split of a single table into a stored snapshot and an incoming batch: even and odd ids."""
    return F.col(column) % 2 == 0


def id_remainder(modulus: int, column: str = "doc_id") -> Column:
    """CRC-32 of the id as text, modulo; null ids have none."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def held_out_for_quality() -> Column:
    """Rows that the quality classifier does not learn from; rows without an id are among them."""
    return F.coalesce(id_remainder(3) == 1, F.lit(True))


@register("op1_token_output")
def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return read_tokens(*write_tokens(documents, public_tokenizers.path("word_bpe_49k.json")))


@register("op2_quality_classifier")
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents", "doc_id", "text")
    scored = score_quality(documents, read_table(spark, sf_dir, "labels", "doc_id", "quality"), held_out_for_quality())
    return scored.select(
        "doc_id", F.col("__held_out").alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= 0.5).cast("int").alias("predicted"))


@register("op3_secret_scans")
def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    # A source owns its documents; its repositories are its languages.
    return scan_secrets(documents, F.col("source"), F.col("lang"))


@register("op4_exact_dedup", """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (t)
""")
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return exact_duplicates(documents, in_first_snapshot())


@register("op5_bpe_encoding")
def op5_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return bpe_digests(documents, public_tokenizers.path("byte_bpe_50k.json"))


@register("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return token_counts(documents, public_tokenizers.path("byte_bpe_50k.json"))


@register("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = F.coalesce(id_remainder(4) == 2, F.lit(True))
    return identify_languages(documents, held_out)


@register("op8_ngram_jaccard_join", r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
counted AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM grams x JOIN grams y ON x.gram = y.gram AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id),
links AS (
  SELECT a, b FROM counted JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
  WHERE 100 * c >= 90 * (s.n + t.n - c)),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
""")
def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return near_duplicates(documents, n=3, percent=90).select("doc_id", "n_shingles", "component_id")


@register("op9_benchmark_decontamination", r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
starts AS (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM items WHERE len(w) > 0),
windows AS (
  SELECT item_id, array_to_string(w[i : i + 12], ' ') AS phrase, least(13, len(w)) AS n FROM starts),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n),
grams AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS phrase FROM places),
found AS (SELECT g.doc_id, g.i, g.n, x.item_id FROM grams g JOIN windows x USING (phrase, n)),
hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM found)) GROUP BY doc_id),
lists AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN lists USING (doc_id)
""")
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents", "doc_id", "text")
    hits = benchmark_hits(documents, read_table(spark, sf_dir, "benchmark", "item_id", "text"))
    return hits.select("doc_id", "__hits.*").drop("spans")


def _like(glob: str) -> str:
    """A glob of the method as a regular expression for the oracle."""
    out = glob.replace(".", "[.]").replace("**", "\1").replace("*", "[^/]*").replace("\1", ".*")
    return f"^{out}$"


def _url_oracle() -> str:
    fits = " UNION ALL ".join(
        f"SELECT page_id, '{r}' AS rule, '{v}' AS verdict FROM u WHERE (host = '{r.partition('/')[0]}' OR "
        f"ends_with(host, '.{r.partition('/')[0]}')) AND starts_with(path, '/{r.partition('/')[2]}')"
        for r, v in RULES)
    blocked = " OR ".join(f"regexp_matches('.' || host || path, '{_like(g)}')" for g, v in GLOBS if v == "block")
    return f"""
WITH r AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages),
u AS (
  SELECT page_id, lower(regexp_extract(rest, '^([^/?#]*)', 1)) AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
f AS ({fits}),
best AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM f GROUP BY page_id)
SELECT page_id, host, path, best.rule AS rule,
  coalesce(best.verdict, CASE WHEN {blocked} THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN best USING (page_id)
"""


@register("op10_url_filters", _url_oracle())
def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read_table(spark, sf_dir, "pages", "page_id", "url"))


def _centroid_oracle(k: int = 8, rounds: int = 10) -> str:
    """Lloyd rounds written out one after the other."""
    def nearest(r: int) -> str:
        return f"""a{r} AS MATERIALIZED (SELECT vec_id, v, arg_min(c, d * {k} + c) AS c, min(d) AS d FROM (
  SELECT vec_id, v, c, list_sum(list_transform(range(1, 65), lambda i: (v[i] - m[i]) * (v[i] - m[i]))) AS d
  FROM kept, c{r}) GROUP BY vec_id, v)"""

    def moved(r: int) -> str:
        return f"""c{r + 1} AS MATERIALIZED (SELECT o.c, coalesce(n.m, o.m) AS m FROM c{r} o LEFT JOIN (
  SELECT c, list(CAST(floor_sum AS BIGINT) ORDER BY i) AS m FROM (
    SELECT c, i, (s - ((s % n) + n) % n) // n AS floor_sum FROM (
      SELECT c, i, sum(x) AS s, count(*) AS n FROM (
        SELECT c, unnest(v) AS x, unnest(range(1, 65)) AS i FROM a{r}) GROUP BY c, i)) GROUP BY c) n ON n.c = o.c)"""

    steps = [nearest(0)]
    for r in range(rounds):
        steps += [moved(r), nearest(r + 1)]
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS c, v AS m FROM (
  SELECT sha256('3:' || vec_id) AS h, v FROM kept ORDER BY h LIMIT {k})),
{", ".join(steps)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
  CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (c)
"""


@register("op11_centroid_clustering", _centroid_oracle())
def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


@register("op12_importance_resampling")
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return resample(documents, read_table(spark, sf_dir, "benchmark", "text"))


@register("op13_substring_dedup", r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS t
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20)),
again AS (
  SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY t ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM again),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words),
left_over AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY p) AS kept
  FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN left_over USING (doc_id)
""")
def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = repeated_words(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    return removed.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))

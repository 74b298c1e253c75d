"""Registered queries of the corpus operators and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from voltframe.llm import (
    alignment,
    byte_bpe,
    decontaminate,
    exact_dedup,
    html_text,
    lattice_lm,
    near_dedup,
    packing,
    sharding,
    toxicity,
    url_rules,
    warc,
    whitening,
)
from voltframe.llm.common import remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"pipeline": corpus_pipeline.run}
SQL: dict[str, str] = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return marked.select(
        "row.doc_id",
        "n_words",
        decontaminate.hit_words("spans").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


SQL["op2_decontaminate"] = r"""
WITH item AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item, least(len(w), 10) AS l, array_to_string(w[k : k + least(len(w), 10) - 1], ' ') AS win
  FROM item, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(k) WHERE len(w) > 0
), doc AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), place AS (
  SELECT r, l, k, array_to_string(w[k : k + l - 1], ' ') AS win
  FROM doc, (SELECT DISTINCT l FROM win), unnest(range(1, len(w) + 2 - l)) AS u(k)
), found AS (SELECT r, l, k, item FROM place JOIN win USING (l, win)),
hit AS (SELECT r, count(DISTINCT k + d) AS n_hit FROM (SELECT DISTINCT r, l, k FROM found), unnest(range(0, l)) AS u(d) GROUP BY r),
named AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM found GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""


@query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


SQL["op5_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM t JOIN g USING (norm)
"""


@query
def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


SQL["op4_near_dedup"] = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[k : k + 4], ' ') AS s
  FROM doc, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS u(k) WHERE len(w) > 0
), size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y USING (s) WHERE x.doc_id <> y.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM common JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)
), reach AS (
  SELECT doc_id, doc_id AS other FROM doc
  UNION
  SELECT reach.doc_id, b FROM reach JOIN link ON reach.other = a
), component AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM component LEFT JOIN size USING (doc_id)
"""


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs.select("doc_id", "text"), machine).select(
        "row.doc_id",
        (remainder(F.col("row.doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


SQL["op1_sharding"] = f"""
WITH doc AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS n_bytes,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ' ' || coalesce(text, '')), 1, 15))::BIGINT AS bits
  FROM documents
), each AS (SELECT *, d, bits >> (60 - d) AS prefix FROM doc, unnest(range(0, 61)) AS u(d)),
fits AS (
  SELECT d, prefix, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_docs
  FROM each GROUP BY ALL HAVING sum(n_bytes) <= {sharding.SHARD_BYTES}
), first AS (
  SELECT doc_id, n_bytes, bits, min(d) AS depth, arg_min(shard_bytes, d) AS shard_bytes, arg_min(shard_docs, d) AS shard_docs
  FROM each JOIN fits USING (d, prefix) GROUP BY doc_id, n_bytes, bits
)
SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(bits >> (60 - depth)), depth::INT, '0') END AS shard,
  depth::INT AS depth, shard_bytes, shard_docs
FROM first
"""


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        F.col("page").alias("page_id"),
        F.col("size").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.col("refers").alias("refers_to"),
    )


SQL["op8_warc"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first < page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


@query
def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is labelled as the document of its number is: bad where of low quality or toxic. These labels say nothing
    about the page itself, so rules need not be found; tests mine labelled URLs that have them."""
    pages = table(spark, sf_dir, "pages")
    bad = F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)) == 1
    marks = table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("page_id")).agg(F.when(bad, "block").otherwise("allow").alias("label"))
    rules = url_rules.mine(pages.select("page_id", "url").join(marks, "page_id"))
    return url_rules.judge(pages.select("page_id", "url"), rules).select("row.page_id", "host", "path", "rule", "verdict")


@query
def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.learn(pages)).select("row.page_id", "row.url", "text", "n_chars")


SQL["op7_html_text"] = r"""
WITH a AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)(</article>|$)', 1, 's') AS body FROM pages
), b AS (
  SELECT page_id, url, list_transform(
    string_split(regexp_replace(regexp_replace(body, '</?(p|h1)>', chr(1), 'g'), '<[^>]*>', ' ', 'g'), chr(1)),
    lambda x: trim(regexp_replace(replace(replace(replace(replace(replace(x, '&quot;', '"'), '&#x27;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g'))
  ) AS blocks FROM a
), c AS (SELECT page_id, url, array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10) || chr(10)) AS text FROM b)
SELECT page_id, url, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n_chars FROM c
"""


@query
def op6_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 7) == 2
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out.alias("held_out"))
    scored = lattice_lm.scored(docs, ~F.col("held_out"))
    return scored.select("row.doc_id", "row.held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.components(table(spark, sf_dir, "embeddings"), "embedding")
    return found.select("row.vec_id", "component", "n", F.col("deviation").cast("long").alias("deviation"), "whitened", "explained", "identity_error")


@query
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return byte_bpe.decode(encoded).select(
        "row.row.doc_id",
        F.size("row.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("row.ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

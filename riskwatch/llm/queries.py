"""The registered queries ``opN_<name>`` and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, shared_path
from . import (byte_bpe, chat, embedding_graph, fingerprint, hard_negatives, line_dedup, packing, periodic, quality, simhash,
               token_count, token_store, url_filter)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op2_token_store")
def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "tokens")
    token_store.write_tokens(table(spark, sf_dir, "documents"), path,
                             public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    found = token_store.read_documents(spark, path)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op10_byte_bpe")
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = byte_bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    back = byte_bpe.decode(ids, ranks)
    return back.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def packed(docs: DataFrame) -> DataFrame:
    """Every piece of the documents with its digest and its place in a sequence of 4096 tokens."""
    pieces = packing.cut(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=4096)
    light = pieces.select("doc_id", "piece", "start", "length", "part", "rank", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(light, 4096).drop("part", "rank")


@query("op3_best_fit_packing")
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


@query("op1_line_dedup", line_dedup.ORACLE_SQL)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "n_lines", "n_removed", "text")


URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


@query("op8_url_filter", """
WITH RECURSIVE rules(host, path, verdict) AS (
    VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
           ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), parsed AS (
    SELECT page_id, url, html, translate(regexp_extract(rest, '^[^/?#]*', 0),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, split_part(coalesce(url, ''), '#', 1) AS node
    FROM (SELECT *, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
          FROM pages)
), judged AS (
    SELECT p.page_id, p.host, p.path, p.node, (
        SELECT {'rule': r.host || r.path, 'verdict': r.verdict} FROM rules r
        WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
        ORDER BY length(r.host || r.path) DESC LIMIT 1) AS r
    FROM parsed p
), edges AS (
    SELECT node AS a, regexp_extract(tag, '(?is)(?:href|url)\\s*=\\s*["'']?([^"''>\\s]+)', 1) AS b
    FROM (SELECT node, unnest(regexp_extract_all(html,
        '(?is)<(?:link\\b[^>]*rel\\s*=\\s*["'']?canonical|meta\\b[^>]*http-equiv\\s*=\\s*["'']?refresh)[^>]*>')) AS tag
        FROM parsed)
), both_ways AS (
    SELECT a, b FROM edges UNION SELECT b, a FROM edges
), reached AS (
    SELECT node FROM judged WHERE r.verdict = 'block'
    UNION
    SELECT b FROM both_ways JOIN reached ON a = node
)
SELECT page_id, host, path, r.rule AS rule,
       coalesce(r.verdict, CASE WHEN node IN (SELECT node FROM reached) THEN 'block' ELSE 'allow' END) AS verdict
FROM judged
""")
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


@query("op9_simhash")
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"), "component_id")


@query("op5_fingerprint")
def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_next(table(spark, sf_dir, "documents"))


@query("op4_chat_format")
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                 "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(more)
    return chat.digests(materialize(chat.format_chat(turns), "chat"))


@query("op7_token_count")
def op7_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op6_quality")
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judge(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("row.doc_id", *quality.STATS, "base_failed", "kept", "score")


def with_planted_period(docs: DataFrame) -> DataFrame:
    """doc_id and text; where crc32 of the id is divisible by ten, the words from some place on repeat with a period."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def repeated(words):
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        unit = F.slice(words, (a + 1).cast("int"), p.cast("int"))
        times = F.array_repeat(unit, F.ceil((n - a) / p).cast("int"))
        row = F.concat(F.slice(words, 1, a.cast("int")), F.slice(F.flatten(times), 1, (n - a).cast("int")))
        return F.when(n > 0, F.array_join(row, " "))

    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    changed = F.when(h % 10 == 0, F.transform(F.array(words), repeated)[0])
    return docs.select("doc_id", F.coalesce(changed, "text").alias("text"))


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(with_planted_period(table(spark, sf_dir, "documents")))
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    best = F.reduce("runs", none, lambda best, run: F.when(  # in order of start and period: the first of equal ones stays
        best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *(r[x].cast("string") for x in ("start", "length", "period"))))
    listed = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    found = found.select("*", best.alias("best"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query("op12_hard_negatives", """
WITH vecs AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), parts AS (
    SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM vecs
), scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(sum(a.x * b.x) AS BIGINT) AS score
    FROM parts a JOIN parts b ON a.d = b.d WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
    GROUP BY a.vec_id, b.vec_id, a.label = b.label
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) <= 3
""")
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    double = F.transform("embedding", lambda x: x.cast("double"))
    finite = ~F.exists(double, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("embedding").isNotNull() & finite)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", label.alias("label"), F.transform(double, lambda x: F.floor(256 * x)).alias("vector"),
                       (F.col("vec_id") % 50 == 0).alias("anchor"))
    return hard_negatives.mine(rows, "vec_id", "vector", "label", "anchor", positives=5, negatives=3, window=(50, 95))


@query("op13_embedding_graph", """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, [CAST(x AS DOUBLE) FOR x IN embedding] AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98
), reached AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
)
SELECT vec_id, coalesce(n, 0) AS n_links, least AS component_id, vec_id = least AS kept
FROM embeddings LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) ON a = vec_id
JOIN (SELECT a AS node, min(b) AS least FROM reached GROUP BY a) ON node = vec_id
""")
def op13_embedding_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_graph.near_duplicates(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label", 0.98)

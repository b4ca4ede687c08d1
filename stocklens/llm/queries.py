"""The registered query of each operator, with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklens.llm.bpe import encoded
from stocklens.llm.centroids import kmeans
from stocklens.llm.chosen_path import near_duplicates
from stocklens.llm.cover_tree import similar_vectors
from stocklens.llm.packing import pack
from stocklens.llm.prefix_trie import prefix_trie
from stocklens.llm.quality import fit_quality, quality
from stocklens.llm.redirects import url_verdicts
from stocklens.llm.shared import fold, table
from stocklens.llm.substrings import repeated_windows
from stocklens.llm.templates import main_text
from stocklens.llm.toxicity import fit_toxicity, toxicity
from stocklens.llm.voronoi import top_inner_products
from stocklens.llm.warc import archived

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_packing(spark, directory):
    return pack(table(spark, directory, "documents"))


@query
def op2_templates(spark, directory):
    return main_text(table(spark, directory, "pages"))


@query
def op3_voronoi(spark, directory):
    return top_inner_products(table(spark, directory, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op4_quality(spark, directory):
    documents = table(spark, directory, "documents")
    remainder = fold(F.col("doc_id"), 5)
    model = fit_quality(documents, table(spark, directory, "labels"), is_training=remainder != 0)
    return quality(documents, model).select(
        "doc_id", (remainder == 0).alias("held_out"), "score", "predicted"
    )


@query
def op5_redirects(spark, directory):
    return url_verdicts(table(spark, directory, "pages"), URL_RULES)


@query
def op6_cover_tree(spark, directory):
    return similar_vectors(table(spark, directory, "embeddings"))


@query
def op7_bpe(spark, directory):
    import public_tokenizers as vocabularies

    return encoded(
        table(spark, directory, "documents"),
        vocabularies.path("byte_bpe_50k.tiktoken"),
        vocabularies.PATTERN,
    )


@query
def op8_warc(spark, directory):
    return archived(table(spark, directory, "pages"))


@query
def op9_toxicity(spark, directory):
    documents = table(spark, directory, "documents")
    remainder = fold(F.col("doc_id"), 3)
    model = fit_toxicity(documents, table(spark, directory, "labels"), is_training=remainder != 1)
    return toxicity(documents, model).select(
        "doc_id", (remainder == 1).alias("held_out"), "score", "predicted", "n_segments"
    )


@query
def op10_chosen_path(spark, directory):
    return near_duplicates(table(spark, directory, "documents"), words=3, percent=85)


@query
def op11_threshold_kmeans(spark, directory):
    return kmeans(table(spark, directory, "embeddings"), clusters=16, rounds=3)


@query
def op12_prefix_trie(spark, directory):
    return prefix_trie(table(spark, directory, "conversations"))


@query
def op13_anchor_dedup(spark, directory):
    return repeated_windows(table(spark, directory, "documents"), span=35, period=21)


def _kmeans_sql(clusters: int = 16, rounds: int = 3, width: int = 64) -> str:
    """DuckDB: the same rounds unrolled, every distance computed."""

    def assign(step: int) -> str:
        return f"""a{step} AS (
    SELECT rid, vec_id, x, cluster, dist FROM (
        SELECT *, row_number() OVER (PARTITION BY rid ORDER BY dist, cluster) AS r FROM (
            SELECT v.rid, v.vec_id, v.x, c{step - 1}.cluster, list_sum(list_transform(range(1, {width + 1}),
                lambda i: (v.x[i] - c{step - 1}.c[i]) * (v.x[i] - c{step - 1}.c[i]))) AS dist
            FROM v, c{step - 1}))
    WHERE r = 1)"""

    def update(step: int) -> str:
        return f"""s{step} AS (
    SELECT cluster, i, CAST(sum(x[i]) AS HUGEINT) AS s, count(*) AS n
    FROM a{step}, range(1, {width + 1}) t(i) GROUP BY cluster, i
), n{step} AS (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM s{step} GROUP BY cluster
), c{step} AS (
    SELECT cluster, c FROM n{step}
    UNION ALL SELECT cluster, c FROM c{step - 1} WHERE cluster NOT IN (SELECT cluster FROM n{step}))"""

    parts = [f"""v AS (
    SELECT row_number() OVER () AS rid, vec_id,
        list_transform(embedding, lambda e: CAST(floor(64 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) = {width}
        AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {width}
), c0 AS (
    SELECT CAST(row_number() OVER (ORDER BY h, x) - 1 AS INTEGER) AS cluster, x AS c FROM (
        SELECT sha256('1:' || vec_id) AS h, x FROM v WHERE vec_id IS NOT NULL ORDER BY h, x LIMIT {clusters}))"""]
    for step in range(1, rounds + 1):
        parts += [assign(step), update(step)]
    parts.append(assign(rounds + 1))
    last = f"a{rounds + 1}"
    return "WITH " + ",\n".join(parts) + f"""
SELECT a.vec_id, a.cluster, CAST(a.dist AS BIGINT) AS distance,
    CAST(t.cluster_inertia AS BIGINT) AS cluster_inertia, CAST(t.inertia AS BIGINT) AS inertia,
    sha256(array_to_string(c{rounds}.c, ',')) AS centroid_sha256
FROM {last} a
JOIN (SELECT cluster, sum(dist) AS cluster_inertia, sum(sum(dist)) OVER () AS inertia FROM {last} GROUP BY cluster) t
    USING (cluster)
JOIN c{rounds} USING (cluster)"""


ORACLE["op11_threshold_kmeans"] = _kmeans_sql()

# pages of the sample tables hold no redirect and no canonical link, so rules alone decide there
ORACLE["op5_redirects"] = r"""
WITH parts AS (
    SELECT page_id,
        translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1), ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
    FROM pages
), judged AS (
    SELECT *, CASE
        WHEN (host = 'example.org' OR suffix(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN (host = 'example.org' OR suffix(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
        WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/') THEN 'org/'
        END AS rule
    FROM parts
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged"""

ORACLE["op3_voronoi"] = """
WITH x AS (
    SELECT vec_id, list_transform(embedding, c -> CAST(floor(64 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, c -> c IS NOT NULL AND isfinite(c))) = len(embedding)
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(
        CAST(q.x AS DOUBLE[]), CAST(c.x AS DOUBLE[])) AS BIGINT) AS score
    FROM x q JOIN x c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), r AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""

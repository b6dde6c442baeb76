"""One query per operator, over the whole table it is meant for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.llm import exact_dedup, fixity, hard_negatives, jaccard_join, mixing, packing, phrases, suffixes, token_files, topk_search, toxicity, url_filter, wrappers


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup.exact_groups(table(spark, folder, "documents"), all_digests=True)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("full_hash").alias("text_sha256"))


def op2_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return topk_search.top_k(vectors.where("vec_id % 50 = 0"), vectors)


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.round_trip(table(spark, folder, "documents"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxic_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.near_components(table(spark, folder, "documents")).drop("text_hash")


def op6_fixity_audit(spark: SparkSession, folder: str) -> DataFrame:
    """The pages as WARC records against a replica with rotten, truncated, grown, missing and extra ones, each every 97th page."""
    pages = table(spark, folder, "pages")
    rotten = F.concat(F.lit("~"), F.substring("html", 2, 2**31 - 1))
    nth, some = F.col("page_id") % 97, F.length("html") > 0
    half = F.substring("html", F.lit(1), F.floor(F.length("html") / 2).cast("int"))
    html = F.when((nth == 5) & some, rotten).when((nth == 23) & some, half).when(nth == 41, F.concat(F.coalesce("html", F.lit("")), F.lit("~")))
    replica = pages.withColumn("html", html.otherwise(F.col("html"))).where(~(F.coalesce(nth, F.lit(0)) == 59))
    extra = pages.where(nth == 77).withColumn("page_id", -1 - F.col("page_id"))
    return fixity.audited(pages, replica.unionByName(extra))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).drop("place")


def op8_wrapper_induction(spark: SparkSession, folder: str) -> DataFrame:
    return wrappers.main_text(table(spark, folder, "pages"))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"))


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages"))


def op11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Every seventh label is wrong by one, as in a noisy set."""
    vectors = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.where("vec_id % 50 = 0"), vectors, label=label)


def op13_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.without_repeats(table(spark, folder, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup, op2_topk_search, op3_token_files, op4_toxicity, op5_jaccard_join,
        op6_fixity_audit, op7_mixing, op8_wrapper_induction, op9_packing, op10_url_filter, op11_phrases, op12_hard_negatives, op13_suffix_dedup,
    )
}

SQL = {
    "op1_exact_dedup": """
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)""",
    "op2_topk_search": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
          FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op11_phrases": """
        WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
        w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM p),
        s AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
        g AS (SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase FROM s, (SELECT unnest([1, 2, 3]) AS m) WHERE i + m - 1 <= len(ws)),
        f AS (SELECT lang, m, phrase, count(*) AS a FROM g GROUP BY ALL),
        c AS (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE m > 1 AND a >= 10),
        k AS (SELECT c.lang, c.m, c.phrase, c.a, k, array_to_string(ws[:k], ' ') AS x, array_to_string(ws[k + 1:], ' ') AS y
          FROM c, (SELECT unnest([1, 2]) AS k) WHERE k < c.m),
        z AS (SELECT k.lang, k.phrase, k.a, k.k, fx.a AS l, fy.a AS r,
            CAST((1000000::HUGEINT * k.a * k.a) // (fx.a::HUGEINT * fy.a) AS BIGINT) AS score
          FROM k JOIN f fx ON fx.lang = k.lang AND fx.phrase = k.x JOIN f fy ON fy.lang = k.lang AND fy.phrase = k.y),
        b AS (SELECT * FROM z QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        i AS (SELECT lang, array_to_string(ws[j:j + 1], ' ') AS phrase, max(a) AS longer FROM c, (SELECT unnest([1, 2]) AS j) WHERE m = 3 GROUP BY ALL),
        kept AS (SELECT b.* FROM b LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase WHERE i.longer IS NULL OR 100 * i.longer < 50 * b.a),
        t AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang)
        SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, t.n, score
        FROM kept JOIN t ON t.lang = kept.lang QUALIFY rank <= 2000""",
    "op12_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
          FROM v a JOIN v c ON c.vec_id <> a.vec_id WHERE a.vec_id % 50 = 0),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        r AS (SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
            CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
          FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 3""",
}

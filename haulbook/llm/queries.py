"""The registered queries of the operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulbook.llm import bpe, forest, langid, linededup, lmscore, mixing, nra, sharding, simhash, sketch, toxicity, vafile, warc
from haulbook.llm.common import crc_fold, ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(spark, table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(crc_fold("doc_id", langid.FOLDS) == langid.HELD_OUT_FOLD, F.lit(False))
    prototypes = langid.learn(docs, ~held_out)
    found = langid.with_language(docs.select("doc_id", "text"), prototypes)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op4_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.edit_report(table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(crc_fold("doc_id", toxicity.FOLDS) == toxicity.HELD_OUT_FOLD, F.lit(False))
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), ~held_out)
    found = toxicity.with_toxicity(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.without_repeated_lines(docs, stats=True).select("doc_id", "n_lines", "removed_lines", "text")


def op8_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: documents labelled as of good quality, but for a held-out fold of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_fold("doc_id", lmscore.FOLDS) == lmscore.HELD_OUT_FOLD, F.lit(False))
    good = table(spark, sf_dir, "labels").filter((F.col("quality") == 1) & ~held_out)
    found = lmscore.cross_entropy_difference(docs, good)
    return found.withColumn("held_out", held_out)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    shuffled = sharding.into_shards(docs)
    data = F.coalesce("text", F.lit("")).cast("binary")
    return shuffled.select(
        "doc_id",
        (F.octet_length(data) + 8).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op12_va_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.clusters(table(spark, sf_dir, "embeddings"))


def op13_nra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nra.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


ALL = [
    op1_warc,
    op2_language,
    op3_hash_forest,
    op4_sketch,
    op5_byte_bpe,
    op6_toxicity,
    op7_line_dedup,
    op8_cross_entropy,
    op9_mixing,
    op10_simhash,
    op11_sharding,
    op12_va_file,
    op13_nra,
]


def _k_means_sql(rounds: int = vafile.ROUNDS) -> str:
    """The rounds of op12, one after another, over one row per vector and component."""
    kept = f"""
        kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id,
                list_transform(embedding, lambda x: floor({vafile.SCALE} * x::double)::bigint) AS v
            FROM embeddings WHERE len(embedding) = {vafile.DIMENSIONS}
                AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {vafile.DIMENSIONS}),
        axes AS MATERIALIZED (SELECT r, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM kept),
        c0 AS MATERIALIZED (SELECT n, unnest(v) AS x, generate_subscripts(v, 1) AS d
            FROM (SELECT row_number() OVER (ORDER BY sha256('{vafile.SEED}:' || vec_id)) - 1 AS n, v FROM kept)
            WHERE n < {vafile.CENTROIDS})"""
    near = """
        a{i} AS MATERIALIZED (SELECT r, min(f).n AS n, min(f).far AS far
            FROM (SELECT r, {{'far': far, 'n': n}} AS f
                FROM (SELECT a.r, c.n, sum((a.x - c.x) * (a.x - c.x)) AS far FROM axes a JOIN c{i} c USING (d) GROUP BY ALL))
            GROUP BY r)"""
    move = """
        c{j} AS MATERIALIZED (SELECT c.n, c.d, coalesce((s.t - ((s.t % s.m) + s.m) % s.m) // s.m, c.x) AS x
            FROM c{i} c LEFT JOIN (SELECT n, d, sum(x) AS t, count(*) AS m FROM axes JOIN a{i} USING (r) GROUP BY ALL) s USING (n, d))"""
    steps = [kept, *[t.format(i=i, j=i + 1) for i in range(rounds) for t in (near, move)], near.format(i=rounds)]
    return f"""WITH {",".join(steps)}
        SELECT vec_id, a.n::int AS cluster, a.far::bigint AS distance,
            (sum(a.far) OVER (PARTITION BY a.n))::bigint AS cluster_inertia, (sum(a.far) OVER ())::bigint AS inertia,
            sha AS centroid_sha256
        FROM a{rounds} a JOIN kept USING (r) JOIN (
            SELECT n, sha256(string_agg(x::bigint::varchar, ',' ORDER BY d)) AS sha FROM c{rounds} GROUP BY n) USING (n)"""


QUERIES = {q.__name__: shipped(q) for q in ALL}
ORACLE_SQL: dict[str, str] = {
    "op1_warc": """
        SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha256(body) AS payload_digest,
            CASE WHEN octet_length(encode(body)) >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END
                AS record_type,
            CASE WHEN octet_length(encode(body)) >= 100 AND page_id <> first THEN first END AS refers_to
        FROM (SELECT page_id, coalesce(html, '') AS body, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
            FROM pages)""",
    "op12_va_file": _k_means_sql(),
    "op13_nra": """
        WITH words AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM documents),
        size AS (SELECT count(*)::bigint AS big_n, sum(len(ts))::bigint AS big_l FROM words WHERE len(ts) > 0),
        postings AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM words) GROUP BY ALL),
        weights AS (SELECT term, floor(1000 * ln((2 * max(big_n) + 2) / (2 * count(*) + 1)))::bigint AS w
            FROM postings, size GROUP BY term),
        asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
        lengths AS (SELECT r, doc_id, 100 - 50 + ((50 * len(ts) * big_n) // big_l) AS m FROM words, size WHERE len(ts) > 0),
        scores AS (SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS score
            FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN lengths USING (r) GROUP BY ALL)
        SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::int AS rank, doc_id,
            score::bigint AS score
        FROM scores WHERE score > 0
        QUALIFY rank <= 50""",
}

"""One query per operator, over its whole table, with its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from custos.llm import balltree, byte_bpe, decontamination, filter_audit, jaccard_join, langid, lexical_topk, packing, pii, quality, secrets, substring_dedup, warc
from custos.llm.common import scratch_path, table

QUERIES = {}
SQL: dict[str, str] = {}


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return put


def remainder(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(id_col.cast("string")) % n


@query("op1_ngram_jaccard_join")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), n=3, percent=90)


@query("op2_warc_roundtrip")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error")


@query("op3_balltree_topk", """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.top_k(table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0, k=5)


@query("op4_best_fit_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op5_benchmark_decontamination", r"""
WITH d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents
), i AS (
    SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM benchmark
), ic AS (
    SELECT DISTINCT item_id, array_to_string(w[k:k + least(len(w), 5) - 1], ' ') AS s, least(len(w), 5) AS width
    FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS k FROM i WHERE len(w) > 0)
), widths AS (SELECT DISTINCT width FROM ic
), dc AS (
    SELECT DISTINCT doc_id, array_to_string(w[k:k + width - 1], ' ') AS s
    FROM (SELECT doc_id, w, width, unnest(generate_series(1, len(w) - width + 1)) AS k FROM d, widths WHERE len(w) >= width)
), n AS (SELECT item_id, count(*) AS item_shingles FROM ic GROUP BY item_id
), hit AS (SELECT doc_id, item_id, count(*) AS shared FROM dc JOIN ic USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, shared, item_shingles FROM hit JOIN n USING (item_id) WHERE shared * 100 >= item_shingles * 80
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_sentence_span_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, sf_dir, "documents"))


@query("op7_secret_scan")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan_secrets(table(spark, sf_dir, "documents")))


@query("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, lambda i: remainder(i, 4) != 2)
    held = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    return langid.identify(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query("op9_quality_ranking")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), lambda i: remainder(i, 3) != 1)
    held = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    return quality.score_documents(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


@query("op10_pii_boosting")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.digest(pii.find_pii(docs, pii.fit(docs)))


@query("op11_byte_bpe")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as tokenizers

    how = tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN
    return byte_bpe.digest(byte_bpe.decode_documents(byte_bpe.encode_documents(table(spark, sf_dir, "documents"), *how), *how))


@query("op12_filter_interactions", r"""
WITH d AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
), w AS (
    SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words, min(doc_id) OVER (PARTITION BY text) AS first_id FROM d
), m AS (
    SELECT doc_id, part, len(words) < 50 AS a, 100 * len(list_distinct(words)) < 65 * len(words) AS b,
        100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d, coalesce(doc_id > first_id, false) AS e
    FROM w
), l AS (
    SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id
), k AS (
    SELECT part, {'A': a, 'B': b, 'C': c, 'D': d, 'E': e} AS fails, count(*) AS n, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS toxic
    FROM m LEFT JOIN l USING (doc_id) GROUP BY ALL
), f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), o AS (
    SELECT x1.f || x2.f || x3.f || x4.f || x5.f AS filter_order FROM f x1, f x2, f x3, f x4, f x5
    WHERE len(list_distinct([x1.f, x2.f, x3.f, x4.f, x5.f])) = 5
), s AS (
    SELECT part, filter_order, step, filter_order[step] AS f, n, good, toxic, struct_extract_at(fails, 1) AS a, struct_extract_at(fails, 2) AS b, struct_extract_at(fails, 3) AS c,
        struct_extract_at(fails, 4) AS d, struct_extract_at(fails, 5) AS e,
        list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: CASE x WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END) AS failed
    FROM k, o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), r AS (
    SELECT part, filter_order, step, f, n, good, toxic, failed, list_contains(failed, f) AS fails_it,
        coalesce(list_min(list_transform(failed, lambda x: strpos(filter_order, x))), 6) AS gone
    FROM s
), t AS (
    SELECT part, filter_order, step, f, sum(n) FILTER (gone > step) AS kept, sum(n) FILTER (gone = step) AS removed, sum(n) FILTER (fails_it AND gone < step) AS redundant,
        sum(n) FILTER (failed = [f]) AS unique_fails, sum(good) FILTER (gone = step) AS good_lost, sum(toxic) FILTER (gone = step) AS toxic_lost
    FROM r GROUP BY ALL
)
SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
    coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
    coalesce(sum(removed) OVER (PARTITION BY part, f), 0)::BIGINT AS shapley
FROM t
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(filter_audit.mask_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


@query("op13_pair_maxscore", r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), t AS (
    SELECT doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM d
), c AS (
    SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM t GROUP BY ALL
), s AS (SELECT count(*)::BIGINT AS documents, sum(len(terms))::BIGINT AS total FROM d WHERE len(terms) > 0
), f AS (
    SELECT term, floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM c, s GROUP BY term, documents
), q AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), r AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * documents) // total))))::BIGINT AS score
    FROM q JOIN f USING (term) JOIN c USING (term), s GROUP BY item_id, doc_id
), k AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM r WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 10
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_topk.top_k(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)

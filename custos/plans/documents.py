"""Registered queries: document chunking, retrieval, context packing, conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from custos.operators import docs
from custos.plans.registry import register
from custos.sources.fixtures import fixture, with_views
from custos.sources.tables import scan

SIZE, OVERLAP, K = 600, 20, 5
BUDGET = 4096 - 512

_WS = r"[ \t\n\r\f\x0B]+"
_CHUNKS = f"""cw AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '{_WS}'), lambda x: x <> '') AS w FROM documents),
cs AS (SELECT doc_id, w, unnest(generate_series(0, greatest(len(w) - {OVERLAP + 1}, 0), {SIZE - OVERLAP})) AS s FROM cw WHERE len(w) > 0),
chunks AS (SELECT doc_id, cast(row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS integer) AS chunk_id,
  array_to_string(w[s + 1 : s + {SIZE}], ' ') AS text, cast(len(w[s + 1 : s + {SIZE}]) AS integer) AS n_tokens FROM cs)"""


def chunks(spark, sf):
    return docs.chunk(scan(spark, sf, "documents"), SIZE, OVERLAP)


@register("doc_chunks", f"WITH {_CHUNKS}\nSELECT * FROM chunks")
def doc_chunks(spark, sf):
    return chunks(spark, sf)


_CENTROIDS = """u AS (SELECT label, unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding) AS v FROM embeddings),
q AS (SELECT label AS query_id, list(v ORDER BY i) AS qv FROM
        (SELECT label, i, avg(cast(v AS double)) AS v FROM u GROUP BY label, i) GROUP BY label)"""


@register("doc_topk", f"""WITH {_CENTROIDS},
sc AS (SELECT query_id, vec_id, list_cosine_similarity(qv, cast(embedding AS DOUBLE[])) AS score FROM q, embeddings)
SELECT query_id, cast(rank AS integer) AS rank, vec_id, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM sc) WHERE rank <= {K}""")
def doc_topk(spark, sf):
    e = scan(spark, sf, "embeddings")
    q = docs.centroids(e, "label", "embedding").withColumnRenamed("label", "query_id")
    t = docs.top_k_vectors(q, e, K)
    return t.withColumn("score", F.round("score", 6))


_LEX = f"""{_CHUNKS},
qt AS (SELECT DISTINCT item_id AS query_id, unnest(list_filter(regexp_split_to_array(lower(text), '{_WS}'), lambda x: x <> '')) AS term FROM benchmark),
ct AS (SELECT DISTINCT doc_id, chunk_id, unnest(list_filter(regexp_split_to_array(lower(text), '{_WS}'), lambda x: x <> '')) AS term FROM chunks),
hits AS (SELECT query_id, doc_id, chunk_id, count(*) AS score FROM qt JOIN ct USING (term) GROUP BY ALL),
top AS (SELECT h.query_id, cast(row_number() OVER (PARTITION BY h.query_id ORDER BY h.score DESC, h.doc_id, h.chunk_id) AS integer) AS rank,
  h.doc_id, h.chunk_id, h.score FROM hits h),
topk AS (SELECT t.*, c.n_tokens FROM top t JOIN chunks c USING (doc_id, chunk_id) WHERE rank <= {K})"""


def lexical(spark, sf):
    q = scan(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return docs.top_k_lexical(q, chunks(spark, sf), K)


@register("doc_lexical_topk", f"WITH {_LEX}\nSELECT * FROM topk")
def doc_lexical_topk(spark, sf):
    return lexical(spark, sf)


@register("doc_context_pack", f"""WITH {_LEX}
SELECT * FROM (SELECT *, sum(n_tokens) OVER (PARTITION BY query_id ORDER BY rank) AS running_tokens FROM topk)
WHERE running_tokens <= {BUDGET}""")
def doc_context_pack(spark, sf):
    return docs.pack_context(lexical(spark, sf), BUDGET).withColumn("running_tokens", F.col("running_tokens").cast("bigint"))


_HIST = "hist AS (SELECT conv_id, string_agg(piece, '' ORDER BY turn) AS history FROM chat_strings GROUP BY conv_id)"


def history(spark, sf):
    return docs.serialize_conversation(fixture(spark, sf, "chat_strings"))


@register("conversation_history", with_views(f"WITH {_HIST}\nSELECT * FROM hist", "chat_strings"))
def conversation_history(spark, sf):
    return history(spark, sf)


@register("conversation_turns", with_views(f"""WITH {_HIST},
parts AS (SELECT conv_id, unnest(generate_series(0, len(string_split(history, '<split>')) - 1)) AS pos,
  string_split(history, '<split>') AS arr, len(string_split(history, '<split>')) AS n FROM hist)
SELECT conv_id, cast(pos AS integer) AS pos, CASE WHEN pos % 2 = 0 THEN 'Human' ELSE 'ChatBot' END AS role, arr[pos + 1] AS part
FROM parts WHERE pos < n - 1 OR arr[pos + 1] <> ''""", "chat_strings"))
def conversation_turns(spark, sf):
    return docs.parse_conversation(history(spark, sf))

"""Queries of retrieval, layout and nested data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import chunks as C
from ..operators import layout as G
from ..operators import nested as N
from ..operators import retrieval as R
from .common import base, once, once_sql
from .lines import _C200, _P200

KM = once_sql("knowledge_main", "chunk_id", "text", "document_id")
QUERY = "mathematics lesson for reading and writing"


def _emb(spark, sf):
    return base(spark, sf, "embeddings")


def _query(spark, sf, key: int = 7) -> list[float]:
    return R.vector_of(_emb(spark, sf), "vec_id", key, "embedding")


def near_vector(spark: SparkSession, sf: str) -> DataFrame:
    return R.nearest(_emb(spark, sf), "embedding", _query(spark, sf), "vec_id", 10)


def semantic_search(spark: SparkSession, sf: str) -> DataFrame:
    return R.nearest(_emb(spark, sf), "embedding", _query(spark, sf, 3), "vec_id", 5)


def near_object(spark: SparkSession, sf: str) -> DataFrame:
    return R.nearest(_emb(spark, sf), "embedding", _query(spark, sf, 11), "vec_id", 10, where=F.col("vec_id") != 11)


def certainty_threshold(spark: SparkSession, sf: str) -> DataFrame:
    d = _emb(spark, sf).withColumn("distance", R.distance(R.cosine_to(F.col("embedding"), _query(spark, sf))))
    return d.where("1 - distance / 2 >= 0.6").select("vec_id", "label", "distance")


def filtered_search(spark: SparkSession, sf: str) -> DataFrame:
    return R.nearest(_emb(spark, sf), "embedding", _query(spark, sf), "vec_id", 10, where=(F.col("label") == 3) & (F.col("vec_id") >= 0))


def tag_filter(spark: SparkSession, sf: str) -> DataFrame:
    return base(spark, sf, "documents", "doc_id", "title", "topics").where(F.array_contains("topics", "music")).select("doc_id", "title")


def best_chunk_per_doc(spark: SparkSession, sf: str) -> DataFrame:
    return R.best_per_document(R.nearest(_emb(spark, sf), "embedding", _query(spark, sf), "vec_id", 20), "label", "vec_id", 5)


def knn_join(spark: SparkSession, sf: str) -> DataFrame:
    """Queries are the rows whose id is divisible by 50, against all rows."""
    return R.knn_join(_emb(spark, sf).where("vec_id % 50 = 0"), _emb(spark, sf), "vec_id", "embedding", 5)


def similar_chunks(spark: SparkSession, sf: str) -> DataFrame:
    d = once(spark, sf, "knowledge_main", "chunk_id", "text").where("text is not null").withColumn("v", R.hash_embedding(F.col("text")))
    q = [float(x) for x in spark.range(1).select(R.hash_embedding(F.lit(QUERY)).alias("v")).first().v]
    return R.nearest(d, "v", q, "chunk_id", 10).select("chunk_id", "distance")


def context_concat(spark: SparkSession, sf: str) -> DataFrame:
    d = once(spark, sf, "knowledge_main", "chunk_id", "text").where("text is not null").withColumn("v", R.hash_embedding(F.col("text")))
    q = [float(x) for x in spark.range(1).select(R.hash_embedding(F.lit(QUERY)).alias("v")).first().v]
    return R.context(R.nearest(d, "v", q, "chunk_id", 3), "text", "chunk_id")


def chunk_search(spark: SparkSession, sf: str) -> DataFrame:
    """Texts cut into windows, embedded, ranked by distance to a question; the best window of each document."""
    chunks = C.token_windows(base(spark, sf, "documents", "doc_id", "text"), "text", 200, 50)
    key = chunks.withColumn(
        "chunk_key", F.col("doc_id") * 1_000_000 + F.col("chunk_index"),
    ).withColumn("v", R.hash_embedding(F.col("content"))).drop("content", "n_tokens")
    q = [float(x) for x in spark.range(1).select(R.hash_embedding(F.lit(QUERY)).alias("v")).first().v]
    return R.best_per_document(
        R.nearest(key, "v", q, "chunk_key", 20), "doc_id", "chunk_key", 5,
    ).select("doc_id", "chunk_index", "distance", "total_chunks")


def hash_embedding(spark: SparkSession, sf: str) -> DataFrame:
    d = base(spark, sf, "documents", "doc_id", "text").where("text is not null")
    return d.select(
        "doc_id", F.posexplode(R.hash_embedding(F.col("text"))).alias("bucket", "n"),
    ).where("n > 0").select("doc_id", "bucket", F.col("n").cast("bigint").alias("n"))


def bm25_topk(spark: SparkSession, sf: str) -> DataFrame:
    return R.bm25(base(spark, sf, "documents", "doc_id", "text"), "doc_id", "text", QUERY, 10)


def hybrid_search(spark: SparkSession, sf: str) -> DataFrame:
    d = base(spark, sf, "documents", "doc_id", "text").where("text is not null")
    q = [float(x) for x in spark.range(1).select(R.hash_embedding(F.lit(QUERY)).alias("v")).first().v]
    v = R.nearest(d.withColumn("v", R.hash_embedding(F.col("text"))), "v", q, "doc_id", 50)
    return R.hybrid(v, R.bm25(d, "doc_id", "text", QUERY, 50), "doc_id", 0.5, 10)


def _blocks(spark, sf):
    e = _emb(spark, sf)
    return e.select("label", "vec_id", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))


def histogram_10(spark: SparkSession, sf: str) -> DataFrame:
    return G.histogram(_blocks(spark, sf), "label", "x").select("label", "bin", "n")


def histogram_peaks(spark: SparkSession, sf: str) -> DataFrame:
    return G.peaks(_blocks(spark, sf), "label", "x", 0.12).select("label", "bin", F.round("centre", 6).alias("centre"), "n")


def nearest_peak_assign(spark: SparkSession, sf: str) -> DataFrame:
    b = _blocks(spark, sf)
    return G.columns_of_blocks(b, "label", "vec_id", "x", G.peaks(b, "label", "x", 0.12)).select("vec_id", "label", "column_no")


def columns_per_page(spark: SparkSession, sf: str) -> DataFrame:
    return G.columns_per_page(_blocks(spark, sf), "label", "x", 0.12)


def reading_order_bands(spark: SparkSession, sf: str) -> DataFrame:
    b = _blocks(spark, sf)
    placed = G.columns_of_blocks(b, "label", "vec_id", "x", G.peaks(b, "label", "x", 0.12))
    return G.reading_order(placed, "label", "vec_id", "y", "column_no").select("vec_id", "label", "band", "place")


def json_flatten_one_level(spark: SparkSession, sf: str) -> DataFrame:
    d = base(spark, sf, "source_document", "id", "metadata").groupBy("id").agg(
        F.struct(
            F.max("metadata.filename").alias("filename"), F.max("metadata.file_size").alias("file_size"), F.max("metadata.author").alias("author"),
        ).alias("metadata")
    )
    return N.flattened(d, sep="_")


def json_nested_split(spark: SparkSession, sf: str) -> DataFrame:
    d = base(spark, sf, "documents", "doc_id", "topics", "title")
    return N.side_tables(d, "doc_id")[1]["topics"]


def json_multi_sheet(spark: SparkSession, sf: str) -> DataFrame:
    j = F.concat(F.lit('{"head":'), F.col("props"), F.lit(',"rows":['), F.col("props"), F.lit(","), F.col("props"), F.lit("]}"))
    d = base(spark, sf, "events", "event_id", "props").select("event_id", j.alias("j"))
    return N.sheets(d, "event_id", "j").select("event_id", "sheet", "row_no", F.element_at("cells", "k").cast("bigint").alias("k"))


def nested_counts(spark: SparkSession, sf: str) -> DataFrame:
    d = base(spark, sf, "source_document", "id", "pages").groupBy("id").agg(
        F.max(F.size("pages")).alias("n_pages"),
        F.max(
            F.aggregate(F.transform("pages", lambda p: F.size(F.split(F.coalesce(p["text"], F.lit("")), "\n"))), F.lit(0), lambda a, b: a + b)
        ).alias("n_lines"),
    )
    return d.where("n_pages > 0")


_Q7 = "(SELECT embedding AS q FROM embeddings WHERE vec_id = {0})"
_ZERO = "CASE WHEN abs({0}) < 0.000000001 THEN 0.0::DOUBLE ELSE {0} END"
_DIST = _ZERO.format(
    "round(1 - list_inner_product(embedding::DOUBLE[], q::DOUBLE[]) / (sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) * sqrt(list_inner_product(q::DOUBLE[], q::DOUBLE[]))), 6)"
)
_NEAR = "SELECT vec_id, label, " + _DIST + " AS distance FROM embeddings, " + _Q7
_VEC = "list_transform(generate_series(0, 63), lambda i: len(list_filter(list_transform(list_filter(regexp_split_to_array(lower({0}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> ''), lambda w: ('0x' || substring(md5(w), 1, 8))::BIGINT % 64), lambda b: b = i))::DOUBLE)"
_TEXTD = _ZERO.format("round(1 - list_inner_product(v, q) / (sqrt(list_inner_product(v, v)) * sqrt(list_inner_product(q, q))), 6)")
_SIM = f"(SELECT chunk_id, text, {_TEXTD} AS distance FROM (SELECT chunk_id, text, {_VEC.format('text')} AS v, {_VEC.format(f"'{QUERY}'")} AS q FROM {KM} WHERE text IS NOT NULL) WHERE list_sum(v) > 0 ORDER BY distance, chunk_id)"
_STOP = ", ".join(f"'{w}'" for w in sorted(R.STOP_WORDS))
_BM = f"""(WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '' AND NOT list_contains([{_STOP}], x)) AS w FROM documents WHERE text IS NOT NULL), n AS (SELECT count(*)::DOUBLE AS rows, avg(len(w)) AS mean FROM w),
    t AS (SELECT unnest(['lesson', 'mathematics', 'reading', 'writing']) AS t), f AS (SELECT doc_id, t, len(w) AS dl, len(list_filter(w, lambda x: x = t))::DOUBLE AS f FROM w, t), d AS (SELECT t, sum((f > 0)::INT)::DOUBLE AS df FROM f GROUP BY t)
    SELECT doc_id, round(sum(ln(1 + (rows - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * f * 2.2::DOUBLE / (f + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / mean))), 6) AS score FROM f JOIN d USING (t), n GROUP BY doc_id HAVING score > 0 ORDER BY score DESC, doc_id LIMIT @N)"""
_XY = "(SELECT label, vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings)"
_HIST = f"""(SELECT e.label, b.bin::INT AS bin, lo, hi, coalesce(n, 0)::BIGINT AS n FROM (SELECT label, min(x) AS lo, max(x) AS hi FROM {_XY} GROUP BY label) e CROSS JOIN (SELECT unnest(generate_series(0, 9)) AS bin) b
    LEFT JOIN (SELECT label, CASE WHEN hi = lo THEN 5 ELSE least(floor((x - lo) / nullif(hi - lo, 0) * 10), 9) END AS bin, count(*) AS n FROM {_XY} JOIN (SELECT label, min(x) AS lo, max(x) AS hi FROM {_XY} GROUP BY label) USING (label) GROUP BY 1, 2) h ON h.label = e.label AND h.bin = b.bin)"""
_PEAK = f"(SELECT label, bin, lo + (bin + 0.5::DOUBLE) * CASE WHEN hi = lo THEN 1 ELSE hi - lo END / 10 AS centre, n FROM (SELECT *, lag(n) OVER w AS a, lead(n) OVER w AS z, sum(n) OVER (PARTITION BY label) AS alln FROM {_HIST} WINDOW w AS (PARTITION BY label ORDER BY bin)) WHERE n > a AND n > z AND n > 0.12::DOUBLE * alln)"
_COLS = f"""(SELECT b.label, b.vec_id, b.x, b.y, coalesce(p.c, 0)::INT AS column_no FROM {_XY} b LEFT JOIN (SELECT b.vec_id, min_by(r, (abs(x - centre), r)) AS c FROM {_XY} b JOIN (SELECT label, centre, row_number() OVER (PARTITION BY label ORDER BY centre) - 1 AS r FROM {_PEAK}) p ON p.label = b.label GROUP BY b.vec_id) p ON p.vec_id = b.vec_id)"""

ORACLES = {
    "near_vector": f"{_NEAR.format(7)} ORDER BY distance, vec_id LIMIT 10",
    "semantic_search": f"{_NEAR.format(3)} ORDER BY distance, vec_id LIMIT 5",
    "near_object": f"SELECT * FROM ({_NEAR.format(11)}) WHERE vec_id <> 11 ORDER BY distance, vec_id LIMIT 10",
    "certainty_threshold": f"SELECT * FROM ({_NEAR.format(7)}) WHERE 1 - distance / 2 >= 0.6",
    "filtered_search": f"SELECT * FROM ({_NEAR.format(7)}) WHERE label = 3 ORDER BY distance, vec_id LIMIT 10",
    "tag_filter": "SELECT doc_id, title FROM documents WHERE list_contains(topics, 'music')",
    "best_chunk_per_doc": f"SELECT vec_id, label, distance, total_chunks FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY distance, vec_id) AS r, count(*) OVER (PARTITION BY label) AS total_chunks FROM ({_NEAR.format(7)} ORDER BY distance, vec_id LIMIT 20)) WHERE r = 1 ORDER BY distance, vec_id LIMIT 5",
    "knn_join": f"SELECT query_id, id, rank, distance FROM (SELECT query_id, id, distance, (row_number() OVER (PARTITION BY query_id ORDER BY distance, id))::INT AS rank FROM (SELECT q.vec_id AS query_id, e.vec_id AS id, {
        _DIST.replace('q::', 'q.embedding::').replace('(embedding', '(e.embedding').replace(', embedding', ', e.embedding')
    } AS distance FROM embeddings e JOIN embeddings q ON q.vec_id % 50 = 0 AND q.vec_id <> e.vec_id)) WHERE rank <= 5",
    "similar_chunks": f"SELECT chunk_id, distance FROM {_SIM} LIMIT 10",
    "context_concat": f"SELECT string_agg(text, chr(10) || chr(10) ORDER BY distance, chunk_id) AS context FROM (SELECT * FROM {_SIM} LIMIT 3)",
    "chunk_search": f"""WITH c AS (SELECT doc_id, chunk_index, {_TEXTD} AS distance FROM (SELECT doc_id, chunk_index, {_VEC.format("array_to_string(" + _P200 + ", ' ')")} AS v, {_VEC.format(f"'{QUERY}'")} AS q FROM {_C200}) WHERE list_sum(v) > 0 ORDER BY distance, doc_id, chunk_index LIMIT 20)
        SELECT doc_id, chunk_index, distance, total_chunks FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY distance, chunk_index) AS r, count(*) OVER (PARTITION BY doc_id) AS total_chunks FROM c) WHERE r = 1 ORDER BY distance, doc_id, chunk_index LIMIT 5""",
    "hash_embedding": r"SELECT doc_id, (('0x' || substring(md5(w), 1, 8))::BIGINT % 64)::INT AS bucket, count(*) AS n FROM (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')) AS w FROM documents WHERE text IS NOT NULL) GROUP BY 1, 2",
    "bm25_topk": f"SELECT * FROM {_BM.replace('@N', '10')}",
    "hybrid_search": f"""WITH v AS (SELECT doc_id, 1 - distance AS v FROM (SELECT doc_id, {_TEXTD} AS distance FROM (SELECT doc_id, {_VEC.format('text')} AS v, {_VEC.format(f"'{QUERY}'")} AS q FROM documents WHERE text IS NOT NULL) WHERE list_sum(v) > 0 ORDER BY distance, doc_id LIMIT 50)), k AS (SELECT * FROM {_BM.replace("@N", "50")}),
        b AS (SELECT coalesce(v.doc_id, k.doc_id) AS doc_id, v, score AS k FROM v FULL JOIN k ON v.doc_id = k.doc_id), e AS (SELECT min(v) AS v0, max(v) AS v1, min(k) AS k0, max(k) AS k1 FROM b)
        SELECT doc_id, round(0.5::DOUBLE * coalesce((v - v0) / (v1 - v0), 0) + 0.5::DOUBLE * coalesce((k - k0) / (k1 - k0), 0), 5) AS score FROM b, e ORDER BY score DESC, doc_id LIMIT 10""",
    "histogram_10": f"SELECT label, bin, n FROM {_HIST}",
    "histogram_peaks": f"SELECT label, bin, round(centre, 6) AS centre, n FROM {_PEAK}",
    "nearest_peak_assign": f"SELECT vec_id, label, column_no FROM {_COLS}",
    "columns_per_page": f"SELECT l.label, greatest(1, count(p.bin)) AS n_columns FROM (SELECT DISTINCT label FROM embeddings) l LEFT JOIN {_PEAK} p ON p.label IS NOT DISTINCT FROM l.label GROUP BY l.label",
    "reading_order_bands": f"""WITH b AS (SELECT *, (CASE WHEN max(column_no) OVER w = 0 THEN 1 WHEN y < min(y) OVER w + 0.1::DOUBLE * (max(y) OVER w - min(y) OVER w) THEN 0 WHEN y > max(y) OVER w - 0.1::DOUBLE * (max(y) OVER w - min(y) OVER w) THEN 2 ELSE 1 END)::INT AS band FROM {_COLS} WINDOW w AS (PARTITION BY label))
        SELECT vec_id, label, band, (row_number() OVER (PARTITION BY label ORDER BY band, CASE WHEN band = 1 THEN column_no ELSE 0 END, y, vec_id))::INT AS place FROM b""",
    "json_flatten_one_level": "SELECT id, max(metadata.filename) AS metadata_filename, max(metadata.file_size) AS metadata_file_size, max(metadata.author) AS metadata_author FROM source_document GROUP BY id",
    "json_nested_split": "SELECT doc_id, (unnest(generate_series(0, len(topics) - 1)))::INT AS place, unnest(topics) AS value FROM documents WHERE len(topics) > 0",
    "json_multi_sheet": "SELECT event_id, sheet, row_no, json_extract_string(props, '$.k')::BIGINT AS k FROM events, (VALUES ('head', 0), ('rows', 0), ('rows', 1)) s(sheet, row_no)",
    "nested_counts": "SELECT id, max(len(pages))::INT AS n_pages, max(list_sum(list_transform(pages, lambda p: len(string_split(coalesce(p.text, ''), chr(10))))))::INT AS n_lines FROM source_document WHERE len(pages) > 0 GROUP BY id",
}
QUERIES = {k: globals()[k] for k in ORACLES}

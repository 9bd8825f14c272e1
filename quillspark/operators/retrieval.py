"""Retrieval: similarity, keyword ranking, both together, filters and grouping by document.

Distances are 1 minus the cosine. Every ranking has the key as its last criterion. Query vectors and query terms
are constants of the plan: the collection is read once and nothing is sent around but the best rows.
"""

import hashlib
import re
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import words

# Parameters of the ranking function and its stop words.
BM25_K1, BM25_B = 1.2, 0.75
STOP_WORDS = frozenset(
    "a an and are as at be but by for if in into is it no not of on or such that the their then there these they this to was will with".split()
)
# End of the fixed values.


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(F.transform(a, lambda x: x.cast("double") * x.cast("double")), F.lit(0.0), lambda s, x: s + x))


def cosine_to(a: Column, query: Sequence[float]) -> Column:
    """Cosine to a constant vector, null if the vector is null, zero or of another length."""
    size = float(sum(x * x for x in query)) ** 0.5
    q = F.array(*(F.lit(float(x)) for x in query))
    return F.when((F.size(a) == len(query)) & (size > 0), F.try_divide(dot(a, q), norm(a) * F.lit(size)))


def distance(cosine: Column) -> Column:
    """1 minus the cosine to six decimals, without a negative zero."""
    return F.round(1 - cosine, 6) + F.lit(0.0)


def nearest(df: DataFrame, vector: str, query: Sequence[float], key: str, k: int, where: Column | None = None) -> DataFrame:
    """The k nearest rows that pass the filter, with ``distance``; the filter goes first."""
    src = df if where is None else df.where(where)
    scored = src.withColumn("distance", distance(cosine_to(F.col(vector), query))).drop(vector)
    # the filter goes above the limit: pushed down, it would compute vectors and distances twice
    return scored.orderBy(F.asc_nulls_last("distance"), key).limit(k).where("distance is not null")


def best_per_document(hits: DataFrame, document: str, key: str, limit: int) -> DataFrame:
    """Of hits the best of each document, with the number of the document's hits."""
    w = Window.partitionBy(document)
    ranked = hits.where(F.col(document).isNotNull()).withColumn(
        "_r", F.row_number().over(w.orderBy("distance", key)),
    ).withColumn("total_chunks", F.count(F.lit(1)).over(w))
    return ranked.where("_r = 1").drop("_r").orderBy("distance", key).limit(limit)


def context(hits: DataFrame, text: str, key: str) -> DataFrame:
    """Texts of a few hits, best first, with blank lines between."""
    parts = F.array_sort(F.collect_list(F.struct("distance", key, text)))
    return hits.agg(F.array_join(F.transform(parts, lambda x: x[text]), "\n\n").alias("context"))


def vector_of(df: DataFrame, key: str, value, vector: str) -> list[float]:
    """One row's vector, by its key."""
    row = df.where(F.col(key) == value).select(vector).limit(1).collect()
    return [float(x) for x in row[0][0]] if row and row[0][0] is not None else []


def hash_embedding(text: Column, dim: int = 64) -> Column:
    """Numbers of words by bucket of a hash; the default, deterministic embedding. Null texts give zeros.

    A worker gets texts in Arrow batches and remembers the buckets of words: with built-in expressions the
    words would be hashed again for every bucket.
    """

    @F.pandas_udf("array<float>")
    def embed(texts: pd.Series) -> pd.Series:
        bucket: dict[str, int] = {}
        out = []
        for t in texts:
            v = np.zeros(dim, np.float32)
            for w in re.findall(r"[^\W_]+", (t or "").lower()):
                if w not in bucket:
                    if len(bucket) > 100_000:
                        bucket.clear()
                    bucket[w] = int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % dim
                v[bucket[w]] += 1
            out.append(v)
        return pd.Series(out)

    return embed(text)


def bm25(df: DataFrame, key: str, text: str, query: str, k: int | None = None) -> DataFrame:
    """(key, score): rows with a word of the query, best first if ``k`` is given.

    One pass makes the corpus's numbers (rows, mean length, rows with each word), a second the scores; words are
    counted in the text where it is read: nothing is exploded or shuffled but one row of numbers.
    """
    terms = sorted({t for t in query.lower().split() if t not in STOP_WORDS})
    # a lambda over an array of one binds the words, which are then split once for all numbers
    numbers = lambda w: F.struct(
        F.size(F.filter(w, lambda x: ~x.isin(*STOP_WORDS))).alias("n"),
        *((F.size(w) - F.size(F.array_remove(w, t))).alias(f"f{i}") for i, t in enumerate(terms)),
    )
    c = F.get(F.transform(F.array(words(F.col(text))), numbers), F.lit(0))
    counted = df.where(F.col(text).isNotNull()).select(key, c.alias("_c")).select(
        key, F.col("_c.n").alias("_n"), *(F.col(f"_c.f{i}").alias(f"_f{i}") for i in range(len(terms))),
    )
    stats = counted.agg(
        F.count(F.lit(1)).cast("double").alias("_rows"), F.avg("_n").alias("_mean"),
        *(F.sum((F.col(f"_f{i}") > 0).cast("double")).alias(f"_d{i}") for i in range(len(terms))),
    )
    score = F.lit(0.0)
    for i in range(len(terms)):
        idf = F.ln(1 + (F.col("_rows") - F.col(f"_d{i}") + 0.5) / (F.col(f"_d{i}") + 0.5))
        f = F.col(f"_f{i}").cast("double")
        score = score + idf * f * (BM25_K1 + 1) / (f + BM25_K1 * (1 - BM25_B + BM25_B * F.col("_n") / F.col("_mean")))
    # the corpus's numbers are one row, a scalar subquery
    whole = counted.withColumn("_s", stats.select(F.struct("*")).scalar()).select("*", "_s.*")
    scored = whole.select(key, F.round(score, 6).alias("score"))
    # the filter goes above the limit: pushed down, it would count the words again for each of its parts
    return (scored.orderBy(F.desc("score"), key).limit(k) if k else scored).where("score > 0")


def hybrid(vector_hits: DataFrame, keyword_hits: DataFrame, key: str, alpha: float, k: int) -> DataFrame:
    """alpha times the normed similarity plus (1 - alpha) times the normed keyword score; what one side misses counts 0."""
    v = vector_hits.select(key, (1 - F.col("distance")).alias("_v"))
    both = v.join(keyword_hits.select(key, F.col("score").alias("_k")), key, "full_outer")
    ends = both.agg(F.min("_v").alias("_v0"), F.max("_v").alias("_v1"), F.min("_k").alias("_k0"), F.max("_k").alias("_k1"))
    scaled = lambda c, a, b: F.coalesce(
        F.when(F.col(b) > F.col(a), (F.col(c) - F.col(a)) / (F.col(b) - F.col(a))).when(F.col(c).isNotNull(), F.lit(1.0)), F.lit(0.0),
    )
    score = alpha * scaled("_v", "_v0", "_v1") + (1 - alpha) * scaled("_k", "_k0", "_k1")
    return both.withColumn(
        "_s", ends.select(F.struct("*")).scalar(),
    ).select("*", "_s.*").select(key, F.round(score, 5).alias("score")).orderBy(F.desc("score"), key).limit(k)


def knn_join(queries: DataFrame, df: DataFrame, key: str, vector: str, k: int, blocks: int | None = None) -> DataFrame:
    """(query_id, id, rank, distance): exact neighbours of each query among all rows.

    The queries are a stated set. Rows are dealt to blocks and each block keeps its k best of each query, so that what
    is shuffled is queries x blocks x k rows, whatever the collection's size. There are as many blocks as the session has
    shuffle partitions, or ``blocks``.
    """
    blocks = blocks or max(16, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    q = queries.select(F.col(key).alias("query_id"), F.col(vector).alias("_q"), norm(F.col(vector)).alias("_qn"))
    rows = df.select(
        F.col(key).alias("id"), F.col(vector).alias("_v"), norm(F.col(vector)).alias("_vn"), F.pmod(F.xxhash64(key), F.lit(blocks)).alias("_b"),
    )
    q = q.withColumn("_b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    pairs = rows.join(q, "_b").where("query_id <> id").select(
        "query_id", "id", "_b", distance(F.try_divide(dot(F.col("_q"), F.col("_v")), F.col("_qn") * F.col("_vn"))).alias("distance"),
    )
    first = pairs.withColumn(
        "_r", F.row_number().over(Window.partitionBy("query_id", "_b").orderBy(F.asc_nulls_last("distance"), "id")),
    ).where(F.col("_r") <= k)
    return first.withColumn(
        "rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.asc_nulls_last("distance"), "id")),
    ).where((F.col("rank") <= k) & F.col("distance").isNotNull()).select("query_id", "id", "rank", "distance")

"""The queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import mixing, near_duplicates, neighbours, packing, quality, scans, splitting, transcripts
from .common import materialise, table, usable_text
from .tokens import with_token_counts


#: Words, threshold and least length that the statement of the problem sets for its pairs.
_ALIKE = near_duplicates.Settings(words=3, threshold=0.6, min_words=20)


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    pairs = near_duplicates.found_pairs(table(spark, sf, "knowledge_main"), "chunk_id", "text", _ALIKE)
    return pairs.select(F.col("id_a").alias("chunk_id_a"), F.col("id_b").alias("chunk_id_b"))


def p1_groups(spark: SparkSession, sf: str) -> DataFrame:
    found = near_duplicates.groups(table(spark, sf, "knowledge_main"), "chunk_id", "text", near_duplicates.Settings())
    return found.withColumnRenamed("id", "chunk_id")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "source_document")
    return scans.defects(scans.scanned_texts(documents, table(spark, sf, "knowledge_main")), scans.corpus_lexicon(documents))


def p2_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "source_document")
    return scans.repaired(scans.scanned_texts(documents, table(spark, sf, "knowledge_main")), scans.corpus_lexicon(documents))


def p3_turns(spark: SparkSession, sf: str) -> DataFrame:
    return transcripts.turns(*(table(spark, sf, n) for n in ("audio_item", "audio_chunk", "audio_roster")))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return p3_turns(spark, sf).select("audio_id", "turn_no", "speaker_no")


def _item_vectors(spark: SparkSession, sf: str):
    items = table(spark, sf, "knowledge_item").withColumnRenamed("item_id", "id")
    return lambda where: neighbours.unit_vectors(items.where(where), "id", "embedding", 64), items.count()


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    near = neighbours.nearest(*_item_vectors(spark, sf), k=5, dim=64, min_similarity=0.85)
    return near.select(F.least("id", "other_id").alias("item_id_a"), F.greatest("id", "other_id").alias("item_id_b")).distinct()


def p4_items(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.nearest(*_item_vectors(spark, sf), k=5, dim=64, queries="id % 50 = 0")


def p4_texts(spark: SparkSession, sf: str) -> DataFrame:
    texts = table(spark, sf, "knowledge_main").withColumnRenamed("chunk_id", "id")
    return neighbours.nearest(
        lambda where: neighbours.text_vectors(texts.where(where), "id", "text"), texts.count(), k=5, dim=64, queries="id % 50 = 0",
    )


def _over(spark: SparkSession, sf: str) -> DataFrame:
    spec = table(spark, sf, "split_spec")
    content = splitting.oversized(table(spark, sf, "source_document"), "id", "content", "source_document.content", spec)
    return content.unionByName(splitting.oversized(table(spark, sf, "knowledge_main"), "chunk_id", "text", "knowledge_main.text", spec))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return splitting.levels(_over(spark, sf))


def p5_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return splitting.split_pieces(_over(spark, sf))


def _counted(spark: SparkSession, sf: str) -> DataFrame:
    return materialise(with_token_counts(table(spark, sf, "documents"), ["doc_id", "source"]).dropDuplicates(["doc_id"]))


def p6_containers(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return packing.fill_containers(with_token_counts(docs, ["doc_id"]).dropDuplicates(["doc_id"]), table(spark, sf, "container_spec"), docs.count())


def p6_fill(spark: SparkSession, sf: str) -> DataFrame:
    return packing.fill_report(p6_containers(spark, sf), table(spark, sf, "container_spec"))


def p7_mixture(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(_counted(spark, sf), table(spark, sf, "mix_target"))[0]


def p7_shares(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.shares(*mixing.mix(_counted(spark, sf), table(spark, sf, "mix_target")))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").where(usable_text("text"))
    return quality.each_statistics(docs).where("text_kind in ('list', 'table', 'junk')").select("doc_id", "text_kind").distinct()


def p8_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return quality.text_statistics(table(spark, sf, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        p1_found, p1_groups, p2_found, p2_paragraphs, p3_found, p3_turns, p4_found, p4_items, p4_texts, p5_found, p5_pieces, p6_containers, p6_fill,
        p7_mixture, p7_shares, p8_found, p8_statistics,
    )
}

_UNIT = "(SELECT item_id AS id, list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) AS v FROM (SELECT item_id, any_value(embedding)::DOUBLE[] AS e FROM knowledge_item WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64 AND len(list_filter(embedding, lambda x: x <> 0)) > 0 GROUP BY item_id))"
_NEAR = f"(SELECT a, b, s, row_number() OVER (PARTITION BY a ORDER BY s DESC, b) AS r FROM (SELECT x.id AS a, y.id AS b, list_inner_product(x.v, y.v) AS s FROM {_UNIT} x JOIN {_UNIT} y ON x.id <> y.id {{0}}))"
_SPLITS = """(SELECT field_name, record_key, list_max(list_transform(regexp_split_to_array(text, '\\n[ \\t\\r]*\\n'), lambda x: length(trim(x, b)))) AS p, list_max(list_transform(string_split(regexp_replace(regexp_replace(text, '\\n[ \\t\\r]*\\n', chr(1), 'g'), '([.!?])[ \\t\\r\\n]+', '\\1' || chr(1), 'g'), chr(1)), lambda x: length(trim(x, b)))) AS s,
    list_max(list_transform(regexp_split_to_array(text, '[ \\t\\r\\n]+'), lambda x: length(x))) AS w, max_chars FROM (SELECT *, ' ' || chr(9) || chr(10) || chr(13) AS b FROM (SELECT 'source_document.content' AS field_name, id AS record_key, any_value(content) AS text FROM source_document WHERE content IS NOT NULL GROUP BY id
    UNION ALL SELECT 'knowledge_main.text', chunk_id::VARCHAR, any_value(text) FROM knowledge_main WHERE text IS NOT NULL GROUP BY chunk_id) JOIN split_spec USING (field_name) WHERE length(text) > max_chars))"""

#: For the rest SQL can't say the same; they are tested against brute force and exact round trips.
ORACLES: dict[str, str] = {
    "p1_found": """WITH w AS (SELECT chunk_id, list_filter(regexp_split_to_array(lower(any_value(text)), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM knowledge_main WHERE text IS NOT NULL GROUP BY chunk_id),
        s AS (SELECT DISTINCT chunk_id, unnest(list_transform(w[1:-3], lambda x, i: x || ' ' || w[i + 1] || ' ' || w[i + 2])) AS s FROM w WHERE len(w) >= 20), n AS (SELECT chunk_id, count(*) AS n FROM s GROUP BY chunk_id),
        b AS (SELECT a.chunk_id AS a, b.chunk_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.chunk_id < b.chunk_id GROUP BY 1, 2)
        SELECT a AS chunk_id_a, b AS chunk_id_b FROM b JOIN n x ON x.chunk_id = a JOIN n y ON y.chunk_id = b WHERE c >= 0.6::DOUBLE * (x.n + y.n - c) - 0.000000001""",
    "p4_found": f"SELECT DISTINCT least(a, b) AS item_id_a, greatest(a, b) AS item_id_b FROM {_NEAR.format('')} WHERE r <= 5 AND s >= 0.85",
    "p5_found": f"SELECT field_name, record_key, CASE WHEN p <= max_chars THEN 'paragraph' WHEN s <= max_chars THEN 'sentence' WHEN w <= max_chars THEN 'word' ELSE 'none' END AS boundary_level FROM {_SPLITS}",
}

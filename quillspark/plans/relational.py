"""Queries of joins, aggregations, set operations and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from ..operators import chunks as C
from ..operators import lines as L
from ..operators import relational as R
from .common import base, once, once_sql

KM = once_sql("knowledge_main", "chunk_id", "text", "filename", "document_id", "chunk_index")
SRC = once_sql(
    "source_document", "id", "source_path", "content", "is_scanned", "metadata.num_pages", "metadata.num_processed_pages", "metadata.file_size",
    "error",
)
ITEM = once_sql("knowledge_item", "item_id", "title", "year", "language")
# Subject words looked for in texts.
SUBJECTS = (
    "mathematics", "science", "history", "geography", "music", "theatre", "dance", "biology", "physics", "chemistry", "economics", "civics",
    "writing", "reading", "health",
)
# Cost of a page by method.
PAGE_COST = (("text", 0.0), ("scan", 0.0002))
# End of the fixed values.


def _km(spark, sf, *columns):
    return once(spark, sf, "knowledge_main", "chunk_id", *columns)


def _src(spark, sf, *columns):
    return once(spark, sf, "source_document", "id", *columns)


def lookup_left_join(spark: SparkSession, sf: str) -> DataFrame:
    nation = base(spark, sf, "nation").join(base(spark, sf, "supplier"), F.col("n_nationkey") == F.col("s_nationkey"), "left_semi")
    return R.lookup(
        base(spark, sf, "customer"), R.small(nation), "c_nationkey", "n_nationkey", "n_name", "nation_name",
    ).groupBy("nation_name").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


def resume_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    done = _km(spark, sf, "document_id").select(F.col("document_id").alias("id"))
    return R.remaining(_src(spark, sf, "source_path"), done, "id")


def scan_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that were read, by kind, with their sizes; a projection of nested fields."""
    d = base(spark, sf, "source_document", "id", "metadata", "error").where("id is not null")
    one = d.groupBy("id").agg(
        F.lower(F.max("metadata.file_type")).alias("file_type"), F.max("metadata.file_size").alias("file_size"), F.max("error").alias("error"),
    )
    return one.groupBy("file_type").agg(F.count(F.lit(1)).alias("n"), F.sum("file_size").alias("bytes"), F.count("error").alias("n_errors"))


def render_commands(spark: SparkSession, sf: str) -> DataFrame:
    return _method(spark, sf).select(
        "id", F.format_string("process --method %s --pages %d %s", F.col("method"), F.coalesce("num_pages", F.lit(0)), F.col("id")).alias("command"),
    )


def resume_pages(spark: SparkSession, sf: str) -> DataFrame:
    p = _src(spark, sf, "metadata.num_pages", "metadata.num_processed_pages").where("num_pages is not null")
    done = F.coalesce("num_processed_pages", F.lit(0))
    return p.select("id", (done == F.col("num_pages")).alias("complete"), F.when(done < F.col("num_pages"), done + 1).alias("next_page"))


def semi_join_referenced(spark: SparkSession, sf: str) -> DataFrame:
    refs = _km(spark, sf, "document_id").select(F.col("document_id").alias("id"))
    return R.referenced(_src(spark, sf, "source_path"), refs, "id")


def first_match_join(spark: SparkSession, sf: str) -> DataFrame:
    rank = F.when(F.col("source_path").endswith(".pdf"), 1).when(F.col("source_path").endswith(".docx"), 2).otherwise(3)
    name = F.regexp_extract("source_path", r"/([^/]*)/[^/]*$", 1)
    sources = _src(spark, sf, "source_path").select(name.alias("org"), rank.alias("source_rank"), F.col("source_path").alias("path"))
    return R.first_match(sources.select("org").distinct(), sources, "org", "source_rank", "path")


def chunk_parent_join(spark: SparkSession, sf: str) -> DataFrame:
    km, src = _km(spark, sf, "document_id", "chunk_index"), _src(spark, sf, "source_path")
    return km.join(src, km.document_id == src.id, "left").groupBy("document_id", "source_path").agg(
        F.count(F.lit(1)).alias("n_chunks"), F.max("chunk_index").alias("last_index"),
    )


def slide_outer_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Two lists put side by side by position: parts of the lines that came back, and suppliers of the lines that are closed."""
    li = base(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    a = li.where("l_returnflag = 'R'").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("slide"))
    b = li.where("l_linestatus = 'F'").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_suppkey").alias("note"))
    return a.join(b, ["l_orderkey", "l_linenumber"], "full_outer")


def hierarchy_paths(spark: SparkSession, sf: str) -> DataFrame:
    r, n, c = base(spark, sf, "region"), base(spark, sf, "nation"), base(spark, sf, "customer")
    path = F.concat_ws("/", "r_name", "n_name", "c_name")
    return c.join(
        R.small(n), F.col("c_nationkey") == F.col("n_nationkey"),
    ).join(R.small(r), F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", path.alias("path"))


def _levels(spark, sf):
    return base(spark, sf, "documents", "doc_id", "lang", "source").select(
        "doc_id", F.coalesce("lang", F.lit("none")).alias("lang"), F.coalesce("source", F.lit("none")).alias("source"),
    )


def surrogate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return R.surrogate_keys(_levels(spark, sf), ["lang", "source"], "doc_id").select(
        F.col("level").cast("bigint").alias("level"), "lang", "source", F.col("id").cast("bigint").alias("id"),
        F.col("parent_id").cast("bigint").alias("parent_id"),
    )


def hierarchy_levels(spark: SparkSession, sf: str) -> DataFrame:
    d = _levels(spark, sf)
    return d.groupBy("lang").agg(F.countDistinct("source").alias("n_children"), F.count(F.lit(1)).alias("n_leaves"))


def dedupe_first_seen(spark: SparkSession, sf: str) -> DataFrame:
    t = F.encode("text", "UTF-8")
    hashed = base(spark, sf, "documents", "doc_id", "text").where("text is not null").select(
        "doc_id", F.sha2(t, 256).alias("h"), F.md5(t).alias("text_md5"),
    )
    return R.first_seen(hashed, ["h"], ["doc_id"]).select("doc_id", "text_md5")


def dedupe_content_hash(spark: SparkSession, sf: str) -> DataFrame:
    h = base(spark, sf, "documents", "doc_id", "text").where("text is not null").select("doc_id", F.sha2("text", 256).alias("sha256"))
    return h.groupBy("sha256").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")


def fuzzy_title_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return R.similar_strings(base(spark, sf, "documents", "title"), "title", 0.75)


def large_documents_topn(spark: SparkSession, sf: str) -> DataFrame:
    return base(spark, sf, "documents", "doc_id", "text").select(
        "doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"),
    ).where("n_bytes >= 2048").orderBy(F.desc("n_bytes"), "doc_id").limit(20)


def point_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return base(spark, sf, "documents", "doc_id", "title", "source_org").where("doc_id = 42").limit(1)


def batch_assignment(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of 10 within each source."""
    d = L.running_totals(base(spark, sf, "documents", "doc_id", "source"), ["source"], ["doc_id"], F.floor(F.col("doc_id") / 4096), place=F.lit(1))
    return d.select("doc_id", "source", F.floor((F.col("place") - 1) / 10).alias("batch"))


def top3_per_group(spark: SparkSession, sf: str) -> DataFrame:
    d = base(spark, sf, "documents", "doc_id", "source", "text").select("source", "doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("n"))
    return R.top_per_group(d, ["source"], [F.desc("n"), F.col("doc_id")], 3)


def union_sources(spark: SparkSession, sf: str) -> DataFrame:
    c = base(spark, sf, "customer").select(F.lit("customer").alias("kind"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    s = base(spark, sf, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    return c.unionByName(s).groupBy("kind", "nation").agg(F.count(F.lit(1)).alias("n"), F.max("name").alias("last_name"))


def csv_merge_union(spark: SparkSession, sf: str) -> DataFrame:
    c = base(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("source"))
    s = base(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance"), F.lit("supplier").alias("source"))
    return c.unionByName(s, allowMissingColumns=True)


def set_intersect(spark: SparkSession, sf: str) -> DataFrame:
    c, s = base(spark, sf, "customer").where("c_acctbal > 9000"), base(spark, sf, "supplier").where("s_acctbal > 5000")
    return c.select(F.col("c_nationkey").alias("nation")).intersect(s.select(F.col("s_nationkey").alias("nation")))


def set_difference(spark: SparkSession, sf: str) -> DataFrame:
    c, s = base(spark, sf, "customer"), base(spark, sf, "supplier").where("s_acctbal > 5000")
    return c.select(F.col("c_nationkey").alias("nation")).distinct().exceptAll(s.select(F.col("s_nationkey").alias("nation")).distinct())


def collection_stats(spark: SparkSession, sf: str) -> DataFrame:
    n = F.length("text")
    return _km(spark, sf, "text", "document_id").agg(
        F.count(F.lit(1)).alias("n_chunks"), F.countDistinct("document_id").alias("n_documents"), F.round(F.avg(n), 4).alias("mean_chars"), F.max(n).alias("max_chars"),
        F.sum(F.when(F.trim(F.coalesce("text", F.lit(""))) == "", 1).otherwise(0)).alias("n_blank"), F.round(
            F.try_divide(F.count("document_id"), F.countDistinct("document_id")), 4,
        ).alias("chunks_per_document"),
    )


def collection_count(spark: SparkSession, sf: str) -> DataFrame:
    return base(spark, sf, "documents").agg(F.count(F.lit(1)).alias("n"))


def group_counts_sets(spark: SparkSession, sf: str) -> DataFrame:
    i = once(spark, sf, "knowledge_item", "item_id", "year", "language")
    return i.groupBy("language").agg(
        F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.transform(F.collect_set("year"), lambda y: y.cast("string"))), ",").alias("years"),
    )


def _method(spark, sf):
    return _src(
        spark, sf, "is_scanned", "metadata.num_pages", "metadata.file_size",
    ).withColumn("method", F.when(F.col("is_scanned"), "scan").otherwise("text"))


def method_cost_report(spark: SparkSession, sf: str) -> DataFrame:
    rate = F.element_at(F.create_map(*(F.lit(x) for kv in PAGE_COST for x in kv)), F.col("method"))
    g = _method(spark, sf).groupBy("method").agg(F.count(F.lit(1)).alias("n"), F.sum("num_pages").alias("pages"), F.sum("file_size").alias("bytes"))
    return g.select(
        "method", "n", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy()), 2).alias("percent"), "pages", "bytes",
        F.round(F.coalesce("pages", F.lit(0)) * rate, 4).alias("cost"),
    )


def _page_stats(spark, sf):
    pages = base(spark, sf, "source_document", "id", "pages").where("pages is not null").select("id", F.explode("pages").alias("p")).select(
        "id", F.col("p.page_number").alias("page_number"), F.col("p.text").alias("page"),
    ).groupBy("id", "page_number").agg(F.max("page").alias("page"))
    return pages.withColumn("n", F.length(F.trim(F.coalesce("page", F.lit("")))))


def doc_complexity(spark: SparkSession, sf: str) -> DataFrame:
    has_table = F.contains(F.lower(F.coalesce("page", F.lit(""))), F.lit("table")) | F.contains(F.coalesce("page", F.lit("")), F.lit("|"))
    g = _page_stats(spark, sf).groupBy("id").agg(
        F.count(F.lit(1)).alias("n_pages"), (F.sum((F.col("n") > 50).cast("int")) / F.count(F.lit(1))).alias("coverage"),
        F.max(has_table.cast("int")).alias("tables"),
    )
    kind = F.when(F.col("coverage") < 0.1, "complex").when(F.col("tables") == 1, "medium").otherwise("simple")
    return g.select(
        "id", "n_pages", F.round("coverage", 4).alias("coverage"), kind.alias("complexity"),
        F.when(kind == "complex", "layout").when(kind == "medium", "layout_tables").otherwise("text").alias("recommended"),
    )


def doc_complexity_summary(spark: SparkSession, sf: str) -> DataFrame:
    return doc_complexity(spark, sf).groupBy("complexity").agg(F.count(F.lit(1)).alias("n"), F.sum("n_pages").alias("n_pages"))


def doc_quick_method(spark: SparkSession, sf: str) -> DataFrame:
    g = _page_stats(spark, sf).where("page_number <= 5").groupBy("id").agg(F.avg("n").alias("mean_chars"))
    m = F.col("mean_chars")
    return g.select(
        "id", F.round(m, 3).alias("mean_chars"), F.when(m > 500, "text").when(m > 100, "layout").otherwise("fallback").alias("method"),
        F.when(m > 500, "High").when(m > 100, "Medium").otherwise("Low").alias("confidence"),
    )


def page_text_gate(spark: SparkSession, sf: str) -> DataFrame:
    p = _page_stats(spark, sf)
    kept = F.col("n") >= 50
    parts = F.array_sort(
        F.collect_list(
            F.when(
                kept,
                F.struct("page_number", F.concat(F.lit("=== Page "), F.col("page_number").cast("string"), F.lit(" ===\n"), F.col("page")).alias("t")),
            )
        )
    )
    g = p.groupBy("id").agg(
        F.count(F.lit(1)).alias("n_pages"), F.sum(kept.cast("bigint")).alias("n_kept"), F.sum(F.when(kept, F.col("n")).otherwise(0)).alias("total"),
        F.md5(F.array_join(F.transform(parts, lambda x: x["t"]), "\n")).alias("text_md5"),
    )
    return g.select("id", "n_pages", "n_kept", "text_md5", ((F.col("n_kept") == 0) | (F.col("total") < 25 * F.col("n_pages"))).alias("requires_ocr"))


def page_concat(spark: SparkSession, sf: str) -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct("page_number", "page")))
    return _page_stats(spark, sf).where("page is not null").groupBy("id").agg(
        F.md5(F.array_join(F.transform(parts, lambda x: x["page"]), "\n--- Page Break ---\n")).alias("text_md5"), F.count(F.lit(1)).alias("n_pages"),
    )


def batch_outcome_report(spark: SparkSession, sf: str) -> DataFrame:
    d = _src(spark, sf, "source_path", "error").withColumn("org", F.regexp_extract("source_path", r"/([^/]*)/[^/]*$", 1))
    return R.outcome_report(d, "org", F.col("error").isNull())


def fallback_first_success(spark: SparkSession, sf: str) -> DataFrame:
    """Of the attempts at a document the first, by rank, that has text; else the last error."""
    d = _src(spark, sf, "content", "error")
    content = d.where("trim(coalesce(content, '')) <> ''").select(
        "id", F.lit(1).alias("attempt"), F.lit(None).cast("string").alias("error"), F.length("content").alias("n"),
    )
    failed = d.where("error is not null").select("id", F.lit(2).alias("attempt"), "error", F.lit(0).alias("n"))
    both = content.unionByName(failed)
    return both.groupBy("id").agg(F.min(F.when(F.col("error").isNull(), F.struct("attempt", "n"))).alias("s"), F.max(F.struct("attempt", "error")).alias("f")).select(
        "id", F.col("s.attempt").alias("attempt"), F.col("s.n").alias("n_chars"), F.when(F.col("s").isNull(), F.col("f.error")).alias("error"),
    )


def output_select(spark: SparkSession, sf: str) -> DataFrame:
    d = base(spark, sf, "documents", "doc_id", "title", "text")
    return d.select("doc_id", F.coalesce(F.nullif(F.trim("text"), F.lit("")), F.concat(F.lit("# "), F.col("title")), F.lit("")).alias("output"))


def multi_format_fanout(spark: SparkSession, sf: str) -> DataFrame:
    d = base(spark, sf, "documents", "doc_id", "text").where("text is not null").select(
        "doc_id", "text", F.explode(F.array(F.lit("text"), F.lit("markdown"), F.lit("json"))).alias("format"),
    )
    out = F.when(
        F.col("format") == "json", F.get_json_object(F.to_json(F.struct("text")), "$.text"),
    ).when(F.col("format") == "markdown", F.concat(F.lit("# Document\n\n"), F.col("text"))).otherwise(F.col("text"))
    return d.groupBy("format").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(out)).alias("n_chars"))


def column_widths(spark: SparkSession, sf: str) -> DataFrame:
    d = base(spark, sf, "documents", "doc_id", "lang", "source", "source_org", "title")
    cols = ["lang", "source", "source_org", "title"]
    widths = d.agg(*(F.least(F.greatest(F.max(F.length(c)), F.lit(len(c))) + 2, F.lit(50)).alias(c) for c in cols))
    return widths.unpivot([], cols, "column", "width").select("column", F.col("width").cast("bigint").alias("width"))


def tag_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return R.tag_frequency(base(spark, sf, "documents", "topics"), "topics")


def tag_frequency_top20(spark: SparkSession, sf: str) -> DataFrame:
    return tag_frequency(spark, sf).orderBy(F.desc("n"), "tag").limit(20)


def tags_explode(spark: SparkSession, sf: str) -> DataFrame:
    joined = F.array_join("topics", " , ")
    return base(spark, sf, "documents", "doc_id", "topics").where("topics is not null").select(
        "doc_id", F.posexplode(T.tags_of(joined)).alias("place", "tag"),
    )


def tags_dedupe_ci(spark: SparkSession, sf: str) -> DataFrame:
    d = base(spark, sf, "documents", "doc_id", "topics", "title").where("topics is not null")
    both = F.concat(F.col("topics"), F.transform("topics", lambda t: F.initcap(t)), F.array(F.coalesce("title", F.lit(""))))
    return d.select("doc_id", F.array_join(R.distinct_ignoring_case(both), "|").alias("tags"))


def distinct_tags_sorted(spark: SparkSession, sf: str) -> DataFrame:
    return base(spark, sf, "documents", "topics").select(F.explode("topics").alias("tag")).where("trim(tag) <> ''").distinct()


def domain_tag_match(spark: SparkSession, sf: str) -> DataFrame:
    """Subjects that occur in texts: each text is looked through once for all of them."""
    d = base(spark, sf, "documents", "doc_id", "text").where("text is not null").withColumn("low", F.lower("text"))
    found = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(s)), F.lit(s)) for s in SUBJECTS)))
    return d.select("doc_id", F.explode(found).alias("tag"))


def keywords_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The 15 most frequent phrases of up to three words of a text."""
    return C.top_phrases(base(spark, sf, "documents", "doc_id", "text"), "doc_id", "text")


def hybrid_tags(spark: SparkSession, sf: str) -> DataFrame:
    """Tags of a text that are given, its frequent phrases, and the subjects in it."""
    d = base(spark, sf, "documents", "doc_id", "text", "topics").where("text is not null")
    return C.hybrid_tags(d, "doc_id", "text", "topics", SUBJECTS).select("doc_id", F.array_join("tags", "|").alias("tags"))


def tumbling_counts(spark: SparkSession, sf: str) -> DataFrame:
    e = base(spark, sf, "events", "ts", "event_type")
    return e.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(
        F.unix_timestamp(F.col("w.start").cast("timestamp")).alias("start"), "event_type", "n",
    )


_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(C.STOP_WORDS))
_PHRASES = rf"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL), r AS (SELECT doc_id, unnest(w) AS l, generate_subscripts(w, 1) AS i, w FROM w),
    p AS (SELECT doc_id, array_to_string(w[i - m + 1 : i], ' ') AS keyword FROM r, range(1, 4) s(m) WHERE i >= m AND l NOT IN ({_STOP})), k AS (SELECT doc_id, keyword, count(*) AS n, (row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, keyword))::INT AS rank FROM p GROUP BY 1, 2 QUALIFY rank <= 15)"""
_ORG = r"regexp_extract(source_path, '/([^/]*)/[^/]*$', 1)"
_PAGES = "(SELECT id, page_number, page, length(trim(coalesce(page, '')))::INT AS n FROM (SELECT id, p.page_number AS page_number, max(p.text) AS page FROM (SELECT id, unnest(pages) AS p FROM source_document WHERE pages IS NOT NULL AND id IS NOT NULL) GROUP BY 1, 2))"
_CX = f"""(SELECT id, n_pages, round(coverage, 4) AS coverage, CASE WHEN coverage < 0.1 THEN 'complex' WHEN tables THEN 'medium' ELSE 'simple' END AS complexity FROM (SELECT id, count(*) AS n_pages, sum((n > 50)::INT) / count(*) AS coverage,
    bool_or(contains(lower(coalesce(page, '')), 'table') OR contains(coalesce(page, ''), '|')) AS tables FROM {_PAGES} GROUP BY id))"""
_LEV = "(SELECT doc_id, coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source FROM documents)"

ORACLES = {
    "lookup_left_join": "SELECT coalesce(n_name, c_nationkey::VARCHAR) AS nation_name, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier)) ON c_nationkey = n_nationkey GROUP BY 1",
    "resume_anti_join": f"SELECT id, source_path FROM {SRC} WHERE id NOT IN (SELECT document_id FROM {KM} WHERE document_id IS NOT NULL)",
    "scan_documents": "SELECT file_type, count(*) AS n, sum(file_size)::BIGINT AS bytes, count(error) AS n_errors FROM (SELECT id, lower(max(metadata.file_type)) AS file_type, max(metadata.file_size) AS file_size, max(error) AS error FROM source_document WHERE id IS NOT NULL GROUP BY id) GROUP BY file_type",
    "render_commands": f"SELECT id, 'process --method ' || CASE WHEN is_scanned THEN 'scan' ELSE 'text' END || ' --pages ' || coalesce(num_pages, 0) || ' ' || id AS command FROM {SRC}",
    "resume_pages": f"SELECT id, coalesce(num_processed_pages, 0) = num_pages AS complete, CASE WHEN coalesce(num_processed_pages, 0) < num_pages THEN coalesce(num_processed_pages, 0) + 1 END AS next_page FROM {SRC} WHERE num_pages IS NOT NULL",
    "semi_join_referenced": f"SELECT id, source_path FROM {SRC} WHERE id IN (SELECT document_id FROM {KM} WHERE document_id IS NOT NULL)",
    "first_match_join": f"SELECT org, source_rank, path FROM (SELECT {_ORG} AS org, CASE WHEN source_path LIKE '%.pdf' THEN 1 WHEN source_path LIKE '%.docx' THEN 2 ELSE 3 END AS source_rank, source_path AS path FROM {SRC}) QUALIFY row_number() OVER (PARTITION BY org ORDER BY source_rank, path) = 1",
    "chunk_parent_join": f"SELECT k.document_id, s.source_path, count(*) AS n_chunks, max(chunk_index) AS last_index FROM {KM} k LEFT JOIN {SRC} s ON k.document_id = s.id GROUP BY 1, 2",
    "slide_outer_merge": "SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, coalesce(a.l_linenumber, b.l_linenumber) AS l_linenumber, slide, note FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS slide FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2) a FULL JOIN (SELECT l_orderkey, l_linenumber, min(l_suppkey) AS note FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2) b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber",
    "hierarchy_paths": "SELECT c_custkey, r_name || '/' || n_name || '/' || c_name AS path FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    "surrogate_keys": f"""WITH a AS (SELECT 1 AS level, lang, NULL::VARCHAR AS source, min(doc_id) AS f FROM {_LEV} GROUP BY lang UNION ALL SELECT 2, lang, source, min(doc_id) FROM {_LEV} GROUP BY lang, source), g AS (SELECT *, min(f) OVER (PARTITION BY lang) AS gf FROM a),
        n AS (SELECT *, 49999 + row_number() OVER (ORDER BY gf, lang, level, f, source) AS id FROM g) SELECT n.level::BIGINT AS level, n.lang, n.source, n.id, p.id AS parent_id FROM n LEFT JOIN n p ON p.level = 1 AND n.level = 2 AND p.lang = n.lang""",
    "hierarchy_levels": f"SELECT lang, count(DISTINCT source) AS n_children, count(*) AS n_leaves FROM {_LEV} GROUP BY lang",
    "dedupe_first_seen": "SELECT min(doc_id) AS doc_id, md5(text) AS text_md5 FROM documents WHERE text IS NOT NULL GROUP BY text",
    "dedupe_content_hash": "SELECT sha256(text) AS sha256, count(*) AS n, min(doc_id) AS first_id FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "fuzzy_title_pairs": "WITH t AS (SELECT DISTINCT title AS v FROM documents WHERE length(title) > 0), p AS (SELECT a.v AS a, b.v AS b, 1 - levenshtein(a.v, b.v) / greatest(length(a.v), length(b.v)) AS r FROM t a JOIN t b ON a.v < b.v) SELECT a, b, round(r, 4) AS ratio FROM p WHERE r >= 0.75::DOUBLE - 0.000000001",
    "large_documents_topn": "SELECT doc_id, strlen(text)::BIGINT AS n_bytes FROM documents WHERE strlen(text) >= 2048 ORDER BY 2 DESC, 1 LIMIT 20",
    "point_lookup": "SELECT doc_id, title, source_org FROM documents WHERE doc_id = 42",
    "batch_assignment": "SELECT doc_id, source, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 10 AS batch FROM documents",
    "top3_per_group": "SELECT source, doc_id, n, rank FROM (SELECT source, doc_id, coalesce(length(text), 0)::INT AS n, (row_number() OVER (PARTITION BY source ORDER BY coalesce(length(text), 0) DESC, doc_id))::INT AS rank FROM documents) WHERE rank <= 3",
    "union_sources": "SELECT kind, nation, count(*) AS n, max(name) AS last_name FROM (SELECT 'customer' AS kind, c_name AS name, c_nationkey AS nation FROM customer UNION ALL SELECT 'supplier', s_name, s_nationkey FROM supplier) GROUP BY kind, nation",
    "csv_merge_union": "SELECT c_custkey AS key, c_mktsegment AS segment, 'customer' AS source, NULL::DOUBLE AS balance FROM customer UNION ALL SELECT s_suppkey, NULL, 'supplier', s_acctbal FROM supplier",
    "set_intersect": "SELECT c_nationkey AS nation FROM customer WHERE c_acctbal > 9000 INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000",
    "set_difference": "SELECT c_nationkey AS nation FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000",
    "collection_stats": f"SELECT count(*) AS n_chunks, count(DISTINCT document_id) AS n_documents, round(avg(length(text)), 4) AS mean_chars, max(length(text))::INT AS max_chars, sum((trim(coalesce(text, '')) = '')::INT)::BIGINT AS n_blank, round(count(document_id) / nullif(count(DISTINCT document_id), 0), 4) AS chunks_per_document FROM {KM}",
    "collection_count": "SELECT count(*) AS n FROM documents",
    "group_counts_sets": f"SELECT language, count(*) AS n, coalesce(array_to_string(list_sort(list(DISTINCT year::VARCHAR) FILTER (year IS NOT NULL)), ','), '') AS years FROM {ITEM} GROUP BY language",
    "method_cost_report": f"SELECT method, n, round(100 * n / sum(n) OVER (), 2) AS percent, pages, bytes, round(coalesce(pages, 0) * CASE method WHEN 'scan' THEN 0.0002::DOUBLE ELSE 0.0::DOUBLE END, 4) AS cost FROM (SELECT CASE WHEN is_scanned THEN 'scan' ELSE 'text' END AS method, count(*) AS n, sum(num_pages)::BIGINT AS pages, sum(file_size)::BIGINT AS bytes FROM {SRC} GROUP BY 1)",
    "doc_complexity": f"SELECT *, CASE complexity WHEN 'complex' THEN 'layout' WHEN 'medium' THEN 'layout_tables' ELSE 'text' END AS recommended FROM {_CX}",
    "doc_complexity_summary": f"SELECT complexity, count(*) AS n, sum(n_pages)::BIGINT AS n_pages FROM {_CX} GROUP BY complexity",
    "doc_quick_method": f"SELECT id, round(m, 3) AS mean_chars, CASE WHEN m > 500 THEN 'text' WHEN m > 100 THEN 'layout' ELSE 'fallback' END AS method, CASE WHEN m > 500 THEN 'High' WHEN m > 100 THEN 'Medium' ELSE 'Low' END AS confidence FROM (SELECT id, avg(n) AS m FROM {_PAGES} WHERE page_number <= 5 GROUP BY id)",
    "page_text_gate": f"SELECT id, n_pages, n_kept, text_md5, n_kept = 0 OR total < 25 * n_pages AS requires_ocr FROM (SELECT id, count(*) AS n_pages, sum((n >= 50)::BIGINT)::BIGINT AS n_kept, sum(CASE WHEN n >= 50 THEN n ELSE 0 END) AS total, md5(coalesce(string_agg('=== Page ' || page_number || ' ===' || chr(10) || page, chr(10) ORDER BY page_number) FILTER (n >= 50), '')) AS text_md5 FROM {_PAGES} GROUP BY id)",
    "page_concat": f"SELECT id, md5(string_agg(page, chr(10) || '--- Page Break ---' || chr(10) ORDER BY page_number)) AS text_md5, count(*) AS n_pages FROM {_PAGES} WHERE page IS NOT NULL GROUP BY id",
    "batch_outcome_report": f"SELECT org, grouping(org)::INT AS level, count(*) AS n, sum((error IS NULL)::BIGINT)::BIGINT AS n_done, (count(*) - sum((error IS NULL)::BIGINT))::BIGINT AS n_failed, round(100 * sum((error IS NULL)::BIGINT) / count(*), 2) AS percent FROM (SELECT {_ORG} AS org, error FROM {SRC}) GROUP BY ROLLUP (org)",
    "fallback_first_success": f"SELECT id, CASE WHEN trim(coalesce(content, '')) <> '' THEN 1 END AS attempt, CASE WHEN trim(coalesce(content, '')) <> '' THEN length(content)::INT END AS n_chars, CASE WHEN trim(coalesce(content, '')) = '' THEN error END AS error FROM {SRC} WHERE trim(coalesce(content, '')) <> '' OR error IS NOT NULL",
    "output_select": "SELECT doc_id, coalesce(nullif(trim(text), ''), '# ' || title, '') AS output FROM documents",
    "multi_format_fanout": "SELECT format, count(*) AS n, sum(length(text) + CASE format WHEN 'markdown' THEN 12 ELSE 0 END)::BIGINT AS n_chars FROM documents, (VALUES ('text'), ('markdown'), ('json')) f(format) WHERE text IS NOT NULL GROUP BY format",
    "column_widths": " UNION ALL ".join(f"SELECT '{c}' AS column, least(greatest(max(length({c})), {len(c)}) + 2, 50)::BIGINT AS width FROM documents" for c in ("lang", "source", "source_org", "title")),
    "tag_frequency": "SELECT tag, count(*) AS n FROM (SELECT unnest(list_distinct(list_transform(topics, lambda t: trim(t)))) AS tag FROM documents) WHERE tag <> '' GROUP BY tag",
    "tag_frequency_top20": "SELECT tag, count(*) AS n FROM (SELECT unnest(list_distinct(list_transform(topics, lambda t: trim(t)))) AS tag FROM documents) WHERE tag <> '' GROUP BY tag ORDER BY n DESC, tag LIMIT 20",
    "tags_explode": "WITH t AS (SELECT doc_id, list_filter(list_transform(string_split(array_to_string(topics, ' , '), ','), lambda x: trim(x)), lambda x: x <> '') AS t FROM documents WHERE topics IS NOT NULL) SELECT doc_id, (unnest(generate_series(0, len(t) - 1)))::INT AS place, unnest(t) AS tag FROM t",
    "tags_dedupe_ci": """WITH t AS (SELECT doc_id, list_filter(list_transform(list_concat(topics, list_transform(topics, lambda x: array_to_string(list_transform(string_split(x, ' '), lambda w: upper(substring(w, 1, 1)) || lower(substring(w, 2))), ' ')), [coalesce(title, '')]), lambda x: trim(x)), lambda x: x <> '') AS t FROM documents WHERE topics IS NOT NULL)
        SELECT doc_id, coalesce(array_to_string(list_filter(t, lambda x, i: list_position(list_transform(t, lambda y: lower(y)), lower(x)) = i)[1:20], '|'), '') AS tags FROM t""",
    "distinct_tags_sorted": "SELECT DISTINCT tag FROM (SELECT unnest(topics) AS tag FROM documents) WHERE trim(tag) <> ''",
    "domain_tag_match": f"SELECT doc_id, tag FROM documents JOIN (VALUES {
        ', '.join(f"('{s}')" for s in SUBJECTS)
    }) s(tag) ON contains(lower(text), tag)",
    "keywords_topk": f"{_PHRASES} SELECT doc_id, keyword, n, rank FROM k",
    "hybrid_tags": f"""{_PHRASES}, g AS (SELECT doc_id, list(keyword ORDER BY rank) AS g FROM k GROUP BY 1),
        t AS (SELECT d.doc_id, list_filter(list_transform(list_concat(coalesce(topics, []), coalesce(g, []), list_filter([{', '.join(f"'{s}'" for s in SUBJECTS)}], lambda x: contains(lower(text), x))), lambda x: trim(x)), lambda x: x <> '') AS t FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id WHERE text IS NOT NULL)
        SELECT doc_id, coalesce(array_to_string(list_filter(t, lambda x, i: list_position(list_transform(t, lambda y: lower(y)), lower(x)) = i)[1:20], '|'), '') AS tags FROM t""",
    "tumbling_counts": "SELECT epoch(time_bucket(INTERVAL 1 HOUR, ts))::BIGINT AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
}
QUERIES = {k: globals()[k] for k in ORACLES}

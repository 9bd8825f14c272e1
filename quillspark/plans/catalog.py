"""Collections: tables with a declared schema, kept in Spark's catalog or as folders."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import uuid5

TYPES = {
    "TEXT": T.StringType(), "TEXT_ARRAY": T.ArrayType(T.StringType()), "INT": T.LongType(), "NUMBER": T.DoubleType(), "BOOLEAN": T.BooleanType(), "DATE": T.TimestampType(), "BLOB": T.BinaryType(),
    "UUID": T.StructType([T.StructField("uuid", T.StringType())]), "VECTOR": T.ArrayType(T.FloatType()),
}

# Collections, their properties and vectors.
COLLECTIONS = {
    "KnowledgeItem": (
        "title TEXT, body TEXT, chapter TEXT, author TEXT, year INT, categories TEXT_ARRAY, type TEXT, source TEXT, url TEXT, format TEXT, language TEXT, summary TEXT, embedding BLOB, created_at DATE, chunk_index INT",
        ("body_vector",),
    ),
    "KnowledgeMain": ("text TEXT, filename TEXT, tags TEXT_ARRAY, chunk_index INT", ("text_vector",)),
    "AudioItem": ("transcript TEXT, duration_sec NUMBER, language TEXT, filename TEXT, ofKnowledgeItem UUID", ("transcript_vector",)),
    "AudioChunk": ("text TEXT, time_start NUMBER, time_end NUMBER, chunk_index INT, ofAudioItem UUID", ("text_vector",)),
    "ImageItem": (
        "caption TEXT, ocr_text TEXT, width INT, height INT, backend TEXT, filename TEXT, ofKnowledgeItem UUID", ("caption_vector", "ocr_vector"),
    ),
    "VideoItem": ("transcript TEXT, duration_sec NUMBER, language TEXT, filename TEXT, ofKnowledgeItem UUID", ("transcript_vector",)),
    "VideoChunk": ("text TEXT, time_start NUMBER, time_end NUMBER, chunk_index INT, ofVideoItem UUID", ("text_vector",)),
    "AdaptiveSchools": (
        "text TEXT, chunk_index INT, document_id TEXT, title TEXT, type TEXT, chapterNumber INT, tags TEXT, source TEXT, uniqueId TEXT",
        ("default_vector",),
    ),
}
# End of the fixed values.


def schema_of(properties: str, vectors: tuple[str, ...] = ()) -> T.StructType:
    """``name TYPE, ...`` as a schema with an id and the vectors; an unknown type is text."""
    fields = [T.StructField("uuid", T.StringType(), False)]
    for p in filter(None, (p.strip() for p in properties.split(","))):
        name, _, kind = p.partition(" ")
        fields.append(T.StructField(name, TYPES.get(kind.strip().upper(), T.StringType())))
    return T.StructType(fields + [T.StructField(v, TYPES["VECTOR"]) for v in vectors])


def schema_of_yaml(text: str) -> tuple[str, T.StructType]:
    """Name and schema of a collection declared in YAML (``name`` or ``class``, and ``properties`` as a list or a map of name to type)."""
    import yaml

    d = yaml.safe_load(text) or {}
    props = d.get("properties") or []
    pairs = [(k, v) for k, v in props.items()] if isinstance(props, dict) else [(p["name"], p.get("data_type") or p.get("dataType") or p.get("type") or "TEXT") for p in props]
    kind = lambda v: (
        v[0] + "_ARRAY" if isinstance(v, list) and len(v) == 1 and not str(v[0]).isupper() else v[0]
    ) if isinstance(v, list) else str(v).upper().replace("[]", "_ARRAY")
    return d.get("name") or d.get("class"), schema_of(", ".join(f"{n} {str(kind(v)).upper()}" for n, v in pairs), ("default_vector",))


class Catalog:
    """Collections in a database of Spark's catalog, as Parquet tables."""

    def __init__(self, spark: SparkSession, database: str = "default"):
        if not re.fullmatch(r"\w+", database):
            raise ValueError("the database's name must be of letters, digits and _")
        self.spark, self.database = spark, database
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def _name(self, name: str) -> str:
        if not re.fullmatch(r"\w+", name):
            raise ValueError("a collection's name must be of letters, digits and _")
        return f"{self.database}.{name}"

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self._name(name))

    def create(self, name: str, schema: T.StructType) -> bool:
        """Whether the collection was made; one that is there stays as it is."""
        if self.exists(name):
            return False
        self.spark.createDataFrame([], schema).write.format("parquet").saveAsTable(self._name(name))
        return True

    def ensure(self, names: list[str] | None = None, declared: dict[str, T.StructType] | None = None) -> list[str]:
        """Make the collections that are missing, of ``declared`` or the registry; gives their names."""
        known = {n: schema_of(*x) for n, x in COLLECTIONS.items()} | (declared or {})
        unknown = [n for n in names or [] if n not in known]
        if unknown:
            raise KeyError(f"unknown collections: {', '.join(unknown)}")
        return [n for n in (names or list(known)) if self.create(n, known[n])]

    def list(self) -> list[str]:
        return sorted(t.name for t in self.spark.catalog.listTables(self.database) if not t.isTemporary)

    def describe(self, name: str) -> DataFrame:
        return self.spark.sql(f"DESCRIBE TABLE {self._name(name)}")

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self._name(name))

    def drop(self, names: list[str], yes_i_know: bool = False) -> None:
        if not yes_i_know:
            raise ValueError("dropping collections must be confirmed with yes_i_know=True")
        for n in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(n)}")

    def ingest(self, name: str, rows: DataFrame, key: list[str], max_errors: int = 10) -> int:
        """Add rows that aren't there yet, by an id made of ``key``; rows with a null key are errors, and more than
        ``max_errors`` of them stop the load before anything is written."""
        target = self.table(name).schema
        bad = F.lit(False)
        for k in key:
            bad = bad | F.col(k).isNull()
        errors = rows.where(bad).limit(max_errors + 1).count()
        if errors > max_errors:
            raise ValueError(f"more than {max_errors} rows without a key")
        ident = uuid5(F.concat_ws("/", F.lit(name), *(F.col(k).cast("string") for k in key)))
        have = {f.name.lower() for f in rows.schema.fields}
        shaped = rows.where(~bad).withColumn("uuid", ident).select(
            *((F.col(f.name) if f.name.lower() in have or f.name == "uuid" else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.fields)
        )
        new = shaped.dropDuplicates(["uuid"]).join(self.table(name).select("uuid"), "uuid", "left_anti").select(*target.names)
        new.write.mode("append").insertInto(self._name(name))
        return errors

    def delete(self, name: str, where: str) -> None:
        """Rows for which the condition holds go. The rest is written beside the table, which then takes its name: a failure at any
        point leaves all rows, under the table's name or with ``_old`` after it."""
        kept = self.table(name).where(f"NOT coalesce({where}, false)")
        here, new, old = (self._name(f"{name}{end}") for end in ("", "_new", "_old"))
        kept.write.mode("overwrite").format("parquet").saveAsTable(new)
        self.spark.sql(f"DROP TABLE IF EXISTS {old}")
        self.spark.sql(f"ALTER TABLE {here} RENAME TO {old}")
        self.spark.sql(f"ALTER TABLE {new} RENAME TO {here}")
        self.spark.sql(f"DROP TABLE {old}")

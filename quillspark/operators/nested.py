"""Nested data: structs, arrays and JSON of unknown shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flattened(df: DataFrame, depth: int | None = None, sep: str = ".") -> DataFrame:
    """Struct columns expanded to columns ``a.b``, ``depth`` levels or all of them. Of two columns with the same name the later gets ``_2``."""

    def walk(fields, path: tuple[str, ...], level: int):
        for f in fields:
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType) and (depth is None or level < depth):
                yield from walk(f.dataType.fields, here, level + 1)
            else:
                yield here

    taken: dict[str, int] = {}
    out = []
    for path in walk(df.schema.fields, (), 0):
        c = F.col(f"`{path[0]}`")
        for p in path[1:]:
            c = c.getField(p)
        name = sep.join(path)
        taken[name.lower()] = taken.get(name.lower(), 0) + 1
        out.append(c.alias(name if taken[name.lower()] == 1 else f"{name}_{taken[name.lower()]}"))
    return df.select(*out)


def side_tables(df: DataFrame, key: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Scalar columns, and for each array or map column a table (key, place, value)."""
    nested = [f for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.MapType)) and f.name != key]
    flat = df.drop(*(f.name for f in nested))
    sides = {}
    for f in nested:
        c = F.map_entries(f.name) if isinstance(f.dataType, T.MapType) else F.col(f.name)
        sides[f.name] = df.select(key, F.posexplode(c).alias("place", "value"))
    return flat, sides


def json_rows(c: Column) -> Column:
    """The objects of a JSON text as an array of maps: a list as it is, an object as a list of one, a scalar as ``{value}``; null if it is no JSON."""
    kind = F.substring(F.trim(c), 1, 1)
    text = F.when(kind == "[", c).when(kind == "{", F.concat(F.lit("["), c, F.lit("]"))).otherwise(F.concat(F.lit('[{"value":'), c, F.lit("}]")))
    return F.from_json(text, "array<map<string,string>>")


def sheets(df: DataFrame, key: str, json_col: str) -> DataFrame:
    """(key, sheet, row_no, cells): one sheet per top-level key if all values are lists or objects, else one sheet ``Data``."""
    obj = F.from_json(json_col, "map<string,string>")
    src = df.select(key, F.col(json_col).alias("_j"), F.when(F.startswith(F.trim(json_col), F.lit("{")), obj).alias("_m"))
    multi = F.coalesce(
        (F.size(F.map_keys("_m")) > 0) & F.forall(F.map_values("_m"), lambda v: F.coalesce(v.rlike(r"^\s*[\[{]"), F.lit(False))), F.lit(False),
    )
    entries = F.when(multi, F.map_entries("_m")).otherwise(F.array(F.struct(F.lit("Data").alias("key"), F.col("_j").alias("value"))))
    parts = src.select(key, F.explode(entries).alias("e"))
    return parts.select(key, F.col("e.key").alias("sheet"), F.posexplode(json_rows(F.col("e.value"))).alias("row_no", "cells"))

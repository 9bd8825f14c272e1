"""Pipelines: a configuration becomes a chain of DataFrame functions; only a chain of fallbacks runs jobs before the result is written."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, fields
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import providers
from ..functions import text as T
from ..operators import chunks as C
from ..operators import lines as L

Step = Callable[[DataFrame], DataFrame]
KINDS = ("text", "markdown", "json", "structured", "hybrid", "chunk", "store")
STRATEGIES = ("exclusive", "fallback_chain")


@dataclass(frozen=True)
class Settings:
    kind: str = "text"
    chunk_size: int = 800
    chunk_overlap: int = 100
    strategy: str = "fallback_chain"
    processors: tuple[str, ...] = ("text",)
    least_chars: int = 1
    before: tuple[Step, ...] = field(default=())
    after: tuple[Step, ...] = field(default=())

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown kind of pipeline: {self.kind}")
        if self.strategy not in STRATEGIES:
            raise ValueError(f"unknown strategy: {self.strategy}")
        if self.strategy == "exclusive" and len(self.processors) != 1:
            raise ValueError("an exclusive strategy has one processor")
        if not self.processors:
            raise ValueError("a pipeline has at least one processor")
        if not 0 <= self.chunk_overlap < self.chunk_size:
            raise ValueError("the overlap must be at least 0 and less than the size")


def layered(env: Mapping[str, str] | None = None, config: str | None = None, dotenv: str | None = ".env", prefix: str = "PIPELINE_") -> Settings:
    """Settings whose values come from the environment (``PIPELINE_CHUNK_SIZE``), else from a YAML file, else from a file of ``NAME=value``
    lines, else the defaults. Files that don't exist and names that are no setting are passed over; lists are comma-separated."""
    env = os.environ if env is None else env
    path = config or env.get(f"{prefix}CONFIG")
    found: dict[str, object] = {}
    names = {f.name: f.default for f in fields(Settings) if f.name not in ("before", "after")}
    if dotenv and Path(dotenv).exists():
        pairs = (line.split("=", 1) for line in Path(dotenv).read_text().splitlines() if "=" in line and not line.lstrip().startswith("#"))
        found |= {k.strip().upper(): v.strip().strip("\"'") for k, v in pairs}
    if path and Path(path).exists():
        import yaml

        found |= {f"{prefix}{k}".upper(): v for k, v in (yaml.safe_load(Path(path).read_text()) or {}).items()}
    found |= {k.upper(): v for k, v in env.items()}
    given = {n: v for n in names if (v := found.get(f"{prefix}{n}".upper())) is not None}
    listed = lambda v: tuple(x.strip() for x in v.split(",") if x.strip()) if isinstance(v, str) else tuple(v)
    return Settings(**{n: listed(v) if isinstance(names[n], tuple) else type(names[n])(v) for n, v in given.items()})


def identified(df: DataFrame) -> DataFrame:
    """An id for each document: its own, else one made of its path."""
    made = T.uuid5(F.concat(F.lit("document/"), F.coalesce("source_path", F.lit("")), F.lit("#"), F.md5(F.coalesce("content", F.lit("")))))
    return df.withColumn("id", F.coalesce("id", made) if "id" in df.columns else made)


def markdown(df: DataFrame) -> DataFrame:
    """Adds ``markdown``: title, contents and text with detected headings."""
    lines = L.detect_headings(L.exploded(df, "id", "content"), "id").withColumn("line", F.coalesce("heading", "line"))
    parts = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    toc = F.array_sort(
        F.collect_list(
            F.when(
                F.col("heading").isNotNull(),
                F.struct(
                    "line_no",
                    F.concat(
                        F.lit("  - ["), F.substring("heading", 4, 1000), F.lit("](#"), T.anchor(F.substring("heading", 4, 1000)), F.lit(")"),
                    ).alias("e"),
                ),
            )
        )
    )
    body = lines.groupBy("id").agg(
        T.collapsed_blank_lines(F.array_join(F.transform(parts, lambda x: x["line"]), "\n")).alias("_body"),
        F.array_join(F.transform(toc, lambda x: x["e"]), "\n").alias("_toc"),
    )
    title = T.title_cascade(F.col("metadata.title"), F.col("source_path"), F.col("content"))
    whole = F.concat(
        F.lit("# "), title, F.lit("\n\n"),
        F.when(F.col("_toc") != "", F.concat(F.lit("## Contents\n\n"), F.col("_toc"), F.lit("\n\n"))).otherwise(""), F.coalesce("_body", F.lit("")),
    )
    return df.join(body, "id", "left").withColumn("markdown", F.when(F.col("content").isNotNull(), whole)).drop("_body", "_toc")


def structured(df: DataFrame) -> DataFrame:
    """Adds ``json``: title, source and sections with summaries, by rule."""
    sections = L.extract_sections(L.detect_headings(L.exploded(df, "id", "content"), "id").withColumn("line", F.coalesce("heading", "line")), "id")
    one = F.struct("section_no", "heading", "level", T.truncated(F.col("content"), 200).alias("content_summary"))
    found = sections.groupBy("id").agg(
        F.transform(
            F.array_sort(F.collect_list(one)),
            lambda s: F.struct(s["heading"].alias("heading"), s["level"].alias("level"), s["content_summary"].alias("content_summary")),
        ).alias("_s")
    )
    j = F.to_json(
        F.struct(
            F.col("id").alias("document_id"), T.title_of_text(F.col("content")).alias("title"), F.col("source_path").alias("source"),
            F.col("_s").alias("sections"),
        )
    )
    return df.join(found, "id", "left").withColumn("json", j).drop("_s")


def chunked(size: int, overlap: int) -> Step:
    def step(df: DataFrame) -> DataFrame:
        return C.token_windows(df.select("id", "source_path", "metadata", F.coalesce("content", F.lit("")).alias("_c")), "_c", size, overlap)

    return step


def extracted(df: DataFrame, s: Settings, processors: dict[str, Step]) -> DataFrame:
    """``content`` and ``error`` of the first listed processor that succeeds, else the last error.

    A processor takes rows and gives them with their ``content`` and ``error``; ``text`` leaves them as they were read.
    A chain of more than one writes to the shared checkpoint folder.
    """
    known = {"text": lambda d: d, **processors}
    unknown = [n for n in s.processors if n not in known]
    if unknown:
        raise ValueError(f"unknown processors: {', '.join(unknown)}")
    if len(s.processors) == 1:
        got = known[s.processors[0]](df)
        return got.withColumn("error", providers.failure(s.least_chars)) if {"content", "error"} <= set(got.columns) else got
    rows = df.withColumn("_row", F.monotonically_increasing_id()).checkpoint()
    found = providers.first_success(rows, "_row", [(n, known[n]) for n in s.processors], s.least_chars).drop("processor")
    rest = rows.drop("content", "error").join(found, "_row", "left")
    return rest.select(*df.columns)


def steps(s: Settings) -> list[Step]:
    chunk = chunked(s.chunk_size, s.chunk_overlap)
    own = {
        "text": [], "markdown": [markdown], "json": [structured], "structured": [structured], "hybrid": [markdown, structured], "chunk": [chunk],
        "store": [chunk, lambda d: C.upload_rows(d, "id")],
    }[s.kind]
    return [identified, *own, *s.after]


def run(df: DataFrame, settings: Settings, processors: dict[str, Step] | None = None) -> DataFrame:
    for step in (*settings.before, lambda d: extracted(d, settings, processors or {}), *steps(settings)):
        df = df.transform(step)
    return df

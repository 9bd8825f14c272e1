"""Interfaces to programs outside (page extraction, speech, language and embedding models), with deterministic stand-ins."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class PageExtractor(Protocol):
    def __call__(self, data: bytes, path: str) -> dict: ...


class Completer(Protocol):
    def __call__(self, prompts: list[str]) -> list[str]: ...


class Embedder(Protocol):
    def __call__(self, texts: list[str]) -> list[list[float]]: ...


def rule_completer(prompts: list[str]) -> list[str]:
    """Answers by rule: the first line of the prompt's last paragraph as a title, in JSON."""
    import json

    return [json.dumps({"title": (p.rsplit("\n\n", 1)[-1].strip().split("\n") or [""])[0][:80]}) for p in prompts]


def hash_embedder(texts: list[str], dim: int = 64) -> list[list[float]]:
    out = []
    for t in texts:
        v = [0.0] * dim
        for w in t.lower().split():
            v[int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % dim] += 1.0
        out.append(v)
    return out


def completed(
    df: DataFrame, prompt: str, complete: Callable[[list[str]], list[str]], out: str = "answer", batch: int = 32, retries: int = 2,
) -> DataFrame:
    """Adds the answers to the prompts; a batch that fails is tried again, and then its rows get ``<out>_error``."""
    names = df.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            answers: list[str | None] = []
            errors: list[str | None] = []
            for i in range(0, len(b), batch):
                prompts = [p or "" for p in b[prompt].iloc[i : i + batch]]
                for attempt in range(retries + 1):
                    try:
                        answers += complete(prompts)
                        errors += [None] * len(prompts)
                        break
                    except Exception as e:
                        if attempt == retries:
                            answers += [None] * len(prompts)
                            errors += [str(e)[:500]] * len(prompts)
            yield b.assign(**{out: answers, f"{out}_error": errors})

    from pyspark.sql import types as T

    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StringType()), T.StructField(f"{out}_error", T.StringType())])
    return df.select(*names).mapInPandas(run, schema)


def failure(least_chars: int = 1):
    """The error of a row: its own, else that its content is missing, blank or shorter than ``least_chars``."""
    size = F.length(F.regexp_replace(F.coalesce("content", F.lit("")), r"^\s+|\s+$", ""))
    return F.coalesce("error", F.when(size < max(1, least_chars), F.lit("too little text")))


def first_success(df: DataFrame, key: str, attempts: list[tuple[str, Callable[[DataFrame], DataFrame]]], least_chars: int = 1) -> DataFrame:
    """(key, content, processor, error): attempts in order, each only over what those before have failed on.

    An attempt takes rows and gives (key, content, error); content that is blank or shorter than ``least_chars`` is a failure. What all fail on keeps the last error. The results of an
    attempt are written to the shared checkpoint folder, as the next depends on them.
    """
    left, out, last = df, None, None
    for name, attempt in attempts:
        got = attempt(left).select(key, "content", failure(least_chars).alias("error")).withColumn("processor", F.lit(name)).checkpoint()
        ok = got.where("error is null")
        out = ok if out is None else out.unionByName(ok)
        left = left.join(ok.select(key), key, "left_anti")
        last = got
    failed = last.join(out.select(key), key, "left_anti").withColumn("content", F.lit(None).cast("string"))
    return out.unionByName(failed)

"""Token counts by a public byte-level BPE vocabulary, whose path is a parameter."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced

TOKENIZER_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the published pre-tokenisation pattern of this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# End of the fixed value.


@lru_cache(maxsize=2)
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_token_counts(df: DataFrame, keys: list[str], text_col: str = "text", tokenizer_path: str = TOKENIZER_PATH) -> DataFrame:
    """``keys`` and ``n_tokens`` (0 for a null text); the text itself goes no further than the Python worker."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(tokenizer_path)
        for b in sliced(batches):
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keys), pa.array(n, pa.int64())], names=[*keys, "n_tokens"])

    src = df.select(*keys, F.col(text_col).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "_text")
    return src.mapInArrow(count, f"{schema}, n_tokens bigint")

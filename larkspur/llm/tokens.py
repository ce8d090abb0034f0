"""Sizes of texts in tokens of a public vocabulary, in Arrow batches."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the vocabulary's pattern of pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@cache
def encoder(vocabulary: str, pattern: str):
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_counts(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """The columns of ``keep`` and ``n_tokens``; NULL and empty texts have 0. Special tokens' names are ordinary text.

    ``vocabulary`` is a path that every executor can read.
    """
    chosen = df.select(*keep, text)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, pattern).encode_ordinary
        for batch in batches:
            sizes = [len(encode(t)) if t else 0 for t in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(sizes, pa.int64())], names=[*keep, "n_tokens"])

    fields = ", ".join(f"`{c}` {chosen.schema[c].dataType.simpleString()}" for c in keep)
    return chosen.mapInArrow(count, f"{fields}, n_tokens bigint")

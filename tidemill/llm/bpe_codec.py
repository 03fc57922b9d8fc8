"""Byte-level BPE with the tiktoken library: texts to ids and ids to bytes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import session
from .vocab import LONG_TEXT, safe_pieces, vocabulary_path

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


@lru_cache(maxsize=4)
def codec(vocabulary: str = VOCABULARY):
    """The library's encoding over a local rank file, without special tokens; once per worker."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(vocabulary_path(vocabulary), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode_text(text: str | None, vocabulary: str = VOCABULARY, limit: int = LONG_TEXT) -> list[int]:
    """Ids of a whole text; a long one is pre-split where no token can cross."""
    encode = codec(vocabulary).encode_ordinary
    if not text:
        return []
    if len(text) <= limit:
        return encode(text)
    return [i for piece in safe_pieces(text, limit) for i in encode(piece)]


def encoded(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Token ids of a text column as ``array<int>``; null counts as empty."""
    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np

        for batch in batches:
            ids = [np.array(encode_text(t, vocabulary), np.int32) for t in batch.to_pylist()]
            ends = np.cumsum([0, *map(len, ids)])
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))

    return run(text)


def decoded(ids: Column, vocabulary: str = VOCABULARY) -> Column:
    """The raw bytes of token ids as ``binary``: bytes need not be whole characters. Null gives null."""
    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decode = codec(vocabulary).decode_bytes
        for batch in batches:
            yield pa.array([None if x is None else decode(x) for x in batch.to_pylist()], pa.binary())

    return run(ids)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, n_tokens, ids`` per row of ``docs``.

    Every match of the pattern is encoded by itself, without special tokens. A null text is empty and
    has no ids, a null id is carried along, repeated rows stay, an empty table gives no rows, other
    columns are ignored. Texts are encoded whole, however long.
    """
    session(docs.sparkSession)
    ids = docs.select(F.col(id_col).alias("doc_id"), encoded(F.col(text_col), vocabulary).alias("ids"))
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


def decode(tokens: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``tokens (ids)`` with the bytes of each row as ``decoded``. Null ids give null, no ids no bytes; repeated rows stay."""
    session(tokens.sparkSession)
    return tokens.withColumn("decoded", decoded(F.col("ids"), vocabulary))

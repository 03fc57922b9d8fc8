"""Token counts by byte-pair merging with a heap over a linked list; no identifier is made."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import session
from .vocab import spelled, vocabulary_path, words_of

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
#: Words, and pattern matches, whose counts a worker remembers.
REMEMBERED = 300_000


def merged_count(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Symbols left after all merges: the lowest-ranked adjacent pair first, leftmost of equals.

    The heap holds candidate pairs by rank and place, the two lists link each symbol to its
    neighbours. A popped pair whose symbols have changed since is stale and skipped.
    """
    n = len(symbols)
    if n < 2:
        return n
    symbols = list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = ranks.get((symbols[i], symbols[i + 1]))
        if rank is not None:
            heap.append((rank, i, symbols[i], symbols[i + 1]))
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != left or j >= n or symbols[j] != right:
            continue
        merges += 1
        symbols[i], symbols[j] = left + right, ""
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            rank = ranks.get((symbols[i], symbols[k]))
            if rank is not None:
                heapq.heappush(heap, (rank, i, symbols[i], symbols[k]))
        h = before[i]
        if h >= 0:
            rank = ranks.get((symbols[h], symbols[i]))
            if rank is not None:
                heapq.heappush(heap, (rank, h, symbols[h], symbols[i]))
    return n - merges


def byte_symbols() -> list[str]:
    """One printable character per byte: itself where it prints, else the next unused one from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [""] * 256, 256
    for b in range(256):
        out[b] = chr(b) if b in own else chr(spare)
        spare += b not in own
    return out


class Counter:
    """Counts tokens with one vocabulary; keeps the counts of words it has met, within a bound."""

    def __init__(self, vocabulary: str):
        import json

        import public_tokenizers
        import regex

        with open(vocabulary_path(vocabulary), encoding="utf-8") as file:
            spec = json.load(file)
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"])
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.strings = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, self.strings)) or "(?!)")
        # White space as the library's engine counts it: by the Unicode property.
        self.matches = regex.compile(public_tokenizers.PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        self.symbols = byte_symbols()
        self.words: dict[str, int] = {}
        self.parts: dict[str, int] = {}

    def _part(self, part: str) -> int:
        count = self.parts.get(part)
        if count is None:
            if len(self.parts) >= REMEMBERED:
                self.parts.clear()
            symbols = self.symbols
            count = self.parts[part] = merged_count([symbols[b] for b in part.encode()], self.ranks)
        return count

    def count(self, text: str | None) -> int:
        """Tokens of a whole text: special strings count one each, as the library finds them."""
        if not text:
            return 0
        total, stretches = 0, [text]
        if any(s in text for s in self.strings):
            stretches = self.special.split(text)
            total = len(stretches) - 1
        known = self.words
        for stretch in stretches:
            first, words = words_of(stretch)
            total += sum(map(self._part, self.matches(first)))
            new = set(words).difference(known)
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = set(words)
            for word in new:
                known[word] = sum(map(self._part, self.matches(spelled(word))))
            total += sum(map(known.__getitem__, words))
        return total


@lru_cache(maxsize=4)
def counter(vocabulary: str = VOCABULARY) -> Counter:
    return Counter(vocabulary)


def token_count(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Number of tokens of a text column; null counts as empty."""
    @F.arrow_udf("long")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count = counter(vocabulary).count
        for batch in batches:
            yield pa.array([count(t) for t in batch.to_pylist()], pa.int64())

    return run(text)


def count_tokens(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, limit: int = LIMIT
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row of ``docs``.

    No begin, end or other tokens are added, nothing is cut off. A null text is empty, a null id is
    carried along, repeated rows stay, an empty table gives no rows, other columns are ignored.
    A word's merging takes n log n steps, so a very long word is no trap.
    """
    session(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(
        F.col(id_col).alias("doc_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        token_count(text, vocabulary).alias("n_tokens"),
    )
    return found.withColumn("over_limit", F.col("n_tokens") > limit)

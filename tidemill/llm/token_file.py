"""Token ids in a block file of Simple-8b words, written in document order and read back."""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import session
from .vocab import GLUED, even_words, vocabulary_path, words_of

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
#: Ids after which a block is closed. A document is never divided, so a block holds one at least.
BLOCK_IDS = 65_536
#: Words whose ids a worker remembers.
REMEMBERED = 800_000

# The word format: the top four bits select how many values of how many bits the other sixty hold.
#: Values per word by selector; selector 0 and 1 are runs of zeros, 15 points to an escaped value.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
#: Selector 15 with this bit set: the low bits index the block's list of values over 60 bits.
ESCAPE_BIT = np.uint64(1 << 59)
LARGEST = (1 << 59) - 1
#: Bit widths of the values below 65,536.
SHORT_WIDTHS = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(words, escapes)`` of unsigned 64-bit ``values``.

    At every place the selector that takes most of the values ahead is found for all places at
    once, from running maxima of their bit widths; then the greedy chain of places is followed.
    A value that needs more than 59 bits stands in ``escapes``, and a word of its own points to it.
    """
    values = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(values)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    wide = np.flatnonzero(values > np.uint64(LARGEST))
    escapes = values[wide]
    if len(wide):
        values = values.copy()
        values[wide] = ESCAPE_BIT | np.arange(len(wide), dtype=np.uint64)
    rest, largest = values, values.max()
    if largest < 1 << 16:
        bits = SHORT_WIDTHS[values]
    elif largest < 1 << 32:  # the exponent of an exact float is the bit width
        bits = np.frexp(values.astype(np.float64))[1].astype(np.uint8)
    else:
        high = np.frexp((rest >> np.uint64(32)).astype(np.float64))[1].astype(np.uint8)
        low = np.frexp((rest & np.uint64(0xFFFFFFFF)).astype(np.float64))[1].astype(np.uint8)
        bits = np.where(high > 0, high + 32, low).astype(np.uint8)
    best = np.full(n, 15, np.uint8)
    longest, length = bits, 1  # longest[i]: the widest of `length` values from i on
    for selector in range(14, -1, -1):
        count, width = int(COUNTS[selector]), int(WIDTHS[selector])
        if count > n:
            break
        while length < count:
            step = min(length, count - length)
            longest = np.maximum(longest[: len(longest) - step], longest[step:])
            length += step
        if longest.min() > width:  # no longer run of fewer bits can fit either
            break
        best[: len(longest)][longest <= width] = selector
    counts = COUNTS.astype(np.uint8)[best].tobytes()
    places, at = [], 0
    while at < n:
        places.append(at)
        at += counts[at]
    places = np.array(places)
    chosen = best[places]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for selector in range(2, 16):
        own = np.flatnonzero(chosen == selector)
        if len(own):
            count, width = int(COUNTS[selector]), int(WIDTHS[selector])
            taken = values[places[own][:, None] + np.arange(count)] << (np.arange(count, dtype=np.uint64) * np.uint64(width))
            words[own] |= np.bitwise_or.reduce(taken, axis=1)
    return words, escapes


def unpack(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The values of ``pack``: all words of one selector are spread at once."""
    words = np.ascontiguousarray(words, dtype=np.uint64)
    selectors = (words >> np.uint64(60)).astype(np.int64)
    ends = np.cumsum(COUNTS[selectors]) if len(words) else np.zeros(0, np.int64)
    out = np.zeros(int(ends[-1]) if len(words) else 0, np.uint64)
    starts = ends - COUNTS[selectors]
    for selector in range(2, 16):
        own = np.flatnonzero(selectors == selector)
        if len(own):
            count, width = int(COUNTS[selector]), int(WIDTHS[selector])
            shifts = np.arange(count, dtype=np.uint64) * np.uint64(width)
            values = (words[own][:, None] >> shifts) & np.uint64((1 << width) - 1)
            if selector == 15 and len(escapes):
                far = (values[:, 0] & ESCAPE_BIT) > 0
                values[far, 0] = escapes[(values[far, 0] ^ ESCAPE_BIT).astype(np.int64)]
            out[starts[own][:, None] + np.arange(count)] = values
    return out


#: Words the library is given in one text.
AT_ONCE = 200


class Encoder:
    """Ids of whole texts by the tokenizers library; remembers the ids of words it has met."""

    def __init__(self, vocabulary: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary_path(vocabulary))
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.words: dict[str, bytes] = {}
        self.breaks = self._whole(["\n"])[0]

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _learn(self, words: list[str]) -> None:
        """Ids of words as ``words_of`` cuts them. Those without line breaks go to the library many at once.

        They are put on lines of their own: a line break between them is a token by itself.
        """
        # A space stands only at the end of a word, and the mark of a glued one is not printable.
        spaced = [w for w in words if w.isprintable() and w[-1] != " "]
        plain = list(zip(spaced, map(" ".__add__, spaced)))
        other = []
        for word in set(words).difference(spaced):
            text = word[1:] if word[0] == GLUED else " " + word
            (plain if text.isprintable() and text[-1] != " " else other).append((word, text))
        known = self.words
        for start in range(0, len(plain), AT_ONCE):
            some = plain[start : start + AT_ONCE]
            (ids,) = self._whole(["\n".join(t for _, t in some)])
            values = np.frombuffer(ids, "<u4")
            ends = (4 * np.flatnonzero(values == np.frombuffer(self.breaks, "<u4")[0])).tolist()
            if len(ends) != len(some) - 1:
                other += some
                continue
            cuts = map(slice, [0, *(e + 4 for e in ends)], [*ends, len(ids)])
            known.update(zip((w for w, _ in some), map(ids.__getitem__, cuts)))
        known.update(zip((w for w, _ in other), self._whole([t for _, t in other])))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids per text. Words that are new in this batch go to the library, once each.

        The words of a batch are told apart by Arrow, so that only distinct ones become Python
        texts; ids are then spread over all words at once. A text with a special string goes
        to the library whole, as its cut words might not stand alone. Once REMEMBERED words are known,
        others are forgotten after the batch; with a batch of mostly new words (another language)
        the memory starts afresh.
        """
        apart = {i for i, t in enumerate(texts) if any(s in t for s in self.special)}
        heads, even, uneven, loose = [""] * len(texts), [], [], []
        lines = []
        for i, text in enumerate(texts):
            if i in apart:
                continue
            marked = even_words(text)
            if marked is not None:
                heads[i], _, rest = marked.partition(" ")
                if rest:
                    even.append(i)
                    lines.append(rest)
            else:
                heads[i], words = words_of(text)
                uneven.append((i, len(words)))
                loose += words
        lists = pc.split_pattern(pa.array(lines, pa.large_string()), " ")
        sizes = [*pc.list_value_length(lists).to_pylist(), *(n for _, n in uneven)]
        flat = pa.concat_arrays([lists.flatten(), pa.array(loose, pa.large_string())])
        del lists, lines, loose
        coded = flat.dictionary_encode()
        wanted = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        own = list(map(self.words.get, wanted))
        gaps = [i for i, ids in enumerate(own) if ids is None]
        if len(self.words) > REMEMBERED and 2 * len(gaps) > len(wanted):
            self.words.clear()
        full = len(self.words) > REMEMBERED
        new = [wanted[i] for i in gaps]
        self._learn(new)
        for i, word in zip(gaps, new):
            own[i] = self.words.pop(word) if full else self.words[word]

        spread, ends = self._spread(own, coded.indices.to_numpy())
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])].tolist()
        out = [np.frombuffer(ids, "<u4") for ids in self._whole(heads)]
        for i, start, end in zip([*even, *(i for i, _ in uneven)], bounds, bounds[1:]):
            out[i] = np.concatenate([out[i], spread[start:end]])
        for i, ids in zip(sorted(apart), self._whole([texts[i] for i in sorted(apart)])):
            out[i] = np.frombuffer(ids, "<u4")
        return out

    @staticmethod
    def _spread(own: list[bytes], places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``own[p]`` for every place one behind the other, and where each one ends."""
        ids = np.frombuffer(b"".join(own), "<u4")
        sizes = np.fromiter(map(len, own), np.int64, len(own)) // 4
        starts = np.cumsum(sizes) - sizes
        taken = sizes[places]
        ends = np.cumsum(taken)
        if not len(ends):
            return ids, ends
        return ids[np.repeat(starts[places] - ends + taken, taken) + np.arange(ends[-1])], ends


@lru_cache(maxsize=4)
def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    return Encoder(vocabulary)


_BLOCK = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int64()),
        ("first", pa.int64()),
        ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("words", pa.binary()),
        ("escapes", pa.binary()),
    ]
)


#: Bytes from which batches are encoded: the more there are, the more words repeat.
GATHERED = 4 << 20


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together until they hold GATHERED bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= GATHERED:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def write_tokens(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
) -> None:
    """Write the ids of every text, each closed by ``end_id``, in ascending order of ids.

    The documents are dealt out by ranges of their id; each range becomes one run of blocks. A row
    of the file is a block: its ``part`` (the range) and number, ``first`` (ids before it in its
    part), its documents with the number of ids of each, and the packed words with
    escaped values. Blocks carry their own offsets, so each is decoded by itself, in any order.
    The file is a folder that Spark commits as a whole: a lost task is run again, and half-written
    output is never seen.

    Null ids come first; documents that repeat an id lie side by side, ordered by a hash of their text. A null
    text is empty and has the end id only. An empty table writes no blocks.
    """
    session(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    rows = rows.select(F.spark_partition_id().alias("part"), "doc_id", "text")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        end = np.array([end_id], "<u4")
        number, first, held = 0, 0, 0
        part, names, lengths, ids = 0, [], [], []

        def block() -> pa.RecordBatch:
            words, escapes = pack(np.concatenate(ids))
            row = [part, number, first, held, names, lengths, words.astype("<u8").tobytes(), escapes.astype("<u8").tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _BLOCK)], schema=_BLOCK)

        for batch in _gathered(batches):
            found = encode(batch.column("text").to_pylist())
            for own, name, p in zip(found, batch.column("doc_id").to_pylist(), batch.column("part").to_pylist()):
                part = p
                names.append(name)
                lengths.append(len(own) + 1)
                ids += [own, end]
                held += len(own) + 1
                if held >= BLOCK_IDS:
                    yield block()
                    number, first, held = number + 1, first + held, 0
                    names, lengths, ids = [], [], []
        if names:
            yield block()

    schema = "part int, block long, first long, n_ids long, doc_ids array<long>, lengths array<long>, words binary, escapes binary"
    rows.mapInArrow(blocks, schema).write.parquet(path)


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """``(part, start)``: ids in all parts before each. One row per part; only headers are read."""
    totals = spark.read.parquet(path).groupBy("part").agg(F.sum("n_ids").alias("n"))
    return totals.select("part", F.expr("sum(n) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n").alias("start"))


def read_tokens(spark: SparkSession, path: str, as_digest: bool = False) -> DataFrame:
    """Documents of a token file: ``doc_id, start, n_tokens`` and ``ids``, or their ``ids_crc32``.

    ``start`` counts the ids of all documents before, ``n_tokens`` includes the end id.
    """
    session(spark)
    stored = spark.read.parquet(path)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in batches:
            for row in batch.to_pylist():
                values = unpack(np.frombuffer(row["words"], "<u8"), np.frombuffer(row["escapes"], "<u8")).astype("<u4")
                ends = np.cumsum(row["lengths"])
                starts = ends - np.array(row["lengths"])
                if as_digest:
                    raw = memoryview(values.tobytes())
                    last = pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())], pa.int64())
                else:
                    last = pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), pa.array(values.astype(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * len(ends), pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts + row["first"], pa.int64()),
                        pa.array(row["lengths"], pa.int64()),
                        last,
                    ],
                    names=["part", "doc_id", "within", "n_tokens", "ids_crc32" if as_digest else "ids"],
                )

    last = "ids_crc32 long" if as_digest else "ids array<long>"
    found = stored.mapInArrow(documents, f"part int, doc_id long, within long, n_tokens long, {last}")
    return found.join(part_starts(spark, path), "part").select(
        "doc_id", (F.col("start") + F.col("within")).alias("start"), "n_tokens", last.split()[0]
    )


def packed(values: Column) -> Column:
    """``array<long>`` of non-negative values as Simple-8b words, for use outside the file."""

    @F.arrow_udf("struct<words: binary, escapes: binary>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            both = [(None, None) if v is None else tuple(x.astype("<u8").tobytes() for x in pack(np.array(v, np.uint64))) for v in batch.to_pylist()]
            yield pa.StructArray.from_arrays(
                [pa.array([a for a, _ in both], pa.binary()), pa.array([b for _, b in both], pa.binary())], ["words", "escapes"]
            )

    return run(values)

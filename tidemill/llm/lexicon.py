"""Byte-level BPE through a lexicon: frequent words in a minimal acyclic transducer, other words merged."""

from __future__ import annotations

import heapq
import mmap
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from .common import kept, session
from .vocab import GLUED, even_words, spelled, vocabulary_path, words_of

VOCABULARY = "byte_bpe_50k.json"
#: Words of the corpus that are compiled, at most: the most frequent ones. It bounds the automaton (some 7 MB), not the texts.
LEXICON_WORDS = 200_000
#: Bytes of the longest word that is compiled, and the lookup's number of steps.
LONGEST_WORD = 48
#: Bytes from which batches are worked on together: the more there are, the more words repeat.
GATHERED = 2 << 20
#: Rows of one batch handed back to Spark.
BATCH = 256
#: Bytes up to which matches are merged side by side; a heap takes over beyond.
SIDE_BY_SIDE = 32
#: Matches merged side by side at once.
AT_ONCE = 20_000
_NEVER = 1 << 30


def byte_characters() -> list[str]:
    """The character that stands for each byte in the vocabulary: itself if printable, else the next from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Merges:
    """The vocabulary file: exact merging of any word, and the bytes of each id."""

    def __init__(self, vocabulary: str):
        import json

        import public_tokenizers
        import regex

        with open(vocabulary_path(vocabulary), encoding="utf-8") as file:
            spec = json.load(file)
        self.ids: dict[str, int] = spec["model"]["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.added: dict[str, int] = {}
        for token in spec["added_tokens"]:
            if token["single_word"] or token["lstrip"] or token["rstrip"]:
                raise ValueError(f"vocabulary {vocabulary}: options of the added token {token['content']!r} are not supported")
            self.added[token["content"]] = token["id"]
        longest_first = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.added else None
        # White space as the library's engine counts it: by the Unicode property.
        pattern = public_tokenizers.PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.matches = regex.compile(pattern).findall
        self.characters = byte_characters()
        # The same merges by ids: sorted pairs, the rank of each, and what each rank makes.
        self.size = len(self.ids) + 1
        coded = np.array([self.ids[a] * self.size + self.ids[b] for a, b in pairs], np.int64)
        order = np.argsort(coded)
        self.pairs, self.pair_ranks = coded[order], order.astype(np.int32)
        self.made = np.array([self.ids[a + b] for a, b in pairs], np.int32)
        self.byte_ids = np.array([self.ids[c] for c in self.characters], np.int32)
        value = {c: b for b, c in enumerate(self.characters)}
        spelling = [b""] * (max([*self.ids.values(), *self.added.values()]) + 1)
        for text, i in [*self.ids.items(), *self.added.items()]:
            known = all(c in value for c in text)
            spelling[i] = bytes(map(value.__getitem__, text)) if known else text.encode()
        # The bytes of all ids one behind the other.
        self.letters = np.frombuffer(b"".join(spelling), np.uint8)
        self.lengths = np.fromiter(map(len, spelling), np.int64, len(spelling))
        self.starts = np.cumsum(self.lengths) - self.lengths

    def merge(self, symbols: list[str]) -> list[str]:
        """Symbols after all merges: the lowest-ranked adjacent pair first, the leftmost of equals.

        A heap holds the pairs by rank and place, the places are linked: n log n steps. Pairs that are no more are skipped.
        """
        parts: list[str | None] = list(symbols)
        following, leading = [*range(1, len(parts)), -1], list(range(-1, len(parts) - 1))
        heap = [(r, i, pair) for i, pair in enumerate(zip(symbols, symbols[1:])) if (r := self.ranks.get(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = following[i]
            if j < 0 or (parts[i], parts[j]) != pair:
                continue
            parts[i], parts[j] = pair[0] + pair[1], None
            following[i] = following[j]
            if following[i] >= 0:
                leading[following[i]] = i
            for k in (leading[i], i):
                if k >= 0 and following[k] >= 0:
                    fresh = parts[k], parts[following[k]]
                    if (r := self.ranks.get(fresh)) is not None:
                        heapq.heappush(heap, (r, k, fresh))
        return [p for p in parts if p is not None]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; a pair that never merges, or has an end of -1, is last."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[at] == key) & (right >= 0), self.pair_ranks[at], _NEVER).astype(np.int32)

    def merge_many(self, matches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, sizes)`` of short matches, by ``merge``'s rule in all of them at once.

        Every round merges one pair in each match that has one left: rows of ids, and of the ranks of their neighbours,
        close up over the merged place, and the two ranks beside it are looked up again.
        """
        n, width = len(matches), max(map(len, matches), default=0) + 1
        lengths = np.fromiter(map(len, matches), np.int64, n)
        ids = np.full((n, width), -1, np.int32)
        ids[np.arange(width) < lengths[:, None]] = self.byte_ids[np.frombuffer(b"".join(matches), np.uint8)]
        ranks = self._rank(ids[:, :-1], ids[:, 1:]) if width > 1 else np.full((n, 1), _NEVER, np.int32)
        columns, rows = np.arange(width), np.arange(n)
        while len(rows):
            own = ranks[rows]
            place = own.argmin(axis=1)
            least = own[np.arange(len(rows)), place]
            live = least < _NEVER
            rows, place, least, own = rows[live], place[live], least[live], own[live]
            if not len(rows):
                break
            shift = columns + (columns > place[:, None])
            symbols = np.take_along_axis(np.pad(ids[rows], ((0, 0), (0, 1)), constant_values=-1), shift, 1)
            own = np.take_along_axis(np.pad(own, ((0, 0), (0, 1)), constant_values=_NEVER), columns[:-1] + (columns[:-1] >= place[:, None]), 1)
            each = np.arange(len(rows))
            symbols[each, place] = self.made[least]
            own[each, place] = self._rank(symbols[each, place], symbols[each, place + 1])
            inner = np.flatnonzero(place)
            own[inner, place[inner] - 1] = self._rank(symbols[inner, place[inner] - 1], symbols[inner, place[inner]])
            ids[rows], ranks[rows] = symbols, own
        found = ids >= 0
        return ids[found].astype(np.int64), found.sum(axis=1)

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, sizes)`` of words as ``words_of`` cuts them, by merging each match of the pattern."""
        matches, per_word = [], []
        for word in words:
            text = spelled(word)
            found = [text] if text.lstrip(" ").isalpha() and len(text) - len(text.lstrip(" ")) < 2 else self.matches(text)
            matches += [m.encode() for m in found]
            per_word.append(len(found))
        sizes = np.zeros(len(matches), np.int64)
        short = sorted((i for i, m in enumerate(matches) if len(m) <= SIDE_BY_SIDE), key=lambda i: len(matches[i]))
        parts: list[np.ndarray] = []
        places: list[np.ndarray] = []  # the match that each id belongs to
        for start in range(0, len(short), AT_ONCE):
            some = np.array(short[start : start + AT_ONCE])
            ids, counts = self.merge_many([matches[i] for i in some.tolist()])
            sizes[some] = counts
            parts.append(ids)
            places.append(np.repeat(some, counts))
        for i, match in enumerate(matches):
            if len(match) > SIDE_BY_SIDE:
                ids = [self.ids[p] for p in self.merge([self.characters[b] for b in match])]
                sizes[i] = len(ids)
                parts.append(np.array(ids, np.int64))
                places.append(np.full(len(ids), i))
        flat = np.concatenate([np.zeros(0, np.int64), *parts])
        order = np.argsort(np.concatenate([np.zeros(0, np.int64), *places]), kind="stable")
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(per_word, dtype=np.int64)])]
        return flat[order], np.diff(ends)


@lru_cache(maxsize=4)
def merges(vocabulary: str = VOCABULARY) -> Merges:
    return Merges(vocabulary)


# --- the transducer ---------------------------------------------------------------------------------------


class _Node:
    """A state under construction: its edges by byte, and what is still to be written where a word ends."""

    __slots__ = ("edges", "final")

    def __init__(self):
        self.edges: dict[int, list] = {}
        self.final: tuple[int, ...] | None = None


def compile_words(words: Iterable[tuple[bytes, tuple[int, ...]]]) -> bytes:
    """The minimal transducer from distinct ``words`` in ascending order to their ids, as bytes to be mapped.

    Every edge writes the ids that all words through it share and none before it has written, so equal rests of
    words, however they began, are one state: the states are told apart by their edges, outputs and
    endings, and those of a finished rest are looked up among all finished ones.
    """
    register: dict[tuple, int] = {}
    states: list[tuple] = []

    def settle(node: _Node) -> int:
        key = (node.final, tuple((b, target, out) for b, (target, out) in node.edges.items()))
        number = register.get(key)
        if number is None:
            number = register[key] = len(states)
            states.append(key)
        return number

    open_nodes, before = [_Node()], b""
    for word, ids in words:
        if open_nodes[0].edges and word <= before:
            raise ValueError("compile_words: words must be distinct and ascend")
        shared = 0
        while shared < min(len(word), len(before)) and word[shared] == before[shared]:
            shared += 1
        for k in range(len(before), shared, -1):
            open_nodes[k - 1].edges[before[k - 1]][0] = settle(open_nodes.pop())
        rest = ids
        for k in range(shared):
            edge, after = open_nodes[k].edges[word[k]], open_nodes[k + 1]
            same = 0
            while same < min(len(edge[1]), len(rest)) and edge[1][same] == rest[same]:
                same += 1
            late = edge[1][same:]
            if late:
                edge[1] = edge[1][:same]
                for later in after.edges.values():
                    later[1] = late + later[1]
                if after.final is not None:
                    after.final = late + after.final
            rest = rest[same:]
        for k in range(shared, len(word)):
            open_nodes[k].edges[word[k]] = [None, rest if k == shared else ()]
            open_nodes.append(_Node())
        open_nodes[-1].final = () if len(word) > shared else rest
        before = word
    for k in range(len(before), 0, -1):
        open_nodes[k - 1].edges[before[k - 1]][0] = settle(open_nodes.pop())
    root = settle(open_nodes.pop())

    pool: list[int] = []
    places: dict[tuple[int, ...], int] = {}

    def place(out: tuple[int, ...]) -> int:
        if out not in places:
            places[out] = len(pool)
            pool.extend(out)
        return places[out]

    edges = [(number << 8 | b, target, place(out), len(out)) for number, (_, own) in enumerate(states) for b, target, out in own]
    finals = [(place(final), len(final)) if final is not None else (0, -1) for final, _ in states]
    edge = np.array(edges, np.int64).reshape(-1, 4)
    edge = edge[np.argsort(edge[:, 0], kind="stable")]
    final = np.array(finals, np.int64).reshape(-1, 2)
    head = np.array([root, len(edge), len(final), len(pool)], np.int64)
    columns = [head, *edge.T, *final.T, np.array(pool, np.int64)]
    return b"".join(np.ascontiguousarray(c).astype("<i8").tobytes() for c in columns)


class Transducer:
    """A compiled transducer over mapped memory; many words are walked side by side."""

    def __init__(self, memory):
        data = np.frombuffer(memory, "<i8")
        self.root, n_edges, n_states, n_pool = data[:4].tolist()
        sizes = [n_edges] * 4 + [n_states] * 2 + [n_pool]
        cuts = np.cumsum([4, *sizes]).tolist()
        parts = [data[a:b] for a, b in zip(cuts, cuts[1:])]
        self.keys, self.targets, self.outs, self.lengths, self.final_outs, self.final_lengths, self.pool = parts

    def walk(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(accepted, ids, sizes)`` of words (``large_string``): ids one behind the other, and how many each has.

        All words take their k-th step together; one that has no edge to go on is out.
        """
        n = len(words)
        offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + n + 1] if n else np.zeros(1, np.int64)
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
        length = np.diff(offsets)
        state = np.full(n, self.root)
        on = np.flatnonzero(length <= LONGEST_WORD)
        accepted = np.zeros(n, bool)
        written: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def write(who: np.ndarray, outs: np.ndarray, lengths: np.ndarray) -> None:
            some = lengths > 0
            if some.any():
                written.append((who[some], outs[some], lengths[some]))

        for step in range(LONGEST_WORD + 1):
            ended = length[on] == step
            done = on[ended]
            done = done[self.final_lengths[state[done]] >= 0]
            accepted[done] = True
            write(done, self.final_outs[state[done]], self.final_lengths[state[done]])
            on = on[~ended]
            if not len(on) or not len(self.keys):
                break
            key = state[on] << 8 | data[offsets[on] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[at] == key
            on, at = on[found], at[found]
            state[on] = self.targets[at]
            write(on, self.outs[at], self.lengths[at])
        if not written:
            return accepted, np.zeros(0, np.int64), np.zeros(n, np.int64)
        who, outs, lengths = (np.concatenate(c) for c in zip(*written))
        whole = accepted[who]
        order = np.argsort(who[whole], kind="stable")  # a word's outputs were written in the order of its steps
        who, outs, lengths = who[whole][order], outs[whole][order], lengths[whole][order]
        sizes = np.bincount(who, lengths, n).astype(np.int64)
        return accepted, self.pool[_ragged(outs, lengths)], sizes


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs of ``sizes`` that begin at ``starts``, one behind the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - ends + sizes, sizes) + np.arange(total)


# --- words of a corpus ------------------------------------------------------------------------------------


def _cut(texts: list[str]) -> tuple[pa.Array, list[int]]:
    """``(words, number per text)``: every text cut where no token crosses; its first word is marked as glued."""
    even, uneven = [], []
    lines, loose = [], []
    for i, text in enumerate(texts):
        marked = even_words(text) if text else None
        if marked is not None:
            even.append(i)
            lines.append(GLUED + marked)
        else:
            head, rest = words_of(text) if text else ("", [])
            uneven.append((i, 1 + len(rest)))
            loose.append(GLUED + head)
            loose += rest
    lists = pc.split_pattern(pa.array(lines, pa.large_string()), " ")
    order = [*even, *(i for i, _ in uneven)]
    sizes = [*pc.list_value_length(lists).to_pylist(), *(n for _, n in uneven)]
    words = pa.concat_arrays([lists.flatten(), pa.array(loose, pa.large_string())])
    if not uneven:
        return words, sizes
    by_text = np.empty(len(texts), np.int64)
    by_text[order] = sizes
    ends = np.cumsum(sizes)
    starts = np.empty(len(texts), np.int64)
    starts[order] = ends - sizes
    return words.take(pa.array(_ragged(starts, by_text))), by_text.tolist()


def _stretches(text: str, vocabulary: Merges) -> list[str | int]:
    """A text around its special strings, these as ids."""
    if vocabulary.special is None or not vocabulary.special.search(text):
        return [text]
    return [vocabulary.added.get(s, s) if k % 2 else s for k, s in enumerate(vocabulary.special.split(text))]


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= GATHERED:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def word_counts(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``word, n`` over all texts, words of up to LONGEST_WORD bytes, as the encoder cuts them.

    Words are counted per batch, summed per task before they move, then per word: a word that is a third
    of all words moves one row per task. A null text has none.
    """
    session(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = merges(vocabulary)
        for table in _gathered(batches):
            texts = [s for t in table.column("text").to_pylist() for s in _stretches(t, known) if isinstance(s, str)]
            words, _ = _cut(texts)
            counted = words.filter(pc.less_equal(pc.binary_length(words), LONGEST_WORD)).value_counts()
            fields = [counted.field("values").cast(pa.string()), counted.field("counts").cast(pa.int64())]
            yield pa.RecordBatch.from_arrays(fields, names=["word", "n"])

    found = docs.select(F.col(text_col).alias("text")).filter("text IS NOT NULL").mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def compile_lexicon(
    docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY, words: int = LEXICON_WORDS
) -> str:
    """Compile the most frequent words of all texts; returns the name the lexicon has on every worker.

    Compiled are the words in as many places as at most ``words`` words are in, two at least: how often each number
    of places occurs tells that number, so no task ever holds or orders more words. One task
    compiles them, as there is a bound. The bytes go to the shared folder, from which Spark hands every executor,
    also one that replaces a lost one, a file of its own to map. An empty table gives an empty lexicon.
    """
    spark = session(docs.sparkSession)
    counts = kept(word_counts(docs, text_col, vocabulary).filter("n > 1"), "word-counts")
    upto = F.expr("sum(words) OVER (ORDER BY n DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    often = counts.groupBy("n").agg(F.count("*").alias("words")).select("n", upto.alias("upto"))
    least = often.filter(F.col("upto") <= words).agg(F.min("n")).first()[0]
    top = counts.filter(F.col("n") >= F.lit(least)) if least is not None else counts.filter(F.lit(False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted((w.encode(), w) for batch in batches for w in batch.column("word").to_pylist())
        ids, sizes = merges(vocabulary).words([w for _, w in found])
        ends = np.cumsum(sizes).tolist()
        rows = zip(found, ends, sizes.tolist())
        compiled = compile_words((raw, tuple(ids[end - size : end].tolist())) for (raw, _), end, size in rows)
        yield pa.RecordBatch.from_arrays([pa.array([compiled], pa.binary())], names=["compiled"])

    compiled = top.select("word").coalesce(1).mapInArrow(run, "compiled binary").first()
    return _publish(spark, bytes(compiled[0]) if compiled else compile_words([]))


def _publish(spark: SparkSession, data: bytes) -> str:
    """Bytes as a file that every worker finds under the returned name."""
    path = shared_path(spark, "lexicon")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[1]


@lru_cache(maxsize=2)
def transducer(name: str) -> Transducer:
    """The worker's mapped lexicon."""
    with open(SparkFiles.get(name), "rb") as file:
        return Transducer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))


class Encoder:
    """Ids of whole texts: words of the lexicon by walking it, others by merging."""

    def __init__(self, lexicon: Transducer, vocabulary: Merges):
        self.lexicon, self.vocabulary = lexicon, vocabulary

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, number per text)``. The distinct words of all texts are looked up once."""
        pieces = [_stretches(t, self.vocabulary) for t in texts]
        words, sizes = _cut([s if isinstance(s, str) else "" for own in pieces for s in own])
        coded = words.dictionary_encode()
        distinct, places = coded.dictionary, coded.indices.to_numpy()
        accepted, ids, counts = self.lexicon.walk(distinct)
        starts = np.cumsum(counts) - counts
        missing = np.flatnonzero(~accepted)
        merged, numbers = self.vocabulary.words(distinct.take(pa.array(missing)).to_pylist())
        counts[missing] = numbers
        starts[missing] = len(ids) + np.cumsum(numbers) - numbers
        taken = counts[places]
        flat = np.concatenate([ids, merged])[_ragged(starts[places], taken)]
        bounds = np.concatenate([[0], np.cumsum(taken)])[np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])]
        per_piece = np.diff(bounds)
        if len(sizes) == len(texts):
            return flat, per_piece
        out, numbers, at = [], [], 0
        for own in pieces:
            parts = [flat[bounds[at + k] : bounds[at + k + 1]] if isinstance(s, str) else np.array([s]) for k, s in enumerate(own)]
            at += len(own)
            out += parts
            numbers.append(sum(map(len, parts)))
        return np.concatenate(out), np.array(numbers)


@lru_cache(maxsize=2)
def encoder(lexicon: str, vocabulary: str) -> Encoder:
    return Encoder(transducer(lexicon), merges(vocabulary))


def encode(
    docs: DataFrame, lexicon: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY
) -> DataFrame:
    """``doc_id, n_tokens, ids`` per row of ``docs``, by a lexicon that ``compile_lexicon`` made.

    The ids are those of the whole text, whatever words the lexicon holds: it saves merging, and changes nothing.
    Special strings get their own ids. A null text is empty and has no ids, a null id is carried along, repeated
    rows stay, an empty table gives no rows, other columns are ignored. Texts are encoded whole, however long.
    """
    session(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = encoder(lexicon, vocabulary).encode
        for table in _gathered(batches):
            ids, numbers = work(table.column("text").to_pylist())
            ends = pa.array(np.concatenate([[0], np.cumsum(numbers)]), pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(ids.astype(np.int32)))
            for start in range(0, len(numbers), BATCH):
                rows = table.slice(start, BATCH).column("doc_id").combine_chunks()
                part = lists.slice(start, BATCH)
                yield pa.RecordBatch.from_arrays([rows, pc.list_value_length(part).cast(pa.int64()), part], names=["doc_id", "n_tokens", "ids"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids array<int>")


def decoded(ids: Column, vocabulary: str = VOCABULARY) -> Column:
    """The text of token ids, special tokens included; bytes that are no character become the replacement mark. Null gives null."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = merges(vocabulary)
        for batch in batches:
            ids = batch.flatten().to_numpy(zero_copy_only=False)
            if len(ids) and not 0 <= ids.min() <= ids.max() < len(known.lengths):
                raise ValueError("decode: ids beyond the vocabulary")
            taken = known.lengths[ids]
            raw = known.letters[_ragged(known.starts[ids], taken)].tobytes()
            counts = pc.list_value_length(batch).fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(taken)])[np.cumsum(counts)].tolist()
            texts = [raw[start:end].decode("utf-8", "replace") for start, end in zip([0, *ends], ends)]
            yield pa.array(texts, pa.string(), mask=batch.is_null().to_numpy(zero_copy_only=False))

    return run(ids)


def decode(tokens: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``tokens (ids)`` with the text of each row as ``decoded``. Null ids give null, no ids the empty text; unknown ids raise."""
    session(tokens.sparkSession)
    return tokens.withColumn("decoded", decoded(F.col("ids"), vocabulary))

"""Conversation repair, Merkle manifest and lexicon encoding against plain Python or the library itself."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemill.llm import conversation_repair as repair
from tidemill.llm import lexicon, merkle
from tidemill.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


# --- conversation repair ----------------------------------------------------------------------------------


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(name.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def faults_of(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\v\f\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return faults


def cheapest(rows, faults):
    """``(cost, audit, repaired)`` by trying all edits: breadth-first over rows, all insertions of up to two rows between."""
    legal = re.compile(r"(s?(ua)*u?|s)?")
    table = [(0, "", "", ())]  # cost, audit, initials, lines
    inserts = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]

    def grown(options):
        out = {}
        for cost, audit, initials, lines in options:
            for extra in inserts:
                now = initials + "".join(r[0] for r in extra)
                if legal.fullmatch(now):
                    key = now[-1:] + str(now == "s")
                    found = (cost + 2 * len(extra), audit + "I" * len(extra), now, lines + tuple(f"{r}:" for r in extra))
                    if key not in out or found < out[key]:
                        out[key] = found
        return list(out.values())

    for (_, role, text), fault in zip(rows, faults):
        options = []
        for cost, audit, initials, lines in grown(table):
            options.append((cost + 3, audit + "D", initials, lines))
            if fault in ("blank", "duplicate"):
                continue
            extra = fault == "truncated"
            options.append((cost + extra, audit + "K", initials + role[:1] if role[:1] in ("s", "u", "a") else initials + "?", lines + (f"{role}:{text}",)))
            for other in ("user", "assistant"):
                options.append((cost + 2 + extra, audit + "R", initials + other[0], lines + (f"{other}:{text}",)))
        table = [o for o in options if legal.fullmatch(o[2])]
    done = [o for o in grown(table) if re.fullmatch("(s?(ua)+)?", o[2])]
    cost, audit, _, lines = min(done)
    return cost, audit, "\n".join(lines)


def expected(rows):
    out = set()
    for conv, own in damaged(rows).items():
        own = sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults = faults_of(own)
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        cost, audit, text = cheapest(own, faults)
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out.add((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return out


def odd_conversations():
    random.seed(5)
    roles = ["system", "user", "assistant", None, "tool", "", "Assistant", "user", "assistant"]
    texts = ["One.", "Two!", "three", "", None, " \t", "A? ", "x\n", "u\xa0", "é.", "...", "Yes."]
    rows = []
    for conv in [None, *range(60)]:
        for k in range(random.randrange(1, 9)):
            turn = random.choice([k, k, k, 2 * k, None, 3])
            rows.append((conv, turn, random.choice(roles), random.choice(texts)))
    return [*rows, *rows[:20], (777, None, None, None)]


def test_repair_equals_trying_all_edits(spark):
    rows = odd_conversations()
    random.shuffle(rows)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, moves string, copy int")
    found = repair.repair(repair.damage(df)).collect()
    assert len(found) == len({r[0] for r in rows})
    assert {tuple(r) for r in found} == expected(rows)


def test_repair_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {tuple(r) for r in QUERIES["op11_conversation_repair"](spark, SMALL).collect()} == expected(rows)


def test_long_conversation_crosses_batches(spark):
    n = 3_000
    rows = spark.range(n).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), "id", F.lit(".")).alias("text"),
    ).withColumn("gone", F.col("turn").isin(500, 2_000))
    (row,) = repair.repair(rows).collect()
    # From the first gap on the initials are swapped until the second one: a row inserted at each is cheapest.
    assert (row.gaps, row.cost, row.illegal, len(row.audit)) == (2, 4, 2, n) and row.audit.count("I") == 2


def test_dropped_and_missing_conversations(spark):
    schema = "conv_id long, turn long, role string, text string, gone boolean"
    nothing = hashlib.sha256(b"").hexdigest()
    (row,) = repair.repair(spark.createDataFrame([(4, 1, "user", "a.", True)], schema)).collect()
    assert tuple(row) == (4, 0, 0, 0, 0, 0, 0, "", nothing)
    assert repair.repair(spark.createDataFrame([], schema)).collect() == []
    assert repair.damage(spark.createDataFrame([], schema.rsplit(",", 1)[0])).collect() == []


# --- Merkle manifest --------------------------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def plain_tree(leaves):
    """``(root, proofs)``: per leaf its levels of (left, right) siblings from the leaf up."""
    proofs, where, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for k, at in enumerate(where):
            start = at // 8 * 8
            proofs[k].append(("".join(nodes[start:at]), "".join(nodes[at + 1 : start + 8])))
            where[k] = at // 8
        nodes = [sha(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0], proofs


def plain_manifest(rows):
    """Rows ``(doc_id, source, lang, n_chars, text)`` to what the query returns."""
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, plain_leaf(row), row))
    order = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    built = []
    for tree in order:
        own = sorted(trees[tree], key=lambda r: r[:3])
        built.append((own, *plain_tree([r[2] for r in own])))
    root, top = plain_tree([subroot for _, subroot, _ in built])
    out = []
    for (own, subroot, proofs), upper in zip(built, top):
        for (_, _, leaf, row), proof in zip(own, proofs):
            path = [*proof, *upper]
            claimed = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
                lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
                claimed = plain_leaf((*row[:4], lower))
            for left, right in path:
                claimed = sha(left, claimed, right)
            out.append((row[0], leaf, subroot, root, sha(*[a + b for a, b in path]), claimed, claimed == root))
    return sorted(out, key=repr)


DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def merkle_rows(spark, rows):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    df = spark.createDataFrame([(*r, "t", 1) for r in rows], DOCS + ", tree string, rank int").repartition(3)
    return sorted((tuple(r) for r in merkle.verify_tampered(df, tampered, lower).collect()), key=repr)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 200])
def test_manifest_of_one_tree(spark, n):
    rows = [(7 * i % n, "s", "en", i, f"Text {i}") for i in range(n)]
    assert merkle_rows(spark, rows) == plain_manifest(rows)


def test_manifest_of_odd_rows(spark):
    rows = [(i, None if i % 5 else "s", [None, "", "en", "-", "=", "é", "zz"][i % 7], None if i % 3 else i, [None, "", "Ab", "a:B"][i % 4]) for i in range(90)]
    rows += [(None, None, None, None, None)] * 3 + [(5, "s", "en", 1, "Same")] * 40 + [(6, "s", "one", 1, "x" * 50_000)]
    rows += [(100 + i, "s", f"l{i}", 0, "One of many trees") for i in range(30)]
    random.seed(2)
    random.shuffle(rows)
    assert merkle_rows(spark, rows) == plain_manifest(rows)


def test_manifest_of_the_table_and_of_nothing(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    found = sorted((tuple(r) for r in QUERIES["op12_merkle"](spark, SMALL).collect()), key=repr)
    assert found == plain_manifest(rows)
    assert {r[-1] for r in found} == {True, False}
    assert merkle_rows(spark, []) == []


def test_some_leaves_are_asked_for(spark):
    rows = [(i, "s", "en" if i % 4 else "de", 1, f"t{i}") for i in range(150)]
    df = spark.createDataFrame(rows, DOCS)
    manifest = merkle.build(df.select(merkle.tree_name(F.col("lang")).alias("tree"), "doc_id", merkle.leaf_of().alias("leaf")), ["doc_id"])
    asked = spark.createDataFrame([("=en", 3, "a"), ("=en", 3, "b"), ("=en", 111, "c"), ("=de", 0, "d"), ("=de", 38, "gone"), ("=xx", 0, "gone")], "tree string, rank long, mine string")
    found = {r.mine: r for r in merkle.prove(manifest, asked).collect()}
    assert sorted(found) == ["a", "b", "c", "d"]
    want = {r[0]: r for r in plain_manifest(rows)}
    for mine, doc in {"a": 5, "b": 5, "c": 149, "d": 0}.items():
        path = "".join(s.left + s.right for s in found[mine].path)
        assert (found[mine].leaf, found[mine].root, sha(path)) == (want[doc][1], want[doc][3], want[doc][4])
    stored = {r.digest: r.children for r in manifest.records.collect()}
    assert all(sha(*children) == key for key, children in stored.items())


# --- lexicon ----------------------------------------------------------------------------------------------

ODD = [
    None, "", " ", "a", "a  b", " a", "a ", "a\n \nb", "\n b\n\n c ", "x.. y", "&&, a", "\0 \0a b", "3.14, 5", ", a", "A\n",
    "foo<|endoftext|> bar  <|endoftext|>", "<|endoftext|>", "'s don't 've", "x\x85 y  z", "q \x1c r", "日本 語 テスト", "a" * 30_000,
    "word, another. " * 3_000, "x" * 20 + "1" * 20 + "!" * 20, "🙂 é́ ​", "The cat. The cat, the cat", "​ ﻿",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("words", [0, 5, 100_000])
def test_lexicon_changes_no_ids(spark, library, words):
    schema = "doc_id long, text string, n_tokens string, ids string, word string, n string"
    texts = [*ODD, *ODD[-6:]]
    docs = spark.createDataFrame([(i if i != 3 else None, t, "x", "y", "z", "n") for i, t in enumerate(texts)], schema)
    name = lexicon.compile_lexicon(docs, words=words)
    found = {r.doc_id: r for r in lexicon.decode(lexicon.encode(docs, name)).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        row = found[i if i != 3 else None]
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert (row.ids, row.n_tokens) == (ids, len(ids)), text
        assert row.decoded == library.decode(ids, skip_special_tokens=False) == (text or "")


def test_lexicon_over_the_table(spark, library):
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = QUERIES["op13_lexicon_bpe"](spark, SMALL).collect()
    assert len(found) == len(rows)
    for row in found:
        ids = library.encode(rows[row.doc_id], add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_decoding_any_ids(spark, library):
    random.seed(9)
    lists = [random.choices(range(50_257), k=k) for k in (1, 2, 3, 50, 400)] + [[], None, [50_256], [187, 247, 102, 187]]
    df = spark.createDataFrame(list(enumerate(lists)), "i int, ids array<int>")
    for row in lexicon.decode(df).collect():
        own = lists[row.i]
        assert row.decoded == (None if own is None else library.decode(own, skip_special_tokens=False))
    with pytest.raises(Exception, match="beyond the vocabulary"):
        lexicon.decode(spark.createDataFrame([([60_000],)], "ids array<int>")).collect()


def test_word_counts_are_those_of_all_texts(spark):
    docs = spark.createDataFrame([("b a a",), (None,), ("a<|endoftext|> a",), ("",)], "text string")
    found = {r.word: r.n for r in lexicon.word_counts(docs).collect() if r.word != "\0"}
    assert found == {"\0b": 1, "a": 3, "\0a": 1}


def test_transducer_is_minimal_and_exact():
    random.seed(1)
    words = {}
    for _ in range(3_000):
        stem, end = random.choice(["walk", "talk", "sing", "jump", "é", "a"]) + "x" * random.randrange(4), random.choice(["", "ing", "ed", "er", "ers"])
        words[(stem + end).encode()] = tuple(random.Random(stem).choices(range(100), k=2)) + (tuple(random.Random(end).choices(range(9), k=2)) if end else ())
    walked = lexicon.Transducer(lexicon.compile_words(sorted(words.items())))
    asked = [*words, b"", b"wal", b"walkingx", b"zzz", b"w" * 100]
    accepted, ids, sizes = walked.walk(pa.array([w.decode() for w in asked], pa.large_string()))
    ends = sizes.cumsum()
    for k, word in enumerate(asked):
        assert accepted[k] == (word in words)
        assert tuple(ids[ends[k] - sizes[k] : ends[k]]) == words.get(word, ())
    n_trie = len({w[:k] for w in words for k in range(len(w) + 1)})
    assert len(walked.final_lengths) < n_trie / 2
    # No two states have the same edges, outputs and endings.
    rights = {}
    for key, target, out, length in zip(walked.keys, walked.targets, walked.outs, walked.lengths):
        rights.setdefault(int(key) >> 8, []).append((int(key) & 255, int(target), tuple(walked.pool[out : out + length])))
    ends = [tuple(walked.pool[o : o + n]) if n >= 0 else None for o, n in zip(walked.final_outs, walked.final_lengths)]
    states = [(tuple(rights.get(s, ())), ends[s]) for s in range(len(ends))]
    assert len(set(states)) == len(states)
    with pytest.raises(ValueError, match="ascend"):
        lexicon.compile_words([(b"b", (1,)), (b"a", (2,))])


def test_long_matches_merge_like_short_ones():
    known = lexicon.merges()
    random.seed(3)
    short = ["".join(random.choices("abcdethinsxx é", k=random.randrange(1, 33))).encode()[:32] for _ in range(500)] + [b"xxxxxxx", b"a", b""]
    ids, sizes = known.merge_many(short)
    ends = sizes.cumsum()
    for k, match in enumerate(short):
        parts = known.merge([known.characters[b] for b in match])
        assert [known.ids[p] for p in parts] == ids[ends[k] - sizes[k] : ends[k]].tolist(), match


def test_merging_takes_lowest_rank_then_leftmost():
    known = lexicon.merges()
    for text in ("hello", " the", "aaaaaaaa", "abababab", " thethethe"):
        parts = [known.characters[b] for b in text.encode()]
        while True:
            ranked = [(known.ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in known.ranks]
            if not ranked:
                break
            _, i = min(ranked)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        assert known.merge([known.characters[b] for b in text.encode()]) == parts

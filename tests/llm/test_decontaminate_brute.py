"""Decontamination against a plain rewrite that compares every document with every item."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import regex
from test_corpus_operators import FOLDER, given_tables, sentences

from tidemill.llm import decontaminate as d


def plain_tokens(text):
    """``(kind, value)`` per token: 0 word, else a mark of the module."""
    out = (text or "").translate({ord(c): " " for c in d.MARKS + d.SPACES})
    out = regex.sub("  +", " ", out)
    out = regex.sub(r"(?<=\p{N})[.,:/](?=\p{N})", d.PART, out)
    apart, number = r"(?![\p{L}\p{N}])", "|".join(w.capitalize() for w in d.NUMBER_WORDS)
    capital = rf"(?!(?:{number}){apart})\p{{Lu}}[\p{{Ll}}\p{{M}}]+"
    out = regex.sub(rf"(?<=[\p{{L}}\p{{N}},;:'’\"”)]\x20){capital}{apart}", lambda m: d.NAME + m[0], out)
    out = regex.sub(rf"(?<![\p{{L}}\p{{N}}{d.NAME}]){capital}{apart}", lambda m: d.MAYBE + m[0], out).lower()
    spelt = rf"(?<![\p{{L}}\p{{N}}{d.NAME}])(?:{'|'.join(d.NUMBER_WORDS)}){apart}"
    out = regex.sub(rf"\p{{N}}[\p{{N}}{d.PART}]*|{spelt}", lambda m: f" {d.NUMBER}{m[0]} ", out)
    units = "|".join(sorted(d.UNITS, key=len, reverse=True))
    out = regex.sub(rf"({d.NUMBER}[\p{{L}}\p{{N}}{d.PART}]+ [ -]?)[{d.NAME}{d.MAYBE}]?((?:{units})){apart}", lambda m: m[1] + d.UNIT + m[2], out)
    words = [w for w in regex.split(rf"[^\p{{L}}\p{{M}}\p{{N}}{d.NUMBER}-{d.MAYBE}]+", out) if w]
    return [(w[0], w[1:]) if w[0] in d.MARKS else ("", w) for w in words]


def keys_of(window):
    slots = [k for k, _ in window]
    values = ("values", tuple(v for _, v in window))
    template = tuple(k if k in (d.NUMBER, d.UNIT, d.NAME) and k else v for k, v in window)
    nameless = tuple(k if k in (d.NUMBER, d.UNIT) and k else v for k, v in window)
    names = tuple(v if not k else d.NAME if k in (d.NAME, d.MAYBE) else k for k, v in window)
    out = [template if any(k in ("", d.MAYBE) for k in slots) else values]
    if d.NAME in slots:
        out.append(nameless)
    if d.MAYBE in slots:
        out.append(names if "" in slots else values)
    return out


def windows_of(tokens, n=d.WINDOW):
    return [tokens[i : i + n] for i in range(len(tokens) - n + 1)]


def plain_hits(items, docs):
    found = {}
    for item_id, item in items.items():
        own = plain_tokens(item)
        if not own:
            continue
        short = len(own) < d.WINDOW
        n = len(own) if short else d.WINDOW
        places = [(at, w, [("short", tuple(v for _, v in w))] if short else keys_of(w)) for at, w in enumerate(windows_of(own, n))]
        real = [any(k in ("", d.MAYBE) for k, _ in w) for _, w, _ in places]
        if any(real) and not short:
            places = [p for p, r in zip(places, real) if r]
        names = {keys[0] for _, _, keys in places}
        for doc_id, text in docs.items():
            by_key = defaultdict(list)
            for w in windows_of(plain_tokens(text), n):
                for key in [("short", tuple(v for _, v in w))] if short else keys_of(w):
                    by_key[key].append(w)
            met, filled = set(), set()
            for at, w, keys in places:
                for key in keys:
                    for theirs in by_key.get(key, ()):
                        met.add(keys[0])
                        for k, ((kind, value), (_, other)) in enumerate(zip(w, theirs)):
                            if kind:
                                filled.add((at + k, value, other, kind != d.MAYBE))
            if len(met) < d.SIMILARITY * len(names):
                continue
            slots = agree = 0
            for value in {f[1] for f in filled}:
                mine = [f for f in filled if f[1] == value]
                counts = Counter(f[2] for f in mine)
                best = max(counts, key=lambda o: (counts[o], o == value, o))
                if any(f[3] for f in mine) or best != value:
                    n_places = len({f[0] for f in mine})
                    slots += n_places
                    agree += min(counts[best], n_places)
            consistency = agree / slots if slots else 1.0
            if consistency >= d.CONSISTENCY:
                found[doc_id, item_id] = (len(names), len(met), slots, round(consistency, 9))
    return found


def spark_hits(spark, items, docs):
    frames = [spark.createDataFrame(list(x.items()), f"{name} long, text string") for x, name in ((docs, "doc_id"), (items, "item_id"))]
    rows = d.contaminated(*frames).collect()
    assert len(rows) == len({(r.doc_id, r.item_id) for r in rows})
    return {(r.doc_id, r.item_id): (r.n_windows, r.n_found, r.n_slots, round(r.consistency, 9)) for r in rows}


NAMES = "Priya Rahul Ingrid Sven Natalia Weng Omar Zoe".split()


def asked(r, names=None):
    a, b = names or r.sample(NAMES, 2)
    n = [r.randint(2, 900) for _ in range(4)]
    return (
        f"{a} bought {n[0]} kg of rice and {n[1]} apples at the market. {b} gave {a} another {n[2]} apples on the way home. "
        f"How many apples does {a} have after {b} eats {n[3]} of them in the evening?"
    )


def test_planted_items_in_every_form(spark):
    r = random.Random(11)
    items = {1: asked(r), 2: sentences(5, 3), 3: "What is 12 + 34 * 5?", 4: "Digits 3 1 4", 5: None, 6: "", 7: "7 8 9 10 11 12", 8: "only Three words"}
    docs = {i: sentences(100 + i, 4) for i in range(20)}
    docs |= {30 + i: f"{sentences(200 + i, 3)} {asked(r)} {sentences(300 + i, 2)}" for i in range(8)}
    docs |= {50: items[1].lower(), 51: items[1].upper(), 52: items[2].replace(" ", "\n"), 53: sentences(5, 2), 54: "what is 7 + 1 * 9? x", 55: None, 56: ""}
    docs |= {60: "They say: digits 3 1 4, and so on and on.", 61: "digits 3 1 5", 62: "So, ONLY three words", 63: "7 8 9 10 11 12 13", 64: "8 8 9 10 11 12"}
    docs |= {70: asked(r, ["Zoe", "Omar"]).replace("How many apples does Zoe", "How many apples does Sven"), 71: "Alice 5 kg " * 50, 72: "é" * 30_000}
    want = plain_hits(items, docs)
    assert {k for k, _ in want} >= {*range(30, 38), 50, 51, 52, 54, 60, 62, 63} and not {k for k, _ in want} & {*range(20), 55, 56, 61, 64}
    assert spark_hits(spark, items, docs) == want


@given_tables
def test_the_table_with_planted_questions(spark):
    r = random.Random(4)
    docs = {x.doc_id: x.text for x in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    items = {x.item_id: x.text for x in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    some = sorted(docs)[:60] + [k for k in docs if any((docs[k] or "").find(t[:40]) >= 0 for t in items.values())]
    docs = {k: docs[k] for k in some}
    items = {k: items[k] for k in sorted(items)[:40]} | {-1: asked(r)}
    for k in sorted(docs)[:10]:
        docs[k] = f"{docs[k]} {asked(r)}"
    assert spark_hits(spark, items, docs) == plain_hits(items, docs)


@given_tables
def test_a_document_that_lists_the_whole_benchmark(spark):
    items = {x.item_id: x.text for x in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    docs = {1: "\n".join(items.values()), 2: sentences(1, 200)}
    assert {k for k in spark_hits(spark, items, docs)} == {(1, i) for i in items}


@given_tables
def test_windows_are_compiled(spark):
    """No stage falls back to interpretation because its code has outgrown a class."""
    docs, items = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "benchmark"))
    before = spark.conf.get("spark.sql.codegen.fallback")
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        assert d.contaminated(docs, items).count() > 0
    finally:
        spark.conf.set("spark.sql.codegen.fallback", before)

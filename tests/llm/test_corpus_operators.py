"""Operators over many documents against brute force, with nulls, ties, repeats, clashes and empty tables."""

from __future__ import annotations

import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from compare import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from tidemill.llm import classifier, components, decontaminate, quality_rules, shards, simhash
from tidemill.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
given_tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables are absent")


def sentences(seed, n=30):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(400)]
    return "\n".join(" ".join(r.choice(words) for _ in range(8)) + "." for _ in range(n))


# --- components ---


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    edges = {
        "chain": [(i, i + 1) for i in range(200)],
        "star": [(0, i) for i in range(1, 200)],
        "random": [(random.Random(i).randint(0, 150), random.Random(-i).randint(0, 150)) for i in range(1, 100)],
        "none": [],
    }[shape]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for u, v in edges:
        if u != v:
            a, b = find(u), find(v)
            root[max(a, b)] = min(a, b)
    found = components.connected_components(spark.createDataFrame([*edges, (None, 1), (5, 5)], "u long, v long"))
    assert {r.node: r.root for r in found.collect()} == {x: find(x) for x in root}


# --- near duplicates ---


def near_fingerprints():
    r = np.random.default_rng(3)
    centres = r.integers(0, 1 << 63, 25, dtype=np.uint64)
    out = set(r.integers(0, 1 << 63, 200, dtype=np.uint64).tolist())
    for c in centres.tolist():
        for _ in range(12):
            v = c
            for b in r.integers(0, 64, r.integers(0, 4)):
                v ^= 1 << int(b)
            out.add(v)
    return np.array(sorted(out), np.uint64)


@pytest.mark.parametrize("paired_at", [1, 3, 4096])
@pytest.mark.parametrize("distance", [1, 2, 3])
def test_all_near_fingerprints_are_connected(spark, monkeypatch, paired_at, distance):
    values = near_fingerprints()
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= distance
    label = np.arange(len(values))
    for _ in range(len(values)):
        new = np.where(near, label[None, :], len(values)).min(axis=1)
        if (new == label).all():
            break
        label = new
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    for parts in (2, 3, 4):
        monkeypatch.setattr(simhash, "partition_count", lambda n, d, parts=parts: parts)
        edges = [(r.u, r.v) for r in simhash.near_links(df, distance, paired_at).distinct().collect()]
        place = {int(v): i for i, v in enumerate(values.view(np.int64))}
        assert all(near[place[u], place[v]] for u, v in edges)  # no false link
        got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges or [(None, None)], "u long, v long")).collect()}
        groups, want = {}, {}
        for v, i in place.items():
            groups.setdefault(got.get(v, v), set()).add(v)
            want.setdefault(int(label[i]), set()).add(v)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
        if paired_at != 3:
            break


def test_simhash_edges(spark):
    base = sentences(1)
    rows = [(5, base, "fp", None, 1), (2, base, "fp", None, 1), (2, base, "fp", None, 1), (None, base, None, None, None), (7, None, "", "", 0),
            (9, "", "", "", 0), (None, "two words", "", "", 0), (11, "TWO  words", "", "", 0), (3, sentences(2), "", "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, root string, fp string, component_id long")
    found = simhash.near_duplicates(docs)
    by_id = Counter((r.doc_id, r.component_id) for r in found.collect())
    assert by_id == Counter({(5, 2): 1, (2, 2): 2, (None, 2): 1, (7, 7): 1, (9, 7): 1, (None, 11): 1, (11, 11): 1, (3, 3): 1})
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 7, 11]
    assert simhash.keep_one(docs.limit(0)).count() == 0
    assert simhash.fingerprint_of(base) == int(found.where("doc_id = 5").first().fp) % (1 << 64)


def test_keep_one_with_maps_and_text_ids(spark):
    rows = [("b", sentences(1), {"x": 1}), ("a", sentences(1), {"x": 2}), ("a", sentences(1), {"x": 3}), (None, sentences(1), None), ("c", sentences(2), None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, more map<string,int>")
    kept = simhash.keep_one(docs)
    assert kept.schema == docs.schema and sorted(r.doc_id for r in kept.collect()) == ["a", "c"]
    assert simhash.keep_one(docs.limit(0)).collect() == []


def test_fingerprints_by_hand(spark):
    import xxhash

    texts = [None, "", " \t", "One", "one TWO", "A b c", "a B c D", "é È x y z É", sentences(3), "spam " * 500, "x\u00a0y z\u2003w v"]
    found = {r.i: r.fp for r in spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", simhash.fingerprint(F.col("t")).alias("fp")).collect()}
    for i, text in enumerate(texts):
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        value = 0
        for bit in range(64):
            ones = sum(xxhash.xxh64(s.encode(), seed=42).intdigest() >> bit & 1 for s in shingles)
            value |= (2 * ones > len(shingles)) << bit
        assert found[i] % (1 << 64) == value


# --- shards ---


def test_shards(spark):
    texts = [sentences(i % 70, 1 + i % 9) for i in range(300)] + [None, "", "big " * 20_000] + ["hot"] * 400
    docs = spark.createDataFrame([(None if i == 4 else i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, size string, shard string")
    for n in (1, 3, 8):
        rows = shards.assign_shards(docs, n).collect()
        assert len(rows) == len(texts) and {r.shard for r in rows} <= set(range(n))
        for s in range(n):
            own = sorted(r.slot for r in rows if r.shard == s)
            assert own == list(range(len(own)))
        place = {}
        for r in rows:
            if r.doc_id is not None:
                assert r.size == len((texts[r.doc_id] or "").encode()) + 16
                assert place.setdefault(texts[r.doc_id] or "", r.shard) == r.shard
    assert shards.assign_shards(docs.limit(0), 4).count() == 0


def least_capacity(sizes, shards_left):
    low, high = max([0, *sizes]), sum(sizes)
    while low < high:
        middle, used, filled = (low + high) // 2, 1, 0
        for s in sizes:
            used, filled = (used, filled + s) if filled + s <= middle else (used + 1, s)
        low, high = (low, middle) if used <= shards_left else (middle + 1, high)
    return low


def test_capacity_is_the_smallest(spark):
    r = random.Random(4)
    for n in (1, 5, 40):
        sizes = [r.randint(1, 500) for _ in range(300)]
        frame = spark.createDataFrame([(i, s, 1) for i, s in enumerate(sizes)], "bucket int, size long, n long")
        totals = Counter()
        last = -1
        for row in shards.plan(frame, n).orderBy("pos").collect():
            assert row.shard in (last, last + 1)
            last = row.shard
            totals[row.shard] += sizes[row.bucket]
        assert max(totals.values()) <= least_capacity(sizes, n) and len(totals) <= n


# --- quality rules ---


def test_rules_edges(spark):
    common = "The same footer line stands on every page"
    rows = [(i, sentences(i, 12) + "\n" + common, "en", "host", 1) for i in range(40)]
    rows += [(100, "\n".join([common] * 20), "en", "host", 1), (101, common + "\n" + sentences(200, 8), "en", "other", 1)]
    rows += [(200, None, None, None, None), (201, "", "en", None, 0), (None, sentences(5, 9), None, None, 0), (203, "a b c " * 60, "en", "host", 0)]
    rows += [(300 + i, sentences(77, 12), "en", "host", 1) for i in range(60)] + [(1, *rows[1][1:])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, source string, n_words long")
    found = {r.doc_id: r for r in quality_rules.quality_rules(docs).collect()}
    assert quality_rules.quality_rules(docs).count() == len(rows)
    assert all(found[i].kept and found[i].n_lost_words == 8 for i in range(40))
    assert not found[100].kept and found[101].n_lost_words == 0 and not found[200].kept and found[None].kept
    assert found[203].base_failed and found[203].n_repeat_words == 180
    assert all(found[300 + i].kept and found[300 + i].n_lost_words == 0 for i in range(60))  # copies are one document
    good = quality_rules.keep_good(docs, length_col="n_words").collect()
    assert len(good) == sum(found[r[0]].kept for r in rows)
    assert all(common not in r.text and r.n_words == len(r.text) for r in good if r.doc_id is not None and r.doc_id < 40)
    assert quality_rules.quality_rules(docs.limit(0)).count() == 0 and quality_rules.keep_good(docs.limit(0)).count() == 0


def test_line_limits_do_not_rise_with_the_host(spark):
    def page(i, more):
        return (i, sentences(10_000 + i, 6).rstrip("\n") + "\n" + more, "en", "big", 1)

    shared, rare = "All rights are reserved by the owners of this page", "This line stands in five pages and no more"
    long_line = " ".join(f"word{i}" for i in range(60))
    rows = [page(i, shared if i < 6 else rare if i < 11 else long_line if i < 14 else f"own line {'x' * i}") for i in range(600)]
    near = sentences(5, 12)
    rows += [(1000 + i, near.replace(near.split("\n")[i % 12], f"edited {'y' * i}"), "en", "big", 1) for i in range(60)]
    short = [(2000 + i, f"{'z' * i} {sentences(20_000 + i, 5)}\n{shared}\n{shared} 2", "en", "big", 1) for i in range(8)]
    docs = spark.createDataFrame(rows + short, DOCS)
    own = quality_rules._keyed(docs, "doc_id", "text", "source")
    found = {r.h for r in quality_rules.boilerplate_lines(quality_rules.line_hits(own, quality_rules.frequent_lines(own))).collect()}
    hashed = {name: spark.range(1).select(F.xxhash64(F.lit(quality_rules_normal(line)))).first()[0] for name, line in (("shared", shared), ("rare", rare), ("long", long_line))}
    assert hashed["shared"] in found and hashed["long"] in found and hashed["rare"] not in found
    judged = {r.doc_id: r for r in quality_rules.quality_rules(docs).collect()}
    assert all(judged[1000 + i].kept and judged[1000 + i].n_lost_words == 0 for i in range(60))  # near copies keep their lines
    # 41 words of their own and two boilerplate lines: enough words at first, too few afterwards.
    assert all(not judged[2000 + i].kept and not judged[2000 + i].base_failed for i in range(1, 8))


def quality_rules_normal(line):
    return re.sub(r"\s+", " ", re.sub("[0-9]", "0", line.lower())).strip()


def repeated_words(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    counts = Counter(windows)
    return len({p for i, x in enumerate(windows) if counts[x] > 1 for p in (i, i + 1, i + 2)})


def test_repeat_words(spark):
    r = random.Random(8)
    texts = [" ".join(r.choice("abcd") for _ in range(n)) for n in range(40)] + ["a " * 30_000, "a b c a b c", "x\t y\x0bz"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for row in quality_rules.text_rules(df, F.col("t")).collect():
        assert row.n_repeat_words == repeated_words(texts[row.i])


# --- decontamination ---

ITEM = "Alice has 3 apples and Tom gives her 4 kg more pears. How many apples does Alice have in her big red basket now?"


def test_decontamination(spark):
    items = spark.createDataFrame([(1, ITEM, "x"), (2, None, "x"), (None, ITEM, "x"), (3, "only three words", "x"), (1, ITEM, "x")], "item_id long, text string, key string")
    asked_again = "Bob has 17 apples and Sarah gives her 9 kg more pears. How many apples does Bob have in her big red basket now?"
    mixed = "Bob has 17 apples and Sarah gives her 9 kg more pears. How many apples does Paul have in her big red basket now?"
    other = "Alice has 3 apples. Nothing else here is taken from any question that anybody has ever asked about baskets."
    rows = [(10, f"Intro here. {ITEM} Bye."), (11, f"{sentences(3)} {asked_again} {sentences(4)}"), (12, ITEM.upper().lower()), (13, other),
            (14, None), (15, ""), (16, sentences(9)), (None, ITEM), (10, f"Intro here. {ITEM} Bye."), (17, "Only THREE words!"), (18, mixed),
            (19, ITEM.replace(" ", "\n"))]
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, item_id long, key string")
    found = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs, items).collect()}
    assert {k[0] for k in found} >= {10, 11, None, 17} and not {k[0] for k in found} & {13, 14, 15, 16}
    assert found[10, 1].n_changed == 0 and found[11, 1].n_changed >= 4 and found[11, 1].consistency == 1
    assert found[18, 1].consistency < 1
    clean = decontaminate.drop_contaminated(docs, items)
    assert clean.columns == docs.columns and {13, 14, 15, 16} <= {r.doc_id for r in clean.collect()}
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0
    assert decontaminate.drop_contaminated(docs, items.limit(0)).count() == len(rows)


def hits(spark, items, docs):
    """``{(doc, item): row}`` of texts numbered in order."""
    items, docs = ([(i, t) for i, t in enumerate(x)] for x in (items, docs))
    found = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    return {(r.doc_id, r.item_id): r for r in found.collect()}


def test_items_dense_in_numbers_are_found_with_other_values(spark):
    items = [
        "A train travels 60 miles in 2 hours and then 90 miles in 3 hours. What is its average speed in miles per hour?",
        "What is 12 + 34 * 5?",
        "3 1 4 1 5 9 2 6",
    ]
    docs = [
        "A train travels 80 miles in 4 hours and then 70 miles in 5 hours. What is its average speed in miles per hour?",
        "They ask: what is 71 + 8 * 9? Nobody knows.",
        "1 2 3 4 5 6 7 8 9 10 11 12 13",
        "Digits: 3 1 4 1 5 9 2 6.",
        "60 miles in 2 hours and then 90 miles in 3 hours were sailed.",
        f"{sentences(5)} 90 miles in 3 hours, 45 miles in 6 hours. {items[0]}",
    ]
    found = hits(spark, items, docs)
    assert set(found) == {(0, 0), (1, 1), (3, 2), (5, 0)}
    assert found[0, 0].similarity == found[0, 0].consistency == 1 and found[0, 0].n_changed == 4
    assert found[3, 2].n_changed == found[5, 0].n_changed == 0


def test_items_are_found_in_any_case_and_line_breaks(spark):
    item = "On Monday Priya bought 4 Pounds of rice and Rahul sold Two Dozen eggs to Priya. How much did Priya and Rahul have in all?"
    other = item.replace("Priya", "Ingrid").replace("Rahul", "Sven").replace("4", "11").replace(" ", "\n")
    docs = [ITEM.upper().lower(), ITEM.replace(" ", "\n"), ITEM.upper(), item.lower(), item.upper(), other, item.lower().replace("4", "37"),
            item.replace(" ", "\u00a0 \r\n\t"), "Alice and Tom", item.lower().replace("priya bought", "nobody ate").replace("eggs to", "hens of")]
    found = hits(spark, [ITEM, item], docs)
    assert set(found) >= {(0, 0), (1, 0), (2, 0), (3, 1), (4, 1), (5, 1), (6, 1), (7, 1)} and not any(d in (8, 9) for d, _ in found)
    assert all(found[k].similarity == 1 and found[k].consistency == 1 for k in found)
    assert all(found[k].n_changed == 0 for k in ((0, 0), (1, 0), (2, 0), (3, 1), (4, 1), (7, 1)))
    assert found[6, 1].n_changed == 1 and found[5, 1].n_changed == 6


def test_sentences_that_begin_with_any_name(spark):
    item = "Natalia sold 48 clips in April. Zuleika sold half as many in May. Natalia gave a third to her aunt. Zuleika kept hers. How many are left?"
    unlisted = item.replace("Natalia", "Oksana").replace("Zuleika", "Bertil")
    priya = item.replace("Natalia", "Priya").replace("Zuleika", "Ingrid").replace("48", "50")
    mixed = "Alva sold 48 clips in April. Bo sold half as many in May. Cleo gave a third to her aunt. Dag kept hers. How many are left?"
    led = f"He writes, {unlisted}"
    found = hits(spark, [item, unlisted], [priya, unlisted, mixed, led, f"{sentences(8)} Priya sold nothing in April. Ingrid kept hers."])
    assert set(found) >= {(d, i) for d in (0, 1, 3) for i in (0, 1)} and not any(d == 4 for d, _ in found)
    assert found[0, 0].similarity == found[0, 0].consistency == 1 and found[0, 0].n_changed == 5
    assert found[1, 1].n_changed == found[3, 1].n_changed == 0 and found[1, 1].consistency == 1
    assert (2, 1) not in found or found[2, 1].consistency < 1


def test_broadcast_and_shuffled_lookup_agree(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "benchmark"))
    one = sorted(map(tuple, decontaminate.contaminated(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 1)
    assert one and sorted(map(tuple, decontaminate.contaminated(docs, items).collect())) == one


# --- classifier ---


def test_classifier(spark):
    good = [(i, sentences(i, 3 + i % 9), None, "s", 0) for i in range(400)]
    bad = [(1000 + i, ("### *** " + sentences(i, 4).upper() + " !!!") if i % 2 else "spam " * 80, None, "s", 0) for i in range(400)]
    docs = spark.createDataFrame([*good, *bad, (5000, None, None, None, None), (None, "", None, None, None)], DOCS.replace("lang", "score"))
    labels = spark.createDataFrame([(r[0], int(r[0] < 1000)) for r in good + bad] + [(None, 1), (3, None), (5, 1)], "doc_id long, quality int")
    model = classifier.fit(docs, labels, ~classifier.held_out(F.col("doc_id")))
    rows = classifier.classify(docs, model).collect()
    assert len(rows) == 802 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 100 and np.mean([r.predicted == int(r.doc_id < 1000) for r in held]) > 0.97
    assert classifier.keep_good(docs, model).columns == docs.columns
    empty = classifier.fit(docs, labels.limit(0), F.lit(True))
    assert {r.score for r in classifier.classify(docs, empty).collect()} == {0.5}
    assert classifier.classify(docs.limit(0), model).count() == 0


def test_fit_solves_the_ridge_and_the_curve_directly(spark):
    texts = [sentences(i, 2 + i % 7) if i % 2 else "SPAM " * (5 + i % 11) + sentences(i, 1) for i in range(300)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, quality int")
    model = classifier.fit(docs, labels, F.lit(True), features=64)
    rows = classifier.labelled(docs, labels, F.lit(True), classifier.FIT_ROWS, "doc_id", "text", "quality").collect()
    assert len(rows) == 300
    x = np.array([np.frombuffer(r.x, "<f8") for r in rows])
    y, back = np.array([r.y for r in rows]), np.array([r.calibrates for r in rows])
    assert sorted(map(tuple, x)) == sorted(tuple(classifier.statistics(t)) for t in texts)
    np.testing.assert_allclose(model.mean, x.mean(0))
    np.testing.assert_allclose(model.scale[x.std(0) > 1e-6], x.std(0)[x.std(0) > 1e-6], rtol=1e-6)
    # The ridge as least squares over rows and, below them, the penalty's own rows.
    z = model.lift(x[~back])
    penalty = np.sqrt(np.append(np.full(64, classifier.RIDGE * (~back).sum()), 1e-9))
    direct = np.linalg.lstsq(np.vstack([z, np.diag(penalty)]), np.concatenate([y[~back], np.zeros(65)]), rcond=None)[0]
    np.testing.assert_allclose(z @ model.weights, z @ direct, atol=1e-6)
    # The curve over bins of the raw scores held back, by the formula of the best non-decreasing fit.
    raw = np.clip(model.raw(x[back]), -0.5, 1.5)
    place = np.minimum(((raw + 0.5) / 2 * classifier.BINS).astype(int), classifier.BINS - 1)
    bins = sorted(set(place))
    n, p = (np.array([w[place == b].sum() for b in bins]) for w in (np.ones(len(raw)), y[back]))
    mean = lambda a, b: p[a : b + 1].sum() / n[a : b + 1].sum()
    best = [max(min(mean(a, b) for b in range(i, len(bins))) for a in range(i + 1)) for i in range(len(bins))]
    middles = np.array([raw[place == b].mean() for b in bins])
    blocks = sorted(set(np.round(best, 12)))
    np.testing.assert_allclose(model.values, blocks, atol=1e-9)
    centres = [np.average(middles[np.isclose(best, v)], weights=n[np.isclose(best, v)]) for v in blocks]
    np.testing.assert_allclose(model.knots, centres, atol=1e-9)


def test_features_approximate_a_gaussian_kernel():
    r = np.random.default_rng(5)
    width = classifier.WIDTH
    model = classifier.Model(np.zeros(19), np.ones(19), r.normal(size=(19, 50_000)) / width, r.uniform(0, 2 * np.pi, 50_000), *[np.zeros(1)] * 3)
    x = r.normal(size=(12, 19))
    z = model.lift(x)[:, :-1]
    exact = np.exp(-((x[:, None] - x[None, :]) ** 2).sum(-1) / (2 * width**2))
    assert np.abs(z @ z.T - exact).max() < 0.03


def test_isotonic_never_falls():
    r = np.random.default_rng(2)
    n = r.integers(1, 9, 50).astype(float)
    _, values = classifier.isotonic(np.arange(50.0), np.round(n * r.random(50)), n)
    assert (np.diff(values) >= 0).all()


# --- the registered queries ---


@given_tables
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered_query(spark, name):
    assert compare(spark, connect(FOLDER), FOLDER, name, QUERIES[name], ORACLES.get(name)) == ""


@given_tables
def test_native_queries_run_no_python(spark):
    for name in ("op1_decontaminate", "op3_shards", "op6_quality_rules"):
        plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"):
            assert word not in plan, f"{name}: {word}"


@given_tables
def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.kept(stage(spark, docs, FOLDER), "test")
        now = [r.doc_id for r in docs.collect()]
        assert docs.columns == columns and len(now) == len(set(now)) and set(now) <= ids, name
        ids = set(now)
    assert {r.doc_id for r in corpus_pipeline.run(spark, FOLDER).collect()} == ids
    assert simhash.near_duplicates(docs).groupBy("root").count().where("count > 1").count() == 0
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    assert decontaminate.contaminated(docs, items).count() == 0

"""SimHash fingerprints and near-duplicate groups by the generalised pigeonhole principle."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import kept, session
from .components import connected_components

BITS = 64
#: Cost of one probe (a row that is shuffled) against that of one candidate pair (an XOR in the join).
PROBE_COST = 20.0
#: Bits of the pieces whose counted values estimate how many candidates a threshold lets through.
PIECE_BITS = 8
#: Fingerprints under one probe key beyond which pairs are linked through midpoints instead.
PAIRED_AT = 4096
#: Shingles whose bits are counted at once: bounds a worker's memory for a very long text.
COUNTED_AT_ONCE = 65_536


def fingerprint_of(text: str | None, words: int = 3) -> int:
    """SimHash of the ``words``-word shingles of ``text``, unsigned.

    A-Z are lower-cased; words are runs without ASCII white space; repeated shingles count as
    often as they occur; a text with fewer words is one shingle, one without words has
    fingerprint zero. A bit is set if it is set in more than half of the XXH64 values (seed 42).
    """
    import xxhash

    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    if len(parts) < words:
        shingles = [b" ".join(parts)]
    else:
        shingles = list(map(b" ".join, zip(*(parts[i:] for i in range(words)))))
    digest, total = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for start in range(0, len(shingles), COUNTED_AT_ONCE):
        hashes = np.array([digest(s, 42) for s in shingles[start : start + COUNTED_AT_ONCE]], ">u8")
        total += np.unpackbits(hashes.view(np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(shingles)).view(">u8")[0])


def fingerprint(text: Column, words: int = 3) -> Column:
    """``fingerprint_of`` as a column; the 64 bits are held in a long."""

    @F.pandas_udf(T.LongType())
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            values = np.array([fingerprint_of(t, words) for t in batch], np.uint64)
            yield pd.Series(values.view(np.int64))

    return run(text)


# --- planning: which bits belong together, which part may differ by how much ---------------------


def partition_count(n: int, distance: int) -> int:
    """Partitions that cost least for ``n`` fingerprints, were their bits independent.

    More partitions need fewer probes but let through more candidates; either way all links
    are found.
    """

    def cost(m: int) -> float:
        width, units = BITS / m, [(distance + 1) // m + (i < (distance + 1) % m) for i in range(m)]
        probes = sum(comb(round(width), k) for u in units for k in range(u))
        return probes * (PROBE_COST + n / 2**width)

    return min(range(2, max(2, distance + 1) + 1), key=cost)


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of rows, and how often each pair of bits is set together (64 x 64)."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, total = 0, np.zeros((BITS, BITS))
        for batch in batches:
            bits = _bits(batch["fp"].to_numpy())
            n, total = n + len(bits), total + bits.T @ bits
        yield pd.DataFrame({"cell": np.arange(BITS * BITS + 1), "n": [n, *total.ravel().astype(np.int64)]})

    rows = fps.mapInPandas(partial, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(BITS * BITS + 1, np.int64)
    for row in rows:
        flat[row["cell"]] = row["n"]
    return int(flat[0]), flat[1:].reshape(BITS, BITS)


def _bits(fps: np.ndarray) -> np.ndarray:
    """One float column per bit; column k is bit k counted from the lowest."""
    raw = np.ascontiguousarray(fps).view(np.uint64).astype("<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(raw, axis=1, bitorder="little").astype(np.float32)


def group_bits(n: int, together: np.ndarray, m: int) -> list[list[int]]:
    """``m`` groups of bits, as equal as can be; each starts with the most correlated free pair.

    Correlated bits repeat each other, so one group that holds them all leaves the other groups
    with independent bits, whose values spread evenly.
    """
    if n == 0:
        return [list(range(BITS))[i::m] for i in range(m)]
    mean = together.diagonal() / n
    covariance = together / n - np.outer(mean, mean)
    spread = np.sqrt(np.maximum(covariance.diagonal(), 1e-12))
    strength = np.abs(covariance / np.outer(spread, spread))
    np.fill_diagonal(strength, 0)
    free, groups = list(range(BITS)), []
    for i in range(m):
        size = len(free) // (m - i)
        a, b = max(combinations(free, 2), key=lambda p: strength[p]) if len(free) > 1 else (free[0], free[0])
        group = list(dict.fromkeys([a, b]))[:size]
        while len(group) < size:
            rest = [k for k in free if k not in group]
            group.append(max(rest, key=lambda k: strength[k, group].sum()))
        groups.append(sorted(group))
        free = [k for k in free if k not in group]
    return groups


def _pieces(groups: list[list[int]]) -> list[tuple[int, list[int]]]:
    """Pieces of at most PIECE_BITS bits, each with the number of its group."""
    return [(g, bits[i : i + PIECE_BITS]) for g, bits in enumerate(groups) for i in range(0, len(bits), PIECE_BITS)]


def _values(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    whole, out = fps.view(np.uint64), np.zeros(len(fps), np.int64)
    for k, bit in enumerate(bits):
        out |= (((whole >> np.uint64(bit)) & np.uint64(1)) << np.uint64(k)).astype(np.int64)
    return out


def distance_tables(fps: DataFrame, groups: list[list[int]], n: int) -> list[np.ndarray]:
    """Per piece: for each value, the share of fingerprints at distance 0, 1, ... from it."""
    pieces = _pieces(groups)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = [np.zeros(2 ** len(bits), np.int64) for _, bits in pieces]
        for batch in batches:
            values = batch["fp"].to_numpy()
            for total, (_, bits) in zip(counts, pieces):
                total += np.bincount(_values(values, bits), minlength=len(total))
        yield pd.DataFrame(
            {
                "piece": np.repeat(np.arange(len(pieces)), [len(c) for c in counts]),
                "value": np.concatenate([np.arange(len(c)) for c in counts]),
                "n": np.concatenate(counts),
            }
        ).query("n > 0")

    counted = fps.mapInPandas(partial, "piece int, value int, n long").groupBy("piece", "value").agg(F.sum("n").alias("n"))
    shares = [np.zeros(2 ** len(bits)) for _, bits in pieces]
    for row in counted.collect():  # at most 64 / PIECE_BITS + parts pieces of 2 ** PIECE_BITS values
        shares[row["piece"]][row["value"]] = row["n"] / max(n, 1)
    tables = []
    for share in shares:
        values = np.arange(len(share))
        apart = np.bitwise_count(values[:, None] ^ values[None, :])
        tables.append(np.stack([(share[None, :] * (apart == d)).sum(axis=1) for d in range(int(apart.max()) + 1)], axis=1))
    return tables


def allocate(fps: np.ndarray, groups: list[list[int]], tables: list[np.ndarray], n: int, distance: int) -> np.ndarray:
    """Per fingerprint, the units of each group: threshold + 1, where 0 leaves the group out.

    The units add up to ``distance + 1``; by the generalised pigeonhole principle two fingerprints
    within ``distance`` then agree on some group up to its threshold. Which groups get how many is
    chosen by dynamic programming over estimated probes and candidates.
    """
    units, pieces = distance + 1, _pieces(groups)
    most = units - 1 if len(groups) > 1 else units
    costs = []
    for g, bits in enumerate(groups):
        spread = np.zeros((len(fps), units))
        spread[:, 0] = 1
        for (owner, piece), table in zip(pieces, tables):
            if owner == g:
                near, mixed = table[_values(fps, piece)], np.zeros_like(spread)
                for d in range(min(near.shape[1], units)):
                    mixed[:, d:] += near[:, d : d + 1] * spread[:, : units - d]
                spread = mixed
        probes = np.cumsum([comb(len(bits), k) for k in range(units)])
        cost = np.zeros((len(fps), units + 1))
        cost[:, 1:] = PROBE_COST * probes + n * np.cumsum(spread, axis=1)
        cost[:, most + 1 :] = np.inf
        costs.append(cost)
    best = np.full((len(fps), units + 1), np.inf)
    best[:, 0] = 0
    choices = []
    for cost in costs:
        options = np.full((len(fps), units + 1, units + 1), np.inf)  # [row, units so far, units here]
        for total in range(units + 1):
            for here in range(total + 1):
                options[:, total, here] = best[:, total - here] + cost[:, here]
        choices.append(options.argmin(axis=2))
        best = options.min(axis=2)
    taken, left = np.zeros((len(fps), len(groups)), np.int64), np.full(len(fps), units)
    for g in range(len(groups) - 1, -1, -1):
        taken[:, g] = choices[g][np.arange(len(fps)), left]
        left -= taken[:, g]
    return taken


@lru_cache(maxsize=64)
def flips(bits: tuple[int, ...], most: int) -> np.ndarray:
    """All masks that flip at most ``most`` of ``bits``, fewest first."""
    return np.array([sum(1 << b for b in c) for k in range(most + 1) for c in combinations(bits, k)], np.uint64)


def _mask(bits: list[int]) -> np.uint64:
    return np.uint64(sum(1 << b for b in bits))


# --- links -----------------------------------------------------------------------------------------


def near_links(fps: DataFrame, distance: int = 3, paired_at: int = PAIRED_AT) -> DataFrame:
    """Edges ``(u, v)`` between distinct fingerprints ``fps (fp)``.

    Every edge joins two fingerprints at most ``distance`` bits apart, and any two such
    fingerprints are connected by edges. Under keys with up to ``paired_at`` fingerprints all
    pairs are compared. Under larger ones the number of pairs would be quadratic; there each
    fingerprint is joined to a midpoint instead: two at most r bits apart meet in a value
    that is at most r - 1 from one and at most 1 from the other, and all that meet in a value are
    linked through one of them. That is a fixed number of rows per fingerprint, and as exact.
    """
    n, together = bit_counts(fps)
    groups = group_bits(n, together, partition_count(n, distance))
    tables = distance_tables(fps, groups, n)
    masks = [_mask(g) for g in groups]
    signed = [int(m.view(np.int64)) for m in masks]

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch["fp"].to_numpy()
            units = allocate(values, groups, tables, n, distance)
            out = []
            for g, bits in enumerate(groups):
                for u in range(1, units.max(initial=0) + 1):
                    own = values[units[:, g] == u].view(np.uint64)
                    if len(own):
                        turned = flips(tuple(bits), u - 1)
                        keys = ((own & masks[g])[:, None] ^ turned[None, :]).ravel()
                        out.append(
                            pd.DataFrame(
                                {
                                    "part": np.int32(g),
                                    "key": keys.view(np.int64),
                                    "u": np.repeat(own.view(np.int64), len(turned)),
                                    "off": np.tile(np.bitwise_count(turned).astype(np.int32), len(own)),
                                }
                            )
                        )
            if out:
                yield pd.concat(out)

    probes = fps.mapInPandas(probe, "part int, key long, u long, off int")
    data = fps.select(
        F.inline(F.array(*[F.struct(F.lit(g).alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for g, m in enumerate(signed)])),
        F.col("fp").alias("v"),
    )
    large = kept(data.groupBy("part", "key").count().where(F.col("count") > paired_at).select("part", "key"), "large-keys")
    any_large = bool(large.take(1))
    paired, listed = (probes, data) if not any_large else (
        probes.join(large, ["part", "key"], "left_anti"),
        data.join(large, ["part", "key"], "left_anti"),
    )
    apart = F.bit_count(F.col("u").bitwiseXOR(F.col("v")))
    edges = paired.join(listed, ["part", "key"]).where((F.col("u") < F.col("v")) & (apart <= distance)).select("u", "v")
    if any_large:
        edges = edges.union(_through_midpoints(probes, data, large, groups, masks, distance))
    return edges


def _through_midpoints(probes, data, large, groups, masks, distance) -> DataFrame:
    rest = [tuple(b for b in range(BITS) if b not in set(g)) for g in groups]

    def midpoints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (part, reach), rows in batch.groupby(["part", "reach"]):
                turned = flips(rest[part], int(reach))
                step = max(1, 500_000 // len(turned))
                for start in range(0, len(rows), step):
                    some = rows.iloc[start : start + step]
                    own = some["fp"].to_numpy().view(np.uint64)
                    middle = ((own & ~masks[part])[:, None] ^ turned[None, :]).ravel()
                    yield pd.DataFrame(
                        {
                            "part": np.int32(part),
                            "key": np.repeat(some["key"].to_numpy(), len(turned)),
                            "mid": middle.view(np.int64),
                            "fp": np.repeat(own.view(np.int64), len(turned)),
                        }
                    )

    schema = "part int, key long, mid long, fp long"
    reach = 1 if distance > 1 else 0  # two that reach a midpoint so are at most two apart
    near = data.join(large, ["part", "key"], "left_semi").select("part", "key", F.col("v").alias("fp"), F.lit(reach).alias("reach"))
    far = probes.join(large, ["part", "key"], "left_semi").select(
        "part", "key", F.col("u").alias("fp"), (F.lit(distance - reach) - F.col("off")).alias("reach")
    )
    near, far = near.mapInPandas(midpoints, schema), far.mapInPandas(midpoints, schema)
    centres = near.groupBy("part", "key", "mid").agg(F.min("fp").alias("centre"))
    return (
        near.union(far)
        .join(centres, ["part", "key", "mid"])
        .where("fp != centre")
        .select(F.col("fp").alias("u"), F.col("centre").alias("v"))
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 3,
    distance: int = 3,
    paired_at: int = PAIRED_AT,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text_key, fp, root, component_id``.

    Fingerprints at most ``distance`` bits apart are linked; ``root`` names the group, and
    ``component_id`` is its smallest id. ``text_key`` is a hash of the text, by which callers can
    find the row again without computing its fingerprint anew.

    Nulls: a null text counts as empty (fingerprint zero, linked like any other); a null id stays
    null and is never the smallest, so a group of null ids only has a null ``component_id``.
    Repeated rows and ids keep one row each. An empty table gives no rows. Other columns
    are ignored, whatever their names. Long texts are read whole, in pieces.
    """
    session(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    light = kept(
        docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), fingerprint(text, words).alias("fp")),
        "fingerprints",
    )
    fps = kept(light.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = connected_components(near_links(fps.select("fp"), distance, paired_at))
    named = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = kept(named, "fingerprint-roots")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = kept(named.select("fp", "root").join(least, "root"), "fingerprint-groups")
    return light.join(groups, "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, distance: int = 3) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the one with the smallest id.

    Rows with a null id give way to rows with one. Among rows that share id and fingerprint one
    with the smallest text hash stays; rows that repeat id and text count once, whatever else they hold. Columns, of any
    type, stay as they are; ids may be of any type that has an order. An empty table gives no rows.
    """
    light = near_duplicates(docs, id_col, text_col, words, distance)
    light = kept(light.groupBy("root", "doc_id", "text_key").agg(F.count("*").alias("copies")), "near-duplicate-rows")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key").alias("place")
    light = light.withColumn("place", order)
    first = light.groupBy("root").agg(F.min("place").alias("first"))
    marked = light.join(first, "root").select("doc_id", "text_key", "copies", (F.col("place") == F.col("first")).alias("stays"))
    gone = kept(marked.where(~F.col("stays")).select("doc_id", "text_key"), "near-duplicates-gone")
    repeated = kept(marked.where(F.col("stays") & (F.col("copies") > 1)).select("doc_id", "text_key"), "near-duplicates-repeated")

    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).alias("id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("key"),
    )

    def match(other: DataFrame, how: str) -> DataFrame:
        on = keyed["id"].eqNullSafe(other["doc_id"]) & (keyed["key"] == other["text_key"])
        return keyed.join(other, on, how)

    out = match(gone.union(repeated), "left_anti").select("row.*")
    if repeated.take(1):
        once = match(repeated, "left_semi").groupBy("id", "key").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
        out = out.union(once.select("row.*"))
    return out

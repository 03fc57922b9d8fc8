"""Document quality scores: random Fourier features, ridge regression, isotonic calibration."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept, session

#: Random features; the kernel's width in standard deviations of the statistics; ridge weight per row.
FEATURES = 384
WIDTH = 4.0
RIDGE = 1e-4
#: Labelled rows the model is fitted on at most (about: rows are chosen by a hash of their id).
FIT_ROWS = 40_000
#: Of these, one in so many is held back from the ridge and calibrates its scores.
CALIBRATE_EVERY = 5
#: Bins of the raw score that calibration counts in.
BINS = 2048
THRESHOLD = 0.7
#: Tasks that sum normal equations; each sends FEATURES squared numbers to the driver.
FIT_TASKS = 8

_SYMBOLS = str.maketrans("", "", "#*$%&|<>{}[]~^_=+\\/@")
_MARKS = str.maketrans("", "", ".,;:")
_LOUD = str.maketrans("", "", "!?")
_DIGITS = str.maketrans("", "", "0123456789")
STATISTICS = 19


def statistics(text: str | None) -> list[float]:
    """Numbers that describe a whole text's form: sizes, repetition, symbols, case, lines. Empty texts give zeros."""
    text = text or ""
    words = text.split()
    n, chars = len(words), len(text)
    if not n:
        return [0.0] * STATISTICS
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.float64, n)
    letters = lengths.sum()
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    top = counts.most_common(1)[0][1]
    upper = sum(map(str.isupper, words))
    ends = sum(text.count(mark) for mark in ".!?")
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    n_symbols = chars - len(text.translate(_SYMBOLS))
    n_loud = chars - len(text.translate(_LOUD))
    n_marks = chars - len(text.translate(_MARKS))
    n_digits = chars - len(text.translate(_DIGITS))
    plain = sum(map(str.isalpha, words))
    pairs = len(set(zip(words, words[1:]))) if n > 1 else 1
    return [
        np.log1p(n),
        np.log1p(letters / n),
        np.log1p(lengths.std()),
        np.log1p(lengths.max()),
        np.log(len(counts)) / np.log(n) if n > 1 else 1.0,
        np.log(max(pairs, 1)) / np.log(n - 1) if n > 2 else 1.0,
        np.sqrt(top / n),
        np.sqrt(repeats / n),
        np.sqrt(n_symbols / chars),
        np.sqrt(n_loud / chars),
        np.sqrt(n_marks / chars),
        np.sqrt(n_digits / chars),
        np.sqrt(upper / n),
        plain / n,
        np.log1p(len(lines)),
        np.log1p(n / len(lines)),
        1 - len(set(lines)) / len(lines),
        np.log1p(n / (ends + 1)),
        np.sqrt((chars - letters) / chars),
    ]


@dataclass(frozen=True)
class Model:
    """A fitted scorer: a few thousand numbers, whatever the corpus' size."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def raw(self, table: np.ndarray) -> np.ndarray:
        return self.lift(table) @ self.weights

    def lift(self, table: np.ndarray) -> np.ndarray:
        """Random Fourier features: inner products approximate a Gaussian kernel. The last is constant."""
        z = np.cos(((table - self.mean) / self.scale) @ self.directions + self.phases)
        return np.hstack([z * np.sqrt(2 / z.shape[1]), np.ones((len(table), 1))])

    def score(self, texts) -> np.ndarray:
        if len(texts) == 0:
            return np.zeros(0)
        table = np.array([statistics(t) for t in texts])
        return np.clip(np.interp(self.raw(table), self.knots, self.values), 0.0, 1.0)


def isotonic(places: np.ndarray, positives: np.ndarray, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the best non-decreasing rates, as knots at the blocks' weighted centres."""
    blocks: list[list[float]] = []
    for x, p, n in zip(places, positives, totals):
        blocks.append([x * n, p, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            x2, p2, n2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + x2, blocks[-1][1] + p2, blocks[-1][2] + n2]
    return np.array([x / n for x, _, n in blocks]), np.array([p / n for _, p, n in blocks])


def _sums(rows: DataFrame, one: callable, shape: tuple[int, ...]) -> np.ndarray:
    """Sum of ``one(batch)`` over all rows: each of FIT_TASKS tasks adds up its own and sends one row."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(shape)
        for batch in batches:
            if len(batch):
                total += one(batch)
        yield pd.DataFrame({"sums": [total.astype("<f8").tobytes()]})

    parts = rows.coalesce(FIT_TASKS).mapInPandas(partial, "sums binary").collect()
    return sum((np.frombuffer(r["sums"], "<f8").reshape(shape) for r in parts), np.zeros(shape))


def labelled(docs: DataFrame, labels: DataFrame, use: Column, fit_rows: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """``(x, y, calibrates)`` of the rows to fit on: statistics and label, written once.

    ``use`` says by ``doc_id`` which labels may be used. Repeated labels of an id are averaged; null ids and
    labels are left out. The chosen labels are at most about ``fit_rows`` by a hash of the id, so they may be
    broadcast; texts are not shuffled.
    """
    truth = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("y")).dropna()
    truth = truth.where(use).groupBy("doc_id").agg(F.avg("y").alias("y"))
    total = truth.count()
    part = min(1.0, fit_rows / max(total, 1))
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    truth = truth.where(chance < int(part * 1_000_000)).withColumn("calibrates", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(CALIBRATE_EVERY)) == 0)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(truth), "doc_id")

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                {
                    "x": [np.array(statistics(t)).astype("<f8").tobytes() for t in batch["text"]],
                    "y": batch["y"],
                    "calibrates": batch["calibrates"],
                }
            )

    return kept(rows.select("text", "y", "calibrates").mapInPandas(describe, "x binary, y double, calibrates boolean"), "labelled")


def _table(batch: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(batch["x"]), "<f8").reshape(len(batch), -1)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    use: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    fit_rows: int = FIT_ROWS,
    features: int = FEATURES,
    seed: int = 17,
) -> Model:
    """Fit a scorer of ``label_col`` on the texts of ``docs`` that have a label which ``use`` admits.

    Three passes over a small table of statistics: their means; the normal equations of the ridge, summed per
    partition; and counts of the raw scores of rows held back, over which the isotonic curve is fitted. Without any
    usable label every score is 0.5.
    """
    session(docs.sparkSession)
    rows = labelled(docs, labels, use, fit_rows, id_col, text_col, label_col)
    moments = _sums(rows, lambda b: np.stack([np.ones(STATISTICS) * len(b), _table(b).sum(0), (_table(b) ** 2).sum(0)]), (3, STATISTICS))
    n = max(moments[0, 0], 1.0)
    mean = moments[1] / n
    scale = np.sqrt(np.maximum(moments[2] / n - mean**2, 0))
    scale[scale < 1e-9] = 1.0
    random = np.random.default_rng(seed)
    directions = random.normal(size=(STATISTICS, features)) / WIDTH
    phases = random.uniform(0, 2 * np.pi, features)
    flat = (np.array([0.0, 1.0]), np.array([0.5, 0.5]))
    model = Model(mean, scale, directions, phases, np.zeros(features + 1), *flat)
    if not moments[0, 0]:
        return model

    def equations(batch: pd.DataFrame) -> np.ndarray:
        z = model.lift(_table(batch))
        return np.hstack([z.T @ z, z.T @ batch["y"].to_numpy()[:, None]])

    fitted = rows.where("not calibrates")
    sums = _sums(fitted, equations, (features + 1, features + 2))
    weight = RIDGE * max(sums[-1, -2], 1.0) * np.eye(features + 1)
    weight[-1, -1] = 1e-9
    model = Model(mean, scale, directions, phases, np.linalg.solve(sums[:, :-1] + weight, sums[:, -1]), *flat)

    def curve(batch: pd.DataFrame) -> np.ndarray:
        raw = np.clip(model.raw(_table(batch)), -0.5, 1.5)
        place = np.minimum(((raw + 0.5) / 2 * BINS).astype(int), BINS - 1)
        y = batch["y"].to_numpy()
        return np.stack([np.bincount(place, w, BINS) for w in (np.ones(len(y)), y, raw)])

    counted = _sums(rows.where("calibrates"), curve, (3, BINS))
    seen = counted[0] > 0
    if not seen.any():
        return Model(mean, scale, directions, phases, model.weights, *(np.array([0.0, 1.0]),) * 2)
    knots, values = isotonic(counted[2][seen] / counted[0][seen], counted[1][seen], counted[0][seen])
    return Model(mean, scale, directions, phases, model.weights, knots, values)


def scored(text: Column, model: Model) -> Column:
    """Score of a text column, 0 to 1; null counts as empty."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.score(batch.tolist()))

    return run(text)


def held_out(doc_id: Column) -> Column:
    """Rows no label may be used of: crc32 of the id as text, modulo 4, is 2. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``.

    A null text is empty and scored as such, a null id is carried along, repeated rows stay, equal texts
    have equal scores, an empty table gives no rows, other columns are ignored. Texts are read whole.
    """
    session(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), scored(F.col(text_col), model).alias("score"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` whose score reaches ``threshold``; columns stay as they are.

    A null text is scored as an empty one, repeated rows stay or go together, an empty table gives no rows.
    """
    session(docs.sparkSession)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, scored(F.col(text_col), model).alias("own_score"))
    return rows.where(F.col("own_score") >= threshold).select("row.*")

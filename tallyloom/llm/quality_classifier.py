"""Quality scores from document statistics: random Fourier features, ridge regression, isotonic calibration.

``statistics`` describes a whole text by some twenty shares and logarithms (never by id, language, source or
labels). A fixed random projection followed by a cosine approximates a Gaussian kernel over the standardised
statistics. Each partition sums its normal equations over scaled integers, so that the total does not depend
on the order of summation; Spark adds the partial sums, and the driver solves one system of ``features``
unknowns. Predictions on a calibration fold are counted in bins and made monotone by pooling adjacent
violators. Scoring reads every text once, in Arrow batches, and shuffles nothing.

The fit uses at most about ``max_fit_rows`` labelled rows (chosen by hash, so that a larger corpus does not
change the cost of fitting); everything else covers all rows.

Defined results: null text is scored as the empty text; rows without doc_id are scored and not held out;
labels other than 0 and 1 are ignored; a document labelled twice counts as bad if any label says so. With no
usable label of one of the two classes there is nothing to learn: every score is the share of good labels
(1 if there are no labels). Equal texts get equal scores, repeated rows too. Texts of any length count whole; columns
besides doc_id and text, and of labels besides doc_id and quality, are passed on or left out, not read. An empty table
gives no row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import small_batches, stored, text_or_empty

STATISTICS = (
    "words", "characters", "word_length", "upper", "lower", "digits", "symbols", "exclamations", "stops", "commas",
    "non_ascii", "lines", "line_length", "distinct_words", "commonest_word", "distinct_lines", "longest_word",
    "distinct_triples", "capital_words", "byte_entropy",
)
FIXED_POINT = 1 << 16


@dataclass(frozen=True)
class Settings:
    features: int = 256
    kernel_width: float = 4.0
    ridge: float = 1e-3
    bins: int = 2048
    max_fit_rows: int = 100_000
    seed: int = 20


def statistics(text: str) -> list[float]:
    """The numbers by which a text is judged, in the order of ``STATISTICS``; all of the text counts."""
    raw = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words, lines = raw.split(), [line for line in raw.split(b"\n") if line.strip()]
    n, size, rows = max(len(words), 1), max(len(raw), 1), max(len(lines), 1)
    tally = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    triples = set(zip(words, words[1:], words[2:]))
    shares = counts[counts > 0] / size
    of = lambda chars: float(counts[list(chars)].sum()) / size
    return [
        np.log1p(len(words)), np.log1p(len(raw)), float(lengths.sum()) / n,
        float(counts[65:91].sum()) / size, float(counts[97:123].sum()) / size, float(counts[48:58].sum()) / size,
        of(b"#*$%&|<>"), of(b"!"), of(b"."), of(b",;:"), float(counts[128:].sum()) / size,
        len(lines) / n, np.log1p(len(raw) / rows), len(tally) / n,
        (max(tally.values()) if tally else 0) / n, len(set(lines)) / rows,
        np.log1p(int(lengths.max()) if len(words) else 0), len(triples) / max(len(words) - 2, 1),
        sum(w[:1].isupper() for w in words) / n, float(-(shares * np.log2(shares)).sum()),
    ]


def statistics_of(texts: pd.Series) -> np.ndarray:
    return np.array([statistics(t) for t in texts], float).reshape(len(texts), len(STATISTICS))


@dataclass(frozen=True)
class Projection:
    """Standardisation and random Fourier features."""

    mean: np.ndarray
    scale: np.ndarray
    settings: Settings

    def __call__(self, x: np.ndarray) -> np.ndarray:
        s = self.settings
        rng = np.random.default_rng(s.seed)
        frequencies = rng.normal(0, 1 / s.kernel_width, (x.shape[1], s.features - 1))
        phases = rng.uniform(0, 2 * np.pi, s.features - 1)
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        waves = np.sqrt(2 / s.features) * np.cos(z @ frequencies + phases)
        return np.hstack([waves, np.ones((len(x), 1))])


@dataclass(frozen=True)
class Model:
    projection: Projection | None
    weights: np.ndarray
    knots: np.ndarray
    heights: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.projection(x) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.projection is None:
            return np.full(len(x), self.heights[0])
        return np.interp(self.raw(x), self.knots, self.heights)


def _labelled(docs: DataFrame, labels: DataFrame, settings: Settings, train: Column | None) -> DataFrame:
    """(doc_id, good, x) of at most about ``max_fit_rows`` labelled documents."""
    usable = labels.select("doc_id", "quality").where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    if train is not None:
        usable = usable.where(train)
    usable = usable.groupBy("doc_id").agg(F.min("quality").cast("double").alias("good"))
    total = usable.count()
    if total > settings.max_fit_rows:
        share = int(settings.max_fit_rows / total * (1 << 32))
        usable = usable.where(F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 32)) < share)

    @F.pandas_udf("array<double>")
    def describe(texts: pd.Series) -> pd.Series:
        return pd.Series(list(statistics_of(texts)))

    # at most max_fit_rows ids of 16 bytes: a bounded table, so that no text is shuffled to find the labelled ones
    chosen = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(usable), "doc_id")
    return chosen.select("doc_id", "good", describe("text").alias("x"))


def _standardisation(fit: DataFrame) -> tuple[np.ndarray, np.ndarray, int, float]:
    width = len(STATISTICS)
    x = F.col("x")
    row = fit.agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"),
        *(F.avg(F.get(x, i)).alias(f"m{i}") for i in range(width)),
        *(F.stddev_pop(F.get(x, i)).alias(f"s{i}") for i in range(width)),
    ).first()
    mean = np.array([row[f"m{i}"] or 0.0 for i in range(width)])
    scale = np.array([row[f"s{i}"] or 0.0 for i in range(width)])
    # rounded, so that the order in which a cluster summed them leaves no trace
    return np.round(mean, 9), np.round(np.where(scale > 1e-9, scale, 1.0), 9), row["n"], row["good"] or 0.0


def _normal_equations(fit: DataFrame, projection: Projection) -> tuple[np.ndarray, np.ndarray]:
    """Sums of z z' and z y over all rows, by partition and then by Spark; the sums are integers."""
    width = projection.settings.features

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width + 1), np.int64)
        for batch in batches:
            z = np.rint(projection(np.array(batch["x"].tolist(), float)) * FIXED_POINT)
            y = np.rint(batch["good"].to_numpy() * FIXED_POINT)
            total += np.rint(z.T @ np.column_stack([z, y])).astype(np.int64)  # exact below 2^53
        if total.any():
            yield pd.DataFrame({"i": np.repeat(np.arange(width), width + 1), "j": np.tile(np.arange(width + 1), width), "v": total.ravel()})

    sums = fit.select("x", "good").mapInPandas(partial, "i int, j int, v long").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((width, width + 1))
    for i, j, v in sums.collect():  # features * (features + 1) rows, whatever the input
        out[i, j] = v
    out /= float(FIXED_POINT) ** 2
    return out[:, :width], out[:, width]


def solved(matrix: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Solution of a positive definite system by Cholesky's method."""
    n = len(right)
    lower, x = np.zeros((n, n)), right.astype(float).copy()
    for j in range(n):
        column = matrix[j:, j] - lower[j:, :j] @ lower[j, :j]
        lower[j:, j] = column / np.sqrt(column[0])
    for j in range(n):
        x[j] = (x[j] - lower[j, :j] @ x[:j]) / lower[j, j]
    for j in range(n - 1, -1, -1):
        x[j] = (x[j] - lower[j + 1:, j] @ x[j + 1:]) / lower[j, j]
    return x


def pooled(counts: np.ndarray, means: np.ndarray) -> list[tuple[float, float, int, int]]:
    """Isotonic regression of ``means`` with weights ``counts``: (weight, mean, first, last) per block."""
    blocks: list[tuple[float, float, int, int]] = []
    for k, (w, m) in enumerate(zip(counts, means)):
        block = (float(w), float(m), k, k)
        while blocks and blocks[-1][1] >= block[1]:
            w0, m0, first, _ = blocks.pop()
            block = (w0 + block[0], (w0 * m0 + block[0] * block[1]) / (w0 + block[0]), first, block[3])
        blocks.append(block)
    return blocks


def _calibration(fold: DataFrame, projection: Projection, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bins, low, high = projection.settings.bins, -0.5, 1.5

    @F.pandas_udf("int")
    def bin_of(x: pd.Series) -> pd.Series:
        raw = projection(np.array(x.tolist(), float)) @ weights
        return pd.Series(np.clip(np.floor((raw - low) / (high - low) * bins), 0, bins - 1).astype("int32"))

    counted = fold.select(bin_of("x").alias("bin"), "good").groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").alias("good")).orderBy("bin").collect()  # at most ``bins`` rows
    at = np.array([(r["bin"] + 0.5) / bins * (high - low) + low for r in counted])
    n = np.array([r["n"] for r in counted], float)
    blocks = pooled(n, np.array([r["good"] for r in counted]) / n)
    # shrunk by one example of each class, so that scores stay inside (0, 1) and keep an order at the ends
    heights = np.array([(w * m + 0.5) / (w + 1) for w, m, _, _ in blocks])
    knots = np.array([np.average(at[a:b + 1], weights=n[a:b + 1]) for _, _, a, b in blocks])
    heights = np.maximum.accumulate(heights)
    knots = np.concatenate([[low - 1], knots, [high + 1]])
    return knots, np.concatenate([[heights[0] * 0.5], heights, [1 - (1 - heights[-1]) * 0.5]])


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, settings: Settings = Settings()) -> Model:
    """Learn from the labels that meet ``train``: three quarters for the ridge, one quarter for the calibration."""
    small_batches(docs.sparkSession)
    rows = _labelled(docs, labels, settings, train)
    rows = stored(rows, "labelled-statistics")
    mean, scale, n, good = _standardisation(rows)
    if n == 0 or good in (0, n):
        share = 1.0 if n == 0 else good / n
        return Model(None, np.zeros(0), np.zeros(1), np.array([share]))
    projection = Projection(mean, scale, settings)
    calibrates = F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(4)) == 0
    learns = rows.where(~calibrates)
    if learns.agg(F.count_distinct("good")).first()[0] < 2 or rows.where(calibrates).isEmpty():
        learns, fold = rows, rows  # too few rows to hold any back
    else:
        fold = rows.where(calibrates)
    gram, moment = _normal_equations(learns, projection)
    size = gram[-1, -1]  # the constant feature counts the rows
    weights = np.round(solved(gram + settings.ridge * size / settings.features * np.eye(len(gram)), moment), 9)
    knots, heights = _calibration(fold, projection, weights)
    return Model(projection, weights, knots, heights)


def score(text: Column, model: Model) -> Column:
    """Calibrated score (0 to 1) of every whole text."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.round(model.scores(statistics_of(texts)), 9))

    return scored(text_or_empty(text))


def remainder(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3


def scored(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted; learnt from rows that are not held out."""
    model = fit(docs, labels, remainder() != 1, settings)
    held_out = F.coalesce(remainder() == 1, F.lit(False))
    rows = docs.select("doc_id", held_out.alias("held_out"), score(F.col("text"), model).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def kept_documents(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that score at least 0.5, with all their columns."""
    model = fit(docs, labels, remainder() != 1, settings)
    rows = docs.select(F.struct("*").alias("row"), F.col("text"))
    return rows.where(score(F.col("text"), model) >= 0.5).select("row.*")


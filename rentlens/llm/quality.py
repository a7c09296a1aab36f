"""Quality classifier: naive Bayes support vectors.

Indicators of hashed n-grams (words, pairs of words, three bytes), and of how large a part
of the pairs repeat one word, are scaled by the log
ratio of their counts in the two classes; a linear model with hinge loss is fitted to the
scaled rows by dual coordinate descent; a logistic curve fitted on rows held out of that
turns its margin into a score.

Defined results: null and empty texts have no n-grams and get the score of margin 0.
Without labelled rows of both classes every text gets the share of label 1 (0.5 without
any). Rows labelled more than once count once, with their lowest label. Repeated rows
give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.llm import arrays

BITS = 18
#: Parts of all word pairs, from which on an indicator of its own says so.
REPEATS = (0.02, 0.05, 0.15, 0.4)
WIDTH = (1 << BITS) + len(REPEATS)
THRESHOLD = 0.3


@dataclass(frozen=True)
class Settings:
    #: Labelled rows the model is fitted on: those of lowest hash. A bound, at any size.
    rows: int = 4000
    smoothing: float = 1.0
    cost: float = 1.0
    rounds: int = 12
    #: One of so many fitted rows is kept for the logistic curve.
    curve_part: int = 5


@dataclass
class Model:
    """`weights` already hold the log-count ratio; `squares` are its squares."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(WIDTH, np.float32))
    squares: np.ndarray = field(default_factory=lambda: np.ones(WIDTH, np.float32))
    slope: float = 0.0
    offset: float = 0.0

    def scores(self, grams: list[np.ndarray]) -> np.ndarray:
        margins = np.array([margin(self.weights, self.squares, g) for g in grams])
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -30, 30)))


def margin(weights: np.ndarray, squares: np.ndarray, grams: np.ndarray) -> float:
    norm = float(squares[grams].sum(dtype=np.float64))
    return float(weights[grams].sum(dtype=np.float64)) / norm**0.5 if norm > 0 else 0.0


def n_grams(column: pa.Array) -> list[np.ndarray]:
    """The different hashed n-grams of each text, ascending."""
    data, bounds = arrays.utf8(column)
    starts, ends, first = arrays.words(data, bounds)
    hashed = arrays.span_hashes(arrays.mix(data.astype(np.uint64) + np.uint64(7)), starts, ends)
    shift = np.uint64(64 - BITS)
    single = (hashed >> shift).astype(np.int32)
    pairs = (arrays.mix(hashed[:-1] * np.uint64(3) + hashed[1:]) >> shift).astype(np.int32)
    repeats = np.concatenate([[0], np.cumsum(hashed[:-1] == hashed[1:])]) if len(hashed) else np.zeros(1, dtype=np.int64)
    wide = data.astype(np.uint64)
    three = (arrays.mix(wide[:-2] << np.uint64(16) | wide[1:-1] << np.uint64(8) | wide[2:]) >> shift).astype(np.int32)
    out = []
    seen = np.zeros(WIDTH, dtype=bool)
    for i in range(len(column)):
        a, b = first[i], first[i + 1]
        seen[single[a:b]] = True
        seen[pairs[a : max(a, b - 1)]] = True
        seen[three[bounds[i] : max(bounds[i], bounds[i + 1] - 2)]] = True
        if b - a > 1:
            part = (repeats[b - 1] - repeats[a]) / (b - a - 1)
            seen[1 << BITS :] = [part >= limit for limit in REPEATS]
        found = np.flatnonzero(seen).astype(np.int32)
        seen[found] = False
        out.append(found)
    return out


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """A model from `docs` (doc_id, text) and `labels` (doc_id, quality)."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .filter("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
    )
    # Bounded: `rows` pairs of numbers.
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.rows)
    texts = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .join(F.broadcast(sample), "doc_id")
        .select("doc_id", "quality", "text")
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrays.parts(batch):
                grams = [g.tobytes() for g in n_grams(part.column("text"))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("quality"), pa.array(grams, pa.binary())], ["doc_id", "quality", "grams"]
                )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = {}
        for batch in batches:
            for doc, quality, grams in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                # Rows may repeat an id; the one of the smallest content counts.
                rows[doc] = min(rows.get(doc, (quality, grams)), (quality, grams))
        model = trained([(q, np.frombuffer(g, np.int32)) for _, (q, g) in sorted(rows.items())], settings)
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.squares.tobytes()], pa.binary()), pa.array([model.slope]), pa.array([model.offset])],
            ["weights", "squares", "slope", "offset"],
        )

    grams = texts.mapInArrow(extract, "doc_id long, quality int, grams binary")
    row = grams.repartition(1).mapInArrow(learn, "weights binary, squares binary, slope double, offset double").first()
    if row is None:
        return Model()
    return Model(np.frombuffer(row["weights"], np.float32), np.frombuffer(row["squares"], np.float32), row["slope"], row["offset"])


def trained(rows: list[tuple[int, np.ndarray]], settings: Settings) -> Model:
    share = sum(q for q, _ in rows) / len(rows) if rows else 0.5
    if share in (0, 1) or not rows:
        return Model(offset=float(np.clip(np.log(max(share, 1e-9) / max(1 - share, 1e-9)), -30, 30)))
    counts = [np.full(WIDTH, settings.smoothing), np.full(WIDTH, settings.smoothing)]
    for quality, grams in rows:
        counts[quality][grams] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    curve = rows[:: settings.curve_part]
    fitted = [r for i, r in enumerate(rows) if i % settings.curve_part] or rows
    if len({q for q, _ in fitted}) < 2 or len({q for q, _ in curve}) < 2:
        fitted = curve = rows
    weights = _descended(fitted, ratio, settings)
    scaled, squares = (weights * ratio).astype(np.float32), (ratio**2).astype(np.float32)
    margins = np.array([margin(scaled, squares, g) for _, g in curve])
    slope, offset = _curve(margins, np.array([q for q, _ in curve], dtype=float))
    return Model(scaled, squares, slope, offset)


def _descended(rows: list[tuple[int, np.ndarray]], ratio: np.ndarray, settings: Settings) -> np.ndarray:
    """Weights of a linear hinge-loss model over rows of length 1, one dual variable a
    row. Classes weigh alike together."""
    weights = np.zeros(WIDTH)
    many = len(rows) / 2 / np.array([sum(q == c for q, _ in rows) for c in (0, 1)])
    values = []
    for _, grams in rows:
        x = ratio[grams]
        norm = np.sqrt((x**2).sum())
        values.append(x / norm if norm > 0 else x)
    dual = np.zeros(len(rows))
    order = np.random.default_rng(5)
    for _ in range(settings.rounds):
        for i in order.permutation(len(rows)):
            quality, grams = rows[i]
            if not len(grams):
                continue
            sign = 2 * quality - 1
            gradient = sign * (weights[grams] @ values[i]) - 1
            new = min(max(dual[i] - gradient, 0.0), settings.cost * many[quality])
            if new != dual[i]:
                weights[grams] += (new - dual[i]) * sign * values[i]
                dual[i] = new
    return weights


def _curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps, with softened targets."""
    ones = labels.sum()
    target = np.where(labels > 0, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), x.T @ (p - target) + 1e-3 * at)
        at = at - step
        if np.abs(step).max() < 1e-8:
            break
    return float(at[0]), float(at[1])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row of `docs` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrays.parts(batch):
                scores = model.scores(n_grams(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id long, score double")


def keep(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of `docs` whose text scores at least `threshold`, with their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrays.parts(batch):
                yield part.filter(pa.array(model.scores(n_grams(part.column("text"))) >= threshold))

    return docs.mapInArrow(run, docs.schema)

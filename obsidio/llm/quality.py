"""Quality classification by random Fourier features over document statistics.

Each text gives a vector of statistics. Random Fourier features, cosines of random projections, approximate a Gaussian
kernel between such vectors. Every partition sums its part of the normal equations of ridge regression on the features;
the sums are added and solved. Isotonic regression on rows that the solution hasn't seen turns the output into a
probability.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bounded_sample, held_out, slices

#: Labelled rows that a model is fitted on, at most.
MOST_LABELLED = 20_000
FEATURES = 384
#: Width of the Gaussian kernel over standardised statistics.
WIDTH = 4.0
RIDGE = 1.0
FOLDS = 4
SEED = 7
#: Partitions that sum normal equations; each hands on FEATURES ** 2 / 2 numbers a fold.
PARTS = 8

STATISTICS = (
    "log_chars", "log_words", "mean_word", "sd_word", "letters", "upper", "digits", "spaces", "newlines", "stops", "other_marks",
    "beyond_ascii", "log_lines", "mean_line", "repeated_lines", "distinct_words", "top_word", "top_five_words", "word_repeats",
    "words_without_letters", "marked_words", "long_words", "one_letter_words", "distinct_pairs", "char_entropy", "word_entropy",
    "capitalised", "stop_ends", "longest_run", "addresses", "mark_runs", "once_words",
)

_RUNS = re.compile(r"(.)\1+", re.S)
_MARK_RUNS = re.compile(r"[^\w\s]{2,}")
_STOPS = frozenset(".,;:!?'\"")


def statistics_of(text: str | None) -> list[float]:
    """The statistics of a whole text, in the order of STATISTICS. Null counts as empty; all are finite."""
    text = text or ""
    n = len(text)
    words = text.split()
    w = len(words)
    if not n or not w:
        return [float(np.log1p(n)), *[0.0] * (len(STATISTICS) - 1)]
    chars = Counter(text)
    letters = upper = digits = spaces = stops = beyond = 0
    for c, k in chars.items():
        if c.isalpha():
            letters += k
            upper += k * c.isupper()
        elif c.isdigit():
            digits += k
        elif c.isspace():
            spaces += k
        elif c in _STOPS:
            stops += k
        if c > "\x7f":
            beyond += k
    newlines = chars["\n"]
    lengths = np.fromiter(map(len, words), np.int64, w)
    counts = Counter(words)
    many = np.fromiter(counts.values(), np.float64, len(counts))
    top = counts.most_common(5)
    share = many / w
    chances = np.fromiter(chars.values(), np.float64, len(chars)) / n
    lines = [x for x in text.split("\n") if x.strip()]
    pairs = len(set(zip(words, words[1:], strict=False)))
    no_letters = marked = capital = ends = 0
    for x, k in counts.items():
        if not x.isalpha():
            if not x.strip(".,;:!?'\"()").isalpha():
                marked += k
                no_letters += 0 if any(map(str.isalpha, x)) else k
            if x[-1] in ".!?":
                ends += k
        if x[0].isupper():
            capital += k
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    run = max((m.end() - m.start() for m in _RUNS.finditer(text)), default=1)
    return [
        float(np.log1p(n)), float(np.log1p(w)), float(lengths.mean()), float(lengths.std()), letters / n, upper / n, digits / n,
        spaces / n, newlines / n, stops / n, (n - letters - digits - spaces - stops) / n, beyond / n, float(np.log1p(len(lines))),
        float(np.log1p(n / max(len(lines), 1))), 1 - len(set(lines)) / max(len(lines), 1), len(counts) / w, top[0][1] / w,
        sum(k for _, k in top) / w, same / w, no_letters / w, marked / w, float((lengths > 15).mean()), float((lengths == 1).mean()),
        pairs / max(w - 1, 1), float(-(chances * np.log(chances)).sum()), float(-(share * np.log(share)).sum()), capital / w,
        ends / w, float(np.log(run)), (text.count("@") + text.count("://")) / w, len(_MARK_RUNS.findall(text)) / w, float((many == 1).sum()) / w,
    ]


def projections() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.standard_normal((len(STATISTICS), FEATURES)) / WIDTH, rng.uniform(0, 2 * np.pi, FEATURES)


@dataclass
class Model:
    """Standardisation, ridge weights of the features (the last one a constant) and the isotonic steps."""

    mean: np.ndarray
    sd: np.ndarray
    weights: np.ndarray
    steps_x: np.ndarray
    steps_y: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        return fourier((x - self.mean) / self.sd)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.features(x) @ self.weights, self.steps_x, self.steps_y)


def fourier(z: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised statistics, and a constant."""
    w, b = projections()
    z = np.clip(z, -8, 8)
    return np.column_stack([np.sqrt(2 / FEATURES) * np.cos(z @ w + b), np.ones(len(z))])


def _statistics(rows: DataFrame) -> DataFrame:
    """The rows with ``stats`` in place of ``text``, which comes last."""
    kept = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            at = piece.schema.get_field_index("text")
            stats = pa.array([statistics_of(x) for x in piece.column(at).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(piece.column(piece.schema.get_field_index(c)) for c in kept), stats], [*kept, "stats"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(run, f"{schema}, stats array<double>")


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing steps that fit y at x best in squares, by pooling adjacent violators, as points to interpolate."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # sum of y, rows, sum of x
    for a, b in zip(x[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([b, 1.0, a])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            top = blocks.pop()
            for i in range(3):
                blocks[-1][i] += top[i]
    at = np.array([b[2] / b[1] for b in blocks])
    value = np.array([(b[0] + 0.5 * (b[0] / b[1])) / (b[1] + 0.5) for b in blocks])
    return at, np.clip(value, 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MOST_LABELLED) -> Model:
    """Fit on at most about ``most`` labelled rows that aren't held out.

    Rows without a label, an id or text teach nothing. Without labelled rows every score is 0.5.
    """
    known = labels.filter(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max(label).cast("double").alias("label"))
    known = bounded_sample(known, F.col("doc_id"), most, 13)
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).filter(F.col("text").isNotNull())
    train = rows.join(F.broadcast(known), "doc_id")  # known: two numbers a row, at most `most` rows
    fold = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(99)), F.lit(FOLDS)).cast("int").alias("fold")
    stats = _statistics(train.select("label", fold, "text")).repartition(PARTS).persist()
    try:
        return _solve(stats)
    finally:
        stats.unpersist()


def _solve(stats: DataFrame) -> Model:
    s = len(STATISTICS)
    moments = stats.select(*[F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(s)], *[F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(s)]).first()
    if moments is None or moments[0] is None:
        return Model(np.zeros(s), np.ones(s), np.zeros(FEATURES + 1), np.array([0.0]), np.array([0.5]))
    mean, sd = np.array(moments[:s]), np.maximum(np.array(moments[s:]), 1e-6)
    width = FEATURES + 1

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = np.zeros((FOLDS, width, width)), np.zeros((FOLDS, width))
        for batch in batches:
            y, fold = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            f = fourier((np.array(batch.column(2).to_pylist(), dtype=float).reshape(-1, s) - mean) / sd)
            for k in range(FOLDS):
                own = f[fold == k]
                left[k] += own.T @ own
                right[k] += own.T @ y[fold == k]
        upper = np.triu_indices(width)
        for k in range(FOLDS):
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([left[k][upper].tobytes()]), pa.array([right[k].tobytes()])], ["fold", "left", "right"])

    left, right = np.zeros((FOLDS, width, width)), np.zeros((FOLDS, width))
    upper = np.triu_indices(width)
    for r in stats.mapInArrow(equations, "fold int, left binary, right binary").collect():  # PARTS * FOLDS rows
        left[r[0]][upper] += np.frombuffer(r[1])
        right[r[0]] += np.frombuffer(r[2])
    left = np.array([x + np.triu(x, 1).T for x in left])
    ridge = np.diag([RIDGE] * FEATURES + [1e-6])
    solve = lambda a, b: np.linalg.solve(a + ridge, b)
    others = np.array([solve(left.sum(0) - left[k], right.sum(0) - right[k]) for k in range(FOLDS)])

    def unseen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = fourier((np.array(batch.column(2).to_pylist(), dtype=float).reshape(-1, s) - mean) / sd)
            out = (f * others[np.asarray(batch.column(1))]).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], ["label", "out"])

    points = np.array(stats.mapInArrow(unseen, "label double, out double").collect())  # two numbers a row, at most MOST_LABELLED rows
    x, y = isotonic(points[:, 1], points[:, 0])
    return Model(mean, sd, solve(left.sum(0), right.sum(0)), x, y)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Score every whole text. ``docs`` has doc_id and text; other columns are ignored, whatever their names.

    Null counts as empty; empty texts get the score that their statistics get. Rows are mapped one by one: ties, repeated
    rows and null ids give a row each; an empty table gives an empty result. Nothing is shuffled.

    Returns doc_id, score (0 to 1).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            x = np.array([statistics_of(t) for t in piece.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(model.probability(x))], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")

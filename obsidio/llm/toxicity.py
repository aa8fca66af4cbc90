"""Toxic passages by maximum-scoring segment search.

Learning: token counts of toxic and other labelled texts give each token a log-odds score under Dirichlet priors. A
word's prior is its stem's rate in that class, and a stem's prior is the rate over both classes, so that a word never seen
takes its stem's score and an unknown stem scores nothing. Every score is then lowered by a drift, as the statistics of
maximal segments need a negative mean.

Search: in each text the linear-time algorithm of Ruzzo and Tompa finds all disjoint maximal segments. A segment's
significance follows the extreme-value law of segment scores: with m tokens, K * m * exp(-lambda * S) segments of score S or
more are expected by chance, where lambda solves E[exp(lambda * s)] = 1 over the tokens of texts that aren't toxic. The
text's score joins the evidence of its significant segments, calibrated on the labelled rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import bounded_sample, discard, held_out, materialise, slices

#: Labelled rows that a model is fitted on, at most.
MOST_LABELLED = 30_000
STEM = 5
WORD_PRIOR, STEM_PRIOR = 2.0, 1.0
DRIFT = 0.5
#: A word or stem counts as evidence where its z-score is at least this.
LEAST_Z = 4.0
#: Scores end here, so that no single word decides alone.
MOST_SCORE = 6.0
#: Chance segments that a significant passage may have a text to itself.
LOG_EXPECTED = math.log(0.05)
MOST_EVIDENCE = 40.0
PUNCTUATION = ".,;:!?\"'()[]{}*%$&#-_<>/\\|~`+=@^"


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-case words of all texts one after another, without punctuation around them, and each text's bounds."""
    lowered = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    split = pc.utf8_split_whitespace(lowered)
    words, bounds = split.flatten(), np.asarray(split.offsets, dtype=np.int64) - split.offsets[0].as_py()
    there = np.asarray(pc.binary_length(words)) > 0  # white space at a text's ends makes empty words
    bounds = np.concatenate(([0], np.cumsum(there)))[bounds]
    return pc.utf8_trim(words.filter(pa.array(there)), characters=PUNCTUATION), bounds


@dataclass
class Model:
    """Scores of words and of stems, lambda and K of the segment statistics, and the calibration from evidence to score."""

    words: pa.Array
    word_scores: np.ndarray
    stems: pa.Array
    stem_scores: np.ndarray
    lam: float = 1.0
    k: float = 0.1
    slope: float = 1.0
    offset: float = 0.0

    def score_words(self, words: pa.Array) -> np.ndarray:
        """A score for each word, drift included."""
        out = np.zeros(len(words))
        found = pc.index_in(words, value_set=self.words)
        known = np.asarray(pc.is_valid(found))
        out[known] = self.word_scores[np.asarray(found.drop_null())]
        rest = np.flatnonzero(~known)
        if len(rest) and len(self.stems):
            stems = pc.utf8_slice_codeunits(pc.take(words, pa.array(rest)), 0, STEM)
            found = pc.index_in(stems, value_set=self.stems)
            hit = np.asarray(pc.is_valid(found))
            out[rest[hit]] = self.stem_scores[np.asarray(found.drop_null())]
        return out - DRIFT

    def weigh(self, scores: np.ndarray) -> tuple[float, list[dict]]:
        """The evidence of one text, and its significant passages.

        Evidence is -ln of the number of segments as good expected by chance, summed over the significant segments; where
        none is, that of the best one.
        """
        if not len(scores):
            return -MOST_EVIDENCE, []
        base = math.log(self.k * len(scores))
        found = [(a, b, s, base - self.lam * s) for a, b, s in maximal_segments(scores)]
        firm = [x for x in found if x[3] <= LOG_EXPECTED]
        total = -sum(x[3] for x in firm) if firm else -min((x[3] for x in found), default=base)
        passages = [{"first_word": a, "end_word": b, "score": s, "expected": math.exp(e)} for a, b, s, e in firm]
        return max(-MOST_EVIDENCE, min(MOST_EVIDENCE, total)), passages

    def probability(self, evidence: float) -> float:
        x = self.slope * evidence + self.offset
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, x))))


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments, by Ruzzo and Tompa in linear time, as (first, end, score).

    Runs of positive and of negative scores are merged first; that doesn't change what is maximal.
    """
    up = scores > 0
    if not up.any():
        return []
    edges = np.flatnonzero(np.diff(np.concatenate(([False], up, [False])).astype(np.int8)))
    starts, ends = edges[::2].tolist(), edges[1::2].tolist()
    sums = np.concatenate(([0.0], np.cumsum(scores)))
    lefts, rights = sums[edges[::2]].tolist(), sums[edges[1::2]].tolist()
    held: list[list] = []  # first, end, sum before, sum after; ordered
    links: list[int] = []  # for each held segment the nearest one to the left that begins lower
    for a, b, low, high in zip(starts, ends, lefts, rights, strict=True):
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= low:
                j = links[j]
            if j < 0 or held[j][3] >= high:
                held.append([a, b, low, high])
                links.append(j)
                break
            a, low = held[j][0], held[j][2]  # joins all from j on
            del held[j:], links[j:]
    return [(a, b, high - low) for a, b, low, high in held]


def _counts(rows: DataFrame) -> DataFrame:
    """For each word the texts of each label that have it, summed for each batch before the shuffle.

    A word counts once a text, so that one text that repeats its words can't stand for many.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            words, bounds = words_of(piece.column(0))
            label = np.asarray(piece.column(1))
            coded = words.dictionary_encode()
            size = max(len(coded.dictionary), 1)
            rows_of = np.repeat(np.arange(len(label)), np.diff(bounds))
            pairs = np.unique(rows_of * size + np.asarray(coded.indices, dtype=np.int64))
            for y in (0, 1):
                n = np.bincount(pairs[label[pairs // size] == y] % size, minlength=size)[: len(coded.dictionary)]
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pc.take(coded.dictionary, pa.array(at)).cast(pa.string()), pa.array([y] * len(at), pa.int32()), pa.array(n[at], pa.int64())],
                    ["word", "label", "n"],
                )

    return rows.select("text", "label").mapInArrow(run, "word string, label int, n long").filter("word != ''")


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = MOST_LABELLED) -> Model:
    """Fit on at most about ``most`` labelled rows that aren't held out; the driver gets the fitted tables alone.

    ``docs`` has doc_id and text, ``labels`` doc_id and ``label``. Rows without a label, an id or text teach nothing; of
    several labels of one id the largest counts, and rows that repeat a doc_id count one by one.
    Without any labelled rows, or with one class only, no token is evidence and every score is low.
    """
    known = labels.filter(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    known = bounded_sample(known, F.col("doc_id"), most, 11)
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).filter(F.col("text").isNotNull())
    # known: two numbers a row, at most `most` rows; their texts are written, as they are read again and again
    train = materialise(rows.join(F.broadcast(known), "doc_id").select("text", "label"), "tox-train")

    counts = _counts(train).groupBy("word").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("toxic"), F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("other")
    )
    counts = materialise(counts, "tox-counts")
    model = _tables(counts) or Model(pa.array([], pa.large_string()), np.zeros(0), pa.array([], pa.large_string()), np.zeros(0))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            words, bounds = words_of(piece.column(0))
            scores = model.score_words(words)
            best = [max((s for _, _, s in maximal_segments(scores[a:b])), default=0.0) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([piece.column(1), pa.array(np.diff(bounds), pa.int64()), pa.array(best, pa.float64())], ["label", "n", "best"])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            words, bounds = words_of(piece.column(0))
            scores = model.score_words(words)
            found = [model.weigh(scores[a:b])[0] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([piece.column(1), pa.array(found, pa.float64())], ["label", "evidence"])

    # score frequencies of other texts, for lambda: from the counts, as the model's scores depend on the word alone
    if len(model.words) + len(model.stems):
        sample = counts.filter("other > 0").select(F.col("word"), F.col("other").alias("n"))
        model.lam = _fit_lambda(sample, model)
    measured = train.mapInArrow(measure, "label int, n long, best double").collect()  # at most `most` rows of three numbers
    if measured:
        y = np.array([r[0] for r in measured])
        m = np.maximum(np.array([r[1] for r in measured], dtype=float), 1)
        best = np.array([r[2] for r in measured])
        if (y == 0).any():  # K: the mean of the counts of chance segments, from the mean over texts of exp(lambda * best) / m
            model.k = float(np.clip(np.mean(np.exp(np.minimum(model.lam * best[y == 0], 50.0)).clip(max=1e3) / m[y == 0]), 1e-4, 1.0))
        weighed = train.mapInArrow(weigh, "label int, evidence double").collect()  # at most `most` rows, too
        model.slope, model.offset = _logistic(np.array([r[1] for r in weighed]), np.array([r[0] for r in weighed]))
    discard(train, counts)
    return model


def _tables(counts: DataFrame) -> Model | None:
    """Words and stems that are evidence, and words that overrule their stem. As each is in several of the labelled texts,
    whose number is bounded, so is the size of the tables."""
    totals = counts.agg(F.sum("toxic"), F.sum("other")).first()
    n_toxic, n_other = int(totals[0] or 0), int(totals[1] or 0)
    if not n_toxic or not n_other:
        return None
    stems = counts.groupBy(F.substring("word", 1, STEM).alias("stem")).agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    base = n_toxic / (n_toxic + n_other)

    def scored(df: DataFrame, prior_toxic, prior_other) -> DataFrame:
        a, b = F.col("toxic"), F.col("other")
        value = F.log((a + prior_toxic) / n_toxic) - F.log((b + prior_other) / n_other)
        value = F.greatest(F.lit(-MOST_SCORE), F.least(F.lit(MOST_SCORE), value))
        return df.withColumn("s", value).withColumn("z", value / F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)))

    stems = scored(stems, F.lit(STEM_PRIOR * base), F.lit(STEM_PRIOR * (1 - base)))
    firm_stems = stems.filter(F.abs("z") >= LEAST_Z).orderBy("stem").collect()
    # a word's prior: its stem's rates, worth WORD_PRIOR words
    words = counts.withColumn("stem", F.substring("word", 1, STEM)).join(
        stems.select("stem", F.col("toxic").alias("st"), F.col("other").alias("so")), "stem"
    )
    share = (F.col("st") + STEM_PRIOR * base) / (F.col("st") + F.col("so") + STEM_PRIOR)
    words = scored(words, WORD_PRIOR * share, WORD_PRIOR * (1 - share)).filter((F.col("toxic") + F.col("other") >= 3) & (F.length("word") > 0))
    # a word of a firm stem that is not itself firm is neutral; others are unknown anyway
    firm_words = words.filter((F.abs("z") >= LEAST_Z) | (F.col("toxic") + F.col("other") >= 20)).orderBy("word").collect()
    value = lambda rows: np.array([r["s"] if abs(r["z"]) >= LEAST_Z else 0.0 for r in rows])
    return Model(
        pa.array([r["word"] for r in firm_words], pa.large_string()),
        value(firm_words),
        pa.array([r["stem"] for r in firm_stems], pa.large_string()),
        value(firm_stems),
    )


def _fit_lambda(words: DataFrame, model: Model) -> float:
    """Lambda over word frequencies; the words are scored where they are, and a histogram of scores comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.round(model.score_words(batch.column(0).cast(pa.large_string())) * 20).astype(int)
            yield pa.RecordBatch.from_arrays([pa.array(s, pa.int32()), batch.column(1)], ["bin", "n"])

    bins = words.mapInArrow(run, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()  # bins of 1/20
    s, n = np.array([r[0] / 20 for r in bins]), np.array([float(r[1]) for r in bins])
    if not len(s) or s.max() <= 0:
        return 1.0
    lo, hi = 1e-3, 3.0
    value = lambda x: float((n * np.exp(np.clip(x * s, -50, 50))).sum() / n.sum()) - 1
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if value(mid) < 0 else (lo, mid)
    return max(lo, 0.05)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit with a weak prior, by Newton's method."""
    mean, sd = x.mean(), max(x.std(), 1e-6)
    z = np.column_stack([(x - mean) / sd, np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag([1e-2, 1e-4])
        step = np.linalg.solve(h, z.T @ (y - p) - np.array([1e-2, 1e-4]) * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / sd), float(w[1] - w[0] * mean / sd)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Score every whole text. ``docs`` has doc_id and text; other columns are ignored, whatever their names.

    Null, empty and wordless texts have no passages and the lowest score. Rows are mapped one by one: ties, repeated rows
    and null ids give a row each; an empty table gives an empty result. Nothing is shuffled.

    Returns doc_id, score (0 to 1) and passages: array of (first_word, end_word, score, expected).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first_word", pa.int32()), ("end_word", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))
        for piece in slices(batches, "text"):
            words, bounds = words_of(piece.column(1))
            scores = model.score_words(words)
            out, passages = [], []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                evidence, found = model.weigh(scores[a:b])
                out.append(model.probability(evidence))
                passages.append(found)
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(out, pa.float64()), pa.array(passages, kind)], ["doc_id", "score", "passages"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, passages array<struct<first_word:int,end_word:int,score:double,expected:double>>")

"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram's vector binds the vectors of its letters, each permuted by its
place: r(r(a)) * r(b) * c with r a rotation. A text's vector bundles, that is adds, the vectors of its n-grams; a language's
prototype bundles those of its texts. Texts are compared with prototypes by cosine, both after the mean prototype's
direction, which holds what all languages share, is taken out.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from .common import bounded_sample, held_out, slices

#: Components of a vector.
DIMENSIONS = 1024
#: Symbols: word boundary, a-z, and places that the other letters share by their code point.
SYMBOLS = 128
#: Labelled texts that prototypes are made of, at most.
MOST_LABELLED = 20_000
#: Characters of a text that are bundled at once.
PIECE = 1 << 20
SEED = 20_240_501
UNKNOWN = "und"


@functools.lru_cache(maxsize=1)
def symbol_table() -> np.ndarray:
    """Symbol of each code point: 0 for all that is no letter; the two cases of a letter share one."""
    out = np.zeros(0x110000, np.uint8)
    for cp in range(0x110000):
        if unicodedata.category(chr(cp))[0] == "L":
            low = ord(chr(cp).lower()[0])
            out[cp] = low - 96 if 97 <= low <= 122 else 27 + low % (SYMBOLS - 27)
    return out


@functools.lru_cache(maxsize=1)
def letter_vectors() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbols' vectors for the first, second and third place of a trigram."""
    base = np.random.default_rng(SEED).integers(0, 2, (SYMBOLS, DIMENSIONS)).astype(np.int8) * 2 - 1
    return np.roll(base, 2, axis=1), np.roll(base, 1, axis=1), base


def trigrams(text: str, piece: int = PIECE) -> Iterator[np.ndarray]:
    """Codes of a text's trigrams around a letter, piece by piece; runs of other characters count as one word boundary."""
    table, tail = symbol_table(), np.zeros(1, np.int64)
    for at in range(0, len(text) + 1, piece):
        s = table[np.frombuffer(text[at : at + piece].encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int64)
        if at + piece > len(text):
            s = np.append(s, 0)  # the end is a boundary, too
        s = np.concatenate((tail, s))
        keep = np.ones(len(s), bool)
        keep[len(tail) :] = (s[len(tail) :] != 0) | (s[len(tail) - 1 : -1] != 0)
        s = s[keep]
        codes = (s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:]
        yield codes[s[1:-1] != 0]
        tail = s[-2:]


def bundle(text: str | None) -> np.ndarray | None:
    """A text's vector, or None if it is null or has no letter. Long texts are bundled whole, piece by piece."""
    total = None
    for found in trigrams(text or ""):
        codes, n = np.unique(found, return_counts=True)
        if not len(codes):
            continue
        a, b, c = letter_vectors()
        # the n-grams' vectors, bound from their letters', then added
        bound = a[codes // (SYMBOLS * SYMBOLS)] * b[codes // SYMBOLS % SYMBOLS] * c[codes % SYMBOLS]
        part = n.astype(np.float32) @ bound.astype(np.float32)
        total = part if total is None else total + part
    return total


@dataclass
class Profiles:
    """Prototypes of unit length, one a language, without the direction that all share."""

    langs: list[str]
    prototypes: np.ndarray
    shared: np.ndarray

    def classify(self, vector: np.ndarray | None) -> tuple[str, float]:
        """The nearest language and the cosine as a score of 0 to 1; ties go to the first language by name."""
        if vector is None or not self.langs:
            return UNKNOWN, 0.0
        v = vector - (vector @ self.shared) * self.shared
        length = float(np.sqrt(v @ v))
        if length == 0:
            return self.langs[0], 0.0
        cosines = self.prototypes @ v / length
        best = int(np.argmax(cosines))
        return self.langs[best], max(0.0, min(1.0, float(cosines[best])))


def fit(docs: DataFrame, most: int = MOST_LABELLED) -> Profiles:
    """Prototypes from texts of known language that aren't held out, ``most`` at most, chosen by a hash of the id.

    Rows with a null doc_id, text or lang teach nothing; repeated rows count one by one. Each task bundles its texts by
    language and hands on one vector for each; their number is that of the languages.
    """
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    rows = bounded_sample(rows, F.col("doc_id"), most, 3).select("text", "lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for piece in slices(batches, "text"):
            for text, lang in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                v = bundle(text)
                if v is not None:
                    v = v / max(float(np.sqrt(v @ v)), 1e-9)
                    sums[lang] = sums[lang] + v if lang in sums else v.astype(np.float64)
        names = sorted(sums)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([x for x in names for _ in range(DIMENSIONS)], pa.string()),
                pa.array(np.tile(np.arange(DIMENSIONS), len(names)), pa.int32()),
                pa.array(np.concatenate([sums[x] for x in names]) if names else [], pa.float64()),
            ],
            ["lang", "at", "v"],
        )

    # rounded, so that the order in which partitions are summed changes nothing
    sums = rows.mapInArrow(run, "lang string, at int, v double").groupBy("lang", "at").agg(F.round(F.sum("v"), 6).alias("v")).collect()
    langs = sorted({r[0] for r in sums})
    protos = np.zeros((len(langs), DIMENSIONS))
    for r in sums:
        protos[langs.index(r[0]), r[1]] = r[2]
    protos /= np.maximum(np.linalg.norm(protos, axis=1, keepdims=True), 1e-9)
    shared = protos.mean(axis=0) if len(langs) > 1 else np.zeros(DIMENSIONS)
    shared /= max(float(np.linalg.norm(shared)), 1e-9)
    protos = protos - (protos @ shared)[:, None] * shared
    protos /= np.maximum(np.linalg.norm(protos, axis=1, keepdims=True), 1e-9)
    return Profiles(langs, protos.astype(np.float32), shared.astype(np.float32))


def identify(docs: DataFrame, profiles: Profiles, keep: str | None = None) -> DataFrame:
    """Predict the language of every whole text from the text alone.

    ``docs`` has doc_id and text; other columns are ignored, whatever their names. A text that is null, empty or without a
    letter is ``und`` with score 0, and so is every text where nothing was learned. Rows are mapped one by one: ties,
    repeated rows and null ids give a row each, and an empty table an empty result. Nothing is shuffled; what goes to the
    executors is one vector for each language.

    Returns doc_id, lang_pred, score. With ``keep``, a column that goes along with its row, also lettered, whether the
    text has a letter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            vectors = [bundle(x) for x in piece.column(1).to_pylist()]
            langs, scores = zip(*map(profiles.classify, vectors), strict=True)
            columns = [piece.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            more = [pa.array([v is not None for v in vectors], pa.bool_()), piece.column(2)] if keep else []
            yield pa.RecordBatch.from_arrays([*columns, *more], schema.names)

    schema = StructType().add("doc_id", "long").add("lang_pred", "string").add("score", "double")
    schema = StructType([*schema, *StructType().add("lettered", "boolean"), docs.schema[keep]]) if keep else schema
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *([keep] if keep else []))
    return rows.mapInArrow(run, schema)

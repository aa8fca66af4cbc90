"""BPE encoding and decoding by a tokenization automaton.

The automaton starts with one state that loops on every base symbol. Each merge (u, v) -> uv, in rank order, applies one
gadget: the state that u-arcs lead to is split; the copy that u-arcs now enter has lost its v-arc; each state from which
the path u, v could be read gains a uv-arc into the state that v-arcs lead to. All arcs of one label lead to one state, so
states are numbered by labels, and a state is known by its gadget: what it was copied from, when, and which arc it lost.
Kept so, 48,894 gadgets take 49,406 rows, where the full transition table would take 2.4 billion. Whether a state has an
arc is resolved through the gadgets once and then stands in a table.

The automaton reads a word in one way only, so every prefix of a word has one last label: the state that the automaton is
in there. Encoding goes from left to right and looks the next state up: of the labels that end at a position, the one whose
arc leaves the state at its start, by the table of arcs. No position is visited twice. There are as many states as labels,
and at most MOST_ARCS arcs in the table; those beyond are resolved again. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from .common import slices

#: Resolved arcs that a worker holds; the table is emptied when it is full.
MOST_ARCS = 2_000_000
#: Words whose arcs a worker remembers; twice as many at most are held.
REMEMBERED = 300_000

_SPACE = "\t-\r \x85\xa0  -     　"
#: Blocks whose letters, numbers and lower case have been the same in all Unicode versions that libraries here use.
#: Capital sigma is out: its lower case depends on its place in Python, but not in the tokenizers library.
_KNOWN = "\0-ȳΆ-ΊΌΎ-ΡΤ-ώЀ-џ‐-‧‰-⁞ぁ-ゖァ-ヺ一-龥가-힣"


class Automaton:
    """States, gadgets and labels for a list of merges. ``vocab`` maps labels to ids."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.vocab, self.suffix = vocab, suffix
        size = max(vocab.values(), default=-1) + 1
        self.labels = [""] * size
        for label, i in vocab.items():
            self.labels[i] = label
        self.born, self.left, self.right = [0] * size, [-1] * size, [-1] * size
        self.lost: dict[int, int] = {}  # u * size + v: the gadget that took v's arc from the state after u
        self.size = size
        for when, (u, v) in enumerate(merges, 1):
            a, b, c = vocab[u], vocab[v], vocab[u + v]
            self.born[c], self.left[c], self.right[c] = when, a, b
            self.lost[a * size + b] = when
        self.inner: dict[str, int] = {}  # by their last two symbols, the symbols of the longest label
        self.final: dict[str, int] = {}  # of those that end a word
        for label in vocab:
            ends = bool(suffix) and label.endswith(suffix)
            spelt = label[: len(label) - len(suffix)] if ends else label
            reach = self.final if ends else self.inner
            reach[spelt[-2:]] = max(reach.get(spelt[-2:], 1), len(spelt))
        if not suffix:
            self.final = self.inner
        self.arcs: dict[int, bool] = {}

    def has_arc(self, x: int, y: int) -> bool:
        """Whether the state after label x has an arc labelled y, resolved through the gadgets."""
        size, born, left, right, lost = self.size, self.born, self.left, self.right, self.lost
        now = len(self.labels) + len(lost) + 1
        while True:
            if lost.get(x * size + y, now + 1) <= now:
                return False
            if left[y] == x and right[y] == x and born[y] <= now:  # a run of u is paired from its start: uu never follows a single u
                return False
            if not born[x] and not born[y]:
                return True
            if born[x] >= born[y]:  # the state was copied from the one after its right part, just before its gadget
                now = born[x] - 1
                x = right[x]
            else:  # the arc was added where its left part could be read, just before its gadget
                now = born[y] - 1
                y = left[y]

    def read(self, word: str) -> list[int]:
        """The ids on the one path that spells ``word``, which is not empty."""
        vocab, arcs, size, n = self.vocab, self.arcs, self.size, len(word)
        state, start = [-1] * (n + 1), [0] * (n + 1)  # the last label of each prefix, and where it starts; -1: none
        for k in range(1, n + 1):
            reach, end = (self.inner, "") if k < n else (self.final, self.suffix)
            for j in range(max(0, k - reach.get(word[max(0, k - 2) : k], 1)), k):
                y, x = vocab.get(word[j:k] + end), state[j]
                if y is None or j and x < 0:
                    continue
                if j:
                    key = x * size + y
                    fits = arcs.get(key)
                    if fits is None:
                        if len(arcs) >= MOST_ARCS:
                            arcs.clear()
                        fits = arcs[key] = self.has_arc(x, y)
                    if not fits:
                        continue
                state[k], start[k] = y, j
                break
        if state[n] < 0:
            raise ValueError(f"no path spells {word!r}")
        out, k = [], n
        while k:
            out.append(state[k])
            k = start[k]
        return out[::-1]

    def emit(self, ids: list[int]) -> list[str]:
        """The labels of a path."""
        return [self.labels[i] for i in ids]


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte, as byte-level BPE defines it."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + hidden.index(b)) for b in range(256)]


def _letters_and_numbers() -> tuple[str, str]:
    """Character classes of the letters and the numbers among the known characters."""
    known, found = re.compile(f"[{_KNOWN}]"), {"L": [], "N": []}
    for c in map(chr, range(0xD800)):
        kind = unicodedata.category(c)[0]
        if kind in found and known.match(c):
            ranges = found[kind]
            if ranges and ord(c) == ord(ranges[-1][1]) + 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
    return tuple("".join(f"{a}-{b}" for a, b in found[k]) for k in "LN")


class WordTokenizer:
    """Normalise, split into words, encode and decode, from a tokenizer file with lower case and word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model["end_of_word_suffix"] or "")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added_labels = {i: t for t, i in self.added.items()}
        self.added_pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        letters, numbers = _letters_and_numbers()
        self.words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{_SPACE}{letters}{numbers}]+").findall
        self.plain_words = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+").findall
        self.unknown = re.compile(f"[^{_KNOWN}]").search
        self.symbols = {b: s for b, s in enumerate(byte_symbols())}
        self.path, self._library = path, None
        self.young: dict[str, tuple[str, int, str]] = {}
        self.old: dict[str, tuple[str, int, str]] = {}

    @property
    def library(self):
        """The library's own normaliser and splitter, for texts with characters that this module doesn't know."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
        return self._library

    def split(self, text: str) -> list[str]:
        """The words of a text without added tokens. Bytes are not yet replaced by their symbols."""
        if text.isascii():
            return self.plain_words(text.lower())
        if not self.unknown(text):
            lowered = unicodedata.normalize("NFC", text).lower()
            if not self.unknown(lowered):  # lower case may lie outside the blocks
                return self.words(lowered)
        lowered = self.library.normalizer.normalize_str(text)
        raw = {s: b for b, s in self.symbols.items()}
        return [bytes(raw[c] for c in w).decode("utf-8") for w, _ in self.library.pre_tokenizer.pre_tokenize_str(lowered)]

    def word(self, word: str) -> tuple[str, int, str]:
        """Decimal ids joined by a space, their number, and the labels joined by a space."""
        found = self.old.get(word)
        if found is None:
            spelt = word if word.isascii() and word.isalnum() else "".join(map(self.symbols.__getitem__, word.encode()))
            ids = self.automaton.read(spelt)
            found = (" ".join(map(str, ids)), len(ids), " ".join(self.automaton.emit(ids)))
        if len(self.young) >= REMEMBERED:
            self.old, self.young = self.young, {}
        self.young[word] = found
        return found

    def encode(self, text: str | None) -> tuple[str, int, str]:
        """Of a whole text: decimal ids joined by a space, their number, and the decoded text. None counts as empty."""
        if not text:
            return "", 0, ""
        parts = self.added_pattern.split(text) if self.added_pattern and "<" in text else [text]
        ids, total, labels = [], 0, []
        for k, part in enumerate(parts):
            if k % 2:
                ids.append(str(self.added[part]))
                labels.append(part)
                total += 1
                continue
            for w in self.split(part):
                found = self.young.get(w) or self.word(w)
                ids.append(found[0])
                total += found[1]
                labels.append(found[2])
        return " ".join(ids), total, " ".join(labels)

    def decode(self, ids: list[int]) -> str:
        """The labels of any ids, joined by a space: the file names no decoder. Ids that the file doesn't have are left out."""
        names = self.automaton.labels
        return " ".join(self.added_labels.get(i) or names[i] for i in ids if i in self.added_labels or 0 <= i < len(names))


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    """One for each Python worker and file."""
    return WordTokenizer(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode_texts(docs: DataFrame, path: str | None = None, keep: str | None = None) -> DataFrame:
    """Encode and decode every text. ``docs`` has doc_id and text; other columns are ignored, whatever their names.

    Null and empty texts, and those of white space, have no tokens, an empty ``ids`` and an empty ``decoded``. Rows are
    mapped one by one: repeated rows, ties and null ids give a row each, and an empty table an empty result. Texts of any
    length are read whole. No rows are shuffled; a lost task is run again.

    Returns doc_id, n_tokens, ids (decimal ids joined by one space), decoded. ``path`` is the tokenizer file, which must
    be found on every executor; None finds the installed one there. ``keep`` names a column that goes along with its row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path or default_path())
        for piece in slices(batches, "text", 2 << 20):
            out = [t.encode(x) for x in piece.column(1).to_pylist()]
            ids, n, decoded = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string()), *piece.columns[2:]],
                ["doc_id", "n_tokens", "ids", "decoded", *kept],
            )

    kept = [keep] if keep else []
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *kept)
    schema = StructType().add("doc_id", "long").add("n_tokens", "long").add("ids", "string").add("decoded", "string")
    return rows.mapInArrow(run, StructType([*schema, *(docs.schema[c] for c in kept)]))


def decode_ids(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Decode rows of (doc_id, ids), ids as ``encode_texts`` gives them. Null ids count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path or default_path())
        for piece in slices(batches, "ids", 2 << 20):
            out = [t.decode(list(map(int, x.split()))) if x else "" for x in piece.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(out, pa.string())], ["doc_id", "decoded"])

    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("string").alias("ids"))
    return rows.mapInArrow(run, "doc_id long, decoded string")

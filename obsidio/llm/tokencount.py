"""Edit-aware token counts.

A document's pre-tokens lie in the leaves of a segment tree whose nodes hold sums of characters and tokens. An edit finds
its leaf by the character sums, splits the text anew from the last pre-token that can't have seen the edit until the
boundaries fall together with the old ones again, counts the tokens of that stretch only, and updates the sums above it.

Trees are kept as a table: the text, the length and token number of each pre-token, the pre-tokens of each leaf, and the
sums of the nodes. Edits that come later are applied to the stored trees, and give the next table of trees.
"""

from __future__ import annotations

import base64
import functools
import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F

from .common import slices

#: Characters after its end that a match of the pattern looks at, at most.
LOOKAHEAD = 4
LEAF = 64
#: A leaf that grows beyond this has the tree built anew.
FULL = 8 * LEAF
#: Pre-tokens whose token number a worker remembers; twice as many at most are held.
REMEMBERED = 300_000


class Counter:
    """Splits text by the vocabulary's pattern and counts the tokens of a pre-token."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def count(self, piece: str) -> int:
        n = self.young.get(piece)
        if n is None:
            n = self.old.get(piece)
            if n is None:
                n = len(self.encoding.encode_ordinary(piece))
            if len(self.young) >= REMEMBERED:
                self.old, self.young = self.young, {}
            self.young[piece] = n
        return n

    def counts(self, pieces: list[str]) -> list[int]:
        found = list(map(self.young.get, pieces))
        return [self.count(x) if n is None else n for x, n in zip(pieces, found, strict=True)] if None in found else found


@functools.lru_cache(maxsize=2)
def counter(path: str | None = None) -> Counter:
    """One for each Python worker and file."""
    import public_tokenizers

    return Counter(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


class TokenTree:
    """Pre-tokens of one text in a segment tree of character and token sums."""

    def __init__(self, text: str, using: Counter):
        self.using, self.recounted = using, 0
        pieces = using.pattern.findall(text)
        self._build(pieces, using.counts(pieces))

    def _build(self, pieces: list[str], counts: list[int]) -> None:
        self.n_pieces = len(pieces)
        at = range(0, max(len(pieces), 1), LEAF)
        self.leaves, self.counts = [pieces[i : i + LEAF] for i in at], [counts[i : i + LEAF] for i in at]
        self.size = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for i, leaf in enumerate(self.leaves):
            self.chars[self.size + i], self.tokens[self.size + i] = sum(map(len, leaf)), sum(self.counts[i])
        for i in range(self.size - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def stored(self) -> tuple:
        """The tree as a row: text, characters and tokens of each pre-token, pre-tokens of each leaf, sums of the nodes."""
        self._open()
        return self.text(), [len(x) for leaf in self.leaves for x in leaf], [n for leaf in self.counts for n in leaf], list(map(len, self.leaves)), self.chars, self.tokens

    @classmethod
    def restored(cls, using: Counter, text: str, piece_chars: Sequence[int], piece_tokens: Sequence[int], leaf_pieces: Sequence[int], chars: Sequence[int], tokens: Sequence[int]) -> TokenTree:
        """The tree of a row. Nothing is counted, and a leaf's text is split only when it is looked at."""
        tree = cls.__new__(cls)
        tree.using, tree.recounted, tree.chars, tree.tokens, tree.size = using, 0, list(chars), list(tokens), len(chars) // 2
        n, bounds = len(leaf_pieces), [0, *itertools.accumulate(leaf_pieces)]
        tree.leaves, tree.counts, tree.n_pieces = [None] * n, [None] * n, bounds[-1]
        tree.closed = text, piece_chars, piece_tokens, bounds, [0, *itertools.accumulate(tree.chars[tree.size : tree.size + n])]
        return tree

    def _leaf(self, i: int) -> list[str]:
        """The pre-tokens of a leaf, which is opened if it isn't yet."""
        if self.leaves[i] is None:
            text, chars, tokens, bounds, begins = self.closed
            own = slice(bounds[i], bounds[i + 1])
            ends = list(itertools.accumulate(chars[own], initial=begins[i]))
            self.leaves[i], self.counts[i] = [text[a:b] for a, b in itertools.pairwise(ends)], list(tokens[own])
        return self.leaves[i]

    def _open(self) -> None:
        for i in range(len(self.leaves)):
            self._leaf(i)

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        self._open()
        return "".join(x for leaf in self.leaves for x in leaf)

    def _leaf_at(self, at: int) -> tuple[int, int]:
        """The leaf that holds the character ``at``, or the last one with characters, and where it begins."""
        node, begin = 1, 0
        at = min(at, max(self.chars[1] - 1, 0))
        while node < self.size:
            node *= 2
            if at - begin >= self.chars[node]:
                begin += self.chars[node]
                node += 1
        return min(node - self.size, len(self.leaves) - 1), begin

    def _set(self, i: int, leaf: list[str], counts: list[int]) -> None:
        """Put ``leaf`` in place i and carry the change of its sums upward."""
        node = self.size + i
        chars, tokens = sum(map(len, leaf)) - self.chars[node], sum(counts) - self.tokens[node]
        self.n_pieces += len(leaf) - len(self._leaf(i))
        self.leaves[i], self.counts[i] = leaf, counts
        while node:
            self.chars[node] += chars
            self.tokens[node] += tokens
            node //= 2

    def edit(self, at: int, deleted: int, inserted: str) -> None:
        """Replace ``deleted`` characters from ``at`` on by ``inserted``. What lies outside the text is cut off."""
        at = max(0, min(at, self.n_chars))
        deleted = max(0, min(deleted, self.n_chars - at))
        if not deleted and not inserted:
            return
        first, begin = self._leaf_at(max(0, at - LOOKAHEAD))
        head = 0
        for piece in self._leaf(first):  # pre-tokens that end LOOKAHEAD before the edit stay
            if begin + len(piece) > at - LOOKAHEAD:
                break
            begin += len(piece)
            head += 1
        last, old, numbers = first, self.leaves[first][head:], self.counts[first][head:]
        have = sum(map(len, old))
        while have < at - begin + deleted + LOOKAHEAD and last + 1 < len(self.leaves):
            last += 1
            old, numbers = old + self._leaf(last), numbers + self.counts[last]
            have += self.chars[self.size + last]
        cut, shift = at - begin, len(inserted) - deleted
        text = "".join(old)
        text = text[:cut] + inserted + text[cut + deleted :]
        bounds, total = {}, 0  # where old pre-tokens begin in the new text, and their numbers
        for k, piece in enumerate(old):
            if total >= cut + deleted:
                bounds[total + shift] = k
            total += len(piece)
        new, now, kept = [], 0, len(old)
        while True:
            if now >= cut + len(inserted) and now in bounds:
                kept = bounds[now]
                break
            found = self.using.pattern.match(text, now)
            if (found is None or found.end() + LOOKAHEAD > len(text)) and last + 1 < len(self.leaves):
                last += 1
                for piece in self._leaf(last):
                    if total >= cut + deleted:
                        bounds[total + shift] = len(old)
                    old.append(piece)
                    total += len(piece)
                numbers += self.counts[last]
                text += "".join(self.leaves[last])
                kept = len(old)
                continue
            if found is None:
                break
            new.append(found[0])
            now = found.end()
        self.recounted += len(new)
        leaf = self.leaves[first][:head] + new + old[kept:]
        counts = self.counts[first][:head] + self.using.counts(new) + numbers[kept:]
        for i in range(first + 1, last + 1):
            self._set(i, [], [])
        self._set(first, leaf, counts)
        if len(leaf) > FULL:
            self._open()
            self._build([x for part in self.leaves for x in part], [n for part in self.counts for n in part])


TREE = "text string, piece_chars array<int>, piece_tokens array<int>, leaf_pieces array<int>, chars array<long>, tokens array<long>"
TREE_COLUMNS = [x.split()[0] for x in TREE.split(", ")]
_KINDS = [pa.string(), *[pa.list_(pa.int32())] * 3, *[pa.list_(pa.int64())] * 2]
_COUNTS = ["n_tokens_before", "n_tokens", "n_pieces", "n_recounted"]


def _columns(rows: list[tuple], kinds: list) -> list[pa.Array]:
    return [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]


def _values(column: pa.Array) -> Iterator[memoryview]:
    """The values of each row of a list column, as views that give whole numbers of Python when they are read."""
    values, at = memoryview(np.ascontiguousarray(column.values.to_numpy())), column.offsets.to_numpy().tolist()
    return (values[a:b] for a, b in itertools.pairwise(at))


def build_trees(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The tree of every whole text, as a table to keep: doc_id and TREE_COLUMNS.

    ``docs`` has doc_id and text; other columns are ignored, whatever their names. Null text counts as empty. Rows are
    mapped one by one, so that ties, repeated rows and null ids give a row each; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        using = counter(path)
        for piece in slices(batches, "text"):
            rows = [TokenTree(text or "", using).stored() for text in piece.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column(0), *_columns(rows, _KINDS)], ["doc_id", *TREE_COLUMNS])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, {TREE}")


def attach_edits(trees: DataFrame, edits: DataFrame) -> DataFrame:
    """``trees`` with their edits, rows of (doc_id, seq, at, deleted, inserted), in the order of seq, nulls first.

    Ties of seq go by position and content. A document's own edits are brought together, as they build on each other; each
    row of a repeated doc_id gets them all. Edits without an id or of no document change nothing, and a table without edits
    gives every tree none. Other columns of the edits are ignored.
    """
    step = F.struct(F.col("seq"), F.col("at").cast("long"), F.col("deleted").cast("long"), F.col("inserted").cast("string"))
    by_doc = edits.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(step)), lambda e: e.dropFields("seq")).alias("edits"))
    return trees.join(by_doc, "doc_id", "left")


def apply_edits(trees: DataFrame, path: str | None = None, keep: bool = True) -> DataFrame:
    """Stored trees after their edits, with token numbers before and after.

    ``trees`` has doc_id, TREE_COLUMNS and edits, an array of (at, deleted, inserted) that is applied from first to last.
    Null edits count as none; within an edit, null numbers count as 0 and null insertions as empty, and what reaches beyond
    the text is cut off. Rows are mapped one by one; nothing is shuffled.

    Returns doc_id, TREE_COLUMNS, n_tokens_before, n_tokens, n_pieces, n_recounted (pre-tokens counted anew for the edits);
    with ``keep`` off, without the trees.
    """
    kinds, names = ([*_KINDS], [*TREE_COLUMNS]) if keep else ([], [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        using = counter(path)
        for piece in slices(batches, "text"):
            rows = []
            for *stored, edits in zip(piece.column(1).to_pylist(), *map(_values, piece.columns[2:7]), piece.column(7).to_pylist(), strict=True):
                tree = TokenTree.restored(using, *stored)
                before = tree.n_tokens
                for e in edits or ():
                    if e:
                        tree.edit(e["at"] or 0, e["deleted"] or 0, e["inserted"] or "")
                rows.append((*(tree.stored() if keep else ()), before, tree.n_tokens, tree.n_pieces, tree.recounted))
            yield pa.RecordBatch.from_arrays([piece.column(0), *_columns(rows, [*kinds, *[pa.int64()] * 4])], ["doc_id", *names, *_COUNTS])

    rows = trees.select("doc_id", *TREE_COLUMNS, F.col("edits").cast("array<struct<at:bigint,deleted:bigint,inserted:string>>").alias("edits"))
    tree = f"{TREE}, " if keep else ""
    return rows.mapInArrow(run, f"doc_id long, {tree}{', '.join(f'{c} long' for c in _COUNTS)}")


def scripted_edits(trees: DataFrame) -> DataFrame:
    """``trees`` with a script of edits that depends on the text alone: a replacement, a deletion and two insertions."""
    n = F.coalesce(F.char_length("text"), F.lit(0))
    edit = lambda at, deleted, inserted: F.struct(at.cast("long").alias("at"), F.lit(deleted).cast("long").alias("deleted"), F.lit(inserted).alias("inserted"))
    script = F.array(edit(F.floor(n / 3), 9, " [masked] "), edit(F.floor(2 * n / 3), 17, ""), edit(F.lit(0), 0, "Title: "), edit(F.floor(n / 2), 0, "\n"))
    return trees.withColumn("edits", script)

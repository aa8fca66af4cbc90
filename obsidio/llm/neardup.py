"""Near duplicates: a Jaccard join on word shingles by signature trees.

Every text becomes the set of its distinct five-word shingles, named by a hash. Equal sets form one node.

1. Nodes that can link with nothing are left out. Of each set the tokens of an extended prefix (2p - 1 tokens in the order
   of their hashes, p the size of the plain prefix) are counted over all sets: a linked set shares p of them at least.
   Only the other nodes' whole sets are kept, once.
2. The top of the tree is a split by token: two sets that reach the similarity share a token among the first p of each in
   any common order, so a node goes to the groups of these tokens, frequent tokens last. Groups of equal members are one.
3. In each group the nodes are paired with its first one only, and so are those of a common minimum hash; then with the
   group's most central one. These pairs are verified, and give components.
4. Groups that still hold more than one component get a signature tree: its nodes hold the OR of their members' token
   bitmaps and their size range, and a dual traversal drops pairs of tree nodes by the largest overlap possible, and those
   within one component. Large groups are split into blocks, each pair of blocks a tree join of its own.
5. What remains is verified on the whole sets, and the components are joined up.

No link between different components is lost; links within one are not all looked at, as they can't change a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import discard, materialise, maybe_in, numbered, release, slices, without
from .components import connected_components, joined_up

WORDS = 5
#: Links: LEAST_SHARED * |union| <= 100 * |intersection|.
LEAST_SHARED = 80
#: Bits of a token bitmap.
BITS = 2048
#: Tokens that come last in the common order: as many at most, each in so many sets at least. They only order prefixes; no
#: result depends on them.
FREQUENT, IN_SETS = 200_000, 3
#: Minima of so many hashes bring most near copies to a common first node; they save looks, and no result depends on them.
SKETCH = 4
#: Rows of one token that a task holds before it hands them on, and tokens that it counts before it hands them on.
LONGEST_RUN, HELD = 1 << 20, 1 << 21
#: Sets with new names at most; all sets that share a 64-bit name with another one get new names.
MOST_RENAMED = 100_000
#: Members of a leaf, and children of a tree node.
FANOUT = 8
#: Members of a block.
BLOCK = 512
#: Bytes of text that are shingled at once, one longer text aside, and bytes whose arithmetic is done at once.
TEXT_BYTES, CHUNK = 1 << 20, 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values, one to one."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


class Shingler:
    """Hashed shingles of many texts at once, on their bytes."""

    def __init__(self):
        self.powers = np.ones(1, np.uint64)

    def _words(self, data: np.ndarray, inside: np.ndarray, opens: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Hashes of the words that open at ``starts``, by pieces of about CHUNK bytes, or one longer word."""
        out, n = np.empty(len(starts), np.uint64), 0
        while n < len(starts):
            upto = max(n + 1, int(np.searchsorted(starts, starts[n] + CHUNK)))
            a, b = int(starts[n]), int(starts[upto]) if upto < len(starts) else len(data)
            at = np.flatnonzero(inside[a:b])
            first = np.flatnonzero(opens[a:b][at])
            place = at - np.repeat(at[first], np.diff(np.append(first, len(at))))
            longest = int(place.max()) + 1
            powers = self.powers
            if longest > len(powers):
                powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(longest - 1, _STEP))), dtype=np.uint64)
                if longest <= CHUNK:
                    self.powers = powers
            value = _LOWER[data[a:b][at]].astype(np.uint64)
            value += np.uint64(1)
            value *= powers[place]
            out[n:upto] = np.add.reduceat(value, first)
            n = upto
        return _mix(out)

    def sets(self, texts: pa.Array) -> list[np.ndarray]:
        """For each text the sorted hashes of its distinct shingles; none for null and wordless texts."""
        texts = texts.cast(pa.large_binary())
        if texts.null_count:
            texts = texts.fill_null(b"")
        offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        inside = ~_SPACE[data]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        at = offsets[:-1][offsets[:-1] < len(data)]
        opens[at] = inside[at]  # a text's first word doesn't go on from the text before
        starts = np.flatnonzero(opens)
        if not len(starts):
            return [np.zeros(0, np.uint64)] * len(texts)
        words = self._words(data, inside, opens, starts)
        first = np.searchsorted(starts, offsets)
        n = len(words)
        if n >= WORDS:
            shingles = np.zeros(n - WORDS + 1, np.uint64)
            for j in range(WORDS):
                shingles += words[j : n - WORDS + 1 + j] * _PLACES[j]
            shingles = _mix(shingles)
        out = []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= WORDS:
                out.append(np.unique(shingles[a : b - WORDS + 1]))
            elif b > a:
                out.append(_mix((words[a:b] * _PLACES[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
            else:
                out.append(np.zeros(0, np.uint64))
        return out


def prefix_size(n: int) -> int:
    """Tokens of which two sets that link share one."""
    return n - -(-LEAST_SHARED * n // 100) + 1


def extended_size(n: int) -> int:
    """Tokens, the first in the order of hashes, of which two sets that link share as many as each one's plain prefix has.

    With overlap t, the first 2p - 1 tokens of the set whose extended prefix ends first hold at most n - t that the other
    lacks, and t >= n - p + 1: so p shared tokens, all of which the other's extended prefix reaches.
    """
    return 2 * prefix_size(n) - 1


def least_shared(n: int) -> int:
    """Tokens of the extended prefix that a set of n shares with any set that it links with.

    The other set's prefix may end first. For n >= 32 it still shares prefix_size(n), as the other has n * 5 / 4 at most;
    below, as many as the plain prefix of the smallest set that can link.
    """
    return prefix_size(n if n >= 32 else -(-LEAST_SHARED * n // 100))


def _least_shared(n: Column) -> Column:
    least = F.when(n >= 32, n).otherwise(F.ceil(n * LEAST_SHARED / 100))
    return least - F.ceil(least * LEAST_SHARED / 100) + 1


def _name(tokens: np.ndarray) -> int:
    """A set's name; 0 for the empty one."""
    return int(_mix(tokens * _PLACES[0]).sum(dtype=np.uint64).astype(np.int64)) if len(tokens) else 0


def _check(tokens: np.ndarray) -> int:
    """A second name, by another hash."""
    return int(_mix(tokens ^ _PLACES[1]).sum(dtype=np.uint64).astype(np.int64)) if len(tokens) else 0


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """BITS bits, one set for each token, as 64-bit words."""
    bits = np.zeros(BITS, bool)
    bits[(tokens >> np.uint64(53)).astype(np.int64)] = True
    return np.packbits(bits).view(np.uint64)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def named_sets(docs: DataFrame) -> DataFrame:
    """Of each text: doc_id, size and name (node, check) of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for piece in slices(batches, "text", TEXT_BYTES):
            sets = shingler.sets(piece.column(1))
            columns = [pa.array([f(x) for x in sets], pa.int64()) for f in (len, _name, _check)]
            yield pa.RecordBatch.from_arrays([piece.column(0), *columns], ["doc_id", "n", "node", "check"])

    return _texts(docs).mapInArrow(run, "doc_id long, n long, node long, check long")


def renamed_sets(sets: DataFrame) -> dict[tuple[int, int], int]:
    """New names for the sets that share a 64-bit name with another set, all but one of each name. With 10 ** 10 sets a
    handful is expected; as the result goes to every task, more than MOST_RENAMED names raise an error."""
    names = sets.filter("n > 0").groupBy("node").agg(F.min("check").alias("lo"), F.max("check").alias("hi")).filter("lo <> hi").select("node")
    names = names.limit(MOST_RENAMED + 1).collect()
    if not names:
        return {}
    if len(names) > MOST_RENAMED:
        raise RuntimeError("too many shingle sets share a 64-bit name")
    names = sets.sparkSession.createDataFrame(names, "node long")
    rows = sets.filter("n > 0").join(F.broadcast(names), "node").select("node", "check").distinct().orderBy("node", "check").collect()
    found: dict[tuple[int, int], int] = {}
    for before, row in zip(rows, rows[1:], strict=False):
        if before[0] == row[0]:
            found[row[0], row[1]] = int(_mix(np.array([row[0] ^ row[1]], np.int64).view(np.uint64)).view(np.int64)[0])
    return found


def token_marks(docs: DataFrame, renamed: dict[tuple[int, int], int]) -> DataFrame:
    """(token, node, info) of the tokens of extended prefixes. A token that several sets of a task's piece hold is counted for
    them at once, so that however frequent it is, a piece has one row of it. ``info``: the task, with so many counted tokens
    of the node times 2 ** 32; or -1 for a token that several sets hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen, part = Shingler(), set(), TaskContext.get().partitionId()
        tokens, nodes, size = [], [], 0

        def counted() -> pa.RecordBatch:
            t, v = np.concatenate(tokens), np.repeat(np.array(nodes, np.int64), list(map(len, tokens)))
            order = np.argsort(t, kind="stable")
            t, v = t[order], v[order]
            at = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
            many = np.diff(np.append(at, len(t))) > 1
            info = np.where(many, -1, part)
            held, n = np.unique(v[np.repeat(many, np.diff(np.append(at, len(t))))], return_counts=True)
            columns = np.concatenate((t[at].view(np.int64), held)), np.concatenate((v[at], held)), np.concatenate((info, part + (n.astype(np.int64) << 32)))
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "node", "info"])

        for piece in slices(batches, "text", TEXT_BYTES):
            for whole in shingler.sets(piece.column(1)):
                node = _name(whole)
                if renamed and (node, _check(whole)) in renamed:
                    node = renamed[node, _check(whole)]
                if not len(whole) or node in seen:
                    continue
                seen.add(node)
                tokens.append(whole[: extended_size(len(whole))].copy())
                nodes.append(node)
                size += len(tokens[-1])
            if size > HELD:
                yield counted()
                tokens, nodes, size = [], [], 0
        if tokens:
            yield counted()

    return _texts(docs).mapInArrow(run, "token long, node long, info long")


def shared_counts(marks: DataFrame) -> DataFrame:
    """(node, part, n_shared): how many tokens of its extended prefix, as a task read it, a node shares with another node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settled(tokens: np.ndarray, nodes: np.ndarray, info: np.ndarray) -> pa.RecordBatch:
            at = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
            shared = (np.minimum.reduceat(nodes, at) != np.maximum.reduceat(nodes, at)) | (np.minimum.reduceat(info, at) < 0)
            shared = np.repeat(shared, np.diff(np.append(at, len(tokens)))) & (info >= 0)
            n = info >> 32
            keep = shared | (n > 0)
            node, part, n = nodes[keep], info[keep] & 0xFFFFFFFF, np.maximum(n[keep], 1)
            order = np.lexsort((part, node))
            node, part, n = node[order], part[order], n[order]
            first = np.flatnonzero(np.concatenate((np.ones(min(1, len(node)), bool), (node[1:] != node[:-1]) | (part[1:] != part[:-1]))))
            total = np.add.reduceat(n, first) if len(first) else n
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (node[first], part[first], total)], ["node", "part", "n"])

        carried = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            rows = [np.concatenate((c, np.asarray(x))) for c, x in zip(carried, batch.columns, strict=True)]
            cut = int(np.searchsorted(rows[0], rows[0][-1])) if len(rows[0]) else 0  # the last token may go on
            carried = [x[cut:] for x in rows]
            if cut:
                yield settled(*(x[:cut] for x in rows))
        if len(carried[0]):
            yield settled(*carried)

    dealt = marks.repartition("token").sortWithinPartitions("token")
    return dealt.mapInArrow(run, "node long, part long, n long").groupBy("node", "part").agg(F.sum("n").alias("n_shared"))


def whole_sets(docs: DataFrame, needed: DataFrame, renamed: dict[tuple[int, int], int]) -> DataFrame:
    """(node, n, tokens) of the needed nodes (node, class_id), made from the text of the class's first document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for piece in slices(batches, "text", TEXT_BYTES):
            sets = shingler.sets(piece.column(1))
            names = [_name(x) for x in sets]
            if renamed:
                names = [renamed.get((k, _check(x)), k) for k, x in zip(names, sets, strict=True)]
            columns = [piece.column(0), pa.array(names, pa.int64()), pa.array(map(len, sets), pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "node", "n", "tokens"])

    rows = maybe_in(_texts(docs), needed.select(F.col("class_id").alias("doc_id")), "doc_id")
    made = rows.mapInArrow(run, "doc_id long, node long, n long, tokens binary").join(needed, "node").filter(F.col("doc_id").eqNullSafe(F.col("class_id")))
    return made.dropDuplicates(["node"]).select("node", "n", "tokens")


def frequent_tokens(whole: DataFrame) -> np.ndarray:
    """The tokens that most sets hold in their extended prefixes, by exact counts, the rarest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            tokens, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(n)], ["token", "n"])

        for batch in batches:
            for x in batch.column(0):
                tokens = np.frombuffer(x.as_buffer(), np.uint64)
                held.append(tokens[: extended_size(len(tokens))].copy())
                size += len(held[-1])
            if size > HELD:
                yield counted()
                held, size = [], 0
        if held:
            yield counted()

    found = whole.select("tokens").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).filter(F.col("n") >= IN_SETS)
    top = found.orderBy(F.desc("n"), "token").limit(FREQUENT).collect()
    return np.array([r[0] for r in reversed(top)], np.int64).view(np.uint64)


def signatures_of(whole: DataFrame, frequent: np.ndarray) -> DataFrame:
    """Of each set: node, size, bitmap, prefix in the common order (rare tokens by hash, then the frequent ones) and sketch."""
    by_value = np.argsort(frequent)
    known, rank = frequent[by_value], by_value

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps, prefixes, sketches = [], [], []
            for x in batch.column(2):
                tokens = np.frombuffer(x.as_buffer(), np.uint64)
                maps.append(bitmap(tokens).tobytes())
                sketches.append([int(_mix(tokens ^ _PLACES[i]).min().astype(np.int64)) for i in range(SKETCH)])
                if len(known):
                    at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
                    often = known[at] == tokens
                    if often.any():
                        tokens = np.concatenate((tokens[~often], tokens[often][np.argsort(rank[at[often]], kind="stable")]))
                prefixes.append(tokens[: prefix_size(len(tokens))].view(np.int64))
            columns = [batch.column(0), batch.column(1), pa.array(maps, pa.binary()), pa.array(prefixes, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["node", "n", "bitmap", "prefix", "sketch"])

    return whole.select("node", "n", "tokens").mapInArrow(run, "node long, n long, bitmap binary, prefix array<long>, sketch array<long>")


def token_groups(sets: DataFrame, column: str = "prefix") -> DataFrame:
    """(token, node, first, times) of the groups of nodes with a common token in an array column; ``first`` is the group's
    first node. Of groups with the same nodes one is kept, ``times`` says of how many.

    Rows are dealt out by ranges of (token, node), so that a frequent token spreads over tasks. Each such part of a group
    has a first node of its own; its runs at a task's ends are kept even if they are single.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried_t, carried_n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        fresh, going_on = True, None

        def rows(tokens: np.ndarray, nodes: np.ndarray, last: bool):
            nonlocal fresh
            new = np.ones(len(tokens), bool)
            new[1:] = (tokens[1:] != tokens[:-1]) | (nodes[1:] != nodes[:-1])
            tokens, nodes = tokens[new], nodes[new]
            at = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
            size = np.diff(np.concatenate((at, [len(tokens)])))
            part = np.zeros(len(at), bool)
            if fresh:
                part[0], fresh = True, False
            if tokens[0] == going_on:  # the rest of a run whose other nodes were handed on
                part[0] = True
            if last:
                part[-1] = True
            keep = (size > 1) | part
            firsts = nodes[at].copy()
            spread = nodes.view(np.uint64)
            names = [np.add.reduceat(_mix(x), at).view(np.int64) for x in (spread * _PLACES[2], spread ^ _PLACES[3])]
            names[0] = np.where(part, tokens[at], names[0])  # such a run is named by its token: it is but a part
            chosen = np.repeat(keep, size)
            columns = [tokens, nodes, *(np.repeat(x, size) for x in (firsts, *names, np.where(part, -1, size)))]
            return pa.RecordBatch.from_arrays([pa.array(c[chosen]) for c in columns], ["token", "node", "first", "name", "name2", "size"])

        for batch in batches:
            tokens = np.concatenate((carried_t, np.asarray(batch.column(0))))
            nodes = np.concatenate((carried_n, np.asarray(batch.column(1))))
            if not len(tokens):
                continue
            cut = int(np.searchsorted(tokens, tokens[-1]))  # the last run may go on
            whole = not cut and len(tokens) > LONGEST_RUN  # a run of its own: hand it on in parts
            if whole:
                cut = len(tokens)
            carried_t, carried_n = tokens[cut:], nodes[cut:]
            if cut:
                out = rows(tokens[:cut], nodes[:cut], whole)
                going_on = tokens[0] if whole else None
                yield out
        if len(carried_t):
            yield rows(carried_t, carried_n, True)

    spread = sets.select(F.explode(column).alias("token"), "node")
    found = spread.repartitionByRange("token", "node").sortWithinPartitions("token", "node")
    found = materialise(found.mapInArrow(run, "token long, node long, first long, name long, name2 long, size long"), "sig-runs")
    kept = found.filter("node = first").groupBy("name", "name2", "size").agg(F.min(F.struct("token", "first")).alias("kept"), F.count(F.lit(1)).alias("times"))
    kept = materialise(kept.select("kept.token", "kept.first", "times"), "sig-kept")
    groups = materialise(found.select("token", "node", "first").join(kept, ["token", "first"]).select("token", "node", "first", "times"), f"sig-groups-{column}")
    discard(found, kept)
    return groups


def _overlap_bound(x: np.ndarray, y: np.ndarray, more_x: np.ndarray, more_y: np.ndarray) -> np.ndarray:
    """The largest overlap of sets with these bitmaps; ``more``: tokens beyond the bits that they set."""
    return np.bitwise_count(x & y).sum(axis=1, dtype=np.int64) + np.minimum(more_x, more_y)


class SignatureTree:
    """Levels of a tree over sets, the members first: OR of the bitmaps, size range, tokens beyond bits, components."""

    def __init__(self, sizes: np.ndarray, maps: np.ndarray, comps: np.ndarray):
        more = sizes - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
        self.levels = [(maps, sizes, sizes, more, comps, comps)]
        while len(self.levels[-1][0]) > 1:
            m, lo, hi, more, c_lo, c_hi = self.levels[-1]
            at = np.arange(0, len(m), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(m, at, axis=0), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at), np.maximum.reduceat(more, at), np.minimum.reduceat(c_lo, at), np.maximum.reduceat(c_hi, at)))


def _possible(a: tuple, i: np.ndarray, b: tuple, j: np.ndarray) -> np.ndarray:
    """Whether members under a[i] and b[j] of different components can link."""
    lo_a, hi_a, lo_b, hi_b = a[1][i], a[2][i], b[1][j], b[2][j]
    ok = (100 * hi_b >= LEAST_SHARED * lo_a) & (100 * hi_a >= LEAST_SHARED * lo_b)
    ok &= (a[4][i] != b[5][j]) | (a[5][i] != b[4][j])
    most = np.minimum(np.minimum(hi_a, hi_b), _overlap_bound(a[0][i], b[0][j], a[3][i], b[3][j]))
    return ok & ((100 + LEAST_SHARED) * most >= LEAST_SHARED * (lo_a + lo_b))


def tree_join(a: SignatureTree, b: SignatureTree | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of members, of one tree or of two, that the dual traversal can't rule out."""
    same = b is None
    b = a if same else b
    depth = max(len(a.levels), len(b.levels)) - 1
    i = j = np.zeros(1, np.int64)
    for level in range(depth, -1, -1):
        own_a, own_b = min(level, len(a.levels) - 1), min(level, len(b.levels) - 1)
        x, y = a.levels[own_a], b.levels[own_b]
        if level < depth:  # to the children; a tree that is lower stays at its root
            step_a, step_b = own_a < min(level + 1, len(a.levels) - 1), own_b < min(level + 1, len(b.levels) - 1)
            da, db = (FANOUT if step_a else 1), (FANOUT if step_b else 1)
            i = np.repeat(i * da, da * db) + np.tile(np.repeat(np.arange(da), db), len(i))
            j = np.repeat(j * db, da * db) + np.tile(np.tile(np.arange(db), da), len(j))
            inside = (i < len(x[0])) & (j < len(y[0]))
            i, j = i[inside], j[inside]
            if same:
                ordered = i < j if level == 0 else i <= j
                i, j = i[ordered], j[ordered]
        elif same and level == 0:
            return i[:0], j[:0]
        keep = np.concatenate([_possible(x, i[k : k + 65536], y, j[k : k + 65536]) for k in range(0, len(i), 65536)]) if len(i) else np.zeros(0, bool)
        i, j = i[keep], j[keep]
    return i, j


def tree_pairs(members: DataFrame) -> DataFrame:
    """Candidate pairs (a, b) of different components within groups, and ``shared``, the groups that both are in.

    ``members``: token, times, node, comp, n, bitmap. Groups of more than BLOCK members are split into blocks by a hash; every
    pair of blocks is joined by itself.
    """
    sizes = materialise(members.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "sig-sizes")
    dealt = members.join(sizes, "token").withColumn("own", F.pmod(F.xxhash64("node", "token"), F.col("blocks")).cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("own", o).alias("i"), F.greatest("own", o).alias("j")))
    dealt = dealt.withColumn("cell", F.explode(others)).select("token", F.col("cell.i").alias("i"), F.col("cell.j").alias("j"), "own", "node", "comp", "n", "bitmap", "times")

    def join(rows: list[tuple]) -> tuple[list[int], list[int]]:
        parts = []
        for block in sorted({r[3] for r in rows}):
            own = sorted((r for r in rows if r[3] == block), key=lambda r: (r[5], r[6], r[7]))
            nodes, comps, sizes = (np.array([r[k] for r in own], np.int64) for k in (4, 5, 6))
            parts.append((nodes, SignatureTree(sizes, np.frombuffer(b"".join(r[7] for r in own), np.uint64).reshape(len(own), -1), comps)))
        if rows[0][1] != rows[0][2]:
            if len(parts) < 2:
                return [], []
            (na, a), (nb, b) = parts
            x, y = tree_join(a, b)
            return na[x].tolist(), nb[y].tolist()
        x, y = tree_join(parts[0][1])
        return parts[0][0][x].tolist(), parts[0][0][y].tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        left, right, times = [], [], []

        def add() -> None:
            a, b = join(held)
            left.extend(a), right.extend(b), times.extend([held[0][8]] * len(a))

        def out() -> pa.RecordBatch:
            a, b = np.array(left, np.int64), np.array(right, np.int64)
            pairs, at = np.unique(np.column_stack((np.minimum(a, b), np.maximum(a, b))), axis=0, return_inverse=True)
            n = np.bincount(at.ravel(), np.array(times, np.float64), len(pairs)).astype(np.int64)
            left.clear(), right.clear(), times.clear()
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(n)], ["a", "b", "shared"])

        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][:3] != r[:3]:
                    add()
                    held = []
                held.append(r)
            if len(left) > 50_000:
                yield out()
        if held:
            add()
        if left:
            yield out()

    cells = dealt.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    found = cells.mapInArrow(run, "a long, b long, shared long")
    return found.groupBy("a", "b").agg(F.sum("shared").alias("shared"))


def _share_enough(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """The pairs that can link with as many prefix tokens as they share.

    What two sets share beyond the end of the prefix that ends first is at most what the larger rest holds.
    """
    size = [signatures.select(F.col("node").alias(k), F.col("n").alias(f"n_{k}")) for k in "ab"]
    rest = [F.ceil(F.col(f"n_{k}") * LEAST_SHARED / 100) - 1 for k in "ab"]
    most = F.col("shared") + F.greatest(*rest)
    both = pairs.join(size[0], "a").join(size[1], "b")
    return both.filter((100 + LEAST_SHARED) * most >= LEAST_SHARED * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def _bounded(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """The pairs whose bitmaps and sizes allow a link."""
    left, right = (signatures.select(F.col("node").alias(k), F.col("n").alias(f"n_{k}"), F.col("bitmap").alias(f"m_{k}")) for k in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, na, nb = (np.asarray(batch.column(batch.schema.get_field_index(c))) for c in ("a", "b", "n_a", "n_b"))
            x, y = (np.frombuffer(b"".join(batch.column(batch.schema.get_field_index(c)).to_pylist()), np.uint64).reshape(len(a), -1) for c in ("m_a", "m_b"))
            more = [n - np.bitwise_count(m).sum(axis=1, dtype=np.int64) for n, m in ((na, x), (nb, y))]
            most = np.minimum(np.minimum(na, nb), _overlap_bound(x, y, *more))
            keep = (100 + LEAST_SHARED) * most >= LEAST_SHARED * (na + nb)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])

    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, signatures: DataFrame, whole: DataFrame) -> DataFrame:
    """The pairs that link, by their whole sets, written. Only the sets of pairs that pass the bitmaps are moved."""
    near = materialise(_bounded(pairs, signatures), "sig-near")
    left, right = (whole.select(F.col("node").alias(k), F.col("tokens").alias(f"t_{k}")) for k in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            sets_a, sets_b = (batch.column(batch.schema.get_field_index(c)) for c in ("t_a", "t_b"))
            for k in range(batch.num_rows):
                x, y = (np.frombuffer(c[k].as_buffer(), np.uint64) for c in (sets_a, sets_b))
                shared = len(x) + len(y) - len(np.unique(np.concatenate((x, y))))
                keep[k] = 100 * shared >= LEAST_SHARED * (len(x) + len(y) - shared)
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)).filter(pa.array(keep)) for c in "ab"], ["a", "b"])

    links = materialise(near.join(left, "a").join(right, "b").mapInArrow(run, "a long, b long"), "sig-links")
    discard(near)
    return links


def _labelled(groups: DataFrame, comps: DataFrame) -> DataFrame:
    """The groups' rows with their components, written."""
    return materialise(groups.join(comps, "node", "left").select("token", "node", "first", "times", F.coalesce("comp", "node").alias("comp")), "sig-labelled")


def _centres(labelled: DataFrame, signatures: DataFrame) -> DataFrame:
    """(token, centre, centre_comp) for groups of several components."""
    company = labelled.groupBy("node").agg(F.sum("times").alias("company"))
    prefix = F.col("n") - F.ceil(F.col("n") * LEAST_SHARED / 100) + 1
    share = materialise(company.join(signatures.select("node", "n"), "node").select("node", (F.col("company") / prefix).alias("share")), "sig-share")
    best = F.max(F.struct("share", "node", "comp"))
    spans = labelled.join(share, "node").groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), best.alias("best")).filter("lo <> hi")
    return spans.select("token", F.col("best.node").alias("centre"), F.col("best.comp").alias("centre_comp"))


def _linked(whole: DataFrame, signatures: DataFrame) -> DataFrame:
    """(node, comp) of the nodes that link with another, written."""
    groups = token_groups(signatures)
    sketched = token_groups(signatures, "sketch")
    stars = groups.unionByName(sketched).filter("node <> first").select(F.least("node", "first").alias("a"), F.greatest("node", "first").alias("b")).distinct()
    links = verified(stars, signatures, whole)
    comps = materialise(connected_components(links), "sig-comps")
    discard(sketched)

    # a second star from each group's most central node, that with most of its prefix in company: edits leave tokens alone
    labelled = _labelled(groups, comps)
    central = materialise(_centres(labelled, signatures), "sig-centres")
    if not central.isEmpty():
        again = labelled.join(central, "token").filter("comp <> centre_comp")
        again = again.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
        comps = joined_up(comps, verified(again, signatures, whole))
        discard(labelled, central)
        labelled = _labelled(groups, comps)
    # a group of two in one part has had its one pair verified
    spans = labelled.groupBy("token").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("first").alias("f0"), F.max("first").alias("f1"), F.count(F.lit(1)).alias("size")
    )
    open_groups = materialise(spans.filter("lo <> hi and (size > 2 or f0 <> f1)").select("token"), "sig-open")
    if open_groups.isEmpty():
        return comps
    members = labelled.join(open_groups, "token").join(signatures.select("node", "n", "bitmap"), "node").select("token", "times", "node", "comp", "n", "bitmap")
    members = materialise(members, "sig-members")
    met = materialise(tree_pairs(members), "sig-met")
    pairs = materialise(_share_enough(met, signatures), "sig-pairs")
    discard(members, labelled, groups, met)
    return joined_up(comps, verified(pairs, signatures, whole))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Components of texts whose shingle sets reach the Jaccard similarity.

    ``docs`` has doc_id and text; other columns are ignored, whatever their names. Words are what white space separates,
    A-Z in lower case; a text of fewer than WORDS words has its whole sequence as one shingle, and a null, empty or
    wordless text has none and links with nothing: it is its own component. Rows that repeat an id or a text are nodes
    of one set. A row without an id takes part in its component and counts as no id; if no row of it has one, its
    component_id is null. An empty table gives an empty result.

    Returns doc_id, n_shingles, component_id (the smallest doc_id reachable by links) and class_id (the smallest doc_id
    of the same set).
    """
    sets = materialise(named_sets(docs), "sig-sets")
    renamed = renamed_sets(sets)
    if renamed:
        names = docs.sparkSession.createDataFrame([(*k, v) for k, v in renamed.items()], "node long, check long, new long")
        sets = materialise(sets.join(F.broadcast(names), ["node", "check"], "left").withColumn("node", F.coalesce("new", "node")).drop("new"), "sig-sets")
    classes = materialise(sets.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("class_id"), F.first("n").alias("n")), "sig-classes")

    # the nodes that may link: a node that shares too little with all others is its own component
    counts = materialise(shared_counts(token_marks(docs, renamed)).join(classes, "node").filter(F.col("n_shared") >= _least_shared(F.col("n"))), "sig-counts")
    release(docs.sparkSession)
    needed = materialise(counts.select("node", "class_id").distinct(), "sig-needed")
    if needed.isEmpty():
        comps = docs.sparkSession.createDataFrame([], "node long, comp long")
    else:
        whole = materialise(whole_sets(docs, needed, renamed), "sig-whole", "lz4")
        signatures = materialise(signatures_of(whole, frequent_tokens(whole)), "sig-signatures", "lz4")
        comps = _linked(whole, signatures)
        discard(signatures, whole)
    discard(counts, needed)
    named = materialise(classes.join(comps, "node", "left").select("node", "class_id", F.coalesce("comp", "node").alias("comp")), "sig-named")
    lowest = materialise(named.groupBy("comp").agg(F.min("class_id").alias("component_id")), "sig-lowest")
    final = materialise(named.join(lowest, "comp").select("node", "class_id", "component_id"), "sig-final")
    ids = materialise(sets.select("doc_id", "n", "node"), "sig-ids")
    discard(sets)
    with_words = ids.filter("n > 0").join(final, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "class_id")
    without = ids.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.col("doc_id").alias("class_id"))
    return with_words.unionByName(without)


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all their columns, one for each component of near duplicates.

    ``docs`` has doc_id and text and any other columns, whatever their names. The row of the smallest id stays; one without
    an id only if the component has none, and of rows that share the id one, chosen by a hash of the row. Every row is
    decided by itself: other rows of its id may stay. Texts are not shuffled but those of the rows that go.
    """
    rows = numbered(docs, "near-rows")
    found = near_duplicates(rows.select(F.col("number").alias("doc_id"), F.col("row.text").alias("text")))
    found = materialise(found.select(F.col("doc_id").alias("number"), "component_id"), "near-found")
    groups = materialise(found.groupBy("component_id").count().filter(F.col("count") > 1).select("component_id"), "near-groups")
    members = found.join(groups, "component_id").join(rows.select("number", F.col("row.doc_id").alias("id"), F.xxhash64(F.to_json("row")).alias("tie")), "number")
    members = materialise(members, "near-members")
    kept = members.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "tie", "number"))["number"].alias("number"))
    dropped = materialise(members.select("number").join(kept.select("number"), "number", "left_anti"), "near-dropped")
    return without(rows, dropped, "number").select("row.*")

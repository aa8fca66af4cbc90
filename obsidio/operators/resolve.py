"""Entity resolution: Fellegi-Sunter scores, components, constrained clusters and stable ids."""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

#: Iterations of expectation maximisation; fixed, so that results can be repeated.
ROUNDS = 20


@dataclass
class Weights:
    """Match and random probabilities of each comparison level, and the share of matches among pairs."""

    m: list[list[float]]
    u: list[list[float]]
    prior: float


def fit_weights(patterns: Sequence[tuple[tuple[int, ...], int]], levels: Sequence[int], prior: float = 0.05, fixed_m: dict[int, list[float]] | None = None) -> Weights:
    """Expectation maximisation over counts of distinct comparison patterns, of which there are few however many pairs.

    ``levels`` are the numbers of levels; level 0 is no agreement, and higher is closer. Comparisons in ``fixed_m`` keep
    their match probabilities.
    """
    fixed_m = fixed_m or {}
    g = np.array([p for p, _ in patterns]).reshape(-1, len(levels))
    n = np.array([float(c) for _, c in patterns])
    m = [np.array(fixed_m[i]) if i in fixed_m else np.linspace(1, 4, k) / np.linspace(1, 4, k).sum() for i, k in enumerate(levels)]
    u = [np.array([n[g[:, i] == v].sum() + 1 for v in range(k)]) for i, k in enumerate(levels)]
    u = [x / x.sum() for x in u]
    for _ in range(ROUNDS):
        like_m = prior * np.prod([m[i][g[:, i]] for i in range(len(levels))], axis=0)
        like_u = (1 - prior) * np.prod([u[i][g[:, i]] for i in range(len(levels))], axis=0)
        p = like_m / np.maximum(like_m + like_u, 1e-300)
        prior = float((p * n).sum() / n.sum())
        for i, k in enumerate(levels):
            if i not in fixed_m:
                m[i] = np.array([(p * n)[g[:, i] == v].sum() + 1e-6 for v in range(k)])
                m[i] /= m[i].sum()
            u[i] = np.array([((1 - p) * n)[g[:, i] == v].sum() + 1e-6 for v in range(k)])
            u[i] /= u[i].sum()
    return Weights([x.tolist() for x in m], [x.tolist() for x in u], prior)


def match_scores(pairs: DataFrame, gammas: Sequence[str], levels: Sequence[int], fixed_m: dict[int, list[float]] | None = None) -> DataFrame:
    """``pairs`` with match_weight, the log2 Bayes factor, and match_prob. Only counts of patterns reach the driver."""
    counts = [(tuple(r[: len(gammas)]), r[-1]) for r in pairs.groupBy(*gammas).count().orderBy(*gammas).collect()]
    w = fit_weights(counts, levels, fixed_m=fixed_m)
    weight = F.lit(math.log2(max(w.prior, 1e-12) / max(1 - w.prior, 1e-12)))
    for i, c in enumerate(gammas):
        part = F.lit(0.0)
        for v in range(levels[i]):
            part = F.when(F.col(c) == v, F.lit(math.log2(max(w.m[i][v], 1e-12) / max(w.u[i][v], 1e-12)))).otherwise(part)
        weight = weight + part
    return pairs.withColumn("match_weight", weight).withColumn("match_prob", 1 / (1 + F.pow(F.lit(2.0), -F.col("match_weight"))))


def name_levels(names: Sequence[str | None]) -> list[np.ndarray]:
    """Of each of some distinct names the places of those that share a word with it, itself included; null shares none."""
    by_word: dict[str, list[int]] = {}
    for i, name in enumerate(names):
        for w in set(name.split(" ")) if name is not None else ():
            by_word.setdefault(w, []).append(i)
    return [np.unique(np.concatenate([by_word[w] for w in set(name.split(" "))])) if name is not None else np.array([], dtype=int) for name in names]


def count_levels(names: np.ndarray, brands: np.ndarray, sizes: np.ndarray, near: float) -> np.ndarray:
    """For each row how many other rows compare with it by each pattern (name 0 to 2, brand, size): rows x 3 x 2 x 2.

    Name 2 is the same one, 1 a shared word; sizes agree up to ``near``. A null agrees with nothing. No pair is made: rows
    of a name and of the names that share its words are summed by brand and size.
    """
    code, distinct = pd.factorize(names, use_na_sentinel=False)
    b, kinds = pd.factorize(brands)
    known = ~np.isnan(sizes)
    steps = np.unique(sizes[known])
    at = np.where(known, np.searchsorted(steps, sizes), len(steps))
    lo, hi = np.searchsorted(steps, sizes - near), np.where(known, np.searchsorted(steps, sizes + near, "right"), 0)
    lo = np.where(known, lo, 0)
    shape = (len(kinds) + 1, len(steps) + 2)  # a last line for no brand, a first column for sums up to nothing, a last for no size
    rows_of = np.split(np.argsort(code, kind="stable"), np.cumsum(np.bincount(code, minlength=len(distinct)))[:-1])

    def sums(rows: np.ndarray) -> np.ndarray:
        table = np.bincount(b[rows] % shape[0] * shape[1] + at[rows] + 1, minlength=shape[0] * shape[1]).reshape(shape)
        return table.cumsum(axis=1)

    def boxes(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
        own, total = np.where(b[rows, None] >= 0, table[b[rows]], 0), table.sum(axis=0)
        pick = np.arange(len(rows))
        both, brand = own[pick, hi[rows]] - own[pick, lo[rows]], own[:, -1]
        size = total[hi[rows]] - total[lo[rows]]
        return np.stack([total[-1] - brand - size + both, size - both, brand - both, both], axis=1)

    out, everything = np.zeros((len(names), 3, 4), dtype=np.int64), sums(np.arange(len(names)))
    plain = [None if pd.isna(x) else x for x in distinct]
    for i, alike in enumerate(name_levels(plain)):
        rows = rows_of[i]
        shared = boxes(sums(np.concatenate([rows_of[j] for j in alike])), rows) if len(alike) else 0
        same = boxes(sums(rows), rows) if plain[i] is not None else 0
        out[rows, 0], out[rows, 1], out[rows, 2] = boxes(everything, rows) - shared, shared - same, same
        out[rows, 0 if plain[i] is None else 2, 2 * (b[rows] >= 0) + known[rows]] -= 1  # a row with itself
    return out.reshape(len(names), 3, 2, 2)


def pattern_weights(patterns: Sequence[tuple[tuple[int, ...], int]], levels: Sequence[int], fixed_m: dict[int, list[float]] | None = None) -> list[float]:
    """The log2 Bayes factor of each pattern, fitted on their counts."""
    w = fit_weights(patterns, levels, fixed_m=fixed_m)
    log = lambda m, u: math.log2(max(m, 1e-12) / max(u, 1e-12))
    return [log(w.prior, 1 - w.prior) + sum(log(w.m[i][v], w.u[i][v]) for i, v in enumerate(p)) for p, _ in patterns]


def components(edges: DataFrame, checkpoint: Callable[[DataFrame], DataFrame], a: str = "a", b: str = "b") -> DataFrame:
    """Smallest reachable node of each linked node, by passing labels and jumping: (node, comp).

    ``checkpoint`` writes a round's labels and gives them back, so that plans don't grow.
    """
    both = checkpoint(edges.select(F.col(a).alias("x"), F.col(b).alias("y")).unionByName(edges.select(F.col(b).alias("x"), F.col(a).alias("y"))).distinct())
    labels = checkpoint(both.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.col("node")).alias("comp")))
    while True:
        near = both.join(labels, F.col("y") == F.col("node")).groupBy("x").agg(F.min("comp").alias("near"))
        step = labels.join(near, F.col("node") == F.col("x")).select("node", F.least("comp", "near").alias("comp"))
        jump = step.select(F.col("node").alias("comp"), F.col("comp").alias("far"))
        after = checkpoint(step.join(jump, "comp", "left").select("node", F.least("comp", F.coalesce("far", "comp")).alias("comp"), F.col("comp").alias("was")))
        moved = after.join(labels.select("node", F.col("comp").alias("old")), "node").filter("comp <> old").limit(1).count()
        labels = after.select("node", "comp")
        if not moved:
            return labels


def haversine(a: tuple[float, float], b: tuple[float, float]) -> float:
    """Metres between two (lat, lon)."""
    la, lb = math.radians(a[0]), math.radians(b[0])
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6_371_000 * math.asin(min(1.0, math.sqrt(h)))


def greedy_clusters(edges: Sequence[tuple], kinds: dict, places: dict, exclusive: set, span: float) -> dict:
    """Clusters by joining the strongest links first, unless the union would hold an exclusive kind twice or span too far.

    ``edges`` are (a, b, p). Ties go by the ends, so that the result depends on no order. Gives the smallest member of each
    node's cluster.
    """
    cluster = {x: x for e in edges for x in e[:2]}
    members = {x: [x] for x in cluster}
    for a, b, _ in sorted(edges, key=lambda e: (-e[2], e[0], e[1])):
        ra, rb = cluster[a], cluster[b]
        if ra == rb:
            continue
        both = Counter(kinds[x] for x in members[ra] + members[rb])
        if any(both[k] > 1 for k in exclusive):
            continue
        if any(haversine(places[x], places[y]) > span for x in members[ra] for y in members[rb]):
            continue
        keep, gone = min(ra, rb), max(ra, rb)
        for x in members[gone]:
            cluster[x] = keep
        members[keep] += members.pop(gone)
    return cluster


def far_bits(points: np.ndarray, span: float) -> list[int]:
    """Of each of some (lat, lon) the points that are farther than ``span`` from it, as the bits of a number."""
    lat, lon, out = np.radians(points[:, 0]), points[:, 1], []
    for i, at in enumerate(points):
        h = np.sin((lat - lat[i]) / 2) ** 2 + np.cos(lat[i]) * np.cos(lat) * np.sin(np.radians(lon - at[1]) / 2) ** 2
        d = 2 * 6_371_000 * np.arcsin(np.minimum(1.0, np.sqrt(h)))
        far = ~(d <= span)
        for j in np.flatnonzero(np.abs(d - span) < 0.01):  # as the other function rounds
            far[j] = haversine(tuple(at), tuple(points[j])) > span
        out.append(int.from_bytes(np.packbits(far, bitorder="little").tobytes(), "little"))
    return out


def greedy_cells(links: Sequence[tuple[Sequence[Sequence], Sequence[Sequence]]], kinds: Sequence, places: Sequence[tuple[float, float]], exclusive: set, span: float) -> list[int]:
    """``greedy_clusters`` without a list of links, for nodes 0 to n - 1 that link where their cells meet.

    ``links`` has (own, seen) for each strength, the strongest first: of each node the cells that it lies in, and those whose
    other nodes it links with. Links go both ways. Gives the smallest member of each node's cluster; -1 for a node without
    a link.

    A union that is refused once is refused for ever, as clusters only grow. So each cell keeps its nodes apart by the
    exclusive kinds of their clusters, and a node looks only at those whose kinds it lacks: a node moves once for each
    kind that its cluster gains, and pairs of one kind are never looked at. Distances are of distinct places, with a bit
    for each two of them.
    """
    n = len(kinds)
    bit = {k: 1 << i for i, k in enumerate(sorted(exclusive))}
    points, at = np.unique(np.array(places, dtype=float).reshape(n, 2), axis=0, return_inverse=True)
    apart, at = far_bits(points, span), at.ravel().tolist()
    root, members = list(range(n)), [[i] for i in range(n)]
    mask, spots, far = [bit.get(k, 0) for k in kinds], [1 << p for p in at], [apart[p] for p in at]
    linked = [False] * n
    for own, seen in links:
        cells: dict = {}
        for i in range(n):
            for c in own[i]:
                cells.setdefault(c, {}).setdefault(mask[root[i]], []).append(i)
        sizes = {c: sum(map(len, held.values())) for c, held in cells.items()}
        for a in range(n):
            linked[a] = linked[a] or any(sizes.get(c, 0) > (c in own[a]) for c in seen[a])
            last = a
            while True:
                r = root[a]
                lacks, away, best = mask[r], far[r], n
                for c in seen[a]:
                    for kind, held in cells.get(c, {}).items():
                        if kind & lacks or not held or held[-1] <= last:
                            continue
                        for j in range(bisect_right(held, last), len(held)):
                            b = held[j]
                            if b >= best:
                                break
                            s = root[b]
                            if s != r and not away & spots[s]:
                                best = b
                                break
                if best == n:
                    break
                last, s = best, root[best]
                both = mask[r] | mask[s]
                for side in (r, s):
                    was = mask[side]
                    if was != both:
                        for x in members[side]:
                            if x > a:  # nodes up to a are not looked at again
                                for c in own[x]:
                                    del cells[c][was][bisect_left(cells[c][was], x)]
                                    insort(cells[c].setdefault(both, []), x)
                keep, gone = (r, s) if len(members[r]) >= len(members[s]) else (s, r)
                for x in members[gone]:
                    root[x] = keep
                members[keep] += members[gone]
                mask[keep], spots[keep], far[keep] = both, spots[r] | spots[s], far[r] | far[s]
                members[gone] = []
    least = [min(m, default=-1) for m in members]
    return [least[r] if known else -1 for r, known in zip(root, linked, strict=True)]


def constrained_clusters(edges: DataFrame, nodes: DataFrame, comps: DataFrame, exclusive: Sequence[str], span: float) -> DataFrame:
    """``greedy_clusters`` within each component, which the constraints never leave: (node, cluster).

    ``edges``: a, b, p; ``nodes``: node, kind, lat, lon; ``comps``: node, comp. A component is one task's work.
    """
    ends = [nodes.select(F.col("node").alias(e), F.col("kind").alias(f"kind_{e}"), F.col("lat").alias(f"lat_{e}"), F.col("lon").alias(f"lon_{e}")) for e in ("a", "b")]
    full = edges.join(ends[0], "a").join(ends[1], "b").join(comps.select(F.col("node").alias("a"), "comp"), "a")
    only = set(exclusive)

    def run(part: pd.DataFrame) -> pd.DataFrame:
        kinds, places = {}, {}
        for e in ("a", "b"):
            for x, k, la, lo in part[[e, f"kind_{e}", f"lat_{e}", f"lon_{e}"]].itertuples(index=False):
                kinds[x], places[x] = k, (la, lo)
        found = greedy_clusters(list(part[["a", "b", "p"]].itertuples(index=False)), kinds, places, only, span)
        return pd.DataFrame(sorted(found.items()), columns=["node", "cluster"])

    return full.groupBy("comp").applyInPandas(run, "node long, cluster long")


def stable_ids(previous: DataFrame, clusters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Carry ids over from a run to the next, and the changes.

    ``previous``: key, business_id; ``clusters``: key, cluster. An id goes to the cluster that holds most of its keys, ties
    to the larger cluster, then by name; a cluster takes the id that brings it most keys. Clusters without one get a new id from their
    first key. Changes: create, merge (an id whose keys now belong to another), split and move.
    """
    from pyspark.sql import Window

    size = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.min("key").alias("first"))
    votes = clusters.join(previous, "key").groupBy("cluster", "business_id").agg(F.count(F.lit(1)).alias("votes")).join(size, "cluster")
    by_id = Window.partitionBy("business_id").orderBy(F.desc("votes"), F.desc("size"), "cluster")
    by_cluster = Window.partitionBy("cluster").orderBy(F.desc("votes"), "business_id")
    claims = votes.withColumn("r", F.row_number().over(by_id)).filter("r = 1").withColumn("r", F.row_number().over(by_cluster)).filter("r = 1")
    named = size.join(claims.select("cluster", "business_id"), "cluster", "left")
    named = named.withColumn("is_new", F.col("business_id").isNull()).withColumn("business_id", F.coalesce("business_id", F.concat(F.lit("b:"), F.md5(F.col("first").cast("string")))))
    ledger = clusters.join(named.select("cluster", "business_id", "is_new"), "cluster").select("key", "business_id", "is_new")
    moved = ledger.join(previous.select("key", F.col("business_id").alias("old_id")), "key", "left")
    kept = ledger.select(F.col("business_id").alias("old_id")).distinct().withColumn("alive", F.lit(True))
    kind = (
        F.when(F.col("old_id").isNull() & F.col("is_new"), "create").when(F.col("old_id").isNull(), "add").when(F.col("old_id") == F.col("business_id"), "keep")
        .when(F.col("alive").isNull(), "merge").when(F.col("is_new"), "split").otherwise("move")
    )
    changes = moved.join(kept, "old_id", "left").select("key", "old_id", "business_id", kind.alias("kind"))
    return ledger.select("key", "business_id"), changes

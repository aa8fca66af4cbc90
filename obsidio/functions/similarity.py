"""String similarity on columns: Jaro-Winkler, token ratios and keyed digests, as pandas UDFs.

Spark has none of these. Callers compare distinct pairs only, so that each pair is worked out once.
"""

from __future__ import annotations

import hashlib
import hmac
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, functions as F


def jaro(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken = [False] * len(b)
    hits = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                hits.append(c)
                break
    if not hits:
        return 0.0
    other = [b[j] for j in range(len(b)) if taken[j]]
    swaps = sum(x != y for x, y in zip(hits, other, strict=True)) // 2
    m = len(hits)
    return (m / len(a) + m / len(b) + (m - swaps) / m) / 3


def winkler(a: str, b: str) -> float:
    """Jaro-Winkler: a common prefix of up to four letters counts a tenth each, for similarities over 0.7."""
    s = jaro(a, b)
    if s <= 0.7:
        return s
    prefix = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        prefix += 1
    return s + prefix * 0.1 * (1 - s)


def indel_ratio(a: str, b: str) -> float:
    """100 * (1 - insertions and deletions / both lengths)."""
    if not a and not b:
        return 100.0
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return 200.0 * row[-1] / (len(a) + len(b))


def token_set_ratio(a: str, b: str) -> float:
    """The best ratio among the common words and these with either rest; 100 where one side's words are all in the other."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    common = " ".join(sorted(x & y))
    if common and (not x - y or not y - x):
        return 100.0
    one = f"{common} {' '.join(sorted(x - y))}".strip()
    two = f"{common} {' '.join(sorted(y - x))}".strip()
    best = indel_ratio(one, two)
    return max(best, indel_ratio(common, one), indel_ratio(common, two)) if common else best


def token_sort_ratio(a: str, b: str) -> float:
    return indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def _pairwise(f: Callable[[str, str], float], a: Column | str, b: Column | str) -> Column:
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else float(f(p, q)) for p, q in zip(x, y, strict=True)], dtype="float64")

    run.__annotations__ = {"x": pd.Series, "y": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "double")(a, b)


def jaro_winkler(a: Column | str, b: Column | str) -> Column:
    return _pairwise(winkler, a, b)


def token_set(a: Column | str, b: Column | str) -> Column:
    return _pairwise(token_set_ratio, a, b)


def token_sort(a: Column | str, b: Column | str) -> Column:
    return _pairwise(token_sort_ratio, a, b)


def ratio(a: Column | str, b: Column | str) -> Column:
    return _pairwise(indel_ratio, a, b)


def pseudonym(value: Column, namespace: str, salt: str) -> Column:
    """A keyed digest that stays the same for a salt: h: and 32 hex digits of HMAC-SHA256. An empty salt is refused."""
    if not salt:
        raise ValueError("a salt is needed")
    key = salt.encode()

    def run(x: pd.Series) -> pd.Series:
        return x.map(lambda s: None if s is None else "h:" + hmac.new(key, f"{namespace}:{s}".encode(), hashlib.sha256).hexdigest()[:32])

    run.__annotations__ = {"x": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "string")(value)

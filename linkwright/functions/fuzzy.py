"""String similarities that need an alignment: plain cores and one Arrow-batched column function."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


def common(a: str, b: str) -> int:
    """Length of the longest common subsequence, with a row of the table as bits of one integer."""
    if len(a) > len(b):
        a, b = b, a
    at: dict[str, int] = {}
    for i, ch in enumerate(a):
        at[ch] = at.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        m = row & at.get(ch, 0)
        row = (row + m | row - m) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """2 * common subsequence / total length; 1 for two empty strings."""
    n = len(a) + len(b)
    return 2 * common(a, b) / n if n else 1.0


def token_sort(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    """1 if one token set holds the other; else the best ratio among the common part and each side's."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, dx, dy = x & y, " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not dx or not dy):
        return 1.0
    s = len(" ".join(sorted(both)))
    gap = 1 if both else 0
    nx, ny = s + gap + len(dx), s + gap + len(dy)
    best = 1 - (len(dx) + len(dy) - 2 * common(dx, dy)) / (nx + ny) if nx + ny else 0.0
    if both:
        best = max(best, 1 - (gap + len(dx)) / (s + nx), 1 - (gap + len(dy)) / (s + ny))
    return best


def partial(a: str, b: str) -> float:
    """The best ratio of the shorter string against a window of the longer one, cut off at its ends too."""

    def against(short: str, long: str) -> float:
        n, best = len(short), 0.0
        chars = set(short)
        for start in range(1 - n, len(long)):
            window = long[max(0, start) : start + n]
            # a window can't be best unless it begins and ends with a character of the short string
            if not window or (start >= 0 and window[0] not in chars and start + n <= len(long)):
                continue
            if 2 * len(window) / (n + len(window)) > best:
                best = max(best, ratio(short, window))
                if best == 1.0:
                    break
        return best

    if not a or not b:
        return 1.0 if a == b else 0.0
    if len(a) == len(b):
        return max(against(a, b), against(b, a))
    return against(a, b) if len(a) < len(b) else against(b, a)


def jaro(a: str, b: str) -> float:
    if a == b:
        return 1.0
    reach = max(len(a), len(b)) // 2 - 1
    used = [False] * len(b)
    left = []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == ch:
                used[j] = True
                left.append(ch)
                break
    m = len(left)
    if not m:
        return 0.0
    right = [ch for ch, u in zip(b, used, strict=True) if u]
    swaps = sum(x != y for x, y in zip(left, right, strict=True)) // 2
    return (m / len(a) + m / len(b) + (m - swaps) / m) / 3


def jaro_winkler(a: str, b: str) -> float:
    """Jaro, raised by 0.1 of the rest per common leading character (four at most) if over 0.7."""
    j = jaro(a, b)
    if j <= 0.7:
        return j
    n = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        n += 1
    return j + 0.1 * n * (1 - j)


MEASURES: dict[str, Callable[[str, str], float]] = {
    "ratio": ratio, "token_sort": token_sort, "token_set": token_set, "partial": partial, "jaro_winkler": jaro_winkler,
}


def similarities(wanted: list[tuple[str, str]], columns: dict[str, tuple[Column, Column]]) -> Column:
    """A struct of fields ``<pair>_<measure>`` for pairs of text columns, in one trip to Python.

    A null or empty side gives null.  Equal pairs of texts in an Arrow batch are
    measured once.
    """
    names = list(columns)
    kind = StructType([StructField(f"{p}_{m}", DoubleType()) for p, m in wanted])

    @F.pandas_udf(kind)
    def measured(*series: pd.Series) -> pd.DataFrame:
        out = {}
        for p, m in wanted:
            f, seen, k = MEASURES[m], {}, 2 * names.index(p)
            vals = []
            for ab in zip(series[k], series[k + 1], strict=True):
                if ab not in seen:
                    seen[ab] = f(*ab) if ab[0] and ab[1] else None
                vals.append(seen[ab])
            out[f"{p}_{m}"] = pd.Series(vals, dtype="float64")
        return pd.DataFrame(out)

    return measured(*[c for p in names for c in columns[p]])

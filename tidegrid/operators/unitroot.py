"""The augmented Dickey-Fuller test: changes on the level before them and on their own lags.

The number of lags is chosen by AIC on equal rows, then the test is made on all rows that number
leaves. Sums of products of two lagged changes depend on the distance of the lags only, up to a few
rows at both ends of a series. So the JVM sums one product per distance, and every matrix, for any
number of lags and any first row, follows from these sums and the values at the ends.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.operators.windows import lagged
from tidegrid.session import saved
from tidegrid.spec import Spec

# MacKinnon's response surfaces for the test with a constant. Polynomials of the
# statistic whose normal probability is p, below and above a turning point; outside the range p is 0
# or 1. Critical values by share are polynomials of one over the number of rows.
P_SMALL, P_LARGE = (2.1659, 1.4412, 0.038269), (1.7339, 0.93202, -0.12745, -0.010368)
P_TURN, P_LEAST, P_MOST = -1.61, -18.83, 2.74
CRITICAL = {
    "critical_1": (-3.43035, -6.5393, -16.786, -79.433),
    "critical_5": (-2.86154, -2.8903, -4.234, -40.040),
    "critical_10": (-2.56677, -1.5384, -2.809, 0.0),
}


def p_value(stat: float) -> float:
    """Approximate probability of a statistic this low when there is a unit root."""
    if stat <= P_LEAST or stat >= P_MOST:
        return float(stat > P_LEAST)
    weights = P_SMALL if stat <= P_TURN else P_LARGE
    return 0.5 * math.erfc(-sum(w * stat**k for k, w in enumerate(weights)) / math.sqrt(2))


def most_lags(n: int) -> int:
    """The usual bound on the number of lags for ``n`` rows; below 0 there are too few for a test."""
    return min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2)


def _gram(n: int, lags: int, first: int, s: np.ndarray, c: np.ndarray, level: tuple[float, float], head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """Sums of products of (1, level before, change 1 .. ``lags`` rows before, change) from row ``first`` on.

    ``s[k]`` and ``c[k]`` are sums over the whole series of a change, and of the level before it,
    times the change ``k`` rows earlier; ``head`` and ``tail`` are the first and last values.
    """

    def y(t: int) -> float:
        return head[t] if t < len(head) else tail[t - n + len(tail)]

    def d(t: int) -> float:
        return y(t) - y(t - 1)

    out = np.zeros((lags + 3, lags + 3))
    order = [*range(1, lags + 1), 0]  # the change itself comes last
    early = range(1, first)
    out[0, 0] = n - first
    out[0, 1] = level[0] - sum(y(t - 1) for t in early)
    out[1, 1] = level[1] - sum(y(t - 1) ** 2 for t in early)
    for a, i in enumerate(order):
        out[0, 2 + a] = y(n - 1 - i) - y(first - 1 - i)
        out[1, 2 + a] = c[i] - sum(y(t - 1) * d(t - i) for t in range(i + 1, first))
        for b in range(a, len(order)):
            low, high = sorted((i, order[b]))
            k = high - low
            out[2 + a, 2 + b] = (
                s[k] - sum(d(u) * d(u - k) for u in range(k + 1, first - low)) - sum(d(u) * d(u - k) for u in range(n - low, n))
            )
    return out + np.triu(out, 1).T


def _fit(gram: np.ndarray, lags: int) -> tuple[float, float]:
    """Residual sum of squares with ``lags`` of its lags, and the statistic of the level."""
    keep = [0, 1, *range(2, 2 + lags)]
    x, xy, yy = gram[np.ix_(keep, keep)], gram[keep, -1], gram[-1, -1]
    # in the scale of the columns, so that level and changes weigh alike
    scale = np.sqrt(np.maximum(np.diag(x), 1e-300))
    inverse = np.linalg.pinv(x / np.outer(scale, scale), hermitian=True) / np.outer(scale, scale)
    b = inverse @ xy
    rss = max(float(yy - b @ xy), 0.0)
    free = gram[0, 0] - len(keep)
    error = math.sqrt(rss / free * inverse[1, 1]) if free > 0 and inverse[1, 1] > 0 else 0.0
    return rss, b[1] / error if error > 0 else math.nan


def _tested(n: int, most: int, s, c, level, head, tail) -> tuple[int, int, float] | None:
    lags = min(most_lags(n), most)
    if lags < 0 or s[0] <= 0:
        return None
    gram = _gram(n, lags, lags + 1, s, c, level, head, tail)
    rows = gram[0, 0]
    best, chosen = math.inf, 0
    for k in range(lags + 1):
        rss, _ = _fit(gram, k)
        aic = rows * math.log(max(rss, 1e-300) / rows) + 2 * (k + 2)
        if aic < best:
            best, chosen = aic, k
    final = _gram(n, chosen, chosen + 1, s, c, level, head, tail)
    return chosen, int(final[0, 0]), _fit(final, chosen)[1]


def stationarity_lagged(regular: DataFrame, spec: Spec, most: int | None = None) -> DataFrame:
    """Augmented Dickey-Fuller test with a constant: lags, rows used, statistic, p and critical values.

    ``regular`` has a value at every position. ``most`` bounds the number of lags; by default the usual
    bound for a series' length does. Stationary means p of at most 0.05. A constant series, or one too short for the test, has NULLs.
    """
    table = saved(regular.select("series_id", "pos", "n", "value"))
    if most is None:
        longest = table.agg(F.max("n")).first()[0] or 0
        most = max(most_lags(longest), 0)
    one = lagged(table, "value", list(range(1, most + 2)), spec)

    def lag(k: int):
        return F.col(f"value_lag{k}") if k else F.col("value")

    change = lag(0) - lag(1)
    distances = range(most + 1)
    ends = [F.when(F.col("pos") <= most + 1, F.struct("pos", "value")), F.when(F.col("pos") >= F.col("n") - 2 * most - 2, F.struct("pos", "value"))]
    sums = one.groupBy("series_id", "n").agg(
        F.array(*[F.sum(change * (lag(k) - lag(k + 1))) for k in distances]).alias("s"),
        F.array(*[F.sum(lag(1) * (lag(k) - lag(k + 1))) for k in distances]).alias("c"),
        F.sum(lag(1)).alias("level"),
        F.sum(lag(1) * lag(1)).alias("square"),
    )
    edges = table.groupBy("series_id").agg(*[F.sort_array(F.collect_list(e)).alias(name) for e, name in zip(ends, ("head", "tail"))])
    edges = edges.select("series_id", F.col("head.value").alias("head"), F.col("tail.value").alias("tail"))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                # distances longer than the series have no products
                lists = [np.nan_to_num(np.array(part, float)) for part in (r.s, r.c)]
                ends = [np.asarray(v, float) for v in (r.head, r.tail)]
                found = _tested(int(r.n), most, *lists, (r.level, r.square), *ends) if r.n > 2 else None
                lags, used, stat = found or (None, None, None)
                if stat is None or math.isnan(stat):
                    rows.append((r.series_id, int(r.n), lags, used, None, None, *[None] * len(CRITICAL), None))
                    continue
                p = p_value(stat)
                limits = [sum(w / used**k for k, w in enumerate(ws)) for ws in CRITICAL.values()]
                rows.append((r.series_id, int(r.n), lags, used, stat, p, *limits, p <= 0.05))
            yield pd.DataFrame(rows, columns=["series_id", "n", "lags", "used", "stat", "p", *CRITICAL, "stationary"], dtype=object)

    key = regular.schema["series_id"].dataType.simpleString()
    limits = ", ".join(f"{k} double" for k in CRITICAL)
    schema = f"series_id {key}, n bigint, lags int, used bigint, stat double, p double, {limits}, stationary boolean"
    return sums.join(edges, "series_id").mapInPandas(solve, schema)

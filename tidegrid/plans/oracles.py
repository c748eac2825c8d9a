"""The registered queries as plain SQL for an independent check.

The SQL takes other ways than the Spark code on purpose: it builds whole grids and joins
them, fills with null-skipping windows over whole series, uses ``ASOF JOIN``, and looks
template rows up by position. It is a test oracle for small data.

Floating results are rounded as in the catalog: nudged by a thousandth of the last digit
first, so that both engines treat exact ties alike.
"""

from __future__ import annotations

# --- building blocks -----------------------------------------------------------------

EVENTS_RAW = "SELECT event_type AS series_id, ts, value FROM events"
USERS_RAW = "SELECT user_id AS series_id, ts, value FROM events"
ORDERS_RAW = "SELECT o_orderpriority AS series_id, o_orderdate AS ts, o_totalprice AS value FROM orders"
MINUTES_RAW = "SELECT event_type AS series_id, date_trunc('minute', ts) AS ts, value FROM events"
PARSED = """SELECT event_id, event_type AS series_id,
       CASE WHEN value > 200 THEN NULL ELSE CAST(date_trunc('minute', ts) AS TIMESTAMP) END AS ts,
       CASE WHEN value < 1 THEN NULL ELSE CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) END AS value,
       value > 20 AS is_weekend
  FROM events"""
WEATHER = """SELECT event_type AS series_id, time_bucket(INTERVAL 1 HOUR, ts) AS ts, avg(value) AS temperature_2m,
       avg(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS relative_humidity_2m, min(value) AS precipitation,
       max(value) AS surface_pressure, CAST(count(*) AS DOUBLE) AS wind_speed_10m
  FROM events GROUP BY 1, 2"""
MEASURES = ("temperature_2m", "relative_humidity_2m", "precipitation", "surface_pressure", "wind_speed_10m")
MINUTES = {"half": 30, "hour": 60, "day": 1440}


def sql(final: str, *ctes: str) -> str:
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + final


def cte(name: str, body: str) -> str:
    return f"{name} AS (\n{body}\n)"


def r6(*cols: str) -> str:
    return ", ".join(f"round({c} + 1e-9, 6) AS {c.split('.')[-1]}" for c in cols)


def bins(raw: str, grid: str, p: str = "") -> list[str]:
    step = f"INTERVAL {MINUTES[grid]} MINUTE"
    return [
        cte(f"{p}raw", raw),
        cte(f"{p}dd", f"SELECT series_id, ts, avg(value) AS value FROM {p}raw WHERE ts IS NOT NULL AND value IS NOT NULL GROUP BY 1, 2"),
        cte(f"{p}bins", f"SELECT series_id, time_bucket({step}, ts) AS ts, avg(value) AS value FROM {p}dd GROUP BY 1, 2"),
    ]


def filled(source: str, cols: tuple[str, ...], grid: str, out: str) -> list[str]:
    """Full grid of ``source`` with ``cols`` interpolated in time (leading gap NULL, trailing repeated)."""
    step = f"INTERVAL {MINUTES[grid]} MINUTE"
    before, after = [], []
    for c in cols:
        before += [
            f"last_value(b.{c} IGNORE NULLS) OVER up AS {c}_p",
            f"last_value(CASE WHEN b.{c} IS NOT NULL THEN g.ts END IGNORE NULLS) OVER up AS {c}_pt",
            f"first_value(b.{c} IGNORE NULLS) OVER down AS {c}_n",
            f"first_value(CASE WHEN b.{c} IS NOT NULL THEN g.ts END IGNORE NULLS) OVER down AS {c}_nt",
        ]
        after.append(
            f"CASE WHEN {c}_pt = ts OR {c}_nt IS NULL THEN {c}_p ELSE {c}_p + ({c}_n - {c}_p) * "
            f"(CAST(date_diff('second', {c}_pt, ts) AS DOUBLE) / date_diff('second', {c}_pt, {c}_nt)) END AS {c}"
        )
    return [
        cte(f"{out}_ends", f"SELECT series_id, min(ts) AS lo, max(ts) AS hi FROM {source} GROUP BY 1"),
        cte(f"{out}_grid", f"SELECT series_id, unnest(generate_series(lo, hi, {step})) AS ts FROM {out}_ends"),
        cte(
            f"{out}_near",
            f"SELECT g.series_id, g.ts, b.series_id IS NULL AS filled, {', '.join(before)}\n"
            f"  FROM {out}_grid g LEFT JOIN {source} b ON b.series_id = g.series_id AND b.ts = g.ts\n"
            "  WINDOW up AS (PARTITION BY g.series_id ORDER BY g.ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),\n"
            "         down AS (PARTITION BY g.series_id ORDER BY g.ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)",
        ),
        cte(
            out,
            f"SELECT series_id, ts, {', '.join(after)}, filled,\n"
            "       row_number() OVER (PARTITION BY series_id ORDER BY ts) - 1 AS pos,\n"
            f"       count(*) OVER (PARTITION BY series_id) AS n\n  FROM {out}_near",
        ),
    ]


def regular(raw: str, grid: str, p: str = "") -> list[str]:
    return bins(raw, grid, p) + filled(f"{p}bins", ("value",), grid, f"{p}reg")


HALF = regular(EVENTS_RAW, "half")
USER_HOURS = regular(USERS_RAW, "hour")
USER_DAYS = regular(USERS_RAW, "day")
PRICE_DAYS = regular(ORDERS_RAW, "day")


def weather(cols: tuple[str, ...] = ("temperature_2m",)) -> list[str]:
    return [cte("hourly", WEATHER)] + filled("hourly", cols, "half", "wx")


# Demand rows with the upsampled temperature, gaps interpolated and padded.
LEFT_FILLED = [
    *HALF,
    *weather(),
    cte("joined", "SELECT r.series_id, r.ts, r.value, r.pos, r.n, w.temperature_2m AS t FROM reg r LEFT JOIN wx w USING (series_id, ts)"),
    cte(
        "jn",
        """SELECT *, last_value(t IGNORE NULLS) OVER up AS p, last_value(CASE WHEN t IS NOT NULL THEN pos END IGNORE NULLS) OVER up AS pp,
       first_value(t IGNORE NULLS) OVER down AS q, first_value(CASE WHEN t IS NOT NULL THEN pos END IGNORE NULLS) OVER down AS qp
  FROM joined WINDOW up AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
       down AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
    ),
    cte(
        "cov",
        """SELECT series_id, ts, value, pos, n, CASE WHEN isodow(ts) >= 6 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_weekend,
       coalesce(t, p + (q - p) * (CAST(pos - pp AS DOUBLE) / (qp - pp)), p, q) AS temperature_2m FROM jn""",
    ),
]

SPARSE = [
    *HALF,
    cte("hourly", WEATHER),
    cte("sparse", "SELECT r.series_id, r.ts, r.pos, h.temperature_2m AS t FROM reg r LEFT JOIN hourly h USING (series_id, ts)"),
    cte(
        "near",
        """SELECT *, last_value(t IGNORE NULLS) OVER up AS p, last_value(CASE WHEN t IS NOT NULL THEN pos END IGNORE NULLS) OVER up AS pp,
       first_value(t IGNORE NULLS) OVER down AS q, first_value(CASE WHEN t IS NOT NULL THEN pos END IGNORE NULLS) OVER down AS qp
  FROM sparse WINDOW up AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
       down AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
    ),
]

FEATURES = [
    *HALF,
    *weather(("temperature_2m", "relative_humidity_2m")),
    cte(
        "feat",
        """SELECT r.series_id, r.ts, r.value AS demand, CASE WHEN isodow(r.ts) >= 6 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_weekend,
       w.temperature_2m, w.relative_humidity_2m,
       row_number() OVER (PARTITION BY r.series_id ORDER BY r.ts) - 1 AS pos, count(*) OVER (PARTITION BY r.series_id) AS n
  FROM reg r JOIN wx w USING (series_id, ts)
 WHERE w.temperature_2m IS NOT NULL AND w.relative_humidity_2m IS NOT NULL""",
    ),
]
RECENT = [c.replace("temperature_2m IS NOT NULL AND", "temperature_2m IS NOT NULL AND r.ts >= (SELECT max(x.ts) FROM reg x WHERE x.series_id = r.series_id) - INTERVAL 90 DAY AND") for c in FEATURES]


def future(src: str, grid: str, steps: int, out: str = "fut") -> str:
    return cte(
        out,
        f"""SELECT series_id, n, CAST(i AS INTEGER) AS h, last_ts + i * INTERVAL {MINUTES[grid]} MINUTE AS ts
  FROM (SELECT series_id, max(ts) AS last_ts, count(*) AS n, unnest(generate_series(1, {steps})) AS i FROM {src} GROUP BY 1)""",
    )


def baselines(src: str, grid: str, period: int, steps: int, k: int) -> list[str]:
    """``naive`` and ``kday`` forecasts of table ``src`` (needs pos and n), looked up by position."""
    return [
        future(src, grid, steps),
        cte(
            "naive",
            f"""SELECT f.series_id, f.h, f.ts, r.value AS yhat, f.n < {period} AS short
  FROM fut f JOIN {src} r ON r.series_id = f.series_id
   AND r.pos = CASE WHEN f.n < {period} THEN f.n - 1 ELSE f.n - {period} + (f.h - 1) % {period} END""",
        ),
        cte(
            "slots",
            f"""SELECT series_id, (pos - (n - least(n, {k * period}))) % {period} AS slot, avg(value) AS mean_value
  FROM {src} WHERE n >= {period} AND pos >= n - {k * period} GROUP BY 1, 2""",
        ),
        cte(
            "kday",
            f"""SELECT f.series_id, f.h, f.ts, coalesce(s.mean_value, r.value) AS yhat, f.n < {period} AS short
  FROM fut f LEFT JOIN slots s ON s.series_id = f.series_id AND s.slot = (f.h - 1) % {period}
  JOIN {src} r ON r.series_id = f.series_id AND r.pos = f.n - 1""",
        ),
        cte(
            "fc",
            """SELECT 'seasonal_naive' AS model, series_id, h, ts, yhat, short FROM naive
 UNION ALL SELECT 'kday_average', series_id, h, ts, yhat, short FROM kday""",
        ),
    ]


def used(model: str) -> str:
    return f"CASE WHEN short THEN 'persistence' ELSE {model} END AS model_used"


def ar1(src: str, grid: str, period: int, steps: int, out: str = "ar") -> list[str]:
    """First-order autoregression on all history, rolled out in closed form."""
    return [
        cte(
            f"{out}_pairs",
            f"""SELECT *, lag(value) OVER (PARTITION BY series_id ORDER BY pos) AS x FROM {src}""",
        ),
        cte(
            f"{out}_fit",
            f"""SELECT series_id, regr_slope(value, x) AS b, regr_intercept(value, x) AS a, max_by(value, pos) AS y, max(ts) AS last_ts
  FROM {out}_pairs GROUP BY 1""",
        ),
        cte(
            out,
            f"""SELECT series_id, CAST(h AS INTEGER) AS h, last_ts + h * INTERVAL {MINUTES[grid]} MINUTE AS ts,
       CASE WHEN b IS NULL THEN y ELSE pow(b, h) * y + a * (1 - pow(b, h)) / (1 - b) END AS yhat
  FROM (SELECT *, unnest(generate_series(1, {steps})) AS h FROM {out}_fit)""",
        ),
    ]


def solved(src: str, k: int, keys: tuple[str, ...], out: str) -> list[str]:
    """Least squares by elimination: sums ``g{i}_{j}`` (i <= j <= k, the target last) to ``b0..b{k-1}``.

    A column that repeats earlier ones gets the weight 0, which leaves the predictions as they are.
    """

    def over(p: int) -> str:
        return f"(CASE WHEN abs(g{p}_{p}) > 1e-9 THEN 1 / g{p}_{p} ELSE 0 END)"

    at = "".join(f"{c}, " for c in keys)
    steps = []
    for p in range(k):
        rest = [
            f"g{i}_{j} - g{p}_{i} * {over(p)} * g{p}_{j} AS g{i}_{j}" for i in range(p + 1, k) for j in range(i, k + 1)
        ]
        done = [f"g{i}_{j}" for i in range(p + 1) for j in range(i, k + 1)]
        steps.append(cte(f"{out}_e{p}", f"SELECT {at}{', '.join(done + rest)} FROM {src if p == 0 else f'{out}_e{p - 1}'}"))
    source = f"{out}_e{k - 1}"
    for i in reversed(range(k)):
        known = "".join(f" - g{i}_{j} * b{j}" for j in range(i + 1, k))
        steps.append(cte(f"{out}_b{i}", f"SELECT *, (g{i}_{k}{known}) * {over(i)} AS b{i} FROM {source}"))
        source = f"{out}_b{i}"
    return [*steps, cte(out, f"SELECT {at}{', '.join(f'b{i}' for i in range(k))} FROM {source}")]


def sums(names: list[str]) -> str:
    """Sums of products of columns, the target last."""
    return ", ".join(f"sum({names[i]} * {names[j]}) AS g{i}_{j}" for i in range(len(names)) for j in range(i, len(names)))


def direct(steps: int, lookback: int, period: int, week: int) -> list[str]:
    """Regressions per horizon step on the scaled table ``reg``, all origins, looked up by position."""
    def shifted(length: int) -> str:
        return f"o.pos + h - {length} * CAST(ceil(h / {length}.0) AS BIGINT)"

    return [
        cte("sc", "SELECT series_id, min(value) AS lo, max(value) AS hi FROM reg GROUP BY 1"),
        cte("z", "SELECT r.series_id, r.pos, r.n, r.ts, (value - lo) / (hi - lo) AS z, lo, hi FROM reg r JOIN sc USING (series_id)"),
        cte(
            "asked",
            f"""SELECT o.series_id, o.pos, o.n, o.ts, o.lo, o.hi, h, 1.0::DOUBLE AS x0, o.z AS x1, s.z AS x2, w.z AS x3
  FROM (SELECT *, unnest(generate_series(1, {steps})) AS h FROM z WHERE pos >= {lookback - 1}) o
  JOIN z s ON s.series_id = o.series_id AND s.pos = {shifted(period)}
  JOIN z w ON w.series_id = o.series_id AND w.pos = {shifted(week)}""",
        ),
        cte(
            "samples",
            f"""SELECT a.*, t.z AS y FROM asked a JOIN z t ON t.series_id = a.series_id AND t.pos = a.pos + a.h WHERE a.pos < a.n - {steps}""",
        ),
        cte("grams", f"SELECT h, {sums(['x0', 'x1', 'x2', 'x3', 'y'])} FROM samples GROUP BY 1"),
        *solved("grams", 4, ("h",), "coef"),
    ]


def order_search(src: str, grid: str, period: int, steps: int, max_p: int, need: int, exog: tuple[str, ...] = ()) -> list[str]:
    """All candidate orders on differenced columns, the one of lowest AIC, rolled out with its interval.

    Reads ``src`` (and for covariates ``ahead`` with ``h``) and makes ``arp``: series_id, h, ts, yhat,
    lower, upper, order.
    """
    lags = sorted({k + s for k in range(max_p + 3) for s in (0, period)} - {0})
    back = [k + s for s in (0, period) for k in range(3)]
    depth = max(lags)

    def combined(poly: dict[int, float], name: str, by: int = 0) -> str:
        return " + ".join(f"({c}) * {name}{k + by}" for k, c in poly.items())

    columns = [f"lag(value, {k}) OVER w AS y{k}" for k in lags]
    columns += [f"lag(coalesce({c}, 0), {k}) OVER w AS e{j}_{k}" for j, c in enumerate(exog) for k in back]
    out = [
        cte("ar_lags", f"SELECT series_id, n, pos, ts, value AS y0, {', '.join(columns)} FROM {src} WHERE n >= {need} WINDOW w AS (PARTITION BY series_id ORDER BY pos)"),
        cte("ar_full", f"SELECT * FROM ar_lags WHERE pos >= {depth}"),
        cte("ar_level", "SELECT series_id, avg(y0) AS level FROM ar_full GROUP BY 1"),
        cte(
            "ar_rows",
            "SELECT f.* REPLACE (" + ", ".join(f"y{k} - level AS y{k}" for k in [0, *lags]) + ") FROM ar_full f JOIN ar_level USING (series_id)",
        ),
    ]
    picks = []
    for d, plain in enumerate(({0: 1.0}, {0: 1.0, 1: -1.0}, {0: 1.0, 1: -2.0, 2: 1.0})):
        for seasonal, difference in ((0, 0), (1, 0), (0, 1)):
            poly = plain | ({k + period: -c for k, c in plain.items()} if difference else {})
            for p in range(max_p + 1):
                i = len(picks)
                by = [*range(1, p + 1), *([period] if seasonal else [])]
                xs = ["1.0::DOUBLE"] * (d == 0) + [combined(poly, "y", b) for b in by]
                xs += [combined(poly, f"e{j}_") for j in range(len(exog))]
                k = len(xs)
                names = [f"x{j}" for j in range(k)] + ["t"]
                exprs = ", ".join(f"{x} AS {n}" for x, n in zip([*xs, combined(poly, "y")], names))
                out.append(cte(f"c{i}_x", f"SELECT series_id, {exprs} FROM ar_rows"))
                out.append(cte(f"c{i}_g", f"SELECT series_id, count(*) AS m, {sums(names)} FROM c{i}_x GROUP BY 1"))
                if k:
                    out += solved(f"c{i}_g", k, ("series_id",), f"c{i}_s")
                rss = f"g.g{k}_{k}" + "".join(f" - b{j} * g.g{j}_{k}" for j in range(k))
                first = d == 0  # b0 is the constant
                weights = []
                for lag in lags:
                    terms = [f"{-poly.get(lag, 0.0)}"]
                    terms += [f"b{first + j} * ({poly[lag - b]})" for j, b in enumerate(by) if lag - b in poly]
                    weights.append(" + ".join(terms))
                moved = [f"b{first + len(by) + j} * ({poly[x]})" if x in poly else "0.0" for j in range(len(exog)) for x in back]
                source = f"c{i}_g g JOIN c{i}_s USING (series_id)" if k else f"c{i}_g g"
                picks.append(
                    f"SELECT series_id, {i} AS place, '({p},{d},0)({seasonal},{difference},0)' AS ord, m * ln(({rss}) / m) + {2 * k} AS aic, "
                    f"({rss}) / greatest(m - {k}, 1) AS sigma2, {'b0' if first else '0.0'}::DOUBLE AS const, "
                    f"[{', '.join(weights)}]::DOUBLE[] AS lw, [{', '.join(moved)}]::DOUBLE[] AS xw FROM {source} WHERE m > {k + 1}"
                )
    out.append(cte("picks", "\nUNION ALL ".join(picks)))
    out.append(cte("best_order", "SELECT * FROM picks QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY aic, place) = 1"))
    known = ", ".join(f"list(coalesce({c}, 0) ORDER BY pos) AS past{j}" for j, c in enumerate(exog))
    out.append(
        cte(
            "ar_past",
            f"SELECT s.series_id, list(value - level ORDER BY pos) AS path, max(ts) AS last_ts, any_value(level) AS level{', ' + known if exog else ''}\n"
            f"  FROM {src} s JOIN ar_level USING (series_id) WHERE pos >= n - {depth} GROUP BY 1",
        )
    )
    if exog:
        ahead = ", ".join(f"list(coalesce({c}, 0) ORDER BY h) AS next{j}" for j, c in enumerate(exog))
        out.append(cte("ar_next", f"SELECT series_id, {ahead} FROM ahead WHERE h <= {steps} GROUP BY 1"))
    joined = "ar_past JOIN best_order USING (series_id)" + (" JOIN ar_next USING (series_id)" if exog else "")
    lists = "".join(f", list_concat(past{j}, next{j}) AS v{j}" for j in range(len(exog)))
    carried = "".join(f", v{j}" for j in range(len(exog)))
    value = " + ".join(f"lw[{i + 1}] * path[-{lag}]" for i, lag in enumerate(lags))
    value += "".join(
        f" + xw[{j * len(back) + i + 1}] * v{j}[{depth + 1 - x} + h]" for j in range(len(exog)) for i, x in enumerate(back)
    )
    impulse = " + ".join(f"lw[{i + 1}] * psi[-{lag}]" for i, lag in enumerate(lags))
    return [
        *out,
        cte(
            "ar_roll",
            f"""SELECT series_id, last_ts, level, ord, sigma2, const, lw, xw, 0 AS h, path, [0.0::DOUBLE FOR i IN range({depth})] AS psi, 0.0::DOUBLE AS spread{lists} FROM {joined} UNION ALL
 SELECT series_id, last_ts, level, ord, sigma2, const, lw, xw, h + 1, list_append(path, const + {value}),
   list_append(psi, CASE WHEN h = 0 THEN 1.0 ELSE {impulse} END),
   spread + pow(CASE WHEN h = 0 THEN 1.0 ELSE {impulse} END, 2){carried} FROM ar_roll WHERE h < {steps}""",
        ),
        cte(
            "arp",
            f"""SELECT series_id, CAST(h AS INTEGER) AS h, last_ts + h * INTERVAL {MINUTES[grid]} MINUTE AS ts, path[-1] + level AS yhat,
       path[-1] + level - 1.959963984540054 * sqrt(sigma2 * spread) AS lower, path[-1] + level + 1.959963984540054 * sqrt(sigma2 * spread) AS upper, ord
  FROM ar_roll WHERE h > 0""",
        ),
    ]


def arma(src: str, grid: str, period: int, steps: int, order: tuple, need: int) -> list[str]:
    """One order in two stages on whole series: a long autoregression, then lags and lagged residuals.

    Reads ``src`` and makes ``arma``: series_id, h, ts, yhat, lower, upper.
    """
    (p, d, q), (sp, sd, sq) = order
    poly = {0: 1.0}
    for gap in [1] * d + [period] * sd:
        poly = {k: poly.get(k, 0.0) - poly.get(k - gap, 0.0) for k in sorted({*poly, *(k + gap for k in poly)})}
    long = sorted({*range(1, max(p + q, 8) + 1), *(s * period + k for s in range(1, max(sp, sq) + 1) for k in (0, 1))})
    own = sorted({*range(1, p + 1), *(s * period for s in range(1, sp + 1))})
    hits = sorted({*range(1, q + 1), *(s * period for s in range(1, sq + 1))})
    base, first, depth = max(poly), max(poly) + max(long), max([*own, *hits])
    keep = max(depth, base)
    w = " + ".join(f"({c}) * lag(value, {k}) OVER w" for k, c in poly.items())
    constant = int(not d and not sd)
    names = [f"z{i}" for i in range(constant + len(own) + len(hits))]
    exprs = ["1.0::DOUBLE"] * constant + [f"lag(w, {k}) OVER o" for k in own] + [f"lag(e, {k}) OVER o" for k in hits]
    k = len(names)
    rss = f"(g.g{k}_{k}" + "".join(f" - b{i} * g.g{i}_{k}" for i in range(k)) + ")"
    value = " + ".join(
        ["b0"] * constant + [f"b{constant + i} * pw[-{x}]" for i, x in enumerate(own)]
        + [f"b{constant + len(own) + i} * pe[-{x}]" for i, x in enumerate(hits)]
    )
    # response to one shock: the shock itself sits ``h`` places back
    reply = " + ".join(
        [f"b{constant + i} * coalesce(rw[-{x}], 0)" for i, x in enumerate(own)]
        + [f"CASE WHEN h = {x} THEN b{constant + len(own) + i} ELSE 0 END" for i, x in enumerate(hits)]
    )
    reply = f"(CASE WHEN h = 0 THEN 1.0 ELSE {reply} END)"
    undo = "".join(f" - ({c}) * py[-{x}]" for x, c in poly.items() if x)
    undone = "".join(f" - ({c}) * coalesce(ry[-{x}], 0)" for x, c in poly.items() if x)
    betas = ", ".join(f"b{i}" for i in range(k))
    long_names = ["1.0::DOUBLE", *[f"l{x}" for x in long]]
    return [
        cte("am_w", f"SELECT series_id, pos, n, ts, value, {w} AS w FROM {src} WHERE n >= {need} WINDOW w AS (PARTITION BY series_id ORDER BY pos)"),
        cte(
            "am_l",
            f"SELECT *, {', '.join(f'lag(w, {x}) OVER o AS l{x}' for x in long)} FROM am_w WHERE pos >= {base} WINDOW o AS (PARTITION BY series_id ORDER BY pos)",
        ),
        cte("am_lx", f"SELECT series_id, pos, n, ts, value, w, {', '.join(f'{c} AS x{i}' for i, c in enumerate(long_names))} FROM am_l WHERE pos >= {first}"),
        cte("am_lg", f"SELECT series_id, {sums([*[f'x{i}' for i in range(len(long_names))], 'w'])} FROM am_lx GROUP BY 1"),
        *solved("am_lg", len(long_names), ("series_id",), "am_a"),
        cte("am_e", f"SELECT x.series_id, pos, n, ts, value, w, w - ({' + '.join(f'b{i} * x{i}' for i in range(len(long_names)))}) AS e FROM am_lx x JOIN am_a USING (series_id)"),
        cte("am_z", f"SELECT series_id, pos, w, {', '.join(f'{x} AS {c}' for c, x in zip(names, exprs))} FROM am_e WINDOW o AS (PARTITION BY series_id ORDER BY pos)"),
        cte("am_g", f"SELECT series_id, count(*) AS m, {sums([*names, 'w'])} FROM am_z WHERE pos >= {first + depth} GROUP BY 1"),
        *solved("am_g", k, ("series_id",), "am_b"),
        cte("am_fit", f"SELECT g.series_id, {betas}, {rss} / greatest(m - {k}, 1) AS sigma2 FROM am_g g JOIN am_b USING (series_id)"),
        cte(
            "am_past",
            f"SELECT series_id, max(ts) AS last_ts, list(w ORDER BY pos) AS pw, list(e ORDER BY pos) AS pe, list(value ORDER BY pos) AS py FROM am_e WHERE pos >= n - {keep} GROUP BY 1",
        ),
        cte(
            "am_roll",
            f"""SELECT p.*, f.* EXCLUDE (series_id), 0 AS h, []::DOUBLE[] AS rw, []::DOUBLE[] AS ry, 0.0::DOUBLE AS spread FROM am_past p JOIN am_fit f USING (series_id) UNION ALL
 SELECT series_id, last_ts, list_append(pw, {value}), list_append(pe, 0.0), list_append(py, {value}{undo}), {betas}, sigma2, h + 1,
   list_append(rw, {reply}), list_append(ry, {reply}{undone}), spread + pow({reply}{undone}, 2) FROM am_roll WHERE h < {steps}""",
        ),
        cte(
            "arma",
            f"""SELECT series_id, CAST(h AS INTEGER) AS h, last_ts + h * INTERVAL {MINUTES[grid]} MINUTE AS ts, py[-1] AS yhat,
       py[-1] - 1.959963984540054 * sqrt(sigma2 * spread) AS lower, py[-1] + 1.959963984540054 * sqrt(sigma2 * spread) AS upper FROM am_roll WHERE h > 0""",
        ),
    ]


def basis(src: str, period: int, steps: int, degree: int = 2, daily: int = 3, weekly: int = 1) -> list[str]:
    """Regression on powers of time and harmonics: ``bcoef`` with weights, ``bpart`` with both parts per row.

    The interval needs the quadratic form of the inverse: eliminating with the functions of a future
    row as the target leaves it as a sum over the pivots.
    """
    waves = [(k, period) for k in range(1, daily + 1)] + [(k, 7 * period) for k in range(1, weekly + 1)]

    def functions(at: str) -> list[str]:
        angle = [f"(2 * pi() * {k} * ({at}) / {length})" for k, length in waves]
        return [f"pow(({at})::DOUBLE / (n - 1), {i})" for i in range(degree + 1)] + [f(a) for a in angle for f in (lambda a: f"sin{a}", lambda a: f"cos{a}")]

    k = degree + 1 + 2 * len(waves)
    named = lambda at, p: ", ".join(f"{f} AS {p}{i}" for i, f in enumerate(functions(at)))
    cells = [f"g{i}_{j}" for i in range(k) for j in range(i, k)]
    total = lambda lo, hi: " + ".join(f"b{i} * x{i}" for i in range(lo, hi))
    return [
        cte("bx", f"SELECT series_id, pos, n, ts, value AS y, {named('pos', 'x')} FROM {src}"),
        cte("bg", f"SELECT series_id, any_value(n) AS n, max(ts) AS last_ts, count(*) AS m, {sums([*[f'x{i}' for i in range(k)], 'y'])} FROM bx GROUP BY 1"),
        *solved("bg", k, ("series_id",), "bcoef"),
        cte("bpart", f"SELECT x.series_id, ts, y, {total(0, degree + 1)} AS trend, {total(degree + 1, k)} AS season FROM bx x JOIN bcoef USING (series_id)"),
        cte("bvar", f"SELECT g.series_id, (g{k}_{k} - ({' + '.join(f'b{i} * g{i}_{k}' for i in range(k))})) / greatest(m - {k}, 1) AS sigma2 FROM bg g JOIN bcoef USING (series_id)"),
        cte("bh", f"SELECT *, {named('n - 1 + h', 'x')} FROM (SELECT series_id, n, last_ts, {', '.join(cells)}, unnest(generate_series(1, {steps})) AS h FROM bg)"),
        cte("bhg", f"SELECT series_id, h, {', '.join(cells)}, {', '.join(f'x{i} AS g{i}_{k}' for i in range(k))} FROM bh"),
        *solved("bhg", k, ("series_id", "h"), "bsolved"),
        cte("bq", f"SELECT series_id, h, {' + '.join(f'CASE WHEN abs(g{i}_{i}) > 1e-9 THEN g{i}_{k} * g{i}_{k} / g{i}_{i} ELSE 0 END' for i in range(k))} AS q FROM bsolved_e{k - 1}"),
        cte(
            "bfc",
            f"""SELECT h.series_id, CAST(h.h AS INTEGER) AS h, last_ts + h.h * INTERVAL 30 MINUTE AS ts, {total(0, degree + 1)} AS trend, {total(degree + 1, k)} AS season,
       1.959963984540054 * sqrt(sigma2 * (1 + q)) AS half FROM bh h JOIN bcoef USING (series_id) JOIN bvar USING (series_id) JOIN bq USING (series_id, h)""",
        ),
    ]


def unit_root(src: str, most: int) -> list[str]:
    """Augmented Dickey-Fuller: one elimination gives the residual sums of all lag counts; ``adf`` has the result.

    ``most`` must not be below the number of lags that the longest series is tested with.
    """
    bound = "least(CAST(ceil(12 * pow(n / 100.0, 0.25)) AS BIGINT), n // 2 - 2)"
    lags = [f"d{k}" for k in range(1, most + 1)]
    order = ["one", "l", *lags, "d"]
    k = len(order) - 1
    rss = [f"g{k}_{k}" + "".join(f" - CASE WHEN abs(g{i}_{i}) > 1e-9 THEN g{i}_{k} * g{i}_{k} / g{i}_{i} ELSE 0 END" for i in range(2 + n)) for n in range(most + 1)]
    masked = ["one", *[f"(CASE WHEN chosen >= {i} THEN d{i} ELSE 0 END)" for i in range(1, most + 1)], "l", "d"]
    names = [f"v{i}" for i in range(len(masked))]
    z = len(names) - 1
    left = f"(g.g{z}_{z}" + "".join(f" - b{i} * g.g{i}_{z}" for i in range(z)) + ")"
    return [
        cte("ad0", f"SELECT series_id, pos, n, 1.0::DOUBLE AS one, value - lag(value) OVER w AS d, lag(value) OVER w AS l, {bound} AS most FROM {src} WINDOW w AS (PARTITION BY series_id ORDER BY pos)"),
        cte("ad1", f"SELECT *, {', '.join(f'coalesce(lag(d, {i}) OVER w, 0) AS d{i}' for i in range(1, most + 1))} FROM ad0 WINDOW w AS (PARTITION BY series_id ORDER BY pos)"),
        # lags beyond a series' bound are columns of zeros, which add nothing
        cte("ad2", f"SELECT series_id, one, l, d, {', '.join(f'CASE WHEN most >= {i} THEN d{i} ELSE 0 END AS d{i}' for i in range(1, most + 1))} FROM ad1 WHERE pos >= 1 + most AND most >= 0"),
        cte("adg", f"SELECT series_id, count(*) AS m, {sums(order)} FROM ad2 GROUP BY 1"),
        *solved("adg", k, ("series_id", "m"), "adb"),
        # after the elimination the corner is used up: take it from the sums
        cte("adr", f"SELECT e.* , g.g{k}_{k} AS corner FROM adb_e{k - 1} e JOIN adg g USING (series_id)"),
        cte(
            "adl",
            " UNION ALL ".join(
                f"SELECT series_id, {n} AS chosen, m * ln(({r.replace(f'g{k}_{k}', 'corner', 1)}) / m) + {2 * (n + 2)} AS aic FROM adr" for n, r in enumerate(rss)
            ),
        ),
        cte("adc", "SELECT l.* FROM adl l JOIN (SELECT DISTINCT series_id, most FROM ad0) USING (series_id) WHERE chosen <= most QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY aic, chosen) = 1"),
        cte("ad3", f"SELECT series_id, chosen, {', '.join(f'{x} AS {c}' for c, x in zip(names, masked))} FROM ad1 JOIN adc USING (series_id) WHERE pos >= 1 + chosen"),
        cte("ad4", f"SELECT series_id, chosen, count(*) AS used, {sums(names)} FROM ad3 GROUP BY 1, 2"),
        *solved("ad4", z, ("series_id",), "ad5"),
        cte(
            "adf",
            f"""SELECT g.series_id, chosen, used, b{z - 1} / sqrt({left} / (used - chosen - 2) / e.g{z - 1}_{z - 1}) AS stat
  FROM ad4 g JOIN ad5 USING (series_id) JOIN ad5_e{z - 1} e ON e.series_id = g.series_id""",
        ),
    ]


def analogues(src: str, steps: int, lookback: int, nearest: int) -> list[str]:
    """Past windows joined to the newest one value by value; ``nearw`` ranks them, ``anfc`` averages them."""
    return [
        cte("an_q", f"SELECT series_id, n, pos - (n - {lookback}) AS i, value AS q, avg(value) OVER s AS qm, stddev_pop(value) OVER s AS qs FROM {src} WHERE pos >= n - {lookback} AND n >= {lookback + steps} WINDOW s AS (PARTITION BY series_id)"),
        cte("an_o", f"SELECT series_id, pos AS origin FROM {src} WHERE pos >= {lookback} AND pos <= n - {steps}"),
        cte(
            "an_d",
            f"""SELECT o.series_id, origin, avg(r.value) AS m, stddev_pop(r.value) AS s, greatest(2 * {lookback} * (1 - corr(r.value, q)), 0) AS distance
  FROM an_o o JOIN {src} r ON r.series_id = o.series_id AND r.pos BETWEEN origin - {lookback} AND origin - 1
  JOIN an_q q ON q.series_id = o.series_id AND q.i = r.pos - origin + {lookback} GROUP BY 1, 2""",
        ),
        cte("nearw", f"SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY distance, origin) AS rank FROM an_d QUALIFY rank <= {nearest}"),
        cte("an_w", "SELECT *, exp(-(distance - min(distance) OVER v) / (avg(distance) OVER v - min(distance) OVER v)) AS weight FROM nearw WINDOW v AS (PARTITION BY series_id)"),
        cte(
            "anfc",
            f"""SELECT w.series_id, r.pos - origin + 1 AS h, sum(weight * (r.value - m) / s) / sum(weight) AS z
  FROM an_w w JOIN {src} r ON r.series_id = w.series_id AND r.pos BETWEEN origin AND origin + {steps - 1} GROUP BY 1, 2""",
        ),
        cte("an_l", f"SELECT series_id, max(ts) AS last_ts FROM {src} GROUP BY 1"),
    ]


#: Result of ``unit_root``. The normal probability is summed up term by term: x^(2k+1) / (1 3 5 ... (2k+1)).
STATIONARITY = """SELECT series_id, n, CAST(chosen AS INTEGER) AS lags, used, round(stat + 1e-9, 6) AS stat, round(p + 1e-9, 6) AS p,
       round(-3.43035 - 6.5393 / used - 16.786 / pow(used, 2) - 79.433 / pow(used, 3) + 1e-9, 6) AS critical_1,
       round(-2.86154 - 2.8903 / used - 4.234 / pow(used, 2) - 40.040 / pow(used, 3) + 1e-9, 6) AS critical_5,
       round(-2.56677 - 1.5384 / used - 2.809 / pow(used, 2) + 1e-9, 6) AS critical_10, p <= 0.05 AS stationary
  FROM (SELECT *, CASE WHEN stat <= -18.83 THEN 0.0::DOUBLE WHEN stat >= 2.74 THEN 1.0::DOUBLE
      ELSE 0.5 + sign(x) * exp(-x * x / 2) / sqrt(2 * pi()) *
        list_sum([exp((2 * k + 1) * ln(abs(x)) - (lgamma(2 * k + 2) - k * ln(2) - lgamma(k + 1))) FOR k IN range(300)]) END AS p
    FROM (SELECT *, CASE WHEN stat <= -1.61 THEN 2.1659 + 1.4412 * stat + 0.038269 * stat * stat
        ELSE 1.7339 + 0.93202 * stat - 0.12745 * pow(stat, 2) - 0.010368 * pow(stat, 3) END AS x
      FROM (SELECT series_id, count(*) AS n FROM reg GROUP BY 1) LEFT JOIN adf USING (series_id)))"""


def searched(model: str, need: int) -> str:
    """Forecasts of the order search, and the seven-day average for series below its gate."""
    return f"""SELECT series_id, '{model}' AS model, h, ts, {r6('yhat')}, '{model}' AS model_used, {r6('lower', 'upper')}, ord AS "order" FROM arp UNION ALL
 SELECT series_id, '{model}', h, ts, {r6('yhat')}, {used("'kday_average_7'")}, NULL, NULL, NULL FROM kday WHERE series_id IN (SELECT series_id FROM base GROUP BY 1 HAVING count(*) < {need})"""


def recursive(steps: int, period: int) -> list[str]:
    """One regression on the scaled table ``feat``, rolled out over a growing list."""
    week = 7 * period
    scaled = ", ".join(
        f"CASE WHEN max({c}) OVER s = min({c}) OVER s THEN 0 ELSE ({c} - min({c}) OVER s) / (max({c}) OVER s - min({c}) OVER s) END AS {z}"
        for c, z in (("demand", "z"), ("is_weekend", "e"), ("temperature_2m", "t"))
    )
    lag = "lag({c}, {k}) OVER (PARTITION BY series_id ORDER BY pos)"
    return [
        cte("fz", f"SELECT series_id, ts, pos, n, min(demand) OVER s AS lo, max(demand) OVER s AS hi, {scaled} FROM feat WINDOW s AS (PARTITION BY series_id)"),
        cte(
            "samples",
            f"""SELECT series_id, pos, z AS y, 1.0::DOUBLE AS x0, {lag.format(c='z', k=1)} AS x1, {lag.format(c='z', k=period)} AS x2,
       {lag.format(c='z', k=week)} AS x3, {lag.format(c='e', k=1)} AS x4, {lag.format(c='t', k=1)} AS x5 FROM fz""",
        ),
        cte("grams", f"SELECT {sums(['x0', 'x1', 'x2', 'x3', 'x4', 'x5', 'y'])} FROM samples WHERE pos >= {week}"),
        *solved("grams", 6, (), "coef"),
        cte(
            "state",
            f"""SELECT series_id, any_value(lo) AS lo, any_value(hi) AS hi, max_by(e, pos) AS e, max_by(t, pos) AS t,
       array_agg(z ORDER BY pos) AS path, max(ts) AS from_ts FROM fz WHERE pos >= n - {week} GROUP BY 1""",
        ),
        cte("ends", "SELECT series_id, max(ts) AS last_ts FROM reg GROUP BY 1"),
        cte("begun", "SELECT s.*, last_ts, CAST(date_diff('minute', from_ts, last_ts) / 30 AS BIGINT) AS behind FROM state s JOIN ends USING (series_id)"),
        cte(
            "rolled",
            f"""SELECT series_id, lo, hi, e, t, last_ts, behind, 0::BIGINT AS i, path FROM begun UNION ALL
 SELECT r.series_id, lo, hi, e, t, last_ts, behind, i + 1,
   list_append(path, b0 + b1 * path[-1] + b2 * path[-{period}] + b3 * path[-{week}] + b4 * e + b5 * t)
  FROM rolled r, coef WHERE i < behind + {steps}""",
        ),
    ]


def holdout(src: str, hold: int) -> list[str]:
    return [
        cte("train", f"SELECT series_id, ts, value, pos, n - {hold} AS n FROM {src} WHERE pos < n - {hold}"),
        cte("valid", f"SELECT series_id, ts, value AS y FROM {src} WHERE pos >= n - {hold}"),
    ]


METRICS = cte(
    "scores",
    """SELECT f.series_id, f.model, CAST(count(v.y) AS BIGINT) AS n,
       CASE WHEN count(*) FILTER (WHERE v.y = 0) = 0 THEN avg(abs((v.y - f.yhat) / nullif(v.y, 0))) * 100 END AS mape,
       avg(abs((v.y - f.yhat) / nullif(v.y, 0))) * 100 AS mape_nonzero,
       avg((v.y - f.yhat) * (v.y - f.yhat)) AS mse, sqrt(avg((v.y - f.yhat) * (v.y - f.yhat))) AS rmse,
       sum(abs(v.y - f.yhat)) / nullif(sum(abs(v.y)), 0) * 100 AS wmape
  FROM fc f LEFT JOIN valid v USING (series_id, ts) GROUP BY 1, 2""",
)
LONG = cte(
    "long",
    """SELECT series_id, model, 'mape' AS metric, mape AS score FROM scores UNION ALL
 SELECT series_id, model, 'mse', mse FROM scores UNION ALL SELECT series_id, model, 'wmape', wmape FROM scores""",
)
BEST = cte(
    "best",
    """SELECT a.series_id, a.metric, a.score AS seasonal_naive, b.score AS kday_average,
       CASE WHEN a.score IS NULL AND b.score IS NULL THEN 'N/A'
            WHEN b.score IS NULL OR a.score <= b.score THEN 'seasonal_naive' ELSE 'kday_average' END AS best_model
  FROM (SELECT * FROM long WHERE model = 'seasonal_naive') a JOIN (SELECT * FROM long WHERE model = 'kday_average') b
    USING (series_id, metric)""",
)
HALF_SCORES = [*HALF, *holdout("reg", 336), *baselines("train", "half", 48, 336, 7), METRICS]
USER_SCORES = [*USER_HOURS, *holdout("reg", 168), *baselines("train", "hour", 24, 168, 7), METRICS]

MARKS = [
    cte("raw", MINUTES_RAW),
    cte("ends", "SELECT series_id, min(ts) AS lo, max(ts) AS hi FROM raw GROUP BY 1"),
    cte(
        "grid",
        """SELECT series_id, unnest(generate_series(time_bucket(INTERVAL 30 MINUTE, lo),
       CASE WHEN time_bucket(INTERVAL 30 MINUTE, hi) = hi THEN hi ELSE time_bucket(INTERVAL 30 MINUTE, hi) + INTERVAL 30 MINUTE END,
       INTERVAL 30 MINUTE)) AS ts FROM ends""",
    ),
    cte("missing", "SELECT g.series_id, g.ts FROM grid g WHERE NOT EXISTS (SELECT 1 FROM raw r WHERE r.series_id = g.series_id AND r.ts = g.ts)"),
    cte(
        "islands",
        """SELECT series_id, ts, ts - row_number() OVER (PARTITION BY series_id ORDER BY ts) * INTERVAL 30 MINUTE AS island FROM missing""",
    ),
    cte("blocks", "SELECT series_id, min(ts) AS start, max(ts) AS \"end\", count(*) AS slots FROM islands GROUP BY series_id, island"),
]

WEEKEND = "CASE WHEN isodow(ts) >= 6 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_weekend"
SUPPLIER_OF = "'Supplier#' || lpad(CAST({c} AS VARCHAR), 9, '0')"


def weekly(steps: int) -> list[str]:
    return [
        future("cov", "half", steps),
        cte(
            "ahead",
            """SELECT f.series_id, f.h, f.ts, c.is_weekend, c.temperature_2m FROM fut f JOIN cov c ON c.series_id = f.series_id
   AND c.pos = CASE WHEN f.n - 336 + (f.h - 1) % 336 >= 0 THEN f.n - 336 + (f.h - 1) % 336 ELSE f.n - 1 END""",
        ),
    ]


def _queries() -> dict[str, str]:
    q: dict[str, str] = {}

    # sources and sinks
    q["read_wide_table"] = f"""SELECT l_shipdate AS ts, isodow(l_shipdate) >= 6 AS is_weekend, count(*) AS n,
       {", ".join(f"round(avg({c}) + 1e-9, 6) AS {c}" for c in ("l_quantity", "l_extendedprice", "l_discount"))}
  FROM lineitem GROUP BY 1, 2"""
    q["station_dim"] = "SELECT trim(s_name) AS station, CAST(s_nationkey AS DOUBLE) AS x, s_acctbal AS y FROM supplier"
    q["weather_json_rows"] = sql(f"SELECT series_id, ts, {r6(*MEASURES)} FROM hourly", cte("hourly", WEATHER))
    q["weather_requests"] = f"""SELECT l.series_id, strftime(min(l.ts), '%Y-%m-%d') AS start_date, strftime(max(l.ts), '%Y-%m-%d') AS end_date,
       CAST(any_value(s.s_nationkey) AS DOUBLE) AS x, any_value(s.s_acctbal) AS y, '{",".join(MEASURES)}' AS hourly, 'auto' AS timezone
  FROM (SELECT {SUPPLIER_OF.format(c="l_suppkey")} AS series_id, l_shipdate AS ts FROM lineitem) l
  JOIN supplier s ON s.s_name = l.series_id GROUP BY 1"""
    q["preview_rows"] = "SELECT event_id, ts, event_type, value FROM events ORDER BY ts, event_id LIMIT 3"
    q["forecast_output_table"] = sql(
        """SELECT coalesce(h.series_id, w.series_id) AS series_id, coalesce(h.ts, w.ts) AS timestamp,
       round(demand_history + 1e-9, 6) AS demand_history, round(seasonal_naive_forecast + 1e-9, 6) AS seasonal_naive_forecast,
       round(kday_average_forecast + 1e-9, 6) AS kday_average_forecast, round(w.temperature_2m + 1e-9, 6) AS weather_temperature_2m,
       round(w.relative_humidity_2m + 1e-9, 6) AS weather_relative_humidity_2m
  FROM (SELECT coalesce(r.series_id, f.series_id) AS series_id, coalesce(r.ts, f.ts) AS ts, r.value AS demand_history,
               f.sn AS seasonal_naive_forecast, f.kd AS kday_average_forecast
          FROM reg r FULL JOIN both_fc f ON f.series_id = r.series_id AND f.ts = r.ts) h
  FULL JOIN wx w ON w.series_id = h.series_id AND w.ts = h.ts""",
        *HALF,
        *weather(("temperature_2m", "relative_humidity_2m")),
        *baselines("reg", "half", 48, 96, 7),
        cte("both_fc", "SELECT a.series_id, a.ts, a.yhat AS sn, b.yhat AS kd FROM naive a JOIN kday b USING (series_id, ts)"),
    )
    q["metrics_report_lines"] = sql(
        """SELECT series_id, CAST(CASE metric WHEN 'mape' THEN 1 WHEN 'mse' THEN 2 ELSE 3 END AS INTEGER) AS line_no,
       rtrim(rpad(CASE metric WHEN 'mape' THEN 'MAPE' WHEN 'mse' THEN 'MSE' ELSE 'wMAPE' END, 12, ' ') || ' ' ||
       rpad(coalesce(printf('%.3f', seasonal_naive), 'N/A'), 15, ' ') || ' ' ||
       rpad(coalesce(printf('%.3f', kday_average), 'N/A'), 15, ' ') || ' ' || best_model) AS line FROM best""",
        *HALF_SCORES, LONG, BEST,
    )
    q["safe_name"] = """SELECT o_orderkey, replace(replace(o_orderpriority || '/' || o_orderstatus || '/' || o_custkey || chr(92) || o_orderkey,
       '/', '_'), chr(92), '_') AS name FROM orders"""

    # projections and filters
    q["wide_to_long"] = " UNION ALL ".join(
        f"SELECT CAST(l_shipdate AS TIMESTAMP) AS ts, '{c}' AS series_id, {c} AS value FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    )
    q["drop_missing"] = sql("SELECT event_id, series_id, ts, value FROM p WHERE ts IS NOT NULL AND value IS NOT NULL", cte("p", PARSED))
    names = f"SELECT DISTINCT {SUPPLIER_OF.format(c='l_partkey')} AS station FROM lineitem"
    q["known_stations"] = f"SELECT station FROM ({names}) WHERE station IN (SELECT s_name FROM supplier)"
    q["unknown_stations"] = f"SELECT station FROM ({names}) WHERE station NOT IN (SELECT s_name FROM supplier)"
    q["station_lookup"] = """SELECT c.c_custkey, n.n_name AS station, s.s_acctbal AS x, CAST(s.s_nationkey AS DOUBLE) AS y
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS rn FROM supplier) s
    ON s.s_nationkey = n.n_nationkey AND s.rn = 1"""
    q["time_slice"] = sql(
        "SELECT * FROM raw WHERE ts BETWEEN TIMESTAMP '2024-01-08 00:00:00' AND TIMESTAMP '2024-01-15 12:00:00'", cte("raw", EVENTS_RAW)
    )
    q["recent_days"] = sql(
        "SELECT series_id, ts, round(value + 1e-6, 3) AS value FROM reg r WHERE ts >= (SELECT max(ts) FROM reg x WHERE x.series_id = r.series_id) - INTERVAL 120 DAY",
        *PRICE_DAYS,
    )
    q["recent_days_raw"] = sql(
        "SELECT series_id, ts, value FROM (SELECT *, max(ts) OVER (PARTITION BY series_id) AS hi FROM raw) WHERE ts >= hi - INTERVAL 7 DAY",
        cte("raw", USERS_RAW),
    )
    q["tail_n"] = sql(
        "SELECT series_id, ts, round(value + 1e-9, 6) AS value FROM reg QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY ts DESC) <= 672", *HALF
    )
    q["history_gate"] = sql(
        """SELECT series_id, count(*) AS n, count(*) >= 24 AS ok_seasonal, count(*) >= 192 AS ok_backtest, count(*) >= 500 AS ok_autoregression,
       count(*) >= 554 AS ok_lookback_features, count(*) >= 604 AS ok_calendar_features, count(*) >= 704 AS ok_deep_calendar
  FROM reg GROUP BY 1""",
        *USER_HOURS,
    )
    q["empty_series_report"] = """SELECT o_custkey AS series_id, count(*) AS rows FROM orders GROUP BY 1
 HAVING count(*) FILTER (WHERE o_orderstatus = 'F' AND o_totalprice IS NOT NULL) = 0"""

    # scalar functions
    q["parse_timestamp"] = """SELECT event_id, CASE WHEN value > 200 THEN NULL WHEN event_type = 'click' THEN date_trunc('second', ts)
       WHEN event_type = 'view' THEN CAST(date_trunc('day', ts) AS TIMESTAMP) ELSE date_trunc('minute', ts) END AS parsed FROM events"""
    q["parse_decimal_comma"] = "SELECT event_id, CASE WHEN value >= 1 THEN value END AS parsed FROM events"
    q["grid_floor_ceil"] = """SELECT event_id, time_bucket(INTERVAL 30 MINUTE, ts) AS floor_ts, CASE WHEN time_bucket(INTERVAL 30 MINUTE, ts) = ts THEN ts
       ELSE time_bucket(INTERVAL 30 MINUTE, ts) + INTERVAL 30 MINUTE END AS ceil_ts FROM events"""
    q["calendar_features"] = """SELECT event_id, round(hour(ts) + minute(ts) / 60.0::DOUBLE + 1e-9, 6) AS hour_of_day, CAST(isodow(ts) - 1 AS DOUBLE) AS day_of_week,
       CAST(dayofyear(ts) AS DOUBLE) AS day_of_year FROM events"""
    q["cyclical_features"] = """SELECT event_id, round(sin(2 * pi() * (hour(ts) + minute(ts) / 60.0::DOUBLE) / 24) + 1e-9, 6) AS hour_sin,
       round(cos(2 * pi() * (hour(ts) + minute(ts) / 60.0::DOUBLE) / 24) + 1e-9, 6) AS hour_cos,
       round(sin(2 * pi() * (isodow(ts) - 1) / 7) + 1e-9, 6) AS day_sin, round(cos(2 * pi() * (isodow(ts) - 1) / 7) + 1e-9, 6) AS day_cos FROM events"""
    q["weekend_flag"] = "SELECT o_orderkey, isodow(o_orderdate) >= 6 AS is_weekend FROM orders"

    # regularisation
    q["dedup_mean"] = sql("SELECT series_id, ts, round(avg(value) + 1e-6, 3) AS value FROM raw GROUP BY 1, 2", cte("raw", ORDERS_RAW))
    q["dedup_first"] = """SELECT o_orderpriority AS series_id, o_orderdate AS ts, o_orderstatus = 'F' AS flag FROM orders
 QUALIFY row_number() OVER (PARTITION BY o_orderpriority, o_orderdate ORDER BY o_orderkey) = 1"""
    q["duplicate_stamps"] = sql("SELECT series_id, ts, count(*) AS copies FROM raw GROUP BY 1, 2 HAVING count(*) > 1", cte("raw", ORDERS_RAW))
    q["resample_mean"] = sql("SELECT series_id, ts, round(value + 1e-9, 6) AS value FROM bins", *bins(EVENTS_RAW, "half"))
    q["resample_first"] = """SELECT event_type AS series_id, time_bucket(INTERVAL 30 MINUTE, ts) AS ts, value > 50 AS flag FROM events
 QUALIFY row_number() OVER (PARTITION BY event_type, time_bucket(INTERVAL 30 MINUTE, ts) ORDER BY ts) = 1"""
    q["regular_grid"] = sql("SELECT series_id, ts FROM reg_grid", *HALF[:-2])
    q["interpolate_time"] = sql("SELECT series_id, ts, round(value + 1e-9, 6) AS value, pos, n, filled FROM reg", *HALF)
    q["interpolate_linear_fill"] = sql(
        "SELECT series_id, ts, round(coalesce(t, p + (q - p) * (CAST(pos - pp AS DOUBLE) / (qp - pp)), p, q) + 1e-9, 6) AS temperature_2m FROM near", *SPARSE
    )
    q["ffill"] = sql("SELECT series_id, ts, round(p + 1e-9, 6) AS temperature_2m FROM near", *SPARSE)
    q["bfill"] = sql("SELECT series_id, ts, round(q + 1e-9, 6) AS temperature_2m FROM near", *SPARSE)
    q["constant_fill"] = sql("SELECT series_id, ts, round(coalesce(t, 0.0) + 1e-9, 6) AS temperature_2m FROM sparse", *SPARSE)
    q["upsample_linear"] = sql(f"SELECT series_id, ts, {r6(*MEASURES)} FROM wx", *weather(MEASURES))
    q["fill_stats"] = sql("SELECT series_id, count(*) AS points, count(*) FILTER (WHERE filled) AS filled FROM reg GROUP BY 1", *HALF)
    q["grid_step_check"] = sql(
        """SELECT series_id, min(d) AS min_step, max(d) AS max_step
  FROM (SELECT series_id, date_diff('second', lag(ts) OVER (PARTITION BY series_id ORDER BY ts), ts) AS d FROM reg) GROUP BY 1""",
        *HALF,
    )
    q["missing_slots"] = sql("SELECT series_id, ts FROM missing", *MARKS)
    q["missing_slots_binned"] = sql("SELECT series_id, ts FROM reg WHERE filled", *HALF)
    q["missing_blocks"] = sql("SELECT * FROM blocks", *MARKS)
    q["top_missing_blocks"] = sql(
        """SELECT *, CAST(row_number() OVER (PARTITION BY series_id ORDER BY slots DESC, start) AS INTEGER) AS rank FROM blocks QUALIFY rank <= 5""", *MARKS
    )
    q["regularise"] = sql(
        """SELECT r.series_id, r.ts, round(r.value + 1e-9, 6) AS value, CASE WHEN coalesce(f.flag, false) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_weekend, r.pos, r.n
  FROM reg r LEFT JOIN flags f USING (series_id, ts)""",
        cte("p", PARSED),
        *regular("SELECT series_id, ts, value FROM p", "half"),
        cte("f1", "SELECT series_id, ts, min_by(is_weekend, event_id) AS flag FROM p WHERE ts IS NOT NULL GROUP BY 1, 2"),
        cte("f2", "SELECT series_id, time_bucket(INTERVAL 30 MINUTE, ts) AS ts, min_by(flag, f1.ts) AS flag FROM f1 GROUP BY 1, 2"),
        cte("fg", "SELECT series_id, unnest(generate_series(min(ts), max(ts), INTERVAL 30 MINUTE)) AS ts FROM f2 GROUP BY 1"),
        cte(
            "flags",
            "SELECT g.series_id, g.ts, last_value(f2.flag IGNORE NULLS) OVER (PARTITION BY g.series_id ORDER BY g.ts) AS flag FROM fg g LEFT JOIN f2 USING (series_id, ts)",
        ),
    )
    q["regular_appended"] = sql("SELECT series_id, ts, round(value + 1e-9, 6) AS value, pos, n, filled FROM reg", *USER_HOURS)
    q["stream_regular_users"] = sql(
        "SELECT series_id, ts, round(value + 1e-9, 6) AS value, pos, filled FROM reg",
        *regular(
            f"SELECT * FROM ({USERS_RAW}) WHERE time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 2 HOUR <= (SELECT max(ts) FROM events WHERE value IS NOT NULL)",
            "hour",
        ),
    )
    q["regularise_users"] = sql("SELECT series_id, ts, round(value + 1e-9, 6) AS value FROM reg", *USER_HOURS)

    # joins
    q["align_inner"] = sql(
        "SELECT series_id, r.ts, round(r.value + 1e-9, 6) AS value, round(w.temperature_2m + 1e-9, 6) AS temperature_2m FROM reg r JOIN wx w USING (series_id, ts)", *HALF, *weather()
    )
    q["align_left_fill"] = sql("SELECT series_id, ts, is_weekend, round(temperature_2m + 1e-9, 6) AS temperature_2m FROM cov", *LEFT_FILLED)
    q["covariates"] = q["align_left_fill"]
    q["feature_matrix"] = sql(f"SELECT series_id, ts, {r6('demand')}, is_weekend, {r6('temperature_2m')}, pos, n FROM feat", *RECENT)
    q["feature_matrix_calendar"] = sql(
        f"""SELECT series_id, ts, {r6('demand', 'temperature_2m', 'relative_humidity_2m')}, is_weekend, pos, n, round(hd + 1e-9, 6) AS hour_of_day,
       dw AS day_of_week, CAST(dayofyear(ts) AS DOUBLE) AS day_of_year, round(sin(2 * pi() * hd / 24) + 1e-9, 6) AS hour_sin,
       round(cos(2 * pi() * hd / 24) + 1e-9, 6) AS hour_cos, round(sin(2 * pi() * dw / 7) + 1e-9, 6) AS day_sin, round(cos(2 * pi() * dw / 7) + 1e-9, 6) AS day_cos
  FROM (SELECT *, hour(ts) + minute(ts) / 60.0::DOUBLE AS hd, CAST(isodow(ts) - 1 AS DOUBLE) AS dw FROM feat)""",
        *FEATURES,
    )
    q["exog_matrix"] = sql("SELECT series_id, ts, pos, n, round(value + 1e-9, 6) AS demand, is_weekend, round(temperature_2m + 1e-9, 6) AS temperature_2m FROM cov", *LEFT_FILLED)
    q["asof_lookup"] = sql(
        """SELECT e.event_id, e.series_id, e.ts, round(h.temperature_2m + 1e-9, 6) AS temperature_2m
  FROM (SELECT event_id, event_type AS series_id, ts - INTERVAL 7 DAY AS ts FROM events) e
  ASOF LEFT JOIN hourly h ON e.series_id = h.series_id AND e.ts >= h.ts""",
        cte("hourly", WEATHER),
    )
    q["asof_fallback"] = sql(
        """SELECT f.series_id, f.ts, round(coalesce(y.value, w.value, m.value) + 1e-6, 3) AS value
  FROM (SELECT *, ts - INTERVAL 365 DAY AS ty, ts - INTERVAL 7 DAY AS tw FROM fut) f
  ASOF LEFT JOIN reg y ON f.series_id = y.series_id AND f.ty >= y.ts
  ASOF LEFT JOIN reg w ON f.series_id = w.series_id AND f.tw >= w.ts
  JOIN (SELECT series_id, avg(value) AS value FROM reg GROUP BY 1) m ON m.series_id = f.series_id""",
        *PRICE_DAYS, future("reg", "day", 14),
    )
    q["asof_raw_stamps"] = """SELECT e.event_id, e.user_id AS series_id, e.ts, p.value AS last_purchase FROM events e ASOF LEFT JOIN
  (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'purchase' GROUP BY 1, 2) p ON e.user_id = p.user_id AND e.ts >= p.ts"""
    q["asof_raw_tolerance"] = """SELECT e.event_id, e.event_type AS series_id, e.ts AS at, e.value, CASE WHEN e.ts - p.ts <= INTERVAL 120 SECOND THEN p.value END AS earlier
  FROM events e ASOF LEFT JOIN (SELECT event_type, ts + INTERVAL 30 SECOND AS ts, max(value) AS value FROM events GROUP BY 1, 2) p ON e.event_type = p.event_type AND e.ts >= p.ts"""
    some = WEATHER.replace("FROM events", "FROM events WHERE event_type <> 'click'")
    q["feature_matrix_some_weather"] = sql(
        f"""SELECT series_id, ts, {r6('demand')}, is_weekend, {r6('temperature_2m')}, pos, n FROM feat UNION ALL
 SELECT series_id, ts, round(value + 1e-9, 6), {WEEKEND}, 0, pos, n FROM reg WHERE series_id = 'click'""",
        *[c.replace(WEATHER, some) for c in FEATURES],
    )
    q["exog_matrix_some_weather"] = sql(
        "SELECT series_id, ts, pos, n, round(value + 1e-9, 6) AS demand, is_weekend, round(temperature_2m + 1e-9, 6) AS temperature_2m FROM cov",
        *[c.replace(WEATHER, some) for c in LEFT_FILLED],
    )
    q["future_covariates"] = sql(
        f"""SELECT f.series_id, f.h, f.ts, {WEEKEND.replace('ts', 'f.ts')}, round(coalesce(y.temperature_2m, w.temperature_2m, m.value) + 1e-9, 6) AS temperature_2m
  FROM (SELECT *, ts - INTERVAL 365 DAY AS ty, ts - INTERVAL 7 DAY AS tw FROM fut) f
  ASOF LEFT JOIN cov y ON f.series_id = y.series_id AND f.ty >= y.ts
  ASOF LEFT JOIN cov w ON f.series_id = w.series_id AND f.tw >= w.ts
  JOIN (SELECT series_id, avg(temperature_2m) AS value FROM cov GROUP BY 1) m ON m.series_id = f.series_id""",
        *LEFT_FILLED, future("reg", "half", 96),
    )
    for name, chain, lags, digits in (("future_by_lag", PRICE_DAYS, (365, 7), "1e-6, 3"), ("future_by_lag_users", USER_DAYS, (28, 7), "1e-9, 6")):
        q[name] = sql(
            f"""SELECT f.series_id, f.h, f.ts, round(coalesce(y.value, w.value, m.value) + {digits}) AS value
  FROM (SELECT *, ts - INTERVAL {lags[0]} DAY AS ty, ts - INTERVAL {lags[1]} DAY AS tw FROM fut) f
  ASOF LEFT JOIN reg y ON f.series_id = y.series_id AND f.ty >= y.ts
  ASOF LEFT JOIN reg w ON f.series_id = w.series_id AND f.tw >= w.ts
  JOIN (SELECT series_id, avg(value) AS value FROM reg GROUP BY 1) m ON m.series_id = f.series_id""",
            *chain, future("reg", "day", 14),
        )
    q["weekly_cycle_covariates"] = sql("SELECT series_id, h, ts, is_weekend, round(temperature_2m + 1e-9, 6) AS temperature_2m FROM ahead", *LEFT_FILLED, *weekly(432))
    q["history_plus_future"] = sql(
        """SELECT series_id, ts, is_weekend, round(temperature_2m + 1e-9, 6) AS temperature_2m FROM cov UNION ALL
 SELECT series_id, ts, is_weekend, round(temperature_2m + 1e-9, 6) FROM ahead""",
        *LEFT_FILLED, *weekly(96),
    )
    q["common_stamps"] = sql("SELECT series_id, ts FROM reg INTERSECT SELECT series_id, ts FROM wx", *HALF, *weather())

    # aggregates and windows
    q["slot_means"] = sql("SELECT series_id, slot, round(mean_value + 1e-9, 6) AS mean_value FROM slots", *HALF, *baselines("reg", "half", 48, 96, 7))
    q["series_profile"] = sql(
        """SELECT series_id, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts, round(min(value) + 1e-9, 6) AS min_value, round(max(value) + 1e-9, 6) AS max_value,
       round(arg_max(value, ts) + 1e-9, 6) AS last_value FROM reg GROUP BY 1""",
        *USER_HOURS,
    )
    q["forecast_summary"] = sql(
        """SELECT series_id, model, count(*) AS steps, round(min(yhat) + 1e-9, 6) AS min_yhat, round(max(yhat) + 1e-9, 6) AS max_yhat, round(avg(yhat) + 1e-9, 6) AS mean_yhat
  FROM fc GROUP BY 1, 2""",
        *USER_HOURS, *baselines("reg", "hour", 24, 48, 7),
    )
    lags = cte("tail", "SELECT series_id, ts, value, pos FROM reg WHERE pos >= n - 336")
    q["seasonal_lag"] = sql(
        """SELECT series_id, ts, round(value + 1e-9, 6) AS value, round(lag(value, 48) OVER (PARTITION BY series_id ORDER BY ts) + 1e-9, 6) AS lag_value FROM tail""", *HALF, lags
    )
    q["seasonal_lag_mean"] = sql(
        """SELECT t.series_id, t.ts, round(any_value(t.value) + 1e-9, 6) AS value, round(avg(e.value) + 1e-9, 6) AS lag_mean
  FROM tail t LEFT JOIN tail e ON e.series_id = t.series_id AND e.pos < t.pos AND (t.pos - e.pos) % 48 = 0 GROUP BY 1, 2""",
        *HALF, lags,
    )
    q["lookback_windows"] = sql(
        """SELECT series_id, ts, pos, round(demand + 1e-9, 6) AS target, round(sum(temperature_2m) OVER w + 1e-9, 6) AS heat, count(*) OVER w AS size,
       round(first_value(demand) OVER w + 1e-9, 6) AS oldest, round(lag(demand) OVER (PARTITION BY series_id ORDER BY ts) + 1e-9, 6) AS newest, round(sum(demand) OVER w + 1e-9, 6) AS total
  FROM feat WINDOW w AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 144 PRECEDING AND 1 PRECEDING) QUALIFY pos >= 144""",
        *FEATURES,
    )
    q["lookback_capped"] = sql(
        """SELECT series_id, ts, pos, round(value + 1e-6, 3) AS target, count(*) OVER w AS size,
       round(first_value(value) OVER w + 1e-6, 3) AS oldest, round(lag(value) OVER (PARTITION BY series_id ORDER BY ts) + 1e-6, 3) AS newest, round(sum(value) OVER w + 1e-6, 3) AS total
  FROM reg WINDOW w AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 144 PRECEDING AND 1 PRECEDING)
 QUALIFY pos >= greatest(144, n - least(2000, n - 144))""",
        *PRICE_DAYS,
    )
    q["horizon_targets"] = sql(
        """SELECT series_id, ts, round(value + 1e-9, 6) AS first_target, round(lead(value, 95) OVER (PARTITION BY series_id ORDER BY ts) + 1e-9, 6) AS last_target,
       round(sum(value) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND 95 FOLLOWING) + 1e-9, 6) AS total FROM reg QUALIFY pos + 96 <= n""",
        *HALF,
    )
    q["chrono_split"] = sql("SELECT series_id, ts, CASE WHEN pos < floor(0.8 * n) THEN 'train' ELSE 'test' END AS part FROM feat", *FEATURES)
    q["holdout_split"] = sql(
        "SELECT series_id, ts, CASE WHEN row_number() OVER (PARTITION BY series_id ORDER BY ts DESC) <= 336 THEN 'validation' ELSE 'train' END AS part FROM reg", *HALF
    )

    # scaling
    three = ("demand", "is_weekend", "temperature_2m")
    fit = ", ".join(f"round(min({c}) + 1e-9, 6) AS {c}_min, round(max({c}) + 1e-9, 6) AS {c}_max" for c in three)
    q["minmax_fit"] = sql(f"SELECT series_id, {fit} FROM feat GROUP BY 1", *FEATURES)
    q["minmax_fit_train"] = sql(f"SELECT series_id, {fit} FROM feat WHERE pos < floor(0.8 * n) GROUP BY 1", *FEATURES)
    scaled = ", ".join(
        f"round(CASE WHEN max({c}) OVER s = min({c}) OVER s THEN 0.0 ELSE ({c} - min({c}) OVER s) / nullif(max({c}) OVER s - min({c}) OVER s, 0) END + 1e-9, 6) AS {c}" for c in three
    )
    q["minmax_transform"] = sql(f"SELECT series_id, ts, {scaled} FROM feat WINDOW s AS (PARTITION BY series_id)", *FEATURES)
    q["minmax_inverse"] = sql("SELECT series_id, ts, round(demand + 1e-9, 6) AS demand FROM feat", *FEATURES)

    # forecasts
    base = baselines("reg", "half", 48, 96, 7)
    q["fc_seasonal_naive"] = sql(f"SELECT series_id, 'seasonal_naive' AS model, h, ts, round(yhat + 1e-9, 6) AS yhat, {used(chr(39) + 'seasonal_naive' + chr(39))} FROM naive", *HALF, *base)
    q["fc_kday_average"] = sql(f"SELECT series_id, 'kday_average' AS model, h, ts, round(yhat + 1e-9, 6) AS yhat, {used(chr(39) + 'kday_average' + chr(39))} FROM kday", *HALF, *base)
    q["fc_persistence"] = sql(
        f"SELECT series_id, 'seasonal_naive' AS model, h, ts, round(yhat + 1e-9, 6) AS yhat, {used(chr(39) + 'seasonal_naive' + chr(39))} FROM naive",
        *USER_DAYS, *baselines("reg", "day", 30, 14, 1),
    )
    q["future_index"] = sql("SELECT series_id, h, ts FROM fut", *USER_HOURS, future("reg", "hour", 48))
    q["fc_ar1"] = sql("SELECT series_id, 'ar1' AS model, h, ts, round(yhat + 1e-9, 6) AS yhat, 'ar1' AS model_used FROM ar", *HALF, *ar1("reg", "half", 48, 96))
    q["fc_direct_horizon"] = sql(
        """SELECT series_id, 'direct_horizon' AS model, CAST(h AS INTEGER) AS h, ts + h * INTERVAL 30 MINUTE AS ts,
       round((b0 + b1 * x1 + b2 * x2 + b3 * x3) * (hi - lo) + lo + 1e-9, 6) AS yhat, 'direct_horizon' AS model_used
  FROM asked JOIN coef USING (h) WHERE pos = n - 1""",
        *HALF, *direct(96, 336, 48, 336),
    )
    q["fc_lag_recursive"] = sql(
        """SELECT series_id, 'lag_recursive' AS model, CAST(i - behind AS INTEGER) AS h, last_ts + (i - behind) * INTERVAL 30 MINUTE AS ts,
       round(path[-1] * (hi - lo) + lo + 1e-9, 6) AS yhat, 'lag_recursive' AS model_used FROM rolled WHERE i > behind""",
        *[c.replace("w.temperature_2m, w.relative_humidity_2m", "w.temperature_2m").replace(" AND w.relative_humidity_2m IS NOT NULL", "") for c in FEATURES],
        *recursive(96, 48),
    ).replace("WITH ", "WITH RECURSIVE ", 1)
    q["fc_ar_p"] = sql(
        searched("ar_p", 500), *USER_HOURS, *baselines("reg", "hour", 24, 48, 7), cte("base", "SELECT * FROM reg"),
        *order_search("reg", "hour", 24, 48, 2, 500),
    ).replace("WITH ", "WITH RECURSIVE ", 1)
    ahead = cte(
        "ahead",
        f"""SELECT f.series_id, f.h, {WEEKEND.replace('ts)', 'f.ts)')}, coalesce(y.temperature_2m, w.temperature_2m, m.value) AS temperature_2m
  FROM (SELECT *, ts - INTERVAL 365 DAY AS ty, ts - INTERVAL 7 DAY AS tw FROM fut) f
  ASOF LEFT JOIN cov y ON f.series_id = y.series_id AND f.ty >= y.ts
  ASOF LEFT JOIN cov w ON f.series_id = w.series_id AND f.tw >= w.ts
  JOIN (SELECT series_id, avg(temperature_2m) AS value FROM cov GROUP BY 1) m ON m.series_id = f.series_id""",
    )
    q["fc_ar_exog"] = sql(
        searched("ar_exog", 500), *LEFT_FILLED, *baselines("cov", "half", 48, 96, 7), cte("base", "SELECT * FROM cov"), ahead,
        *order_search("cov", "half", 48, 96, 3, 500, ("is_weekend", "temperature_2m")),
    ).replace("WITH ", "WITH RECURSIVE ", 1)
    for name, order in (("fc_arma_fixed", ((0, 1, 1), (0, 1, 1))), ("fc_arma_seasonal", ((1, 0, 1), (1, 0, 1)))):
        q[name] = sql(
            f"""SELECT series_id, 'arma' AS model, h, ts, {r6('yhat')}, 'arma' AS model_used, {r6('lower', 'upper')}, '({",".join(map(str, order[0]))})({",".join(map(str, order[1]))})' AS "order" FROM arma UNION ALL
 SELECT series_id, 'arma', h, ts, {r6('yhat')}, {used("'kday_average_7'")}, NULL, NULL, NULL FROM kday WHERE series_id IN (SELECT series_id FROM reg GROUP BY 1 HAVING count(*) < 500)""",
            *USER_HOURS, *baselines("reg", "hour", 24, 48, 7), *arma("reg", "hour", 24, 48, order, 500),
        ).replace("WITH ", "WITH RECURSIVE ", 1)
    q["fc_basis"] = sql(
        f"""SELECT series_id, 'basis' AS model, h, ts, round(trend + season + 1e-7, 4) AS yhat, 'basis' AS model_used, round(trend + 1e-7, 4) AS trend, round(season + 1e-7, 4) AS season,
       round(trend + season - half + 1e-7, 4) AS lower, round(trend + season + half + 1e-7, 4) AS upper FROM bfc""",
        *HALF, *basis("reg", 48, 96),
    )
    q["basis_decompose"] = sql(
        f"SELECT series_id, ts, round(y + 1e-7, 4) AS value, round(trend + 1e-7, 4) AS trend, round(season + 1e-7, 4) AS season, round(y - trend - season + 1e-7, 4) AS remainder FROM bpart", *HALF, *basis("reg", 48, 96)
    )
    near = analogues("reg", 96, 144, 24)
    q["nearest_windows"] = sql(
        """SELECT w.series_id, CAST(rank AS INTEGER) AS rank, origin, round(distance + 1e-7, 4) AS distance, round((a.value - m) / s + 1e-7, 4) AS first, round((b.value - m) / s + 1e-7, 4) AS last
  FROM nearw w JOIN reg a ON a.series_id = w.series_id AND a.pos = origin JOIN reg b ON b.series_id = w.series_id AND b.pos = origin + 95""",
        *HALF, *near,
    )
    q["fc_analogue"] = sql(
        """SELECT f.series_id, 'analogue' AS model, CAST(h AS INTEGER) AS h, last_ts + h * INTERVAL 30 MINUTE AS ts, round(qm + qs * z + 1e-7, 4) AS yhat, 'analogue' AS model_used
  FROM anfc f JOIN an_l USING (series_id) JOIN (SELECT series_id, any_value(qm) AS qm, any_value(qs) AS qs FROM an_q GROUP BY 1) USING (series_id)""",
        *HALF, *near,
    )
    for name, chain, most in (("stationarity_lagged", HALF, 24), ("stationarity_lagged_users", USER_DAYS, 9)):
        q[name] = sql(STATIONARITY, *chain, *unit_root("reg", most))
    q["interval_coverage"] = sql(
        """SELECT series_id, f.model, CAST(count(v.y) AS BIGINT) AS n,
       round(avg(CASE WHEN f.lower IS NULL THEN NULL WHEN v.y BETWEEN f.lower AND f.upper THEN 1.0 ELSE 0.0 END) + 1e-9, 6) AS coverage
  FROM found f JOIN valid v USING (series_id, ts) GROUP BY 1, 2""",
        *USER_HOURS, *holdout("reg", 168), *baselines("train", "hour", 24, 168, 7), cte("base", "SELECT * FROM train"),
        *order_search("train", "hour", 24, 168, 2, 500),
        cte(
            "found",
            """SELECT series_id, 'ar_p' AS model, ts, lower, upper FROM arp UNION ALL
 SELECT series_id, 'ar_p', ts, NULL, NULL FROM kday WHERE series_id IN (SELECT series_id FROM base GROUP BY 1 HAVING count(*) < 500)""",
        ),
    ).replace("WITH ", "WITH RECURSIVE ", 1)
    q["models_used"] = sql(
        """SELECT series_id, model, CASE WHEN n >= need THEN used WHEN n < 24 THEN 'persistence' ELSE 'kday_average_7' END AS model_used, CAST(48 AS BIGINT) AS steps
  FROM (SELECT series_id, count(*) AS n FROM reg GROUP BY 1),
       (VALUES ('seasonal_naive', 'seasonal_naive', 24), ('kday_average', 'kday_average', 24), ('ar1', 'ar1', 0), ('ar_p', 'ar_p', 500),
               ('lag_recursive', 'lag_recursive', 168), ('direct_horizon', 'direct_horizon', 168)) AS m(model, used, need)""",
        *regular(
            "SELECT user_id || '/all' AS series_id, ts, value FROM events UNION ALL "
            "SELECT user_id || '/' || strftime(date_trunc('week', ts), '%Y-%m-%d'), ts, value FROM events", "hour",
        ),
    )
    q["seasonal_decompose"] = sql(
        """SELECT t.series_id, t.ts, round(t.value + 1e-9, 6) AS value, round(trend + 1e-9, 6) AS trend, round(m.mean_rest - c.centre + 1e-9, 6) AS season,
       round(t.value - trend - (m.mean_rest - c.centre) + 1e-9, 6) AS remainder
  FROM trended t JOIN means m ON m.series_id = t.series_id AND m.slot = t.pos % 48
  JOIN (SELECT series_id, avg(mean_rest) AS centre FROM means GROUP BY 1) c ON c.series_id = t.series_id""",
        *HALF,
        cte(
            "trended",
            """SELECT r.*, CASE WHEN r.pos >= 24 AND r.pos < r.n - 24 THEN (avg(value) OVER a + avg(value) OVER b) / 2 END AS trend FROM reg r
 WINDOW a AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 24 PRECEDING AND 23 FOLLOWING),
        b AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 23 PRECEDING AND 24 FOLLOWING)""",
        ),
        cte("means", "SELECT series_id, pos % 48 AS slot, avg(value - trend) AS mean_rest FROM trended GROUP BY 1, 2"),
    )
    q["fc_ensemble_mean"] = sql(
        """SELECT series_id, 'ensemble_mean' AS model, h, ts, round((a.yhat + b.yhat) / 2 + 1e-9, 6) AS yhat, 'ensemble_mean' AS model_used
  FROM naive a JOIN kday b USING (series_id, h, ts)""",
        *HALF, *base,
    )
    q["fc_with_fallback"] = sql(
        f"""SELECT series_id, 'ar1' AS model, h, ts, round(yhat + 1e-9, 6) AS yhat, 'ar1' AS model_used FROM ar
  WHERE series_id IN (SELECT series_id FROM reg GROUP BY 1 HAVING count(*) >= 28) UNION ALL
 SELECT series_id, 'kday_average_4', h, ts, round(yhat + 1e-9, 6), {used(chr(39) + 'kday_average_4' + chr(39))} FROM kday
  WHERE series_id IN (SELECT series_id FROM reg GROUP BY 1 HAVING count(*) < 28)""",
        *USER_DAYS, *ar1("reg", "day", 7, 14), *baselines("reg", "day", 7, 14, 4),
    )

    # evaluation
    errors = r6("mape", "mape_nonzero", "mse", "rmse", "wmape")
    q["metric_mape_nonzero"] = sql("SELECT series_id, model, round(mape_nonzero + 1e-9, 6) AS mape_nonzero FROM scores", *USER_SCORES)
    q["metrics_by_model"] = sql(
        f"SELECT series_id, model, n, {errors} FROM scores UNION ALL SELECT DISTINCT series_id, 'persistence', 0, NULL, NULL, NULL, NULL, NULL FROM reg", *HALF_SCORES
    )
    q["backtest_seasonal"] = sql(
        """SELECT series_id, model, CAST(count(yhat) AS BIGINT) AS n, round(avg(abs((value - yhat) / nullif(value, 0))) * 100 + 1e-9, 6) AS mape_nonzero,
       round(sqrt(avg((value - yhat) * (value - yhat))) + 1e-9, 6) AS rmse
  FROM (SELECT series_id, ts, value, 'seasonal_naive' AS model, l[1] AS yhat FROM lagged UNION ALL
        SELECT series_id, ts, value, 'slot_average', list_avg(l) FROM lagged) GROUP BY 1, 2""",
        *HALF,
        cte("tail", "SELECT series_id, ts, value FROM reg WHERE pos >= n - 336 AND n >= 384"),
        cte(
            "lagged",
            "SELECT series_id, ts, value, [" + ", ".join(f"lag(value, {48 * i}) OVER w" for i in range(1, 8)) + "] AS l FROM tail WINDOW w AS (PARTITION BY series_id ORDER BY ts)",
        ),
    )
    q["backtest_holdout"] = sql(f"SELECT series_id, model, n, {errors} FROM scores", *USER_SCORES)
    q["best_model"] = sql(f"SELECT series_id, metric, {r6('seasonal_naive', 'kday_average')}, best_model FROM best", *USER_SCORES, LONG, BEST)
    q["improvement_over_baseline"] = sql(
        """SELECT l.series_id, l.model, l.metric, round(l.score + 1e-9, 6) AS score, round(b.score + 1e-9, 6) AS base_score,
       round((b.score - l.score) / nullif(b.score, 0) * 100 + 1e-9, 6) AS improvement,
       coalesce(printf('%+.1f%%', (b.score - l.score) / nullif(b.score, 0) * 100), 'N/A') AS improvement_text
  FROM long l JOIN long b ON b.series_id = l.series_id AND b.metric = l.metric AND b.model = 'seasonal_naive' WHERE l.model <> 'seasonal_naive'""",
        *HALF, *holdout("reg", 336),
        *[c.replace("fc AS (", "fc2 AS (", 1) if c.startswith("fc AS (") else c for c in baselines("train", "half", 48, 336, 7)],
        *ar1("train", "half", 48, 336),
        cte("fc", "SELECT model, series_id, ts, yhat FROM fc2 UNION ALL SELECT 'ar1', series_id, ts, yhat FROM ar"),
        METRICS, LONG,
    )
    q["stationarity_df"] = sql(
        """SELECT series_id, n, round(b / se + 1e-9, 6) AS stat, b / se < -2.86 AS stationary
  FROM (SELECT series_id, count(*) AS n, any_value(b) AS b, sqrt(sum((d - a - b * l) * (d - a - b * l)) / (count(*) - 2) / sum((l - ml) * (l - ml))) AS se
          FROM (SELECT p.*, regr_slope(d, l) OVER s AS b, regr_intercept(d, l) OVER s AS a, avg(l) OVER s AS ml
                  FROM pairs p WINDOW s AS (PARTITION BY series_id)) GROUP BY 1)""",
        *HALF,
        cte(
            "pairs",
            """SELECT series_id, value - lag(value) OVER (PARTITION BY series_id ORDER BY ts) AS d, lag(value) OVER (PARTITION BY series_id ORDER BY ts) AS l
  FROM reg QUALIFY l IS NOT NULL""",
        ),
    )
    return q


# No SQL: the hold-out scores of all models at once, each of which has SQL of its own, and searches
# over many fits, which tests compare with numpy.
WITHOUT_SQL = ("backtest_all_models", "best_of_all_models", "fc_arma", "fc_arma_exog", "fc_stacked_horizon", "fc_boosted_recursive", "backtest_fitted_models")


def oracle_sql() -> dict[str, str]:
    return _queries()

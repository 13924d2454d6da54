"""SQL counterparts of the registered queries, built from shared common table expressions."""

from __future__ import annotations

FEATURES = ("temp", "rh", "pres", "wind", "solar", "rain")
AUX = ("hour_sin", "hour_cos", "doy_sin", "doy_cos", "theo_solar")
INPUTS = FEATURES + AUX
RES = {"temp": 0.1, "rh": 0.1, "pres": 0.1, "wind": 0.1, "solar": 1.0, "rain": 0.1}
LIMITS = {"temp": 5, "rh": 20, "pres": 10, "wind": 5, "solar": 100, "rain": 1}


def each(template: str, names=FEATURES, sep: str = ", ") -> str:
    return sep.join(template.replace("#", f) for f in names)


def r(expr: str, name: str | None = None) -> str:
    """Six decimals by the same floating-point steps as the Spark side: engines differ on ties."""
    return f"floor(({expr}) * 1e6 + 0.5) / 1e6 AS {name or expr}"


def rounded(names) -> str:
    return ", ".join(r(n) for n in names)


def query(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(dict.fromkeys(ctes)) + "\n" + select


# --- inputs -------------------------------------------------------------------------------


def tel(station: str = "event_type", name: str = "tel") -> list[str]:
    return [
        f"""{name} AS (
  SELECT station_id, ts, event_id, u - 4 AS temp, k::double AS rh, k + 950::double AS pres,
         v / 16 AS wind, CASE WHEN k >= 5 THEN k * 10::double END AS solar,
         CASE WHEN k <= 95 THEN greatest(v - 100, 0) / 8 END AS rain
  FROM (SELECT {station}::varchar AS station_id, ts, event_id, floor(value / 8) AS u, floor(value * 16) / 16 AS v,
               regexp_extract(props, '([0-9]+)', 1)::int AS k FROM events))"""
    ]


GRID = """grid AS (
  SELECT valid_time, latitude, longitude, avg(u) + 270 AS t2m, avg(u) / 2 + 268 AS d2m,
         avg(k) * 100 + 95000 AS sp, avg(v) / 32 AS u10, max(v) / 64 AS v10,
         avg(k) * 36000 AS ssrd, max(v) / 65536 AS tp
  FROM (SELECT date_trunc('hour', ts) AS valid_time, 40 + floor(k / 10) / 4 AS latitude,
               5 + (k % 10) / 4::double AS longitude, k, u, v
        FROM (SELECT ts, floor(value / 8) AS u, floor(value * 16) / 16 AS v,
                     regexp_extract(props, '([0-9]+)', 1)::int AS k FROM events))
  GROUP BY ALL)"""

STATIONS = """stations AS (
  SELECT c_custkey::varchar AS station_id, 40 + floor(c_acctbal) / 4096 AS latitude,
         5 + c_nationkey / 8::double AS longitude FROM customer)"""

BUSY = """busy AS (
  SELECT f.station_id, s.latitude, s.longitude
  FROM (SELECT event_type AS station_id, arg_min(user_id, event_id)::varchar AS reporter
        FROM events GROUP BY 1) f JOIN stations s ON s.station_id = f.reporter)"""


def cells(stations: str) -> str:
    axis = lambda a: f"""(SELECT station_id, g FROM {stations}, (SELECT DISTINCT {a} AS g FROM grid)
      QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY abs(g - {a}), g DESC) = 1)"""
    return f"""cells AS (
  SELECT s.station_id, s.latitude, s.longitude, la.g AS cell_latitude, lo.g AS cell_longitude
  FROM {stations} s JOIN {axis('latitude')} la USING (station_id) JOIN {axis('longitude')} lo USING (station_id))"""


RH = lambda t, d: (
    f"least(greatest(100 * exp(17.625 * ({d}) / (243.04 + ({d}))) / "
    f"exp(17.625 * ({t}) / (243.04 + ({t}))), 0), 100)"
)

ERA5 = f"""era5 AS (
  SELECT valid_time, latitude, longitude, t2m - 273.15 AS temp_era5,
         {RH('t2m - 273.15', 'd2m - 273.15')} AS rh_era5, sp / 100 AS pres_era5,
         sqrt(u10 * u10 + v10 * v10) AS wind_era5, ssrd / 3600 AS solar_era5, tp * 1000 AS rain_era5
  FROM grid)"""

# --- hourly series ------------------------------------------------------------------------

HOURLY = """res AS (
  SELECT station_id, date_trunc('hour', ts) AS ts, avg(temp - 1.5) AS temp, avg(rh) AS rh, avg(pres) AS pres,
         avg(wind) AS wind, avg(solar) AS solar, max(rain) AS rain FROM tel GROUP BY ALL)"""


def dense(src: str = "res", name: str = "dense") -> str:
    return f"""{name} AS (
  SELECT g.station_id, g.ts, {each('s.#')}
  FROM (SELECT station_id, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts
        FROM {src} GROUP BY station_id) g LEFT JOIN {src} s ON s.station_id = g.station_id AND s.ts = g.ts)"""


def near(src: str = "dense", name: str = "near") -> str:
    cols = each(
        "#, last_value(# IGNORE NULLS) OVER b AS #_p, "
        "last_value(CASE WHEN # IS NOT NULL THEN epoch(ts) END IGNORE NULLS) OVER b AS #_pt, "
        "first_value(# IGNORE NULLS) OVER a AS #_n, "
        "first_value(CASE WHEN # IS NOT NULL THEN epoch(ts) END IGNORE NULLS) OVER a AS #_nt"
    )
    return f"""{name} AS (
  SELECT station_id, ts, {cols} FROM {src}
  WINDOW b AS (PARTITION BY station_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         a AS (PARTITION BY station_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


def line(f: str, limit: int | None = 7200) -> str:
    cut = f"WHEN epoch(ts) - {f}_pt > {limit} THEN NULL " if limit else ""
    return (
        f"CASE WHEN {f} IS NOT NULL THEN {f} WHEN {f}_pt IS NULL THEN NULL {cut}"
        f"WHEN {f}_nt IS NULL THEN {f}_p "
        f"ELSE {f}_p + ({f}_n - {f}_p) / ({f}_nt - {f}_pt) * (epoch(ts) - {f}_pt) END"
    )


def quantise(x: str, res: float) -> str:
    return f"(round_even(({x}) / {res}::double, 0) * {res}::double)"


def guard(f: str, x: str) -> str:
    if f in ("wind", "solar", "rain", "rh"):
        x = f"CASE WHEN {x} IS NOT NULL THEN greatest({x}, 0) END"
    if f in ("wind", "solar", "rain"):
        x = f"CASE WHEN ({x}) < {RES[f]}::double / 2 THEN 0 ELSE ({x}) END"
    return quantise(x, RES[f])


def interp(src: str = "near", name: str = "interp", limit: int | None = 7200) -> str:
    cols = ", ".join(f"{line(f, limit)} AS {f}" for f in FEATURES)
    return f"{name} AS (SELECT station_id, ts, {cols} FROM {src})"


CLEAN = "clean AS (SELECT station_id, ts, " + ", ".join(
    f"{guard(f, f)} AS {f}" if f in ("rain", "rh", "solar", "wind") else f for f in FEATURES
) + " FROM interp)"


def hourly(station: str = "event_type") -> list[str]:
    return [*tel(station), HOURLY, dense(), near(), interp(), CLEAN]


def matches(station: str = "event_type") -> list[str]:
    places = "busy" if station == "event_type" else "stations"
    extra = [STATIONS, BUSY] if station == "event_type" else [STATIONS]
    return [
        *hourly(station),
        GRID,
        *extra,
        cells(places),
        ERA5,
        f"""matches AS (
  SELECT h.station_id, h.ts, {each('e.#_era5')}, {each('h.# AS #_eco')}
  FROM clean h LEFT JOIN cells c ON c.station_id = h.station_id
  LEFT JOIN era5 e ON e.valid_time = h.ts AND e.latitude = c.cell_latitude AND e.longitude = c.cell_longitude)""",
    ]


BIAS = (
    "bias AS (SELECT station_id, ts, "
    + each("#_eco AS ecowitt_#, #_era5 AS era5_#, #_eco - #_era5 AS bias_#")
    + ", CASE WHEN "
    + " OR ".join(f"abs({f}_eco - {f}_era5) > {LIMITS[f]}" for f in FEATURES)
    + " THEN 1 ELSE 0 END AS bias_overflow_flag FROM matches)"
)
BIAS_COLS = [c for f in FEATURES for c in (f"ecowitt_{f}", f"era5_{f}", f"bias_{f}")]

# --- solar and cyclic ---------------------------------------------------------------------


def sky(ts: str, lat: str, lon: str, rh: str | None = None) -> str:
    doy = f"dayofyear({ts})"
    b = f"radians(360::double * ({doy} - 81) / 365)"
    eot = f"(9.87 * sin(2 * {b}) - 7.53 * cos({b}) - 1.5 * sin({b}))"
    hour = f"(hour({ts}) + minute({ts}) / 60::double + second({ts}) / 3600::double)"
    ha = f"radians(15 * ({hour} + {lon} / 15 + {eot} / 60 - 12))"
    dec = f"radians(23.45 * sin(radians(360::double * (284 + {doy}) / 365)))"
    se = f"sin(radians({lat})) * sin({dec}) + cos(radians({lat})) * cos({dec}) * cos({ha})"
    out = f"1000 * greatest(sin(asin(least(greatest({se}, -1), 1))), 0)"
    if rh:
        out = f"{out} * exp(-0.35 * CASE WHEN {rh} IS NOT NULL THEN least(greatest({rh} / 100, 0), 1) END)"
    return f"({out})"


def cyclic(ts: str) -> str:
    hour = f"(hour({ts}) + minute({ts}) / 60::double)"
    return (
        f"sin(2 * pi() * {hour} / 24) AS hour_sin, cos(2 * pi() * {hour} / 24) AS hour_cos, "
        f"sin(2 * pi() * dayofyear({ts}) / 365.25) AS doy_sin, cos(2 * pi() * dayofyear({ts}) / 365.25) AS doy_cos"
    )


def features() -> list[str]:
    full = ", ".join(f"coalesce({line(f, None)}, {f}_n) AS {f}" for f in FEATURES)
    any_null = " OR ".join(f"{f} IS NULL" for f in FEATURES)
    return [
        *hourly(),
        STATIONS,
        BUSY,
        near("clean", "near2"),
        f"gapfree AS (SELECT station_id, ts, {full}, ({any_null}) AS filled FROM near2)",
        f"""feat AS (SELECT g.station_id, g.ts, {each('#')}, {cyclic('g.ts')},
  {sky('g.ts', 'latitude', 'longitude', 'rh')} AS theo_solar, filled
  FROM gapfree g JOIN busy USING (station_id))""",
    ]


REFS = """refs AS (
  SELECT f.station_id, f.ts AS ts_ref FROM feat f
  JOIN (SELECT station_id, min(ts) AS lo, max(ts) AS hi FROM feat GROUP BY 1) b USING (station_id)
  WHERE f.ts >= lo + INTERVAL 23 HOUR AND f.ts <= hi - INTERVAL 6 HOUR)"""

# --- forecasts ----------------------------------------------------------------------------

PRED = [f"pred_{f}" for f in FEATURES]


def forecast(station: str = "event_type") -> list[str]:
    return [
        *hourly(station),
        f"means AS (SELECT station_id, ts, {each('floor(avg(#) OVER w * 1e6 + 0.5) / 1e6 AS m_#')} FROM clean "
        "WINDOW w AS (PARTITION BY station_id, hour(ts) ORDER BY ts ROWS UNBOUNDED PRECEDING))",
        f"""origins AS (SELECT c.*, u.horizon, c.ts + INTERVAL 1 HOUR * u.horizon AS target
  FROM clean c, (SELECT unnest(generate_series(1, 6))::int AS horizon) u)""",
        f"""forecast AS (
  SELECT station_id, target AS ts, 'persistence' AS model_version, ts AS created_at,
         ts - INTERVAL 23 HOUR AS ts_window_start, ts AS ts_window_stop, horizon, {each('# AS pred_#')} FROM origins
  UNION ALL
  SELECT o.station_id, target, 'climatology', o.ts, o.ts - INTERVAL 23 HOUR, o.ts, horizon, {each('m_#')}
  FROM origins o JOIN means m ON m.station_id = o.station_id AND m.ts = target - INTERVAL 24 HOUR)""",
    ]


def evaluated() -> list[str]:
    return [*forecast(), *matches(), BIAS]


MART_COLS = (
    PRED
    + [f"actual_{f}" for f in FEATURES]
    + [f"{f}_era5" for f in FEATURES]
    + [f"{p}_{f}" for p in ("delta", "abs_error", "perc_error") for f in FEATURES]
)


def mart(where: str = "true") -> list[str]:
    preds = ", ".join(
        f"CASE WHEN pred_{f} > 0 THEN pred_{f} ELSE 0 END AS pred_{f}" if f in ("solar", "rain") else f"pred_{f}"
        for f in FEATURES
    )
    return [
        *evaluated(),
        f"shown AS (SELECT station_id, ts, model_version, created_at, {preds} FROM forecast WHERE {where})",
        f"""mart AS (
  SELECT p.*, {each('a.# AS actual_#')}, {each('e.era5_# AS #_era5')}, {each('p.pred_# - a.# AS delta_#')},
         {each('abs(p.pred_# - e.era5_#) AS abs_error_#')},
         {each('abs(p.pred_# - e.era5_#) / nullif(e.era5_#, 0) * 100 AS perc_error_#')}
  FROM shown p LEFT JOIN (SELECT * FROM clean WHERE temp IS NOT NULL) a ON a.station_id = p.station_id AND a.ts = p.ts
  LEFT JOIN bias e ON e.station_id = p.station_id AND e.ts = p.ts)""",
    ]


def reconciled() -> list[str]:
    base = "CASE WHEN m.ts IS NOT NULL THEN coalesce(b.bias_#, 0) END"
    return [
        *evaluated(),
        f"""reconciled AS (
  SELECT f.*, {each('m.#_eco AS actual_#')}, {each('f.pred_# - m.#_eco AS diff_#')},
         {each(base + ' AS historical_bias_#')}, {each('f.pred_# - m.#_eco - ' + base + ' AS drift_vs_bias_#')}
  FROM forecast f LEFT JOIN matches m ON m.station_id = f.station_id AND m.ts = f.ts
  LEFT JOIN bias b ON b.station_id = f.station_id AND b.ts = f.ts)""",
    ]


RECONCILED_COLS = PRED + [
    f"{p}_{f}" for f in FEATURES for p in ("actual", "diff", "historical_bias", "drift_vs_bias")
]
PUBLIC = [
    n.replace("#", f)
    for n in ("pred_#", "diff_#", "historical_bias_#", "drift_vs_bias_#", "#_era5", "abs_error_#")
    for f in FEATURES
]


def public() -> list[str]:
    nulls = each("NULL::double")
    filled = " + ".join(f"({c} IS NOT NULL)::int" for c in ["created_at", *PUBLIC])
    cols = ", ".join(PUBLIC)
    return [
        *mart(),
        *reconciled(),
        f"""runs AS (
  SELECT station_id, ts, created_at, model_version, {each('pred_#')}, {each('diff_#')},
         {each('historical_bias_#')}, {each('drift_vs_bias_#')} FROM reconciled
  UNION ALL SELECT station_id, ts, created_at, model_version, {each('pred_#')}, {nulls}, {nulls}, {nulls} FROM forecast)""",
        f"""public AS (
  SELECT station_id, ts, created_at, model_version, {cols} FROM (
    SELECT u.*, {each('q.#_era5')}, {each('q.abs_error_#')} FROM runs u
    LEFT JOIN mart q ON q.station_id = u.station_id AND q.ts = u.ts
      AND q.model_version = u.model_version AND q.created_at = u.created_at)
  QUALIFY row_number() OVER (PARTITION BY station_id, ts, model_version
    ORDER BY {filled} DESC, (created_at IS NULL) DESC, created_at DESC) = 1)""",
    ]


def series() -> list[str]:
    def one(f):
        actual = f"pred_{f} - diff_{f}"
        if f in ("wind", "solar", "rain"):
            actual = f"CASE WHEN {actual} IS NOT NULL THEN greatest({actual}, 0) END"
        elif f == "rh":
            actual = f"CASE WHEN {actual} IS NOT NULL THEN least(greatest({actual}, 0), 100) END"
        return f"""SELECT station_id, ts, ts + INTERVAL 1 HOUR AS ts_local, (ts + INTERVAL 1 HOUR)::date AS local_day,
  '{f}' AS feature, pred_{f} AS pred, {actual} AS actual, {f}_era5 AS era5, abs_error_{f} AS abs_error,
  historical_bias_{f} AS bias, drift_vs_bias_{f} AS drift FROM hours"""

    return [
        *public(),
        """hours AS (SELECT * FROM public
  QUALIFY row_number() OVER (PARTITION BY station_id, date_trunc('hour', ts) ORDER BY created_at DESC, model_version DESC) = 1)""",
        "series AS (" + "\nUNION ALL ".join(one(f) for f in FEATURES) + ")",
    ]

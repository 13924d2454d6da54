"""Feature catalog, column schemes, sensor specs and table schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

# The canonical feature order. Matrices and sample arrays rely on it.
FEATURES = ("temp", "rh", "pres", "wind", "solar", "rain")
AUX_FEATURES = ("hour_sin", "hour_cos", "doy_sin", "doy_cos", "theo_solar")
INPUT_FEATURES = FEATURES + AUX_FEATURES

# The column name of every feature in each naming scheme.
SCHEMES = {
    "feature": dict(zip(FEATURES, FEATURES)),
    "raw": {
        "temp": "outdoor_temperature_c",
        "rh": "outdoor_humidity",
        "pres": "abs_pressure_hpa",
        "wind": "wind_m_s",
        "solar": "solar_rad_w_m2",
        "rain": "hourly_rain_mm",
    },
    "standard": {
        "temp": "temperature",
        "rh": "humidity",
        "pres": "pressure_hpa",
        "wind": "wind_speed",
        "solar": "solar_radiation",
        "rain": "hourly_rain",
    },
    "eco": {f: f"{f}_eco" for f in FEATURES},
    "ecowitt": {f: f"ecowitt_{f}" for f in FEATURES},
}

# Fixed values: (resolution, deadband) as printed on the sensors ...
NOMINAL_SPECS = {
    "temp": (0.1, 0.0),
    "rh": (1.0, 0.0),
    "pres": (0.1, 0.0),
    "wind": (0.1, 0.2),
    "solar": (0.1, 0.0),
    "rain": (0.1, 0.2),
}
# ... and as used by the guardrails, where humidity keeps its dynamics.
GUARDRAIL_SPECS = {
    "temp": (0.1, 0.0),
    "rh": (0.1, 0.0),
    "pres": (0.1, 0.0),
    "wind": (0.1, 0.2),
    "solar": (1.0, 0.0),
    "rain": (0.1, 0.2),
}

# Absolute bias above which a row is flagged.
BIAS_LIMITS = {"temp": 5.0, "rh": 20.0, "pres": 10.0, "wind": 5.0, "solar": 100.0, "rain": 1.0}

# Accepted ranges of the staged telemetry and of the bias table.
STAGING_RANGES = {
    "temperature": (-30.0, 50.0),
    "pressure_hpa": (800.0, 1100.0),
    "humidity": (0.0, 100.0),
    "wind_speed": (0.0, 80.0),
    "solar_radiation": (0.0, 1500.0),
    "hourly_rain": (0.0, 300.0),
}
BIAS_RANGES = {"bias_temp": (-15.0, 15.0), "bias_pres": (-30.0, 30.0)}

# CSV header of the station export -> column name.
CSV_COLUMNS = {
    "Time": "ts_label",
    "Timestamp": "epoch_timestamp",
    "Indoor Temperature(°C)": "indoor_temperature_c",
    "Indoor Humidity(%)": "indoor_humidity",
    "Outdoor Temperature(°C)": "outdoor_temperature_c",
    "Outdoor Humidity(%)": "outdoor_humidity",
    "Dew Point(°C)": "dew_point_c",
    "Feels Like(°C)": "feels_like_c",
    "VPD(kPa)": "vpd_kpa",
    "Wind(m/s)": "wind_m_s",
    "Gust(m/s)": "gust_m_s",
    "Wind Direction(deg)": "wind_direction_deg",
    "ABS Pressure(hPa)": "abs_pressure_hpa",
    "REL Pressure(hPa)": "rel_pressure_hpa",
    "Solar Rad(W/m2)": "solar_rad_w_m2",
    "UV-Index": "uv_index",
    "Rain Rate(mm/Hr)": "rain_rate_mm_hr",
    "Hourly Rain(mm)": "hourly_rain_mm",
    "Event Rain(mm)": "event_rain_mm",
    "Daily Rain(mm)": "daily_rain_mm",
    "Weekly Rain(mm)": "weekly_rain_mm",
    "Monthly Rain(mm)": "monthly_rain_mm",
    "Yearly Rain(mm)": "yearly_rain_mm",
    "Piezo Rate(mm/Hr)": "piezo_rate_mm_hr",
    "Piezo Hourly Rain(mm)": "piezo_hourly_rain_mm",
    "Piezo Event Rain(mm)": "piezo_event_rain_mm",
    "Piezo Daily Rain(mm)": "piezo_daily_rain_mm",
    "Piezo Weekly Rain(mm)": "piezo_weekly_rain_mm",
    "Piezo Monthly Rain(mm)": "piezo_monthly_rain_mm",
    "Piezo Yearly Rain(mm)": "piezo_yearly_rain_mm",
}

GRID_KEY = ("valid_time", "latitude", "longitude")
SPECS_TYPE = T.MapType(
    T.StringType(),
    T.StructType(
        [T.StructField("resolution", T.DoubleType()), T.StructField("deadband", T.DoubleType())]
    ),
)

PUBLIC_COLUMNS = ("ts", "created_at", "model_version") + tuple(
    name.format(f)
    for name in ("pred_{}", "diff_{}", "historical_bias_{}", "drift_vs_bias_{}", "{}_era5", "abs_error_{}")
    for f in FEATURES
)


def rename_features(df: DataFrame, source: str, target: str) -> DataFrame:
    """Renames the six features from one naming scheme to another."""
    return df.withColumnsRenamed({SCHEMES[source][f]: SCHEMES[target][f] for f in FEATURES})


def specs_json(specs: dict[str, tuple[float, float]]) -> str:
    """The JSON text that the station table stores for a spec map."""
    parts = (
        f'"ecowitt_{f}":{{"resolution":{res},"deadband":{dead}}}' for f, (res, dead) in specs.items()
    )
    return "{" + ",".join(parts) + "}"


def resolutions(specs: dict[str, tuple[float, float]]) -> dict:
    """Literal resolution column per feature."""
    return {f: F.lit(res) for f, (res, _) in specs.items()}

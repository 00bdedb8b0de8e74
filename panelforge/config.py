"""Fixed values and parameters of the domain rules."""

from __future__ import annotations

from dataclasses import dataclass

# ---- fixed values: entity codes -------------------------------------------------
COUNTRIES = (
    "ES", "PT", "FR", "DE", "IT", "GB", "NL", "BE", "AT", "CH", "PL", "CZ", "DK", "SE",
    "NO", "FI", "GR", "IE", "RO", "BG", "HU", "SK", "SI", "HR", "EE", "LT", "LV",
)
COUNTRIES_WITHOUT_GENERATION = (
    "DK", "FI", "LV", "SE", "EE", "GR", "RO", "SI", "NO", "CH", "BG",
)

# ---- fixed values: country facts (name, iso3, average load, average stress) -----
COUNTRY_FACTS = (
    ("AT", "Austria", "AUT", 6669, 29.5),
    ("BE", "Belgium", "BEL", 9113, 28.6),
    ("DE", "Germany", "DEU", 52664, 29.2),
    ("ES", "Spain", "ESP", 26307, 25.2),
    ("FR", "France", "FRA", 48737, 29.4),
    ("HR", "Croatia", "HRV", 2059, 26.8),
    ("HU", "Hungary", "HUN", 4871, 31.8),
    ("IT", "Italy", "ITA", 31638, 19.9),
    ("LT", "Lithuania", "LTU", 1360, 28.9),
    ("NL", "Netherlands", "NLD", 12789, 41.2),
    ("PL", "Poland", "POL", 18794, 26.0),
    ("PT", "Portugal", "PRT", 5819, 24.2),
    ("SK", "Slovakia", "SVK", 2913, 28.5),
)

# ---- fixed values: weather points (place, latitude, longitude, country) ---------
PLACES = (
    (1, 47.52, 14.55, "AT"), (2, 50.5, 4.47, "BE"), (3, 51.17, 10.45, "DE"),
    (4, 40.46, -3.75, "ES"), (5, 46.23, 2.21, "FR"), (6, 45.1, 15.2, "HR"),
    (7, 47.16, 19.5, "HU"), (8, 41.87, 12.56, "IT"), (9, 55.17, 23.88, "LT"),
    (10, 52.13, 5.29, "NL"), (11, 51.92, 19.14, "PL"), (12, 39.4, -8.22, "PT"),
    (13, 48.67, 19.69, "SK"),
)

# ---- fixed values: borders with a flow, in either or both directions -------------
BORDERS = (
    ("ES", "PT"), ("ES", "FR"), ("FR", "BE"), ("FR", "CH"), ("FR", "DE"), ("FR", "IT"),
    ("BE", "NL"), ("BE", "DE"), ("NL", "DE"), ("NL", "GB"), ("GB", "NL"), ("GB", "FR"),
    ("GB", "IE"), ("DE", "CZ"), ("DE", "PL"), ("DE", "CH"), ("DE", "DK"), ("DE", "AT"),
    ("DK", "DE"), ("DK", "NO"), ("DK", "SE"), ("SE", "NO"), ("SE", "FI"), ("SE", "DK"),
    ("NO", "NL"), ("NO", "GB"), ("NO", "SE"), ("NO", "DK"), ("FI", "EE"), ("FI", "SE"),
    ("EE", "LV"), ("LV", "LT"), ("LT", "PL"), ("PL", "SK"), ("PL", "CZ"), ("CZ", "AT"),
    ("CZ", "SK"), ("AT", "SI"), ("AT", "IT"), ("AT", "CH"), ("AT", "CZ"), ("AT", "DE"),
    ("SI", "HR"), ("SI", "IT"), ("SI", "AT"), ("HR", "HU"), ("HR", "SI"), ("HU", "SK"),
    ("HU", "RO"), ("HU", "HR"), ("HU", "AT"), ("SK", "HU"), ("SK", "CZ"), ("SK", "PL"),
    ("RO", "BG"), ("RO", "HU"), ("BG", "GR"), ("BG", "RO"), ("GR", "BG"),
)

# ---- fixed values: columns of the old generation layout -------------------------
LEGACY_COLUMNS = (
    "Hydro_Pumped_Storage", "Hydro_Run_of_river_and_poundage", "Hydro_Water_Reservoir",
    "Nuclear", "Solar", "Wind_Onshore", "Biomass", "Fossil_Brown_coal_Lignite",
    "Fossil_Coal_derived_gas", "Fossil_Gas", "Fossil_Hard_coal", "Fossil_Oil", "Waste",
    "Wind_Offshore", "Other", "Other_renewable", "Fossil_Peat", "Energy_storage",
    "Fossil_Oil_shale",
)
GENERATION_SUFFIXES = ("__Actual_Aggregated", "__Actual_Consumption")

# ---- fixed values: imputation method per column ---------------------------------
FILL_METHODS = {
    "Biomass__Actual_Aggregated": "ffill_bfill",
    "Biomass__Actual_Consumption": "mean",
    "Energy_storage__Actual_Aggregated": "median",
    "Energy_storage__Actual_Consumption": "median",
    "Fossil_Brown_coal_Lignite__Actual_Aggregated": "mean",
    "Fossil_Coal_derived_gas__Actual_Aggregated": "mean",
    "Fossil_Gas__Actual_Aggregated": "ffill_bfill",
    "Fossil_Gas__Actual_Consumption": "mean",
    "Fossil_Hard_coal__Actual_Aggregated": "mean",
    "Fossil_Hard_coal__Actual_Consumption": "mean",
    "Fossil_Oil__Actual_Aggregated": "mean",
    "Fossil_Oil__Actual_Consumption": "mean",
    "Fossil_Oil_shale__Actual_Aggregated": "mean",
    "Fossil_Peat__Actual_Aggregated": "mean",
    "Geothermal__Actual_Aggregated": "mean",
    "Geothermal__Actual_Consumption": "mean",
    "Hydro_Pumped_Storage__Actual_Aggregated": "ffill_bfill",
    "Hydro_Pumped_Storage__Actual_Consumption": "ffill_bfill",
    "Hydro_Run_of_river_and_poundage__Actual_Aggregated": "mean",
    "Hydro_Run_of_river_and_poundage__Actual_Consumption": "mean",
    "Hydro_Water_Reservoir__Actual_Aggregated": "ffill_bfill",
    "Hydro_Water_Reservoir__Actual_Consumption": "mean",
    "Marine__Actual_Aggregated": "mean",
    "Nuclear__Actual_Aggregated": "ffill_bfill",
    "Nuclear__Actual_Consumption": "ffill_bfill",
    "Other__Actual_Aggregated": "mean",
    "Other__Actual_Consumption": "mean",
    "Other_renewable__Actual_Aggregated": "mean",
    "Other_renewable__Actual_Consumption": "mean",
    "Solar__Actual_Aggregated": "ffill_bfill",
    "Solar__Actual_Consumption": "mean",
    "Waste__Actual_Aggregated": "mean",
    "Waste__Actual_Consumption": "mean",
    "Wind_Offshore__Actual_Aggregated": "mean",
    "Wind_Offshore__Actual_Consumption": "ffill_bfill",
    "Wind_Onshore__Actual_Aggregated": "ffill_bfill",
    "Wind_Onshore__Actual_Consumption": "mean",
}

# ---- fixed values: columns that must not reach a model --------------------------
LEAKAGE_COLUMNS = (
    "index", "country", "grid_stress_score", "reserve_margin_ml", "forecast_load_error",
    "load_rel_error", "net_imports", "P10_net", "P90_net", "score_reserve_margin",
    "score_load_error", "score_T7", "score_T8", "T7_high_exports", "T8_high_imports",
    "hour", "month", "day_of_week",
)
PROHIBITED_PARTS = (
    "net_imports", "stress_lag", "stress_change", "reserve_margin_ml",
    "forecast_load_error", "load_rel_error",
)

# ---- fixed values: model features -----------------------------------------------
MODEL_FEATURES = (
    "Actual_Load", "Forecasted_Load",
    "load_lag_1h", "load_lag_24h",
    "load_rolling_mean_24h", "load_rolling_std_24h",
    "load_change_1h", "load_change_24h",
    "load_forecast_diff", "load_forecast_ratio", "load_forecast_error_pct",
    "load_deviation_from_hourly_avg", "load_deviation_from_daily_avg",
    "mean_temperature_c", "mean_wind_speed", "mean_ssrd",
    "solar_forecast", "wind_forecast", "temp_lag_1h",
    "load_per_temp", "temp_load_product", "is_very_cold", "temp_extreme",
    "wind_power_index", "imports_lag_1h", "imports_rolling_mean_24h",
    "hour_sin", "hour_cos", "month_sin", "month_cos",
    "day_of_week_sin", "day_of_week_cos",
    "is_weekend", "is_morning_peak", "is_evening_peak", "is_peak_hour",
)
# fixed values: feature categories by name part (case-insensitive parts, exact parts)
FEATURE_GROUPS = {
    "load": (("load",), ()),
    "weather": (("temp", "wind", "solar", "ssrd"), ()),
    "temporal": ((), ("hour_", "month_", "day_of_week", "weekend", "peak")),
    "import": (("import",), ()),
    "country": ((), ("country_",)),
    "generation": ((), ("Actual_Aggregated",)),
}

# ---- fixed values: what-if presets ----------------------------------------------
# (scenario, temperature, wind, solar, load multiplier)
SCENARIO_PRESETS = (
    ("normal", 15.0, 5.0, 500.0, 1.0),
    ("heat_wave", 38.0, 2.0, 900.0, 1.3),
    ("cold_snap", -15.0, 3.0, 100.0, 1.4),
    ("wind_drought", 15.0, 0.5, 300.0, 1.0),
    ("import_crisis", 10.0, 5.0, 400.0, 1.1),
    ("forecast_error", 15.0, 5.0, 500.0, 1.2),
    ("peak_hour", 20.0, 4.0, 600.0, 1.25),
    ("blackout", 38.0, 1.0, 50.0, 2.0),
)

# ---- fixed values: score rules ---------------------------------------------------
TRAILING_ROWS = 24            # rows before the current one: a frame of 25 rows
ROLLING_ROWS = 24             # rows in a feature frame, current one included
THRESHOLDS = (30, 35, 40, 45, 50, 55, 60)
RISK_THRESHOLD = 50
WARNING_THRESHOLD = 66
SPARSE_LIMIT = 0.80
MIN_OBSERVATIONS = 30
MASK_SHARE_PERCENT = 10
SCORE_BINS = (0.0, 25.0, 50.0, 75.0)
TIME_CANDIDATES = ("index", "time", "timestamp", "datetime")
EPS = 1e-6


@dataclass(frozen=True)
class Splits:
    """Ends of the train and validation spans."""

    train_end: str = "2024-12-31"
    val_end: str = "2025-07-31"
    inclusive_day: bool = False

"""Queries: imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.catalog.registry import query, rounded
from panelforge.catalog.sqltext import with_fragments as sql
from panelforge.operators import impute as M
from panelforge.operators.columns import drop_all_null, suffix_columns
from panelforge.session import reliable_checkpoint
from panelforge.sources import benchdata as B

GEN = ("Nuclear__Actual_Aggregated", "Solar__Actual_Aggregated", "Biomass__Actual_Consumption")
KEY_SQL = """country || '|' || strftime("index", '%Y-%m-%d')"""
ASC = """OVER (PARTITION BY country ORDER BY "index" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
DESC = """OVER (PARTITION BY country ORDER BY "index" ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""


def near(c):
    return f"coalesce(last_value({c} IGNORE NULLS) {ASC}, first_value({c} IGNORE NULLS) {DESC})"


def cell_key():
    return F.concat_ws("|", "country", F.date_format("index", "yyyy-MM-dd"))


def panel(spark, sf):
    """Generation without its empty column."""
    rows = B.generation(spark, sf)
    return drop_all_null(rows, suffix_columns(rows), drop=["Marine__Actual_Aggregated"])


def _hidden(c):
    return f"""({c} IS NOT NULL AND ('0x' || substr(md5({KEY_SQL} || '|{c}'), 1, 8))::BIGINT % 100 < 10)"""


MASKED = {
    "masked": """SELECT country, "index", """ + ", ".join(
        f"{c}, {c} AS {c}_original, {_hidden(c)}::INT AS {c}_was_masked, "
        f"CASE WHEN NOT {_hidden(c)} THEN {c} END AS {c}_mask" for c in GEN
    ) + " FROM generation",
    "mask_stats": "SELECT country, " + ", ".join(
        f"avg({c}_mask) AS {c}_m, quantile_disc({c}_mask, 0.5) AS {c}_d" for c in GEN
    ) + " FROM masked GROUP BY 1",
    "tried": """SELECT country, "index", """ + ", ".join(
        f"{c}_original, {c}_was_masked, coalesce({c}_mask, {c}_m) AS {c}_mean, "
        f"coalesce({c}_mask, {c}_d) AS {c}_median, {near(c + '_mask')} AS {c}_ffill_bfill" for c in GEN
    ) + " FROM masked LEFT JOIN mask_stats USING (country)",
}
MAE_PARTS = " UNION ALL ".join(
    f"""SELECT country, '{c}' AS "column", '{m}' AS method, avg(abs({c}_{m} - {c}_original)) AS mae
        FROM tried WHERE {c}_was_masked = 1 GROUP BY 1"""
    for c in GEN for m in ("mean", "median", "ffill_bfill")
)
MAES = {**MASKED, "maes": f"SELECT * FROM ({MAE_PARTS}) WHERE mae IS NOT NULL"}
BEST = {
    **MAES,
    "best": """SELECT "column", country, method, mae FROM (
                 SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY mae, country, method) AS r
                 FROM maes) WHERE r = 1""",
}


@query(
    "mask_10pct",
    sql("""SELECT country, "index", """ + ", ".join(
        f"{c}_original, {c}_was_masked, {c}_mask" for c in GEN) + " FROM masked", MASKED),
)
def mask_10pct(spark, sf):
    """About a tenth of the known cells of each column is hidden."""
    return M.mask_cells(panel(spark, sf), GEN, cell_key()).drop(*GEN)


def _stats():
    return {"gstats": "SELECT country, " + ", ".join(
        f"avg({c}) AS {c}_m, quantile_disc({c}, 0.5) AS {c}_d" for c in GEN
    ) + " FROM generation GROUP BY 1"}


def _filled_sql(expr, places=None):
    def cell(c):
        e = expr(c)
        return f"round({e}, {places}) AS {c}" if places else f"{e} AS {c}"

    return sql(
        """SELECT country, "index", """ + ", ".join(cell(c) for c in GEN)
        + " FROM generation LEFT JOIN gstats USING (country)", _stats()
    )


def _one_way(spark, sf, method):
    ways = M.fill_all_ways(panel(spark, sf), ["country"], ["index"], {c: c for c in GEN})
    return ways.select("country", "index", *[F.col(f"{c}_{method}").alias(c) for c in GEN])


@query("impute_mean", _filled_sql(lambda c: f"coalesce({c}, {c}_m)", 4))
def impute_mean(spark, sf):
    return rounded(_one_way(spark, sf, "mean"), *GEN, places=4)


@query("impute_median", _filled_sql(lambda c: f"coalesce({c}, {c}_d)"))
def impute_median(spark, sf):
    return _one_way(spark, sf, "median")


@query("impute_ffill_bfill", _filled_sql(near))
def impute_ffill_bfill(spark, sf):
    return _one_way(spark, sf, "ffill_bfill")


def _maes(spark, sf):
    return M.method_mae(panel(spark, sf), ["country"], ["index"], GEN, cell_key())


MAE_SQL = sql("""SELECT country, "column", method, round(mae, 6) AS mae FROM maes""", MAES)


@query("masked_mae", MAE_SQL)
def masked_mae(spark, sf):
    return rounded(_maes(spark, sf), "mae")


@query("impute_method_mae", MAE_SQL)
def impute_method_mae(spark, sf):
    return masked_mae(spark, sf)


BEST_SQL = sql("""SELECT "column", country, method, round(mae, 6) AS mae FROM best""", BEST)


@query("argmin_per_group", BEST_SQL)
def argmin_per_group(spark, sf):
    return rounded(M.best_method(_maes(spark, sf), "country"), "mae")


@query("impute_best_method", BEST_SQL)
def impute_best_method(spark, sf):
    return argmin_per_group(spark, sf)


def _won(c):
    return f"""(SELECT method FROM best b WHERE b."column" = '{c}' AND b.country = g.country)"""


APPLIED = {
    **BEST, **_stats(),
    "started": """SELECT g.country, g."index", """ + ", ".join(
        f"coalesce({c}, CASE {_won(c)} WHEN 'mean' THEN {c}_m WHEN 'median' THEN {c}_d END) AS {c}" for c in GEN
    ) + " FROM generation g LEFT JOIN gstats s ON g.country = s.country",
}


@query(
    "impute_apply_best",
    sql("""SELECT country, "index", """ + ", ".join(f"round(coalesce({near(c)}, 0), 4) AS {c}" for c in GEN)
        + " FROM started", APPLIED),
)
def impute_apply_best(spark, sf):
    rows = reliable_checkpoint(panel(spark, sf), "generation")   # measured, then filled
    best = M.best_method(M.method_mae(rows, ["country"], ["index"], GEN, cell_key()), "country")
    return rounded(M.apply_best(rows, "country", ["index"], GEN, best), *GEN, places=4)


@query(
    "impute_by_map",
    _filled_sql(lambda c: (
        f"coalesce({c}, {c}_m, 0)" if c.startswith("Biomass") else f"coalesce({near(c)}, 0)"
    ), 4),
)
def impute_by_map(spark, sf):
    """The fixed method of each column, for all keys."""
    rows = panel(spark, sf)
    return rounded(M.apply_by_map(rows, ["country"], ["index"], GEN), *GEN, places=4)


@query(
    "drop_helpers",
    sql("""SELECT country, "index", Nuclear__Actual_Aggregated, Solar__Actual_Aggregated,
                  Biomass__Actual_Consumption FROM generation"""),
)
def drop_helpers(spark, sf):
    rows = panel(spark, sf)
    return M.keep_original(M.mask_cells(rows, GEN, cell_key()), rows.columns)

"""From raw tables to scored, split, imputed and feature-ready panels.

Every step is lazy, so a product is one plan. ``run_batch`` and ``run_live``
write tables between the large steps, where several products start from the same
rows, so that lost executors repeat a step and not the whole chain.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from panelforge.config import COUNTRIES, COUNTRIES_WITHOUT_GENERATION, FILL_METHODS, Splits
from panelforge.operators.columns import drop_all_null, drop_legacy, suffix_columns
from panelforge.operators.features import clean_features, final_features, model_matrix
from panelforge.operators.flows import net_flow
from panelforge.operators.impute import apply_by_map
from panelforge.operators.joins import align
from panelforge.operators.resample import resample_mean
from panelforge.operators.scores import score_panel
from panelforge.operators.splits import with_split
from panelforge.session import reliable_checkpoint
from panelforge.sources.tables import overwrite_table

KEYS = ["index", "country"]


@dataclass(frozen=True)
class Inputs:
    """Raw readings per country and time; flows per pair of countries. Frames in
    ``panels`` hold one row per country and period already, e.g. the weather."""

    readings: Sequence[DataFrame]
    flows: DataFrame
    panels: Sequence[DataFrame] = ()
    unit: str = "hour"


def joined_panel(inputs: Inputs) -> DataFrame:
    """Resample every input to one row per country and period and join them."""
    series = [resample_mean(df, ["country"], unit=inputs.unit) for df in inputs.readings]
    edges = resample_mean(
        inputs.flows, ["from_country", "to_country"], unit=inputs.unit, values=["Value"]
    )
    first, *rest = series
    return align([first, net_flow(edges), *rest, *inputs.panels], KEYS)


def scored_panel(panel: DataFrame, splits: Splits | None = None) -> DataFrame:
    """Score without the legacy columns, labelled by split if asked for."""
    scored = score_panel(drop_legacy(panel))
    return scored if splits is None else with_split(scored, splits=splits)


def imputed_panel(
    scored: DataFrame,
    methods: dict[str, str] = FILL_METHODS,
    excluded: Sequence[str] = COUNTRIES_WITHOUT_GENERATION,
    empty: Sequence[str] | None = None,
) -> DataFrame:
    """Fill the generation columns. With a split column, each split is filled
    from its own rows. ``empty`` names the all-NULL columns to drop; without it
    they are found by one aggregate."""
    kept = scored.filter(~scored["country"].isin(*excluded))
    rows = drop_all_null(kept, suffix_columns(kept), drop=empty)
    keys = ["split", "country"] if "split" in rows.columns else ["country"]
    return apply_by_map(rows, keys, ["index"], suffix_columns(rows), methods)


def run_batch(inputs: Inputs, splits: Splits, name: str, root: str) -> str:
    """Write the scored panel and its imputed splits; returns the last table."""
    spark = inputs.flows.sparkSession
    overwrite_table(scored_panel(joined_panel(inputs), splits), f"{name}_scored", f"{root}/scored")
    imputed = imputed_panel(spark.table(f"{name}_scored"))
    overwrite_table(imputed, f"{name}_imputed", f"{root}/imputed", ["split"])
    return f"{name}_imputed"


KEPT_WITH_FEATURES = ("index", "grid_stress_score", "net_imports")   # shown beside a prediction


def run_live(
    inputs: Inputs, name: str, root: str, countries: Sequence[str] | None = None
) -> tuple[str, str]:
    """The hourly re-run: a feature table, with gaps as 0 and one flag per
    country, and a table of actual scores. Both are replaced as a whole."""
    if countries is None:
        countries = [c for c in COUNTRIES if c not in COUNTRIES_WITHOUT_GENERATION]
    spark = inputs.flows.sparkSession
    overwrite_table(scored_panel(joined_panel(inputs)), f"{name}_panel", f"{root}/panel")
    panel = spark.table(f"{name}_panel")
    rows = reliable_checkpoint(clean_features(imputed_panel(panel)), "features")   # read twice
    matrix = model_matrix(rows, final_features(rows), countries, keep=KEPT_WITH_FEATURES)
    overwrite_table(matrix, f"{name}_features", f"{root}/features")
    overwrite_table(
        panel.select("index", "country", "grid_stress_score"), f"{name}_scores", f"{root}/scores"
    )
    return f"{name}_features", f"{name}_scores"

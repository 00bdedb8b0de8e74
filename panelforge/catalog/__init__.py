"""All registered queries."""

from panelforge.catalog import (  # noqa: F401
    columns_q,
    features_q,
    impute_q,
    joins_q,
    models_q,
    plans_q,
    profile_q,
    scores_q,
    streaming_q,
    tables_q,
    windows_q,
)
from panelforge.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]

"""The queries of this subpackage and their SQL, by name."""

from panelforge.llm import (  # noqa: F401
    binary_codes,
    bit_sliced,
    byte_bpe,
    class_lm,
    decontaminate,
    jaccard_join,
    merkle,
    multi_index,
    resample,
    sharding,
    token_counts,
    toxicity,
    warc,
)
from panelforge.llm.common import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]

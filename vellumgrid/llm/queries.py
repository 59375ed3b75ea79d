"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .decontaminate import op4_decontaminate
from .fingerprints import op2_fingerprints
from .language_id import op10_language_id
from .near_dedup import OP3_SQL, op3_near_dedup
from .quality import op5_quality
from .secret_scan import OP1_SQL, op1_secret_scan
from .source_mix import OP9_SQL, op9_source_mix
from .token_counts import op7_token_counts
from .token_store import op8_token_store
from .toxicity import op6_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_fingerprints": op2_fingerprints,
    "op3_near_dedup": op3_near_dedup,
    "op4_decontaminate": op4_decontaminate,
    "op5_quality": op5_quality,
    "op6_toxicity": op6_toxicity,
    "op7_token_counts": op7_token_counts,
    "op8_token_store": op8_token_store,
    "op9_source_mix": op9_source_mix,
    "op10_language_id": op10_language_id,
}

ORACLE_SQL: dict[str, str] = {
    "op1_secret_scan": OP1_SQL,
    "op3_near_dedup": OP3_SQL,
    "op9_source_mix": OP9_SQL,
}

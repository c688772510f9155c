"""Queries of this folder by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .alignment import op11_token_alignment
from .hard_negatives import op12_hard_negatives
from .jaccard_join import op6_jaccard_join
from .line_dedup import op13_line_dedup
from .mixing import op4_budget_mix
from .packing import op9_pattern_packing
from .pii import op8_pii_bootstrap
from .quality import op5_quality_cascade
from .quotes import op7_quote_linking
from .sketches import op3_scaled_sketch
from .sql import OP2, OP5, OP6, OP7, OP12, OP13
from .substring_dedup import op2_substring_dedup
from .suffix_dedup import op10_suffix_dedup
from .toxicity import op1_toxicity_crf

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity_crf,
        op2_substring_dedup,
        op3_scaled_sketch,
        op4_budget_mix,
        op5_quality_cascade,
        op6_jaccard_join,
        op7_quote_linking,
        op8_pii_bootstrap,
        op9_pattern_packing,
        op10_suffix_dedup,
        op11_token_alignment,
        op12_hard_negatives,
        op13_line_dedup,
    )
}

SQL: dict[str, str] = {
    "op2_substring_dedup": OP2,
    "op5_quality_cascade": OP5,
    "op6_jaccard_join": OP6,
    "op7_quote_linking": OP7,
    "op12_hard_negatives": OP12,
    "op13_line_dedup": OP13,
}

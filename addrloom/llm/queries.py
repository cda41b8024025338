"""The llm queries and their SQL by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .addressmatch import p3_found
from .bpe import p8_ids
from .canonical import p6_found, p6_unmatched
from .confusables import p1_forms, p1_found

from .leakage import p9_found, p9_removals, p9_spans


from .stuffing import p10_found, p10_scores

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found, "p1_forms": p1_forms, "p3_found": p3_found,
    "p6_found": p6_found, "p6_unmatched": p6_unmatched, 
    "p8_ids": p8_ids, "p9_found": p9_found, "p9_spans": p9_spans, "p9_removals": p9_removals, "p10_found": p10_found, "p10_scores": p10_scores,
}
SQL: dict[str, str] = {}

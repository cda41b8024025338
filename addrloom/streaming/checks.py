"""The per-row stages on a stream: cleaning forms, parts and checks need no state, so a stream of addresses meets the static PIN table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import extract as x
from ..functions import text as t
from ..operators.checks import CHECKS, checked


def checked_stream(addresses: DataFrame, pins: DataFrame) -> DataFrame:
    """A stream (row_id, full_address, city, state, pincode) with clean text, labels, parts and the status of every check; `pins` is a
    static PIN context. Late and repeated rows pass through like any other."""
    out = checked(addresses, pins)
    c = F.col("full_address")
    return out.select("row_id", t.clean_text(c).alias("clean"), t.last_pin(c).alias("pin"), *[x.labelled(c, k).alias(k) for k in x.LABELLED], x.has_premise(c).alias("premise"), x.address_type(c).alias("address_type"), *[F.col(f"{k}.status").alias(k) for k in CHECKS])

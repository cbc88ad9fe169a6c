"""Byte-size formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the reference's formatting: MB up to 1000 MB, then GB.
MB = 1024 * 1024
GB_THRESHOLD_MB = 1000


def _fixed2(x: Column) -> Column:
    # two decimals, ties to even (as Python's format does on these dyadic values)
    return F.format_string("%.2f", F.bround(x, 2))


def human_size(n_bytes: Column) -> Column:
    """``"12.34 MB"``, or ``"1.23 GB"`` above 1000 MB."""
    mb = n_bytes.cast("double") / MB
    return F.when(mb > GB_THRESHOLD_MB, F.concat(_fixed2(mb / 1024), F.lit(" GB"))) \
        .otherwise(F.concat(_fixed2(mb), F.lit(" MB")))

"""Compact-date parsing and the age / power / frequency bin labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C
from .columns import bin_by_edges, bin_code_by_edges, clip, col_of


def parse_compact_date(c: str | Column) -> Column:
    """YYYYMMDD integer or text -> date; a trailing `.0` is dropped before the
    text is trimmed; illegal dates (month 00, Feb 30, 7 digits) give NULL."""
    text = F.trim(F.regexp_replace(col_of(c).cast("string"), r"\.0$", ""))
    return F.try_to_date(text, "yyyyMMdd")


def age_bin(age_years: str | Column, missing_label: str = C.AGE_MISSING) -> Column:
    """Age in years clipped at 0, right-closed bins 0_1y..8y_plus."""
    return bin_by_edges(clip(age_years, lower=0.0), C.AGE_BIN_EDGES, C.AGE_BIN_LABELS, missing_label)


def power_bin(power: str | Column) -> Column:
    """Power clipped to [0, 600] then labelled 0, 1_60, ..., 300_600."""
    lo, hi = C.POWER_CLIP
    # values are clipped to <= 600, so the last label covers (300, 600]
    return bin_by_edges(clip(power, lo, hi), C.POWER_BIN_EDGES[:-1], C.POWER_BIN_LABELS, C.POWER_MISSING)


def power_bin_code(power: str | Column) -> Column:
    """Numeric code 0..7 of the power bins (double, NULL when missing)."""
    return bin_code_by_edges(power, C.POWER_BIN_EDGES, lower=-1.0)


def frequency_bin(count: str | Column) -> Column:
    return bin_by_edges(count, C.FREQ_BIN_EDGES, C.FREQ_BIN_LABELS, C.FREQ_MISSING)

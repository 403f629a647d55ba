"""Presentation of the report: derived text columns, blank fills, types and display names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockout import schemas
from stockout.functions import broadcast_time_text, option_detail

# Columns with a numeric type that arrive as text and must not fail the job when malformed.


def present(report: DataFrame, with_estimate: bool = True) -> DataFrame:
    """Add PGM_TIME, SIZE2, SIZE3; fill blank order quantities with 0; cast every column to
    the report's type and order the columns as the report lists them."""
    size2, size3 = option_detail(F.col("attr_prd_whl_val"))
    out = report.withColumns({
        "pgm_time": broadcast_time_text(F.col("broad_str_dtm")),
        "size2": size2,
        "size3": size3,
        "tot_ord_qty": F.coalesce(F.col("tot_ord_qty"), F.lit(0)),
        "pord_03_tot_ord_qty": F.coalesce(F.col("pord_03_tot_ord_qty"), F.lit(0)),
    })
    cols = []
    for name in schemas.REPORT_COLUMN_NAMES:
        if name == "estim_qty" and not with_estimate:
            continue
        dtype = schemas.REPORT_TYPES[name]
        c = F.col(name) if name in out.columns else F.lit(None)
        cols.append(c.cast(dtype).alias(name))
    return out.select(*cols)


def to_display_names(report: DataFrame) -> DataFrame:
    """English keys -> display names; the columns must be exactly the 39 known ones, or those
    without the estimate."""
    known = set(schemas.REPORT_COLUMN_NAMES)
    unknown, absent = set(report.columns) - known, known - set(report.columns) - {"estim_qty"}
    if unknown or absent:
        raise ValueError(f"report columns without a display name: {sorted(unknown)}, absent: {sorted(absent)}")
    return report.withColumnsRenamed({c: schemas.REPORT_COLUMN_NAMES[c] for c in report.columns})


def from_display_names(report: DataFrame) -> DataFrame:
    """Display names -> English keys (inverse of ``to_display_names``)."""
    inverse = {v: k for k, v in schemas.REPORT_COLUMN_NAMES.items()}
    return report.withColumnsRenamed({c: inverse[c] for c in report.columns if c in inverse})

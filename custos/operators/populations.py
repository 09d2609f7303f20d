"""Which rows take part: complete rows (P3) and population exclusions (P25)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def complete_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows without a null in ``cols`` (all columns by default); a step of its own, so that no fit drops rows unseen."""
    return df.na.drop("any", subset=list(cols) if cols is not None else None)


def exclude_population(df: DataFrame, excluded: Mapping[str, Sequence], known: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """P25: rows with none of the excluded values, and with a match in ``known``.

    ``excluded`` maps a column to the values that leave the population; a null
    is none of them and stays.  With ``known`` (and ``key``) rows without a match
    there leave too, rows without a key among them; repeated keys in ``known``
    don't repeat rows.
    """
    out = df
    for col, values in excluded.items():
        out = out.where(F.col(col).isNull() | ~F.col(col).isin(list(values)))
    return out if known is None else out.join(known.select(key), key, "left_semi")

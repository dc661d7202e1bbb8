"""Column checks made while a plan is built; none of them runs a job."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame


def require_columns(df: DataFrame, names: Iterable[str], what: str = "table") -> DataFrame:
    """``df`` itself, or a ValueError that names every absent column."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks {', '.join(missing)}; it has {', '.join(df.columns)}")
    return df


def resolve_column(df: DataFrame, aliases: Sequence[str]) -> str | None:
    """The first alias among the columns, or else the first that differs in case or outer blanks only."""
    for a in aliases:
        if a in df.columns:
            return a
    folded = {c.strip().lower(): c for c in reversed(df.columns)}
    return next((folded[a.strip().lower()] for a in aliases if a.strip().lower() in folded), None)

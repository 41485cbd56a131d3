"""Column-name normalisation (PRJ1, PRJ2) and the one-``toDF`` rename.

Renaming is metadata only: one ``toDF``/``select`` — never a loop of
``withColumnRenamed`` (each adds a projection node to the plan).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

# Characters replaced by "_" in the default normaliser (PRJ2),
# in this order: space, colon, hyphen, dot, comma, open paren, close paren, plus.
DEFAULT_SYMBOLS = [" ", ":", "-", ".", ",", "(", ")", "+"]


def parse_name(name: str) -> str:
    """PRJ1: lower; ``: . - ,`` and space → ``_``; drop ``'``; strip last.

    Stripping runs after spaces became ``_`` so it only removes other
    surrounding whitespace (tabs, newlines).
    """
    out = name.lower()
    for ch in (":", ".", "-"):
        out = out.replace(ch, "_")
    out = out.replace("'", "")
    for ch in (",", " "):
        out = out.replace(ch, "_")
    return out.strip()


def norm_name(name: str, symbols: Sequence[str] | None = None) -> str:
    """PRJ2: lower, strip first, then each symbol → ``_``."""
    out = name.lower().strip()
    for sym in (DEFAULT_SYMBOLS if symbols is None else symbols):
        out = out.replace(sym, "_")
    return out


def parse_column_names(df: DataFrame) -> DataFrame:
    """PRJ1 on every column of ``df``."""
    return df.toDF(*[parse_name(c) for c in df.columns])


def norm_columns_name(df: DataFrame, symbols: Sequence[str] | None = None) -> DataFrame:
    """PRJ2 on every column of ``df``."""
    return df.toDF(*[norm_name(c, symbols) for c in df.columns])

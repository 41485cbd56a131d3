"""Column expressions shared by every operator.

All helpers return ``pyspark.sql.Column`` objects built from built-in
functions, so they stay inside whole-stage codegen.  They encode the
missing-value rules of the pandas code we re-create:

* a missing value is SQL NULL (NaN is turned into NULL at ingestion,
  because Spark orders NaN above every number);
* row-wise mean skips NULLs and is NULL when every input is NULL;
* row-wise sum skips NULLs and is **0** when every input is NULL;
* ``x / 0`` is replaced by a fill value, but ``0 / 0`` stays missing;
* Spark 4 runs in ANSI mode, so a raw division by zero raises — every
  division goes through :func:`safe_div`.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

MICROS_PER_SECOND = 1_000_000
EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------
# time: every bucket computation runs on epoch microseconds (BIGINT), which
# keeps it independent of the session time zone.
# --------------------------------------------------------------------------

def epoch_us(c: ColumnOrName) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ (or TIMESTAMP) column."""
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), col(c).cast("timestamp_ntz"))


def from_epoch_us(c: ColumnOrName) -> Column:
    """TIMESTAMP_NTZ from epoch microseconds."""
    return F.timestamp_add("MICROSECOND", col(c), F.expr(EPOCH_NTZ))


def seconds(spec: str | int | float) -> int:
    """Parse a pandas-style frequency (``"2H"``, ``"10min"``, ``"1D"``) to seconds."""
    if isinstance(spec, (int, float)):
        return int(spec)
    s = spec.strip()
    units = [("min", 60), ("T", 60), ("H", 3600), ("h", 3600), ("D", 86400),
             ("d", 86400), ("S", 1), ("s", 1)]
    for suffix, mult in units:
        if s.endswith(suffix):
            num = s[: -len(suffix)].strip() or "1"
            return int(float(num) * mult)
    return int(s)


def bin_right(c: ColumnOrName, rule_s: int, offset_s: int = 0) -> Column:
    """Right-closed, right-labelled bin label of a timestamp.

    ``label = ceil((t - o) / r) * r + o`` on epoch microseconds.  Equals
    pandas ``resample(rule, offset=o, closed="right", label="right")``
    whenever ``r`` divides one day (origin ``start_day``).
    """
    r = rule_s * MICROS_PER_SECOND
    o = offset_s * MICROS_PER_SECOND
    t = epoch_us(c)
    k = F.ceil((t - F.lit(o)) / F.lit(r)).cast("long")
    return from_epoch_us(k * F.lit(r) + F.lit(o))


def bin_left(c: ColumnOrName, rule_s: int, offset_s: int = 0) -> Column:
    """Left-closed, left-labelled bin start (``floor`` form)."""
    r = rule_s * MICROS_PER_SECOND
    o = offset_s * MICROS_PER_SECOND
    t = epoch_us(c)
    k = F.floor((t - F.lit(o)) / F.lit(r)).cast("long")
    return from_epoch_us(k * F.lit(r) + F.lit(o))


def shift_time(c: ColumnOrName, secs: int) -> Column:
    return F.timestamp_add("SECOND", F.lit(int(secs)), col(c))


# --------------------------------------------------------------------------
# missing values and arithmetic
# --------------------------------------------------------------------------

def nan_to_null(c: ColumnOrName) -> Column:
    """NaN and ±inf become NULL (Spark orders NaN above every number)."""
    x = col(c)
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None)).otherwise(x)


def to_double(c: ColumnOrName) -> Column:
    """Numeric coercion: text that does not parse becomes NULL (pandas ``errors='coerce'``)."""
    return nan_to_null(F.expr(f"try_cast({c} AS DOUBLE)") if isinstance(c, str)
                       else c.try_cast("double"))


def safe_div(num: ColumnOrName, den: ColumnOrName, fill=None) -> Column:
    """``num / den`` with pandas' division-by-zero outcome mapped explicitly.

    ``x / 0`` (x ≠ 0) gives ``fill`` (NULL by default — the ``inf → NaN``
    clean); ``0 / 0`` is always NULL.
    """
    n, d = col(num), col(den)
    if fill is None:  # each operand once: nested ratios stay small
        return F.try_divide(n.cast("double"), d)
    return (F.when(d == 0, F.when(n == 0, F.lit(None).cast("double")).otherwise(F.lit(float(fill))))
            .otherwise(n.cast("double") / d))


def row_sum(cols: Sequence[ColumnOrName]) -> Column:
    """Row-wise sum skipping NULLs; all-NULL gives 0 (pandas ``sum(axis=1)``)."""
    return reduce(lambda a, b: a + b, [F.coalesce(col(c).cast("double"), F.lit(0.0)) for c in cols])


def row_count(cols: Sequence[ColumnOrName]) -> Column:
    return reduce(lambda a, b: a + b, [col(c).isNotNull().cast("int") for c in cols])


def row_mean(cols: Sequence[ColumnOrName]) -> Column:
    """Row-wise mean skipping NULLs; all-NULL gives NULL."""
    return F.try_divide(row_sum(cols), row_count(cols))


def plain_mean(cols: Sequence[ColumnOrName]) -> Column:
    """Row-wise mean that propagates NULL (pandas ``(a + b) / 2``)."""
    return reduce(lambda a, b: a + b, [col(c) for c in cols]) / F.lit(float(len(cols)))


def weighted_avg(values: Sequence[ColumnOrName], weights: Sequence[ColumnOrName]) -> Column:
    """``Σ w·x / Σ w`` over pairs (NULL propagates through a pair)."""
    num = reduce(lambda a, b: a + b, [col(v) * col(w) for v, w in zip(values, weights)])
    den = reduce(lambda a, b: a + b, [col(w) for w in weights])
    return safe_div(num, den)


def cut(c: ColumnOrName, lo=None, hi=None) -> Column:
    """Outside the closed range ``[lo, hi]`` → NULL; a missing bound is open."""
    x = col(c)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (x >= F.lit(lo))
    if hi is not None:
        cond = cond & (x <= F.lit(hi))
    return F.when(cond, x)


def clip(c: ColumnOrName, lo=None, hi=None) -> Column:
    """Clip to ``[lo, hi]`` keeping NULL (``least/greatest`` would skip NULL)."""
    x = col(c)
    out = x
    if hi is not None and lo is not None:
        out = F.when(x > F.lit(hi), F.lit(hi)).when(x < F.lit(lo), F.lit(lo)).otherwise(x)
    elif hi is not None:
        out = F.when(x > F.lit(hi), F.lit(hi)).otherwise(x)
    elif lo is not None:
        out = F.when(x < F.lit(lo), F.lit(lo)).otherwise(x)
    return out


def non_negative(c: ColumnOrName) -> Column:
    """``df[df < 0] = 0``."""
    x = col(c)
    return F.when(x < 0, F.lit(0.0)).otherwise(x)


def magnitude_gate(c: ColumnOrName, limit: float) -> Column:
    """Values beyond ``±limit`` become 0 (not NULL)."""
    x = col(c)
    return F.when(F.abs(x) > F.lit(limit), F.lit(0.0)).otherwise(x)


def zero_while(c: ColumnOrName, other: ColumnOrName, limit: float = 0.0) -> Column:
    """Values become 0 while another tag is above ``limit`` (a NULL there changes nothing)."""
    return F.when(F.coalesce(col(other) > F.lit(limit), F.lit(False)), F.lit(0.0)).otherwise(col(c))


def on_off(c: ColumnOrName, off_when: str, value: float) -> Column:
    """1 unless the value is NULL or below/above the limit, then 0."""
    x = col(c)
    if off_when == "less_than":
        off = x < F.lit(value)
    elif off_when == "greater_than":
        off = x > F.lit(value)
    else:
        raise ValueError(f"off_when must be less_than or greater_than, not {off_when!r}")
    return F.when(x.isNull() | off, F.lit(0)).otherwise(F.lit(1))


def all_of(preds: Iterable[Column]) -> Column:
    preds = list(preds)
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def any_of(preds: Iterable[Column]) -> Column:
    preds = list(preds)
    return reduce(lambda a, b: a | b, preds) if preds else F.lit(False)


def open_interval(c: ColumnOrName, lo=None, hi=None) -> Column:
    """``lo < c < hi`` with optional bounds (NULL compares false)."""
    x = col(c)
    preds = []
    if lo is not None:
        preds.append(x > F.lit(lo))
    if hi is not None:
        preds.append(x < F.lit(hi))
    return F.coalesce(all_of(preds), F.lit(False))


def r6(c: ColumnOrName) -> Column:
    """Round a double to 6 digits for cross-engine comparison."""
    return F.round(col(c).cast("double"), 6)

"""Row-positional windows at scale (WIN1–WIN13, CLN8, CLN9, AGG8, FLT11).

Spark's ``Window.partitionBy(tag).orderBy(ts)`` sends a whole series to one
task; with one tag holding a third of all rows that task is the job.  Two
building blocks keep every window distributed and exact:

**Halo buckets** (bounded frames: lags, leads, rolling statistics,
differences, limited fills).  Rows carry a dense position ``pos``.  Bucket
``b = pos div B``; the last ``back`` rows of every bucket are copied into
the next bucket and the first ``fwd`` rows into the previous one.  Windows
run per ``(keys, bucket)`` and only the bucket's own rows are kept, so a
frame reaching ``back`` rows behind or ``fwd`` rows ahead sees the same
rows as on the whole series.  Data grows by ``(back + fwd) / B``.

**Carry scans** (unbounded: forward fill, NULL runs, exponentially
weighted means).  Each bucket is summarised to one row, the summaries are
scanned with a window per key (``1/B`` of the data), and the carry is
joined back to the rows of the bucket.

``pos`` must be dense (0, 1, 2, … per key with no gaps).  On a complete
time grid it is arithmetic (:func:`sensorloom.operators.grid.grid_position`);
otherwise :func:`dense_index` builds it from rows sorted by range.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.session import written

DEFAULT_BUCKET_ROWS = 65_536

# --------------------------------------------------------------------------
# dense positions
# --------------------------------------------------------------------------


def dense_index(df: DataFrame, keys: Sequence[str], order_col: str, pos_col: str = "pos") -> DataFrame:
    """0-based row number per key in ``order_col`` order.

    Rows are sorted by range over the cluster and written with the number of
    their range; a row's position is its number within (key, range) plus the
    rows of the key's earlier ranges, so no key and no moment is one task.
    Rows equal in ``order_col`` follow in the order of a hash of the whole
    row, the same on every run.
    """
    spark = df.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    d = df.withColumn("_tie", tie).repartitionByRange(n, *keys, order_col, "_tie").withColumn("_part", F.spark_partition_id())
    d = written(d, "ranges")
    counts = d.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    offsets = counts.select(*[F.col(k).alias(f"_o_{k}") for k in keys], F.col("_part").alias("_o_part"),
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    rn = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(order_col, "_tie"))
    same = [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in keys] + [F.col("_part") == F.col("_o_part")]
    out = d.withColumn("_rn", rn).join(offsets, same)
    return out.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_off") + F.col("_rn") - 1).cast("long").alias(pos_col))


# --------------------------------------------------------------------------
# halo buckets
# --------------------------------------------------------------------------


def halo(df: DataFrame, pos_col: str, back: int, fwd: int = 0,
         bucket_rows: int = DEFAULT_BUCKET_ROWS) -> DataFrame:
    """Add ``_b`` (bucket) and ``_own`` (row belongs to ``_b``), copying halo rows."""
    B = int(bucket_rows)
    if back > B or fwd > B:
        raise ValueError("bucket_rows must be at least the frame reach")
    b = F.floor(F.col(pos_col) / F.lit(B)).cast("long")
    r = F.col(pos_col) - b * F.lit(B)
    parts = [F.struct(b.alias("_b"), F.lit(True).alias("_own"))]
    if back > 0:
        parts.append(F.when(r >= F.lit(B - back),
                            F.struct((b + 1).alias("_b"), F.lit(False).alias("_own"))))
    if fwd > 0:
        parts.append(F.when(r < F.lit(fwd),
                            F.struct((b - 1).alias("_b"), F.lit(False).alias("_own"))))
    arr = F.filter(F.array(*parts), lambda x: x.isNotNull()) if len(parts) > 1 else F.array(*parts)
    return (df.withColumn("_h", F.explode(arr))
              .withColumn("_b", F.col("_h._b")).withColumn("_own", F.col("_h._own"))
              .drop("_h"))


def positional(df: DataFrame, keys: Sequence[str], pos_col: str,
               build: Callable[[WindowSpec], dict[str, Column]],
               back: int, fwd: int = 0, bucket_rows: int = DEFAULT_BUCKET_ROWS) -> DataFrame:
    """Add the columns ``build(w)`` computed with ``w = partitionBy(keys).orderBy(pos)``.

    ``back``/``fwd`` is the farthest row any expression looks behind/ahead.
    Runs as one shuffle on ``(keys, bucket)`` and one sort inside each
    bucket, for any number of window columns sharing the spec.
    """
    h = halo(df, pos_col, back, fwd, bucket_rows)
    w = Window.partitionBy(*keys, "_b").orderBy(pos_col)
    cols = build(w)
    out = h.select("*", *[c.alias(n) for n, c in cols.items()])
    return out.where("_own").drop("_b", "_own")


# -- bounded-frame expressions (use inside ``build``) -----------------------

def lag_expr(c: str, n: int, w: WindowSpec) -> Column:
    """WIN1: value ``n`` rows back (``n < 0`` looks ahead)."""
    return F.lag(c, n).over(w) if n >= 0 else F.lead(c, -n).over(w)


def diff_expr(c: str, n: int, w: WindowSpec) -> Column:
    """WIN2: ``x - lag(x, n)``."""
    return F.col(c) - F.lag(c, n).over(w)


def rolling_full_mean(c: str, n: int, w: WindowSpec, dead: int = 0) -> Column:
    """WIN3: mean of the last ``n`` rows, ``dead`` rows ago (WIN7); NULL unless all ``n`` are present."""
    fr = w.rowsBetween(-(n - 1) - dead, -dead)
    return F.when(F.count(c).over(fr) == n, F.avg(c).over(fr))


def rolling_mean(c: str, n: int, w: WindowSpec, min_periods: int | None = None) -> Column:
    fr = w.rowsBetween(-(n - 1), 0)
    mp = n if min_periods is None else min_periods
    return F.when(F.count(c).over(fr) >= mp, F.avg(c).over(fr))


def flatline_expr(c: str, n: int, w: WindowSpec) -> Column:
    """WIN4: rolling std over ``n`` full rows is 0 ⇔ max == min (exact test)."""
    fr = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(c).over(fr) == n, F.max(c).over(fr) == F.min(c).over(fr))


def limited_fill(c: str, w: WindowSpec, ffill: int = 1, bfill: int = 2) -> Column:
    """CLN8: forward fill (limit ``ffill``) then backward fill (limit ``bfill``).

    Composed in one pass: ``coalesce(x, x[-1..-ffill], x[+1..+bfill])``.
    """
    parts = [F.col(c)] + [F.lag(c, k).over(w) for k in range(1, ffill + 1)] \
        + [F.lead(c, k).over(w) for k in range(1, bfill + 1)]
    return F.coalesce(*parts)


def sliding_medians(values: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """The median of ``values[i + lo .. i + hi]`` for every i, NaN left out; NaN where a frame has no number.

    The frame is held as a sorted list: a step inserts one value and deletes one, each found by bisection."""
    n, frame, out = len(values), [], np.full(len(values), np.nan)
    for v in values[0: max(0, min(n, hi))].tolist():  # what lies in the frame before the first step
        if v == v:
            insort(frame, v)
    for i in range(n):
        if 0 <= i + hi < n and (v := float(values[i + hi])) == v:
            insort(frame, v)
        if 0 <= i + lo - 1 < n and (v := float(values[i + lo - 1])) == v:
            del frame[bisect_left(frame, v)]
        if m := len(frame):
            out[i] = frame[m // 2] if m % 2 else (frame[m // 2 - 1] + frame[m // 2]) / 2.0
    return out


def rolling_medians(df: DataFrame, keys: Sequence[str], pos_col: str, value_col: str, frames: dict[str, tuple[int, int]],
                    bucket_rows: int = DEFAULT_BUCKET_ROWS) -> DataFrame:
    """``df`` with the exact median over rows ``lo`` to ``hi`` from each row, for every ``name: (lo, hi)``; NULL when a frame is empty.

    Halo buckets as in :func:`positional`; a bucket is worked through once a frame, so a row costs the logarithm of the
    frame and not the frame."""
    back, fwd = max(0, *(-lo for lo, _ in frames.values())), max(0, *(hi for _, hi in frames.values()))
    h = halo(df, pos_col, back, fwd, max(bucket_rows, back, fwd))
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, T.DoubleType()) for n in frames]])

    def medians(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(pos_col, kind="stable").reset_index(drop=True)
        x = pdf[value_col].to_numpy(dtype=np.float64, na_value=np.nan)
        for name, (lo, hi) in frames.items():
            pdf[name] = sliding_medians(x, lo, hi)
            pdf[name] = pdf[name].astype(object).where(pdf[name].notna(), None)
        return pdf.loc[pdf["_own"], [f.name for f in schema.fields]]
    return h.groupBy(*keys, "_b").applyInPandas(medians, schema)


# --------------------------------------------------------------------------
# carry scans
# --------------------------------------------------------------------------


def _bucket(pos_col: str, B: int) -> Column:
    return F.floor(F.col(pos_col) / F.lit(B)).cast("long")


def ffill(df: DataFrame, keys: Sequence[str], pos_col: str, cols: Sequence[str],
          bucket_rows: int = DEFAULT_BUCKET_ROWS) -> DataFrame:
    """CLN9: unlimited forward fill (pandas ``pad``) per key, as a carry scan."""
    B = int(bucket_rows)
    d = df.withColumn("_b", _bucket(pos_col, B))
    w_in = (Window.partitionBy(*keys, "_b").orderBy(pos_col)
            .rowsBetween(Window.unboundedPreceding, 0))
    d = d.select("*", *[F.last(c, True).over(w_in).alias(f"_in_{c}") for c in cols])
    summ = df.withColumn("_b", _bucket(pos_col, B)).groupBy(*keys, "_b").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(pos_col))).alias(f"_last_{c}")
          for c in cols])
    w_c = (Window.partitionBy(*keys).orderBy("_b")
           .rowsBetween(Window.unboundedPreceding, -1))
    carry = summ.select(*keys, "_b", *[F.last(f"_last_{c}", True).over(w_c).alias(f"_cy_{c}")
                                       for c in cols])
    out = d.join(carry, [*keys, "_b"], "left")
    sel = [F.col(c) for c in df.columns if c not in cols]
    sel += [F.coalesce(F.col(f"_in_{c}"), F.col(f"_cy_{c}")).alias(c) for c in cols]
    return out.select(*sel)


def null_runs(df: DataFrame, keys: Sequence[str], pos_col: str, value_col: str = "value",
              bucket_rows: int = DEFAULT_BUCKET_ROWS) -> DataFrame:
    """Per row: ``run_len`` = length of the NULL run the row is in (NULL for
    non-NULL rows) and ``run_closed`` = a non-NULL row follows the run.

    Built from the previous and next non-NULL positions, each a carry scan.
    """
    B = int(bucket_rows)
    nn = F.when(F.col(value_col).isNotNull(), F.col(pos_col))
    d = df.withColumn("_b", _bucket(pos_col, B)).withColumn("_nn", nn)
    w, down = (Window.partitionBy(*keys, "_b").orderBy(o) for o in (F.col(pos_col), F.col(pos_col).desc()))
    d = d.select("*",
                 F.last("_nn", True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("_pi"),
                 # the next one is the last one seen from the other end: a frame that grows, not one worked out anew for each row
                 F.last("_nn", True).over(down.rowsBetween(Window.unboundedPreceding, -1)).alias("_ni"))
    summ = d.groupBy(*keys, "_b").agg(F.max("_nn").alias("_mx"), F.min("_nn").alias("_mn"),
                                      F.min(pos_col).alias("_p0"), F.max(pos_col).alias("_p1"))
    wc = Window.partitionBy(*keys).orderBy("_b")
    carry = summ.select(
        *keys, "_b",
        F.max("_mx").over(wc.rowsBetween(Window.unboundedPreceding, -1)).alias("_pc"),
        F.min("_mn").over(wc.rowsBetween(1, Window.unboundedFollowing)).alias("_nc"),
        F.min("_p0").over(Window.partitionBy(*keys)).alias("_first"),
        F.max("_p1").over(Window.partitionBy(*keys)).alias("_last"),
    )
    out = d.join(carry, [*keys, "_b"], "left")
    prev_nn = F.coalesce("_pi", "_pc")
    next_nn = F.coalesce("_ni", "_nc")
    start = F.coalesce(prev_nn + 1, F.col("_first"))
    # run end: next non-NULL - 1, or the last position of the key when none follows
    end = F.coalesce(next_nn - 1, F.col("_last"))
    is_null = F.col(value_col).isNull()
    return (out.withColumn("run_len", F.when(is_null, end - start + 1))
               .withColumn("run_closed", F.when(is_null, next_nn.isNotNull()))
               .drop("_b", "_nn", "_pi", "_ni", "_pc", "_nc", "_first", "_last"))


def max_null_run(df: DataFrame, keys: Sequence[str], pos_col: str, value_col: str = "value",
                 bucket_rows: int = DEFAULT_BUCKET_ROWS) -> DataFrame:
    """AGG8: longest run of consecutive NULL rows per key (0 when none).

    Exact without any per-key window over rows: each bucket keeps its first
    and last non-NULL positions and its longest internal gap; buckets are
    stitched by a window over the (small) bucket summary.
    """
    B = int(bucket_rows)
    d = df.withColumn("_b", _bucket(pos_col, B)).withColumn(
        "_nn", F.when(F.col(value_col).isNotNull(), F.col(pos_col)))
    w = Window.partitionBy(*keys, "_b").orderBy(pos_col)
    d = d.withColumn("_gap", F.col("_nn") - F.last("_nn", True).over(
        w.rowsBetween(Window.unboundedPreceding, -1)) - 1)
    summ = d.groupBy(*keys, "_b").agg(
        F.min("_nn").alias("_mn"), F.max("_nn").alias("_mx"),
        F.max("_gap").alias("_g"), F.min(pos_col).alias("_lo"), F.max(pos_col).alias("_hi"))
    wc = Window.partitionBy(*keys).orderBy("_b")
    summ = summ.withColumn("_prev", F.max("_mx").over(wc.rowsBetween(Window.unboundedPreceding, -1)))
    summ = summ.withColumn("_first", F.min("_lo").over(Window.partitionBy(*keys)))
    # gap entering the bucket: from the previous non-NULL (or before the first row)
    entering = F.col("_mn") - F.coalesce(F.col("_prev"), F.col("_first") - 1) - 1
    per_b = summ.groupBy(*keys).agg(
        F.max(F.greatest(F.coalesce("_g", F.lit(0)), F.coalesce(entering, F.lit(0)))).alias("_inner"),
        F.max("_hi").alias("_hi"), F.max("_mx").alias("_mx"), F.min("_lo").alias("_lo"))
    trailing = F.col("_hi") - F.coalesce(F.col("_mx"), F.col("_lo") - 1)
    return per_b.select(*keys, F.greatest(F.col("_inner"), trailing).cast("long")
                        .alias("max_null_run"))


def remove_long_null_runs(df: DataFrame, keys: Sequence[str], pos_col: str, value_col: str,
                          max_run: int = 48, bucket_rows: int = DEFAULT_BUCKET_ROWS) -> DataFrame:
    """FLT11: drop rows inside NULL runs of at least ``max_run`` rows that are
    followed by a non-NULL row; a run that reaches the end is kept."""
    r = null_runs(df, keys, pos_col, value_col, bucket_rows)
    drop = F.coalesce((F.col("run_len") >= max_run) & F.col("run_closed"), F.lit(False))
    return r.where(~drop).drop("run_len", "run_closed")


# --------------------------------------------------------------------------
# exponentially weighted mean (WIN5)
# --------------------------------------------------------------------------

def ewm_means(df: DataFrame, keys: Sequence[str], pos_col: str, specs: Sequence[tuple[str, float, str]],
              bucket_rows: int = DEFAULT_BUCKET_ROWS) -> DataFrame:
    """WIN5: pandas ``ewm(halflife=h, adjust=True).mean()`` with NULLs keeping position, for all
    ``(value column, halflife, output column)`` of ``specs`` in one carry scan.

    With ``d = 0.5 ** (1 / h)``, at row ``p``: ``Σ x_j d^(p-j) / Σ d^(p-j)`` over the
    non-NULL rows ``j <= p``; a NULL row repeats the last mean, since both sums
    only shrink by the same factor.  Inside a bucket both sums run on; a
    summary row per bucket holds them as of its end, and those of earlier buckets
    are added with the weight their distance leaves — as many buckets back as a
    double can tell from zero, so no old value is cut off, however large."""
    half = [float(h) for _, h, _ in specs]
    B = max(1, min(int(bucket_rows), int(900 * min(half))))  # keeps d^(-r) finite
    b = _bucket(pos_col, B)
    d = df.withColumn("_b", b)
    r = (F.col(pos_col) - F.col("_b") * F.lit(B)).cast("double")
    w = Window.partitionBy(*keys, "_b").orderBy(pos_col).rowsBetween(Window.unboundedPreceding, 0)
    sums, ends = {}, []
    for i, (c, h, _) in enumerate(specs):
        decay = F.lit(0.5 ** (1.0 / float(h)))
        x, up = F.col(c).cast("double"), F.pow(decay, -r)
        there = x.isNotNull()
        sums |= {f"_n{i}": F.sum(F.when(there, x * up)).over(w), f"_d{i}": F.sum(F.when(there, up)).over(w)}
        to_end = F.pow(decay, F.lit(B - 1.0) - r)
        ends += [F.sum(F.when(there, x * to_end)).alias(f"_en{i}"), F.sum(F.when(there, to_end)).alias(f"_ed{i}")]
    summary = d.groupBy(*keys, "_b").agg(*ends)
    back = max(int(math.ceil(1100.0 * h / B)) + 1 for h in half)
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(-back, -1)
    cells = F.collect_list(F.struct("_b", *[f"_e{k}{i}" for i in range(len(specs)) for k in "nd"])).over(before)
    carry = summary.select(*keys, "_b", cells.alias("_cells"))

    def carried(i: int, k: str, h: float):
        decay = F.lit(0.5 ** (1.0 / float(h)))
        return F.aggregate("_cells", F.lit(0.0), lambda t, e: t + F.coalesce(e[f"_e{k}{i}"], F.lit(0.0)) * F.pow(
            decay, (F.col("_b") - 1 - e["_b"]).cast("double") * F.lit(float(B))))
    carry = carry.select(*keys, "_b", *[carried(i, k, h).alias(f"_c{k}{i}") for i, (_, h, _) in enumerate(specs) for k in "nd"])
    out = d.withColumns(sums).join(carry, [*keys, "_b"])
    final = {}
    for i, (_, h, name) in enumerate(specs):
        decay = F.lit(0.5 ** (1.0 / float(h)))
        num = F.coalesce(F.col(f"_n{i}"), F.lit(0.0)) + F.col(f"_cn{i}") * decay
        den = F.coalesce(F.col(f"_d{i}"), F.lit(0.0)) + F.col(f"_cd{i}") * decay
        final[name] = F.when(den > 0, num / den)
    names = set(final)
    return out.select(*[c for c in df.columns if c not in names], *[v.alias(k) for k, v in final.items()])


def ewm_mean(df: DataFrame, keys: Sequence[str], pos_col: str, value_col: str,
             halflife: float, out_col: str, bucket_rows: int | None = None) -> DataFrame:
    """WIN5 for one column, see :func:`ewm_means`."""
    return ewm_means(df, keys, pos_col, [(value_col, halflife, out_col)], bucket_rows or DEFAULT_BUCKET_ROWS)

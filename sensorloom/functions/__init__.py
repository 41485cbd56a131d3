"""Column-level building blocks (see :mod:`sensorloom.functions.exprs`)."""

from sensorloom.functions.exprs import (  # noqa: F401
    all_of, any_of, bin_left, bin_right, clip, cut, epoch_us, from_epoch_us,
    magnitude_gate, nan_to_null, non_negative, on_off, open_interval, plain_mean,
    r6, row_count, row_mean, row_sum, safe_div, seconds, shift_time, to_double,
    weighted_avg,
)
from sensorloom.functions.naming import (  # noqa: F401
    norm_columns_name, norm_name, parse_column_names, parse_name,
)

"""Pure Column expressions. Everything here is JVM-side except the NFKD
step of :func:`normalize_text`, which is an Arrow-batched pandas UDF that
only touches non-ASCII values."""

from feria.functions.numeric import (flag, mean_round, money, money_mean_round, money_round,
                                     nan_to_null, null_if_zero, pct, ratio_round)
from feria.functions.text import collapse_ws, normalize_text, strip_ws, upper_strip
from feria.functions.time import floor_days, to_ts, year_month

__all__ = ["flag", "mean_round", "money", "money_mean_round", "money_round", "nan_to_null",
           "null_if_zero",
           "pct", "ratio_round", "collapse_ws", "normalize_text", "strip_ws", "upper_strip",
           "floor_days", "to_ts", "year_month"]

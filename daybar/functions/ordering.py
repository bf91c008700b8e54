"""Clock text as a number, so that first/last by time compares longs and not text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clock_micros(t: Column) -> Column:
    """Microseconds since midnight of ``HH``, ``HH:MM``, ``HH:MM:SS`` or ``HH:MM:SS.f…`` (1-6 digits).

    Zero-padded clock text sorts like its numeric value, so this keeps the
    order of the text. Anything else raises (ANSI cast or ``raise_error``)
    rather than being ordered wrongly; use ``time_order="text"`` for such data.
    """
    n = F.length(t)
    h = F.substring(t, 1, 2).cast("long")
    m = F.when(n >= 5, F.substring(t, 4, 2).cast("long")).otherwise(F.lit(0))
    s = F.when(n >= 8, F.substring(t, 7, 2).cast("long")).otherwise(F.lit(0))
    f = F.when(n >= 10, F.rpad(F.substring(t, 10, 6), 6, "0").cast("long")).otherwise(F.lit(0))
    shape_ok = ((n == 2)
                | ((F.substring(t, 3, 1) == ":")
                   & ((n == 5) | ((F.substring(t, 6, 1) == ":")
                                  & ((n == 8) | ((F.substring(t, 9, 1) == ".") & n.between(10, 15)))))))
    micros = ((h * 60 + m) * 60 + s) * 1_000_000 + f
    return F.when(shape_ok, micros).otherwise(
        F.raise_error(F.concat(F.lit("Time is not clock text HH[:MM[:SS[.ffffff]]]: "), t)).cast("long"))

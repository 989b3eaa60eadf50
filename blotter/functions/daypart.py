"""Part of the day from a time of day written as the number HHmm."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from blotter.functions._cols import ColumnOrName, as_col

# Half-open HHmm bounds of each part of the day; every other
# time of day is "night".
MORNING = ("morning", 500, 1200)
AFTERNOON = ("afternoon", 1200, 1700)
EVENING = ("evening", 1700, 2100)
NIGHT = "night"
DAY_PARTS = (MORNING, AFTERNOON, EVENING)


def day_segment(c: ColumnOrName) -> Column:
    """HHmm number → part of the day, as a native expression.

    A missing time stays NULL instead of falling through to "night".
    """
    t = as_col(c)
    out = F.when(t.isNull(), F.lit(None).cast("string"))
    for name, lo, hi in DAY_PARTS:
        out = out.when((t >= lo) & (t < hi), F.lit(name))
    return out.otherwise(F.lit(NIGHT))


def _segments(times: pd.Series) -> pd.Series:
    t = pd.to_numeric(times, errors="coerce").to_numpy(dtype="float64")
    conditions = [np.isnan(t)] + [(t >= lo) & (t < hi) for _, lo, hi in DAY_PARTS]
    choices = [None] + [name for name, _, _ in DAY_PARTS]
    return pd.Series(np.select(conditions, choices, default=NIGHT), dtype=object)


# Arrow-batched form of the same rule, for callers that need a Python
# function (kept equal to ``day_segment`` by tests).  The module is pickled
# by value, so executors' Python workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
day_segment_pandas = F.pandas_udf(_segments, StringType())

"""Freight dimension labels (N33, N34) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Freight range labels and their upper bounds, in order.
FREE_LABEL = "R$0,00 (FREE)"
FREIGHT_RANGES = [
    (100, "entre R$ 0,01 e R$ 100,00"),
    (200, "entre R$ 100,01 e R$ 200,00"),
    (300, "entre R$ 200,01 e R$ 300,00"),
    (500, "entre R$ 300,01 e R$ 500,00"),
    (1000, "entre R$ 500,01 e R$ 1.000,00"),
    (10000, "entre R$ 1.000,01 e R$ 10.000,00"),
]
ABOVE_LABEL = "acima de R$ 10.000,00"


# Deadline buckets, as the highest deadline in days and its label, in order.
DEADLINE_BUCKETS = [(5, ">0"), (10, ">5"), (15, ">10"), (20, ">15"), (25, ">20"), (30, ">25"), (35, ">30"), (40, ">35"),
                    (45, ">40"), (60, ">45")]
LATEST_BUCKET = ">60"


def freight_range(value: Column) -> Column:
    """Null stays null, 0 is free, then the paid ranges.

    Negative values fall in the first paid range (they are <= 100).
    """
    v = value.try_cast("double")
    expr = F.when(v.isNull(), F.lit(None).cast("string")).when(v == 0, F.lit(FREE_LABEL))
    for bound, label in FREIGHT_RANGES:
        expr = expr.when(v <= bound, F.lit(label))
    return expr.otherwise(F.lit(ABOVE_LABEL))


def deadline_bucket(deadline: Column) -> Column:
    """The first bucket whose bound the deadline does not pass (also for
    deadlines of 0 or less)."""
    d = deadline.try_cast("double")
    expr = F.when(d.isNull(), F.lit(None).cast("string"))
    for bound, label in DEADLINE_BUCKETS:
        expr = expr.when(d <= bound, F.lit(label))
    return expr.otherwise(F.lit(LATEST_BUCKET))

"""Decimal arithmetic, unit conversion and statistics with stated rounding."""

from __future__ import annotations

from decimal import Decimal, localcontext

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

EXACT = "decimal(38,18)"


def decimal_equal(a: Column, b: Column) -> Column:
    """Equal as numbers (100 = 100.0); false where either is no number."""
    return F.coalesce(a.try_cast(EXACT) == b.try_cast(EXACT), F.lit(False))


def fold_decimals(operation: str, operands: Column) -> Column:
    """ADD, SUBTRACT or MULTIPLY over two or more numbers, left to right; null for fewer or for what is no number."""
    rest = F.transform(F.slice(operands, 2, F.greatest(F.size(operands) - 1, F.lit(0))), lambda x: x.try_cast(EXACT))
    step = {"ADD": lambda a, x: a + x, "SUBTRACT": lambda a, x: a - x, "MULTIPLY": lambda a, x: a * x}[operation]
    return F.when(F.size(operands) >= 2, F.aggregate(rest, F.try_element_at(operands, F.lit(1)).try_cast(EXACT), lambda a, x: step(a, x).cast(EXACT)))


@F.pandas_udf(StringType())
def divide_decimals(operands: pd.Series) -> pd.Series:
    """Left-to-right division with 28 digits, as plain text without trailing zeros; null where it can't be done."""

    def one(xs):
        try:
            with localcontext() as ctx:
                ctx.prec = 28
                a, *rest = map(Decimal, xs)
                for x in rest:
                    a /= x
                return format(a.normalize(), "f") if rest else None
        except Exception:
            return None

    return operands.map(one)


#: Metres, grams, seconds and bytes in a unit.
UNITS = {"B": ("size", "1"), "KiB": ("size", "1024"), "m": ("length", "1"), "km": ("length", "1000"), "cm": ("length", "0.01"), "mm": ("length", "0.001"), "g": ("mass", "1"), "kg": ("mass", "1000"), "mg": ("mass", "0.001"), "s": ("time", "1"), "min": ("time", "60"), "h": ("time", "3600")}


def convert_units(value: Column, source: Column, target: Column) -> Column:
    """Value in another unit of the same kind; null for unknown units and across kinds."""
    kind = F.create_map(*(F.lit(x) for k, (d, _) in UNITS.items() for x in (k, d)))
    factor = F.create_map(*(x for k, (_, f) in UNITS.items() for x in (F.lit(k), F.lit(f).cast("decimal(20,6)"))))
    return F.when(F.try_element_at(kind, source) == F.try_element_at(kind, target), (value.try_cast("decimal(20,6)") * F.try_element_at(factor, source) / F.try_element_at(factor, target)).cast(EXACT))


def draw_number(seed: int, n: Column, *counters: Column) -> Column:
    """A number from 0 to n - 1 for a seed and counters: 60 bits of the MD5 of all of them, joined by bars, modulo n. SQL can say the same."""
    text = F.concat_ws("|", F.lit(str(seed)), *(c.cast("string") for c in counters))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % n


def bootstrap_interval(spark: SparkSession, values: DataFrame, draws: int = 2000, seed: int = 7) -> DataFrame:
    """One row, lower and upper: the 95 % percentile interval of the mean of (group, difference) over groups drawn with replacement.

    With n groups numbered in order, place i of draw d takes group draw_number(seed, n, d, i): executors make the
    draws from the counters alone, and the driver holds none. Bounds are those at places int(0.025 * (draws - 1)) and int(0.975 *
    (draws - 1)) of the ascending means. A difference that is null counts in no mean. No groups are an error.
    """
    n = values.count()
    if not n:
        raise ValueError("no groups")
    numbered = values.select((F.row_number().over(Window.orderBy("group")) - 1).cast("long").alias("i"), "difference")  # groups of one experiment: few
    places = spark.range(draws * n).select(F.floor(F.col("id") / n).alias("draw"), (F.col("id") % n).alias("place"))
    drawn = places.select("draw", draw_number(seed, F.lit(n), F.col("draw"), F.col("place")).alias("i"))
    means = drawn.join(numbered, "i").groupBy("draw").agg(F.avg("difference").alias("mean"))
    place = means.withColumn("k", F.row_number().over(Window.orderBy("mean")) - 1)  # a row a draw
    return place.agg(F.max(F.when(F.col("k") == int(0.025 * (draws - 1)), F.col("mean"))).alias("lower"), F.max(F.when(F.col("k") == int(0.975 * (draws - 1)), F.col("mean"))).alias("upper"))

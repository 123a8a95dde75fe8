"""Trailing-window statistics per key and the suspicion rule built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from caudal.functions.rules import MONEY, flag

CENTS = DecimalType(24, 0)
WIDE = DecimalType(38, 0)
LIMB = 10 ** 12
LIMB_PAIRS = (("_h", "_h", "_hh"), ("_h", "_l", "_hl"), ("_l", "_l", "_ll"))


def _cents(value: str) -> Column:
    """Whole cents, from the decimal text of the amount; NULL beyond the limit of `money`."""
    return (F.col(value).try_cast(MONEY) * 100).cast(CENTS)


def _quotient(value: str, by: str) -> str:
    """Floor of value / by for whole decimals of any size (`div` gives 64 bits only)."""
    return f"cast(({value} - pmod({value}, {by})) / {by} as decimal(38,0))"


def daily_stats(df: DataFrame, key: str, date_col: str, value: str, days: int,
                mean: str, sd: str) -> DataFrame:
    """Mean and sample deviation of the `days` days before each (key, day) that occurs.

    The frame leaves out the current day, so every row of a day sees the same window and the
    window needs only one row per key and day: counts, sums and sums of squares, which are
    aggregated before the shuffle. A key with a large share of all rows then costs at most
    one window row per calendar day.

    Sums are whole cents in decimals, so they are exact and do not depend on row order. With
    sum = n*k + r, the squared deviations from k are squares - n*k*k - 2*k*r, exactly; only the
    small correction r*r/n is done in floating point, so equal amounts give a deviation of 0.
    Squares are summed in three parts, from the upper and lower twelve digits of each amount, so that no
    sum overflows. The parts are carried into one another before they become floating point, and so
    do not cancel.

    A window with an amount of MONEY_LIMIT or more (or NaN) has no mean and no deviation: it is
    not computed from the others.
    """
    cents = _cents(value)
    per_day = (
        df.filter(F.col(key).isNotNull() & F.col(date_col).isNotNull())
        .select(key, date_col, cents.alias("_c"), (F.col(value).isNotNull() & cents.isNull()).alias("_beyond"))
        # Most amounts are below one limb, and need no division.
        .withColumn("_l", F.expr(f"case when _c between 0 and {LIMB - 1} then _c else pmod(_c, {LIMB}) end")
                    .cast("decimal(12,0)"))
        .withColumn("_h", F.expr(f"case when _c between 0 and {LIMB - 1} then 0 "
                                 f"else cast((_c - _l) / {LIMB} as decimal(12,0)) end").cast("decimal(12,0)"))
        .groupBy(key, date_col)
        .agg(F.count("_c").alias("_n"), F.count_if("_beyond").alias("_lost"),
             F.sum("_c").alias("_s"),
             *[F.sum(F.col(x) * F.col(y)).alias(name) for x, y, name in LIMB_PAIRS])
    )
    frame = Window.partitionBy(key).orderBy(F.unix_date(date_col)).rangeBetween(-days, -1)
    sums = per_day.select(
        key, date_col,
        F.sum("_n").over(frame).cast("decimal(20,0)").alias("_rows"),
        F.sum("_lost").over(frame).alias("_lost"),
        F.sum("_s").over(frame).cast(WIDE).alias("_sum"),
        *[F.sum(name).over(frame).cast(WIDE).alias(name) for _, _, name in LIMB_PAIRS],
    ).filter("_rows > 0")
    parts = (
        sums.withColumn("_k", F.expr(f"cast({_quotient('_sum', '_rows')} as decimal(24,0))"))
        .withColumn("_r", F.expr("cast(pmod(_sum, _rows) as decimal(20,0))"))
        .withColumn("_kl", F.expr(f"cast(pmod(_k, {LIMB}) as decimal(12,0))"))
        .withColumn("_kh", F.expr(f"cast((_k - _kl) / {LIMB} as decimal(12,0))"))
        .withColumn("_dh", F.expr("_hh - cast(_rows * (_kh * _kh) as decimal(38,0))"))
        .withColumn("_dm", F.expr("2 * (_hl - cast(_rows * (_kh * _kl) as decimal(38,0))"
                                  " - cast(_kh * _r as decimal(38,0)))").cast(WIDE))
        .withColumn("_dl", F.expr("_ll - cast(_rows * (_kl * _kl) as decimal(38,0))"
                                  " - cast(2 * (_kl * _r) as decimal(38,0))").cast(WIDE))
        .withColumn("_m", F.expr(f"_dm + {_quotient('_dl', str(LIMB))}").cast(WIDE))
        .withColumn("_u", F.expr(f"_dh + {_quotient('_m', str(LIMB))}").cast(WIDE))
    )
    around_k = (F.col("_u").cast("double") * float(LIMB) ** 2
                + F.expr(f"cast(pmod(_m, {LIMB}) as double)") * float(LIMB)
                + F.expr(f"cast(pmod(_dl, {LIMB}) as double)"))
    rest = F.col("_r").cast("double")
    count = F.col("_rows").cast("double")
    squares = around_k - rest * rest / count
    whole = F.col("_lost") == 0
    return parts.select(
        key, date_col,
        F.when(whole, (F.col("_k").cast("double") + rest / count) / 100).alias(mean),
        F.when(whole & (count > 1),
               F.sqrt(F.greatest(squares, F.lit(0.0)) / (count - 1)) / 100).alias(sd),
    )


def rolling_stats(df: DataFrame, key: str, date_col: str, value: str, days: int = 30,
                  mean: str = "mean_30d", sd: str = "sd_30d",
                  history: DataFrame | None = None) -> DataFrame:
    """Add the trailing mean and deviation to every row. `value` is money, exact to the cent.

    `history` gives the rows to compute from where they are not those of `df`.
    """
    stats = daily_stats(df if history is None else history, key, date_col, value, days, mean, sd)
    return df.join(stats, [key, date_col], "left")


def suspicious(value: str, mean: str, sd: str, sigmas: float = 3) -> Column:
    """1 where the amount exceeds the mean by more than so many deviations."""
    known = F.col(mean).isNotNull() & F.col(sd).isNotNull()
    return flag(known & (F.col(value) > F.col(mean) + F.lit(sigmas) * F.col(sd)))


def suspicious_flag(df: DataFrame, key: str, date_col: str, value: str, days: int = 30,
                    sigmas: float = 3, name: str = "ind_sospechoso",
                    history: DataFrame | None = None) -> DataFrame:
    stats = rolling_stats(df, key, date_col, value, days, "_mean", "_sd", history)
    return stats.withColumn(name, suspicious(value, "_mean", "_sd", sigmas)).drop("_mean", "_sd")

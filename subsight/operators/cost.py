"""Usage and cost queries on billing tables (Q26-Q31).

``usage`` holds one row per metered interval; ``list_prices`` holds price
versions per SKU valid on ``[price_start_time, price_end_time)``, the open
version having a NULL end. Quantities and prices are decimals, summed
exactly and turned into doubles only after rounding.

Date windows end at ``as_of``: a date, ``"today"`` (``current_date()``), or
by default the greatest usage day of the table, so that results on a fixed
table do not move from one day to the next. The default is a scalar
subquery: nothing runs before the result is asked for. A caller with
several questions resolves it once (:func:`latest_usage_day`) and passes
the date, which is then a literal in the scan's pushed filters.

The ingest keeps the newest day with the stored table
(:meth:`subsight.lake.Lake.usage_day`); the registered queries pass it.

Stored usage is partitioned by month (``usage_ym``). Where that column is
there, the window also bounds it, so files of other months are not opened,
and the greatest day is looked for in the last month only.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subsight.functions import month_of
from subsight.model import USAGE_MONTH


def _latest(usage: DataFrame) -> DataFrame:
    if USAGE_MONTH in usage.columns:
        usage = usage.where(F.col(USAGE_MONTH) == usage.select(F.max(USAGE_MONTH)).scalar())
    return usage.select(F.max("usage_date").alias("usage_date"))


def latest_usage_day(usage: DataFrame) -> _dt.date | None:
    """The greatest usage day, resolved now: one aggregate, one value."""
    return _latest(usage).first()[0]


def _as_of(usage: DataFrame, as_of: str | _dt.date | None) -> Column:
    if as_of is None:
        return _latest(usage).scalar()
    if as_of == "today":
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def recent(usage: DataFrame, days: int | None = 30, as_of: str | _dt.date | None = None) -> DataFrame:
    """Usage from ``days`` days before ``as_of`` up to ``as_of`` (all rows
    when ``days`` is None)."""
    if days is None:
        return usage
    last = _as_of(usage, as_of)
    first = F.date_sub(last, days)
    if USAGE_MONTH in usage.columns:
        if as_of in (None, "today"):
            months = month_of(first), month_of(last)
        else:  # literals, so partitions are pruned while planning
            day = _dt.date.fromisoformat(str(as_of))
            months = f"{day - _dt.timedelta(days):%Y-%m}", f"{day:%Y-%m}"
        usage = usage.where(F.col(USAGE_MONTH).between(*months))
    return usage.where(F.col("usage_date").between(first, last))


def rounded_sum(col: Column | str, digits: int = 2) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.round(F.sum(c), digits).cast("double")


def daily_usage(usage: DataFrame, days: int | None = 30, as_of=None) -> DataFrame:
    """Q26: usage per day."""
    return (recent(usage, days, as_of).groupBy("usage_date")
            .agg(rounded_sum("usage_quantity").alias("dbus"))
            .orderBy("usage_date"))


def usage_by_sku(usage: DataFrame, days: int | None = 30, as_of=None) -> DataFrame:
    """Q27: usage per SKU, largest first."""
    return (recent(usage, days, as_of).groupBy("sku_name")
            .agg(rounded_sum("usage_quantity").alias("dbus"))
            .orderBy(F.desc("dbus"), "sku_name"))


def priced(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Usage joined to the price version in force at its end time (inner:
    usage without a valid price drops out; overlapping versions would count
    it twice, as the equivalent SQL join does).

    Planned as an equi-join on the SKU with the validity interval as a
    residual condition. The price list is as small as the SKU catalogue,
    so the size-checked broadcast applies; since a few SKUs carry all the
    usage, a shuffled join on sku_name would be skewed: for price lists
    beyond the broadcast threshold there is :func:`priced_by_time`.
    """
    u, p = usage.alias("u"), prices.alias("p")
    cond = (
        (F.col("u.sku_name") == F.col("p.sku_name"))
        & (F.col("u.usage_end_time") >= F.col("p.price_start_time"))
        & ((F.col("u.usage_end_time") < F.col("p.price_end_time")) | F.col("p.price_end_time").isNull())
    )
    return _priced_columns(u.join(p, cond, "inner"))


def priced_by_time(usage: DataFrame, prices: DataFrame, bucket_days: int = 1) -> DataFrame:
    """:func:`priced` for price lists too large to broadcast.

    Validity intervals are cut at time buckets, so (SKU, bucket) is an equi
    key, and the usage of a SKU that carries most of all is spread over as
    many keys as it has buckets instead of meeting its prices in one task.
    The interval itself stays as a condition, for the buckets in which a
    price changes; a usage row lies in one bucket, so it meets a price once.

    The first and last time of the usage bound the buckets of open and long
    intervals: one aggregate, two values. A price is repeated once a bucket
    it is valid in, which depends on the time span, not on the usage.
    """
    span = usage.agg(F.min("usage_end_time"), F.max("usage_end_time")).first()
    if span[0] is None:
        return priced(usage, prices)
    width = bucket_days * 86_400_000_000
    bucket = lambda c: F.floor(F.unix_micros(c) / F.lit(width)).cast("long")
    first, last = (F.lit(t).cast("timestamp") for t in span)
    end = F.coalesce("price_end_time", last)
    cut = prices.where((F.col("price_start_time") <= last) & (end >= first)) \
        .withColumn("bucket", F.explode(F.sequence(bucket(F.greatest("price_start_time", first)), bucket(F.least(end, last)))))
    u, p = usage.withColumn("bucket", bucket(F.col("usage_end_time"))).alias("u"), cut.alias("p")
    cond = (
        (F.col("u.sku_name") == F.col("p.sku_name")) & (F.col("u.bucket") == F.col("p.bucket"))
        & (F.col("u.usage_end_time") >= F.col("p.price_start_time"))
        & ((F.col("u.usage_end_time") < F.col("p.price_end_time")) | F.col("p.price_end_time").isNull())
    )
    return _priced_columns(u.join(p, cond, "inner"))


def _priced_columns(joined: DataFrame) -> DataFrame:
    return joined.select(
        F.col("u.usage_date").alias("usage_date"),
        F.col("u.sku_name").alias("sku_name"),
        F.col("u.usage_quantity").alias("usage_quantity"),
        F.col("u.usage_metadata.job_id").alias("job_id"),
        F.col("p.currency_code").alias("currency_code"),
        F.col("p.pricing.effective_list.default").alias("unit_price"),
    )


def _cost_by(priced_usage: DataFrame, key: str) -> DataFrame:
    """Exact decimal sums of quantity and cost per ``key``, rounded at the
    end, with the greatest currency label.

    The sums are taken per (key, currency) first: grouping by a string is a
    hash aggregate, while ``max`` over a string column would make the
    aggregate over every priced usage row sort-based. The second level
    folds the few currency rows of a key."""
    per_currency = priced_usage.groupBy(key, "currency_code").agg(
        F.sum("usage_quantity").alias("quantity"),
        F.sum(F.col("usage_quantity") * F.col("unit_price")).alias("cost"),
    )
    return per_currency.groupBy(key).agg(
        rounded_sum("quantity").alias("dbus"),
        rounded_sum("cost").alias("estimated_cost"),
        F.max("currency_code").alias("currency"),
    )


def estimated_cost_by_sku(usage: DataFrame, prices: DataFrame, days: int | None = 30, as_of=None,
                          bucket_days: int | None = None) -> DataFrame:
    """Q28: usage x price in force, per SKU, with the currency. With
    ``bucket_days`` the join is :func:`priced_by_time`."""
    some = recent(usage, days, as_of)
    found = priced(some, prices) if bucket_days is None else priced_by_time(some, prices, bucket_days)
    return (_cost_by(found, "sku_name")
            .orderBy(F.desc("estimated_cost"), "sku_name"))


def estimated_cost_by_job(usage: DataFrame, prices: DataFrame, days: int | None = 30, as_of=None) -> DataFrame:
    """Q31: Q28 per job, most expensive first."""
    return (_cost_by(priced(recent(usage, days, as_of), prices), "job_id")
            .orderBy(F.desc("estimated_cost"), "job_id"))


def my_usage_by_job(usage: DataFrame, user: str | None = None, days: int | None = 30,
                    as_of=None, k: int = 50) -> DataFrame:
    """Q29: one user's usage per day x job x warehouse, newest and largest
    first, top ``k`` (a top-k: TakeOrderedAndProject keeps k rows per
    partition, never the whole result). ``user`` defaults to the session
    user. Remaining keys break ties so the k rows are the same each run."""
    who = F.current_user() if user is None else F.lit(user)
    return (
        recent(usage, days, as_of)
        .filter(F.col("identity_metadata.run_as") == who)
        .groupBy(
            "usage_date",
            F.col("usage_metadata.job_id").alias("job_id"),
            F.col("usage_metadata.warehouse_id").alias("warehouse_id"),
        )
        .agg(rounded_sum("usage_quantity").alias("dbus"))
        .orderBy(F.desc("usage_date"), F.desc("dbus"), "job_id", "warehouse_id")
        .limit(k)
    )


def top_sku_recent(usage: DataFrame, days: int = 7, as_of=None, k: int = 1) -> DataFrame:
    """Q30: the SKU with the most usage in the last ``days`` days."""
    return (recent(usage, days, as_of).groupBy("sku_name")
            .agg(rounded_sum("usage_quantity").alias("dbus"))
            .orderBy(F.desc("dbus"), "sku_name")
            .limit(k))

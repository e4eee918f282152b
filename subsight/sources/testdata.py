"""Mapping of the driver's test tables onto the model.

The test tables are a TPC-H-like star schema; this module derives the four
bronze inputs and the two billing inputs from them, one row of the model per
row of the source (no row is filtered out):

* ``bronze_members``       <- customer (+ nation name as prefecture)
* ``bronze_articles``      <- part
* ``bronze_reading_logs``  <- lineitem (+ orders for the member)
* ``bronze_subscriptions`` <- orders
* ``usage``                <- lineitem
* ``list_prices``          <- usage, two price versions per SKU

The tables are regular where the model's rules are about exceptions, so the
mapping moves some values, by their keys, and leaves every row in: logs of
articles and members that do not exist, times that do not parse, members
without or with few events, hits without conversions and the other way
round, a price bound inside the last weeks, a SKU without a price
(:data:`EXCEPTIONS`).

Every derivation is a narrow projection except the two joins (lineitem x
orders on the order key; customer x nation, a 25-row dimension) and the
per-SKU aggregate of the price list. ``subsight.oracle`` holds the same
mapping in SQL for the DuckDB check; keep the two in step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subsight import model as M

TEST_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Given tables read as they are.
RAW_TABLES = ["events", "region", "documents", "pages", "benchmark", "labels", "conversations"]

# Anchor dates of the derived text dates.
REGISTRATION_ANCHOR = "2015-01-01"
PUBLISH_ANCHOR = "1994-01-01"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _date_text(date_col: Column) -> Column:
    return F.date_format(date_col, "yyyy-MM-dd")


def _days_after(anchor: str, days: Column) -> Column:
    return F.date_add(F.lit(anchor).cast("date"), days.cast("int"))


def bronze_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    # one name per nation key (TPC-H keys are unique, so nothing changes); a
    # key known to be distinct lets Catalyst drop the join wherever the
    # prefecture is not used, and keeps the members' size estimate that of
    # the customers instead of the product of both tables
    nation = (read(spark, sf_dir, "nation").groupBy("n_nationkey")
              .agg(F.min("n_name").alias("n_name")))
    key = F.col("c_custkey")
    segment = F.col("c_mktsegment")
    return (
        cust.join(nation, cust["c_nationkey"] == nation["n_nationkey"], "left")
        .select(
            key.alias("member_id"),
            F.col("c_name").alias("name"),
            (F.lit(18) + key % 53).cast("int").alias("age"),
            F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
            F.col("n_name").alias("prefecture"),
            F.lower(segment).alias("occupation"),
            F.when(segment == "FURNITURE", M.PLAN_PAID)
             .when(segment == "MACHINERY", M.PLAN_PREMIUM)
             .otherwise(M.PLAN_FREE).alias("plan_type"),
            # every 97th member has an empty date: exercises try_cast -> NULL
            F.when(key % 97 == 0, F.lit(""))
             .otherwise(_date_text(_days_after(REGISTRATION_ANCHOR, key % 3000)))
             .alias("registration_date"),
            F.concat(F.lit("member"), key.cast("string"), F.lit("@example.com")).alias("email"),
        )
    )


def bronze_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part")
    key = F.col("p_partkey")
    return part.select(
        key.alias("article_id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("category"),
        _date_text(_days_after(PUBLISH_ANCHOR, key % 2500)).alias("publish_date"),
        (F.col("p_size") % 2).cast("int").alias("is_premium"),
    )


# Which rows are exceptions: (divisor, remainder) of a key.
EXCEPTIONS = {
    "unknown_article": (53, 7),    # of the order: the log's article is not in the dimension
    "bad_time": (41, 3),           # of the order: empty event time
    "unknown_member": (37, 5),     # of the order: the log's member is not in the dimension, and never hits the paywall
    "idle_member": (11, 3),        # of the customer: all its logs go to the next customer
    "light_member": (11, 5),       # of the customer: all but about 1 of 16 do
    "regular_member": (11, 7),     # of the customer: all but about 1 of 3 do
    "bad_end": (101, 9),           # of the order: churned, but the end date does not parse
}
UNPRICED_SKU = "SKU_RO"
USERS = 4


def _is(name: str, key: Column) -> Column:
    divisor, remainder = EXCEPTIONS[name]
    return key % divisor == remainder


def _log_member(custkey: Column, orderkey: Column) -> Column:
    moved = (_is("idle_member", custkey)
             | (_is("light_member", custkey) & (orderkey % 16 != 0))
             | (_is("regular_member", custkey) & (orderkey % 3 != 0)))
    return F.when(_is("unknown_member", orderkey), -custkey).when(moved, custkey + 1).otherwise(custkey)


def log_id(orderkey: Column, linenumber: Column, partkey: Column, suppkey: Column, shipdate: Column) -> Column:
    """Surrogate key of a log row: the md5 of the natural key, all 128 bits,
    as text. Computed per row (no global numbering, no single partition); the
    natural key is unique on the test tables while (order, line) alone is
    not."""
    natural = F.concat_ws(
        "|", orderkey.cast("string"), linenumber.cast("string"), partkey.cast("string"),
        suppkey.cast("string"), _date_text(shipdate),
    )
    return F.md5(natural)


def bronze_reading_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_returnflag", "l_linestatus", "l_shipdate")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    flag, status, line = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_linenumber")
    order = F.col("l_orderkey")
    event_type = (
        F.when((flag == "R") & (status == "F") & ~_is("unknown_member", order), M.PAYWALL_HIT)
         .when((flag == "R") & (line == 1), M.SUBSCRIBE)
         .when(status == "F", M.READ_COMPLETE)
         .otherwise(M.READ_START)
    )
    minutes = (line * 137 + F.col("l_orderkey") % 60).cast("int")
    event_time = F.when(_is("bad_time", order), F.lit("")).otherwise(
        F.date_format(F.timestamp_add("MINUTE", minutes, F.col("l_shipdate")), "yyyy-MM-dd HH:mm:ss"))
    return (
        li.join(orders, li["l_orderkey"] == orders["o_orderkey"], "inner")
        .select(
            log_id(F.col("l_orderkey"), line, F.col("l_partkey"), F.col("l_suppkey"),
                   F.col("l_shipdate")).alias("log_id"),
            _log_member(F.col("o_custkey"), order).alias("member_id"),
            F.when(_is("unknown_article", order), -F.col("l_partkey")).otherwise(F.col("l_partkey")).alias("article_id"),
            event_type.alias("event_type"),
            event_time.alias("event_time"),
            F.when(line % 2 == 0, "app").otherwise("web").alias("device"),
            (F.col("l_quantity").cast("int") * 10).alias("reading_seconds"),
            ((line * 13 + F.col("l_partkey")) % 101).cast("int").alias("scroll_depth"),
        )
    )


def bronze_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                                  "o_orderdate", "o_orderpriority")
    key = F.col("o_orderkey")
    start = F.col("o_orderdate").cast("date")
    churned = F.col("o_orderstatus") == "F"
    return orders.select(
        key.alias("subscription_id"),
        F.col("o_custkey").alias("member_id"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), M.PLAN_PREMIUM)
         .otherwise(M.PLAN_PAID).alias("plan_type"),
        _date_text(start).alias("start_date"),
        F.when(churned & ~_is("bad_end", key), _date_text(F.date_add(start, (F.lit(30) + key % 571).cast("int"))))
         .otherwise(F.lit("")).alias("end_date"),
        F.when(churned, M.STATUS_CHURNED).otherwise(M.STATUS_ACTIVE).alias("status"),
    )


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus",
        "l_shipdate")
    line = F.col("l_linenumber")
    return li.select(
        F.col("l_shipdate").cast("date").alias("usage_date"),
        F.timestamp_add("HOUR", line, F.col("l_shipdate")).cast("timestamp").alias("usage_end_time"),
        F.concat(F.lit("SKU_"), F.col("l_returnflag"), F.col("l_linestatus")).alias("sku_name"),
        F.col("l_quantity").cast(M.MONEY).alias("usage_quantity"),
        F.struct(
            (F.col("l_partkey") % 20).cast("string").alias("job_id"),
            line.cast("string").alias("warehouse_id"),
        ).alias("usage_metadata"),
        F.struct(
            F.concat(F.lit("user"), (F.col("l_suppkey") % USERS).cast("string"), F.lit("@example.com")).alias("run_as"),
        ).alias("identity_metadata"),
    )


def list_prices(usage_df: DataFrame) -> DataFrame:
    """Three price versions per SKU seen in the usage, but for one SKU that
    has no price: from the first usage day to the middle day (exclusive),
    from there to ten days before the last, and from there with an open
    end. One row per SKU leaves the aggregate, so the result is as small as
    the SKU catalogue."""
    per_sku = usage_df.where(F.col("sku_name") != UNPRICED_SKU).groupBy("sku_name").agg(
        F.min("usage_date").alias("lo"), F.max("usage_date").alias("hi"))
    split = F.date_add("lo", F.floor(F.datediff("hi", "lo") / 2).cast("int"))
    cents = (F.lit(10) + F.ascii(F.substring("sku_name", 5, 1)) % 7
             + F.ascii(F.substring("sku_name", 6, 1)) % 3)
    first = (cents.cast(M.MONEY) / 100).cast(M.MONEY)
    second = (first * F.lit(1.25).cast(M.MONEY)).cast(M.MONEY)
    third = (first * F.lit(1.5).cast(M.MONEY)).cast(M.MONEY)
    late = F.date_sub("hi", 10)

    def version(start: Column, end: Column, price: Column) -> Column:
        return F.struct(
            start.cast("timestamp").alias("price_start_time"),
            end.cast("timestamp").alias("price_end_time"),
            price.alias("price"),
        )

    versions = per_sku.select(
        "sku_name",
        F.inline(F.array(version(F.col("lo"), split, first),
                         version(split, late, second),
                         version(late, F.lit(None).cast("date"), third))),
    )
    return versions.select(
        "sku_name",
        F.lit("USD").alias("currency_code"),
        "price_start_time",
        "price_end_time",
        F.struct(F.struct(F.col("price").alias("default")).alias("effective_list")).alias("pricing"),
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict:
    """Loaders of the given tables that the model uses as they are."""
    return {t: (lambda t=t: read(spark, sf_dir, t)) for t in RAW_TABLES}


def sources(spark: SparkSession, sf_dir: str) -> dict:
    """Loaders of the model's input tables, keyed by model name."""
    return {
        "bronze_members": lambda: bronze_members(spark, sf_dir),
        "bronze_articles": lambda: bronze_articles(spark, sf_dir),
        "bronze_reading_logs": lambda: bronze_reading_logs(spark, sf_dir),
        "bronze_subscriptions": lambda: bronze_subscriptions(spark, sf_dir),
        "usage": lambda: usage(spark, sf_dir),
        "list_prices": lambda: list_prices(usage(spark, sf_dir)),
        # given tables used as they are (event log; profile inputs)
        **raw_tables(spark, sf_dir),
    }

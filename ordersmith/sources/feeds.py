"""The two raw order feeds, derived from the driver's TPC-H-style tables.

Both feeds read their tables whole: the marketplace feed is every line item
(joined to its order and customer), the storefront feed is every order.

The reference pipeline reads a marketplace report feed and a storefront
order feed.  Test data ships as ``lineitem``/``orders``/``customer``, so this
adapter re-expresses those tables as the two feeds, with the dirt the
pipeline must handle (padding, blanks, synonyms, repeats, NULLs, negative
totals, undated files).  Everything is a join plus one projection; the
storefront's second order versions come from ``explode``, not a self-union,
so each input table is scanned once.

Source dates are shifted by ``SHIFT_DAYS`` so that they straddle the 2010
"too old" line and the ``as_of`` date used by the queries.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schema import MARKETPLACE_RAW, STOREFRONT_RAW, conform

# Date shift of the source tables and the as-of date the
# registered queries use.
SHIFT_DAYS = 3652
AS_OF = _dt.date(2011, 1, 1)


def _shift(ts: Column, days: int = SHIFT_DAYS) -> Column:
    return ts.cast("timestamp") + F.expr(f"INTERVAL {days} DAYS")


def _ship_country(nation: Column) -> Column:
    code = F.concat(F.char(F.lit(97) + nation), F.lit("x"))
    return (F.when(nation % 5 == 4, F.lit(None).cast("string"))
            .when(nation % 7 == 6, F.lit("DEU"))
            .otherwise(code))


def marketplace_feed(lineitem: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    """One report row per line item, every line of every order (an order
    repeats across its lines, as an order repeats across reports)."""
    li = lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_shipdate")
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    c = customer.select("c_custkey", "c_nationkey")
    # orders meet their customers first: fewer rows are dealt out by customer than lines would be
    o = o.join(c, o["o_custkey"] == c["c_custkey"], "left")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "left")

    key = F.col("l_orderkey")
    ingested = _shift(F.col("l_shipdate"), SHIFT_DAYS + 1)
    file_day = F.date_add(F.to_date(ingested), F.when(key % 19 == 0, 1).otherwise(0))
    flag = F.col("l_returnflag")
    nation = F.col("c_nationkey")
    price = F.col("l_extendedprice")
    out = j.select(
        F.when(key % 43 == 7, F.lit(None).cast("timestamp")).otherwise(ingested).alias("ingested_at"),
        F.when(key % 29 == 0, F.lit("reports/undated.tsv"))
         .when(key % 23 == 0, F.lit(""))
         .otherwise(F.concat(F.lit("reports/"), file_day.cast("string"), F.lit(".tsv")))
         .alias("source_file"),
        F.to_date(_shift(F.col("l_shipdate"))).alias("report_date"),
        F.when(key % 101 == 0, F.lit("")).otherwise(F.concat(F.lit(" A-"), key.cast("string")))
         .alias("amazon_order_id"),
        F.when(key % 47 == 5, F.lit(None).cast("timestamp")).otherwise(_shift(F.col("o_orderdate")))
         .alias("purchase_date"),
        F.when(key % 7 == 0, F.lit(None).cast("timestamp")).otherwise(_shift(F.col("l_shipdate")))
         .alias("last_updated_date"),
        F.when(key % 41 == 2, F.lit(None).cast("string"))
         .when(key % 41 == 3, F.lit("\t"))
         .when(key % 41 == 4, F.lit("Mystery"))
         .when(key % 41 == 5, F.lit("\tComplete"))
         .when(key % 41 == 6, F.lit("unShipped\u00a0"))
         .when(key % 41 == 7, F.lit("\u3000REFUNDED"))
         .when(flag == "R", F.lit("Returned"))
         .when(flag == "A", F.lit(" canceled"))
         .when(flag.isin("N", "O"), F.lit("Shipped "))
         .otherwise(F.lit("pending")).alias("order_status"),
        F.when(key % 31 == 2, F.lit(None).cast("string"))
         .when(key % 31 == 3, F.lit("\t "))
         .when(F.col("l_linenumber") % 3 == 0, F.lit("afn"))
         .when(F.col("l_linenumber") % 3 == 1, F.lit("MFN"))
         .otherwise(F.lit("fbx")).alias("fulfillment_channel"),
        F.when(key % 59 == 0, F.lit(None).cast("double"))
         .when(key % 53 == 0, -price).otherwise(price).alias("order_total"),
        F.when(key % 37 == 3, F.lit(None).cast("string")).when(key % 37 == 4, F.lit("  "))
         .when(nation % 4 == 0, F.lit("EUR")).when(nation % 4 == 1, F.lit(" usd "))
         .when(nation % 4 == 2, F.lit("CHF")).otherwise(F.lit("EU1")).alias("currency"),
        _ship_country(nation).alias("ship_country"),
        F.when(key % 31 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("c"), F.col("o_custkey").cast("string"))).alias("buyer_id"),
    )
    return conform(out, MARKETPLACE_RAW)


def storefront_feed(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """One row per order, plus a later ``refunded`` version (processed three
    days after creation) for keys divisible by 11.  The storefront's ids
    (``S-<key>``) never meet the marketplace's (``A-<key>``)."""
    o = orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = customer.select("c_custkey", "c_nationkey")
    key = F.col("o_orderkey")
    j = (o.join(c, o["o_custkey"] == c["c_custkey"], "left")
          .withColumn("version", F.explode(
              F.when(key % 11 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))))

    v2 = F.col("version") == 2
    created = _shift(F.col("o_orderdate"))
    status = F.col("o_orderstatus")
    prio = F.col("o_orderpriority")
    nation = F.col("c_nationkey")
    cust = F.col("o_custkey")
    total = (F.when(key % 61 == 1, F.lit(None).cast("double"))
              .when(key % 67 == 1, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")))
    out = j.select(
        F.when(key % 103 == 1, F.lit("")).otherwise(F.concat(F.lit("S-"), key.cast("string"), F.lit(" ")))
         .alias("id"),
        F.when(key % 43 == 2, F.lit(None).cast("timestamp")).otherwise(created).alias("created_at"),
        F.when(v2, created + F.expr("INTERVAL 3 DAYS"))
         .when(status == "P", F.lit(None).cast("timestamp"))
         .otherwise(created + F.expr("INTERVAL 2 HOURS")).alias("processed_at"),
        F.when(v2, F.lit("refunded")).when(status == "F", F.lit("paid"))
         .when(status == "O", F.lit(" Pending")).otherwise(F.lit("refunded")).alias("financial_status"),
        F.when(prio == "5-LOW", F.lit(None).cast("string")).when(prio == "1-URGENT", F.lit("cancelled"))
         .otherwise(F.lit("fulfilled ")).alias("fulfillment_status"),
        F.when(key % 29 == 3, F.lit(None).cast("string")).when(key % 29 == 4, F.lit("\t"))
         .when(key % 29 == 5, F.lit("E1R")).when(key % 29 == 6, F.lit("\tusd\u00a0"))
         .when(key % 3 == 0, F.lit("eur")).when(key % 3 == 1, F.lit("USD"))
         .otherwise(F.lit("CHF ")).alias("currency"),
        total.alias("total_price"),
        (total * 0.8).alias("subtotal_price"),
        (total * 0.05).alias("total_discounts"),
        F.when(key % 13 == 1, F.lit(None).cast("double")).otherwise(total * 0.15).alias("total_tax"),
        F.coalesce(F.concat(F.lit(" "), _ship_country(nation), F.lit(" ")), F.lit("")).alias("shipping_country"),
        F.when(key % 37 == 1, F.lit("")).otherwise(F.concat(F.lit("c"), cust.cast("string"))).alias("customer_id"),
        F.when(cust % 4 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("u"), cust.cast("string"), F.lit("@shop.test"))).alias("email"),
        F.when(key % 17 == 1, F.lit("vip")).otherwise(F.lit(None).cast("string")).alias("tags"),
        (key % 41 == 1).alias("test"),
    )
    return conform(out, STOREFRONT_RAW)


def load_tables(spark: SparkSession, sf_dir: str, names=("lineitem", "orders", "customer")) -> dict:
    """The tables as they are scanned: nothing is repartitioned by size."""
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def feeds_from_dir(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(marketplace raw feed, storefront raw feed) for a test-data directory."""
    t = load_tables(spark, sf_dir)
    return (marketplace_feed(t["lineitem"], t["orders"], t["customer"]),
            storefront_feed(t["orders"], t["customer"]))

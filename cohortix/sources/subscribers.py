"""The subscriber table derived from the warehouse tables customer, orders and lineitem."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix import schema as S

AS_OF = "1996-07-01"
LABEL_DAYS = 365
COPY_OFFSET = 100_000_000

# The columns read, by table; a given schema spares the scan of file footers.
READ = {
    "customer": "c_custkey long, c_acctbal double",
    "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_quantity double, l_shipdate timestamp_ntz",
}


def subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer as of ``AS_OF``, with outliers, gaps and copied rows."""
    as_of = F.to_date(F.lit(AS_OF))
    customer, orders, lines = (
        spark.read.schema(columns).parquet(f"{sf_dir}/{name}.parquet") for name, columns in READ.items())

    earlier = F.col("o_orderdate") < as_of
    ahead = (F.col("o_orderdate") >= as_of) & (F.col("o_orderdate") < F.date_add(as_of, LABEL_DAYS))
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    history = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min(F.when(earlier, F.col("o_orderdate"))).alias("first_order"),
        F.max((earlier & urgent).cast("int")).alias("urgent_before"),
        F.max(ahead.cast("int")).alias("ordered_after"),
    )
    usage = (
        orders.where(earlier).select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("c_custkey")
        .agg(F.sum("l_quantity").alias("quantity"),
             F.countDistinct(F.to_date("l_shipdate")).alias("ship_days"))
    )
    key = F.col("c_custkey")
    factor = F.when(key % 331 == 7, F.lit(40.0)).otherwise(F.lit(1.0))
    ids = F.when(key % 200 == 0, F.array(key, key + COPY_OFFSET)).otherwise(F.array(key))
    return (
        customer.join(history, "c_custkey", "left").join(usage, "c_custkey", "left")
        .select(
            F.explode(ids).alias(S.ID),
            (F.col("quantity") / 10.0 * factor).alias(S.USAGE),
            F.col("c_acctbal").alias(S.REVENUE),
            F.coalesce(F.col("ship_days"), F.lit(0)).cast("double").alias(S.DOU),
            F.coalesce(F.col("urgent_before"), F.lit(0)).alias(S.PACK),
            F.datediff(as_of, F.to_date("first_order")).alias(S.TENURE),
            (1 - F.coalesce(F.col("ordered_after"), F.lit(0))).alias(S.CHURN),
        )
    )

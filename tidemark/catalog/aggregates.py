"""Aggregates, windows, ordering and limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.registry import query, rounded
from tidemark.functions.measures import count_where, flag, mean_where, percent
from tidemark.operators.groups import running_total, with_group_totals
from tidemark.operators.ranking import global_rank, top_k, top_k_per_group
from tidemark.plans.retail import MONEY
from tidemark.sources.tables import read_table

C = F.col


def _year(column: str):
    return F.year(column).cast("bigint")


def _rows():
    return F.count(F.lit(1))


@query("A1", f"""
    SELECT l_returnflag, l_linestatus, sum(l_quantity)::BIGINT AS quantity,
           sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS price, count(*) AS n, min(l_shipdate)::DATE AS first_ship,
           max(l_shipdate)::DATE AS last_ship, {rounded("avg(l_quantity)", 2)} AS mean_quantity
    FROM lineitem GROUP BY 1, 2""")
def grouped_totals(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").cast("bigint").alias("quantity"),
        F.sum(C("l_extendedprice").cast(MONEY)).alias("price"), _rows().alias("n"),
        F.min("l_shipdate").cast("date").alias("first_ship"), F.max("l_shipdate").cast("date").alias("last_ship"),
        F.round(F.avg("l_quantity"), 2).alias("mean_quantity"))


@query("A2", """
    SELECT l_suppkey, sum(l_extendedprice::DECIMAL(18,2)) FILTER (l_linestatus = 'O')::DOUBLE AS open_price,
           ifnull(sum(l_extendedprice::DECIMAL(18,2)) FILTER (l_linestatus = 'F'), 0)::DOUBLE AS final_price
    FROM lineitem GROUP BY 1""")
def conditional_sums(spark: SparkSession, folder: str) -> DataFrame:
    price = C("l_extendedprice").cast(MONEY)
    return read_table(spark, folder, "lineitem").groupBy("l_suppkey").agg(
        F.sum(F.when(C("l_linestatus") == "O", price)).alias("open_price"),
        F.sum(F.when(C("l_linestatus") == "F", price).otherwise(F.lit(0))).alias("final_price"))


@query("A3", """
    SELECT l_orderkey, bool_or(l_returnflag = 'R')::BIGINT AS any_returned, bool_or(l_quantity = 50)::BIGINT AS any_full
    FROM lineitem GROUP BY 1""")
def any_flags(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.max(flag(C("l_returnflag") == "R")).alias("any_returned"),
        F.max(flag(C("l_quantity") == 50)).alias("any_full"))


@query("A4", """
    SELECT l_suppkey, count(DISTINCT l_orderkey) FILTER (l_returnflag = 'R') AS orders_returned,
           count(DISTINCT l_orderkey) FILTER (l_linestatus = 'O') AS orders_open,
           count(DISTINCT l_orderkey) FILTER (l_quantity > 40) AS orders_large
    FROM lineitem GROUP BY 1""")
def distinct_conditional_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Several COUNT(DISTINCT CASE) at once: fold per order, then add flags; no row is expanded."""
    per_order = read_table(spark, folder, "lineitem").groupBy("l_suppkey", "l_orderkey").agg(
        F.max(flag(C("l_returnflag") == "R")).alias("r"), F.max(flag(C("l_linestatus") == "O")).alias("o"),
        F.max(flag(C("l_quantity") > 40)).alias("q"))
    return per_order.groupBy("l_suppkey").agg(
        F.sum("r").alias("orders_returned"), F.sum("o").alias("orders_open"), F.sum("q").alias("orders_large"))


@query("A5", """
    SELECT s_nationkey::BIGINT AS nation, count(*) AS cars, sum(won::BIGINT)::BIGINT AS wins,
           count(DISTINCT l_orderkey) AS orders_served
    FROM (SELECT s_nationkey, l_orderkey, l_linenumber, bool_or(l_quantity > 45) AS won
          FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2, 3) GROUP BY 1""")
def shared_entity_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Two levels: a (nation, order, line number) shared by several rows counts once."""
    lines = read_table(spark, folder, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity")
    suppliers = read_table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    cars = lines.join(suppliers, C("l_suppkey") == C("s_suppkey")).groupBy(
        "s_nationkey", "l_orderkey", "l_linenumber").agg(F.max(flag(C("l_quantity") > 45)).alias("won"))
    per_order = cars.groupBy("s_nationkey", "l_orderkey").agg(_rows().alias("cars"), F.sum("won").alias("wins"))
    return per_order.groupBy(C("s_nationkey").alias("nation")).agg(
        F.sum("cars").alias("cars"), F.sum("wins").alias("wins"), _rows().alias("orders_served"))


@query("A6", f"""
    SELECT event_type, count(*) FILTER (value > 10) AS large,
           {rounded("avg(floor(value)) FILTER (value > 10)", 2)} AS mean_large
    FROM events GROUP BY 1""")
def filtered_aggregates(spark: SparkSession, folder: str) -> DataFrame:
    large = C("value") > 10
    return read_table(spark, folder, "events").groupBy("event_type").agg(
        count_where(large).alias("large"), mean_where(F.floor("value"), large, 2).alias("mean_large"))


@query("A8", "SELECT l_returnflag, l_linestatus, l_linenumber::BIGINT AS line, count(*) AS n FROM lineitem GROUP BY ALL")
def group_by_all(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql("""
        SELECT l_returnflag, l_linestatus, l_linenumber AS line, count(*) AS n FROM {lines} GROUP BY ALL""",
        lines=read_table(spark, folder, "lineitem"))


@query("A9", "SELECT l_orderkey, l_linenumber::BIGINT AS line, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING n > 1")
def having_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "lineitem").groupBy("l_orderkey", C("l_linenumber").alias("line")).agg(
        _rows().alias("n")).filter("n > 1")


@query("A10", """
    SELECT l_suppkey, median(l_quantity - l_linenumber) FILTER (l_returnflag <> 'R') AS median_gain,
           median(l_quantity) AS median_quantity
    FROM lineitem GROUP BY 1""")
def exact_medians(spark: SparkSession, folder: str) -> DataFrame:
    """Exact: map tasks merge value counts, not values."""
    gain = C("l_quantity") - C("l_linenumber")
    return read_table(spark, folder, "lineitem").groupBy("l_suppkey").agg(
        F.median(F.when(C("l_returnflag") != "R", gain)).alias("median_gain"),
        F.median("l_quantity").alias("median_quantity"))


@query("A11", """
    SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS priorities
    FROM orders GROUP BY 1""")
def ordered_string_list(spark: SparkSession, folder: str) -> DataFrame:
    # Distinct values first, so a list never exceeds the number of priorities.
    values = read_table(spark, folder, "orders").select("o_custkey", "o_orderpriority").distinct()
    return spark.sql("""
        SELECT o_custkey, string_agg(o_orderpriority, ', ') WITHIN GROUP (ORDER BY o_orderpriority) AS priorities
        FROM {values} GROUP BY o_custkey""", values=values)


@query("A12", """
    SELECT o_orderpriority, o_orderstatus, (SELECT count(DISTINCT o_custkey) FROM orders) AS customers
    FROM orders GROUP BY 1, 2""")
def distinct_rows(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    customers = orders.agg(F.count_distinct("o_custkey")).scalar()
    return orders.select("o_orderpriority", "o_orderstatus").distinct().withColumn("customers", customers)


@query("A13", """
    SELECT count(*) AS n, count(DISTINCT l_orderkey) AS orders_with_lines,
           sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS price, max(l_quantity) AS largest FROM lineitem""")
def global_totals(spark: SparkSession, folder: str) -> DataFrame:
    per_order = read_table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        _rows().alias("n"), F.sum(C("l_extendedprice").cast(MONEY)).alias("price"), F.max("l_quantity").alias("q"))
    return per_order.agg(F.sum("n").alias("n"), _rows().alias("orders_with_lines"), F.sum("price").alias("price"),
                         F.max("q").alias("largest"))


@query("A14", """
    SELECT l_orderkey, max(l_suppkey) FILTER (l_linenumber = 1) AS first_supplier,
           max(l_quantity) FILTER (l_linenumber = 1) AS first_quantity FROM lineitem GROUP BY 1""")
def argmax_by_case(spark: SparkSession, folder: str) -> DataFrame:
    first = C("l_linenumber") == 1
    return read_table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.max(F.when(first, C("l_suppkey"))).alias("first_supplier"),
        F.max(F.when(first, C("l_quantity"))).alias("first_quantity"))


@query("W1", """
    SELECT c_custkey, row_number() OVER (ORDER BY spent DESC, placed DESC, c_custkey) AS spent_rank,
           row_number() OVER (ORDER BY placed DESC, spent DESC, c_custkey) AS placed_rank
    FROM (SELECT o_custkey AS c_custkey, sum(o_totalprice::DECIMAL(18,2)) AS spent, count(*) AS placed
          FROM orders GROUP BY 1)""")
def global_ranks(spark: SparkSession, folder: str) -> DataFrame:
    totals = read_table(spark, folder, "orders").groupBy(C("o_custkey").alias("c_custkey")).agg(
        F.sum(C("o_totalprice").cast(MONEY)).alias("spent"), _rows().alias("placed"))
    ranked = global_rank(totals, "spent_rank", [C("spent").desc(), C("placed").desc(), C("c_custkey")])
    ranked = global_rank(ranked, "placed_rank", [C("placed").desc(), C("spent").desc(), C("c_custkey")])
    return ranked.select("c_custkey", "spent_rank", "placed_rank")


@query("W2", """
    SELECT p_partkey, p_name || CASE WHEN count(*) OVER (PARTITION BY p_name) > 1 THEN ' / ' || upper(p_brand) ELSE '' END
           AS label FROM part""")
def disambiguated_labels(spark: SparkSession, folder: str) -> DataFrame:
    counted = with_group_totals(read_table(spark, folder, "part").select("p_partkey", "p_name", "p_brand"), ["p_name"],
                                _rows().alias("_n"))
    label = F.when(C("_n") > 1, F.concat("p_name", F.lit(" / "), F.upper("p_brand"))).otherwise(C("p_name"))
    return counted.select("p_partkey", label.alias("label"))


@query("W3", f"""
    SELECT *, {rounded("100.0 * price / sum(price) OVER (PARTITION BY season)", 1)} AS share
    FROM (SELECT year(l_shipdate)::BIGINT AS season, l_suppkey, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS price
          FROM lineitem GROUP BY 1, 2)""")
def share_of_total(spark: SparkSession, folder: str) -> DataFrame:
    sums = read_table(spark, folder, "lineitem").groupBy(_year("l_shipdate").alias("season"), "l_suppkey").agg(
        F.sum(C("l_extendedprice").cast(MONEY)).alias("price"))
    totals = with_group_totals(sums, ["season"], F.sum("price").alias("_total"), store="shares")
    return totals.select("season", "l_suppkey", "price", percent(C("price"), C("_total")).alias("share"))


@query("W4", """
    SELECT year(o_orderdate)::BIGINT AS season, month(o_orderdate)::BIGINT AS month, count(*) AS n,
           max(max(month(o_orderdate))) OVER (PARTITION BY year(o_orderdate))::BIGINT AS last_month
    FROM orders GROUP BY year(o_orderdate), month(o_orderdate)""")
def group_maximum(spark: SparkSession, folder: str) -> DataFrame:
    months = read_table(spark, folder, "orders").groupBy(
        _year("o_orderdate").alias("season"), F.month("o_orderdate").cast("bigint").alias("month")).agg(_rows().alias("n"))
    return with_group_totals(months, ["season"], F.max("month").alias("last_month"), store="months").select(
        "season", "month", "n", "last_month")


def _monthly(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "orders").groupBy(
        "o_custkey", _year("o_orderdate").alias("season"), F.month("o_orderdate").cast("bigint").alias("month")).agg(
        F.sum(C("o_totalprice").cast(MONEY)).alias("amount"))


_MONTHLY = """(SELECT o_custkey, year(o_orderdate)::BIGINT AS season, month(o_orderdate)::BIGINT AS month,
                      sum(o_totalprice::DECIMAL(18,2)) AS amount FROM orders GROUP BY 1, 2, 3)"""


@query("W5", f"""
    SELECT o_custkey, season, month, amount::DOUBLE AS amount,
           sum(amount) OVER (PARTITION BY o_custkey, season ORDER BY month
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::DOUBLE AS running
    FROM {_MONTHLY}""")
def running_totals(spark: SparkSession, folder: str) -> DataFrame:
    # A customer's season has at most twelve rows here.
    return running_total(_monthly(spark, folder), ["o_custkey", "season"], ["month"], "amount", "running")


@query("W7", f"""
    SELECT o_custkey, season, month, (max(amount) OVER (PARTITION BY season, month) - amount)::DOUBLE AS gap
    FROM {_MONTHLY}""")
def gap_to_leader(spark: SparkSession, folder: str) -> DataFrame:
    led = with_group_totals(_monthly(spark, folder), ["season", "month"], F.max("amount").alias("_lead"),
                            store="monthly")
    return led.select("o_custkey", "season", "month", (C("_lead") - C("amount")).alias("gap"))


@query("O2", """
    SELECT l_orderkey, l_partkey, nullif(l_linenumber, 7)::BIGINT AS position FROM lineitem
    ORDER BY position NULLS LAST, l_orderkey, l_partkey""")
def nulls_last_order(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", F.nullif(C("l_linenumber"), F.lit(7)).alias("position"))
    return lines.orderBy(C("position").asc_nulls_last(), C("l_orderkey"), C("l_partkey"))


@query("O3 O5", """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def top_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return top_k(orders, 10, [C("o_totalprice").desc(), C("o_orderkey")])


@query("O5", """
    SELECT o_orderpriority, o_orderkey, rank
    FROM (SELECT o_orderpriority, o_orderkey,
                 row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders)
    WHERE rank <= 10""")
def top_orders_per_priority(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return top_k_per_group(orders, ["o_orderpriority"], 10, [C("o_totalprice").desc(), C("o_orderkey")]).select(
        "o_orderpriority", "o_orderkey", "rank")


@query("O4", """
    SELECT 'negative balance' AS probe, EXISTS (SELECT 1 FROM customer WHERE c_acctbal < 0) AS found
    UNION ALL SELECT 'free order', EXISTS (SELECT 1 FROM orders WHERE o_totalprice <= 0)""")
def existence_probes(spark: SparkSession, folder: str) -> DataFrame:
    """Each probe stops at its first row."""
    def probe(name: str, table: str, condition: str) -> DataFrame:
        hit = read_table(spark, folder, table).filter(condition).limit(1)
        return hit.agg((_rows() > 0).alias("found")).select(F.lit(name).alias("probe"), "found")

    return probe("negative balance", "customer", "c_acctbal < 0").unionByName(
        probe("free order", "orders", "o_totalprice <= 0"))

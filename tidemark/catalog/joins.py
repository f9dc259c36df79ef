"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.registry import query
from tidemark.functions.measures import zero_fill
from tidemark.operators import parity, quality
from tidemark.operators.groups import dense_running_total
from tidemark.operators.pairs import member_pairs
from tidemark.plans.retail import MONEY
from tidemark.sources.tables import read_table

C = F.col


def _year(column: str):
    return F.year(column).cast("bigint")


@query("J1", """
    SELECT p_type, count(*) AS n, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS price
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def fact_to_dimension(spark: SparkSession, folder: str) -> DataFrame:
    # Folded per part before the join: the dimension meets one row per key.
    per_part = read_table(spark, folder, "lineitem").groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(C("l_extendedprice").cast(MONEY)).alias("price"))
    joined = per_part.join(read_table(spark, folder, "part"), C("l_partkey") == C("p_partkey"))
    return joined.groupBy("p_type").agg(F.sum("n").alias("n"), F.sum("price").alias("price"))


@query("J2", """
    SELECT season, customer, declared::DOUBLE AS declared, shipped::DOUBLE AS shipped
    FROM (SELECT year(o_orderdate)::BIGINT AS season, o_custkey AS customer, sum(o_totalprice::DECIMAL(18,2)) AS declared
          FROM orders GROUP BY 1, 2)
    JOIN (SELECT year(o_orderdate)::BIGINT AS season, o_custkey AS customer, sum(l_extendedprice::DECIMAL(18,2)) AS shipped
          FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2) USING (season, customer)""")
def composite_key_join(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    keys = [_year("o_orderdate").alias("season"), C("o_custkey").alias("customer")]
    declared = orders.groupBy(*keys).agg(F.sum(C("o_totalprice").cast(MONEY)).alias("declared"))
    # Lines are folded per order first, so the join with orders moves one row per order.
    per_order = read_table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.sum(C("l_extendedprice").cast(MONEY)).alias("price"))
    shipped = per_order.join(orders, C("l_orderkey") == C("o_orderkey")).groupBy(*keys).agg(
        F.sum("price").alias("shipped"))
    return declared.join(shipped, ["season", "customer"]).select("season", "customer", "declared", "shipped")


@query("J3", """
    SELECT o_orderstatus, count(*) AS orders_placed, count(l_orderkey) AS with_lines,
           sum(ifnull(n, 0))::BIGINT AS line_count, sum(ifnull(price, 0))::DOUBLE AS price
    FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, sum(l_extendedprice::DECIMAL(18,2)) AS price
                           FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
    GROUP BY 1""")
def left_join_zero_fill(spark: SparkSession, folder: str) -> DataFrame:
    per_order = read_table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(C("l_extendedprice").cast(MONEY)).alias("price"))
    joined = read_table(spark, folder, "orders").join(per_order, C("o_orderkey") == C("l_orderkey"), "left")
    return joined.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders_placed"), F.count("l_orderkey").alias("with_lines"),
        F.sum(zero_fill(C("n"))).alias("line_count"), F.sum(zero_fill(C("price"))).alias("price"))


@query("J4", """
    SELECT 'no lines' AS kind, o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    UNION ALL
    SELECT 'none shipped after a month', o_orderkey FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                             WHERE l_shipdate::DATE > o_orderdate::DATE + 30)""")
def anti_joins(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select("o_orderkey", C("o_orderdate").cast("date").alias("ordered"))
    # The latest shipment decides the residual predicate, so one row per order is enough.
    last = read_table(spark, folder, "lineitem").groupBy(C("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_shipdate").cast("date").alias("shipped"))
    no_lines = orders.join(last, "o_orderkey", "left_anti")
    late = (orders["o_orderkey"] == last["o_orderkey"]) & (last["shipped"] > F.date_add(orders["ordered"], 30))
    not_late = orders.join(last, late, "left_anti")
    return no_lines.select(F.lit("no lines").alias("kind"), "o_orderkey").unionByName(
        not_late.select(F.lit("none shipped after a month").alias("kind"), "o_orderkey"))


@query("J5", """
    SELECT o_orderkey, o_custkey FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE l_orderkey IS NULL""")
def left_join_is_null(spark: SparkSession, folder: str) -> DataFrame:
    # One row per order, so that no line is joined only to be dropped.
    lines = read_table(spark, folder, "lineitem").select("l_orderkey").distinct()
    joined = read_table(spark, folder, "orders").join(lines, C("o_orderkey") == C("l_orderkey"), "left")
    return joined.filter(C("l_orderkey").isNull()).select("o_orderkey", "o_custkey")


@query("J6", """
    SELECT season, customer, status, amount::DOUBLE AS amount
    FROM (SELECT year(o_orderdate)::BIGINT AS season, o_custkey AS customer, o_orderstatus AS status,
                 sum(o_totalprice::DECIMAL(18,2)) AS amount FROM orders GROUP BY 1, 2, 3)
    QUALIFY status = 'F' OR NOT bool_or(status = 'F') OVER (PARTITION BY season, customer)""")
def not_exists_under_or(spark: SparkSession, folder: str) -> DataFrame:
    entries = read_table(spark, folder, "orders").groupBy(
        _year("o_orderdate").alias("season"), C("o_custkey").alias("customer"), C("o_orderstatus").alias("status")).agg(
        F.sum(C("o_totalprice").cast(MONEY)).alias("amount"))
    return spark.sql("""
        SELECT season, customer, status, amount FROM {entries} e
        WHERE status = 'F' OR NOT EXISTS (
            SELECT 1 FROM {entries} f WHERE f.status = 'F' AND f.season = e.season AND f.customer = e.customer)""",
        entries=entries)


@query("J7", """
    WITH s AS (SELECT l_orderkey, s_nationkey, l_suppkey, l_linenumber FROM lineitem JOIN supplier ON s_suppkey = l_suppkey)
    SELECT a.s_nationkey::BIGINT AS nation, a.l_suppkey AS supplier_a, b.l_suppkey AS supplier_b, count(*) AS pairs,
           count(*) FILTER (a.l_linenumber < b.l_linenumber) AS a_first,
           count(*) FILTER (b.l_linenumber < a.l_linenumber) AS b_first
    FROM s a, s b
    WHERE a.l_orderkey = b.l_orderkey AND a.s_nationkey = b.s_nationkey AND b.l_suppkey > a.l_suppkey
    GROUP BY 1, 2, 3""")
def supplier_pairs(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber")
    named = lines.join(read_table(spark, folder, "supplier").select("s_suppkey", "s_nationkey"),
                       C("l_suppkey") == C("s_suppkey"))
    pairs = member_pairs(named, ["l_orderkey", "s_nationkey"], "l_suppkey", ["l_linenumber"])
    a, b = C("l_linenumber_a"), C("l_linenumber_b")
    return pairs.groupBy(C("s_nationkey").alias("nation"), C("member_a").alias("supplier_a"),
                         C("member_b").alias("supplier_b")).agg(
        F.sum("weight").alias("pairs"), F.sum(F.when(a < b, C("weight")).otherwise(0)).alias("a_first"),
        F.sum(F.when(b < a, C("weight")).otherwise(0)).alias("b_first"))


@query("J8 W6", """
    SELECT month, nation, ifnull(amount, 0)::DOUBLE AS amount,
           sum(ifnull(amount, 0)) OVER (PARTITION BY nation ORDER BY month)::DOUBLE AS running
    FROM (SELECT DISTINCT (year(o_orderdate) * 12 + month(o_orderdate))::BIGINT AS month FROM orders)
    CROSS JOIN (SELECT DISTINCT c_nationkey::BIGINT AS nation FROM customer)
    LEFT JOIN (SELECT (year(o_orderdate) * 12 + month(o_orderdate))::BIGINT AS month, c_nationkey::BIGINT AS nation,
                      sum(o_totalprice::DECIMAL(18,2)) AS amount
               FROM orders JOIN customer ON c_custkey = o_custkey
               WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' GROUP BY 1, 2)
      USING (month, nation)""")
def densified_months(spark: SparkSession, folder: str) -> DataFrame:
    """Every nation in every month of all years, from sparse sums, by carrying rows forward."""
    orders = read_table(spark, folder, "orders")
    customers = read_table(spark, folder, "customer").select("c_custkey", C("c_nationkey").alias("nation"))
    month = (F.year("o_orderdate") * 12 + F.month("o_orderdate")).cast("bigint")
    wanted = orders.filter((C("o_orderpriority") == "1-URGENT") & (C("o_orderstatus") == "F"))
    # Folded per customer before the join with nations.
    per_customer = wanted.groupBy("o_custkey", month.alias("month")).agg(
        F.sum(C("o_totalprice").cast(MONEY)).alias("amount"))
    sums = per_customer.join(customers, C("o_custkey") == C("c_custkey")).select("nation", "month", "amount")
    first, last = orders.agg(F.min(month)).scalar(), orders.agg(F.max(month)).scalar()
    starts = customers.select("nation").distinct().select(
        "nation", first.alias("month"), F.lit(0).cast(MONEY).alias("amount"))
    sparse = sums.unionByName(starts).groupBy("nation", "month").agg(F.sum("amount").alias("amount"))
    dense = dense_running_total(sparse, "nation", "month", "amount", "running", last)
    months = orders.select(month.alias("month")).distinct()
    return dense.join(months, "month").select("month", "nation", "amount", "running")


@query("J10", """
    SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""")
def join_to_distinct_parent(spark: SparkSession, folder: str) -> DataFrame:
    parents = read_table(spark, folder, "orders").filter(C("o_totalprice") > 400000).select(
        C("o_custkey").alias("c_custkey")).distinct()
    return read_table(spark, folder, "customer").join(parents, "c_custkey").select("c_custkey", "c_name")


@query("J11", """
    SELECT c_mktsegment, p_type, r_name, count(*) AS n, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS price
    FROM lineitem, orders, customer, part, supplier, nation, region
    WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey AND l_partkey = p_partkey AND l_suppkey = s_suppkey
      AND s_nationkey = n_nationkey AND n_regionkey = r_regionkey
    GROUP BY 1, 2, 3""")
def star_join(spark: SparkSession, folder: str) -> DataFrame:
    def table(name: str, *columns: str) -> DataFrame:
        return read_table(spark, folder, name).select(*columns)

    buyers = table("orders", "o_orderkey", "o_custkey").join(
        table("customer", "c_custkey", "c_mktsegment"), C("o_custkey") == C("c_custkey"))
    sellers = (
        table("supplier", "s_suppkey", "s_nationkey")
        .join(table("nation", "n_nationkey", "n_regionkey"), C("s_nationkey") == C("n_nationkey"))
        .join(table("region", "r_regionkey", "r_name"), C("n_regionkey") == C("r_regionkey"))
        .select("s_suppkey", "r_name"))
    joined = (
        table("lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice")
        .join(buyers, C("l_orderkey") == C("o_orderkey"))
        .join(table("part", "p_partkey", "p_type"), C("l_partkey") == C("p_partkey"))
        .join(sellers, C("l_suppkey") == C("s_suppkey")))
    return joined.groupBy("c_mktsegment", "p_type", "r_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum(C("l_extendedprice").cast(MONEY)).alias("price"))


@query("U1", """
    SELECT kind, season, count(*) AS n, sum(amount)::DOUBLE AS amount
    FROM (SELECT 'ORDER' AS kind, year(o_orderdate)::BIGINT AS season, o_totalprice::DECIMAL(18,2) AS amount FROM orders
          UNION ALL SELECT 'LINE', year(l_shipdate), l_extendedprice::DECIMAL(18,2) FROM lineitem)
    GROUP BY 1, 2""")
def tagged_union(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select(
        F.lit("ORDER").alias("kind"), _year("o_orderdate").alias("season"), C("o_totalprice").cast(MONEY).alias("amount"))
    lines = read_table(spark, folder, "lineitem").select(
        C("l_extendedprice").cast(MONEY).alias("amount"), _year("l_shipdate").alias("season"), F.lit("LINE").alias("kind"))
    return orders.unionByName(lines).groupBy("kind", "season").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))


@query("U2", """
    SELECT 'customers' AS check_name, count(*) AS failures FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_totalprice < 1000
    UNION ALL SELECT 'lines', count(*) FROM lineitem WHERE l_tax = 0
    UNION ALL SELECT 'events', count(*) FROM events WHERE event_type = 'error'""")
def check_row_union(spark: SparkSession, folder: str) -> DataFrame:
    conditions = {"customers": ("customer", "c_acctbal < 0"), "orders": ("orders", "o_totalprice < 1000"),
                  "lines": ("lineitem", "l_tax = 0"), "events": ("events", "event_type = 'error'")}
    return quality.union_rows([
        quality.failures(name, read_table(spark, folder, table).filter(condition))
        for name, (table, condition) in conditions.items()])


@query("U3", """
    WITH a AS (SELECT l_orderkey AS k, l_linenumber::BIGINT AS n FROM lineitem WHERE l_returnflag <> 'N'),
         b AS (SELECT l_orderkey AS k, l_linenumber::BIGINT AS n FROM lineitem WHERE l_linestatus = 'O')
    SELECT 'left' AS side, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
    UNION ALL SELECT 'right', * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def bag_difference(spark: SparkSession, folder: str) -> DataFrame:
    """Both directions from one signed aggregate; copies come back as copies."""
    lines = read_table(spark, folder, "lineitem").select(
        C("l_orderkey").alias("k"), C("l_linenumber").alias("n"), "l_returnflag", "l_linestatus")
    diff = parity.bag_diff(lines.filter(C("l_returnflag") != "N"), lines.filter(C("l_linestatus") == "O"), ["k", "n"])
    side = F.when(C("surplus") > 0, "left").otherwise("right")
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.abs("surplus")))
    return diff.select(side.alias("side"), "k", "n", copies.alias("_copy")).drop("_copy")


@query("U4", """
    WITH a AS (SELECT l_suppkey AS k, l_returnflag AS f FROM lineitem WHERE l_quantity > 25),
         b AS (SELECT l_suppkey AS k, l_returnflag AS f FROM lineitem WHERE l_quantity <= 25)
    SELECT 'left' AS side, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
    UNION ALL SELECT 'right', * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def except_all_both_ways(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select(
        C("l_suppkey").alias("k"), C("l_returnflag").alias("f"), "l_quantity")
    return parity.except_both_ways(lines.filter("l_quantity > 25"), lines.filter("l_quantity <= 25"), ["k", "f"]).select(
        "side", "k", "f")

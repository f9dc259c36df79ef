"""Projections, filters, predicates and scalar expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.registry import query, rounded
from tidemark.functions import releases, text
from tidemark.functions.measures import count_where, percent, ratio
from tidemark.operators.clean import in_scope, select_release, type_columns
from tidemark.session import scratch
from tidemark.sources.tables import read_table, register, scan

C = F.col


@query("P1", """
    SELECT nullif(CASE l_returnflag WHEN 'N' THEN '' ELSE l_returnflag END, '') AS flag, count(*) AS n
    FROM lineitem GROUP BY 1""")
def blank_to_null(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.when(C("l_returnflag") == "N", "").otherwise(C("l_returnflag"))
    lines = read_table(spark, folder, "lineitem")
    return lines.groupBy(text.blank_to_null(raw).alias("flag")).agg(F.count(F.lit(1)).alias("n"))


@query("P2", """
    SELECT o_orderkey AS order_id, o_orderdate::DATE AS order_date, o_totalprice::DECIMAL(10,2)::DOUBLE AS amount,
           o_orderstatus = 'F' AS is_final FROM orders""")
def strict_casts(spark: SparkSession, folder: str) -> DataFrame:
    raw = read_table(spark, folder, "orders").select(
        C("o_orderkey").cast("string").alias("orderKey"),
        C("o_orderdate").cast("date").cast("string").alias("orderDate"),
        C("o_totalprice").cast("string").alias("totalPrice"),
        (C("o_orderstatus") == "F").cast("string").alias("isFinal"))
    return type_columns(raw, [("orderKey", "order_id", "bigint"), ("orderDate", "order_date", "date"),
                              ("totalPrice", "amount", "decimal(10,2)"), ("isFinal", "is_final", "boolean")])


@query("P3", """
    SELECT s_suppkey, s_name, s_nationkey::BIGINT AS s_nationkey, s_acctbal, s_name AS supplier_name,
           s_nationkey::BIGINT AS nation FROM supplier""")
def star_and_rename(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "supplier").select(
        "*", C("s_name").alias("supplier_name"), C("s_nationkey").alias("nation"))


@query("P4", """
    SELECT nullif(p_brand, '') AS brand, upper(p_type) AS kind, p_size * 2::BIGINT AS double_size FROM part""")
def select_expr(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").selectExpr(
        "nullif(p_brand, '') AS brand", "upper(p_type) AS kind", "p_size * 2L AS double_size")


def tagged_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as raw text with the release of their year."""
    orders = read_table(spark, folder, "orders")
    year = F.year("o_orderdate").cast("string")
    return orders.select(C("o_orderkey").cast("string").alias("id"), year.alias("year"),
                         C("o_totalprice").alias("price"), C("o_orderstatus").alias("status"),
                         F.concat(F.lit("v"), year, F.lit(".1.0")).alias("release_tag"))


@query("P5", """
    SELECT o_orderkey::VARCHAR AS id, o_orderstatus AS status FROM orders WHERE year(o_orderdate) = 1998""")
def release_selection(spark: SparkSession, folder: str) -> DataFrame:
    """One release of a table that is partitioned by its tag: the filter reads one partition."""
    path = scratch(spark, "releases")
    tagged_orders(spark, folder).select("id", "status", "release_tag").write.partitionBy("release_tag").parquet(path)
    raw = spark.read.schema("id string, status string, release_tag string").parquet(path)
    return select_release(raw, "v1998.1.0").select("id", "status")


@query("P6", """
    SELECT year(o_orderdate)::VARCHAR AS year, count(*) AS n FROM orders WHERE year(o_orderdate) >= 1998 GROUP BY 1""")
def season_scope(spark: SparkSession, folder: str) -> DataFrame:
    return in_scope(tagged_orders(spark, folder), "year", 1998).groupBy("year").agg(F.count(F.lit(1)).alias("n"))


@query("P7 J9", """
    SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)""")
def latest_release_rows(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    newest = orders.agg(F.max(F.year("o_orderdate"))).scalar()
    return orders.filter(F.year("o_orderdate") == newest).select("o_orderkey", "o_totalprice")


@query("P8", """
    SELECT CASE WHEN l_discount = 0 THEN 'full price' WHEN l_discount < 0.05 THEN 'reduced' ELSE 'deep' END AS band,
           count(*) AS n FROM lineitem GROUP BY 1""")
def searched_case(spark: SparkSession, folder: str) -> DataFrame:
    band = F.when(C("l_discount") == 0, "full price").when(C("l_discount") < 0.05, "reduced").otherwise("deep")
    return read_table(spark, folder, "lineitem").groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query("P9", """
    SELECT ifnull(nullif(l_linenumber, 7)::VARCHAR, l_returnflag) AS label, count(*) AS n,
           sum(ifnull(nullif(l_quantity, 50), 0))::BIGINT AS quantity
    FROM lineitem GROUP BY 1""")
def coalesced_labels(spark: SparkSession, folder: str) -> DataFrame:
    position = F.nullif(C("l_linenumber"), F.lit(7))
    quantity = F.coalesce(F.nullif(C("l_quantity"), F.lit(50.0)), F.lit(0))
    return read_table(spark, folder, "lineitem").groupBy(
        text.position_label(position, C("l_returnflag")).alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(quantity).cast("bigint").alias("quantity"))


@query("P10 A7", """
    WITH t AS (SELECT nullif(l_linenumber, 7) AS p, l_returnflag AS f, l_quantity AS q FROM lineitem)
    SELECT count(*) FILTER (p IS NULL) AS unknown_position, count(*) FILTER (p IS NOT NULL) AS known_position,
           count(*) FILTER (p BETWEEN 2 AND 4 OR q > 45) AS middle_or_large,
           count(*) FILTER (NOT (p < 3)) AS not_front, count(*) FILTER (f IN ('A', 'N')) AS listed,
           count(*) FILTER (p NOT IN (1, 2)) AS not_listed, count(*) FILTER (p <> 1 AND f <> 'R') AS differs
    FROM t""")
def three_valued_logic(spark: SparkSession, folder: str) -> DataFrame:
    t = read_table(spark, folder, "lineitem").select(
        F.nullif(C("l_linenumber"), F.lit(7)).alias("p"), C("l_returnflag").alias("f"), C("l_quantity").alias("q"))
    return t.agg(
        count_where(C("p").isNull()).alias("unknown_position"),
        count_where(C("p").isNotNull()).alias("known_position"),
        count_where(C("p").between(2, 4) | (C("q") > 45)).alias("middle_or_large"),
        count_where(~(C("p") < 3)).alias("not_front"), count_where(C("f").isin("A", "N")).alias("listed"),
        count_where(~C("p").isin(1, 2)).alias("not_listed"),
        count_where((C("p") != 1) & (C("f") != "R")).alias("differs"))


@query("P11", """
    WITH t AS (SELECT nullif(l_linenumber, 7) AS a, nullif(l_quantity, 7) AS b FROM lineitem)
    SELECT count(*) FILTER (a IS NOT DISTINCT FROM b) AS same, count(*) FILTER (a IS DISTINCT FROM b) AS different,
           count(*) FILTER (a = b) AS equal FROM t""")
def null_safe_compare(spark: SparkSession, folder: str) -> DataFrame:
    a, b = F.nullif(C("l_linenumber"), F.lit(7)), F.nullif(C("l_quantity"), F.lit(7.0))
    return read_table(spark, folder, "lineitem").agg(
        count_where(a.eqNullSafe(b)).alias("same"), count_where(~a.eqNullSafe(b)).alias("different"),
        count_where(a == b).alias("equal"))


@query("P12", f"""
    WITH t AS (SELECT l_suppkey, sum(l_extendedprice::DECIMAL(18,2)) AS gross,
                      sum(l_extendedprice::DECIMAL(18,2)) FILTER (l_returnflag = 'R') AS returned,
                      count(*) FILTER (l_returnflag = 'R') AS n_returned, count(*) FILTER (l_discount > 0.1) AS n_over
               FROM lineitem GROUP BY 1)
    SELECT l_suppkey, abs(ifnull(returned, 0) - gross / 2)::DOUBLE AS off_half,
           {rounded("100.0 * ifnull(returned, 0)::DOUBLE / nullif(gross, 0)::DOUBLE", 1)} AS returned_pct,
           {rounded("n_returned::DOUBLE / nullif(n_over, 0)::DOUBLE", 2)} AS per_over
    FROM t""")
def guarded_arithmetic(spark: SparkSession, folder: str) -> DataFrame:
    price = C("l_extendedprice").cast("decimal(18,2)")
    is_returned = C("l_returnflag") == "R"
    t = read_table(spark, folder, "lineitem").groupBy("l_suppkey").agg(
        F.sum(price).alias("gross"), F.sum(F.when(is_returned, price)).alias("returned"),
        count_where(is_returned).alias("n_returned"), count_where(C("l_discount") > 0.1).alias("n_over"))
    returned = F.coalesce(C("returned"), F.lit(0))
    return t.select(
        "l_suppkey", F.abs(returned.cast("double") - C("gross").cast("double") / 2).alias("off_half"),
        percent(returned, C("gross")).alias("returned_pct"),
        ratio(C("n_returned"), C("n_over"), 2).alias("per_over"))


@query("P13", """
    SELECT lpad(month(o_orderdate)::VARCHAR, 2, '0') || ' - ' || upper(replace(lower(o_orderpriority), '-', ' ')) AS label,
           trim('  ' || o_orderstatus || ' ') AS status, count(*) AS n
    FROM orders GROUP BY 1, 2""")
def string_labels(spark: SparkSession, folder: str) -> DataFrame:
    label = text.round_label(F.month("o_orderdate"), F.lower("o_orderpriority"))
    status = F.trim(F.concat(F.lit("  "), C("o_orderstatus"), F.lit(" ")))
    return read_table(spark, folder, "orders").groupBy(label.alias("label"), status.alias("status")).agg(
        F.count(F.lit(1)).alias("n"))


@query("P14", """
    SELECT page_id, length(html)::BIGINT AS size FROM pages WHERE html NOT ILIKE '%lang="en"%'""")
def pattern_filter(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "pages").filter(~C("html").ilike('%lang="en"%')).select(
        "page_id", F.length("html").cast("bigint").alias("size"))


@query("P15", """
    SELECT o_orderpriority, min(o_orderdate)::DATE AS first_date, max(o_orderdate)::DATE AS last_date,
           count(*) FILTER (o_orderdate::DATE > DATE '2000-06-30') AS later
    FROM orders GROUP BY 1""")
def date_bounds(spark: SparkSession, folder: str) -> DataFrame:
    day = C("o_orderdate").cast("date")
    return read_table(spark, folder, "orders").groupBy("o_orderpriority").agg(
        F.min(day).alias("first_date"), F.max(day).alias("last_date"),
        count_where(day > F.lit(dt.date(2000, 6, 30))).alias("later"))


@query("P16", """
    WITH t AS (SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d, o_orderstatus
               FROM orders),
    tags AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'v' || y || '.' || lpad(m::VARCHAR, 2, '0') || '.' || d
                                     WHEN 'O' THEN y || '.' || m || '.' || d
                                     ELSE 'v' || y || '.' || m || '.' || d END AS tag, y, m, d, o_orderstatus FROM t)
    SELECT tag, CASE WHEN o_orderstatus = 'F' OR (o_orderstatus = 'P' AND m >= 10)
                     THEN y * 1000000 + m * 1000 + d END::BIGINT AS seq, count(*) AS n
    FROM tags GROUP BY ALL""")
def release_tag_encoding(spark: SparkSession, folder: str) -> DataFrame:
    day = C("o_orderdate")
    month = F.month(day).cast("string")
    padded = F.when(C("o_orderstatus") == "P", F.lpad(month, 2, "0")).otherwise(month)
    prefix = F.when(C("o_orderstatus") == "O", "").otherwise("v")
    tag = F.concat(prefix, F.concat_ws(".", F.year(day).cast("string"), padded, F.day(day).cast("string")))
    tags = read_table(spark, folder, "orders").select(tag.alias("tag"))
    return tags.groupBy("tag", releases.release_seq(C("tag")).alias("seq")).agg(F.count(F.lit(1)).alias("n"))


@query("P17", "SELECT o_orderkey, o_orderstatus = 'F' AS is_final, o_totalprice > 100000 AS is_large FROM orders")
def boolean_columns(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "orders").select(
        "o_orderkey", (C("o_orderstatus") == "F").alias("is_final"), (C("o_totalprice") > 100000).alias("is_large"))


@query("P18", "SELECT s_suppkey, 'SUPPLIER' AS kind, 2024001000::BIGINT AS _release_seq FROM supplier")
def constant_columns(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "supplier").select(
        "s_suppkey", F.lit("SUPPLIER").alias("kind"),
        F.lit(releases.parse_tag("v2024.1.0")).cast("bigint").alias("_release_seq"))


@query("P19 O1", """
    SELECT l_orderkey, l_partkey, ifnull(nullif(l_linenumber, 7)::BIGINT, 9999) AS order_key FROM lineitem
    ORDER BY order_key, l_orderkey DESC, l_partkey""")
def sentinel_order_key(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey",
        text.order_key(F.nullif(C("l_linenumber"), F.lit(7)).cast("bigint")).alias("order_key"))
    return lines.orderBy(C("order_key"), C("l_orderkey").desc(), C("l_partkey"))


@query("P20", """
    SELECT CASE WHEN l_returnflag = 'R' THEN 'R' ELSE 'Classified' END AS result_status, count(*) AS n
    FROM lineitem GROUP BY 1""")
def result_status_label(spark: SparkSession, folder: str) -> DataFrame:
    position = F.when(C("l_returnflag") != "R", C("l_linenumber"))
    status = text.result_status(position, C("l_returnflag"))
    return read_table(spark, folder, "lineitem").groupBy(status.alias("result_status")).agg(F.count(F.lit(1)).alias("n"))


@query("P21", """
    SELECT * EXCLUDE (p_retailprice) REPLACE (upper(p_name) AS p_name, p_size::BIGINT AS p_size) FROM part""")
def star_except_and_replace(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").drop("p_retailprice").withColumn("p_name", F.upper("p_name"))


@query("P22 S12", """
    SELECT o_orderpriority AS priority, count(*) AS customers, sum(orders_placed)::BIGINT AS orders_placed
    FROM (SELECT o_orderpriority, o_custkey, count(*) AS orders_placed FROM orders GROUP BY 1, 2)
    WHERE orders_placed > 1 GROUP BY 1""")
def named_views_and_ctes(spark: SparkSession, folder: str) -> DataFrame:
    register(read_table(spark, folder, "orders"), "tm_orders")
    register(scan(spark, "tm_orders").select("o_orderpriority", "o_custkey"), "tm_order_keys")
    return spark.sql("""
        WITH per_customer AS (
            SELECT o_orderpriority AS priority, o_custkey, count(*) AS n FROM tm_order_keys GROUP BY ALL
        ), repeaters AS (SELECT * FROM per_customer WHERE n > 1)
        SELECT priority, count(*) AS customers, sum(n) AS orders_placed FROM (SELECT * FROM repeaters) GROUP BY priority""")

"""File, stream, sink and manifest queries over releases landed from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.registry import query
from tidemark.catalog.state import TAGS, snapshot
from tidemark.operators import snapshot as S
from tidemark.operators.quality import check_input, union_rows
from tidemark.plans.schema import Dataset
from tidemark.plans.verification import files_per_release, source_population
from tidemark.session import scratch, stored
from tidemark.sources import csv_release as csv
from tidemark.sources import digest_tree as D
from tidemark.sources import manifest as M
from tidemark.sources.export import export, member_coverage
from tidemark.sources.tables import literal_rows, read_table
from tidemark.streaming.ingest import RAW_EXPECTATIONS, RawStore

C = F.col
CUSTOMERS = "customers"


def land_customers(spark: SparkSession, folder: str, name: str) -> RawStore:
    """Three customer releases as CSV: the second reorders its columns, the third adds one."""
    landing = scratch(spark, f"{name}-landing")
    for i, tag in enumerate(TAGS):
        rows = snapshot(spark, folder, tag).select(
            C("c_custkey").cast("string").alias("id"), C("c_name").alias("name"), "segment",
            C("nation").cast("string").alias("nation"))
        if i == 1:
            rows = rows.select("nation", "id", "segment", "name")
        if i == 2:
            rows = rows.withColumn("label", F.concat("name", F.lit(' "'), F.coalesce("segment", F.lit("?")), F.lit('",\nnew')))
        csv.write_release(rows, landing, CUSTOMERS, tag)
    return RawStore(spark, landing, scratch(spark, f"{name}-raw"))


_RAW = """SELECT release_tag, c_custkey::VARCHAR AS id, c_name AS name, segment, nation::VARCHAR AS nation,
    CASE release_tag WHEN 'v2024.10.0' THEN c_name || ' "' || ifnull(segment, '?') || '",' || chr(10) || 'new' END AS label
    FROM t_snapshots"""


@query("S1 S4 S6 S8 S9", _RAW)
def ingested_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every release streamed in under its own header, aligned by name, then streamed again."""
    store = land_customers(spark, folder, "ingest")
    store.ingest([CUSTOMERS])
    store.ingest([CUSTOMERS])  # a replay adds nothing
    return store.table(CUSTOMERS).select("release_tag", "id", "name", "segment", "nation", "label")


@query("S5 Q12", """
    SELECT release_tag, count(*) AS row_count, true AS all_files_read, count(*) AS manifest_rows, true AS has_ingest_time
    FROM t_snapshots GROUP BY 1""")
def ingest_provenance(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and source files of each release against its manifest."""
    store = land_customers(spark, folder, "provenance")
    store.ingest([CUSTOMERS], max_files=2)
    raw = store.table(CUSTOMERS)
    manifest = M.build_manifest(spark, store.landing, {CUSTOMERS: list(TAGS)})
    # A file without rows leaves no trace in the table.
    listed = manifest.groupBy("release_tag").agg(
        F.sum("row_count").alias("manifest_rows"), F.count_if(C("row_count") > 0).alias("listed_files"))
    stamped = raw.groupBy("release_tag").agg(F.count_if(C(csv.INGESTED_AT).isNull()).alias("n")).select(
        "release_tag", (C("n") == 0).alias("has_ingest_time"))
    found = files_per_release(raw, listed).join(stamped, "release_tag")
    return found.withColumn("all_files_read", C("file_count") == C("listed_files")).drop("file_count", "listed_files")


@query("S2 Q5", "SELECT s_suppkey::VARCHAR AS id, s_name AS name, 'v2024.1.0' AS release_tag FROM supplier")
def declared_stream_table(spark: SparkSession, folder: str) -> DataFrame:
    """A stream whose expectations would stop it at the first bad row."""
    landing = scratch(spark, "declared-landing")
    rows = read_table(spark, folder, "supplier").select(C("s_suppkey").cast("string").alias("id"), C("s_name").alias("name"))
    csv.write_release(rows, landing, "suppliers", "v2024.1.0")
    store = RawStore(spark, landing, scratch(spark, "declared-raw"))
    store.ingest(["suppliers"], strict=False, expectations=RAW_EXPECTATIONS)
    return store.table("suppliers").select("id", "name", "release_tag")


@query("S3 P4", "SELECT c_custkey, c_name, segment, nation FROM t_snapshots WHERE seq = 2024002000")
def static_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    store = land_customers(spark, folder, "static")
    rows = csv.read_snapshot(spark, store.landing, CUSTOMERS, "v2024.2.0")
    return rows.selectExpr("cast(nullif(id, '') AS bigint) AS c_custkey", "nullif(name, '') AS c_name",
                           "nullif(segment, '') AS segment", "cast(nullif(nation, '') AS bigint) AS nation")


@query("S6 Q11", """
    SELECT release_tag, count(segment) AS segment, count(*) FILTER (release_tag = 'v2024.10.0') AS label
    FROM t_snapshots GROUP BY 1""")
def evolved_column_population(spark: SparkSession, folder: str) -> DataFrame:
    store = land_customers(spark, folder, "evolved")
    store.ingest([CUSTOMERS])
    return source_population(store.table(CUSTOMERS), ["segment", "label"])


@query("S7 Q2", """
    SELECT 'no_rescued_rows' AS check_name, count(*) FILTER (c_acctbal < 0) + count(*) FILTER (c_acctbal > 9000) AS failures
    FROM customer
    UNION ALL SELECT 'row_count', 0""")
def rescued_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with a field too few or too many are kept whole in the rescue column and block the gate."""
    landing = scratch(spark, "rescued-landing")
    balance = C("c_acctbal")
    short, long = C("c_name"), F.concat_ws(",", "c_name", "c_mktsegment", F.lit("extra"))
    rest = F.when(balance < 0, short).when(balance > 9000, long).otherwise(F.concat_ws(",", "c_name", "c_mktsegment"))
    # One column holds the whole line, and its name the header; the separator never occurs.
    line = F.concat_ws(",", C("c_custkey").cast("string"), rest)
    lines = read_table(spark, folder, "customer").select(line.alias("id,name,segment"))
    lines.write.options(header="true", sep="\u0001").csv(csv.release_path(landing, CUSTOMERS, "v2024.1.0"))
    store = RawStore(spark, landing, scratch(spark, "rescued-raw"))
    store.ingest([CUSTOMERS], strict=False)
    # The count comes from the manifest of the landed files, as in a release run.
    listed = M.expected_rows(M.build_manifest(spark, landing, {CUSTOMERS: ["v2024.1.0"]})).first()
    return check_input(store.table(CUSTOMERS), expected_count=listed["row_count"])


@query("S8", "SELECT (SELECT count(*) FROM t_snapshots) AS first_run, 0::BIGINT AS second_run, 0::BIGINT AS third_run")
def replayed_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Rows added by three runs over the same files."""
    store = land_customers(spark, folder, "replay")
    counts = [store.ingest([CUSTOMERS]) for _ in range(3)]
    return literal_rows(spark, [tuple(counts)], "first_run bigint, second_run bigint, third_run bigint")


@query("S9", "SELECT kind, n FROM (SELECT 'batch 1' AS kind, count(*) AS n FROM orders UNION ALL SELECT 'batch 2', count(*) FROM lineitem)")
def appended_table(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "appended")
    for kind, table in (("batch 1", "orders"), ("batch 2", "lineitem")):
        keys = read_table(spark, folder, table)
        keys.select(F.lit(kind).alias("kind"), C(keys.columns[0]).alias("id")).write.mode("append").parquet(path)
    return spark.read.parquet(path).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("S10", "SELECT p_partkey, p_name, p_brand FROM part")
def overwritten_table(spark: SparkSession, folder: str) -> DataFrame:
    """A published table replaced by one with another schema; readers switch at the log entry."""
    table = S.VersionedTable(spark, scratch(spark, "overwritten"))
    parts = read_table(spark, folder, "part")
    table.publish(parts.select("p_partkey", "p_size"), 1)
    table.publish(parts.select("p_partkey", "p_name", "p_brand"), 2)
    return table.read()


@query("S11 S13 S19", """
    SELECT * FROM (VALUES ('declared', 0::BIGINT, 'release_seq,attempt_id,task_key'), ('like', 0, 'o_orderkey,o_custkey'),
                          ('literal', 2, 'release_seq,release_tag'),
                          ('filled', (SELECT count(*) FROM orders), 'o_orderkey,o_custkey')) t(kind, n, column_list)""")
def created_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Empty tables from a declared schema and from a query, parameter rows, and a filled table."""
    from tidemark.operators.ledger import COMPLETIONS

    declared = S.VersionedTable(spark, scratch(spark, "declared"))
    declared.create(COMPLETIONS)
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    filled = S.VersionedTable(spark, scratch(spark, "like"))
    empty = S.empty_like(orders)
    filled.publish(empty, None)
    filled.publish(orders, 1)
    literal = literal_rows(spark, [(1, "v2024.1.0"), (2, "v2024.2.0")], "release_seq bigint, release_tag string")
    frames = {"declared": declared.read(), "like": empty, "literal": literal, "filled": filled.read()}
    return union_rows([
        frame.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(kind).alias("kind"), "n", F.lit(",".join(frame.columns)).alias("column_list"))
        for kind, frame in frames.items()])


# The contract of the landed customers, for the manifest rules.
CUSTOMER_DATASET = Dataset(
    name=CUSTOMERS, columns=(("id", "c_custkey", "bigint"), ("name", "c_name", "string"), ("label", "label", "string")),
    keys=("c_custkey",), required=("c_custkey",))


@query("S14", """
    SELECT 'customers' AS dataset, release_tag, count(*) AS row_count,
           CASE release_tag WHEN 'v2024.2.0' THEN 'nation,id,segment,name' WHEN 'v2024.1.0' THEN 'id,name,segment,nation'
                ELSE 'id,name,segment,nation,label' END AS column_list, 64::BIGINT AS digest_length
    FROM t_snapshots GROUP BY 2""")
def release_manifest(spark: SparkSession, folder: str) -> DataFrame:
    store = land_customers(spark, folder, "manifest")
    manifest = M.build_manifest(spark, store.landing, {CUSTOMERS: list(TAGS)})
    return manifest.groupBy("dataset", "release_tag", F.array_join("columns", ",").alias("column_list")).agg(
        F.sum("row_count").alias("row_count"), F.max(F.length("sha256")).alias("digest_length"))


@query("S14", """
    SELECT release_tag, violation, true AS in_every_file FROM (VALUES
      ('v2024.1.0', 'missing_column'), ('v2024.2.0', 'missing_column')) t(release_tag, violation)""")
def manifest_rule_violations(spark: SparkSession, folder: str) -> DataFrame:
    """The contract asks for ``label``, which only the third release has."""
    store = land_customers(spark, folder, "rules")
    manifest = stored(M.build_manifest(spark, store.landing, {CUSTOMERS: list(TAGS)}), "rules-manifest")
    listed = manifest.groupBy("release_tag").agg(F.count(F.lit(1)).alias("listed"))
    found = M.manifest_violations(manifest, {CUSTOMERS: CUSTOMER_DATASET}).groupBy("release_tag", "violation").agg(
        F.count(F.lit(1)).alias("files"))
    return found.join(listed, "release_tag").select("release_tag", "violation", (C("files") == C("listed")).alias("in_every_file"))


@query("S15", """
    SELECT * FROM (VALUES ('v2024.1.0', 'row_count_changed', true), ('v2024.10.0', 'file_unlisted', true))
      t(release_tag, violation, in_every_file)""")
def manifest_verification(spark: SparkSession, folder: str) -> DataFrame:
    """Files against a stored manifest that has wrong counts for one release and lacks another."""
    store = land_customers(spark, folder, "verify")
    manifest = stored(M.build_manifest(spark, store.landing, {CUSTOMERS: list(TAGS)}), "landed-manifest")
    count = F.when(C("release_tag") == "v2024.1.0", C("row_count") + 1).otherwise(C("row_count"))
    kept = stored(manifest.withColumn("row_count", count).filter("release_tag <> 'v2024.10.0'"), "manifest")
    listed = manifest.groupBy("release_tag").agg(F.count(F.lit(1)).alias("listed"))
    found = M.verify_manifest(manifest, kept).groupBy("release_tag", "violation").agg(F.count(F.lit(1)).alias("files"))
    return found.join(listed, "release_tag").select("release_tag", "violation", (C("files") == C("listed")).alias("in_every_file"))


@query("S14 S15", """
    SELECT release_tag, count(*) + CASE release_tag WHEN 'v2024.10.0' THEN count(c_name) ELSE 0 END AS line_feeds,
           true AS bytes_agree, release_tag = 'v2024.2.0' AS changed, true AS as_planted
    FROM t_snapshots GROUP BY release_tag""")
def file_range_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Landed files by digests of byte ranges, against stored digests of which those of one release are planted."""
    store = land_customers(spark, folder, "ranges")
    out = []
    for tag in TAGS:
        path = csv.release_path(store.landing, CUSTOMERS, tag)
        now = stored(D.range_digests(spark, path, range_bytes=1 << 14, glob="*.csv"), "range-digests")
        # Every third range of one release was another one when the digests were stored.
        other = (C("number") % 3 == 0) & F.lit(tag == "v2024.2.0")
        then = now.withColumn("sha256", F.when(other, F.sha2("sha256", 256)).otherwise(C("sha256")))
        planted = now.filter(other).select("file", "number")
        found = stored(D.changed_ranges(D.tree(now, 8), D.tree(then, 8), 8), "changed-ranges")
        wrong = planted.join(found, ["file", "number"], "full").filter(
            C("change").isNull() | (C("change") != "changed")).union(
            found.join(planted, ["file", "number"], "left_anti").select("file", "number", "change"))
        sizes = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path).agg(
            F.sum("length").alias("file_bytes"), F.count(F.lit(1)).alias("files"))
        facts = now.agg(F.sum("length").alias("range_bytes"), F.sum("line_feeds").alias("lines"))
        # One row each, laid over each other.
        changed = found.agg((F.count(F.lit(1)) > 0).alias("changed"))
        as_planted = wrong.agg((F.count(F.lit(1)) == 0).alias("as_planted"))
        one = sizes
        for other_fact in (facts, changed, as_planted):
            one = one.unionByName(other_fact, allowMissingColumns=True)
        told = one.agg(*[F.max(c).alias(c) for c in one.columns])
        # Every file starts with a header line.
        out.append(told.select(F.lit(tag).alias("release_tag"), (C("lines") - C("files")).alias("line_feeds"),
                               (C("file_bytes") == C("range_bytes")).alias("bytes_agree"), "changed", "as_planted"))
    return union_rows(out)


@query("S17", """
    SELECT 'csv' AS format, o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 2, 3
    UNION ALL SELECT 'json', o_orderpriority, o_orderstatus, count(*) FROM orders GROUP BY 2, 3""")
def exported_results(spark: SparkSession, folder: str) -> DataFrame:
    """A result written as CSV and as JSON lines, and both read back."""
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    schema = "o_orderkey bigint, o_orderpriority string, o_orderstatus string"
    out = []
    for fmt in ("csv", "json"):
        path = scratch(spark, f"export-{fmt}")
        export(orders, path, fmt)
        reader = spark.read.schema(schema)
        back = reader.csv(path, header=True) if fmt == "csv" else reader.json(path)
        out.append(back.groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(fmt).alias("format"), "o_orderpriority", "o_orderstatus", "n"))
    return union_rows(out)


@query("S18", """
    SELECT 'pit stops' AS member, (SELECT count(*) FROM lineitem) AS total_rows, 'id,year,flag' AS column_list,
           year(l_shipdate)::VARCHAR AS season, count(*) AS season_rows
    FROM lineitem WHERE year(l_shipdate) BETWEEN 1998 AND 2000 GROUP BY 4""")
def extra_member_coverage(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "member")
    lines = read_table(spark, folder, "lineitem")
    export(lines.select(C("l_orderkey").alias("id"), F.year("l_shipdate").alias("year"), C("l_returnflag").alias("flag")), path)
    return member_coverage(spark, path, "pit stops", ["1998", "1999", "2000"])

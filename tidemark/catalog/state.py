"""Snapshot merge, history and ledger queries over releases derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.registry import query
from tidemark.operators import history as H
from tidemark.operators import ledger as L
from tidemark.operators import snapshot as S
from tidemark.operators.parity import bag_diff
from tidemark.operators.quality import union_rows
from tidemark.plans.schema import TERMINAL_TASKS
from tidemark.session import scratch, stored
from tidemark.sources.tables import literal_rows, read_table
from tidemark.streaming.cursor import advance_history, snapshot_source

C = F.col

KEYS = ["c_custkey"]
TRACKED = ["c_name", "segment", "nation"]
TAGS = {"v2024.1.0": 2024001000, "v2024.2.0": 2024002000, "v2024.10.0": 2024010000}


def snapshot(spark: SparkSession, folder: str, tag: str) -> DataFrame:
    """One release of the customers.

    The second one lacks customers in the red and forgets the segment of the rich; the third brings
    back those slightly in the red, drops some builders, and moves the machinery makers.
    """
    balance, segment = C("c_acctbal"), C("c_mktsegment")
    customers = read_table(spark, folder, "customer")
    nation = C("c_nationkey").cast("bigint")
    if tag == "v2024.2.0":
        customers = customers.filter(balance >= 0)
        segment = F.when(balance <= 9000, segment)
    elif tag == "v2024.10.0":
        gone = (segment == "BUILDING") & balance.between(1000, 2000)
        customers = customers.filter((balance >= -500) & ~gone)
        nation = F.when(segment == "MACHINERY", F.lit(-1)).otherwise(nation).cast("bigint")
        segment = F.when(balance <= 9500, segment)
    return customers.select("c_custkey", "c_name", segment.alias("segment"), nation.alias("nation"))


def all_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return union_rows([
        snapshot(spark, folder, tag).withColumn("seq", F.lit(seq).cast("bigint")) for tag, seq in TAGS.items()])


_SNAP = "(SELECT c_custkey, c_name, segment, nation FROM t_snapshots WHERE seq = {})"
_OLD, _NEW = _SNAP.format(2024001000), _SNAP.format(2024002000)


@query("M1", f"""
    SELECT coalesce(n.c_custkey, o.c_custkey) AS c_custkey,
           if(n.c_custkey IS NULL, o.c_name, n.c_name) AS c_name,
           if(n.c_custkey IS NULL, o.segment, n.segment) AS segment,
           if(n.c_custkey IS NULL, o.nation, n.nation) AS nation,
           CASE WHEN o.c_custkey IS NULL THEN 'insert' WHEN n.c_custkey IS NULL THEN 'delete'
                WHEN (o.c_name, o.segment, o.nation) IS NOT DISTINCT FROM (n.c_name, n.segment, n.nation)
                THEN 'unchanged' ELSE 'update' END AS _change
    FROM {_OLD} o FULL JOIN {_SNAP.format(2024010000)} n USING (c_custkey)""")
def snapshot_changes(spark: SparkSession, folder: str) -> DataFrame:
    return S.classify_changes(snapshot(spark, folder, "v2024.1.0"), snapshot(spark, folder, "v2024.10.0"), KEYS)


@query("M1 S10 S11", f"SELECT * FROM {_SNAP.format(2024010000)}")
def merged_current_table(spark: SparkSession, folder: str) -> DataFrame:
    """Three releases merged in turn into a versioned table, the last one twice."""
    table = S.VersionedTable(spark, scratch(spark, "current"))
    for tag in [*TAGS, "v2024.10.0"]:
        table.merge(snapshot(spark, folder, tag), KEYS, TAGS[tag])
    return table.read()


@query("M1", f"""
    SELECT seq, change, count(*) AS n FROM (
      SELECT 2024002000::BIGINT AS seq,
             CASE WHEN o.c_custkey IS NULL THEN 'insert' WHEN n.c_custkey IS NULL THEN 'delete'
                  WHEN (o.c_name, o.segment, o.nation) IS NOT DISTINCT FROM (n.c_name, n.segment, n.nation)
                  THEN 'unchanged' ELSE 'update' END AS change
      FROM {_OLD} o FULL JOIN {_NEW} n USING (c_custkey)
      UNION ALL
      SELECT 2024010000,
             CASE WHEN o.c_custkey IS NULL THEN 'insert' WHEN n.c_custkey IS NULL THEN 'delete'
                  WHEN (o.c_name, o.segment, o.nation) IS NOT DISTINCT FROM (n.c_name, n.segment, n.nation)
                  THEN 'unchanged' ELSE 'update' END
      FROM {_NEW} o FULL JOIN {_SNAP.format(2024010000)} n USING (c_custkey))
    GROUP BY 1, 2""")
def merge_change_counts(spark: SparkSession, folder: str) -> DataFrame:
    tags = list(TAGS)

    def step(before: str, after: str) -> DataFrame:
        changes = S.classify_changes(snapshot(spark, folder, before), snapshot(spark, folder, after), KEYS)
        return S.change_counts(changes).select(F.lit(TAGS[after]).cast("bigint").alias("seq"), "change", "n")

    return step(tags[0], tags[1]).unionByName(step(tags[1], tags[2]))


@query("M5 D26", f"SELECT * FROM {_SNAP.format(2024010000)}")
def current_view(spark: SparkSession, folder: str) -> DataFrame:
    """The merge-free form of the current table: each release, taken from the raw rows of all, overwrites it."""
    raw = all_snapshots(spark, folder)
    table = S.VersionedTable(spark, scratch(spark, "current-view"))
    for tag in ("v2024.2.0", "v2024.10.0"):
        state = S.overwrite_current(table, raw.filter(C("seq") == TAGS[tag]).select(*KEYS, *TRACKED), TAGS[tag])
    return state


_STORED = "(SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders)"


@query("M2", """
    SELECT o_orderkey, if(l_orderkey IS NULL, o_orderstatus, 'RUNNING') AS status, o_totalprice AS price,
           if(l_orderkey IS NULL, o_orderpriority, flags) AS note
    FROM orders LEFT JOIN (SELECT l_orderkey, min(l_returnflag) AS flags FROM lineitem WHERE l_quantity = 50 GROUP BY 1)
      ON l_orderkey = o_orderkey
    UNION ALL
    SELECT -1 - s_suppkey, 'RUNNING', s_acctbal, 'new' FROM supplier""")
def keyed_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Matched orders take status and note, not price; supplier rows are inserted whole."""
    stored = read_table(spark, folder, "orders").select(
        "o_orderkey", C("o_orderstatus").alias("status"), C("o_totalprice").alias("price"),
        C("o_orderpriority").alias("note"))
    touched = read_table(spark, folder, "lineitem").filter("l_quantity = 50").groupBy(
        C("l_orderkey").alias("o_orderkey")).agg(F.min("l_returnflag").alias("note")).select(
        "o_orderkey", F.lit("RUNNING").alias("status"), F.lit(0.0).alias("price"), "note")
    fresh = read_table(spark, folder, "supplier").select(
        (F.lit(-1) - C("s_suppkey")).alias("o_orderkey"), F.lit("RUNNING").alias("status"),
        C("s_acctbal").alias("price"), F.lit("new").alias("note"))
    return L.upsert(stored, touched.unionByName(fresh), ["o_orderkey"], ["status", "note"])


@query("M3", """
    SELECT o_orderkey, if(year(o_orderdate) = 1998 AND o_orderpriority = '1-URGENT', 'COMPLETE', o_orderstatus) AS status
    FROM orders""")
def predicate_update(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    due = (F.year("o_orderdate") == 1998) & (C("o_orderpriority") == "1-URGENT")
    done = L.update_where(orders, due, {"o_orderstatus": F.lit("COMPLETE")})
    return done.select("o_orderkey", C("o_orderstatus").alias("status"))


@query("M4", """
    SELECT s_suppkey, s_name, s_nationkey::BIGINT AS s_nationkey, s_acctbal, NULL::VARCHAR AS attempt_id FROM supplier""")
def added_columns(spark: SparkSession, folder: str) -> DataFrame:
    return L.add_columns(read_table(spark, folder, "supplier"), {"attempt_id": "string", "s_name": "string"})


# --- history ------------------------------------------------------------------------------------

def _incremental(spark: SparkSession, folder: str, retry: bool) -> DataFrame:
    """The stored history after each release in turn; storing keeps every step's plan short."""
    first = snapshot(spark, folder, "v2024.1.0")
    table = S.VersionedTable(spark, scratch(spark, "history"))
    history = H.empty_history(first, KEYS, TRACKED)
    for tag, seq in TAGS.items():
        for _ in range(2 if retry else 1):
            table.publish(H.apply_snapshot(history, snapshot(spark, folder, tag), seq, KEYS, TRACKED), seq)
            history = table.read()
    return history


@query("H1", """
    SELECT c_custkey, c_name, segment, nation, 2024001000::BIGINT AS valid_from_release,
           CASE WHEN n.k IS NULL OR (c_name, segment, nation) IS DISTINCT FROM (n.a, n.b, n.c)
                THEN 2024002000 END::BIGINT AS valid_to_release
    FROM t_snapshots LEFT JOIN (SELECT c_custkey AS k, c_name AS a, segment AS b, nation AS c FROM t_snapshots
                                WHERE seq = 2024002000) n ON n.k = c_custkey
    WHERE seq = 2024001000""")
def history_close(spark: SparkSession, folder: str) -> DataFrame:
    """After the first half of the second release: changed and removed customers are closed."""
    first, second = snapshot(spark, folder, "v2024.1.0"), snapshot(spark, folder, "v2024.2.0")
    opened = H.open_versions(H.empty_history(first, KEYS, TRACKED), first, TAGS["v2024.1.0"], KEYS, TRACKED)
    return H.close_versions(opened, second, TAGS["v2024.2.0"], KEYS, TRACKED)


_TWO = """SELECT c_custkey, c_name, segment, nation, valid_from_release,
    CASE WHEN valid_to_release <= 2024002000 THEN valid_to_release END AS valid_to_release
    FROM t_history WHERE valid_from_release <= 2024002000"""


@query("H2 H3", _TWO)
def history_after_crash(spark: SparkSession, folder: str) -> DataFrame:
    """A run that stopped between closing and opening, then applied the same release again."""
    half = history_close(spark, folder)
    return H.apply_snapshot(half, snapshot(spark, folder, "v2024.2.0"), TAGS["v2024.2.0"], KEYS, TRACKED)


@query("D9 H1 H2 H4", "SELECT * FROM t_history")
def history_incremental(spark: SparkSession, folder: str) -> DataFrame:
    return _incremental(spark, folder, retry=True)


def release_ledger(spark: SparkSession) -> DataFrame:
    """The releases there are, so that no snapshot is read to learn of them."""
    return literal_rows(spark, [(seq,) for seq in TAGS.values()], "seq bigint")


@query("D9 H4", "SELECT * FROM t_history")
def history_rebuilt(spark: SparkSession, folder: str) -> DataFrame:
    """All releases at once; equal to applying them in turn."""
    snapshots = all_snapshots(spark, folder)
    return H.rebuild_history(snapshots, release_ledger(spark), KEYS, TRACKED)


@query("S16 H4", "SELECT * FROM t_history")
def history_from_cursor(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshot sources drained by version; a replayed or older version yields nothing."""
    history = H.empty_history(snapshot(spark, folder, "v2024.1.0"), KEYS, TRACKED)
    last: int | None = None
    for tag in ["v2024.1.0", "v2024.2.0", "v2024.2.0", "v2024.1.0", "v2024.10.0"]:
        source = snapshot_source(lambda t=tag: snapshot(spark, folder, t), TAGS[tag])
        found, cursor = advance_history(history, last, source, KEYS, TRACKED)
        if cursor != last:
            history, last = stored(found, "history"), cursor
    return history


@query("H4", """
    WITH daily AS (SELECT user_id, ts::DATE AS day, max_by(event_type, (ts, event_id)) AS last_type
                   FROM events GROUP BY 1, 2),
    days AS (SELECT day, date_part('year', day) * 10000 + date_part('month', day) * 100 + date_part('day', day) AS seq,
                    row_number() OVER (ORDER BY day) AS step FROM (SELECT DISTINCT day FROM daily)),
    marked AS (SELECT user_id, last_type, seq, step,
                      step - row_number() OVER (PARTITION BY user_id, last_type ORDER BY step) AS island
               FROM daily JOIN days USING (day))
    SELECT user_id, last_type, min(m.seq)::BIGINT AS valid_from_release, n.seq::BIGINT AS valid_to_release
    FROM marked m LEFT JOIN days n ON n.step = (SELECT max(step) FROM marked x WHERE x.user_id = m.user_id
         AND x.last_type = m.last_type AND x.island = m.island) + 1
    GROUP BY user_id, last_type, island, n.seq""")
def user_activity_history(spark: SparkSession, folder: str) -> DataFrame:
    """One snapshot a day of each active user's last event; an idle day ends a version."""
    day = C("ts").cast("date")
    last = F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type")
    daily = read_table(spark, folder, "events").groupBy("user_id", day.alias("day")).agg(last)
    seq = F.year("day") * 10000 + F.month("day") * 100 + F.day("day")
    # Read once for the days there are, and once for the rows.
    snapshots = stored(daily.withColumn("seq", seq.cast("bigint")), "daily")
    return H.rebuild_history(snapshots, snapshots.select("seq"), ["user_id"], ["last_type"])


@query("H5", """
    SELECT unnest(['null:c_custkey', 'null:valid_from_release', 'unique:c_custkey,valid_from_release',
                   'one_open_version', 'open_without_current', 'current_without_open', 'positive_interval']) AS check_name,
           unnest([0, 0, 0, 0,
                   (SELECT count(*) FROM t_history WHERE valid_to_release IS NULL AND c_custkey NOT IN
                      (SELECT c_custkey FROM t_snapshots WHERE seq = 2024002000)),
                   (SELECT count(*) FROM t_snapshots WHERE seq = 2024002000 AND c_custkey NOT IN
                      (SELECT c_custkey FROM t_history WHERE valid_to_release IS NULL)), 0])::BIGINT AS failures""")
def history_invariants(spark: SparkSession, folder: str) -> DataFrame:
    """The finished history against an older snapshot: the presence checks must report it."""
    return H.check_history(_incremental(spark, folder, retry=False), KEYS, snapshot(spark, folder, "v2024.2.0"))


@query("H6 U3", """
    SELECT c_custkey, c_name, segment, nation, count(*) FILTER (side > 0) - count(*) FILTER (side < 0) AS surplus
    FROM (SELECT c_custkey, c_name, segment, nation, 1 AS side FROM t_history WHERE valid_to_release IS NULL
          UNION ALL SELECT c_custkey, c_name, segment, nation, -1 FROM t_snapshots WHERE seq = 2024002000)
    GROUP BY 1, 2, 3, 4 HAVING surplus <> 0""")
def open_history_difference(spark: SparkSession, folder: str) -> DataFrame:
    snapshots = all_snapshots(spark, folder)
    history = H.rebuild_history(snapshots, release_ledger(spark), KEYS, TRACKED)
    live = history.filter(C(H.END).isNull())
    return bag_diff(live, snapshot(spark, folder, "v2024.2.0"), [*KEYS, *TRACKED])


# --- ledger -------------------------------------------------------------------------------------
# Each customer is an independent ledger, each order a release of it, and each line a task marker.

def _state(spark: SparkSession, folder: str) -> DataFrame:
    status = F.when(C("o_orderstatus") == "F", "PUBLISHED").when(C("o_orderstatus") == "O", "RUNNING").otherwise("COMPLETE")
    return read_table(spark, folder, "orders").select(
        C("o_custkey").alias("ledger"), C("o_orderkey").alias("release_seq"), status.alias("status"),
        F.year("o_orderdate").cast("bigint").alias("min_season"), C("o_orderpriority").alias("archive_sha256"),
        F.when(C("o_orderpriority") != "5-LOW", "current").alias("attempt_id"))


def _completions(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of returned goods belong to a stale attempt; line numbers above five are other tasks."""
    tasks = F.array(*[F.lit(t) for t in TERMINAL_TASKS], F.lit("bronze"), F.lit("silver"))
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    owners = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return lines.join(owners, C("l_orderkey") == C("o_orderkey")).select(
        C("o_custkey").alias("ledger"), C("l_orderkey").alias("release_seq"),
        F.when(C("l_returnflag") == "R", "stale").otherwise("current").alias("attempt_id"),
        F.element_at(tasks, C("l_linenumber")).alias("task_key"))


def _candidates(spark: SparkSession, folder: str) -> DataFrame:
    """The next run of every customer: a new, a repeated or an older release, by segment."""
    orders = read_table(spark, folder, "orders")
    latest = orders.groupBy(C("o_custkey").alias("ledger")).agg(
        F.max("o_orderkey").alias("last_seq"),
        F.max_by(F.year("o_orderdate"), "o_orderkey").cast("bigint").alias("last_scope"),
        F.max_by("o_orderpriority", "o_orderkey").alias("last_hash"))
    who = read_table(spark, folder, "customer").select(C("c_custkey").alias("ledger"), "c_mktsegment", "c_acctbal", "c_name")
    segment, rich = C("c_mktsegment"), C("c_acctbal") > 5000
    shift = F.when(segment == "BUILDING", 1).when(segment == "MACHINERY", -1).otherwise(0)
    scope = F.when((segment == "HOUSEHOLD") & rich, C("last_scope") - 1).when(
        (segment == "FURNITURE") & rich, C("last_scope") + 1).otherwise(C("last_scope"))
    digest = F.when((segment == "AUTOMOBILE") & rich, "changed").otherwise(C("last_hash"))
    return latest.join(who, "ledger").select(
        "ledger", (C("last_seq") + shift).alias("release_seq"), scope.alias("min_season"),
        digest.alias("archive_sha256"), (C("c_acctbal") > 7000).alias("allow_scope_expansion"),
        C("c_name").alias("attempt_id"))


_STATE = """
    s AS (SELECT o_custkey AS ledger, o_orderkey AS seq, year(o_orderdate)::BIGINT AS scope, o_orderpriority AS hash,
                 CASE o_orderstatus WHEN 'F' THEN 'PUBLISHED' WHEN 'O' THEN 'RUNNING' ELSE 'COMPLETE' END AS status,
                 CASE WHEN o_orderpriority <> '5-LOW' THEN 'current' END AS attempt,
                 CASE WHEN o_orderpriority = '5-LOW' THEN o_orderstatus = 'F'
                      ELSE (SELECT count(DISTINCT l_linenumber) FROM lineitem
                            WHERE l_orderkey = o_orderkey AND l_returnflag <> 'R' AND l_linenumber <= 5) = 5 END AS whole
          FROM orders),
    top AS (SELECT * FROM s QUALIFY seq = max(seq) OVER (PARTITION BY ledger)),
    c AS (SELECT ledger, t.scope AS top_scope, t.seq AS top_seq, t.whole AS top_whole, t.attempt AS top_attempt,
                 seq + CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN -1 ELSE 0 END AS seq,
                 scope + CASE WHEN c_acctbal <= 5000 THEN 0 WHEN c_mktsegment = 'HOUSEHOLD' THEN -1
                              WHEN c_mktsegment = 'FURNITURE' THEN 1 ELSE 0 END AS scope,
                 CASE WHEN c_mktsegment = 'AUTOMOBILE' AND c_acctbal > 5000 THEN 'changed' ELSE hash END AS hash,
                 c_acctbal > 7000 AS allow, c_name AS attempt
          FROM top t JOIN customer ON c_custkey = ledger)"""


@query("L3 L1", f"""
    WITH {_STATE}
    SELECT ledger, seq AS release_seq, 'scope_change' AS violation FROM c
    WHERE scope <> top_scope AND NOT (allow AND scope < top_scope AND seq = top_seq)
    UNION ALL
    SELECT ledger, seq, 'unfinished_latest' FROM c
    WHERE allow AND scope < top_scope AND seq = top_seq AND NOT top_whole
    UNION ALL
    SELECT ledger, seq, 'rollback' FROM c WHERE EXISTS (SELECT 1 FROM s WHERE s.ledger = c.ledger AND s.seq > c.seq)
    UNION ALL
    SELECT ledger, seq, 'identity_changed' FROM c
    WHERE EXISTS (SELECT 1 FROM s WHERE s.ledger = c.ledger AND s.seq = c.seq AND s.hash <> c.hash)
    UNION ALL
    SELECT ledger, seq, 'unfinished_earlier' FROM c
    WHERE EXISTS (SELECT 1 FROM s WHERE s.ledger = c.ledger AND s.seq < c.seq AND NOT whole)""")
def release_order_violations(spark: SparkSession, folder: str) -> DataFrame:
    return L.release_order_violations(_state(spark, folder), _completions(spark, folder), _candidates(spark, folder),
                                      TERMINAL_TASKS, ["ledger"])


@query("L1", """
    SELECT o_custkey AS ledger, o_orderkey AS release_seq,
           CASE WHEN o_orderstatus = 'O' AND month(o_orderdate) <> 12 THEN 'no_attempt' ELSE 'not_prepared' END AS violation
    FROM orders
    WHERE NOT (o_orderstatus = 'O' AND month(o_orderdate) <> 12 AND o_orderpriority <> '5-LOW')
    UNION ALL
    SELECT c_custkey, -1, 'not_prepared' FROM customer""")
def run_gate_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Every order tries to run, those of December with another scope; so does an unknown release."""
    orders = read_table(spark, folder, "orders")
    year = F.year("o_orderdate").cast("bigint")
    scope = F.when(F.month("o_orderdate") == 12, year + 1).otherwise(year)
    runs = orders.select(C("o_custkey").alias("ledger"), C("o_orderkey").alias("release_seq"), scope.alias("min_season"))
    unknown = read_table(spark, folder, "customer").select(
        C("c_custkey").alias("ledger"), F.lit(-1).cast("bigint").alias("release_seq"),
        F.lit(1995).cast("bigint").alias("min_season"))
    return L.run_gate_violations(_state(spark, folder), runs.unionByName(unknown), ["ledger"])


@query("L2 S9", """
    SELECT o_custkey AS ledger, o_orderkey AS release_seq,
           CASE WHEN o_orderpriority <> '5-LOW' THEN 'current' END AS attempt_id, l_returnflag AS task_key
    FROM orders JOIN (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem) ON l_orderkey = o_orderkey
    WHERE o_orderstatus = 'O'
    UNION ALL
    SELECT o_custkey, o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN 'current' END, 'gold' FROM orders
    WHERE o_orderstatus = 'O'""")
def completion_markers(spark: SparkSession, folder: str) -> DataFrame:
    """Markers of finished tasks appended to a stored table in two runs, then read back."""
    state = _state(spark, folder)
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", C("l_returnflag").alias("task_key")).distinct()
    first = lines.join(state.select("ledger", "release_seq"), C("l_orderkey") == C("release_seq")).select(
        "ledger", "release_seq", "task_key")
    second = state.select("ledger", "release_seq", F.lit("gold").alias("task_key"))
    path = scratch(spark, "markers")
    for tasks in (first, second):
        L.completion_markers(state, tasks, ["ledger"]).write.mode("append").parquet(path)
    return spark.read.parquet(path)


@query("L4", f"""
    WITH {_STATE}
    SELECT ledger, seq AS release_seq, top_scope AS previous_min_season, scope AS min_season,
           top_attempt AS previous_attempt_id, attempt AS attempt_id
    FROM c WHERE scope <> top_scope""")
def scope_expansion_audit(spark: SparkSession, folder: str) -> DataFrame:
    return L.scope_expansions(_state(spark, folder), _candidates(spark, folder), ["ledger"])


@query("L5", f"""
    WITH {_STATE}
    SELECT ledger, c.seq AS release_seq, 'rollback' AS violation FROM c
    WHERE (SELECT max(seq) FROM s WHERE s.ledger = c.ledger) > c.seq
    UNION ALL
    SELECT ledger, seq, 'unfinished_earlier' FROM c
    WHERE (SELECT count(*) FROM s WHERE s.ledger = c.ledger AND s.seq < c.seq AND status <> 'COMPLETE') > 0
    UNION ALL
    SELECT ledger, seq, 'scope_change' FROM c
    WHERE (SELECT count(*) FROM s WHERE s.ledger = c.ledger AND s.scope <> c.scope) > 0""")
def simple_guard_violations(spark: SparkSession, folder: str) -> DataFrame:
    return L.simple_guard_violations(_state(spark, folder), _candidates(spark, folder), ["ledger"])

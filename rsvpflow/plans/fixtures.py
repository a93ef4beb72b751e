"""Fixture views derived from the driver's TPC-H-ish tables.

The master fixture is one portable SQL text (Spark 4.1 and DuckDB give identical
rows).  ``{orders}``, ``{customer}``, ``{nation}`` are placeholders: Spark binds
DataFrames through ``spark.sql(text, orders=df, ...)``; the DuckDB oracle substitutes
view names.  Every fixture therefore grows with the driver tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rsvpflow.sources.tables import read_table

MASTER_SQL = """
SELECT o.o_orderkey AS id,
 CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE c.c_name || ' o''neil & sons-' || CAST(o.o_orderkey AS STRING) END AS Client_Name,
 CASE WHEN o.o_orderkey % 41 = 0 THEN NULL ELSE lower(substr(o.o_orderpriority, 3)) END AS Practice_Head,
 CASE WHEN o.o_orderkey % 43 = 0 THEN NULL ELSE ' ' || n.n_name || ' ' END AS Partner,
 lower(c.c_mktsegment) AS Sector,
 CASE WHEN o.o_orderkey % 71 = 0 THEN chr(9) || 'pune' || chr(160) ELSE CASE o.o_custkey % 9 WHEN 0 THEN 'Navi Mumbai' WHEN 1 THEN 'new delhi' WHEN 2 THEN 'Bangalore' WHEN 3 THEN 'KOLKATA' WHEN 4 THEN 'Paris' WHEN 5 THEN 'Kota Bangalore' WHEN 6 THEN NULL WHEN 7 THEN ' Pune ' ELSE 'vapi' END END AS Location,
 o.o_orderstatus AS Invite_Status,
 CASE WHEN o.o_orderkey % 13 = 0 THEN 'not a date' WHEN o.o_orderkey % 17 = 0 THEN NULL WHEN o.o_orderkey % 19 = 0 THEN '12/25/2024' WHEN o.o_orderkey % 23 = 0 THEN '05-03-2024' WHEN o.o_orderkey % 29 = 0 THEN ' 25-Dec-2024' WHEN o.o_orderkey % 31 = 0 THEN substr(CAST(o.o_orderdate AS STRING), 1, 10) || 'T10:11:12' WHEN o.o_orderkey % 37 = 0 THEN '25-12-2024' ELSE substr(CAST(o.o_orderdate AS STRING), 1, 10) END AS Invite_Dt,
 CASE WHEN o.o_orderkey % 5 = 0 THEN substr(CAST(o.o_orderdate AS STRING), 1, 10) END AS Circle_Back_Dt,
 CASE o.o_orderkey % 11 WHEN 0 THEN 'abc' WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN '4.9' WHEN 4 THEN ' 12 ' ELSE CAST(o.o_orderkey % 20 AS STRING) END AS numInvitees,
 CASE o.o_orderkey % 6 WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN '2' WHEN 3 THEN ' 1' WHEN 4 THEN '1x' ELSE NULL END AS numRegistrations,
 CASE WHEN o.o_orderkey % 59 = 0 THEN chr(9) || '2 positive' || chr(9) WHEN o.o_orderkey % 61 = 0 THEN 'Registered' || chr(160) WHEN o.o_orderkey % 67 = 0 THEN '3' || chr(160) || 'positive' ELSE CASE o.o_orderkey % 8 WHEN 0 THEN '2 positive' WHEN 1 THEN 'Positive' WHEN 2 THEN 'Awaited' WHEN 3 THEN 'awaited' WHEN 4 THEN NULL WHEN 5 THEN '3  Negative' WHEN 6 THEN 'Registered' ELSE '0 Positive' END END AS Response,
 'Tax ' || CAST(o.o_custkey AS STRING) AS Tax_Contact,
 CASE WHEN o.o_orderkey % 3 = 0 THEN NULL ELSE 'VP, Tax; India' END AS Designation,
 't' || CAST(o.o_custkey AS STRING) || '@x.test' AS Email_ID,
 CASE o.o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE '+91-' || CAST(o.o_custkey AS STRING) END AS Phone_Number,
 CASE o.o_orderkey % 5 WHEN 0 THEN 'Registered' WHEN 1 THEN ' registered ' WHEN 2 THEN 'Positive' WHEN 3 THEN '-1 No' ELSE CASE WHEN o.o_orderkey % 3 = 0 THEN chr(9) || 'positive' || chr(160) END END AS Response_1,
 CASE WHEN o.o_orderkey % 10 = 0 THEN NULL ELSE 'Cfo ' || CAST(o.o_orderkey AS STRING) END AS CFO_Name,
 'CFO' AS Designation_2,
 CASE WHEN o.o_orderkey % 4 = 0 THEN NULL ELSE 'c' || CAST(o.o_orderkey AS STRING) || '@x.test' END AS Email_ID_3,
 CASE WHEN o.o_orderkey % 3 = 0 THEN '+44-' || CAST(o.o_orderkey % 500 AS STRING) END AS Phone_Number_4,
 CASE o.o_orderkey % 4 WHEN 0 THEN 'Chennai' WHEN 1 THEN 'gurugram' WHEN 2 THEN NULL ELSE 'Odisha' END AS Location_6,
 CASE o.o_orderkey % 4 WHEN 0 THEN 'registered' WHEN 1 THEN 'POSITIVE' WHEN 2 THEN '0' ELSE 'Declined' END AS Response_7,
 CASE WHEN o.o_orderkey % 5 = 0 THEN 'Other ' || CAST(o.o_orderkey AS STRING) END AS Others,
 'Manager' AS Designation_8,
 'o' || CAST(o.o_orderkey AS STRING) || '@x.test' AS Email_ID_9,
 CASE WHEN o.o_orderkey % 5 < 2 THEN '+1-' || CAST(o.o_orderkey AS STRING) ELSE '' END AS Phone_Number_10,
 CASE o.o_orderkey % 3 WHEN 0 THEN 'Surat' WHEN 1 THEN 'Noida Sector 5' ELSE 'London' END AS Location_12,
 CASE o.o_orderkey % 3 WHEN 0 THEN 'Registered' WHEN 1 THEN NULL ELSE 'positive' END AS Response_13
FROM {orders} o
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
"""

# Change feed (op I/U/D with seq): every master row is inserted with seq = id, then
# with seq = id + CHANGE_OFFSET (above every id): id%10=1 tax phone changed, id%10=2 cfo phone NULL -> value,
# id%10=4 tax phone value -> '', id%10=5 only attributes changed; id%10=6 deleted.
CHANGE_OFFSET = 1 << 62


#: Input rows that one task of a spread input takes at most (about): a master row is widened to more than a kilobyte, its
#: change events to several, and tasks sort and aggregate them before they shuffle.
TASK_ROWS = 100_000


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin an input that has fewer scan splits than the cluster has cores, or than its rows ask for.

    A single-row-group file is one scan task, so every per-row expression above it
    would run on one core; and a split of narrow rows makes a far larger task once they are widened.  Inputs with enough
    splits for both are returned untouched.
    """
    spark = df.sparkSession
    want = min_partitions or max(spark.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS))
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want)


#: Columns of a customer that a master row takes.
CUSTOMER_COLS = ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


def by_customer(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """The orders as the join with the customers wants them: spread, or, where that join is too large to be broadcast and shuffles
    both sides, dealt by customer at once.  That is one shuffle of the orders instead of two, and tasks of ``TASK_ROWS`` behind
    the join, which would else be made anew by the narrow rows' bytes and hold millions of rows to widen."""
    spark = orders.sparkSession
    sent = customer.select(*CUSTOMER_COLS)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if int(str(sent)) <= spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold():
        return spread(orders)
    want = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-orders.count() // TASK_ROWS))
    return orders.repartition(want, "o_custkey")


def master_from(spark: SparkSession, orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    return spark.sql(MASTER_SQL, orders=orders, customer=customer, nation=nation)


def master(spark: SparkSession, base: str) -> DataFrame:
    """The wide master fixture (one row per order)."""
    customer = read_table(spark, base, "customer")
    return master_from(spark, by_customer(read_table(spark, base, "orders"), customer), customer, read_table(spark, base, "nation"))


def sync_pair(m: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(target, source) for the sync operators: inserts id%10=3, deletes id%10=7,
    updates id%4=0 (target Response replaced by 'Old')."""
    target = m.filter(F.col("id") % 10 != 3).withColumn(
        "Response", F.when(F.col("id") % 4 == 0, F.lit("Old")).otherwise(F.col("Response")))
    source = m.filter(F.col("id") % 10 != 7)
    return target, source


def _changed_cols(m: DataFrame) -> list:
    """Column expressions of the NEW image of every row the feed updates."""
    i = F.col("id")
    k = i % 10
    cols = {
        "Phone_Number": F.when(k == 1, F.concat(F.lit("+91-9"), i.cast("string")))
                         .when(k == 4, F.lit("")).otherwise(F.col("Phone_Number")),
        "Phone_Number_4": F.when(k == 2, F.coalesce(F.col("Phone_Number_4"),
                                                    F.concat(F.lit("+44-8"), i.cast("string"))))
                           .otherwise(F.col("Phone_Number_4")),
        "Practice_Head": F.when(k == 5, F.lit("changed head")).otherwise(F.col("Practice_Head")),
        "Response_1": F.when(k == 5, F.lit("Registered")).otherwise(F.col("Response_1")),
    }
    return [cols.get(c, F.col(c)).alias(c) for c in m.columns]


def changed_row(m: DataFrame) -> DataFrame:
    """The NEW image of every row (same columns as ``m``)."""
    return m.select(*_changed_cols(m))


def change_feed(m: DataFrame) -> DataFrame:
    """Change events ``(seq, op, id, old, new)`` with full-row images as structs.

    One narrow pass over the master: each row emits its I event and, for the
    changed/deleted ids, a U or D event (``explode`` of a per-row event array).
    """
    old = F.struct(*[F.col(c) for c in m.columns])
    new = F.struct(*_changed_cols(m))
    k = F.col("id") % 10
    null_row = F.lit(None).cast(m.select(old.alias("r")).schema["r"].dataType)
    ev = lambda seq, op, o, n: F.struct(seq.alias("seq"), F.lit(op).alias("op"), o.alias("old"), n.alias("new"))
    later = F.col("id") + F.lit(CHANGE_OFFSET).cast("bigint")
    events = F.array(
        ev(F.col("id"), "I", null_row, old),
        F.when(k.isin(1, 2, 4, 5), ev(later, "U", old, new)).when(k == 6, ev(later, "D", old, null_row)),
    )
    return (m.select("id", F.explode(F.filter(events, lambda e: e.isNotNull())).alias("e"))
             .select("e.seq", "e.op", "id", "e.old", "e.new"))


def late_inserts(feed: DataFrame) -> DataFrame:
    """The feed with the inserts of every third id behind all updates and deletes."""
    late = (F.col("op") == "I") & (F.col("id") % 3 == 1)
    return feed.withColumn("seq", F.when(late, F.col("seq") + F.lit(CHANGE_OFFSET + (CHANGE_OFFSET >> 1)).cast("bigint")).otherwise(F.col("seq")))


#: Event time of a timed feed: a moment of one day by id, updates and deletes a month later (``{id}`` the row's id).
EVENT_TIME = "TIMESTAMP_NTZ '2025-01-01 00:00:00' + make_dt_interval({day}, 0, 0, CAST({id} % 86400 AS INT))"


def timed(feed: DataFrame) -> DataFrame:
    """The feed with the time ``ts`` of each event."""
    first, later = (F.expr(EVENT_TIME.format(day=d, id="id")) for d in (0, 31))
    return feed.withColumn("ts", F.when(F.col("seq") >= CHANGE_OFFSET, later).otherwise(first))


#: Master rows whose events one file of ``mixed_batches`` holds at most (about).
FILE_ROWS = 100_000


def mixed_batches(spark: SparkSession, feed: DataFrame, path: str, rows: int = 0) -> DataFrame:
    """The feed as a stream of five batches: the updates and deletes of a row come before its insert.

    A batch is a file, or with more than ``FILE_ROWS`` of the feed's ``rows`` master rows to a batch as many files as it takes,
    so that no task writes or reads a fifth of a large feed."""
    files = max(1, -(-rows // (3 * FILE_ROWS)))
    feed.filter(F.col("seq") >= CHANGE_OFFSET).repartition(2 * files, "id").write.parquet(path)
    feed.filter(F.col("seq") < CHANGE_OFFSET).repartition(3 * files, "id").write.mode("append").parquet(path)
    return spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", files).parquet(path)


def final_master(m: DataFrame) -> DataFrame:
    """Master after the whole change feed (the rebuild oracle)."""
    return changed_row(m).filter(F.col("id") % 10 != 6)

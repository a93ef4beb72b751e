"""Composed jobs (snapshots, write-then-swap) and streaming == batch."""

from pyspark.sql import functions as F

from rsvpflow.operators import contacts as C
from rsvpflow.plans import fixtures as X
from rsvpflow.plans import jobs as J
from rsvpflow.session import work_dir
from rsvpflow.streaming.changes import start_change_stream, stream_apply_changes, stream_invite_trend, stream_invite_trend_windowed
from rsvpflow.streaming.deltas import append_changes, compact, current_contacts
from rsvpflow.operators import reports as R
from tests.conftest import SF_SMALL


def same_rows(a, b):
    cols = sorted(a.columns)
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rebuild_then_apply_changes_job(spark):
    m = X.master(spark, SF_SMALL)
    root = work_dir(spark, "contacts")
    J.rebuild_contacts_job(m, root, 0)
    feed = X.change_feed(m).filter(F.col("seq") >= X.CHANGE_OFFSET)
    path = J.apply_changes_job(spark, root, feed, 1)
    assert same_rows(spark.read.parquet(path), C.rebuild_contacts(X.final_master(m)))
    # version 0 is untouched (write-then-swap)
    assert same_rows(spark.read.parquet(f"{root}/v=0"), C.fan_out(m))
    # replaying version 1 gives the same snapshot
    path = J.apply_changes_job(spark, root, feed, 1)
    assert same_rows(spark.read.parquet(path), C.rebuild_contacts(X.final_master(m)))


def test_load_and_sync_first_load(spark):
    m = X.master(spark, SF_SMALL).withColumnRenamed("Client_Name", "Client Name")
    res, counts = J.load_and_sync(spark, m, None, "Client Name", "id", "smart_sync")
    assert "Client_Name" in res.columns
    assert res.count() == m.count()
    assert {r["action"] for r in counts.collect()} == {"inserted"}


def test_reports_bundle(spark):
    m = X.master(spark, SF_SMALL)
    reps = J.reports(m, C.fan_out(m), {"ph": ["Urgent"], "partner": [], "sector": [], "loc": [], "resp": []})
    assert reps["overview"].first()["total_clients"] == m.filter(F.lower("Practice_Head") == "urgent").count()
    assert reps["role_kpis"].count() == 3


def test_stream_changes_equals_batch(spark):
    m = X.master(spark, SF_SMALL)
    assert same_rows(stream_apply_changes(spark, SF_SMALL), C.rebuild_contacts(X.final_master(m)))


def test_stream_trend_equals_batch(spark):
    m = X.master(spark, SF_SMALL)
    assert same_rows(stream_invite_trend(spark, SF_SMALL), R.invite_trend(C.standardize_master(m)))


def test_replicate_empty_source_leaves_target(spark):
    m = X.master(spark, SF_SMALL)
    dst = work_dir(spark, "replica")
    st = J.replicate(spark, {"master": m}, dst).first()
    assert st["status"] == "ok" and st["source_rows"] == st["copied_rows"] == m.count()
    st2 = J.replicate(spark, {"master": m.limit(0)}, dst).first()
    assert st2["status"] == "skipped_empty"
    assert spark.read.parquet(f"{dst}/master").count() == m.count()


def test_delta_table_any_order_replay_and_compaction(spark):
    """Batches in any order, replayed and compacted, equal the rebuild; a delete outlives an older event."""
    m = X.master(spark, SF_SMALL)
    feed = X.change_feed(m)
    root = work_dir(spark, "deltas")
    later, first = feed.filter(F.col("seq") >= X.CHANGE_OFFSET), feed.filter(F.col("seq") < X.CHANGE_OFFSET)
    want = C.rebuild_contacts(X.final_master(m))
    append_changes(spark, root, later.filter("id % 2 = 0"), 0)
    append_changes(spark, root, first, 1)
    assert compact(spark, root) == 1
    append_changes(spark, root, first, 2)  # older events once more
    append_changes(spark, root, later.filter("id % 2 = 1"), 3)
    append_changes(spark, root, later.filter("id % 2 = 1"), 3)  # replay
    assert same_rows(current_contacts(spark, root), want)
    assert compact(spark, root) == 3 and compact(spark, root) == 3
    assert same_rows(current_contacts(spark, root), want)


def test_delta_write_follows_the_batch(spark):
    """A batch of 1 % of the rows writes 1 % of the rows."""
    m = X.master(spark, SF_SMALL)
    feed = X.change_feed(m)
    root = work_dir(spark, "deltas")
    append_changes(spark, root, feed, 0)
    few = feed.filter((F.col("seq") >= X.CHANGE_OFFSET) & (F.col("id") % 100 == 1))
    append_changes(spark, root, few, 1)
    wrote, table = spark.read.parquet(f"{root}/delta/b=1").count(), spark.read.parquet(f"{root}/delta/b=0").count()
    assert wrote == few.select("id").distinct().count() and wrote <= 0.03 * table


def test_change_stream_runs_until_stopped(spark):
    """With a processing-time trigger the running query comes back; T4: a restart goes on from its checkpoint."""
    feed = X.change_feed(X.master(spark, SF_SMALL))
    src, root = work_dir(spark, "feed"), work_dir(spark, "service")
    feed.filter("id % 2 = 0").coalesce(1).write.parquet(src)
    events = spark.readStream.schema(feed.schema).parquet(src)
    q = start_change_stream(spark, events, root, {"processingTime": "1 second"})
    q.processAllAvailable()
    assert q.isActive
    q.stop()
    feed.filter("id % 2 = 1").coalesce(1).write.mode("append").parquet(src)
    q = start_change_stream(spark, events, root, {"processingTime": "1 second"})
    q.processAllAvailable()
    q.stop()
    assert same_rows(current_contacts(spark, f"{root}/table"), C.rebuild_contacts(X.final_master(X.master(spark, SF_SMALL))))


def test_windowed_trend_equals_batch(spark):
    m = X.master(spark, SF_SMALL)
    assert same_rows(stream_invite_trend_windowed(spark, SF_SMALL), R.invite_trend(C.standardize_master(m)))


def test_empty_insert_batch_changes_nothing(spark):
    m = X.master(spark, SF_SMALL)
    table = C.fan_out(m)  # not unique: nothing may be lost all the same
    none = X.change_feed(m).limit(0)
    for policy, keep, client in (("phone", "first", True), ("phone_client", "last", True), ("phone", "last", False)):
        assert same_rows(C.apply_insert(table, none, policy, keep, overwrite_client=client), table)


def test_cards_are_sorted_within_parts(spark):
    """O1: each part file of a role lists its cards by client, then contact."""
    import glob

    d = C.unique_contacts(C.fan_out(X.master(spark, SF_SMALL)), "phone", "first")
    root = work_dir(spark, "export")
    J.export_cards_job(spark, d, f"{root}/ledger", f"{root}/cards", "2025-01-01")
    parts = glob.glob(f"{root.removeprefix('file://')}/cards/batch_id=2025-01-01/role=*/part-*")
    assert parts
    for p in parts:
        cards = [c for c in open(p, encoding="utf-8").read().split("\n\n") if c.strip()]
        clients = [next(x for x in c.split("\n") if x.startswith("N:"))[2:].split(";")[0] for c in cards]
        assert clients == sorted(clients, key=lambda x: (x != "Company", x))


def test_standardize_job_then_reports(spark):
    """Reports over the stored standardised tables equal the on-the-fly path, and the stored
    path pushes the dashboard filter into the Parquet scan."""
    m = X.master(spark, SF_SMALL)
    c = C.fan_out(m)
    root = work_dir(spark, "std")
    pm, pc = J.standardize_job(m, c, root, 1)
    spec = {"ph": ["Urgent", "High"], "partner": [], "sector": [], "loc": [], "resp": []}
    stored = J.reports(spark.read.parquet(pm), spark.read.parquet(pc), spec, standardized=True)
    live = J.reports(m, c, spec)
    for name in ("overview", "role_region", "owner_response", "funnel"):
        assert same_rows(stored[name], live[name]), name
    plan = stored["overview"]._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(Practice_Head" in plan


def test_cli_reports_and_cards(spark):
    """The command line runs in its own session; here only argument wiring and outputs are checked
    by calling the same jobs the CLI calls."""
    import os

    from rsvpflow.__main__ import main  # noqa: F401  (importable)

    m = X.master(spark, SF_SMALL)
    root = work_dir(spark, "cli")
    m.write.parquet(f"{root}/master")
    reps = J.reports(spark.read.parquet(f"{root}/master"), C.fan_out(spark.read.parquet(f"{root}/master")), {})
    from rsvpflow.sources.sinks import export_report
    export_report(reps["overview"], f"{root}/out/overview")
    assert any(f.endswith(".csv") for f in os.listdir(f"{root}/out/overview"))


def test_reports_follow_changes_in_any_order(spark):
    """Batches dealt at random, one of them replayed, with compactions; deletes down to an empty table leave no group."""
    import random

    from rsvpflow.operators.grain import report_grain
    from rsvpflow.streaming.views import append_signed, compact_grain, current_grain

    m = X.master(spark, SF_SMALL).filter("id < 400")
    feed = X.change_feed(m)
    expected = report_grain(C.standardize_master(X.final_master(m)))
    rng = random.Random(7)
    for attempt in range(2):
        root = work_dir(spark, "views")
        parts = [feed.filter(F.pmod(F.hash("seq", F.lit(attempt)), F.lit(5)) == k) for k in rng.sample(range(5), 5)]
        for b, part in enumerate(parts):
            append_signed(spark, root, part, b)
            if b == 1:
                append_signed(spark, root, part, b)
            if b in (1, 3):
                assert compact_grain(spark, root) == b
        assert same_rows(current_grain(spark, root), expected)
    left = X.final_master(m)
    gone = left.select(F.lit(1 << 63 - 1).cast("long").alias("seq"), F.lit("D").alias("op"), "id", F.struct("*").alias("old"),
                       F.lit(None).cast(feed.schema["new"].dataType).alias("new"))
    append_signed(spark, root, gone, 9)
    assert current_grain(spark, root).count() == 0


def test_reader_across_compactions(spark):
    """A frame taken before a compaction still reads; what lies two compactions back is removed."""
    from rsvpflow.streaming.deltas import _numbers, compact

    feed = X.change_feed(X.master(spark, SF_SMALL))
    root = work_dir(spark, "deltas")
    for k in range(3):
        append_changes(spark, root, feed.filter(F.col("id") % 3 == k), k)
    before = current_contacts(spark, root)
    rows = before.count()
    compact(spark, root)
    assert before.count() == rows and current_contacts(spark, root).count() == rows
    append_changes(spark, root, feed.limit(0), 3)
    held = current_contacts(spark, root)
    compact(spark, root)
    assert held.count() == rows and _numbers(spark, f"{root}/base", "v=") == [2, 3] and _numbers(spark, f"{root}/delta", "b=") == [3]


def test_timed_changes_replayed_and_shuffled(spark):
    """Marks do not depend on the order of batches, and a replayed batch counts once; against a plain fold."""
    from rsvpflow.streaming.deltas import change_counts

    m = X.master(spark, SF_SMALL).filter("id < 300")
    feed = X.timed(X.change_feed(m))
    events = sorted(feed.collect(), key=lambda e: e.seq)
    phones = {"tax": "Phone_Number", "cfo": "Phone_Number_4", "other": "Phone_Number_10"}
    state, counts = {}, {}
    from rsvpflow.roles import CLIENT_ATTRS, ROLES
    for e in events:
        for r, ph in phones.items():
            cols = ["id", "Client_Name", *CLIENT_ATTRS, *ROLES[r].master_cols().values()]
            old, new = ([x[c] for c in cols] if x is not None and x[ph] else None for x in (e.old if e.op != "I" else None, e.new if e.op != "D" else None))
            kind = None if old is None and new is None else "inserted" if old is None else "deleted" if new is None else "unchanged" if old == new else "updated"
            if kind:
                counts[r, kind] = counts.get((r, kind), 0) + 1
            if kind == "inserted":
                state[r, e.id] = (e.ts, e.ts)
            elif kind == "updated":
                state[r, e.id] = (state[r, e.id][0], e.ts)
            elif kind == "deleted":
                del state[r, e.id]
    for order in ((0, 1, 2), (2, 0, 1)):
        root = work_dir(spark, "timed")
        for b, k in enumerate(order):
            for _ in range(2 if b == 1 else 1):
                append_changes(spark, root, feed.filter(F.pmod(F.hash("seq"), F.lit(3)) == k), b)
        got = {(r.role, r.id): (r.Data_Insert_Time, r.Last_Updated) for r in current_contacts(spark, root).collect()}
        assert got == state
        said = change_counts(spark, root).groupBy("role", "action").agg(F.sum("row_count").alias("n")).collect()
        assert {(r.role, r.action): r.n for r in said if r.n} == counts


def test_timed_change_job(spark):
    """K3 as a job: snapshots with times, counts beside them; an older event in a later batch changes nothing."""
    m = X.master(spark, SF_SMALL).filter("id < 300")
    feed = X.timed(X.change_feed(m))
    root = work_dir(spark, "timed-job")
    none = F.lit(None).cast("timestamp_ntz")
    J.write_snapshot(C.fan_out(m).limit(0).withColumns({"Data_Insert_Time": none, "Last_Updated": none}), root, 0)
    J.apply_changes_job(spark, root, feed.filter(F.col("seq") < X.CHANGE_OFFSET), 1)
    path = J.apply_changes_job(spark, root, feed.filter(F.col("seq") >= X.CHANGE_OFFSET), 2)
    got = spark.read.parquet(path)
    assert same_rows(got.drop("Data_Insert_Time", "Last_Updated"), C.fan_out(X.final_master(m)))
    assert got.filter("Data_Insert_Time is null or Last_Updated < Data_Insert_Time").count() == 0
    assert same_rows(spark.read.parquet(J.apply_changes_job(spark, root, feed.filter("id % 2 = 0 and op = 'I'"), 3)), got)
    counts = {(r.role, r.action): r.row_count for r in spark.read.parquet(f"{root}/counts/v=1").collect()}
    assert sum(n for (_, k), n in counts.items() if k != "inserted") == 0 and sum(counts.values()) == C.fan_out(m).count()


def test_no_batch_yet(spark):
    from rsvpflow.streaming.changes import stream_report
    from rsvpflow.streaming.views import current_grain

    root = work_dir(spark, "none")
    assert current_contacts(spark, root).count() == 0 and current_grain(spark, root).count() == 0
    # a source folder without files: no batch runs
    for name, cols in (("orders", None), ("customer", None), ("nation", None)):
        df = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
        df.limit(0).coalesce(1).write.parquet(f"{root}/{name}.parquet") if name == "orders" else df.write.parquet(f"{root}/{name}.parquet")
    assert stream_report(spark, root, R.response_weights).count() == 0 and stream_invite_trend_windowed(spark, root).count() == 0


def test_windowed_trend_drops_late_rows(spark):
    """T3 with a real delay: days behind the watermark are closed, a late row for one of them is dropped, state stays bounded."""
    m = X.master(spark, SF_SMALL).filter("id < 40")
    root = work_dir(spark, "late")
    day = lambda d, k: m.filter(F.col("id") % 4 == k).withColumn("Invite_Dt", F.lit(d))
    days = ["2024-01-01", "2024-01-10", "2024-03-01", "2024-02-28", "2024-01-01", "2024-03-02"]
    for k, d in enumerate(days):
        day(d, k % 4).coalesce(1).write.mode("append").parquet(root)
        import time

        time.sleep(1.1)  # files are taken in the order of their times
    events = spark.readStream.schema(m.schema).option("maxFilesPerTrigger", 1).parquet(root)
    got = {str(r.invite_date): r.invites for r in stream_invite_trend_windowed(spark, SF_SMALL, "5 days", events).collect()}
    n = {k: m.filter(F.col("id") % 4 == k).count() for k in range(4)}
    # the second 2024-01-01 comes after 2024-03-01 and is late; 2024-02-28 is within five days
    assert got == {"2024-01-01": n[0], "2024-01-10": n[1], "2024-03-01": n[2], "2024-02-28": n[3], "2024-03-02": n[1]}


def test_batches_of_a_large_feed_are_many_files(spark, monkeypatch):
    """Five batches whatever the size, updates and deletes first; no file holds a fifth of a large feed."""
    from pyspark.sql import functions as F

    from rsvpflow.plans import fixtures as X
    from rsvpflow.session import work_dir

    monkeypatch.setattr(X, "FILE_ROWS", 100)
    feed = spark.range(3000).select(F.explode(F.array(F.col("id"), F.col("id") + F.lit(X.CHANGE_OFFSET))).alias("seq"), "id")
    path = work_dir(spark, "feed")
    events = X.mixed_batches(spark, feed, path, 3000)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 50 and max(sizes) <= 250 and sum(sizes) == 6000
    seen = []
    q = events.writeStream.foreachBatch(lambda b, n: seen.append(b.agg(F.min("seq"), F.count("*")).first())).option(
        "checkpointLocation", work_dir(spark, "at")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert len(seen) == 5 and sum(r[1] for r in seen) == 6000
    assert [r[0] >= X.CHANGE_OFFSET for r in seen] == [True, True, False, False, False]


def test_reports_on_changes_read_the_grain_once(spark, monkeypatch):
    """The reports after a feed are roll-ups of a stored sum, not each a sum of all deltas."""
    from rsvpflow.plans.queries import q_stream_reports_on_changes
    from rsvpflow.streaming import changes as SC
    from tests.conftest import SF_SMALL

    took = []
    monkeypatch.setattr(SC, "reports_from", lambda grain, **kw: took.append(grain.inputFiles()) or SC_reports(grain, **kw))
    SC_reports = __import__("rsvpflow.operators.grain", fromlist=["reports_from"]).reports_from
    assert q_stream_reports_on_changes(spark, SF_SMALL).count() > 0
    assert took == [[]]  # a checkpoint, no delta files


def test_spread_follows_rows(spark, monkeypatch):
    """A short file of many rows is dealt over as many tasks as its rows ask for; nothing is lost."""
    from rsvpflow.plans import fixtures as X

    df = spark.range(0, 1000, 1, 2)
    monkeypatch.setattr(X, "TASK_ROWS", 10)
    out = X.spread(df)
    assert out.rdd.getNumPartitions() == max(100, spark.sparkContext.defaultParallelism)
    assert sorted(r.id for r in out.collect()) == list(range(1000))
    monkeypatch.setattr(X, "TASK_ROWS", 1000)
    assert X.spread(spark.range(0, 1000, 1, 64)).rdd.getNumPartitions() == 64


def test_stored_table_reads_its_contacts_once(spark):
    """The table in use is one pass over the unique contacts, with the rows of both choices."""
    from pyspark.sql import functions as F

    from rsvpflow.operators import contacts as C
    from rsvpflow.plans.queries import _stored
    from rsvpflow.roles import CONTACT_COLS

    rows = [(i, f"+{i % 40}") for i in range(60)] + [(None, "+none")]
    c = spark.createDataFrame(rows, "id long, phone string").select(
        *[F.col(n) if n in ("id", "phone") else F.lit("tax" if n == "role" else "x").alias(n) for n in CONTACT_COLS])
    got = _stored(c, "phone")
    u = C.unique_contacts(c, "phone", "first").select("id", "phone").collect()
    want = [(r.id, r.phone) for r in u if r.id is not None and r.id % 3 == 0] + [(r.id, r.phone + "#") for r in u if r.id is not None and r.id % 5 == 1]
    assert sorted((r.id, r.phone) for r in got.collect()) == sorted(want) and got.columns == list(c.columns)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("windowspecdefinition") == 1

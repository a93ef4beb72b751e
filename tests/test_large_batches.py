"""Batches and tables too large to be broadcast: the same rows as small ones, each shuffled once, and no shuffle files left behind."""

import re
import time
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from rsvpflow.operators import audit as A
from rsvpflow.operators import bags as B
from rsvpflow.operators import contacts as C
from rsvpflow.operators import joins as JN
from rsvpflow.plans import fixtures as X
from rsvpflow.plans import queries as Q
from rsvpflow.roles import CONTACT_COLS
from tests.conftest import SF_SMALL
from tests.test_merge_bruteforce import sim_strict
from tests.test_ordered import made_feed

NONE_SMALL = {JN.BROADCAST_MAX_ROWS_CONF: "1", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@contextmanager
def nothing_small(spark):
    for k, v in NONE_SMALL.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in NONE_SMALL:
            spark.conf.unset(k)


def shuffled(df, column):
    """Exchanges by key of the plan that carry the column or its copy for a join."""
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    inputs = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hashpartitioning", text)
    return sum(bool(re.search(rf"\b(__n_)?{column}#", cols)) for cols in inputs)


def bag(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def contact(role, i, client, phone, name, **more):
    return {c: None for c in CONTACT_COLS} | dict(role=role, id=i, client=client, phone=phone, name=name, **more)


def table(spark, rows, more=()):
    kinds = {f.name: f.dataType.simpleString() for f in C.fan_out(X.master(spark, SF_SMALL)).schema} | dict(more)
    cols = [*CONTACT_COLS, *[c for c, _ in more]]
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], ", ".join(f"{c} {kinds[c]}" for c in cols)).repartition(3)


STORED = [contact("tax", 1, "A", "hot", "s1"), contact("tax", 2, "B", "p1", "s2"), contact("tax", 3, None, "p1", "s3"), contact("tax", 3, None, "p1", "s3"),
          contact("tax", 901, "Z", "p9", "s4"), contact("cfo", 1, "A", "hot", "s5"), contact("tax", 902, "A", "", "s6"), contact("tax", None, "D", "p2", "s7")]


def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(k).getName() for k in range(files.size())) if n.startswith("shuffle_")}


@pytest.mark.parametrize("keep", [JN.materialized, JN.written])
def test_kept_tables_leave_no_shuffle_files(spark, keep):
    df = spark.range(5000).groupBy((F.col("id") % 700).alias("k")).agg(F.max("id").alias("m"), F.collect_set(F.col("id") % 3).alias("s"))
    before = shuffle_files(spark)
    kept = keep(df)
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert kept.count() == 700 and kept.agg(F.sum("m")).first()[0] == sum(range(4300, 5000))
    assert spark.conf.get(JN.SHUFFLE_CLEANUP_CONF) == "false" and df.count() == 700 and df.count() == 700


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_of_a_large_batch(spark, seed):
    """Stored times of contacts that come more than once, of none and of NULL ids; wide contacts are shuffled once, for the anti join."""
    times = [("Data_Insert_Time", "timestamp_ntz"), ("Last_Updated", "timestamp_ntz")]
    feed = X.timed(made_feed(spark, 60, seed)[0])
    later = feed.filter("seq > 300")  # most of these rows are in the table already
    none = F.lit(None).cast("timestamp_ntz")
    first, _ = A.apply_changes_audit(table(spark, STORED).withColumns({n: none for n, _ in times}), feed.filter("seq <= 300"))
    first = table(spark, [r.asDict() for r in first.collect()] * 2, times)
    small, few = A.apply_changes_audit(first, later)
    want, counts = bag(small), bag(few)
    with nothing_small(spark):
        large, many = A.apply_changes_audit(first, later)
        assert shuffled(large, "designation") == 1
        assert bag(large) == want and bag(many) == counts
    # one new row for each stored one of its role and id, with that one's time where the batch gives none
    old = {}
    for r in first.collect():
        old.setdefault((r.role, r.id), []).append(r.Data_Insert_Time)
    touched = {r.id for r in later.select("id").distinct().collect()}
    marks = {r.id: r for r in A.timed_rows(later).collect()}
    got = {}
    for r in small.collect():
        got.setdefault((r.role, r.id), []).append(r.Data_Insert_Time)
    for i in touched:
        for c in marks[i].contacts:
            at = marks[i][f"ins_{c.role}"]
            assert sorted(map(str, got.pop((c.role, i)))) == sorted(str(at.ts if at else t) for t in old.get((c.role, i), [None]))
    assert got == {k: v for k, v in old.items() if k[1] not in touched}


def test_bits_keep_all_that_are_among_the_keys(spark):
    df = spark.range(4000).selectExpr("if(id % 10 = 3, null, concat('k', id % 500)) as k", "id % 8 as at", "id as n", "repeat('w', 20) as wide")
    keys = spark.createDataFrame([(None, 3), ("k20", 4), ("k21", 5), ("k20", 5), ("none", 1)], "k string, at long")
    got = B.maybe_among(df, keys, ["k", "at"])
    among = df.join(keys.withColumnsRenamed({"k": "__k", "at": "__at"}), F.expr("k <=> __k and at = __at"), "left_semi")
    assert bag(got) == bag(among) and among.filter("k is null").count() > 0 and got.columns == df.columns
    assert "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
    assert B.maybe_among(df, keys.limit(0), ["k", "at"]).count() == 0


@pytest.mark.parametrize("seed", [4, 5])
def test_strict_feed_of_many_keys(spark, monkeypatch, seed):
    """Of the events' columns only those of events that stay are shuffled, and what decides that leaves no shuffle behind."""
    seen, among = [], C.maybe_among

    def counted(df, keys, key):
        out = among(df, keys, key)
        seen.append((df.count(), out.count(), keys.count()))
        return out

    monkeypatch.setattr(C, "maybe_among", counted)
    feed, events = made_feed(spark, 300, seed)
    empty = C.fan_out(X.master(spark, SF_SMALL)).limit(0)
    with nothing_small(spark):
        got = C.apply_changes_by_phone(empty, feed, roles=("tax",), strict_reference=True)
        rows = sorted(((r.phone, r.client, r.id, r.name) for r in got.collect()), key=str)
        plan = got._jdf.queryExecution().executedPlan().toString()
    assert rows == sim_strict(events)
    [(n, left, kept)] = seen
    assert left == kept < n / 2
    assert "SortMergeJoin" not in plan.split("Union")[-1]  # the marks of what stays were computed before


@pytest.mark.parametrize("policy,keep,overwrite", [("phone_client", "last", True), ("phone_client", "first", True), ("phone", "last", True),
                                                   ("phone", "first", True), ("phone", "last", False)])
def test_inserts_of_a_large_batch(spark, monkeypatch, policy, keep, overwrite):
    """The batch is not written down to be checked; its rows and the table's are shuffled once each."""
    feed, _ = made_feed(spark, 200, 7)
    stored = table(spark, STORED)
    small = bag(C.apply_insert(stored, feed, policy, keep, overwrite_client=overwrite))

    def no(df):
        raise AssertionError("written down")

    monkeypatch.setattr(C, "materialized", no)
    with nothing_small(spark):
        large = C.apply_insert(stored, feed, policy, keep, overwrite_client=overwrite)
        assert shuffled(large, "designation") == (2 if keep == "last" and overwrite else 1)
        assert bag(large) == small
    key = (lambda r: (r.role, r.phone)) if policy == "phone" else (lambda r: (r.role, r.phone, r.client))
    new, had = {}, {}
    for s in sorted(feed.filter("op = 'I' and new.Phone_Number <> ''").collect(), key=lambda s: s.seq):
        k = ("tax", s.new.Phone_Number) if policy == "phone" else ("tax", s.new.Phone_Number, s.new.Client_Name)
        new.setdefault(k, []).append((s.new.id, s.new.Client_Name))
    for r in stored.collect():
        had.setdefault(key(r), []).append((r.id, r.client))
    got = {}
    for r in large.collect():
        got.setdefault(key(r), []).append((r.id, r.client))
    for k in new.keys() | had.keys():
        n, h = new.get(k, []), had.get(k, [])
        if None in k:
            want = n + h
        elif keep == "first":
            want = h or n[:1]
        else:
            last = n[-1] if n else None
            want = h if not n else [(last[0], last[1] if overwrite else c) for _, c in (h or n[:1])]
        assert sorted(got[k], key=str) == sorted(want, key=str), k


def test_master_deals_orders_once(spark, tmp_path):
    """With customers too many to be broadcast the orders are shuffled once, into tasks of bounded rows behind the join too."""
    orders = spark.range(3000).selectExpr("id as o_orderkey", "if(id % 50 = 7, null, id % 90) as o_custkey", "'O' as o_orderstatus", "1.0 as o_totalprice",
                                          "timestamp_ntz '1998-02-06 00:00:00' as o_orderdate", "'5-LOW' as o_orderpriority")
    customer = spark.range(80).selectExpr("id as c_custkey", "concat('Customer#', id) as c_name", "id % 5 as c_nationkey", "1.0 as c_acctbal", "'FURNITURE' as c_mktsegment")
    nation = spark.range(5).selectExpr("id as n_nationkey", "concat('N', id) as n_name", "id as n_regionkey")
    for name, df in (("orders", orders), ("customer", customer), ("nation", nation)):
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    small = X.master(spark, str(tmp_path))
    assert "RoundRobin" in small._jdf.queryExecution().executedPlan().toString()
    want = bag(small)
    with nothing_small(spark):
        large = X.master(spark, str(tmp_path))
        plan = large._jdf.queryExecution().executedPlan().toString()
        assert "RoundRobin" not in plan and plan.count("Exchange hashpartitioning(o_custkey") == 1
        assert bag(large) == want and len(want) == 3000 - sum(i % 50 == 7 or i % 90 >= 80 for i in range(3000))


@pytest.mark.parametrize("policy", ["phone", "phone_client"])
def test_stored_shuffles_columns_of_its_rows_only(spark, policy):
    rows = [contact(r, i, None if i % 7 == 0 else f"c{i % 4}", f"p{i % 11}", f"n{i}", email=f"e{i}", designation="d") for i in range(200) for r in ("tax", "cfo")]
    rows += [contact("tax", None, "c1", "p1", "n"), *rows[:20]]
    got = bag(Q._stored(table(spark, rows), policy))
    seen, want = set(), []
    for r in sorted(rows, key=lambda r: (r["id"] is not None, r["id"] or 0)):
        k = (r["role"], r["phone"]) if policy == "phone" else (r["role"], r["phone"], r["client"])
        if None not in k and k in seen:
            continue
        seen.add(k)
        if r["id"] is not None:
            want += [r | {"designation": "stored", "phone": p} for p in [r["phone"]] * (r["id"] % 3 == 0) + [r["phone"] + "#"] * (r["id"] % 5 == 1)]
    assert got == sorted((tuple(r[c] for c in sorted(CONTACT_COLS)) for r in want), key=str)

"""Bags, changed-only copies, collated keys, reserved column names, place tables, quarantined scans."""

import glob
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rsvpflow.operators import bags as B
from rsvpflow.operators import contacts as C
from rsvpflow.operators import merge as M
from rsvpflow.operators import places as P
from rsvpflow.operators import quality as Q
from rsvpflow.operators.joins import BROADCAST_MAX_ROWS_CONF
from rsvpflow.session import work_dir
from rsvpflow.sources import sinks as SK
from rsvpflow.sources import tables as T

ROW = "role string, id long, phone string, name string, note string"


def bag_rows(rng, n):
    v = lambda *xs: rng.choice(xs)
    return [(v("tax", "cfo"), v(1, 2, 3, None), v("p", "q", None, ""), v("x", None, ""), v("x", None, "y")) for _ in range(n)]


@pytest.mark.parametrize("buckets", [1, 3, 4096])
def test_bags_match_counting(spark, buckets):
    rng = random.Random(buckets)
    hot = [("tax", 9, "hot", "x", None)] * 300
    a, b = bag_rows(rng, 120) + hot, bag_rows(rng, 120) + hot[:-1] + [("tax", 9, "hot", None, "x")]
    got = Q.reconcile_bags(spark.createDataFrame(a, ROW), spark.createDataFrame(b, ROW), buckets=buckets).collect()
    ca, cb = Counter(a), Counter(b)
    want = {k: (ca[k], cb[k]) for k in ca | cb if ca[k] != cb[k]}
    assert {tuple(r)[:5]: (r.n_expected, r.n_derived) for r in got} == want
    assert {r.side for r in got} <= {"missing_in_derived", "extra_in_derived", "copies"} and want["tax", 9, "hot", "x", None] == (300, 299)


def test_doubled_and_equal_tables(spark):
    rows = spark.createDataFrame(bag_rows(random.Random(1), 50), ROW).distinct()
    assert Q.reconcile_bags(rows, rows.unionByName(rows)).count() == rows.count()
    assert Q.reconcile_bags(rows, rows.repartition(7)).count() == 0
    assert Q.reconcile_bags(rows.limit(0), rows.limit(0)).count() == 0
    assert Q.reconcile_bags(rows.limit(0), rows).filter("side = 'extra_in_derived'").count() == rows.count()


def test_equal_tables_shuffle_digests_only(spark):
    rows = spark.createDataFrame(bag_rows(random.Random(1), 50), ROW)
    plan = B.bucket_digests(rows.withColumn("b", B.bucket_of(["id"], 8)), rows.columns, ["b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(b#") == 1 and plan.count("Exchange") == 1


def test_many_differing_buckets_shuffle_no_other_rows(spark):
    """More buckets differ than a key set of the session may have rows: which ones is still sent as bits, not joined by a shuffle."""
    a = [("tax", i, "p", "x", None) for i in range(300)]
    b = [("tax", i, "p", "x" if i % 3 else "y", None) for i in range(300)] + a[:5]
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(BROADCAST_MAX_ROWS_CONF, "3")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = B.bag_differences(spark.createDataFrame(a, ROW), spark.createDataFrame(b, ROW), ["id"], buckets=2)
        plan = got._jdf.queryExecution().executedPlan().toString()
        rows = got.collect()
    finally:
        spark.conf.unset(BROADCAST_MAX_ROWS_CONF)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)
    ca, cb = Counter(a), Counter(b)
    assert {tuple(r)[:5]: (r.n_expected, r.n_derived) for r in rows} == {k: (ca[k], cb[k]) for k in ca | cb if ca[k] != cb[k]}
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan


def test_rows_differ_by_where_a_null_stands(spark):
    key, schema = ["role", "id", "phone"], ROW
    a = spark.createDataFrame([("tax", 1, "p", "x", None)], schema)
    b = spark.createDataFrame([("tax", 1, "p", None, "x")], schema)
    assert [r.side for r in Q.reconcile_rows(a, b, key).collect()] == ["changed"]


def files(dst):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{dst.removeprefix('file://')}/bucket=*/part-*")}


def test_only_changed_buckets_are_written(spark):
    src = spark.range(2000).selectExpr("id", "concat('k', id) as k", "id % 7 as v", "case when id % 5 = 0 then null else 'n' end as w", "'b' as other")
    dst = work_dir(spark, "replica")
    first = SK.replicate_changed(spark, src, dst, "t", ["k"], buckets=16).first()
    assert (first.status, first.buckets, first.buckets_written, first.copied_rows) == ("ok", 16, 16, 2000)
    before = files(dst)
    again = SK.replicate_changed(spark, src, dst, "t", ["k"], buckets=16).first()
    assert again.buckets_written == 0 and again.copied_rows == 0 and files(dst) == before
    # one row changed, one copied, one gone: at most three buckets are new files, all others are the same files
    touched = src.filter("id <> 11").withColumn("v", F.when(F.col("id") == 5, F.lit(99)).otherwise(F.col("v"))).unionByName(src.filter("id = 17"))
    st = SK.replicate_changed(spark, touched, dst, "t", ["k"], buckets=16, rows_per_file=20).first()
    after = files(dst)
    same = {f for f in before if after.get(f) == before[f]}
    assert st.status == "ok" and 1 <= st.buckets_written <= 3 and len({os.path.dirname(f) for f in before} - {os.path.dirname(f) for f in same}) == st.buckets_written
    got = Counter(map(tuple, spark.read.parquet(dst).select("k", "v", "w", "other").collect()))
    assert got == Counter(map(tuple, touched.select("k", "v", "w", "other").collect()))
    # most rows gone: their buckets go; an empty source changes nothing
    few = touched.filter("id < 3")
    assert SK.replicate_changed(spark, few, dst, "t", ["k"], buckets=16).first().status == "ok"
    assert spark.read.parquet(dst).count() == 3
    assert SK.replicate_changed(spark, few.limit(0), dst, "t", ["k"], buckets=16).first().status == "skipped_empty"
    # another number of buckets or a lost folder: made again
    assert SK.replicate_changed(spark, src, dst, "t", ["k"], buckets=4).first().buckets_written == 4
    assert spark.read.parquet(dst).count() == 2000


def test_a_column_called_bucket(spark):
    src = spark.range(20).selectExpr("id", "id % 3 as bucket")
    dst = work_dir(spark, "replica")
    assert SK.replicate_changed(spark, src, dst, "t", ["id"], buckets=4).first().status == "ok"
    assert Counter(r.bucket for r in spark.read.parquet(dst).collect()) == Counter(i % 3 for i in range(20))


def test_empty_lists(spark):
    assert SK.replicate(spark, {}, work_dir(spark, "r")).count() == 0 and T.path_inventory(spark, "/root/testdata/sf0.001", []).count() == 0


RESERVED = ["_action", "__rn", "__k0", "__j0", "__m", "__ts", "__k", "t_k", "s_k"]


def test_columns_with_reserved_names(spark):
    cols = ["k", "seq", *RESERVED]
    make = lambda rows: spark.createDataFrame([(k, s, *[f"{c}{s}" for c in RESERVED]) for k, s in rows], f"k string, seq long, {', '.join(f'`{c}` string' for c in RESERVED)}")
    t, s = make([("a", 1), ("b", 2), (None, 3)]), make([("b", 10), ("b", 11), ("c", 12), (None, 13)])
    keys = lambda df: sorted(((r.k, r.seq) for r in df.select("k", "seq").collect()), key=str)
    assert M.upsert(t, s, "k", "seq").columns == cols
    assert keys(M.upsert(t, s, "k", "seq")) == sorted([("a", 1), ("b", 11), ("c", 12), (None, 3), (None, 13)], key=str)
    assert keys(M.smart_sync(t, s, "k", "seq")) == sorted([("b", 11), ("c", 12), (None, 3), (None, 13)], key=str)
    assert keys(M.insert_new_only(t, s, "k", "seq")) == sorted([("a", 1), ("b", 2), ("c", 12), (None, 3), (None, 13)], key=str)
    assert keys(M.keep_per_key(s, "k", "seq", "last")) == sorted([("b", 11), ("c", 12), (None, 13)], key=str)
    assert [r.k for r in M.deleted_keys(t, s, "k").collect()] == ["a"]
    assert [r[0] for r in M.deleted_keys(t.withColumnRenamed("k", "kk").withColumnRenamed("__k", "k"), s.withColumnRenamed("k", "kk").withColumnRenamed("__k", "k"), "k")
            .collect()] and M.upsert(t, s, "__k", "seq").count() == 7
    with pytest.raises(ValueError):
        M.sync_with_actions(t, s, "k", "seq")
    acts = M.sync_with_actions(t, s, "k", "seq", action_col="what")
    assert {(r.action, r.row_count) for r in M.sync_action_counts(acts, "what").collect()} == {("inserted", 2), ("updated", 1), ("kept", 1), ("kept_null_key", 1)}
    from rsvpflow.plans.jobs import load_and_sync
    res, counts = load_and_sync(spark, s, t, "k", "seq", "upsert")
    assert res.count() == 5 and counts.filter("action = 'updated'").first().row_count == 1


def test_keys_under_a_collation(spark):
    t = spark.createDataFrame([("MÜLLER", 1), ("josé", 2), ("zoe", 3), (None, 4)], "k string, seq long")
    s = spark.createDataFrame([("Muller", 10), ("müller", 11), ("JOSE", 12), ("Ada", 13), ("ÁDA", 14), (None, 15)], "k string, seq long")
    ci = "UNICODE_CI_AI"
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    assert rows(M.upsert(t, s, "k", "seq", ci)) == sorted([("MÜLLER", 11), ("josé", 12), ("zoe", 3), ("ÁDA", 14), (None, 4), (None, 15)], key=str)
    assert rows(M.smart_sync(t, s, "k", "seq", ci)) == sorted([("MÜLLER", 11), ("josé", 12), ("ÁDA", 14), (None, 4), (None, 15)], key=str)
    assert rows(M.insert_new_only(t, s, "k", "seq", ci)) == sorted([("MÜLLER", 1), ("josé", 2), ("zoe", 3), ("Ada", 13), (None, 4), (None, 15)], key=str)
    assert [r.k for r in M.deleted_keys(t, s, "k", ci).collect()] == ["zoe"]
    kids, parents = s.withColumnRenamed("seq", "n"), t
    assert {r.k for r in C.cascade_delete(kids, parents, "k", "k", ci).collect()} == {"Muller", "müller", "JOSE"}
    assert {r.k for r in C.orphans(kids, parents, "k", "k", ci).collect()} == {"Ada", "ÁDA"}
    assert M.upsert(t, s, "k", "seq", ci).schema == t.schema  # the collation stays inside


def test_place_table_equals_contains(spark):
    rng = random.Random(3)
    names = [("".join(rng.choice("abé ") for _ in range(rng.randint(1, 6))), f"L{k}", k // 2) for k in range(300)] + [("", "E", 0), (None, "N", 0), ("AB", "up", -1)]
    texts = ["".join(rng.choice("abcé A") for _ in range(rng.randint(0, 12))) for _ in range(200)] + [None, "", "  ", "zzz", "a" * 5000]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts * 2)], "i int, t string, region string, `__t` string").drop("region")
    places = spark.createDataFrame(names, "name string, label string, rank long")

    def plain(t):
        if t is None:
            return "Unknown"
        low = t.strip().lower()
        hits = [(r, lab) for n, lab, r in names if n and n.lower() in low]
        return min(hits)[1] if hits else "Other"

    got = {r.i: r.region for r in P.label_places(df, "t", places).collect()}
    best = {}
    for n, lab, r in names:  # a name listed twice counts by its smaller rank
        if n:
            best[n.lower()] = min(best.get(n.lower(), (r, lab)), (r, lab))
    assert got == {i: plain(t) for i, t in enumerate(texts * 2)}
    assert {r.region for r in P.label_places(df, "t", places.limit(0)).collect()} == {"Other", "Unknown"}
    plan = P.label_places(df, "t", places)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_quarantine_loses_nothing(spark):
    lines = ["1,a,2.5", "x,a,2.5", "2,b", "3,c,1.0,more", ",d,2.0", "4,\"e,f\",-1", "5,,", "", "6,g,nope", "1,a,2.5"]
    path = work_dir(spark, "raw")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    schema = StructType().add("k", "long").add("name", "string").add("_record", "double")
    good, bad = T.read_checked(spark, path, schema, {"no key": F.col("k").isNotNull(), "amount": F.col("_record") >= 0}, header=False)
    assert sorted(tuple(r) for r in good.collect()) == [(1, "a", 2.5), (1, "a", 2.5)]
    assert sorted((r.reason, r.record) for r in bad.collect()) == sorted([
        ("malformed", "x,a,2.5"), ("malformed", "2,b"), ("malformed", "3,c,1.0,more"), ("no key", ",d,2.0"), ("amount", "4,\"e,f\",-1.0"), ("amount", "5,,"),
        ("malformed", "6,g,nope")])
    assert good.count() + bad.count() == len([x for x in lines if x])  # blank lines are no records
    assert good.select("name").count() == 2 and bad.select("reason").count() == 7  # pruned reads agree


def test_places_cut_only_windows_that_names_begin(spark, monkeypatch):
    """Of all windows of all lengths only those whose head a name has reach the join with the names."""
    from rsvpflow.operators import places as P

    places = spark.createDataFrame([("Customer#%04d" % i, f"c{i}", i) for i in range(50)] + [("Customer#%03d" % i, f"s{i}", 90 - i) for i in range(5)]
                                   + [("pune", "P", 7), ("x-ray hall", "X", 60), ("", "none", -1), (None, "none", -2)], "name string, label string, rank long")
    rows = [(i, f"the customer#{i % 60:04d} of hall {i}, PUNEPUNE" if i % 3 else f" at x-ray halls {i}") for i in range(200)] + [(200, None), (201, ""), (202, "pun")]
    df = spark.createDataFrame(rows, "i long, t string")
    names = [(r.name.lower(), r.label, r.rank) for r in places.collect() if r.name]
    best = lambda t: min(((k, x) for n, x, k in names if n in t.lower()), default=(0, "Other"))[1]
    sent, join = [], P.key_join

    def counted(big, keys, on, *a, **kw):
        out = join(big, keys, on, *a, **kw)
        if isinstance(on, str) and on == "name":
            sent.append(big.count())
        return out

    monkeypatch.setattr(P, "key_join", counted)
    got = {r.i: r.region for r in P.label_places(df, "t", places).collect()}
    assert got == {i: "Unknown" if t is None else best(t) for i, t in rows}
    assert sent and sent[0] <= 5 * len(rows)

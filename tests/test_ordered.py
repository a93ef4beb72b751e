"""Order-dependent folds over ranges of events: hot keys in many tasks, against one-by-one versions."""

import random
import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from rsvpflow.operators import contacts as C
from rsvpflow.operators import ordered as O
from rsvpflow.plans import fixtures as X
from tests.conftest import SF_SMALL
from tests.test_merge_bruteforce import _master_row, sim_strict


@contextmanager
def many_parts(spark):
    """As on a large table: range partitions stay apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def made_feed(spark, n, seed, hot=0.4):
    """Random I/U/D events on few phones, one of which has a large part of them; and the same as a list."""
    rng = random.Random(seed)
    phone = lambda: "hot" if rng.random() < hot else rng.choice([None, "", "p1", "p2", "p3", "p4"])
    client = lambda: rng.choice([None, "A", "B", "C", "D"])
    state, events = {}, []
    for seq in rng.sample(range(10 * n), n):
        i = rng.randrange(n // 4)
        events.append((seq, i))
    out = []
    for seq, i in sorted(events):
        old = state.get(i)
        if old is None:
            new = _master_row(i, client(), phone())
            out.append((seq, "I", None, new))
            state[i] = new
        elif rng.random() < 0.25:
            out.append((seq, "D", old, None))
            del state[i]
        else:
            new = dict(_master_row(i, client(), rng.choice([old["Phone_Number"], phone()])), Tax_Contact=f"n{seq}")
            out.append((seq, "U", old, new))
            state[i] = new
    kind = X.master(spark, SF_SMALL).select(F.struct("*").alias("r")).schema["r"].dataType.simpleString()
    rows = [(s, o, (n or od)["id"], od, n) for s, o, od, n in out]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, f"seq long, op string, id long, old {kind}, new {kind}").repartition(4), out


def sim_keyed(stored, events, version):
    """v1 / v2 row triggers, one event at a time, on UNIQUE(phone): phone -> (id, client, name)."""
    table = dict(stored)
    for _, op, old, new in sorted(events, key=lambda e: e[0]):
        p = new and new["Phone_Number"]
        if op == "I" and p and p not in table:
            table[p] = (new["id"], new["Client_Name"], new["Tax_Contact"])
        elif op == "U" and p and p in table:
            i, c, _ = table[p]
            table[p] = (i, c if version == "v1" else new["Client_Name"], new["Tax_Contact"])
        elif op == "D" and version == "v2" and old["Phone_Number"]:
            table.pop(old["Phone_Number"], None)
    return table


@pytest.mark.parametrize("version", ["v1", "v2"])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mixed_feed_matches_one_by_one(spark, version, seed):
    with many_parts(spark):
        feed, events = made_feed(spark, 600, seed)
        m = X.master(spark, SF_SMALL)
        shape = C.fan_out(m).schema
        stored = {"p1": (900, "S", "s1"), "p9": (901, None, "s9")} | ({"hot": (902, "S", "s")} if seed % 2 else {})
        rows = [tuple({"role": "tax", "id": i, "client": c, "name": n, "phone": p}.get(f.name) for f in shape) for p, (i, c, n) in stored.items()]
        got = C.apply_triggers(spark.createDataFrame(rows, shape), feed, version, roles=("tax",)).collect()
    assert {r.phone: (r.id, r.client, r.name) for r in got} == sim_keyed(stored, events, version) and len(got) == len({r.phone for r in got})


def test_mixed_feed_of_nothing(spark):
    m = X.master(spark, SF_SMALL)
    table = C.unique_contacts(C.fan_out(m))
    for version in ("v1", "v2"):
        assert C.apply_triggers(table, X.change_feed(m).limit(0), version).count() == table.count()
    with pytest.raises(ValueError):
        C.apply_triggers(table, X.change_feed(m), "v3")


def test_strict_decides_on_keys_alone(spark, monkeypatch):
    """What is sorted and counted per phone holds no contact fields; of two upserts at one place one stays, of two without a client both."""
    seen = []
    monkeypatch.setattr(C, "ranged", lambda df, *order: seen.append(df.columns) or O.ranged(df, *order))
    feed, events = made_feed(spark, 40, 5)
    empty = spark.createDataFrame([], C.fan_out(feed.select("new.*")).schema)
    rows = lambda f: sorted((r.phone, str(r.client)) for r in C.apply_changes_by_phone(empty, f, roles=("tax",), strict_reference=True).collect())
    once = rows(feed)
    assert [set(c) for c in seen] == [{"role", "phone", "client", "seq", "ord", "kind"}]
    twice = rows(feed.filter("op = 'I'").unionByName(feed.filter("op = 'I'")))
    single = rows(feed.filter("op = 'I'"))
    assert once and twice == sorted(single + [r for r in single if r[1] == "None"])


@pytest.mark.parametrize("seed", [4, 5])
def test_strict_feed_with_a_hot_phone(spark, seed):
    with many_parts(spark):
        feed, events = made_feed(spark, 500, seed)
        empty = spark.createDataFrame([], C.fan_out(X.master(spark, SF_SMALL)).schema)
        got = C.apply_changes_by_phone(empty, feed, roles=("tax",), strict_reference=True)
        rows = sorted(((r.phone, r.client, r.id, r.name) for r in got.collect()), key=str)
    assert rows == sim_strict(events)


def test_hot_key_is_counted_in_many_tasks(spark):
    """Running counts: a key with a third of the rows lies in several parts, and no window over rows has the bare key."""
    with many_parts(spark):
        rows = spark.range(6000).selectExpr("case when id % 3 = 0 then 'hot' else concat('k', id % 40) end as k", "id * 7 % 6001 as at", "id % 5 = 0 as f")
        dealt = O.ranged(rows, "k", "at")
        assert dealt.filter("k = 'hot'").select(O.PART).distinct().count() > 1
        df = O.running_count(dealt, ["k"], ["at"], F.col("f"), "n")
        nxt = O.next_value(dealt, ["k"], "at", F.when(F.col("f"), F.col("at")), "then")
        windows = re.findall(r"windowspecdefinition\(([^)]*?ASC|[^)]*?DESC)[^)]*specifiedwindowframe", df._jdf.queryExecution().optimizedPlan().toString())
        got, then = df.collect(), {(r.k, r.at): r.then for r in nxt.collect()}
    assert any(O.PART in w.split(" ASC")[0].split(", ")[1] for w in windows), windows
    groups = {}
    for r in got:
        groups.setdefault(r.k, []).append(r)
    for k, rs in groups.items():
        n = 0
        rs.sort(key=lambda r: r.at)
        for j, r in enumerate(rs):
            n += r.f
            assert r.n == n and then[k, r.at] == next((x.at for x in rs[j + 1:] if x.f), None)


def plain_renames(keys, renames):
    """Children's keys after the renames, one statement at a time."""
    now = {k: k for k in keys}
    best = {}
    for old, new, seq in renames:
        if old is not None and old != new:
            b = best.get((seq, old))
            best[seq, old] = new if b is None or (new is not None and new > b) else b
    steps = {}
    for (seq, old), new in best.items():
        steps.setdefault(seq, {})[old] = new
    for seq in sorted(steps):
        now = {k: steps[seq].get(v, v) if v is not None else v for k, v in now.items()}
    return now


@pytest.mark.parametrize("seed", range(4))
def test_renames_in_order(spark, seed):
    """Chains, swaps, cycles, repeated and simultaneous renames, NULLs, and a key that most renames pass through."""
    rng = random.Random(seed)
    names = [f"n{i}" for i in range(12)] + [None]
    pick = lambda: "n0" if rng.random() < 0.3 else rng.choice(names)
    renames = [(pick(), pick(), rng.randrange(60)) for _ in range(80)] + [("a", "b", 1), ("b", "a", 2), ("a", "b", 3), ("x", "x", 1)]
    keys = [n for n in names if n] + ["a", "b", "x", "zz"]
    with many_parts(spark):
        r = spark.createDataFrame(renames, "old_key string, new_key string, seq int")
        kids = spark.createDataFrame([(i, k) for i, k in enumerate([*keys, None, *keys])], "i int, k string")
        got = C.cascade_renames(kids, r, "k").orderBy("i").collect()
    want = plain_renames(keys, renames)
    assert [x.k for x in got] == [want[k] for k in keys] + [None] + [want[k] for k in keys]


def test_long_rename_chain(spark):
    r = spark.createDataFrame([(f"k{i}", f"k{i + 1}", i) for i in range(100)], "old_key string, new_key string, seq int")
    kids = spark.createDataFrame([("k0",), ("k50",), ("k100",)], "k string")
    assert sorted(x.k for x in C.cascade_renames(kids, r, "k").collect()) == ["k100"] * 3
    assert C.cascade_renames(kids, r.limit(0), "k").count() == 3

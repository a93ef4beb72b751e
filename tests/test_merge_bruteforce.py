"""Merge operators vs a row-by-row simulation of the reference's MySQL statements."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rsvpflow.operators import merge as M

KEYS = st.sampled_from([None, "a", "b", "c", "d"])
VALS = st.sampled_from([None, "x", "y", "z"])
SETTINGS = settings(max_examples=int(__import__("os").environ.get("MERGE_EXAMPLES", "6")), deadline=None, suppress_health_check=list(HealthCheck))
SCHEMA = "k string, seq long, v string"


def rows(keys_vals, offset):
    return [(k, offset + i, v) for i, (k, v) in enumerate(keys_vals)]


def unique_target(t):
    """A target table already satisfies UNIQUE(k): keep the first row per non-NULL key."""
    seen, out = set(), []
    for k, s, v in t:
        if k is None or k not in seen:
            out.append((k, s, v))
            if k is not None:
                seen.add(k)
    return out


def sim_insert_ignore(t, src):
    table = list(t)
    present = {k for k, _, _ in table if k is not None}
    for k, s, v in sorted(src, key=lambda r: r[1]):
        if k is None or k not in present:
            table.append((k, s, v))
            if k is not None:
                present.add(k)
    return table


def sim_upsert(t, src):
    table = {("t", i): r for i, r in enumerate(t)}
    index = {r[0]: ("t", i) for i, r in enumerate(t) if r[0] is not None}
    for j, (k, s, v) in enumerate(sorted(src, key=lambda r: r[1])):
        if k is not None and k in index:
            table[index[k]] = (k, s, v)
        else:
            table[("s", j)] = (k, s, v)
            if k is not None:
                index[k] = ("s", j)
    return list(table.values())


def sim_smart_sync(t, src):
    src_keys = {k for k, _, _ in src if k is not None}
    kept = [r for r in t if r[0] is None or r[0] in src_keys]  # DELETE WHERE k = <missing key>
    return sim_upsert(kept, src)


def as_set(spark_rows):
    return sorted((tuple(r) for r in spark_rows), key=str)


@SETTINGS
@given(st.lists(st.tuples(KEYS, VALS), max_size=8), st.lists(st.tuples(KEYS, VALS), max_size=10))
def test_merges_match_simulation(spark, t_kv, s_kv):
    t = unique_target(rows(t_kv, 0))
    s = rows(s_kv, 100)
    tdf = spark.createDataFrame(t, SCHEMA)
    sdf = spark.createDataFrame(s, SCHEMA)
    assert as_set(M.insert_new_only(tdf, sdf, "k", "seq").collect()) == sorted(sim_insert_ignore(t, s), key=str)
    assert as_set(M.upsert(tdf, sdf, "k", "seq").collect()) == sorted(sim_upsert(t, s), key=str)
    assert as_set(M.smart_sync(tdf, sdf, "k", "seq").collect()) == sorted(sim_smart_sync(t, s), key=str)


# ---------------------------------------------------------------- trigger fold (fixed mode)
PHONES = st.sampled_from([None, "", "p1", "p2", "p3"])
CLIENTS = st.sampled_from([None, "A", "B"])


def _master_row(i, client, phone):
    from rsvpflow.plans.oracle import MASTER_COLUMNS

    row = {c: None for c in MASTER_COLUMNS}
    row.update(id=i, Client_Name=client, Phone_Number=phone, Tax_Contact=f"n{i}", Response_1="r")
    return row


def sim_triggers(events):
    """Row triggers, one event at a time, on a table keyed by (phone, client) (NULL-safe)."""
    table = {}
    present = lambda p: p is not None and p != ""
    for seq, op, old, new in sorted(events, key=lambda e: e[0]):
        if op in ("U", "D") and old and present(old["Phone_Number"]):
            table.pop((old["Phone_Number"], old["Client_Name"]), None)
        if op in ("I", "U") and new and present(new["Phone_Number"]):
            table[(new["Phone_Number"], new["Client_Name"])] = (new["id"], new["Tax_Contact"])
    return sorted(((p, c, i, n) for (p, c), (i, n) in table.items()), key=str)


def sim_strict(events):
    """Strict mode, one event at a time: an attribute update rewrites whatever row has the phone, NULL clients never
    collide, and the rows of a phone become one when their client is rewritten (UNIQUE key)."""
    table = []  # [phone, client, id, name]
    present = lambda p: p is not None and p != ""

    def delete(phone, client):
        table[:] = [r for r in table if not (client is not None and r[0] == phone and r[1] == client)]

    for seq, op, old, new in sorted(events, key=lambda e: e[0]):
        o, n = old and old["Phone_Number"], new and new["Phone_Number"]
        moved = o is not None and n is not None and o != n
        row = new and [n, new["Client_Name"], new["id"], new["Tax_Contact"]]
        if present(o) and (op == "D" or (op == "U" and (not present(n) or moved))):
            delete(o, old["Client_Name"])
        if present(n) and (op == "I" or (op == "U" and moved)):
            delete(n, new["Client_Name"])
            table.append(row)
        elif present(n) and op == "U" and any(r[0] == n for r in table):
            table[:] = [r for r in table if r[0] != n] + [row]
    return sorted((tuple(r) for r in table), key=str)


@pytest.mark.parametrize("strict", [False, True])
@SETTINGS
@given(ops=st.lists(st.tuples(st.sampled_from(["I", "U", "U", "D"]), st.integers(0, 3), CLIENTS, PHONES), min_size=1,
                    max_size=12))
def test_trigger_fold_matches_sequential(spark, ops, strict):
    from pyspark.sql import functions as F

    from rsvpflow.operators import contacts as C
    from rsvpflow.plans import fixtures as X

    m0 = X.master(spark, "/root/testdata/sf0.001").limit(0)
    struct_type = m0.select(F.struct(*m0.columns).alias("r")).schema["r"].dataType
    state, events = {}, []
    for seq, (op, i, client, phone) in enumerate(ops):
        old = state.get(i)
        if op == "I" and old is None:
            new = _master_row(i, client, phone)
            events.append((seq, "I", None, new))
            state[i] = new
        elif op == "U" and old is not None:
            new = _master_row(i, client, phone)
            events.append((seq, "U", old, new))
            state[i] = new
        elif op == "D" and old is not None:
            events.append((seq, "D", old, None))
            del state[i]
    if not events:
        return
    df = spark.createDataFrame([(s, o, (n or od)["id"], od, n) for s, o, od, n in events],
                               f"seq long, op string, id long, old {struct_type.simpleString()}, "
                               f"new {struct_type.simpleString()}")
    got = C.apply_changes_by_phone(spark.createDataFrame([], C.fan_out(m0).schema), df, roles=("tax",), strict_reference=strict)
    got = sorted(((r["phone"], r["client"], r["id"], r["name"]) for r in got.collect()), key=str)
    assert got == (sim_strict if strict else sim_triggers)(events)


def test_strict_probes(spark):
    """A row whose client an update rewrote is deleted under its new client only."""
    from pyspark.sql import functions as F

    from rsvpflow.operators import contacts as C
    from rsvpflow.plans import fixtures as X

    m0 = X.master(spark, "/root/testdata/sf0.001").limit(0)
    kind = m0.select(F.struct(*m0.columns).alias("r")).schema["r"].dataType.simpleString()
    a, b0, b1 = _master_row(1, "A", "p"), _master_row(2, "B", None), _master_row(2, "B", "p")
    start = [(0, "I", 1, None, a), (1, "I", 2, None, b0), (2, "U", 2, b0, b1)]
    for end, want in (((3, "D", 1, a, None), [("p", "B")]), ((3, "D", 2, b1, None), [])):
        df = spark.createDataFrame(start + [end], f"seq long, op string, id long, old {kind}, new {kind}")
        got = C.apply_changes_by_phone(spark.createDataFrame([], C.fan_out(m0).schema), df, roles=("tax",), strict_reference=True)
        assert [(r["phone"], r["client"]) for r in got.collect()] == want

"""Contact fan-out and derived-table maintenance.

The reference keeps six derived tables (3 roles × details/analysis) and scans
the master once per role.  Here one *long* contacts table is produced by a
single narrow pass (``explode`` of an array of per-role structs); the per-role
tables are projections of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rsvpflow.functions.scalars import present, response_label, response_weight, title_case
from rsvpflow.operators.bags import maybe_among
from rsvpflow.operators.joins import beyond_broadcast, fits_broadcast, key_join, materialized, written
from rsvpflow.operators.merge import keep_per_key, ranked_per_key
from rsvpflow.operators.ordered import PART, next_value, ranged, running_count
from rsvpflow.roles import (ANALYSIS_FIELDS, CLIENT_ATTRS, CONTACT_COLS, DETAILS_FIELDS, ROLE_ORDER, ROLES,
                              derived_name)

__all__ = ["fan_out", "role_view", "trigger_events", "apply_changes_by_phone", "standardize_master", "standardize_contacts", "rebuild_contacts",
           "unique_contacts", "apply_changes", "applied_seq", "apply_insert", "apply_update", "apply_delete",
           "apply_triggers", "cascade_delete", "cascade_rename", "cascade_renames", "rename_map", "orphans", "MASTER_TITLE_COLS"]

# Master columns the dashboard title-cases.
MASTER_TITLE_COLS = ("Practice_Head", "Partner", "Client_Name", "Location", "Sector")


def fan_out(master: DataFrame, roles: Sequence[str] = ROLE_ORDER, client_col: str = "Client_Name",
            key_col: str = "id", carry: Sequence[str] = ()) -> DataFrame:
    """The three repeated contact groups -> one long table, present phones only.

    One scan, no shuffle: each master row becomes an array of role structs; ``explode`` and the filter for a present
    phone run in one generated stage.
    """
    structs = []
    for r in roles:
        spec = ROLES[r]
        structs.append(F.struct(F.lit(r).alias("role"),
                                *[F.col(src).alias(dst) for dst, src in spec.master_cols().items()]))
    exploded = master.select(F.col(key_col).alias("id"), F.col(client_col).alias("client"),
                             *[F.col(c) for c in CLIENT_ATTRS], *[F.col(c) for c in carry],
                             F.explode(F.array(*structs)).alias("__c")).filter(present("__c.phone"))
    return exploded.select(
        *[F.col(f"__c.{c}").alias(c) if c in ("role", "name", "designation", "email", "phone", "location",
                                              "contact_response") else F.col(c) for c in CONTACT_COLS],
        *[F.col(c) for c in carry])


def role_view(contacts: DataFrame, role: str, kind: str = "analysis") -> DataFrame:
    """One role's derived table with the reference's column names."""
    spec = ROLES[role]
    fields = ANALYSIS_FIELDS if kind == "analysis" else DETAILS_FIELDS
    return contacts.filter(F.col("role") == role).select(
        *[F.col(f).alias(derived_name(spec, f)) for f in fields])


def standardize_master(master: DataFrame, title_cols: Sequence[str] = MASTER_TITLE_COLS,
                       response_col: str = "Response") -> DataFrame:
    """K4 on the master: title-case names (F2), ``Response_Weight`` (F6) computed
    *before* the label (F5) overwrites ``Response``."""
    cols = []
    for c in master.columns:
        if c in title_cols:
            cols.append(title_case(c).alias(c))
        elif c == response_col:
            cols.append(response_label(c).alias(c))
        else:
            cols.append(F.col(c))
    return master.select(*cols, response_weight(response_col).alias("Response_Weight"))


def standardize_contacts(contacts: DataFrame) -> DataFrame:
    """K4 on the long contacts: each role titles the fields its analysis table exposes
    under a title-cased name (tax: client + location too; cfo/other: heads, partner, sector)."""
    cols = []
    for c in contacts.columns:
        roles_for = [r for r in ROLES if c in ROLES[r].titled_fields]
        if c == "Response":
            cols.append(response_label(c).alias(c))
        elif roles_for:
            if len(roles_for) == len(ROLES):
                cols.append(title_case(c).alias(c))
            else:
                cols.append(F.when(F.col("role").isin(*roles_for), title_case(c)).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return contacts.select(*cols, response_weight("Response").alias("Response_Weight"))


def unique_contacts(contacts: DataFrame, policy: str = "phone", keep: str = "first",
                    seq: str = "id", unique_seq: bool = True) -> DataFrame:
    """M9: apply a uniqueness policy to the long table.

    ``policy="phone"`` -> UNIQUE(role, phone); ``"phone_client"`` -> UNIQUE(role, phone, client).
    ``keep="first"`` models ``INSERT IGNORE`` (M5a), ``"last"`` ``ON DUPLICATE KEY UPDATE`` (M5b).
    A NULL client never collides (UNIQUE admits many NULLs).  ``seq`` is unique per role in a fan-out; pass
    ``unique_seq=False`` for tables where it is not, and ties go by a hash of the whole row.
    """
    key = ["role", "phone"] if policy == "phone" else ["role", "phone", "client"]
    return keep_per_key(contacts, key, seq, keep, unique_seq=unique_seq)


def rebuild_contacts(master: DataFrame, roles: Sequence[str] = ROLE_ORDER) -> DataFrame:
    """M8: full rebuild = fan-out of the current master (write it to a new snapshot, then swap)."""
    return fan_out(master, roles)


def _latest_change(changes: DataFrame) -> DataFrame:
    """Last event per master row id (by seq): the fold of a batch of changes."""
    return keep_per_key(changes, "id", "seq", "last", null_safe=True)


def applied_seq(applied: DataFrame | None, changes: DataFrame) -> DataFrame:
    """(id, seq): the largest event applied to each id so far, deleted ids included."""
    new = changes.select("id", "seq")
    both = new if applied is None else applied.select("id", "seq").unionByName(new)
    return both.groupBy("id").agg(F.max("seq").alias("seq"))


def apply_changes(contacts: DataFrame, changes: DataFrame, roles: Sequence[str] = ROLE_ORDER,
                  applied: DataFrame | None = None) -> DataFrame:
    """K3 / M5–M7 (fixed behaviour): apply a change feed ``(seq, op, id, old, new)`` to the
    long contacts table keyed by (role, id).

    Per changed master row only its last event counts; the row's contacts are replaced
    by the fan-out of the NEW image (nothing for ``D`` or an absent phone).  Hence
    ``apply_changes(rebuild(m0), feed) == rebuild(m1)`` — the incremental path equals
    the full rebuild, which the reference's triggers do not guarantee (a phone that
    *appears* is never inserted there, see ``apply_update``).

    ``applied`` (see ``applied_seq``) names the event last applied to each id, deletes included: events that are not
    newer are dropped, so batches may arrive in any order.

    The fold shuffles only the change batch (partial ``WindowGroupLimit`` first) and is
    checkpointed once; its id set is broadcast to the anti join when its size checks out, so
    the large contacts table is not shuffled; a huge batch falls back to a shuffled anti join.
    """
    last = _latest_change(changes.select("seq", "op", "id", "new"))
    if applied is not None:
        seen = applied.select(F.col("id").alias("__id"), F.col("seq").alias("__seq"))
        last = last.join(seen, F.col("id") == F.col("__id"), "left").filter(F.col("__seq").isNull() | (F.col("seq") > F.col("__seq"))).drop("__id", "__seq")
    last = materialized(last)  # the folded batch, computed once
    touched = last.select("id")
    kept = key_join(contacts, touched, "id", "left_anti", materialize=False)
    new_rows = last.filter(F.col("op") != "D").select("new.*")
    return kept.unionByName(fan_out(new_rows, roles))


def _events_long(changes: DataFrame, image: str, roles: Sequence[str]) -> DataFrame:
    img = changes.filter(F.col(image).isNotNull()).select("seq", "op", F.col(f"{image}.*"))
    structs = []
    for r in roles:
        spec = ROLES[r]
        structs.append(F.struct(F.lit(r).alias("role"), F.col(spec.phone).alias("phone")))
    return img.select("seq", "op", F.col("id"), F.col("Client_Name").alias("client"),
                      F.explode(F.array(*structs)).alias("__r")).select("seq", "op", "id", "client", "__r.*")


def apply_insert(contacts: DataFrame, changes: DataFrame, policy: str = "phone", keep: str = "first",
                 roles: Sequence[str] = ROLE_ORDER, overwrite_client: bool = True) -> DataFrame:
    """Trigger-style inserts of the ``I`` events into a uniquely keyed table.

    keep="first" -> ``INSERT IGNORE`` (existing row wins, earliest seq among new ones);
    keep="last"  -> ``ON DUPLICATE KEY UPDATE`` (latest seq wins, existing row overwritten).
    ``overwrite_client=False`` (the duplicate-fix trigger) updates every field except the
    client name, which stays the one first stored under the key.

    Nothing is ever deleted: the batch is folded by key, rows of the table change in place or not at all, and keys the
    table lacks are appended.  The table itself is not shuffled while the folded batch passes the size check.  A batch with far
    more keys than that is not kept to be checked: its rows and the table's are shuffled once each, to one join.
    """
    ins = changes.filter(F.col("op") == "I")
    new = fan_out(ins.select("seq", "new.*"), roles, carry=("seq",))
    key = ["role", "phone"] if policy == "phone" else ["role", "phone", "client"]
    cols = contacts.columns
    keep_client = keep == "last" and not overwrite_client and "client" not in key
    loose = new.filter("client is null").select(*cols) if "client" in key else None  # such a key collides with none: all are inserted
    if keep_client:
        # one partial aggregation per key: last full row and first client (skew-safe: map-side)
        g = new.groupBy(*key).agg(F.max_by(F.struct(*cols), F.col("seq")).alias("__last"), F.min_by(F.struct("client"), F.col("seq")).alias("__c"))
        fold = g.select(*[F.col(c) if c in key else F.col("__c.client").alias(c) if c == "client" else F.col(f"__last.{c}").alias(c) for c in cols])
    else:
        fold = ranked_per_key(new, key, "seq", keep).select(*cols)
    names = {k: f"__k_{k}" for k in key}
    on = [F.col(k) == F.col(names[k]) for k in key]  # a NULL client equals nothing, as in a UNIQUE key
    setcols = [c for c in cols if c not in key and not (keep_client and c == "client")]
    marked = [*[F.col(f"__n_{c}") for c in setcols], F.col("__hit")]

    def hits(f: DataFrame) -> DataFrame:
        return f.select(*[F.col(k).alias(names[k]) for k in key], *[F.col(c).alias(f"__n_{c}") for c in cols if c not in key], F.lit(True).alias("__hit"))

    if beyond_broadcast(new, key):
        if keep == "first":
            stored = contacts.select(*[F.col(k).alias(names[k]) for k in key])
            return _with(contacts.unionByName(fold.join(stored, _all(on), "left_anti")), loose)
        # a key on both sides: the stored row, set; in the batch alone: its row; in the table alone, or NULL: as it is
        j = contacts.withColumn("__stored", F.lit(True)).join(hits(fold), _all(on), "full_outer")
        shown = {**{k: F.when(F.col("__stored"), F.col(k)).otherwise(F.col(names[k])) for k in key},
                 **{c: F.when(F.col("__hit"), F.col(f"__n_{c}")).otherwise(F.col(c)) for c in setcols}}
        if keep_client:
            shown["client"] = F.when(F.col("__stored"), F.col("client")).otherwise(F.col("__n_client"))
        return _with(j.select(*[shown[c].alias(c) for c in cols]), loose)
    fold = materialized(_with(fold, loose))
    taken = key_join(contacts.select(*key), fold.select(*[F.col(k).alias(names[k]) for k in key]), _all(on), "left_semi",
                     materialize=False).distinct()
    fresh = fold.join(taken.select(*[F.col(k).alias(names[k]) for k in key]), _all(on), "left_anti")
    if keep == "first":
        return contacts.unionByName(fresh)
    hit = hits(fold).select(*names.values(), *marked)
    j = key_join(contacts, hit, _all(on), "left", materialize=False)
    changed = j.select(*[F.when(F.col("__hit"), F.col(f"__n_{c}")).otherwise(F.col(c)).alias(c) if c in setcols else F.col(c) for c in cols])
    return changed.unionByName(fresh)


def _with(df: DataFrame, more: DataFrame | None) -> DataFrame:
    return df if more is None else df.unionByName(more)


def _all(conds: Sequence) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def apply_update(contacts: DataFrame, changes: DataFrame, version: str = "v1",
                 roles: Sequence[str] = ROLE_ORDER) -> DataFrame:
    """Trigger-style updates matched on the NEW phone (role, phone).

    v1 sets the client attributes and contact fields where phone = NEW.phone; the client
    name is not updated; a changed phone leaves the old row stale; nothing is inserted.
    v2 additionally updates the client name, and only when NEW phone is present.
    Several updates to one phone: the last by seq wins.
    """
    upd = changes.filter(F.col("op") == "U").select("seq", "new.*")
    long_new = fan_out(upd, roles, carry=("seq",))
    if version == "v2":
        long_new = long_new.filter(present("phone"))
    last = keep_per_key(long_new, ["role", "phone"], "seq", "last")
    setcols = [c for c in CONTACT_COLS if c not in ("role", "phone", "id") and (version == "v2" or c != "client")]
    n = last.select(F.col("role").alias("__r"), F.col("phone").alias("__p"),
                    *[F.col(c).alias(f"n_{c}") for c in setcols], F.lit(True).alias("__hit"))
    # the update batch is broadcast when its size checks out: the table is not shuffled on a hot phone
    j = key_join(contacts, n, (F.col("role") == F.col("__r")) & (F.col("phone") == F.col("__p")), "left")
    return j.select(*[F.when(F.col("__hit"), F.col(f"n_{c}")).otherwise(F.col(c)).alias(c) if c in setcols
                      else F.col(c) for c in contacts.columns])


def apply_delete(contacts: DataFrame, changes: DataFrame, by_client: bool = True,
                 roles: Sequence[str] = ROLE_ORDER) -> DataFrame:
    """M7: delete contacts of ``D`` events — v2 by phone only (also removes other clients
    sharing the phone), v3 by (phone, client)."""
    dels = _events_long(changes.filter(F.col("op") == "D").select("seq", "op", "id", "old"), "old", roles)
    dels = dels.filter(present("phone"))
    key = ["role", "phone", "client"] if by_client else ["role", "phone"]
    conds = [contacts[k].eqNullSafe(dels[k]) if k == "client" else contacts[k] == dels[k] for k in key]
    return contacts.join(dels.select(*key).distinct(), conds, "left_anti")


def trigger_events(changes: DataFrame, roles: Sequence[str] = ROLE_ORDER, strict_reference: bool = False
                   ) -> DataFrame:
    """Row-trigger semantics as key-level events ``(seq, ord, kind, <contact columns>)``.

    Per change and role (one narrow pass, ``explode`` of an event array):
    * ``D`` at (role, OLD phone, OLD client) when the OLD phone is present (U and D ops);
    * ``U`` (insert-or-overwrite) at (role, NEW phone, NEW client) when the NEW phone is present
      (I and U ops);
    * ``strict_reference=True`` reproduces the reference: a U op takes the delete+upsert path
      only when ``OLD phone != NEW phone`` is TRUE — with a NULL old phone the comparison is
      NULL, so it emits ``X`` (update rows with NEW phone, any client, insert nothing): a phone
      that *appears* is never inserted; and delete keys with a NULL client match nothing.
    Within one change a delete sorts before the upsert (``ord``).
    """
    per_role = []
    for r in roles:
        spec = ROLES[r]
        newc = F.struct(F.lit(r).alias("role"), F.col("new.id").alias("id"),
                        F.col("new.Client_Name").alias("client"),
                        *[F.col(f"new.{a}").alias(a) for a in CLIENT_ATTRS],
                        *[F.col(f"new.{src}").alias(dst) for dst, src in spec.master_cols().items()])
        per_role.append(F.struct(F.lit(r).alias("role"), F.col(f"old.{spec.phone}").alias("o_phone"),
                                 F.col("old.Client_Name").alias("o_client"), newc.alias("n")))
    x = changes.select("seq", "op", F.explode(F.array(*per_role)).alias("r")).select("seq", "op", "r.*")
    op = F.col("op")
    new_present = op.isin("I", "U") & present(F.col("n.phone"))
    old_present = op.isin("U", "D") & present(F.col("o_phone"))
    if strict_reference:
        moved = F.coalesce(F.col("o_phone") != F.col("n.phone"), F.lit(False))
        d_cond = old_present & ((op == "D") | ((op == "U") & (~new_present | moved)))
        u_cond = new_present & ((op == "I") | moved)
        x_cond = new_present & (op == "U") & ~moved
    else:
        d_cond, u_cond, x_cond = old_present, new_present, F.lit(False)
    fields = [c for c in CONTACT_COLS if c not in ("role", "phone", "client")]
    null_n = [F.lit(None).cast(x.schema["n"].dataType[c].dataType).alias(c) for c in fields]

    def ev(kind, ord_, phone, client, payload):
        return F.struct(F.lit(kind).alias("kind"), F.lit(ord_).alias("ord"), F.col("role"), phone.alias("phone"),
                        client.alias("client"), *payload)

    n_payload = [F.col(f"n.{c}").alias(c) for c in fields]
    events = F.array(
        F.when(d_cond, ev("D", 0, F.col("o_phone"), F.col("o_client"), null_n)),
        F.when(u_cond, ev("U", 1, F.col("n.phone"), F.col("n.client"), n_payload)),
        F.when(x_cond, ev("X", 1, F.col("n.phone"), F.col("n.client"), n_payload)),
    )
    return x.select("seq", F.explode(F.filter(events, lambda e: e.isNotNull())).alias("e")).select("seq", "e.*")


def apply_changes_by_phone(contacts: DataFrame, changes: DataFrame, roles: Sequence[str] = ROLE_ORDER,
                           strict_reference: bool = False) -> DataFrame:
    """M5b + M6c + M7 (v3): the reference's trigger-maintained analysis table keyed by
    UNIQUE(role, phone, client), applied set-based.

    Events are folded per key (last by ``(seq, ord)``; partial ``WindowGroupLimit`` before the
    shuffle), touched keys are anti-joined away (size-checked broadcast), surviving upserts are
    appended.  Fixed mode compares keys NULL-safely; strict mode see ``_apply_strict``.
    """
    ev = trigger_events(changes, roles, strict_reference)
    if strict_reference:
        return _apply_strict(contacts, ev)
    cols = list(CONTACT_COLS)
    last = materialized(keep_per_key(ev, ["role", "phone", "client"], ["seq", "ord"], "last", null_safe=True))
    keys = last.select(F.col("role").alias("__r"), F.col("phone").alias("__p"), F.col("client").alias("__c"))
    cond = ((F.col("role") == F.col("__r")) & (F.col("phone") == F.col("__p"))
            & F.col("client").eqNullSafe(F.col("__c")))
    kept = key_join(contacts.select(*cols), keys, cond, "left_anti", materialize=False)
    return kept.unionByName(last.filter(F.col("kind") == "U").select(*cols))


def _apply_strict(contacts: DataFrame, ev: DataFrame) -> DataFrame:
    """Strict trigger mode: ``X`` rewrites the client of every row that has its phone at that moment.

    All events of a phone concern its own rows only, so each (role, phone) history is cut into segments that an ``X``
    opens.  Inside a segment deletes and upserts fold per client as usual (a NULL client never collides: its upserts
    are inserts, its deletes match nothing).  Rows of a phone become one row at an ``X`` (UNIQUE(phone, client) allows
    no more).  Whether there is a row when the last ``X`` comes follows from the last segment before it that decides:
    one that leaves an upserted client alive, or one that deletes the client which its opening ``X`` had set.

    The segment number is a running count over a phone's events, taken per range of ``seq`` with offsets from the counts of
    the ranges before (``ordered.running_count``): a phone with a third of the feed is sorted by many tasks.

    All of this is decided on keys alone; the events' other columns are shuffled once, to meet the keys that stay, and where
    these are too many to be broadcast, bits tell most events that do not stay before that.
    """
    cols, rp = list(CONTACT_COLS), ["role", "phone"]
    pos = ["seq", "ord"]
    dealt = ranged(ev.select(*rp, "client", *pos, "kind"), *rp, *pos)
    e = written(running_count(dealt, rp, pos, F.col("kind") == "X", "seg").drop(PART))
    fold = (e.filter(F.col("kind").isin("D", "U") & F.col("client").isNotNull()).groupBy(*rp, "seg", "client")
            .agg(F.max(F.struct(*pos, "kind")).alias("__last")).select(*rp, "seg", "client", "__last.*"))
    fold = written(fold)
    loose = e.filter((F.col("kind") == "U") & F.col("client").isNull()).select(*fold.columns)
    xs = e.filter(F.col("kind") == "X")
    final = materialized(xs.groupBy(*rp).agg(F.max("seg").alias("last_seg")))  # phones that an X touches

    # contacts that stay: no key that the first segment folds, and no phone that an X touches
    key0 = fold.filter("seg = 0").select(*rp, "client")
    in_use = materialized(contacts.select(*rp, "client").join(final.select(*rp), rp, "left_semi").distinct())
    begin = in_use.join(key0, [*rp, "client"], "left_anti").distinct()
    out = key0.unionByName(in_use).select(*[F.col(c).alias(f"__{c}") for c in (*rp, "client")])
    same = (F.col("role") == F.col("__role")) & (F.col("phone") == F.col("__phone")) & F.col("client").eqNullSafe(F.col("__client"))
    untouched = key_join(contacts.select(*cols), out, same, "left_anti")

    # what each segment decides: 1 a row is there, 0 none, NULL as before
    wrote = fold.filter("kind = 'U'").select(*rp, "seg").unionByName(loose.select(*rp, "seg")).withColumn("d", F.lit(1))
    x_key = xs.select(*rp, "seg", "client")
    gone = x_key.join(fold.filter("kind = 'D'").select(*rp, "seg", "client"), [*rp, "seg", "client"], "left_semi").select(*rp, "seg", F.lit(0).alias("d"))
    # phones in use at the start count as a segment 0 that leaves a row
    votes = (wrote.unionByName(gone).unionByName(begin.select(*rp, F.lit(0).cast(e.schema["seg"].dataType).alias("seg"), F.lit(1).alias("d")))
             .join(final, rp).filter("seg < last_seg"))
    alive = votes.groupBy(*rp).agg(F.max(F.struct("seg", "d")).alias("v")).filter("v.d = 1").select(*rp)

    touched = fold.select(*rp, "seg", "client")
    carried = (xs.join(final, rp).filter("seg = last_seg").join(alive, rp, "left_semi")
               .join(touched, [*rp, "seg", "client"], "left_anti"))
    put = fold.filter("kind = 'U'").unionByName(loose).join(final, rp, "left").filter("seg = coalesce(last_seg, 0)")
    # a fold's winner is one row, the first by a hash of those at its place; other events stay as often as they come
    key = [*rp, "client", *pos, "kind"]
    kept, small = fits_broadcast(put.unionByName(carried).groupBy(*key).agg(F.max("seg").alias("__seg")))
    rest = [c for c in cols if c not in key]
    events = ev.filter("kind <> 'D'")
    events = (events if small else maybe_among(events, kept, key)).select(*key, F.struct(*rest).alias("__row"), F.lit(None).cast(e.schema["seg"].dataType).alias("__seg"), F.xxhash64(*ev.columns).alias("__h"))
    marks = kept.select(*key, F.lit(None).cast(events.schema["__row"].dataType).alias("__row"), "__seg", F.lit(None).cast("bigint").alias("__h"))
    place = Window.partitionBy(*key)
    found = (events.unionByName(marks).withColumn("__in", F.max("__seg").over(place)).filter("__in is not null and __row is not null")
             .withColumn("__n", F.row_number().over(place.orderBy("__h"))).filter("__n = 1 or kind = 'X' or client is null"))
    shown = found.select(*[F.col(c) if c in key else F.col(f"__row.{c}").alias(c) for c in cols])
    return untouched.unionByName(shown)


def apply_triggers(contacts: DataFrame, changes: DataFrame, version: str = "v1", roles: Sequence[str] = ROLE_ORDER) -> DataFrame:
    """M5a + M6a / M6b + M7 as they fire together: a mixed feed of I, U and D events in ``seq`` order on a table keyed by
    UNIQUE(role, phone).

    I inserts a contact under its NEW phone unless one is there (keep-first); U sets the fields of the contact that has the
    NEW phone at that moment (v1 not the client name, v2 the client name too), never inserts and never moves a changed phone;
    D (v2; v1 has no delete trigger) removes the contact that has the OLD phone, whoever's it is.

    The events of a phone act on its row alone, as functions that compose: after the last D the row is absent, the first I
    behind that brings it back, and of the U behind that only the last shows; without a D a stored row stays and shows the
    last U.  So a phone's events are folded per range of ``seq`` to one row (last D; first I behind it; last U), and the
    ranges' rows to one: no task sorts or holds all events of a phone.  The table is not shuffled while the folded feed
    passes the size check.  Events of one row need distinct ``seq``; contacts without a present phone are left as they are.
    """
    if version not in ("v1", "v2"):
        raise ValueError(f"unknown trigger version {version!r}")
    cols, rp = list(CONTACT_COLS), ["role", "phone"]
    per_role = []
    for r in roles:
        spec = ROLES[r]
        row = F.struct(F.lit(r).alias("role"), F.col("new.id").alias("id"), F.col("new.Client_Name").alias("client"), *[F.col(f"new.{a}").alias(a) for a in CLIENT_ATTRS],
                       *[F.col(f"new.{src}").alias(dst) for dst, src in spec.master_cols().items()])
        gone = (F.col("op") == "D") if version == "v2" else F.lit(False)
        phone = F.when(F.col("op").isin("I", "U"), F.col(f"new.{spec.phone}")).when(gone, F.col(f"old.{spec.phone}"))
        per_role.append(F.struct(F.lit(r).alias("role"), phone.alias("phone"), F.when(F.col("op") != "D", row).alias("row")))
    ev = changes.select("seq", "op", F.explode(F.array(*per_role)).alias("e")).select("seq", "op", "e.*").filter(present("phone"))
    dealt = ranged(ev, *rp, "seq")
    seq, op, last_d = F.col("seq"), F.col("op"), F.col("__d")
    behind = lambda at, d: F.when(d.isNull() | (at > d), at)
    local = dealt.withColumn("__d", F.max(F.when(op == "D", seq)).over(Window.partitionBy(*rp, PART)))
    first = F.when(op == "I", behind(seq, last_d))
    parts = local.groupBy(*rp, PART).agg(F.max("__d").alias("d"), F.min(first).alias("i_seq"), F.min_by("row", first).alias("i_row"),
                                         F.max(F.when(op == "U", seq)).alias("u_seq"), F.max_by("row", F.when(op == "U", seq)).alias("u_row"))
    parts = parts.withColumn("__d", F.max("d").over(Window.partitionBy(*rp)))
    first = behind(F.col("i_seq"), last_d)
    fold = materialized(parts.groupBy(*rp).agg(F.max("__d").alias("d"), F.min(first).alias("i_seq"), F.min_by("i_row", first).alias("i_row"),
                                               F.max("u_seq").alias("u_seq"), F.max_by("u_row", "u_seq").alias("u_row")))
    setcols = [c for c in cols if c not in ("role", "phone", "id") and (version == "v2" or c != "client")]
    fresh = fold.filter("i_seq is not null").select(
        "d", *[F.when(F.col("u_seq") > F.col("i_seq"), F.col(f"u_row.{c}")).otherwise(F.col(f"i_row.{c}")).alias(c) if c in setcols
               else F.col(f"i_row.{c}").alias(c) for c in cols])
    names = [F.col("role").alias("__r"), F.col("phone").alias("__p")]
    same = (F.col("role") == F.col("__r")) & (F.col("phone") == F.col("__p"))
    taken = key_join(contacts.select(*rp), fold.select(*names), same, "left_semi", materialize=False).distinct().select(*names)
    put = fresh.filter("d is not null").drop("d").unionByName(fresh.filter("d is null").drop("d").join(taken, same, "left_anti"))
    hit = fold.select(*names, "d", "u_seq", "u_row")
    j = key_join(contacts, hit, same, "left", materialize=False).filter("d is null")
    shown = j.select(*[F.when(F.col("u_seq").isNotNull(), F.col(f"u_row.{c}")).otherwise(F.col(c)).alias(c) if c in setcols else F.col(c)
                       for c in contacts.columns])
    return shown.unionByName(put)


def rename_map(renames: DataFrame, old_col: str = "old_key", new_col: str = "new_key", seq: str = "seq") -> DataFrame:
    """(old_key, new_key): where each key ends under renames that run one after the other by ``seq``.

    A rename hands the rows it finds to the first later rename of its new key.  These links form chains that only go
    forward in ``seq`` — a swap or a cycle of names is a chain through time like any other — and pointer doubling follows
    them in as many rounds as the longest chain has binary digits, whatever the number of renames.  A key starts at its
    first rename.  NULL keys and renames of a key to itself do nothing; of several renames of one key at one ``seq`` the
    largest new key counts; a NULL new key ends a chain.
    """
    old, new = F.col(old_col), F.col(new_col)
    r = (renames.filter(old.isNotNull() & ~old.eqNullSafe(new)).groupBy(old.alias("old"), F.col(seq).cast("bigint").alias("seq"))
         .agg(F.max(new).alias("new")))
    # per key the renames that leave it and those that reach it; each of the latter takes the first leave behind it
    leaves = r.select(F.col("old").alias("key"), "seq", F.lit(True).alias("leaves"), F.lit(None).cast(r.schema["old"].dataType).alias("origin"))
    reaches = r.filter("new is not null").select(F.col("new").alias("key"), "seq", F.lit(False).alias("leaves"), F.col("old").alias("origin"))
    dealt = ranged(leaves.unionByName(reaches), "key", "seq")
    linked = next_value(dealt, ["key"], "seq", F.when(F.col("leaves"), F.col("seq")), "then")
    link = linked.filter("not leaves and then is not null").select(F.col("origin").alias("old"), "seq", F.col("key").alias("o2"), F.col("then").alias("s2"))
    step = materialized(r.join(link, ["old", "seq"], "left"))
    while not step.filter("o2 is not null").isEmpty():
        ahead = step.select(F.col("old").alias("o2"), F.col("seq").alias("s2"), F.col("new").alias("__n"), F.col("o2").alias("__o"), F.col("s2").alias("__s"))
        step = materialized(step.join(ahead, ["o2", "s2"], "left").select(
            "old", "seq", F.when(F.col("o2").isNotNull(), F.col("__n")).otherwise(F.col("new")).alias("new"), F.col("__o").alias("o2"), F.col("__s").alias("s2")))
    return step.groupBy(F.col("old").alias("old_key")).agg(F.min_by(F.struct("new"), "seq").alias("__e")).select("old_key", F.col("__e.new").alias("new_key"))


def cascade_renames(children: DataFrame, renames: DataFrame, child_key: str, old_col: str = "old_key", new_col: str = "new_key",
                    seq: str = "seq") -> DataFrame:
    """J6 ``ON UPDATE CASCADE`` for parent renames in ``seq`` order, chains, swaps and cycles included (``rename_map``).

    The children are not shuffled while the map passes the size check."""
    ends = rename_map(renames, old_col, new_col, seq).select(F.col("old_key").alias("__old"), F.col("new_key").alias("__new"))
    j = key_join(children, ends, F.col(child_key) == F.col("__old"), "left")
    return j.select(*[F.when(F.col("__old").isNotNull(), F.col("__new")).otherwise(F.col(c)).alias(c) if c == child_key else F.col(c) for c in children.columns])


def _alike(col: str, collation: str | None) -> Column:
    return F.collate(F.col(col), collation) if collation else F.col(col)


def cascade_delete(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str, collation: str | None = None) -> DataFrame:
    """J6 ``ON DELETE CASCADE``: keep only children whose parent still exists (keys alike under ``collation``, if named)."""
    p = parents.select(_alike(parent_key, collation).alias("__p")).filter(F.col("__p").isNotNull())
    return children.join(p, _alike(child_key, collation) == F.col("__p"), "left_semi")


def cascade_rename(children: DataFrame, renames: DataFrame, child_key: str, old_col: str = "old_key",
                   new_col: str = "new_key", seq: str | None = None) -> DataFrame:
    """J6 ``ON UPDATE CASCADE``: rewrite a child's parent key through a rename map, one statement (for renames that run one
    after the other see ``cascade_renames``)."""
    # one rename per key, the last by ``seq`` (or the largest new key): the map never multiplies children
    order = F.struct(F.col(seq), F.col(new_col)) if seq else F.col(new_col)
    r = (renames.filter(F.col(old_col).isNotNull()).groupBy(F.col(old_col).alias("__old"))
         .agg(F.max_by(F.col(new_col), order).alias("__new")))
    j = children.join(r, F.col(child_key) == F.col("__old"), "left")
    return j.select(*[F.when(F.col("__old").isNotNull(), F.col("__new")).otherwise(F.col(c)).alias(c)
                      if c == child_key else F.col(c) for c in children.columns])


def orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str, collation: str | None = None) -> DataFrame:
    """Children whose non-NULL parent key has no parent row (FK violation report; keys alike under ``collation``)."""
    p = parents.select(_alike(parent_key, collation).alias("__p"))
    return children.filter(F.col(child_key).isNotNull()).join(p, _alike(child_key, collation) == F.col("__p"), "left_anti")

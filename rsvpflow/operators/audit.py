"""What change events do to contacts: actions, counts, insert and update times (M10, M12 for change application).

Each event of a timed feed ``(seq, op, id, old, new, ts)`` says by its images what it does to a role's contact: it appears,
goes, changes or stays.  The last appearance (the insert time's event) and the last appearance or change (the update
time's) are maxima by ``seq``, so they fold map-side, in any order, and merge over batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rsvpflow.functions.scalars import present
from rsvpflow.operators.joins import fits_broadcast, written
from rsvpflow.roles import CLIENT_ATTRS, CONTACT_COLS, ROLE_ORDER, ROLES

__all__ = ["ACTIONS", "apply_changes_audit", "contact_of", "contact_rows", "count_columns", "count_rows", "timed_rows", "time_columns"]

#: What an event does to a contact.
ACTIONS = ("inserted", "updated", "unchanged", "deleted")
TIMES = (("ins", "Data_Insert_Time"), ("upd", "Last_Updated"))


def contact_of(image: str, role: str) -> Column:
    """A role's contact in a master image, as a struct."""
    return F.struct(F.lit(role).alias("role"), F.col(f"{image}.id").alias("id"), F.col(f"{image}.Client_Name").alias("client"),
                    *[F.col(f"{image}.{a}").alias(a) for a in CLIENT_ATTRS],
                    *[F.col(f"{image}.{src}").alias(dst) for dst, src in ROLES[role].master_cols().items()])


def contact_rows(last: DataFrame, roles: Sequence[str], *more: str) -> DataFrame:
    """(id, seq, contacts, more...): the contacts of each last event's NEW image, none after a delete."""
    alive = (F.col("op") != "D") & F.col("new").isNotNull()
    fan = F.array(*[contact_of("new", r) for r in roles])
    return last.select("id", "seq", F.when(alive, F.filter(fan, lambda c: present(c["phone"]))).otherwise(F.filter(fan, lambda c: F.lit(False))).alias("contacts"),
                       *more)


def count_columns(roles: Sequence[str]) -> list[tuple[str, str, str]]:
    """(role, action, column of ``timed_rows`` that counts it)."""
    return [(r, k, f"n_{r}_{k}") for r in roles for k in ACTIONS]


def timed_rows(changes: DataFrame, roles: Sequence[str] = ROLE_ORDER) -> DataFrame:
    """Per master id of a timed feed: its last event's contacts, per role the marks ``ins_<role>`` and ``upd_<role>``
    (seq, ts) and the events counted by action (``count_columns``); one aggregation by id, of the columns that contacts have."""
    marks, sums = [], []
    fields = dict.fromkeys(["id", "Client_Name", *CLIENT_ATTRS, *[src for r in roles for src in ROLES[r].master_cols().values()]])
    image = F.when(F.col("new").isNotNull(), F.struct(*[F.col(f"new.{c}").alias(c) for c in fields]))
    for r in roles:
        phone = ROLES[r].phone
        had = F.col("op").isin("U", "D") & F.col("old").isNotNull() & present(f"old.{phone}")
        has = F.col("op").isin("I", "U") & F.col("new").isNotNull() & present(f"new.{phone}")
        same = contact_of("old", r).eqNullSafe(contact_of("new", r))
        kinds = {"inserted": has & ~had, "updated": has & had & ~same, "unchanged": has & had & same, "deleted": had & ~has}
        at = F.struct("seq", "ts")
        marks += [F.max(F.when(kinds["inserted"], at)).alias(f"ins_{r}"), F.max(F.when(kinds["inserted"] | kinds["updated"], at)).alias(f"upd_{r}")]
        sums += [F.count_if(kinds[k]).alias(f"n_{r}_{k}") for k in ACTIONS]
    last = changes.groupBy("id").agg(F.max("seq").alias("seq"), F.max_by(F.struct("op", image.alias("new")), "seq").alias("e"), *marks, *sums)
    names = [f"{k}_{r}" for r in roles for k in ("ins", "upd")] + [n for _, _, n in count_columns(roles)]
    return contact_rows(last.select("id", "seq", "e.*", *names), roles, *names)


def time_columns(roles: Sequence[str], role: str = "c.role") -> list[Column]:
    """Data_Insert_Time and Last_Updated of a contact from its id's marks."""
    out = []
    for kind, name in TIMES:
        pick = None
        for r in roles:
            own = F.col(f"{kind}_{r}.ts")
            pick = F.when(F.col(role) == r, own) if pick is None else pick.when(F.col(role) == r, own)
        out.append(pick.alias(name))
    return out


def count_rows(rows: DataFrame, roles: Sequence[str] = ROLE_ORDER) -> DataFrame:
    """(role, action, row_count) over ``timed_rows``."""
    names = count_columns(roles)
    total = rows.agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for _, _, n in names])
    cells = F.array(*[F.struct(F.lit(r).alias("role"), F.lit(k).alias("action"), F.col(n).alias("row_count")) for r, k, n in names])
    return total.select(F.explode(cells).alias("x")).select("x.*")


def apply_changes_audit(contacts: DataFrame, changes: DataFrame, roles: Sequence[str] = ROLE_ORDER, applied: DataFrame | None = None
                        ) -> tuple[DataFrame, DataFrame]:
    """K3 with M10 and M12: ``contacts.apply_changes`` of a timed feed to a table that has Data_Insert_Time and Last_Updated.

    A contact's insert time is that of the event by which it last appeared, its update time that of the last event that
    changed a value of it; rows that the batch touches without changing them keep both.  Returns the table and the counts
    (role, action, row_count) of the batch's events.  The batch is folded once, for rows, times and counts alike.

    ``applied`` as in ``apply_changes``: ids whose events are not newer are left alone; times follow the events that are
    applied, so across batches they hold for feeds in order (``streaming.deltas`` keeps them for any order).
    """
    rows = timed_rows(changes, roles)
    if applied is not None:
        seen = applied.select(F.col("id").alias("__id"), F.col("seq").alias("__seq"))
        rows = rows.join(seen, F.col("id") == F.col("__id"), "left").filter(F.col("__seq").isNull() | (F.col("seq") > F.col("__seq"))).drop("__id", "__seq")
    rows = written(rows)
    ids, small = fits_broadcast(rows.select("id"), materialize=False)
    ids = F.broadcast(ids) if small else ids
    names = [name for _, name in TIMES]
    kept = contacts.join(ids, "id", "left_anti").select(*[contacts[c] for c in contacts.columns])
    # the stored times meet a row before its contacts are spelled out, so no contact is shuffled for them
    had = (contacts.select(F.col("id").alias("__id"), "role", *names).join(ids.select(F.col("id").alias("__id")), "__id", "left_semi")
           .groupBy("__id").agg(F.collect_list(F.struct("role", *names)).alias("__had")))
    marks = [F.col(f"{k}_{r}") for r in roles for k, _ in TIMES]
    some = rows.filter(F.size("contacts") > 0).select("contacts", *marks).join(had, F.get("contacts", F.lit(0))["id"] == F.col("__id"), "left")
    new = some.select(F.explode("contacts").alias("c"), *marks, "__had")
    new = new.select("c", *time_columns(roles), F.explode_outer(F.filter("__had", lambda h: h["role"] == F.col("c.role"))).alias("__h"))
    new = new.select(*[F.col(f"c.{c}").alias(c) for c in CONTACT_COLS], *[F.coalesce(n, f"__h.{n}").alias(n) for n in names])
    return kept.unionByName(new), count_rows(rows, roles)

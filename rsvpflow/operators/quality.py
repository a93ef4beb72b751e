"""Data-quality operators: duplicates (A15, A16, W2), reconciliation (A17, A18), pending.

Skew: one phone may be shared by a third of all contacts.  Counts therefore use
partial aggregation only; membership is returned as a *long* table (one row per
member) rather than one concatenated string per phone, so no group is ever
collected into a single value or task.  The top-N report (W2) is the only place a
limit appears — it is the feature (N phones, k people each) — and its per-phone
``row_number() <= k`` is planned with a partial ``WindowGroupLimit`` before the
shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rsvpflow.functions.scalars import client_contact_label, present
from rsvpflow.operators.bags import bag_differences, row_hash
from rsvpflow.operators.joins import key_join, materialized

__all__ = ["duplicate_phones", "duplicate_phone_people", "duplicate_phones_top", "duplicate_phone_counts",
           "reconcile_bags", "reconcile_counts", "reconcile_rows", "reconcile_registered", "pending_counts"]


def duplicate_phones(contacts: DataFrame) -> DataFrame:
    """Phones used more than once per role, with the number of labelled people."""
    lab = client_contact_label("client", "name")
    return (contacts.filter(present("phone"))
                    .groupBy("role", "phone")
                    .agg(F.count(F.lit(1)).alias("dup_count"), F.count(lab).alias("labelled"))
                    .filter(F.col("dup_count") > 1))


def duplicate_phone_people(contacts: DataFrame) -> DataFrame:
    """A15 membership: every ``Client (Contact)`` of a duplicated phone, one row each
    (the reference's ``GROUP_CONCAT`` list, kept whole and unaggregated).

    The (role, phone) count table is broadcast when its size checks out; otherwise the join
    shuffles and AQE's skew-join handling splits a hot phone's partition."""
    d = duplicate_phones(contacts).select(F.col("role").alias("__r"), F.col("phone").alias("__p"), "dup_count")
    lab = client_contact_label("client", "name")
    people = contacts.filter(present("phone")).select("role", "phone", "id", lab.alias("person")) \
                     .filter(F.col("person").isNotNull())
    j = key_join(people, d, (F.col("role") == F.col("__r")) & (F.col("phone") == F.col("__p")), "inner")
    return j.select("role", "phone", "id", "person", "dup_count")


def duplicate_phones_top(contacts: DataFrame, n_phones: int = 20, n_people: int = 3) -> DataFrame:
    """The ``n_phones`` most used phones per role and the first ``n_people`` people of each
    (sorted), with how many more there are.  Bounded output by design."""
    d = duplicate_phones(contacts).select("role", "phone", "dup_count", "labelled")
    wtop = Window.partitionBy("role").orderBy(F.desc("dup_count"), "phone")
    # at most n_phones rows per role: computed once, then a size-bounded broadcast to both joins
    top = materialized(d.withColumn("phone_rank", F.row_number().over(wtop)).filter(F.col("phone_rank") <= n_phones))
    lab = client_contact_label("client", "name")
    people = contacts.filter(present("phone")).select("role", "phone", lab.alias("person")) \
                     .filter(F.col("person").isNotNull())
    sel = people.join(F.broadcast(top.select("role", "phone")), ["role", "phone"], "left_semi")
    wp = Window.partitionBy("role", "phone").orderBy("person")
    first = sel.withColumn("person_rank", F.row_number().over(wp)).filter(F.col("person_rank") <= n_people)
    # every ranked phone stays, with a NULL person when nobody is labelled; both sides are bounded by the report
    return (top.join(first, ["role", "phone"], "left")
                 .select("role", "phone_rank", "phone", "dup_count", "person_rank", "person",
                         F.greatest(F.col("labelled") - F.lit(n_people), F.lit(0)).cast("bigint").alias("more")))


def duplicate_phone_counts(contacts: DataFrame) -> DataFrame:
    """Number of duplicated phones per role."""
    return duplicate_phones(contacts).groupBy("role").agg(F.count(F.lit(1)).alias("dup_phones"))


def _role_counts(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy("role").agg(F.count(F.lit(1)).alias(name))


def reconcile_counts(expected: DataFrame, derived: DataFrame) -> DataFrame:
    """Per role and in total (role ``total``) — eligible in master, present in derived, missing, in-sync flag."""
    e = _role_counts(expected, "master_n")
    d = _role_counts(derived, "derived_n")
    j = e.join(d, "role", "full_outer")
    mn = F.coalesce("master_n", F.lit(0).cast("bigint"))
    dn = F.coalesce("derived_n", F.lit(0).cast("bigint"))
    per = j.select("role", mn.alias("master_n"), dn.alias("derived_n"))
    total = per.agg(F.sum("master_n").alias("master_n"), F.sum("derived_n").alias("derived_n"))
    both = per.unionByName(total.select(F.lit("total").alias("role"), F.coalesce("master_n", F.lit(0).cast("bigint")).alias("master_n"),
                                        F.coalesce("derived_n", F.lit(0).cast("bigint")).alias("derived_n")))
    return both.select("*", (F.col("master_n") - F.col("derived_n")).alias("missing"),
                       (F.col("master_n") == F.col("derived_n")).alias("in_sync"))


def reconcile_rows(expected: DataFrame, derived: DataFrame, key=("role", "id", "phone")) -> DataFrame:
    """A17 row level, for tables with unique keys (else ``reconcile_bags``): contacts missing from the derived table, rows the master no longer backs and rows whose
    other values differ (counts alone can cancel out).  One full outer join on the key (keys are unique per row);
    the other columns travel as one hash."""
    key = list(key)
    rest = [c for c in expected.columns if c not in key and c in derived.columns]
    digest = row_hash(rest) if rest else F.lit(0)
    e = expected.select(*key, digest.alias("__e"))
    d = derived.select(*key, digest.alias("__d"))
    # one full outer join classifies both directions (each side shuffled once)
    j = e.join(d, key, "full_outer").filter(~F.col("__e").eqNullSafe(F.col("__d")))
    side = (F.when(F.col("__d").isNull(), "missing_in_derived").when(F.col("__e").isNull(), "extra_in_derived")
            .otherwise("changed"))
    return j.select(*key, side.alias("side"))


def reconcile_bags(expected: DataFrame, derived: DataFrame, key=("role", "id", "phone"), buckets: int = 4096) -> DataFrame:
    """A17 row level for tables with copies: every row held a different number of times by the two, with both counts and
    ``side`` (``missing_in_derived``, ``extra_in_derived``, or ``copies`` where both hold it).  Digests of key buckets come
    first, so tables that agree are read and not shuffled (``bags.bag_differences``)."""
    off = bag_differences(expected, derived, list(key), buckets)
    side = F.when(F.col("n_derived") == 0, "missing_in_derived").when(F.col("n_expected") == 0, "extra_in_derived").otherwise("copies")
    return off.withColumn("side", side)


def reconcile_registered(expected: DataFrame, derived: DataFrame) -> DataFrame:
    """Registered contacts (exact 'Registered' / 'registered') in master vs derived, per role."""
    reg = F.col("contact_response").isin("Registered", "registered")
    return reconcile_counts(expected.filter(reg), derived.filter(reg))


def pending_counts(details: DataFrame, ledger: DataFrame) -> DataFrame:
    """Contacts not exported yet (status 0 = absent from the export ledger), per role."""
    pend = key_join(details, ledger.select("role", "phone").distinct(), ["role", "phone"], "left_anti")
    return pend.groupBy("role").agg(F.count(F.lit(1)).alias("pending"))

"""Reporting aggregates.

Inputs are the *standardised* master (``standardize_master``) and long contacts
(``standardize_contacts``).  Every report is a single aggregation with partial
(map-side) aggregation; conditional counts use ``count_if`` / ``sum(when)`` instead
of joins (the reference's region/positive left join collapses into one pass).
NULL group keys are dropped, as pandas ``groupby`` does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rsvpflow.functions.scalars import (clean_response, conversion_rate, is_registered, parse_date, present, round2,
                                          region_of, safe_int)
from rsvpflow.operators.filters import cascade_filter
from rsvpflow.operators.joins import materialized
from rsvpflow.roles import ROLE_ORDER, ROLES

__all__ = ["overview", "response_weights", "sector_performance", "region_counts", "owner_stats",
           "owner_totals", "owner_response", "owner_response_once", "owner_cross", "owner_sector_rollup", "role_kpis",
           "role_responses", "role_region", "cfo_sector_counts", "metrics", "invite_trend", "funnel",
           "filter_options"]

OWNERS = ("Practice_Head", "Partner")


def _rate(num: Column, den: Column) -> Column:
    return F.when(den > 0, round2(num / den * F.lit(100.0))).otherwise(F.lit(0.0))


def _responded(resp: Column) -> Column:
    """Non-NULL and not 'awaited' (case-insensitive)."""
    return resp.isNotNull() & (F.lower(resp) != F.lit("awaited"))


def overview(sm: DataFrame) -> DataFrame:
    """A1: clients, invitees, registrations, response rate excluding 'awaited'."""
    n = F.count(F.lit(1))
    return sm.agg(n.alias("total_clients"),
                  F.sum(safe_int("numInvitees")).alias("total_invitees"),
                  F.sum(safe_int("numRegistrations")).alias("registrations"),
                  _rate(F.count_if(_responded(F.col("Response"))), n).alias("response_rate"))


def response_weights(sm: DataFrame, response_col: str = "Response") -> DataFrame:
    """A2: weighted response distribution."""
    return (sm.filter(F.col(response_col).isNotNull())
              .groupBy(F.col(response_col).alias("response"))
              .agg(F.sum("Response_Weight").alias("weight")))


def sector_performance(sm: DataFrame) -> DataFrame:
    """A3: per sector Σ invitees, Σ registrations, conversion."""
    g = (sm.filter(F.col("Sector").isNotNull()).groupBy(F.col("Sector").alias("sector"))
           .agg(F.sum(safe_int("numInvitees")).alias("invitees"),
                F.sum(safe_int("numRegistrations")).alias("registrations")))
    return g.withColumn("conversion", conversion_rate(F.col("registrations"), F.col("invitees")))


def region_counts(sm: DataFrame, location_col: str = "Location") -> DataFrame:
    """A4: rows per region (F4) among rows with a location, descending."""
    return (sm.filter(F.col(location_col).isNotNull())
              .groupBy(region_of(location_col).alias("region")).agg(F.count(F.lit(1)).alias("row_count"))
              .orderBy(F.desc("row_count"), "region"))


def owner_stats(sm: DataFrame, owner: str = "Practice_Head") -> DataFrame:
    """A5: per owner — invites sent (non-NULL clients), Σ invitees, Σ registrations, responses."""
    return (sm.filter(F.col(owner).isNotNull()).groupBy(F.col(owner).alias("owner"))
              .agg(F.count("Client_Name").alias("invites_sent"),
                   F.sum(safe_int("numInvitees")).alias("invitees"),
                   F.sum(safe_int("numRegistrations")).alias("registrations"),
                   F.count("Response").alias("responses")))


def _owner_long(sm: DataFrame) -> DataFrame:
    """Both owner dimensions as rows ``(owner_type, owner, ...)`` — one Expand-like explode."""
    pairs = F.array(*[F.struct(F.lit(o).alias("owner_type"), F.col(o).alias("owner")) for o in OWNERS])
    return sm.select("*", F.explode(pairs).alias("__o")).select("*", "__o.owner_type", "__o.owner") \
             .drop("__o").filter(F.col("owner").isNotNull())


def owner_totals(sm: DataFrame) -> DataFrame:
    """Totals over A5 for both owner types (rows with a NULL owner excluded)."""
    return (_owner_long(sm).groupBy("owner_type")
            .agg(F.count("Client_Name").alias("invites_sent"),
                 F.sum(safe_int("numInvitees")).alias("invitees"),
                 F.sum(safe_int("numRegistrations")).alias("registrations"),
                 F.count("Response").alias("responses")))


def owner_response(sm: DataFrame, sc: DataFrame) -> DataFrame:
    """Weighted response by owner on the master and on each role table (8 instances
    of the reference) in one aggregation over ``source ∈ {master, tax, cfo, other}``."""
    m = sm.select(F.lit("master").alias("source"), *OWNERS, "Response", "Response_Weight")
    c = sc.select(F.col("role").alias("source"), *OWNERS, "Response", "Response_Weight")
    return (_owner_long(m.unionByName(c)).filter(F.col("Response").isNotNull())
            .groupBy("source", "owner_type", "owner", F.col("Response").alias("response"))
            .agg(F.sum("Response_Weight").alias("weight")))


def owner_response_once(sm: DataFrame, roles: Sequence[str] = ROLE_ORDER) -> DataFrame:
    """A7 from the standardised master alone, read once: each row counts for itself and for its present contacts, whose
    owners and response are the row's own (names are title-cased before the fan-out, not per contact).

    One aggregation by (source, owners, response) comes first; J1's key sets — heads and partners that occur in the master —
    and the report are taken from that small table.
    """
    sources = [F.struct(F.lit("master").alias("source"), F.lit(True).alias("there"))]
    sources += [F.struct(F.lit(r).alias("source"), present(ROLES[r].phone).alias("there")) for r in roles]
    x = sm.select(*OWNERS, "Response", "Response_Weight", F.explode(F.array(*sources)).alias("s")).filter("s.there")
    g = materialized(x.groupBy(F.col("s.source").alias("source"), *OWNERS, "Response").agg(F.sum("Response_Weight").alias("Response_Weight")))
    contacts = cascade_filter(g.filter("source <> 'master'"), g.filter("source = 'master'"))
    return (_owner_long(g.filter("source = 'master'").unionByName(contacts)).filter(F.col("Response").isNotNull())
            .groupBy("source", "owner_type", "owner", F.col("Response").alias("response")).agg(F.sum("Response_Weight").alias("weight")))


def owner_cross(sm: DataFrame) -> DataFrame:
    """Row counts for (head, sector), (head, location), (partner, location)."""
    pairs = F.array(
        F.struct(F.lit("head_sector").alias("pair"), F.col("Practice_Head").alias("k1"), F.col("Sector").alias("k2")),
        F.struct(F.lit("head_location").alias("pair"), F.col("Practice_Head").alias("k1"),
                 F.col("Location").alias("k2")),
        F.struct(F.lit("partner_location").alias("pair"), F.col("Partner").alias("k1"),
                 F.col("Location").alias("k2")))
    return (sm.select(F.explode(pairs).alias("p")).select("p.*")
              .filter(F.col("k1").isNotNull() & F.col("k2").isNotNull())
              .groupBy("pair", "k1", "k2").agg(F.count(F.lit(1)).alias("row_count")))


def owner_sector_rollup(sm: DataFrame) -> DataFrame:
    """A8 hierarchy (head -> sector sunburst): ``rollup`` with the level of each row."""
    base = sm.filter(F.col("Practice_Head").isNotNull() & F.col("Sector").isNotNull())
    g = base.rollup("Practice_Head", "Sector").agg(F.count(F.lit(1)).alias("row_count"),
                                                   F.grouping_id().alias("gid"))
    level = F.when(F.col("gid") == 0, "sector").when(F.col("gid") == 1, "head").otherwise("total")
    return g.select(level.alias("level"), "Practice_Head", "Sector", "row_count")


def role_kpis(sc: DataFrame) -> DataFrame:
    """Per role — contacts, registered (P6 on the contact response), response rate
    on the client-level response excluding 'awaited'."""
    n = F.count(F.lit(1))
    return sc.groupBy("role").agg(n.alias("total"),
                                  F.count_if(is_registered("contact_response")).alias("registered"),
                                  _rate(F.count_if(_responded(F.col("Response"))), n).alias("response_rate"))


def role_responses(sc: DataFrame) -> DataFrame:
    """Weighted client-level response distribution per role."""
    return (sc.filter(F.col("Response").isNotNull())
              .groupBy("role", F.col("Response").alias("response"))
              .agg(F.sum("Response_Weight").alias("weight")))


def role_region(sc: DataFrame) -> DataFrame:
    """A10: per role and region — invited, registered, positive, confirmed, unregistered, rate;
    regions with no confirmed contact dropped; by confirmed descending."""
    clean = clean_response("contact_response")
    g = (sc.filter(F.col("location").isNotNull())
           .groupBy("role", region_of("location").alias("region"))
           .agg(F.count("phone").alias("total_invited"),
                F.count_if(clean == "registered").alias("registered"),
                F.count_if(clean == "positive").alias("positive_responses")))
    confirmed = F.col("registered") + F.col("positive_responses")
    return (g.select("role", "region", "total_invited", "registered", "positive_responses",
                     confirmed.alias("total_confirmed"),
                     (F.col("total_invited") - confirmed).alias("unregistered"),
                     round2(confirmed / F.col("total_invited") * F.lit(100.0)).alias("registration_rate"))
             .filter(F.col("total_confirmed") > 0)
             .orderBy(F.desc("total_confirmed"), "role", "region"))


def cfo_sector_counts(sc: DataFrame) -> DataFrame:
    """Contacts per sector for one role (the CFO tab's sector chart)."""
    return (sc.filter((F.col("role") == "cfo") & F.col("Sector").isNotNull())
              .groupBy(F.col("Sector").alias("sector")).agg(F.count(F.lit(1)).alias("row_count")))


def metrics(sm: DataFrame) -> DataFrame:
    """Conversion, response rate (all non-NULL responses), pending follow-ups, circle backs."""
    n = F.count(F.lit(1))
    inv = F.sum(safe_int("numInvitees"))
    reg = F.sum(safe_int("numRegistrations"))
    return sm.agg(conversion_rate(reg, inv).alias("conversion_rate"),
                  _rate(F.count("Response"), n).alias("response_rate"),
                  F.count_if(F.col("Response").isNull()).alias("pending_followups"),
                  F.count("Circle_Back_Dt").alias("circle_backs"))


def invite_trend(sm: DataFrame, date_col: str = "Invite_Dt") -> DataFrame:
    """Invites per day; unparseable dates drop out.

    They drop out as the group that counts no date: a filter on the date itself would move below the aggregation and parse
    every text twice."""
    return (sm.select(parse_date(date_col).alias("invite_date")).groupBy("invite_date")
              .agg(F.count("invite_date").alias("invites")).filter(F.col("invites") > 0))


def funnel(sm: DataFrame) -> DataFrame:
    """Clients -> invitees -> responses -> registrations, with percent of the first stage."""
    a = sm.agg(F.count(F.lit(1)).alias("s1"), F.sum(safe_int("numInvitees")).alias("s2"),
               F.count("Response").alias("s3"), F.sum(safe_int("numRegistrations")).alias("s4"))
    long = a.selectExpr("s1", "stack(4, 1, 'Total Clients', s1, 2, 'Total Invitees', s2, "
                              "3, 'Responses', s3, 4, 'Registrations', s4) as (stage_no, stage, value)")
    return long.select(F.col("stage_no").cast("int").alias("stage_no"), "stage",
                       F.col("value").cast("bigint").alias("value"),
                       _rate(F.col("value"), F.col("s1")).alias("pct_initial"))


def filter_options(sm: DataFrame) -> DataFrame:
    """Sorted distinct non-NULL values of each filter dimension."""
    from rsvpflow.operators.filters import FILTER_COLUMNS
    dims = F.array(*[F.struct(F.lit(k).alias("dimension"), F.col(c).cast("string").alias("value"))
                     for k, c in FILTER_COLUMNS.items()])
    return (sm.select(F.explode(dims).alias("d")).select("d.*").filter(F.col("value").isNotNull())
              .distinct().orderBy("dimension", "value"))

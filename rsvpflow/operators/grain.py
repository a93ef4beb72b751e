"""One mergeable table under all reports: the filter dimensions and role, with additive measures.

``report_grain`` reads the standardised master once; every row gives one row for itself and one per contact, and one
aggregation adds them up by ``DIMS``.  Every report of ``operators.reports``, under any filter spec, is a roll-up of that
table (``reports_from``), whose size follows the distinct dimension values, not the master.

The measures are sums, so grains add up (``merged``): those of parts of a table, or of changes with a sign — the OLD image
of a changed row counts -1 and its NEW image +1, in whatever order the changes come; a group that nets to no rows vanishes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rsvpflow.functions.scalars import (clean_response, conversion_rate, is_registered, parse_date, present, region_of, round2,
                                        safe_int, title_case)
from rsvpflow.operators.filters import FILTER_COLUMNS, filter_master
from rsvpflow.operators.joins import key_join
from rsvpflow.operators.reports import OWNERS
from rsvpflow.roles import ROLE_ORDER, ROLES

__all__ = ["DIMS", "MEASURES", "image_rows", "report_grain", "merged", "reports_from"]

#: ``source`` is ``master`` or a role; ``place`` the location of a master row, the region of a contact.
DIMS = ("source", "Practice_Head", "Partner", "Sector", "place", "Response", "day")
MEASURES = ("n", "clients", "invitees", "registrations", "responded", "weight", "circle_backs", "registered", "confirmed", "positive")


def image_rows(sm: DataFrame, roles: Sequence[str] = ROLE_ORDER, date_col: str = "Invite_Dt", sign: Column | None = None) -> DataFrame:
    """Rows of ``DIMS`` and ``MEASURES`` (times ``sign``): per standardised master row itself and its present contacts."""
    nothing = F.lit(None).cast("string")

    def image(source, phone, place, response, day):
        return F.struct(F.lit(source).alias("source"), phone.alias("phone"), place.alias("place"), response.alias("said"), day.alias("day"))

    images = [image("master", nothing, F.col("Location"), nothing, parse_date(date_col))]
    for r in roles:
        spec = ROLES[r]
        # a role whose tables show the location title-cased reads it so (a no-op on the master's own, titled already)
        where = title_case(spec.location) if "location" in spec.titled_fields else F.col(spec.location)
        images.append(image(r, F.col(spec.phone), F.when(where.isNotNull(), region_of(where)), F.col(spec.response), F.lit(None).cast("date")))
    own = [F.col(c) for c in ("Practice_Head", "Partner", "Sector", "Response")]
    x = sm.select(*own, F.lit(1).cast("bigint").alias("_one") if sign is None else sign.cast("bigint").alias("_one"),
                  F.col("Client_Name").isNotNull().alias("_client"), F.col("Circle_Back_Dt").isNotNull().alias("_back"),
                  safe_int("numInvitees").alias("_inv"), safe_int("numRegistrations").alias("_reg"), F.col("Response_Weight").alias("_weight"),
                  F.explode(F.array(*images)).alias("_i"))
    master = F.col("_i.source") == "master"
    x = x.filter(master | present("_i.phone"))
    clean, answered = clean_response("_i.said"), F.col("Response").isNotNull()
    values = {"n": F.lit(1), "clients": (master & F.col("_client")).cast("int"), "invitees": F.when(master, F.col("_inv")),
              "registrations": F.when(master, F.col("_reg")), "responded": (answered & (F.lower("Response") != "awaited")).cast("int"),
              "weight": F.when(answered, F.col("_weight")), "circle_backs": (master & F.col("_back")).cast("int"),
              "registered": is_registered("_i.said").cast("int"), "confirmed": (clean == "registered").cast("int"),
              "positive": (clean == "positive").cast("int")}
    dims = {"source": F.col("_i.source"), "place": F.col("_i.place"), "day": F.col("_i.day")}
    return x.select(*[dims.get(d, F.col(d)).alias(d) for d in DIMS],
                    *[(F.coalesce(v.cast("bigint"), F.lit(0)) * F.col("_one")).alias(m) for m, v in values.items()])


def merged(rows: DataFrame) -> DataFrame:
    """Sums by ``DIMS``; groups that net to nothing vanish."""
    g = rows.groupBy(*DIMS).agg(*[F.sum(m).alias(m) for m in MEASURES])
    empty = F.lit(True)
    for m in MEASURES:
        empty = empty & (F.col(m) == 0)
    return g.filter(~empty)


def report_grain(sm: DataFrame, roles: Sequence[str] = ROLE_ORDER, date_col: str = "Invite_Dt") -> DataFrame:
    """The grain of a standardised master: one scan, one aggregation."""
    return merged(image_rows(sm, roles, date_col))


def _rate(num: Column, den: Column) -> Column:
    return F.when(den > 0, round2(num / den * F.lit(100.0))).otherwise(F.lit(0.0))


def _count(c: str | Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0).cast("bigint"))


def reports_from(grain: DataFrame, filters: Mapping[str, Sequence[str]] | None = None, cascade: bool = True) -> dict[str, DataFrame]:
    """Every report of ``plans.jobs.reports`` (same names, columns and rows) as a roll-up of the grain.

    Contacts are filtered as J1 says: their head and their partner each occur in the filtered master (so contacts without
    either drop out); with ``cascade=False`` all contacts count, as in the reports over the whole tables.
    """
    every = grain.filter(F.col("source") == "master").withColumnRenamed("place", "Location").filter(F.col("n") > 0)
    fm = filter_master(every, filters)
    contacts = grain.filter((F.col("source") != "master") & (F.col("n") > 0)).withColumnRenamed("source", "role")
    for c in OWNERS if cascade else ():
        keys = fm.select(F.col(c).alias("__k")).filter("__k is not null").distinct()
        contacts = key_join(contacts, keys, F.col(c) == F.col("__k"), "left_semi")
    answered, n = F.col("Response").isNotNull(), F.sum("n")
    owner_sums = [F.sum("clients").alias("invites_sent"), F.sum("invitees").alias("invitees"), F.sum("registrations").alias("registrations"),
                  F.sum(F.when(answered, F.col("n")).otherwise(0)).alias("responses")]

    def owners(df):
        pairs = F.explode(F.array(*[F.struct(F.lit(o).alias("owner_type"), F.col(o).alias("owner")) for o in OWNERS]))
        return df.select("*", pairs.alias("__o")).select("*", "__o.*").drop("__o").filter("owner is not null")

    def owner_stats(col):
        return fm.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("owner")).agg(*owner_sums)

    crosses = F.explode(F.array(*[F.struct(F.lit(name).alias("pair"), F.col(a).alias("k1"), F.col(b).alias("k2")) for name, a, b in (
        ("head_sector", "Practice_Head", "Sector"), ("head_location", "Practice_Head", "Location"), ("partner_location", "Partner", "Location"))]))
    sectors = (fm.filter("Sector is not null").groupBy(F.col("Sector").alias("sector"))
               .agg(F.sum("invitees").alias("invitees"), F.sum("registrations").alias("registrations")))
    both = fm.withColumn("source", F.lit("master")).select("source", *OWNERS, "Response", "weight").unionByName(
        contacts.withColumnRenamed("role", "source").select("source", *OWNERS, "Response", "weight"))
    roll = (fm.filter("Practice_Head is not null and Sector is not null").rollup("Practice_Head", "Sector")
            .agg(n.alias("row_count"), F.grouping_id().alias("gid")))
    regions = (contacts.filter("place is not null").groupBy("role", F.col("place").alias("region"))
               .agg(n.alias("total_invited"), F.sum("confirmed").alias("registered"), F.sum("positive").alias("positive_responses")))
    sure = F.col("registered") + F.col("positive_responses")
    stages = fm.agg(_count("n").alias("s1"), F.sum("invitees").alias("s2"), _count(F.when(answered, F.col("n"))).alias("s3"), F.sum("registrations").alias("s4"))
    dims = F.explode(F.array(*[F.struct(F.lit(k).alias("dimension"), F.col(c).cast("string").alias("value")) for k, c in FILTER_COLUMNS.items()]))
    return {
        "overview": fm.agg(_count("n").alias("total_clients"), F.sum("invitees").alias("total_invitees"), F.sum("registrations").alias("registrations"),
                           _rate(_count("responded"), _count("n")).alias("response_rate")),
        "response_weights": fm.filter(answered).groupBy(F.col("Response").alias("response")).agg(F.sum("weight").alias("weight")),
        "sector_perf": sectors.withColumn("conversion", conversion_rate(F.col("registrations"), F.col("invitees"))),
        "region_counts": fm.filter("Location is not null").groupBy(region_of("Location").alias("region")).agg(n.alias("row_count"))
                           .orderBy(F.desc("row_count"), "region"),
        "owner_stats_head": owner_stats("Practice_Head"), "owner_stats_partner": owner_stats("Partner"),
        "owner_totals": owners(fm).groupBy("owner_type").agg(*owner_sums),
        "owner_response": owners(both).filter(answered).groupBy("source", "owner_type", "owner", F.col("Response").alias("response"))
                                      .agg(F.sum("weight").alias("weight")),
        "owner_cross": fm.select("n", crosses.alias("p")).select("n", "p.*").filter("k1 is not null and k2 is not null")
                         .groupBy("pair", "k1", "k2").agg(n.alias("row_count")),
        "owner_sector_rollup": roll.select(F.when(F.col("gid") == 0, "sector").when(F.col("gid") == 1, "head").otherwise("total").alias("level"),
                                           "Practice_Head", "Sector", "row_count"),
        "role_kpis": contacts.groupBy("role").agg(n.alias("total"), F.sum("registered").alias("registered"),
                                                  _rate(F.sum("responded"), n).alias("response_rate")),
        "role_responses": contacts.filter(answered).groupBy("role", F.col("Response").alias("response")).agg(F.sum("weight").alias("weight")),
        "role_region": regions.select("role", "region", "total_invited", "registered", "positive_responses", sure.alias("total_confirmed"),
                                      (F.col("total_invited") - sure).alias("unregistered"),
                                      round2(sure / F.col("total_invited") * F.lit(100.0)).alias("registration_rate"))
                              .filter("total_confirmed > 0").orderBy(F.desc("total_confirmed"), "role", "region"),
        "cfo_sectors": contacts.filter((F.col("role") == "cfo") & F.col("Sector").isNotNull()).groupBy(F.col("Sector").alias("sector")).agg(n.alias("row_count")),
        "metrics": fm.agg(conversion_rate(F.sum("registrations"), F.sum("invitees")).alias("conversion_rate"),
                          _rate(_count(F.when(answered, F.col("n"))), _count("n")).alias("response_rate"),
                          _count(F.when(~answered, F.col("n"))).alias("pending_followups"), _count("circle_backs").alias("circle_backs")),
        "invite_trend": fm.filter("day is not null").groupBy(F.col("day").alias("invite_date")).agg(n.alias("invites")),
        "funnel": stages.selectExpr("s1", "stack(4, 1, 'Total Clients', s1, 2, 'Total Invitees', s2, 3, 'Responses', s3, 4, 'Registrations', s4) "
                                    "as (stage_no, stage, value)")
                        .select(F.col("stage_no").cast("int").alias("stage_no"), "stage", F.col("value").cast("bigint").alias("value"),
                                _rate(F.col("value"), F.col("s1")).alias("pct_initial")),
        "filter_options": every.select(dims.alias("d")).select("d.*").filter("value is not null").distinct().orderBy("dimension", "value"),
    }

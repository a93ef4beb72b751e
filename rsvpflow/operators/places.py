"""F4 with a place table: a text gets the label of the first place, by rank, whose name it contains.

A pattern of all names does not scale with the table.  Here every *distinct* text is cut into one short window per position,
as long as the heads of the names (their first ``HEAD`` characters, or what the shortest name has); a join with the distinct
heads leaves the positions where a name may begin, with the lengths that names of this head have.  Only these are cut to
whole windows and equi-joined with the names: the work follows the distinct texts, and what is shuffled the windows whose
head names have, not all windows of all lengths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rsvpflow.functions.scalars import REGIONS, strip
from rsvpflow.operators.joins import key_join, materialized
from rsvpflow.operators.merge import free_name

__all__ = ["region_places", "label_places"]

#: Characters of a name by which the positions of a text are sieved.
HEAD = 4


def region_places(spark) -> DataFrame:
    """The fixed regions as a place table (name, label, rank)."""
    rows = [(city, region, k) for k, (region, cities) in enumerate(REGIONS) for city in cities]
    return spark.createDataFrame(rows, "name string, label string, rank long")


def label_places(df: DataFrame, col: str, places: DataFrame, out: str = "region", default: str = "Other", unknown: str = "Unknown") -> DataFrame:
    """``df`` with ``out``: the label of the smallest ``rank`` in ``places`` (name, label, rank) whose name occurs in ``col``,
    case-insensitively; ``default`` where none does, ``unknown`` where ``col`` is NULL.  Of one name listed twice the smaller
    rank (then label) counts; empty and NULL names are no places.

    Nothing but the length of the shortest name comes to the driver.
    """
    names = materialized(places.select(F.lower("name").alias("name"), "label", "rank").filter("name <> ''")
                         .groupBy("name").agg(F.min(F.struct("rank", "label")).alias("place")))
    shortest = names.agg(F.min(F.length("name"))).first()[0]
    text = F.lower(strip(col))
    texts = df.select(text.alias("t")).filter("t <> ''").distinct()
    key = free_name("__t", df.columns)
    if shortest:
        head = min(HEAD, shortest)
        heads = names.groupBy(F.substring("name", 1, head).alias("head")).agg(F.collect_set(F.length("name")).alias("ks"))
        at = texts.filter(F.length("t") >= head).select("t", F.explode(F.sequence(F.lit(1), F.length("t") - head + 1)).alias("i"))
        begun = key_join(at.select("t", "i", F.substring("t", F.col("i"), head).alias("head")), heads, "head", "inner")
        cut = begun.select("t", "i", F.explode("ks").alias("k")).filter(F.col("i") + F.col("k") - 1 <= F.length("t"))
        windows = cut.select("t", F.substring("t", F.col("i"), F.col("k")).alias("name"))
        found = key_join(windows, names, "name", "inner", materialize=False).groupBy("t").agg(F.min("place").alias("place")).select(
            F.col("t").alias(key), F.col("place.label").alias(f"{key}l"))
    else:
        found = texts.limit(0).select(F.col("t").alias(key), F.col("t").alias(f"{key}l"))
    j = key_join(df, materialized(found), text == F.col(key), "left", materialize=False)
    return j.select(*[F.col(f"`{c}`") for c in df.columns], F.when(F.col(col).isNull(), unknown).otherwise(F.coalesce(f"{key}l", F.lit(default))).alias(out))

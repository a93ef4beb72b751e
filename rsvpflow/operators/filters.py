"""Dashboard filters: conjunctive multi-select (P5) and the cascading contact filter."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rsvpflow.operators.joins import fits_broadcast

__all__ = ["FILTER_COLUMNS", "filter_master", "cascade_filter"]

# Filter-spec keys and the master columns they select on.
FILTER_COLUMNS = {"ph": "Practice_Head", "partner": "Partner", "sector": "Sector", "loc": "Location",
                  "resp": "Response"}


ISIN_MAX = 1000


def filter_master(master: DataFrame, filters: Mapping[str, Sequence[str]] | None) -> DataFrame:
    """P5: keep rows whose column value is in every non-empty selection list (empty = no filter).

    Selection lists come from a UI and are small literal lists -> ``isin`` (pushed to the
    Parquet scan as an ``In`` filter when the column is a stored column).
    """
    out = master
    for k, values in (filters or {}).items():
        if not values:
            continue
        col = FILTER_COLUMNS[k]
        if len(values) <= ISIN_MAX:
            out = out.filter(F.col(col).isin(list(values)))
        else:
            # a long selection: broadcast semi join; its size is the list length (a proven bound)
            sel = master.sparkSession.createDataFrame([(v,) for v in dict.fromkeys(values)], f"__v {master.schema[col].dataType.simpleString()}")
            out = out.join(F.broadcast(sel), F.col(col) == F.col("__v"), "left_semi")
    return out


def cascade_filter(contacts: DataFrame, filtered_master: DataFrame, head_col: str = "Practice_Head",
                   partner_col: str = "Partner") -> DataFrame:
    """Keep a contact when its head is among the heads of the filtered master **and** its
    partner is among the partners — two independent semi joins, not a pair match.

    NULL keys drop out on both sides.  The distinct (head, partner) pairs are aggregated
    map-side in one pass and persisted; both key sets are broadcast only when that pair set
    passes the size check (``fits_broadcast``), else the semi joins shuffle.  An empty
    filtered master yields no contacts.
    """
    # one pass over the filtered master: distinct (head, partner) pairs, aggregated map-side;
    # both key sets are then derived from that small persisted set
    pairs, small = fits_broadcast(filtered_master.select(F.col(head_col).alias("__h"), F.col(partner_col).alias("__p"))
                                  .filter(F.col("__h").isNotNull() | F.col("__p").isNotNull()).distinct())
    heads = pairs.select("__h").filter(F.col("__h").isNotNull()).distinct()
    partners = pairs.select("__p").filter(F.col("__p").isNotNull()).distinct()
    hb = F.broadcast(heads) if small else heads
    pb = F.broadcast(partners) if small else partners
    out = contacts.join(hb, F.col(head_col) == F.col("__h"), "left_semi")
    return out.join(pb, F.col(partner_col) == F.col("__p"), "left_semi")

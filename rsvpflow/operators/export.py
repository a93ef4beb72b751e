"""Contact-card export with a replay-safe ledger.

The reference selects eligible rows, writes one file, then issues one UPDATE per
row.  Here eligibility is an anti join against an append-only ledger, cards are a
column expression, the file write is partition-parallel, and the ledger append is
keyed by a batch id so a rerun of the same batch overwrites instead of duplicating.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rsvpflow.functions.scalars import numeric_prefix, present, vcard_card
from rsvpflow.operators.joins import key_join, materialized
from rsvpflow.sources.sinks import write_cards
from rsvpflow.sources.tables import path_exists

__all__ = ["LEDGER_SCHEMA", "eligible_contacts", "contact_cards", "mark_exported", "export_cards",
           "empty_ledger"]

LEDGER_SCHEMA = "role string, phone string, exported_at timestamp_ntz, batch_id string"


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER_SCHEMA)


def eligible_contacts(details: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """P10: not exported yet, phone present, ``numRegistrations = 1`` and contact response
    ``>= 0`` under MySQL's text->number coercion (F9)."""
    cond = (present("phone") & (numeric_prefix("numRegistrations") == F.lit(1.0))
            & F.col("contact_response").isNotNull() & (numeric_prefix("contact_response") >= F.lit(0.0)))
    out = details.filter(cond)
    if ledger is not None:
        out = key_join(out, ledger.select("role", "phone").distinct(), ["role", "phone"], "left_anti")
    return out


def contact_cards(eligible: DataFrame) -> DataFrame:
    """one vCard text per eligible contact."""
    return eligible.select("role", "id", "client", "name", "phone",
                           vcard_card("name", "designation", "client", "phone", "email").alias("card"))


def mark_exported(details: DataFrame, ledger: DataFrame) -> DataFrame:
    """Export status (0/1) and time per contact, from the ledger (set-based, no per-row UPDATE)."""
    led = ledger.groupBy("role", "phone").agg(F.max("exported_at").alias("Contact_File_Created_Time_Stamp"))
    j = details.join(led, ["role", "phone"], "left")
    return j.select(*details.columns,
                    F.when(F.col("Contact_File_Created_Time_Stamp").isNotNull(), 1).otherwise(0)
                    .cast("int").alias("Contact_Created_Status"),
                    "Contact_File_Created_Time_Stamp")


def export_cards(spark: SparkSession, details: DataFrame, ledger_path: str, out_path: str, batch_id: str,
                 batch_ts: Column | None = None) -> DataFrame:
    """K6: export job.  Writes the cards of a batch to ``<out>/batch_id=<id>/role=<role>`` (sorted by client,
    contact inside each role folder), then its keys to ``<ledger>/batch_id=<id>``.  Other batches' folders are never
    touched, and a rerun replaces its own, so it is idempotent.  Eligibility is worked out once and staged; cards and
    ledger come from the same rows.  Returns the ledger rows of this batch."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch_id):
        raise ValueError(f"batch id {batch_id!r}: letters, digits, '_', '.' and '-' only (it names a folder)")
    ledger = spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path) if path_exists(spark, ledger_path) else empty_ledger(spark)
    ledger = ledger.filter(F.col("batch_id") != batch_id)  # a rerun replaces its own batch
    elig = materialized(eligible_contacts(details, ledger).select("role", "id", "client", "name", "phone", "designation", "email"))
    cards = contact_cards(elig)
    # range partitioning on the sort key: balanced tasks (a role may hold a third of all cards),
    # each task's output sorted (O1); the writer splits it into role folders
    order = ["role", "client", "name", "phone"]
    write_cards(cards.repartitionByRange(*order).sortWithinPartitions(*order), f"{out_path.rstrip('/')}/batch_id={batch_id}")
    ts = batch_ts if batch_ts is not None else F.current_timestamp()
    new = elig.select("role", "phone", ts.cast("timestamp_ntz").alias("exported_at"))
    new.write.mode("overwrite").parquet(f"{ledger_path.rstrip('/')}/batch_id={batch_id}")
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path).filter(F.col("batch_id") == batch_id)

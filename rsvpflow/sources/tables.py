"""Table scans, header cleaning, profiling, schema evolution, inventory."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StringType, StructField, StructType

__all__ = [
    "TEST_TABLES", "read_table", "read_table_any", "table_exists", "path_exists", "path_inventory", "read_checked", "read_file", "clean_header", "clean_headers",
    "nan_to_null", "align_names", "column_profile", "evolve_schema", "row_count",
    "common_columns",
]

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Scan one table stored as ``<base>/<name>.parquet`` (file or directory).

    Column pruning and filter pushdown reach the Parquet reader because the
    plan stays declarative.
    """
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def table_exists(spark: SparkSession, base: str, name: str) -> bool:
    """Existence check of ``<base>/<name>.parquet`` (file-system metadata only)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{name}.parquet")
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def read_table_any(spark: SparkSession, base: str, names: Sequence[str]) -> DataFrame:
    """S7 with name fallback: the first of ``names`` that exists (e.g. ``Tax_Persons_Analysis``
    then ``tax_persons_analysis``)."""
    for n in names:
        if table_exists(spark, base, n):
            return read_table(spark, base, n)
    raise FileNotFoundError(f"none of {list(names)} under {base}")


def read_file(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType | str | None = None,
              header: bool = True, mode: str = "PERMISSIVE", null_value: str = "\\N", **options) -> DataFrame:
    """Tabular file scan (re-aimed spreadsheet load). Declare ``schema`` in production."""
    reader = spark.read.format(fmt).option("mode", mode)
    if fmt == "csv":
        reader = (reader.option("header", header).option("ignoreLeadingWhiteSpace", False)
                        .option("ignoreTrailingWhiteSpace", False).option("nullValue", null_value))
        if schema is None:
            reader = reader.option("inferSchema", True)
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def clean_header(name: str | None, position: int, blank_rule: bool = True) -> str:
    """Header cleaning of one column name.

    blank / NaN -> ``Unnamed_Column_{i+1}``; trim; space -> ``_``; ``#`` -> ``num``;
    ``-`` -> ``_``; any other non-alphanumeric, non-underscore char -> ``_``.
    The key-column name gets the same replacements without the blank rule.
    """
    if blank_rule and (name is None or str(name).strip() == "" or str(name).lower() == "nan"):
        return f"Unnamed_Column_{position + 1}"
    s = str(name).strip().replace(" ", "_").replace("#", "num").replace("-", "_")
    return "".join(c if c.isalnum() or c == "_" else "_" for c in s)  # letters of any script stay


def clean_headers(df: DataFrame) -> DataFrame:
    """Apply S2 to every column (metadata-only rename, no data pass). Fails on collisions."""
    names = [clean_header(c, i) for i, c in enumerate(df.columns)]
    low = [n.lower() for n in names]  # column names ignore case
    dup = {n for n in names if low.count(n.lower()) > 1}
    if dup:
        raise ValueError(f"header cleaning produced duplicate names: {sorted(dup)}")
    return df.toDF(*names)


def align_names(df: DataFrame, target: DataFrame) -> DataFrame:
    """``df`` with its columns spelled as in ``target`` where they differ in case only."""
    spelled = {c.lower(): c for c in target.columns}
    return df.toDF(*[spelled.get(c.lower(), c) for c in df.columns])


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN -> NULL on floating columns."""
    fl = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)).alias(c) if c in fl
                       else F.col(c) for c in df.columns])


def _type_name(dt: T.DataType) -> str:
    """SQL type the reference would create for a column of this Spark type."""
    if isinstance(dt, T.StringType):
        return "VARCHAR"
    if isinstance(dt, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return "INT"
    if isinstance(dt, (T.DoubleType, T.FloatType, T.DecimalType)):
        return "FLOAT"
    return "TEXT"


def column_profile(df: DataFrame) -> DataFrame:
    """One-pass column profile.

    Output per column: column_name, position, sql_type, non_null, max_len (text only),
    suggested_len = least(int(1.5*max_len)+50, 1000), or 255 when no value.
    A single aggregation (partial + final) computes every column's stats; the wide
    row is then unpivoted with ``stack`` — no per-column scans.
    """
    aggs = []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        aggs.append(F.count(c).alias(f"nn_{i}"))
        if isinstance(f.dataType, T.StringType):
            aggs.append(F.max(F.length(c)).cast("bigint").alias(f"ml_{i}"))
        else:
            aggs.append(F.lit(None).cast("bigint").alias(f"ml_{i}"))
    wide = df.agg(*aggs)
    rows = ", ".join(
        f"'{f.name}', {i}, '{_type_name(f.dataType)}', nn_{i}, ml_{i}" for i, f in enumerate(df.schema.fields))
    long = wide.selectExpr(
        f"stack({len(df.schema.fields)}, {rows}) as (column_name, position, sql_type, non_null, max_len)")
    suggested = F.when(F.col("sql_type") != "VARCHAR", F.lit(None).cast("bigint")).when(
        F.col("max_len").isNull(), F.lit(255).cast("bigint")).otherwise(
        F.least(F.floor(F.col("max_len") * 1.5).cast("bigint") + 50, F.lit(1000).cast("bigint")))
    return long.select(F.col("column_name"), F.col("position").cast("int").alias("position"), "sql_type",
                       "non_null", "max_len", suggested.alias("suggested_len"))


def evolve_schema(target: DataFrame, source: DataFrame) -> DataFrame:
    """Additive schema evolution — columns of ``source`` missing in ``target`` are added
    (NULL-filled, source type); existing columns are never dropped or retyped."""
    have = {c.lower() for c in target.columns}
    extra = [f for f in source.schema.fields if f.name.lower() not in have]
    return target.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in extra])


def common_columns(a: DataFrame, b: DataFrame, exclude: Sequence[str] = ("id", "S_No", "Data_Insert_Time",
                                                                         "Last_Updated")) -> list[str]:
    """P11 helper: shared column names (in ``a``'s order) minus audit columns."""
    bset = set(b.columns)
    ex = set(exclude)
    return [c for c in a.columns if c in bset and c not in ex]


def row_count(df: DataFrame, name: str) -> DataFrame:
    """``(table_name, row_count)`` as a one-row DataFrame (stays lazy)."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")


def path_inventory(spark: SparkSession, base: str, names: Sequence[str]) -> DataFrame:
    """S9 with existence: ``(table_name, present, row_count)``; a missing table has
    ``present = false`` and a NULL count."""
    parts = []
    for n in names:
        if table_exists(spark, base, n):
            parts.append(row_count(read_table(spark, base, n), n).select(
                "table_name", F.lit(True).alias("present"), "row_count"))
        else:
            parts.append(spark.createDataFrame([(n, False, None)], "table_name string, present boolean, row_count bigint"))
    out = spark.createDataFrame([], "table_name string, present boolean, row_count bigint") if not parts else parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_checked(spark: SparkSession, path: str, schema: StructType, checks: Mapping[str, Column] | None = None, header: bool = True,
                 **options) -> tuple[DataFrame, DataFrame]:
    """S1 with quarantine: a delimited scan split into good rows (``schema``) and rejects ``(record, reason)``; every input
    record is in exactly one of them.

    A record that does not parse under the schema (a value of another type, missing or surplus fields) is rejected as
    ``malformed`` with its text; one that parses is rejected by the first of ``checks`` (name -> condition on its columns)
    that is not true, with its fields as text.  Both frames are lazy; the parser sees all columns whatever is selected, so
    that no pruning changes what counts as malformed.
    """
    names = [f.name for f in schema.fields]
    raw = "_record"
    while raw in names:
        raw += "_"
    full = StructType([*schema.fields, StructField(raw, StringType())])
    rows = (spark.read.schema(full).options(mode="PERMISSIVE", columnNameOfCorruptRecord=raw, columnPruning=False, header=header,
                                                        **options).csv(path))
    cols = [F.col(f"`{c}`") for c in names]
    reason = F.when(F.col(raw).isNotNull(), F.lit("malformed"))
    for name, holds in (checks or {}).items():
        reason = reason.when(~F.coalesce(holds, F.lit(False)), F.lit(name))
    judged = rows.select(*cols, F.coalesce(F.col(raw), F.to_csv(F.struct(*cols))).alias(raw), reason.alias(f"{raw}_why"))
    why = F.col(f"{raw}_why")
    return judged.filter(why.isNull()).select(*cols), judged.filter(why.isNotNull()).select(F.col(raw).alias("record"), why.alias("reason"))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any filesystem."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

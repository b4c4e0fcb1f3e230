"""Loading, saving, appending and describing tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.operators.drift_stats import correlation
from tallywatch.schemas import DEFAULTS, NOW, REQUIRED, table_schema


def load_splits(
    spark: SparkSession, paths: dict[str, str], fmt: str = "parquet", columns: Sequence[str] | None = None, **options: str
) -> DataFrame:
    """Read one path per split into a single frame with a `split` column; columns missing in a split are NULL."""
    parts = []
    for split, path in paths.items():
        part = spark.read.format(fmt).options(**options).load(path)
        parts.append((part.select(*columns) if columns else part).withColumn("split", F.lit(split)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def save_splits(df: DataFrame, path: str) -> None:
    """Write the splits as partitions of one Parquet folder."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def load_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame], force_reload: bool = False) -> DataFrame:
    """The saved copy, unless there is none or a rebuild is forced; then build, save and read back."""
    if not force_reload:
        try:
            return spark.read.parquet(path)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    save_splits(build(), path)
    return spark.read.parquet(path)


def with_defaults(df: DataFrame, table: str, now: Column | None = None) -> DataFrame:
    """The rows in the table's schema: NULL or absent columns take their default, required columns must be there."""
    missing = [c for c in REQUIRED[table] if c not in df.columns]
    if missing:
        raise ValueError(f"{table} needs the columns {missing}")
    now = F.current_timestamp().cast("timestamp_ntz") if now is None else now
    columns = []
    for field in table_schema(table):
        given = F.col(field.name).cast(field.dataType) if field.name in df.columns else F.lit(None).cast(field.dataType)
        if field.name in DEFAULTS[table]:
            default = DEFAULTS[table][field.name]
            given = F.coalesce(given, now if default == NOW else F.lit(default).cast(field.dataType))
        columns.append(given.alias(field.name))
    return df.select(*columns)


def append_rows(df: DataFrame, table: str, path: str, now: Column | None = None) -> None:
    """Append runs, deployments, dataset metrics or alerts with their defaults filled in."""
    with_defaults(df, table, now).write.mode("append").parquet(path)


def prediction_rows(predictions: DataFrame, deployment_id: Column | None = None, now: Column | None = None) -> DataFrame:
    """Log rows of scored texts: hash, deployment and time are added; rows without a deployment are left out."""
    deployment = F.col("deployment_id") if deployment_id is None else deployment_id
    rows = predictions.withColumn("deployment_id", deployment).filter(F.col("deployment_id").isNotNull())
    hashed = rows.withColumn("input_hash", F.sha2("input_text", 256))
    with_id = hashed if "id" in hashed.columns else hashed.withColumn("id", F.sha2("request_id", 256))
    return with_defaults(with_id, "prediction_logs", now)


def log_predictions(predictions: DataFrame, path: str, deployment_id: Column | None = None) -> None:
    """Append log rows, partitioned by day so that lookbacks read only the days they need."""
    rows = prediction_rows(predictions, deployment_id).withColumn("predicted_on", F.to_date("predicted_at"))
    rows.write.mode("append").partitionBy("predicted_on").parquet(path)


def export_json(df: DataFrame, path: str) -> None:
    """Whole table as JSON lines; types JSON does not have become strings."""
    plain = ("string", "boolean", "tinyint", "smallint", "int", "bigint", "float", "double")
    columns = [
        F.col(f.name)
        if f.dataType.simpleString() in plain or f.dataType.simpleString().startswith(("array", "map", "struct"))
        else F.col(f.name).cast("string").alias(f.name)
        for f in df.schema
    ]
    df.select(*columns).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def run_sql(spark: SparkSession, query: str, tables: dict[str, DataFrame] | None = None, **params: object) -> DataFrame:
    """Run SQL with named parameters (`:name`); `tables` are visible as temporary views."""
    for name, df in (tables or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(query, args=params)


def table_info(df: DataFrame, table: str) -> DataFrame:
    """One row per column in order: name, type, nullability, default and the table's row count."""
    defaults = DEFAULTS.get(table, {})
    required = REQUIRED.get(table, ())
    columns = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("name"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.lit(f.nullable and f.name not in required).alias("nullable"),
                F.lit(None if f.name not in defaults else str(defaults[f.name])).cast("string").alias("default"),
            )
            for i, f in enumerate(df.schema)
        ]
    )
    counted = df.agg(F.count("*").alias("row_count"))
    return counted.select(F.lit(table).alias("table_name"), "row_count", F.inline(columns))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def column_profile(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Per column: rows, NULLs, least and greatest value as text, distinct values.

    Exact distinct counts group by (column, value) first, with partial sums before the shuffle; `exact=False` keeps a
    sketch per column in a single pass instead.
    """
    names = list(columns or df.columns)
    if exact:
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in names])
        counts = df.select(F.inline(pairs)).groupBy("column", "value").agg(F.count("*").alias("n"))
        distinct = counts.groupBy("column").agg(F.count("value").alias("n_distinct"))
        return _column_bounds(df, names).drop("n_distinct").join(distinct, "column", "left").withColumn(
            "n_distinct", F.coalesce("n_distinct", F.lit(0))
        )
    return _column_bounds(df, names)


def _column_bounds(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Everything about the columns that one pass can tell, distinct values from a sketch."""
    measured = df.agg(
        *[
            F.struct(
                F.count("*").alias("rows"),
                F.count_if(F.col(c).isNull()).alias("nulls"),
                F.min(c).cast("string").alias("min_value"),
                F.max(c).cast("string").alias("max_value"),
                F.approx_count_distinct(c).alias("n_distinct"),
            ).alias(c)
            for c in names
        ]
    )
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("p")) for c in names])
    return measured.select(F.inline(rows)).select("column", "p.*")


def order_correlation(df: DataFrame, order: str, columns: Sequence[str]) -> DataFrame:
    """Correlation of numeric columns with an ordering column: near 1 or -1 where the table is stored in their order."""
    measured = df.agg(*[correlation(c, order).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("correlation")) for c in columns])
    return measured.select(F.inline(rows))

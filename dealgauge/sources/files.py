"""CSV source, table reload, summaries as JSON, and publishing to a target."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealgauge.sources.schemas import RAW_TABLES
from dealgauge.sources.stages import measured
from dealgauge.sources.versions import TableSet

# Tables a deployment publishes, in publishing order.
PUBLISHED_TABLES = [
    "lead_summary", "ml_lead_scores", "ml_survival_predictions", "ml_clv_predictions",
    "ml_uplift_predictions", "leads_clean", "raw_leads", "raw_opportunities", "raw_activities",
    "raw_campaign_touches", "opportunities_clean", "activities_clean", "campaign_touches_clean",
    "dim_leads", "fact_opportunities", "fact_activities", "fact_campaign_touches",
]


def read_raw_csv(spark: SparkSession, path: str, table: str, multi_line: bool = True) -> DataFrame:
    """One raw table from CSV files with a header: columns are taken by name, in any order.

    Quotes inside quoted fields are doubled; ``multi_line`` allows line breaks in fields and can be
    switched off for files without any, which Spark then splits. A value that is not of its column's
    type is an error, not a null. ``ingest_seq`` numbers the rows from 0 in read order, which is what
    "keep the first copy" needs later: files by name, then splits by their place in the file, then rows.
    """
    text = spark.read.csv(path, header=True, escape='"', multiLine=multi_line)
    columns = spark.createDataFrame([], RAW_TABLES[table]).schema.fields
    return numbered(text.select(
        *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in columns],
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")), ["_file", "_block"])


def numbered(rows: DataFrame, place: Sequence[str]) -> DataFrame:
    """``ingest_seq`` in the order of ``place`` (file and start of the split) and of the rows inside it.

    A split is read by one task from its first row to its last, so ids that grow inside a task give the order there;
    ids of different tasks are not compared. The rows are written with their ids once; sizes of splits (one row each)
    give every split its first number. Tasks and their order do not show in the result."""
    read = measured(rows.withColumn("_id", F.monotonically_increasing_id()))
    splits = read.groupBy(*place).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    starts = measured(splits.select(*place, "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")))
    return read.join(starts, list(place)).withColumn(
        "ingest_seq", F.col("_id") - F.col("_first") + F.col("_start")).drop(*place, "_id", "_first", "_start")


def load_raw_folder(spark: SparkSession, folder: str, tables: TableSet) -> dict[str, str]:
    """Reload every raw table from ``<folder>/<table>.csv``, a file or a folder of files; all become visible together.

    All tables are emptied by a reload, so a table whose file is missing ends up empty.
    """
    outcome = {}
    with tables.reload() as batch:
        for table, schema in RAW_TABLES.items():
            try:
                rows = read_raw_csv(spark, f"{folder}/{table}.csv", table)
                outcome[table] = "loaded"
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
                outcome[table] = "skipped"
                rows = spark.createDataFrame([], schema).withColumn("ingest_seq", F.lit(None).cast("long"))
            batch.write(table, rows)
    return outcome


def stamp(predictions: DataFrame, **constants: object) -> DataFrame:
    """Prediction table with its constant columns and the time of scoring."""
    for name, value in constants.items():
        predictions = predictions.withColumn(name, F.lit(value))
    return predictions.withColumn("scored_at", F.current_timestamp())


def write_summary(summary: DataFrame, path: str) -> None:
    """Small summary (one row per metric or feature) as JSON lines, with its schema beside it."""
    summary.write.mode("overwrite").json(f"{path}/rows")
    told = summary.sparkSession.createDataFrame([(summary.schema.json(),)], "schema string")
    told.coalesce(1).write.mode("overwrite").text(f"{path}/schema")


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    told = spark.read.text(f"{path}/schema", wholetext=True).first()[0]
    return spark.read.schema(T.StructType.fromJson(json.loads(told))).json(f"{path}/rows")


def publish(tables: Mapping[str, DataFrame], target: str, fmt: str = "parquet", **options: str) -> list[str]:
    """Drop and replace each table at the target, in the order given.

    With ``fmt="jdbc"`` the target is the connection URL and each table keeps its name.
    """
    for name, rows in tables.items():
        writer = rows.write.mode("overwrite").format(fmt).options(**options)
        if fmt == "jdbc":
            writer.option("url", target).option("dbtable", name).save()
        else:
            writer.save(f"{target}/{name}")
    return list(tables)

"""Written stages: a table computed once, stored in the shared folder and read back."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from dealgauge.session import shared_dir


def _shared_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/stages/{spark.sparkContext.applicationId}"


def measured(rows: DataFrame) -> DataFrame:
    """The rows as a written table, so that Catalyst knows their true size.

    Without it an aggregate is planned at the size of its input: a join with a handful of group
    rates would shuffle all leads onto those few keys. With the true size a small table is
    broadcast under spark.sql.autoBroadcastJoinThreshold, and a large one is shuffled.
    """
    path = f"{_shared_root(rows.sparkSession)}/measured/{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


class StageStore:
    """Written tables of one application for one input folder.

    A stage cuts the lineage like a reliable checkpoint, keeps its columns prunable and gives
    Catalyst true file sizes. A lost executor costs only a re-read. Stages never outlive the
    application: its id is part of the path, so a new run never sees old data.

    With ``buckets`` above 0, stages written with a key are bucketed by it, one file per bucket:
    later joins on that key need no shuffle.
    """

    _schemas: dict[str, object] = {}

    def __init__(self, spark: SparkSession, scope: str, buckets: int = 0):
        self._spark = spark
        self._buckets = buckets
        digest = hashlib.sha1(scope.encode()).hexdigest()[:12]
        self._root = f"{_shared_root(spark)}/{digest}"
        application = re.sub(r"\W", "_", spark.sparkContext.applicationId)
        self._prefix = f"stage_{application}_{digest}"

    def _bucketed(self, name: str, build: Callable[[], DataFrame], key: str) -> DataFrame:
        table = f"{self._prefix}_{name}"
        if table not in self._schemas:
            rows = build()
            rows.repartition(self._buckets, key).write.mode("overwrite").format("parquet").bucketBy(
                self._buckets, key).sortBy(key).option("path", f"{self._root}/{name}").saveAsTable(table)
            self._schemas[table] = rows.schema
        return self._spark.table(table)

    def drop_tables(self) -> None:
        """Takes the bucketed stages out of the catalog; their files go with the application's folder."""
        for table in [t for t in self._schemas if t.startswith(self._prefix)]:
            self._spark.sql(f"DROP TABLE IF EXISTS {table}")
            del self._schemas[table]

    def table(
        self, name: str, build: Callable[[], DataFrame], partition_by: Sequence[str] = (), key: str | None = None,
    ) -> DataFrame:
        """Partition columns must come last in the built frame, as they do when it is read back."""
        if key and self._buckets:
            return self._bucketed(name, build, key)
        path = f"{self._root}/{name}"
        if path not in self._schemas:
            rows = build()
            rows.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
            self._schemas[path] = rows.schema
        return self._spark.read.schema(self._schemas[path]).parquet(path)

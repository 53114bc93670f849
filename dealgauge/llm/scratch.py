"""Written intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import contextlib
import gc
import pathlib
import tempfile
import time
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session; only where it is unset on a local master, a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir is not set: intermediate tables need a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _OWN:
        _OWN[application] = tempfile.mkdtemp(prefix="llm-")
    return _OWN[application]


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this subpackage to the executors once per application, so that their Python finds it."""
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    root = pathlib.Path(__file__).resolve().parents[2]
    archive = pathlib.Path(tempfile.mkdtemp(prefix="llm-")) / "llm_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in [root / "dealgauge/__init__.py", *sorted((root / "dealgauge/llm").glob("*.py"))]:
            out.write(file, file.relative_to(root))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(application)


_TRACKED: list[Scratch] | None = None


@contextlib.contextmanager
def tracked() -> Iterator[list[Scratch]]:
    """The scratch folders that are made inside the block."""
    global _TRACKED
    before, _TRACKED = _TRACKED, []
    try:
        yield _TRACKED
    finally:
        _TRACKED = before


class Scratch:
    """Tables of one run of an operator.

    A written table cuts the lineage and survives lost executors. `drop` removes tables that the
    result no longer reads; what the result still reads has to stay.
    """

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
        if _TRACKED is not None:
            _TRACKED.append(self)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        self.release()
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self, after: float = 0.0) -> None:
        """Let Spark's cleaner remove the shuffle files of finished steps: it follows garbage collection. Spark's events
        hold the plan of the last step a little longer; `after` so many seconds they are over."""
        time.sleep(after)
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def remove(self) -> None:
        """All tables of the run."""
        self.drop("")

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")

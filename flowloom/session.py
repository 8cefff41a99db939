"""Getting this package to the Python workers."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


@functools.cache
def _archive() -> str:
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="flowloom-")) / "flowloom.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    return str(target)


#: Bytes of an Arrow batch.
BATCH = "8m"
_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send the package's sources to the workers of this application, once, and bound the Arrow batches that workers get: rows can be long texts, and both sides hold a batch."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        spark.sparkContext.addPyFile(_archive())
        _shipped.add(application)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)
    return spark


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever Spark can write."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only in local mode, where it may be unset, one in the machine's temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return os.path.join(tempfile.gettempdir(), "flowloom-checkpoints")

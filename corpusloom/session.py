"""Sessions, and the shared folder in which jobs cut their lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Whether the files of a job's shuffles are removed when it ends, rather than when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def session(app: str = "corpusloom", **conf: str) -> SparkSession:
    """A local session for tests and benches; on a cluster, use the one that spark-submit configures."""
    builder = SparkSession.builder.appName(app)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir as the session has it, or, only where
    that is unset and the session is local, a temporary folder of this process."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="corpusloom-")
    atexit.register(shutil.rmtree, local, True)
    spark.conf.set("spark.checkpoint.dir", f"file://{local}")
    spark.sparkContext.setCheckpointDir(f"file://{local}")
    return f"file://{local}"


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/corpusloom/{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def clear(spark: SparkSession) -> None:
    """Remove every table that stored() wrote for this application.  For the end of a job: results that read one are gone with it."""
    _delete(spark, _own_dir(spark))


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: its lineage ends there, so the loss of an
    executor costs at most the tasks that were running."""
    spark = df.sparkSession
    path = f"{_own_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")  # nothing reads this job's shuffles again
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Remove a table that stored() wrote, once nothing reads it any more."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/corpusloom/" in path:
            _delete(spark, path)


def preflight(spark: SparkSession, tasks: int = 8) -> DataFrame:
    """(task, host, python, ok): a job of so many tasks, each of which imports what the operators need, writes to a scratch file and reads it back."""
    from pyspark import TaskContext

    def probe(batches):  # noqa: ANN001, ANN202
        import platform
        import sys

        import numpy
        import pyarrow as pa

        for b in batches:
            with tempfile.TemporaryFile() as f:
                f.write(numpy.arange(3).tobytes())
                f.seek(0)
                ok = len(f.read()) == 24
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()] * n, pa.int32()), pa.array([platform.node()] * n), pa.array([sys.version.split()[0]] * n), pa.array([ok] * n)], ["task", "host", "python", "ok"])

    return spark.range(0, tasks, 1, tasks).mapInArrow(probe, "task int, host string, python string, ok boolean")

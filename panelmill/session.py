"""Session helpers shared by every module: the shared folder, written intermediates."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where it is unset a local session (tests) gets a folder of its own; on a
    cluster that is an error, for executors would write to their own disks."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("panelmill.shared.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-panelmill-")
        spark.conf.set("panelmill.shared.dir", found)
    return found


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage, so a lost executor costs a re-read and not a recomputation, and the
    shuffle files behind ``df`` are dropped as soon as the write has ended. ``spent`` deletes such tables.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup, "false")
    spark.conf.set(cleanup, "true")
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        spark.conf.set(cleanup, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def spent(*tables: DataFrame) -> None:
    """Delete what ``written`` wrote for these tables. Only tables that nothing reads any more: what was made of them must be written."""
    for t in tables:
        path = getattr(t, "written_path", None)
        if path:
            spark = t.sparkSession
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


_SHIPPED: set[str] = set()
#: What an Arrow batch between the JVM and a Python worker holds at most (or one longer row); Spark's default bounds rows at 10,000 and bytes at 64 MB.
BATCH_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that their Python workers can import it, and bound the bytes of
    the session's Arrow batches by ``BATCH_BYTES`` where the session leaves Spark's default: each is held twice in the JVM and once in Python."""
    import io
    import os
    import zipfile

    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(bound) == f"{64 << 20}b":
        spark.conf.set(bound, str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for folder, _, names in sorted(os.walk(top)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    path = os.path.join(tempfile.mkdtemp(prefix="spark-panelmill-ship-"), "panelmill.zip")
    with open(path, "wb") as f:
        f.write(data.getvalue())
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)

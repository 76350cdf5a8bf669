"""Sources and sinks: trip files, dimensions, extracts and result tables."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmill.session import written

#: The columns of a trip file and their types.
TRIP_COLUMNS = {
    "order_id": "bigint",
    "line": "int",
    "vendor_id": "bigint",
    "pu_zone": "int",
    "do_zone": "int",
    "pickup_ts": "timestamp_ntz",
    "dropoff_ts": "timestamp_ntz",
    "trip_distance": "double",
    "fare_amount": "double",
    "total_amount": "double",
    "congestion_fee": "double",
}
LATER_COLUMNS = ("congestion_fee",)
LINEAGE = ("run_id", "feature_run_id", "challenger_model", "benchmark_model", "git_commit", "config_hash")


def _in_fixed_schema(raw: DataFrame, name: str) -> DataFrame:
    """Lower-case names, later columns as null where absent, no others, each column cast, and the file's name kept."""
    raw = raw.withColumn("_file", F.col("_metadata.file_path"))
    raw = raw.toDF(*[c.lower() for c in raw.columns])
    for c in LATER_COLUMNS:
        if c not in raw.columns:
            raw = raw.withColumn(c, F.lit(None).cast("double"))
    found = set(raw.columns) - {"_file"}
    if odd := found ^ set(TRIP_COLUMNS):
        raise ValueError(f"{name}: unexpected or missing columns {sorted(odd)}")
    return raw.select(*[F.col(c).cast(t).alias(c) for c, t in TRIP_COLUMNS.items()], F.col("_file").alias("sourcefile_path"), F.current_timestamp().alias("load_timestamp_utc"))


def file_schemas(spark: SparkSession, paths: Iterable[str], footers: bool = True) -> DataFrame:
    """(path, kind) of every Parquet file at or below the paths: kind tells schemas apart. Spark lists the files; tasks read their footers, by
    the store's own client where there is one, else (or without ``footers``) from the file as Spark reads it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")

    def kind(source) -> str:
        schema = pq.read_schema(source).remove_metadata()
        return "; ".join(f"{f.name} {f.type}" for f in schema)

    def by_footer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kinds = []
            for path in b.column(0).to_pylist():
                try:
                    store, at = FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
                    with store.open_input_file(at) as f:
                        kinds.append(kind(f))
                except (pa.ArrowException, OSError):
                    kinds.append(None)
            yield pa.record_batch([b.column(0), pa.array(kinds, pa.string())], names=["path", "kind"])

    def by_content(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array([kind(pa.BufferReader(x)) for x in b.column(1).to_pylist()], pa.string())], names=["path", "kind"])

    found = files.load(list(paths)).select("path")
    if not footers:
        return files.load(list(paths)).select("path", "content").mapInArrow(by_content, "path string, kind string")
    found = written(found.mapInArrow(by_footer, "path string, kind string"), "footers")
    unread = [r[0] for r in found.where("kind IS NULL").select("path").collect()]
    if not unread:
        return found
    rest = files.load(unread).select("path", "content").mapInArrow(by_content, "path string, kind string")
    return found.where("kind IS NOT NULL").unionByName(rest)


def ingest_trip_files(spark: SparkSession, paths: Iterable[str], footers: bool = True) -> DataFrame:
    """Files in the fixed schema, from files and folders whose schemas drift from file to file. Footers are read by a job, and the files of
    each schema are one read: the plan has as many branches as there are schemas, and the driver opens as many files."""
    paths = list(paths)
    if not paths:
        raise ValueError("no trip files")
    kinds = file_schemas(spark, paths, footers).groupBy("kind").agg(F.array_sort(F.collect_list("path")).alias("paths")).orderBy("kind").collect()
    if not kinds:
        raise ValueError(f"no Parquet files in {paths[:3]}")
    out = None
    for _, same in kinds:
        one = _in_fixed_schema(spark.read.schema(spark.read.parquet(same[0]).schema).parquet(*same), same[0])
        out = one if out is None else out.unionByName(one)
    return out


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("zone_id int, zone string, borough string").csv(path, header=True).withColumn("load_timestamp_utc", F.current_timestamp())


def truncate_and_load(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace a table's rows; with partitions only those that ``df`` has."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def clustered(df: DataFrame, by_date: str, cluster: list[str]) -> DataFrame:
    """The layout of large facts: one write task for each date range, sorted inside by the cluster columns."""
    return df.repartitionByRange(F.col(by_date)).sortWithinPartitions(by_date, *cluster)


def prepare_sql(text: str, params: dict[str, object]) -> tuple[str, str]:
    """The SQL text and the SHA-256 of text and parameters."""
    return text, hashlib.sha256((text + repr(sorted(params.items()))).encode()).hexdigest()


def extract(spark: SparkSession, text: str, params: dict[str, object], path: str) -> DataFrame:
    """Run a parameterised query, write its rows as Parquet, and give them back with the query's fingerprint. No rows is an error."""
    text, digest = prepare_sql(text, params)
    spark.sql(text, args=params).withColumn("query_sha256", F.lit(digest)).write.mode("overwrite").parquet(path)
    rows = spark.read.parquet(path)
    if rows.isEmpty():
        raise ValueError("the extract has no rows")
    return rows


def extract_metadata(spark: SparkSession, path: str) -> DataFrame:
    """An extract's fingerprint and number of rows, from what was written."""
    return spark.read.parquet(path).groupBy("query_sha256").agg(F.count("*").alias("n_rows"))


def with_lineage(df: DataFrame, feature_run_id: str) -> DataFrame:
    if not feature_run_id:
        raise ValueError("an empty lineage id")
    return df.withColumn("feature_run_id", F.lit(feature_run_id))


def publish_summary(panel: DataFrame) -> DataFrame:
    return panel.groupBy("feature_run_id").agg(F.count("*").alias("n_rows"), F.countDistinct("unique_id").alias("n_series"), F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"))


def stamp_lineage(df: DataFrame, identity: dict[str, str]) -> DataFrame:
    if set(identity) != set(LINEAGE):
        raise ValueError(f"lineage needs {LINEAGE}")
    return df.withColumns({c: F.lit(identity[c]) for c in LINEAGE})


def write_run(frames: dict[str, DataFrame], root: str, run_id: str, model: str) -> None:
    """All frames of a run, then its manifest: a run without one isn't complete."""
    spark = next(iter(frames.values())).sparkSession
    counts = []
    for name, df in frames.items():
        path = f"{root}/{name}/run_id={run_id}/model={model}"
        df.write.mode("overwrite").parquet(path)
        counts.append((run_id, model, name, spark.read.parquet(path).count()))
    manifest = spark.createDataFrame(counts, "run_id string, model string, table_name string, n_rows long")
    manifest.coalesce(1).write.mode("append").parquet(f"{root}/manifest")


def completed_runs(spark: SparkSession, root: str) -> DataFrame:
    """Runs with a manifest, newest first by id."""
    return spark.read.parquet(f"{root}/manifest").select("run_id").distinct().orderBy(F.desc("run_id"))


def default_run(runs: DataFrame, pointer: str | None) -> DataFrame:
    """One row: the pointer's run if it is complete, else the newest."""
    return runs.agg(F.coalesce(F.max(F.when(F.col("run_id") == F.lit(pointer), F.col("run_id"))), F.max("run_id")).alias("run_id"))


def scan_runs(spark: SparkSession, root: str, table: str) -> DataFrame:
    """One table of all committed runs; run and model come from the folders. The manifest prunes the folders at run time, so what a run
    without one has left is never read."""
    rows = spark.read.option("basePath", f"{root}/{table}").parquet(f"{root}/{table}")
    committed = spark.read.parquet(f"{root}/manifest").where(F.col("table_name") == table).select("run_id", "model").distinct()
    return rows.join(F.broadcast(committed), ["run_id", "model"], "left_semi")  # a row a run and model


def read_committed(spark: SparkSession, root: str, table: str, run_id: str) -> DataFrame:
    """One table of one run, checked against its manifest: a model whose rows aren't as many as were written is an error."""
    rows = scan_runs(spark, root, table).where(F.col("run_id") == run_id)
    wanted = {r["model"]: r["n_rows"] for r in spark.read.parquet(f"{root}/manifest").where((F.col("table_name") == table) & (F.col("run_id") == run_id)).collect()}
    found = {r["model"]: r["count"] for r in rows.groupBy("model").count().collect()}
    if not wanted or wanted != {m: found.get(m, 0) for m in wanted}:
        raise ValueError(f"{table} of run {run_id}: manifest {wanted}, found {found}")
    return rows


def stitch_daily(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Daily files of several months as one table with the month that each file's folder carries."""
    return spark.read.parquet(*paths).withColumn("source_month", F.regexp_extract(F.col("_metadata.file_path"), r"(\d{4}-\d{2})", 1))

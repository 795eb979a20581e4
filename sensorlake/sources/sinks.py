"""Sinks and table maintenance (SK1-SK3, SK5, SK6, SK9, SK10).

Long tables are partitioned by day and updated by day: ``replace_days`` rewrites only
the days that the new rows touch, the other days' files stay as they are. Small tables without a day are written as a
new version folder and readers follow the newest complete version;
``upsert``/``delete_matching`` return the new table content as a DataFrame so the
caller picks the write.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from ..session import even_tasks


def write_stream(df: DataFrame, target: str, checkpoint: str, trigger: str | None = "10 seconds",
                 available_now: bool = False, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> StreamingQuery:
    """SK1: append a stream to a file table with a checkpoint; ``available_now``
    processes what is there and stops (tests, catch-up runs)."""
    w = df.writeStream.outputMode("append").format(fmt).option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start(target)


def write_stream_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                       available_now: bool = False, trigger: str = "10 seconds") -> StreamingQuery:
    """SK2: ``foreachBatch`` sink; ``fn(batch_df, batch_id)`` must be idempotent per
    batch id (e.g. write to a folder named after the batch id)."""
    w = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def idempotent_batch_writer(path: str, transform: Callable[[DataFrame], DataFrame] | None = None,
                            fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """SK2 helper: a ``foreachBatch`` function writing each micro-batch to its own
    ``batch_id=<n>`` folder with overwrite, so a batch replayed after a failure
    replaces its earlier partial output instead of duplicating it."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch) if transform is not None else batch
        out.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/batch_id={batch_id}")
    return fn


def _dealt(df: DataFrame, tasks: int) -> DataFrame:
    """A stream's rows dealt in turn over ``tasks`` tasks, whatever its own partitions. Every partition's first row goes to
    the first task, as Spark writes an empty file for a first task without rows."""
    def number(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        n, shift = 0, TaskContext.get().partitionId()
        for b in batches:
            at = np.arange(n, n + b.num_rows, dtype="int64")
            at = np.where(at == 0, 0, (at + shift) % tasks).astype("int32")
            n += b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at)], names=[*b.schema.names, "_landing_task"])

    schema = StructType([*df.schema.fields, StructField("_landing_task", IntegerType())])
    return df.mapInArrow(number, schema).repartitionById(tasks, "_landing_task").drop("_landing_task")


def write_landing(df: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """SK3: one record per JSON file in a landing folder. A batch's files are created by many tasks, also where
    it comes from one large file."""
    w = (_dealt(df, even_tasks(df.sparkSession)).writeStream.format("json").option("checkpointLocation", checkpoint)
           .option("maxRecordsPerFile", 1).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start(path)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           set_cols: Sequence[str] | None = None) -> DataFrame:
    """SK5: target after update-matched / insert-unmatched by ``keys``.

    With ``set_cols`` only those columns take the source value on a match
    (others keep the target's); without, the whole source row replaces it.
    """
    keys = list(keys)
    if set_cols is None:
        kept = target.join(source.select(*keys), keys, "left_anti")
        return kept.unionByName(source.select(*target.columns))
    s = source.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in set_cols])
    j = target.join(s, keys, "full")
    cols = [F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in set_cols else F.col(c)
            for c in target.columns]
    return j.select(*cols)


def delete_matching(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SK6: target rows whose key is not in ``source`` (delete matched)."""
    return target.join(source.select(*keys), list(keys), "left_anti")


def log_files(files: DataFrame, status: str, error: str | None = None) -> DataFrame:
    """SK9: audit rows (file_name, status, error_message, logged_at) to append."""
    return files.select(F.col("file_name"), F.lit(status).alias("status"),
                        F.lit(error).cast("string").alias("error_message"),
                        F.current_timestamp().alias("logged_at"))


def conform(df: DataFrame, schema: StructType, defaults: dict | None = None) -> DataFrame:
    """SK10: bring rows to a declared table schema: defaults for missing columns
    (e.g. ``last_updated_date = current_timestamp()``), column order and types."""
    out = df
    for f in schema.fields:
        if f.name not in out.columns:
            d = (defaults or {}).get(f.name)
            out = out.withColumn(f.name, (d if d is not None else F.lit(None)).cast(f.dataType))
    return out.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def _fs(spark: SparkSession, path: str):
    """Hadoop FileSystem and Path for ``path`` (HDFS, object stores, local files alike)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _versions(spark: SparkSession, base: str, complete: bool) -> list[str]:
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    vs = sorted(n for n in names if n.startswith("v") and n[1:].isdigit())
    if complete:
        jvm = spark.sparkContext._jvm
        vs = [n for n in vs if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{n}/_SUCCESS"))]
    return vs


def next_version_path(spark: SparkSession, base: str) -> str:
    """Versioned folder for a rewrite (``base/v000001`` ...), on any Hadoop file system."""
    vs = _versions(spark, base, complete=False)
    return f"{base.rstrip('/')}/v{(int(vs[-1][1:]) + 1 if vs else 1):06d}"


def latest_version_path(spark: SparkSession, base: str) -> str | None:
    """Newest completely written version (its ``_SUCCESS`` marker exists)."""
    vs = _versions(spark, base, complete=True)
    return f"{base.rstrip('/')}/{vs[-1]}" if vs else None


def write_version(df: DataFrame, base: str, partition_by: Sequence[str] = ()) -> str:
    """Write a new table version; readers switch to it once ``_SUCCESS`` exists."""
    path = next_version_path(df.sparkSession, base)
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_latest(spark: SparkSession, base: str) -> DataFrame | None:
    p = latest_version_path(spark, base)
    return spark.read.parquet(p) if p else None


def write_clustered(df: DataFrame, path: str, ts: str, cluster_by: Sequence[str], day_col: str = "day",
                    files_per_day: int | None = None, mode: str = "errorifexists") -> None:
    """Layout for long reading tables (the clustering of the reference's tables):
    partitioned by day for partition pruning, and within each day range-
    partitioned and sorted by (cluster keys, time) so parquet row-group
    statistics let tag / asset / time filters skip data."""
    d = df.withColumn(day_col, day_of(ts, df))
    n = files_per_day or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = d.repartitionByRange(n, day_col, *cluster_by, ts).sortWithinPartitions(day_col, *cluster_by, ts)
    d.write.mode(mode).partitionBy(day_col).parquet(path)


def day_of(ts: str, df: DataFrame):
    """Day of an epoch-seconds or timestamp column."""
    numeric = dict(df.dtypes)[ts] in ("bigint", "int")
    return F.to_date(F.timestamp_seconds(F.col(ts))) if numeric else F.to_date(F.col(ts))


#: File names of rows that were appended; rows that a rewrite placed keep Spark's own prefix.
APPENDED = "append"


def clustered(df: DataFrame, day_col: str, cluster_by: Sequence[str], ts: str) -> DataFrame:
    """Rows dealt to tasks by ranges of (day, cluster keys, time) and sorted so.

    A hot day is many tasks and files, several small days share a task (AQE joins small neighbouring
    ranges), and files of a day hold disjoint ranges of the cluster keys, so that row-group statistics still
    let tag, asset and time filters skip them.
    """
    order = list(dict.fromkeys([day_col, *cluster_by, ts]))
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def append_days(df: DataFrame, path: str, ts: str, cluster_by: Sequence[str] = (), day_col: str = "day") -> None:
    """Rows appended to a day-partitioned table, in files that a stream over the table sees
    (``files.read_appended``)."""
    d = clustered(df.withColumn(day_col, day_of(ts, df)), day_col, cluster_by, ts)
    d.write.mode("append").option("mapreduce.output.basename", APPENDED).partitionBy(day_col).parquet(path)


def appended_path(path: str) -> str:
    """Where appended files go when their day is rewritten: streams that have not read them yet find them there."""
    return f"{path.rstrip('/')}_appended"


def _move(fs, jvm, source, folder: str) -> None:
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(folder))
    if not fs.rename(source, jvm.org.apache.hadoop.fs.Path(f"{folder}/{source.getName()}")):
        raise OSError(f"cannot move {source} to {folder}")


def replace_days(df: DataFrame, path: str, ts: str, cluster_by: Sequence[str] = (), day_col: str = "day") -> None:
    """Rows of whole days written in place of those days' partitions of a
    day-partitioned table; days that ``df`` does not hold are not touched.

    The new files are written beside the table first (``df`` may read the very days it replaces), a day in as
    many tasks and files as it asks for (``clustered``). Then each day's folder is swapped: files of appended rows
    move to ``appended_path``, where streams still find them, others go, and the new ones move in.
    """
    spark = df.sparkSession
    fs, table = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    staged = f"{path.rstrip('/')}/_staged_{uuid.uuid4().hex}"
    clustered(df.withColumn(day_col, day_of(ts, df)), day_col, cluster_by, ts).write.partitionBy(day_col).parquet(staged)
    for st in fs.listStatus(jvm.org.apache.hadoop.fs.Path(staged)):
        name = st.getPath().getName()
        if not st.isDirectory() or not name.startswith(f"{day_col}="):
            continue
        old = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}")
        for f in fs.listStatus(old) if fs.exists(old) else []:
            if f.getPath().getName().startswith(f"{APPENDED}-"):
                _move(fs, jvm, f.getPath(), f"{appended_path(path)}/{name}")
            else:
                fs.delete(f.getPath(), True)
        for f in fs.listStatus(st.getPath()):
            _move(fs, jvm, f.getPath(), f"{path.rstrip('/')}/{name}")
    fs.delete(jvm.org.apache.hadoop.fs.Path(staged), True)
    spark.catalog.refreshByPath(path)


def _touched(spark: SparkSession, path: str, source: DataFrame, ts: str, day_col: str) -> DataFrame:
    """The table's rows of the days that ``source`` holds (partition-pruned)."""
    days = source.select(day_of(ts, source).alias(day_col)).distinct()
    return spark.read.parquet(path).join(days, day_col, "left_semi").drop(day_col)


def upsert_days(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], ts: str,
                set_cols: Sequence[str] | None = None, day_col: str = "day") -> None:
    """SK5/SK7/GO6 on a day-partitioned table: ``upsert`` of the touched days only.
    ``keys`` must fix the day (hold ``ts`` or a bucket of it); files are clustered by them."""
    merged = upsert(_touched(spark, path, source, ts, day_col), source, keys, set_cols)
    replace_days(merged, path, ts, keys, day_col)


def refresh_days(spark: SparkSession, path: str, source: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame],
                 ts: str, cluster_by: Sequence[str] = (), day_col: str = "day") -> None:
    """GO7 and the like: ``merge(old rows of the touched days, source)`` replaces
    those days, e.g. with ``resample.refresh_gold``."""
    replace_days(merge(_touched(spark, path, source, ts, day_col), source), path, ts, cluster_by, day_col)


def drop_days_before(spark: SparkSession, path: str, cutoff_day: str, day_col: str = "day") -> list[str]:
    """PB7/SK6 on a day-partitioned table: remove whole days before ``cutoff_day``
    (``YYYY-MM-DD``); nothing is rewritten. Returns the removed days."""
    gone = []
    for folder in (path, appended_path(path)):
        fs, p = _fs(spark, folder)
        for st in fs.listStatus(p) if fs.exists(p) else []:
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith(f"{day_col}=") and name.split("=", 1)[1] < cutoff_day:
                fs.delete(st.getPath(), True)
                gone.append(name.split("=", 1)[1])
    spark.catalog.refreshByPath(path)
    return sorted(set(gone))


def retain_version(spark: SparkSession, base: str, ts: str, cutoff, partition_by: Sequence[str] = ()) -> str | None:
    """PB7 on a versioned table: the latest version's rows at or after ``cutoff``
    become a new version (the old one is never overwritten while it may be read)."""
    cur = read_latest(spark, base)
    if cur is None:
        return None
    return write_version(cur.filter(F.col(ts) >= F.lit(cutoff)), base, partition_by)

"""Session defaults, checkpoint location, small configuration frames.

No join is hinted: Spark broadcasts a side by its measured size
(``spark.sql.autoBroadcastJoinThreshold`` with AQE)."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


_SHIPPED: set[str] = set()


def get_spark(master: str | None = None, app: str = "sensorlake",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with UTC time, AQE and the web UI off."""
    b = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    if master:
        b = b.master(master)
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on (UTC) on a session we did not build."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    share_package(spark)
    return spark


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package: a local master's from the driver's place, a cluster's from an
    archive that Spark sends to every executor, once per context."""
    sc = spark.sparkContext
    if sc.master.startswith("local"):
        root = str(Path(__file__).resolve().parents[1])
        env = sc.environment
        paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
        if root not in paths:
            env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    elif sc.applicationId not in _SHIPPED:
        _SHIPPED.add(sc.applicationId)
        folder = tempfile.mkdtemp(prefix="sensorlake-package-")  # on the driver, which serves the archive from here
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.addPyFile(package_archive(folder))


def package_archive(folder: str) -> str:
    """This package as a zip archive that Python imports from."""
    package = Path(__file__).resolve().parent
    return shutil.make_archive(f"{folder}/{package.name}", "zip", root_dir=package.parent, base_dir=package.name)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared ``spark.checkpoint.dir``. Only a local master, where one
    machine is all there is, may leave it unset and gets a scratch folder; on a
    cluster that would be a folder per machine, so it is an error there."""
    share_package(spark)
    path = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith(("local[", "local")) or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="sensorlake-ckpt-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:  # once per context
        spark.sparkContext.setCheckpointDir(path)
    return path


def even_tasks(spark: SparkSession) -> int:
    """Tasks for rows that are dealt to a fixed number of them. Adaptive execution merges partitions by their
    compressed bytes; where these say little of the work or memory behind them, the number is given."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder and
    read it back: one job (no second computation as with an un-cached RDD
    checkpoint), the result survives executor loss, and later scans of it get
    column pruning and filter pushdown."""
    import uuid

    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/sensorlake-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def estimated_bytes(df: DataFrame) -> int:
    """Size that the optimizer estimates for a frame (exact for local rows, an upper guess elsewhere); no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def local_frame(spark: SparkSession, rows, schema: str | StructType) -> DataFrame:
    """Small configuration frame (rule specs, coefficient tables) built from an Arrow table with the declared
    types, whatever the session's Arrow setting: no Python worker is needed to read it on the executors, and
    a null leaves a long column long."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    st = schema if isinstance(schema, StructType) else _parse_datatype_string(schema)
    rows = list(rows)
    if not rows:
        return spark.createDataFrame([], st)
    columns = [pa.array(list(values), field.type) for values, field in zip(zip(*rows), to_arrow_schema(st))]
    return spark.createDataFrame(pa.Table.from_arrays(columns, names=st.names), schema=st)

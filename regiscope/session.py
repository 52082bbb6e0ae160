"""Session factory and shared-storage helpers.

Nothing here hard-codes a master URL for production use: ``get_session`` only
supplies one when the caller asks for a local session (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package relies on. ANSI mode is left at the
# Spark 4 default (on); operators use try_cast where leniency is wanted.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of frames that are no longer referenced are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(app_name: str = "regiscope", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false")
        builder = builder.config("spark.ui.showConsoleProgress", "false")
        builder = builder.config("spark.driver.memory", os.environ.get("REGISCOPE_DRIVER_MEM", "8g"))
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the operators assume, on any session,
    and make the package importable by the Python workers."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.sources.partitionOverwriteMode"):
        spark.conf.set(k, BASE_CONF[k])
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application
    (``SparkContext.addPyFile``), as ``spark-submit --py-files`` would.

    The Python steps that run inside tasks (tree growing, forest scoring)
    refer to functions of this package, so every worker must be able to
    import it. The zip is built on the driver and served by Spark itself.
    """
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    zpath = os.path.join(tempfile.mkdtemp(prefix="regiscope-pyfiles-"), "regiscope.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    The cluster's ``spark.checkpoint.dir`` always wins. Only a ``local``
    master without it (tests, a laptop) gets a private folder; on a cluster
    that would be a different folder on every machine, so it raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="regiscope-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder.

    Written tables (bronze/silver outputs, exports, stream checkpoints) go
    here so that every executor sees the same storage.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/regiscope/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Cut lineage at a layer boundary: the frame is written once below the
    shared checkpoint folder and read back, so that each later reference reads
    the stored rows instead of re-planning the whole upstream plan. (An eager
    ``checkpoint`` runs the last stage twice, to count and to write.)"""
    return store(df, "stage")


#: Row groups of a table stored for CPU-heavy steps: a split holds at least one.
SPLIT_BYTES = 4 << 20


def store(df, name: str, split_bytes: int | None = None):
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back: lineage ends here and later readers prune columns.

    ``split_bytes`` sets the row-group size. Spark cuts a scan into splits of
    at most its share per core but never inside a row group, so small ones let
    a CPU-heavy step (Python scoring) use every core even where the input was
    written by one task; no shuffle and no look at the partition count."""
    path = scratch_path(df.sparkSession, name)
    w = df.write
    if split_bytes:
        w = w.option("parquet.block.size", split_bytes)
    w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of ``path`` (works for
    file:, hdfs:, s3a: ... alike)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))

"""Session construction and lineage/checkpoint helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CHECKPOINT_CONF = "spark.checkpoint.dir"
WAREHOUSE_CONF = "spark.sql.warehouse.dir"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: bytes of shuffled rows that AQE may join to one task at most: sorts and joins hold some 15 times that unpacked
TASK_BYTES = 16 << 20
#: bytes of a file that one scan task reads at most: a hash aggregate before the shuffle holds some 25 times that unpacked
SCAN_BYTES = 16 << 20
#: bytes of shuffled rows that a byte of a Parquet table may become at most, for the number of partitions a shuffle begins with
UNPACKED = 8
#: bytecode of a generated method beyond which the JVM never compiles it (it stays interpreted); such a subtree runs by operators
COMPILED_BYTES = 8000


def build_session(
    master: str = "local[8]",
    app: str = "vigil",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with AQE (coalesce + skew join) on, UI off and UTC time.

    On a cluster pass ``shuffle_partitions`` sized to the data (roughly input bytes / 128 MB);
    AQE then coalesces small partitions and splits skewed join partitions at run time.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def bound_tasks(spark: SparkSession) -> None:
    """Lower three limits of the session, where they are higher: what AQE coalesces to one task (64 MB by default, which a cleaning
    or joining task unpacks to a gigabyte), what one task scans (128 MB by default, which the aggregate of a large scan unpacks to
    some 3 GB), and the size of generated methods (64 KB, eight times what the JVM compiles)."""
    advisory, methods = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.codegen.hugeMethodLimit"
    for conf, most in ((advisory, TASK_BYTES), ("spark.sql.files.maxPartitionBytes", SCAN_BYTES)):
        if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(conf)) > most:
            spark.conf.set(conf, str(most))
    if int(spark.conf.get(methods)) > COMPILED_BYTES:
        spark.conf.set(methods, str(COMPILED_BYTES))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a path, in any file system that Spark reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(where).getLength() if fs.exists(where) else 0


def spread_shuffles(spark: SparkSession, read: int) -> None:
    """Let shuffles begin with partitions enough for ``read`` bytes of tables, where the session has fewer: AQE joins small ones
    again, but divides only skewed ones, so with a fixed number a task's rows would grow with the tables."""
    conf, needed = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", -(-read * UNPACKED // TASK_BYTES)
    if needed > int(spark.conf.get(conf, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(conf, str(needed))


#: (application id, folder) pairs that ``_seen_by_all`` has found shared
_seen: set[tuple[str, str]] = set()


def _shared(spark: SparkSession, path: str) -> bool:
    """Whether a path is in a file system of the cluster: a scheme of its own, or the default one where that is not local.

    ``file:`` with an explicit scheme is taken at its word (a mount that all hosts have)."""
    if "://" in path or path.startswith("file:"):
        return True
    default = spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    return not default.startswith("file:")


def _seen_by_all(spark: SparkSession, path: str) -> None:
    """Raise unless what executors write to a bare local path can be read back whole: it may be a mount that all hosts have.

    One task per core writes a row, once per application and folder. Where hosts have folders of their own, the driver cannot
    commit the other hosts' files and rows are missing."""
    try:
        known = (spark.sparkContext.applicationId, path)
        if known in _seen:
            return
        n, probe = max(2, spark.sparkContext.defaultParallelism), f"{path.rstrip('/')}/probe-{uuid.uuid4().hex}"
        spark.range(0, n, 1, n).write.parquet(probe)
        found = spark.read.schema("id long").parquet(probe).count()
    except Exception as e:
        raise RuntimeError(f"{CHECKPOINT_CONF} is {path!r}, which is no folder that all executors share: it cannot be written and read") from e
    if found != n:
        raise RuntimeError(f"{CHECKPOINT_CONF} is {path!r}, which is no folder that all executors share: {found} of {n} rows came back")
    _seen.add(known)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir`` (or by ``setCheckpointDir``).

    Where none is named, executors in the driver's own process (``local[n]``: tests, laptops) get a scratch folder, all others
    one in the warehouse, the other folder of a cluster that its hosts share. The context keeps it: Spark 4.1 lets no session
    set ``spark.checkpoint.dir``. Bare local paths and the warehouse are tried out.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get(CHECKPOINT_CONF, None) or spark.conf.get(CHECKPOINT_CONF, None)
    one_process = sc.master == "local" or sc.master.startswith("local[")  # a local-cluster has executors with folders of their own
    if configured:
        if not one_process and not _shared(spark, configured):
            _seen_by_all(spark, configured)
        sc.setCheckpointDir(configured)
        return configured
    kept = getattr(sc, "getCheckpointDir", lambda: None)()
    if kept:
        if not one_process:
            _seen_by_all(spark, kept)
        return kept
    if one_process:
        chosen = tempfile.mkdtemp(prefix="vigil-ckpt-")
    else:
        warehouse = spark.conf.get(WAREHOUSE_CONF, None)
        if not warehouse:
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
        chosen = f"{warehouse.rstrip('/')}/vigil-checkpoints"
        _seen_by_all(spark, chosen)
    sc.setCheckpointDir(chosen)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def set_aside(df: DataFrame, label: str = "rows") -> DataFrame:
    """Write rows to the shared checkpoint folder as compressed Parquet and read them back: lineage ends there, as with ``cut_lineage``.

    The rows take a fraction of a checkpoint's disk, and the shuffle files of the writing query are removed when it has ended, not
    when the driver next collects its garbage. The files stay until the application's folder is removed."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP_CONF)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        rows = df.select("*")  # a query takes the setting when it is made
        rows.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP_CONF, before)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
    return spark.read.schema(schema).parquet(path)

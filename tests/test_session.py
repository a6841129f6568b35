"""A cluster's checkpoint folder must be one that all executors share."""

import pytest

from vigil import session


class _Context:
    master = "spark://somewhere:7077"
    kept = None

    def __init__(self, configured):
        self.configured = configured

    def getConf(self):
        return self

    def get(self, key, default=None):
        return self.configured

    def setCheckpointDir(self, path):
        self.kept = path


class _Session:
    def __init__(self, configured, default="file:///"):
        self.sparkContext = self.conf = _Context(configured)
        self._jsc = type("J", (), {"hadoopConfiguration": lambda s: {"fs.defaultFS": default}})()


def test_bare_local_paths_are_refused_on_a_cluster():
    with pytest.raises(RuntimeError, match="share"):
        session.ensure_checkpoint_dir(_Session("/tmp/x"))
    with pytest.raises(RuntimeError, match="must name"):
        session.ensure_checkpoint_dir(_Session(None))
    for configured, default in (("hdfs://n/x", "file:///"), ("file:///mnt/shared", "file:///"), ("/x", "hdfs://n/")):
        s = _Session(configured, default)
        assert session.ensure_checkpoint_dir(s) == configured == s.sparkContext.kept


def _as_cluster(spark, monkeypatch, folder):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://somewhere:7077")
    conf = spark.sparkContext.getConf().set(session.CHECKPOINT_CONF, folder)
    monkeypatch.setattr(spark.sparkContext, "getConf", lambda: conf)


def test_a_bare_path_that_all_executors_see_is_taken(spark, tmp_path, monkeypatch):
    folder, before = str(tmp_path / "shared"), spark.sparkContext.getCheckpointDir()
    _as_cluster(spark, monkeypatch, folder)
    try:
        assert session.ensure_checkpoint_dir(spark) == folder
        assert sorted(r[0] for r in session.cut_lineage(spark.range(3)).collect()) == [0, 1, 2]
    finally:
        if before:
            spark.sparkContext.setCheckpointDir(before)


def test_a_bare_path_that_loses_rows_is_refused(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "own")
    _as_cluster(spark, monkeypatch, folder)
    whole = type(spark.read).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *paths: whole(self, *paths).where("id > 0"))  # as if a host's files were missing
    with pytest.raises(RuntimeError, match="rows came back"):
        session.ensure_checkpoint_dir(spark)


def test_queries_bound_what_one_task_holds_and_the_size_of_methods(spark):
    """Beyond 8,000 bytes of code the JVM does not compile a method; 64 MB of shuffled rows are a gigabyte in a joining task."""
    from vigil.sources.catalog import Catalog

    advisory, methods = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.codegen.hugeMethodLimit"
    try:
        for before, after in (("64MB", str(16 << 20)), ("1g", str(16 << 20)), ("8m", "8m")):  # a smaller one is kept
            spark.conf.set(advisory, before)
            Catalog(spark, "/nowhere")
            assert spark.conf.get(advisory) == after and int(spark.conf.get(methods)) <= 8000
    finally:
        spark.conf.unset(advisory)


def test_queries_bound_what_one_task_scans(spark, tmp_path):
    """The scan's own aggregate holds all groups of its split, so a split must not grow with the file."""
    from vigil.sources.catalog import Catalog

    scan = "spark.sql.files.maxPartitionBytes"
    try:
        for before, after in (("128MB", str(16 << 20)), ("1g", str(16 << 20)), ("8m", "8m")):  # a smaller one is kept
            spark.conf.set(scan, before)
            Catalog(spark, "/nowhere")
            assert spark.conf.get(scan) == after
        spark.conf.set(scan, "1g")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        rows = spark.range(0, 6_000_000, 1, 1).selectExpr("id", "xxhash64(id) AS h")  # 48 MB of hashes that do not compress
        rows.write.option("parquet.block.size", 4 << 20).parquet(str(tmp_path / "orders.parquet"))
        assert Catalog(spark, str(tmp_path)).driver("orders").rdd.getNumPartitions() > 2
    finally:
        spark.conf.unset(scan)
        spark.conf.unset("spark.sql.files.minPartitionNum")


def _unnamed(spark, monkeypatch):
    """A context that was given no checkpoint folder, as where no spark-defaults.conf names one. Returns what it is then set to."""
    monkeypatch.setattr(spark.sparkContext, "getConf", lambda: type("C", (), {"get": lambda s, key, default=None: default})())
    plain = type(spark.conf).get
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *a: None if key == session.CHECKPOINT_CONF else plain(self, key, *a))

    def refuse(self, key, value):
        raise AssertionError(f"Spark 4.1 lets no session set {key}")

    monkeypatch.setattr(type(spark.conf), "set", refuse)
    chosen = []
    monkeypatch.setattr(spark.sparkContext, "getCheckpointDir", lambda: chosen[-1] if chosen else None)
    monkeypatch.setattr(spark.sparkContext, "setCheckpointDir", chosen.append)
    return chosen


def test_without_a_named_folder_a_local_session_keeps_one_scratch_folder(spark, monkeypatch):
    chosen = _unnamed(spark, monkeypatch)
    first = session.ensure_checkpoint_dir(spark)
    assert session.ensure_checkpoint_dir(spark) == first and chosen == [first]


@pytest.mark.parametrize("master", ["local-cluster[3,2,3000]", "spark://somewhere:7077"])
def test_without_a_named_folder_a_cluster_uses_its_warehouse(spark, tmp_path, monkeypatch, master):
    """The driver's scratch folder would be another one for each executor."""
    chosen, plain = _unnamed(spark, monkeypatch), type(spark.conf).get
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *a: str(tmp_path / "wh") if key == session.WAREHOUSE_CONF else plain(self, key, *a))
    monkeypatch.setattr(spark.sparkContext, "master", master)
    folder = session.ensure_checkpoint_dir(spark)
    assert folder == str(tmp_path / "wh" / "vigil-checkpoints") and chosen == [folder]
    assert session.ensure_checkpoint_dir(spark) == folder and chosen == [folder]


def test_a_local_cluster_tries_out_a_bare_path(spark, tmp_path, monkeypatch):
    _as_cluster(spark, monkeypatch, str(tmp_path / "own"))
    monkeypatch.setattr(spark.sparkContext, "master", "local-cluster[3,2,3000]")
    whole = type(spark.read).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *paths: whole(self, *paths).where("id > 0"))
    with pytest.raises(RuntimeError, match="rows came back"):
        session.ensure_checkpoint_dir(spark)


def test_shuffles_begin_with_partitions_for_the_tables_read(spark, tmp_path, monkeypatch):
    """AQE divides only skewed partitions: with a fixed number a task of fei_coverage, fei_overlap or features grows with the tables."""
    from vigil.sources import catalog

    first, few = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(0, 2000, 1, 1).selectExpr("id", "xxhash64(id) AS h")
    for name in ("orders", "lineitem"):
        rows.write.parquet(str(tmp_path / f"{name}.parquet"))
    try:
        spark.conf.unset(first)
        catalog.Catalog(spark, str(tmp_path)).driver("orders")
        assert spark.conf.get(first, None) is None  # small tables: as the session has it
        monkeypatch.setattr(session, "TASK_BYTES", 8 << 10)
        c = catalog.Catalog(spark, str(tmp_path))
        c.driver("orders")
        one = int(spark.conf.get(first))
        c.driver("lineitem")
        both = int(spark.conf.get(first))
        assert few < one and both in range(2 * one - 1, 2 * one + 2)
        catalog.Catalog(spark, str(tmp_path)).driver("orders")
        assert int(spark.conf.get(first)) == both  # a higher one is kept
    finally:
        spark.conf.unset(first)

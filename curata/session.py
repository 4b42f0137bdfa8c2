"""Session helpers.

Nothing here hard-codes cluster paths: the checkpoint folder is read from the
session (``spark.checkpoint.dir``), and only when that is unset (local tests)
do we fall back to a folder under ``/tmp``.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # pages are large rows; keep Arrow batches moderate for the HTML UDF
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "curata", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; clusters pass their own session."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("CURATA_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``curata`` importable on the Python workers (``addPyFile`` of a zip of
    the package), once per application.  Functions run by ``mapInPandas`` and
    pandas UDFs are pickled by reference to their module."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    target = os.path.join(tempfile.mkdtemp(prefix="curata-pkg-"), "curata.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` must point at shared storage; we only
    set our own (a fresh folder under /tmp) when it is unset, as in local tests.
    """
    ship_package(spark)
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="curata-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Cut lineage through a table written under the shared ``spark.checkpoint.dir``.

    One computation (a reliable ``checkpoint()`` computes its input twice unless
    it is cached), a small plan afterwards, and the files survive executor loss.
    Rows keep their values, not their partitioning: compute anything that depends
    on the partition layout before the cut."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/curata-cut-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(*tables: DataFrame) -> None:
    """Delete tables that ``cut_lineage`` wrote, once nothing reads them any more."""
    for df in tables:
        spark = df.sparkSession
        jvm = spark.sparkContext._jvm
        for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/curata-cut-" in name:
                path = jvm.org.apache.hadoop.fs.Path(name)
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

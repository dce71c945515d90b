"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import gc
import io
import os
import re
import tempfile
import threading
import time
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on. AQE re-plans joins and coalesces shuffle
# partitions at runtime and splits skewed sort-merge partitions; the session
# time zone is fixed so timestamp ordering never depends on the host.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Remove checkpoint files once their frames are garbage collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "affinity",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    On a cluster, pass ``master=None`` and let spark-submit decide.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", os.environ.get("AFFINITY_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, registering it with the context.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that one is
    always used. Only a local session without the setting (tests, benches)
    gets a fresh folder under the system temp dir. A cluster session without
    the setting is an error: a machine-local folder would not survive the loss
    of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):  # local-cluster has executors of its own
            raise RuntimeError(
                "spark.checkpoint.dir is not set; name a shared folder (HDFS/S3) for checkpoints")
        conf_dir = tempfile.mkdtemp(prefix="affinity-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def reliable_checkpoint(df):
    """Write ``df`` to the shared checkpoint folder now and return the frame
    read back from it (lineage cut; survives the loss of any executor)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SHIPPING = threading.Lock()


def ship_code(spark: SparkSession) -> None:
    """Make the library importable in the Python workers, once per context:
    Spark's own file server hands the zipped sources to every executor."""
    context = spark.sparkContext
    with _SHIPPING:  # the points of a grid come here at once
        if not getattr(context, "_affinity_shipped", False):
            _ship(context)
            context._affinity_shipped = True


def _ship(context) -> None:
    package = Path(__file__).resolve().parent
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    target = Path(tempfile.mkdtemp(prefix="affinity-code-")) / "affinity.zip"
    target.write_bytes(buffer.getvalue())
    context.addPyFile(str(target))


# ---------------------------------------------------------------- life of written tables

_LOCK = threading.Lock()


def track_table(df: DataFrame, path: str) -> DataFrame:
    """Have the folder ``path``, which ``df`` reads, removed once no frame that
    reads it is left; returns ``df``.

    Frames derived from ``df`` share its file relations, on the JVM. A weak
    reference to each is kept here, and ``sweep_tables``, which runs whenever
    another table is tracked, deletes the folders whose relations the JVM has
    collected. So a table outlives all plans that read it, also those of other
    threads, and the steps of one query go while the next ones run. (An RDD
    taken from a frame does not hold its relations: keep the frame.)
    """
    spark = df.sparkSession
    sweep_tables(spark)
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    relations = [leaf.relation() for leaf in (leaves.apply(i) for i in range(leaves.size()))
                 if leaf.getClass().getSimpleName() == "LogicalRelation"]
    held = [spark._jvm.java.lang.ref.WeakReference(r) for r in relations]
    with _LOCK:
        spark.sparkContext.__dict__.setdefault("_affinity_tables", {})[path] = held
    return df


def sweep_tables(spark: SparkSession, collect: bool = False) -> int:
    """Delete the tracked folders that nothing reads any more; how many are
    left. ``collect`` asks Python and the JVM to collect their garbage first, a
    few times while tables are held, as threads of the JVM let a plan go a
    moment after its query."""
    tables = spark.sparkContext.__dict__.setdefault("_affinity_tables", {})
    for pause in (0, 0.1, 0.3) if collect else ():
        time.sleep(pause)
        gc.collect()
        spark._jvm.System.gc()
        with _LOCK:
            held = any(w.get() is not None for refs in tables.values() for w in refs)
        if not held:
            break
    with _LOCK:
        gone = [path for path, held in tables.items() if all(w.get() is None for w in held)]
        for path in gone:
            del tables[path]
    for path in gone:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return len(tables)

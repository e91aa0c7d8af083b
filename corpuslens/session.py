"""Session construction and the shared scratch folder.

On a cluster the session comes from the platform and ``spark.checkpoint.dir``
names a folder every executor can reach; we only read it.  A private folder
under the system temp directory is created only when that setting is unset,
which is the case for local tests and ``bench.py``.
"""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove reliable-checkpoint files once their DataFrames are unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "corpuslens", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # local mode runs every task in the driver JVM
        conf["spark.driver.memory"] = "12g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(master: str) -> bool:
    """Driver and executors are one process, so a private folder serves both."""
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session, set up only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not is_local(sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share: "
                           f"master {sc.master!r} may run them on other machines")
    local = tempfile.mkdtemp(prefix="corpuslens-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint folder."""
    root = checkpoint_root(spark)
    # Spark's writers create the folder; nothing is made here.
    return root.rstrip("/") + f"/{name}-{uuid.uuid4().hex[:12]}"


def _store(spark: SparkSession, path: str):
    """The path and its file system, whatever store it names."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    found, fs = _store(spark, path)
    return fs.exists(found)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds."""
    found, fs = _store(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(found)]


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``scratch_dir`` named; any other path raises."""
    if not path.startswith(checkpoint_root(spark).rstrip("/") + "/"):
        raise ValueError(f"{path!r} is not in the session's checkpoint folder")
    found, fs = _store(spark, path)
    fs.delete(found, True)


def cut_lineage(df):
    """Materialise ``df`` into the shared checkpoint folder (reliable, eager).

    The result survives executor loss (it is re-read from the shared folder,
    not recomputed) and keeps its physical partitions and in-partition order.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Have shuffle files and checkpoints of frames that nothing refers to any
    more removed now; Spark finds them when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: rows of an Arrow batch: whole texts are rows here, and Spark's default of
#: 10,000 of them lets a worker's memory grow with the input
BATCH_ROWS = 500
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Ship the package and bound the rows of an Arrow batch (smaller
    settings stay)."""
    ship_package(spark)
    if not 0 < int(spark.conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``corpuslens`` importable in Python workers, like ``--py-files``.

    Functions run by ``mapInPandas`` / pandas UDFs refer to this package's
    helpers by module name, so executors must be able to import it.  The
    package sources are zipped once per application and added with
    ``addPyFile``; Spark distributes the file to every executor.
    """
    import os
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import corpuslens
    pkg_dir = os.path.dirname(os.path.abspath(corpuslens.__file__))
    root = os.path.dirname(pkg_dir)
    fd, path = tempfile.mkstemp(prefix="corpuslens-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, dirnames, files in os.walk(pkg_dir):
            dirnames[:] = [d for d in dirnames if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)

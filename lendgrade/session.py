"""Session helpers: a local session for tests/bench and the shared work folder."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from urllib.parse import unquote

from pyspark.sql import SparkSession

# Settings every session that runs these jobs should carry. AQE re-plans joins
# from runtime sizes (broadcast only when the measured side is small), splits
# skewed join partitions even when that costs an extra shuffle, and coalesces
# small shuffle partitions.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # HotSpot does not JIT-compile methods over 8000 bytes of bytecode; wide
    # CASE projections exceed that when fused into one whole-stage method and
    # then run interpreted (3-4x slower here). Above the limit Spark falls
    # back to split per-expression codegen, which is compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def _driver_memory() -> str:
    """Half the machine's memory, between 2 and 16 GiB (local mode only)."""
    try:
        with open("/proc/meminfo") as f:
            kb = next(int(line.split()[1]) for line in f if line.startswith("MemTotal:"))
        gb = max(2, min(16, int(kb / 1024 / 1024 * 0.5)))
    except (OSError, StopIteration, ValueError):
        gb = 4
    return f"{gb}g"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lendgrade") -> SparkSession:
    """Local session used by tests and the benchmark (no UI, no server)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", _driver_memory())
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Local inputs are a few MB; the 1 MB default floor would coalesce a
        # CPU-heavy shuffle output (wide derivation, SHA-256) into 2 tasks.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def _hadoop_path(spark: SparkSession, path: str):
    """A path and its file system, by the cluster's configuration."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(p)


def _machine_local(spark: SparkSession, path: str) -> bool:
    """Whether a path is on this machine's disk while executors run on others
    (``local`` and ``local-cluster`` masters keep all on one machine)."""
    return not spark.sparkContext.master.startswith("local") and _hadoop_path(spark, path)[1].toUri().getScheme() == "file"


def file_state(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, size and time of the files of a table, as its store lists them."""
    fs, root = _hadoop_path(spark, path)
    found, files = [], fs.listFiles(root, True)
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().getName(), f.getLen(), f.getModificationTime()))
    return sorted(found)


def file_statuses(spark: SparkSession, paths: list[str]) -> list[list]:
    """Path, size and time of files, by one listing of each of their folders.
    ``paths`` are URIs, as ``DataFrame.inputFiles`` gives them."""
    wanted: dict[str, set[str]] = {}
    for path in paths:
        folder, _, name = unquote(path).rpartition("/")
        wanted.setdefault(folder, set()).add(name)
    found = []
    for folder, names in wanted.items():
        fs, p = _hadoop_path(spark, folder)
        for f in fs.listStatus(p):
            if f.getPath().getName() in names:
                found.append([f.getPath().toString(), f.getLen(), f.getModificationTime()])
    return sorted(found)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_path(spark, path)
    return fs.exists(p)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    fs, p = _hadoop_path(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop_path(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, by the cluster's file system."""
    fs, p = _hadoop_path(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text_atomically(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that readers see whole or not at all: written under a
    temporary name, then renamed over the old one."""
    fs, p = _hadoop_path(spark, path)
    jvm = spark.sparkContext._jvm
    temp = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
    stream = fs.create(temp, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(temp, p, options)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir`` as configured for the cluster. Only in
    local mode (tests) an unset setting gets a private temporary folder; on
    a cluster an unset setting is an error, never a machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        # the context appends a random sub-folder; use its parent
        return current.rsplit("/", 1)[0]
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir and _machine_local(spark, conf_dir):
        raise RuntimeError(f"spark.checkpoint.dir is {conf_dir}, a folder of one machine: point it at shared storage")
    if not conf_dir:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: point it at shared storage (HDFS, object store) "
                "so stage tables written by one executor can be read by all"
            )
        conf_dir = tempfile.mkdtemp(prefix="lendgrade-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return _hadoop_path(spark, conf_dir)[1].toString()


# Scratch folders made by this driver process: (jvm, hadoop conf, path).
_SCRATCH: list[tuple[object, object, str]] = []
_EXIT_HOOK = False
# Databases over scratch folders: (session, name).
_DATABASES: list[tuple[SparkSession, str]] = []


def drop_at_exit(spark: SparkSession, database: str) -> None:
    """Drop ``database`` when this driver process exits, before the scratch
    folders under it go: no catalog keeps tables over deleted folders."""
    _DATABASES.append((spark, database))


def _remove_scratch() -> None:
    """Delete this process's scratch folders at exit. Runs before PySpark's
    own exit hook stops the JVM (``atexit`` is last-in, first-out), and goes
    through the Hadoop file system, so shared storage is cleaned as well."""
    while _DATABASES:
        spark, name = _DATABASES.pop()
        try:
            spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
        except Exception:  # the session is stopped, and its catalog with it
            pass
    while _SCRATCH:
        jvm, hconf, path = _SCRATCH.pop()
        try:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(hconf).delete(p, True)
        except Exception:  # JVM already gone: nothing more can be done
            pass


def fresh_dir(spark: SparkSession, label: str, keep: bool = False) -> str:
    """A new, unique folder under the shared folder.

    Unless ``keep``, the folder is scratch: it is deleted when this driver
    process exits, after every DataFrame read from it has been consumed, so
    repeated runs do not pile up stage copies on shared storage.
    """
    base = shared_dir(spark)
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
    fs, qualified = _hadoop_path(spark, path)
    fs.mkdirs(qualified)
    path = qualified.toString()
    if not keep:
        global _EXIT_HOOK
        sc = spark.sparkContext
        if not _EXIT_HOOK:  # registered after the JVM is up, so it runs first
            atexit.register(_remove_scratch)
            _EXIT_HOOK = True
        _SCRATCH.append((sc._jvm, sc._jsc.hadoopConfiguration(), path))
    return path


def cluster_conf(
    input_bytes: int,
    scan_partition_bytes: int = 128 * 1024 * 1024,
    shuffle_partition_bytes: int = 256 * 1024 * 1024,
    shuffled_bytes: int | None = None,
    max_shuffle_partitions: int | None = None,
) -> dict[str, str]:
    """Partition sizing for a cluster run over ``input_bytes`` of input.

    Scan splits of ``scan_partition_bytes``; as many shuffle partitions as
    ``shuffled_bytes`` (of the largest exchange; the input where it is not
    known) make at ``shuffle_partition_bytes`` each. ``max_shuffle_partitions``
    bounds their number only if the caller asks for it, at the price of larger
    partitions. AQE coalesces partitions for smaller intermediates and splits
    skewed ones. Apply with ``SparkSession.builder.config(map=...)`` together
    with ``RECOMMENDED_CONF``.
    """
    partitions = max(200, -(-int(shuffled_bytes or input_bytes) // int(shuffle_partition_bytes)))
    if max_shuffle_partitions is not None:
        partitions = min(partitions, max_shuffle_partitions)
    return {
        "spark.sql.files.maxPartitionBytes": str(scan_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(scan_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(shuffle_partition_bytes),
    }

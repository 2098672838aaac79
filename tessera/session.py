"""Session helpers: one place for the settings every operator assumes.

The operators never build their own session; they take DataFrames. These
helpers exist for tests, the bench and the driver entry point, and for the
one thing operators do need from the session: a shared checkpoint folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings the library's semantics rely on (UTC wall clock, ANSI arithmetic)
# plus the adaptive-execution switches that matter at scale.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpoint files of DataFrames that are no longer referenced are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    Meant for tests and benchmarks. On a cluster the caller's session is used
    as is; only ``spark.checkpoint.dir`` must be set there.
    """
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    for key, value in (extra or {}).items():
        conf[key] = value
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only where none is set.

    The cluster names its shared folder in ``spark.checkpoint.dir``; that wins.
    A private temporary folder is only acceptable in local mode (tests, bench),
    because on a cluster every executor must reach the same files.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; operators that cut lineage need a "
            "folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


_SHIPPED: set[str] = set()


def _package_zip() -> bytes:
    """The ``tessera`` package as zip bytes, built in memory."""
    import io
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _dirs, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    return buf.getvalue()


def ship_package(spark: SparkSession, shared: bool | None = None) -> None:
    """Make ``tessera`` importable in executor Python workers (once per app).

    Operators that run Python per partition (``mapInPandas``) pickle
    functions by reference to this package, so executors need it: the same
    thing ``--py-files`` does at submit time. In local mode the zip goes to a
    private temporary folder; on a cluster it is written into the shared
    checkpoint folder (through Hadoop's FileSystem) and added from there.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    data = _package_zip()
    if shared is None:
        shared = not sc.master.startswith("local")
    if shared:
        base = ensure_checkpoint_dir(spark).rstrip("/")
        target = f"{base}/tessera-pkg-{app}/tessera.zip"
        jvm = sc._jvm
        path = jvm.org.apache.hadoop.fs.Path(target)
        out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
        try:
            out.write(bytearray(data))
        finally:
            out.close()
        sc.addPyFile(target)
    else:
        work = tempfile.mkdtemp(prefix="tessera-pkg-")
        local = os.path.join(work, "tessera.zip")
        with open(local, "wb") as fh:
            fh.write(data)
        sc.addPyFile(local)
    _SHIPPED.add(app)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (never a local checkpoint).

    Used where a later step must see exactly the same rows and partition
    assignment as an earlier one, and where a lost executor must not force a
    nondeterministic recomputation.
    """
    ensure_checkpoint_dir(df.sparkSession)
    ship_package(df.sparkSession)
    return df.checkpoint(eager=True)


def default_parallelism(spark: SparkSession) -> int:
    """Partition count for explicit repartitions: the shuffle setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def settings_for_input(input_bytes: int, cores: int, mem_per_core_bytes: int = 4 << 30) -> dict[str, str]:
    """Shuffle and scan sizes for a job reading ``input_bytes`` on ``cores``
    task slots (each with about ``mem_per_core_bytes`` of execution memory).

    Scan splits of 256 MB (more and the per-task memory is at risk, fewer and
    the scheduling cost grows); an initial shuffle fan-out of about one
    partition per 256 MB of input, never below 2 x cores, which AQE coalesces
    towards the 128 MB advisory size; skew splitting above 4 x the median
    partition or 512 MB.
    """
    mb = 1 << 20
    split = 256 * mb if mem_per_core_bytes >= 2 << 30 else 128 * mb
    shuffle = max(2 * cores, min(200_000, -(-input_bytes // (256 * mb))))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * mb),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * mb),
    }


def apply_settings(spark: SparkSession, settings: dict[str, str]) -> None:
    """Set runtime SQL options (all of the above can change per session)."""
    for key, value in settings.items():
        spark.conf.set(key, value)

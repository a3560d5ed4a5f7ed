"""Session helpers: a local session for tests/bench and the shared scratch area."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession


def _driver_memory(cap_gb: int = 16) -> str:
    """Local driver heap: 60% of physical memory, at most ``cap_gb`` (a 7 GB host gets 4g)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
        return f"{max(1, min(cap_gb, int(total * 0.6 / (1 << 30))))}g"
    except (ValueError, OSError, AttributeError):
        return "4g"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerline") -> SparkSession:
    """A local session configured like the cluster profile (AQE on, UI off, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", _driver_memory())
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session. Unset, a fresh local folder is registered for a local master; on a
    cluster that is an error, as executors would write to disks that they do not share.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current:
            sc.setCheckpointDir(current)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        sc.setCheckpointDir(base)
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def scratch_dir(spark: SparkSession, tag: str) -> str:
    """A fresh, never-reused (not yet created) sub-folder of the shared checkpoint area."""
    root = checkpoint_root(spark)
    return f"{root}/ledgerline-scratch/{tag}-{uuid.uuid4().hex}"


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that begins in here are removed when it ends. Spark keeps them until the driver
    happens to collect its garbage, so that those of all steps of a job would lie on the disk at a time."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)


def remove_scratch(path: str) -> None:
    """Remove a table of the scratch area that nothing reads any more."""
    from pyarrow import fs as pafs

    from ledgerline.sinks.archives import filesystem

    fs, base = filesystem(path)
    if fs.get_file_info(base).type == pafs.FileType.Directory:
        fs.delete_dir(base)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for Python-side file access (pyarrow handles other schemes)."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``ledgerline`` importable in Spark's Python workers (once per application).

    Python-side operators (mapInPandas jobs, the tar data source, stateful stream functions) are
    pickled by reference to this package; the package is zipped on the driver and distributed with
    ``SparkContext.addPyFile``, so workers import it whatever their working directory or host.
    """
    import io
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for base, dirs, files in os.walk(pkg):
            dirs[:] = [x for x in dirs if x != "__pycache__"]
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.join("ledgerline", os.path.relpath(full, pkg)))
    # written into the shared checkpoint area (not a machine-local folder) and shipped by Spark
    from ledgerline.sinks.archives import filesystem

    target = f"{checkpoint_root(spark)}/ledgerline-pyfiles/{uuid.uuid4().hex}/ledgerline.zip"
    fs, path = filesystem(target)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(path) as out:
        out.write(buf.getvalue())
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def partitions_for_size(spark: SparkSession, total: int, per_partition: int) -> int:
    """Partition count for ``total`` measured units (bytes or rows) at ``per_partition`` each,
    never below ``spark.sql.shuffle.partitions``. Sizes are measured by the caller (an aggregate),
    not taken from plan estimates: without table statistics a join's estimate is an upper bound
    that can be larger than the data by orders of magnitude."""
    base = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), 1)
    return int(max(base, -(-int(total or 0) // int(per_partition))))

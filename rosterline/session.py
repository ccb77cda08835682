"""Session helpers: adaptive execution and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow.fs as pafs
from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation, SparkSession

# Runtime settings every job relies on. Adaptive execution picks a broadcast join only after
# measuring the side it would ship, splits partitions made large by a hot key, and merges small ones.
ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


def ensure_adaptive(spark: SparkSession) -> SparkSession:
    for key, value in ADAPTIVE_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("rosterline")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**ADAPTIVE_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a cluster a
    machine-local folder would lose data with its machine, so a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="rosterline-"))
        current = context.getCheckpointDir()
    return current.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{work_dir(spark)}/rosterline/{name}-{uuid.uuid4().hex}"


def newest_version(path: str) -> int:
    """The highest number of a folder ``version=n`` below ``path`` that Spark has finished writing, 0 without one."""
    fs, root = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
    listed = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
    numbers = sorted((int(x.base_name.removeprefix("version=")) for x in listed if x.base_name.startswith("version=")), reverse=True)
    done = (n for n in numbers if fs.get_file_info(f"{root}/version={n:06d}/_SUCCESS").type == pafs.FileType.File)
    return next(done, 0)


def observed(seen: Observation, *names: str) -> tuple:
    """What a finished job has observed; zeros where the optimizer found the frame empty and dropped the observation with it."""
    try:
        found = seen.get
    except Py4JJavaError:
        found = {}
    return tuple(found.get(name) or 0 for name in names)

"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import site
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings the operators assume. UTC matters: timestamps are stored as ISO-8601 'Z' text
# and months/hours are computed in UTC.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # Written tables and the spill of sorts are what fills disks on large inputs: tables are packed closer, tasks
    # read less, and a join by (sha, filename) takes rows that already lie by sha as they are.
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "24m",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}
#: A shuffle is first cut into this many times ``spark.sql.shuffle.partitions`` parts; AQE joins small ones again.
FINER = 5


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "pullscope", extra: dict | None = None) -> SparkSession:
    """Create (or get) a session with the base settings.

    On a cluster, leave ``master`` unset and let the launcher decide; size
    ``spark.sql.shuffle.partitions`` to the data (AQE coalesces small partitions).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable base settings to an existing session."""
    for k, v in BASE_CONF.items():
        if k == "spark.ui.enabled":
            continue
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: leave it
            pass
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(FINER * parts))
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the workers where they could not import it from a path of their own
    (the driver found it on a path that only its own process added)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep), *site.getsitepackages()]
    app = spark.sparkContext.applicationId
    if app in _shipped or root in map(os.path.abspath, filter(None, known)) or not os.path.isdir(root):
        return
    zipped = os.path.join(tempfile.mkdtemp(prefix="pullscope-"), "pullscope.zip")
    with zipfile.ZipFile(zipped, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "pullscope")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(zipped)
    _shipped.add(app)


_shipped: set[str] = set()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Only when it is unset and the master is local (tests) do we make our own folder; on a
    cluster a folder of the driver's machine would be lost to the executors, so that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.conf.get("spark.master", "local").split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="pullscope-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    try:  # enables DataFrame.checkpoint(); not available on every session kind
        spark.sparkContext.setCheckpointDir(d)
    except Exception:  # noqa: BLE001
        pass
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    return os.path.join(checkpoint_dir(spark), name)

"""Session construction and reliable-checkpoint helpers.

The library never picks a machine-local folder on a cluster: checkpoints go to
the shared folder the cluster names in ``spark.checkpoint.dir``. Only when the
session has none (tests, a laptop) is a fresh local folder assigned.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Defaults tuned for the single-node test machine; on a cluster the
# submitter's own settings win because ``getOrCreate`` keeps them.
_LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    # plan-time size estimates are not bounds (an exploded text column is
    # far larger than its file); broadcast only on AQE's measured sizes
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # drop checkpoint files once their DataFrame is unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.checkpoint.compress": "true",
}


def get_session(master: str | None = None, app: str = "simrec",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Return (or create) a session with AQE and skew-join handling on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_LOCAL_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder of the session; a fresh local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError(f"spark.checkpoint.dir is not set, and {sc.master} has no common local folder")
        configured = tempfile.mkdtemp(prefix="simrec-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def prepare_session(spark: SparkSession) -> SparkSession:
    """Settings every job here relies on, applied to a caller's session:
    no plan-time auto-broadcast (file-size estimates of exploded text are far
    below the real size), broadcast left to AQE's measured sizes, and a
    checkpoint folder whose files go when their DataFrame does. The settings stay
    on the session."""
    # a core setting, read from the live configuration whenever a checkpoint is made
    spark.sparkContext._jsc.sc().conf().set("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    # the JVM does not compile longer methods; the sketch test of a pair join is one, in parts it is compiled
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    if spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) in (None, "", "-1"):
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")
    ensure_checkpoint_dir(spark)
    return spark


#: AQE starts from so many shuffle partitions and joins them up to so many bytes; it never cuts
#: one that is too large for a task
FINE_PARTITIONS, FINE_BYTES = 256, "16MB"
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def fine_shuffles(spark: SparkSession, on: bool = True) -> None:
    """Let AQE size shuffle partitions by their bytes: with few partitions a task's sort and hash
    tables grow with the input. ``on=False`` takes the settings back; a caller's own values stay."""
    fine = {_INITIAL: str(max(FINE_PARTITIONS, shuffle_partitions(spark))), _ADVISORY: FINE_BYTES}
    for key, value in fine.items():
        if on and spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
        elif not on and spark.conf.get(key, None) == value:
            spark.conf.unset(key)


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage.

    Used where two branches of a plan must see byte-identical data (range
    bounds, partition ids) and where a recomputation after an executor loss
    could otherwise differ.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Have the files of finished steps deleted now. Spark deletes shuffle files and checkpoints once
    their objects are garbage, and a driver with free memory may not collect any for half an hour."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def shared_folder(spark: SparkSession) -> Iterator[str]:
    """A fresh folder beside the checkpoints, deleted at the end of the ``with`` block."""
    name = f"{ensure_checkpoint_dir(spark)}/simrec_{uuid.uuid4().hex}"
    try:
        yield name
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))

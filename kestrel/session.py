"""Session helpers: a local session for tests/bench and the shared work folder.

Library code never builds its own session; callers pass one in. Anything a job
must write (stream checkpoints, stream sinks, lineage cuts) goes under the
folder the cluster names in ``spark.checkpoint.dir``. Only when that setting is
missing (a bare local session, as in some tests) do we pick a folder ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "kestrel") -> SparkSession:
    """Local session used by tests and ``bench.py`` (never by library code)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared work folder: ``spark.checkpoint.dir``, else the context's
    checkpoint folder, else (bare local sessions only) a fresh local folder. On a cluster
    without either it raises: executors must not write to their own disks.

    On a cluster this is the shared storage the operators agreed on; jobs that
    must survive executor loss cut lineage or stage output there. The core
    setting itself cannot be changed at runtime, so only the context's
    checkpoint folder is set when nothing is configured.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="kestrel-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name under the shared work folder."""
    root = shared_dir(spark)
    return f"{root}/kestrel/{name}-{uuid.uuid4().hex[:12]}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared work folder once nothing reads it any more."""
    root = f"{shared_dir(spark)}/kestrel/"
    if not path.startswith(root):
        raise ValueError(f"{path} is not a scratch folder under {root}")
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


MAX_SHUFFLE_PARTITIONS = 20_000


def cluster_settings(
    input_bytes: int,
    executor_memory_bytes: int = 16 << 30,
    executor_cores: int = 4,
    target_partition_bytes: int = 256 << 20,
) -> dict[str, str]:
    """Session settings sized for a large run (pass them to ``SparkSession.builder.config``).

    * Input splits of ``target_partition_bytes`` (``spark.sql.files.maxPartitionBytes``).
    * Initial shuffle partitions so that one partition holds about
      ``target_partition_bytes`` of ``input_bytes``, at most 20,000: shuffle blocks grow with map
      tasks x partitions, and the driver keeps a status for each. Pass the bytes that reach the
      shuffle (after column pruning and partial aggregation), not the raw table. AQE then
      coalesces small partitions and splits skewed ones into pieces of the advisory size.
    * The partition target is capped so that ``executor_cores`` concurrent tasks
      fit in the execution memory of one executor (about 60% of the heap).
    """
    per_task = int(executor_memory_bytes * 0.6 / max(1, executor_cores))
    part = max(32 << 20, min(target_partition_bytes, per_task // 2))
    shuffle_partitions = min(MAX_SHUFFLE_PARTITIONS, max(200, -(-input_bytes // part)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(part),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * part),
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.files.maxPartitionBytes": str(part),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        # a hot key's rows become few sessions before the shuffle (kestrel.streaming.sessions)
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    }

"""Session helpers: building a local session for tests/bench, table loading,
and lineage cutting through the cluster's shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "regloom", memory: str = "4g") -> SparkSession:
    """Session for tests and the bench. On a cluster, use the cluster's own
    session; nothing in the library depends on this builder."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when nothing is configured *and* the master is local (tests) is a
    private temporary folder created; on a cluster that is an error, because
    a machine-local folder does not survive executor loss."""
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
            "spark.checkpoint.dir is not set; point it at a shared folder")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="regloom-ckpt-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable, eager checkpoint into the shared checkpoint folder.

    Used where a later step must see *exactly* the same partitioning/row ids
    as an earlier action (range partition bounds are sampled per job)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet into a fresh folder under the shared checkpoint
    folder and read it back: lineage cut like ``checkpoint()``, but columnar,
    and later filters are pushed into the scan (row-group statistics)."""
    import uuid

    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/regloom-tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


class Shared:
    """A broadcast value whose classes travel with it: executors need no copy of the package."""

    def __init__(self, broadcast):
        self.broadcast = broadcast

    @property
    def value(self):
        from pyspark import cloudpickle
        return cloudpickle.loads(self.broadcast.value)

    def release(self) -> None:
        self.broadcast.unpersist()


def share(spark: SparkSession, value) -> Shared:
    from pyspark import cloudpickle
    return Shared(spark.sparkContext.broadcast(cloudpickle.dumps(value)))


#: Rows up to which a counted table of groups is sent to every task.
SMALL_ROWS = 20_000


def small_side(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` written once, and broadcast in joins when it was counted to hold
    at most ``rows`` rows; a larger one is joined by shuffle."""
    kept = materialize(df, "groups")
    return F.broadcast(kept) if kept.count() <= rows else kept


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def partitions_for(df: DataFrame, target_bytes: int = 128 << 20) -> int:
    """Partition count for an explicit range repartition of ``df``: the
    optimizer's size estimate at ``target_bytes`` per partition, at least the
    default parallelism and at most the session's shuffle partition setting
    (sized for the cluster). No job runs; with no estimate the setting is used."""
    cap = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001  no estimate: use the configured width
        return cap
    floor = max(1, df.sparkSession.sparkContext.defaultParallelism)  # keep every core busy
    return max(1, min(cap, max(floor, -(-size // target_bytes))))

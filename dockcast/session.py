"""Session helpers: building a session for tests/bench, locating the shared
checkpoint folder, and size-checked broadcasts.

Nothing here touches Spark internals; everything is what a Spark user writes.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Default configuration for an occupancy job. AQE re-plans joins at runtime
# (broadcast when a shuffled side turns out small, skew-join splitting) and
# coalesces small shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Dimensions (stations, zones) are far below this; facts never are.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def build_session(master: str = "local[*]", app: str = "dockcast",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster, callers pass their own."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.driver.memory"] = os.environ.get("DOCKCAST_DRIVER_MEM", "16g")
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared (distributed) folder and is read
    as is. Only when it is unset (local tests) do we pick a folder of our own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder (HDFS/object store) "
                               "so checkpoints survive the loss of an executor")
        d = tempfile.mkdtemp(prefix="dockcast-ckpt-")  # local mode only (tests)
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives the
    loss of the executors that computed ``df``)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows: a partially aggregated
    count (one number per task moves)."""
    return df.count() <= max_rows


MAX_BROADCAST_BYTES = 256 << 20


def estimated_row_bytes(df: DataFrame) -> Column:
    """Bytes a row takes in memory: 16 a column, and the length of its texts."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    out = F.lit(16 * len(df.schema.fields)).cast("long")
    for t in texts:
        out = out + t
    return out


def broadcast_if_bounded(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only behind a checked bound of rows and estimated bytes
    (one partial aggregate); otherwise leave the join to the planner (shuffle
    hash / sort-merge, AQE may still switch)."""
    size = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(estimated_row_bytes(df)), F.lit(0)).alias("b")).first()
    return F.broadcast(df) if size["n"] <= max_rows and size["b"] <= max_bytes else df


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints, as a string (for plan checks)."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def ship_package(spark: SparkSession) -> None:
    """Make the Python code that runs inside executors travel with the task.

    The operators whose functions run in Python workers (``mapInPandas``)
    live in two modules; registering them with cloudpickle "by value" ships
    their code inside the serialized task, so workers need neither the
    package installed nor any file copied (no local folders involved).
    On a cluster, installing the package or ``--py-files`` works as well.
    """
    from pyspark import cloudpickle

    from dockcast.operators import model, sequence
    for mod in (sequence, model):
        try:
            cloudpickle.register_pickle_by_value(mod)
        except ValueError:  # already registered
            pass

"""Session settings and the shared folder every multi-step job writes to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "tideline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library expects. ``master=None`` leaves it to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Set the runtime options the operators rely on; safe to call on any session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # Sessions of a hot key are merged inside each input partition before the shuffle.
    spark.conf.set("spark.sql.sessionWindow.merge.sessions.in.local.partition", "true")
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name under ``spark.checkpoint.dir`` that all executors can reach.

    Only a local session, where driver and executors are one process, may fall back to a
    temporary folder of the machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="tideline-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def broadcast_if_small(df: DataFrame, max_rows: int = 1_000_000, max_bytes: int = 64 << 20) -> DataFrame:
    """Hint a broadcast only after measuring that ``df`` stays within both bounds.

    Beyond them the frame is returned as it is and the join shuffles (AQE splits skewed keys). At most
    ``max_rows + 1`` rows are measured.
    """
    size = F.octet_length(F.to_json(F.struct("*")))
    rows, width = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(size)).first()
    if rows <= max_rows and (width or 0) <= max_bytes:
        return F.broadcast(df)
    return df


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the frame that reads it back.

    Used for small tables that several branches of a plan need: they are computed once and survive
    the loss of executors.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Remove the folders of settled frames that nothing reads any more."""
    for df in frames:
        context = df.sparkSession.sparkContext
        for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)

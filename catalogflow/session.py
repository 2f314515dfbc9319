"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# Everything here can be overridden by spark-submit or the cluster defaults,
# except the zone: stored timestamps are instants, shown and parsed in UTC.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key is split even where the split costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Keyed streaming state outgrows the heap long before it outgrows local disk.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app_name: str = "catalogflow", master: str | None = None, **conf: str
) -> SparkSession:
    """Session with the package defaults; ``conf`` wins over them.

    Keys are given with ``__`` for dots, e.g. ``spark__ui__enabled="false"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = _DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()


def work_folder(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared one named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own;
    a cluster without it is an error, since executors would not share the path.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="catalogflow-")
        context.setCheckpointDir(root)
    folder = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _folders.setdefault(context.applicationId, []).append(folder)
    return folder


# Work folders given out, by application.
_folders: dict[str, list[str]] = {}


def work_folders(spark: SparkSession) -> tuple[str, ...]:
    """The work folders given out to this application and not cleared since."""
    return tuple(_folders.get(spark.sparkContext.applicationId, ()))


def clear_work_folders(spark: SparkSession, folders: Iterable[str] | None = None) -> None:
    """Delete work folders of this application, all of them unless ``folders`` are named.

    No frame that reads one may be used later.
    """
    given = _folders.get(spark.sparkContext.applicationId, [])
    for folder in list(given if folders is None else folders):
        if folder in given:
            given.remove(folder)
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(frame: DataFrame, label: str) -> DataFrame:
    """Write ``frame`` to the shared folder and read it back.

    Cuts the lineage so that values which depend on how rows were laid out
    (sampled range bounds, row numbers) are fixed once, for every later reader
    and every retried task.
    """
    path = work_folder(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)

"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Settings the engine counts on. Sizes (shuffle partitions, memory, split size) are
# left to the cluster: AQE coalesces whatever the cluster starts with.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # count(*) and count(column) are answered from parquet footers where possible
    "spark.sql.parquet.aggregatePushdown": "true",
    # checkpoints go when the frames that read them are gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # independent rule jobs share the executors instead of queueing
    "spark.scheduler.mode": "FAIR",
}


def build_session(
    app: str = "dqloom", master: str | None = None, **conf: str
) -> SparkSession:
    """A session with the engine's settings; ``conf`` keys use ``__`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or else the context's own."""
    context = getattr(spark, "sparkContext", None)  # not every kind of session has one
    folder = spark.conf.get("spark.checkpoint.dir", None) or (context and context.getCheckpointDir())
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df`` in the shared folder.

    Used where several passes read the same derived rows, so a lost executor costs a
    read of the checkpoint and not another scan of the source.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def small_frame(
    spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str
) -> DataFrame:
    """Driver-side metadata as a local relation, which plans fold without a job."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) or [()] * len(schema)
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)


def side_by_side(spark: SparkSession, work: Callable, items: Iterable, workers: int) -> list:
    """``work`` on each item, their independent jobs submitted at the same time."""
    with ThreadPoolExecutor(workers) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), items))

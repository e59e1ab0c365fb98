"""Session settings and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Window state of a large fleet does not fit the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

#: How the folders that ``stage`` writes begin.
STAGED = "odotrack-stage-"
#: Whether a query's shuffle files are removed as it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(app: str = "odotrack", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it. Only a
    local session may fall back to a temporary folder."""
    context = spark.sparkContext
    folder = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="odotrack-")
        context.setCheckpointDir(folder)
    return folder


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Later steps read only the columns and rows they need, and a lost executor
    costs a re-read instead of everything upstream. Shuffles of the write go with it;
    else they stay until the driver happens to collect its garbage."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{STAGED}{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(*tables: DataFrame) -> None:
    """Delete the folders that ``stage`` wrote and that ``tables`` read, so that a long query
    holds no more than its next step needs. Nothing may read them again."""
    for df in tables:
        jvm = df.sparkSession._jvm
        conf = df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
            if folder.rpartition("/")[2].startswith(STAGED):
                path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
                path.getFileSystem(conf).delete(path, True)

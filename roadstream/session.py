"""Session settings the operators rely on."""

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "roadstream", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution and UTC days. `conf` keys use `__` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in `spark.checkpoint.dir`.

    A local session without that setting gets a folder of its own; a cluster must name one.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named
    if sc.master.startswith("local"):
        return tempfile.mkdtemp(prefix="roadstream-")
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def snapshot(df: DataFrame) -> DataFrame:
    """`df` as it is now, stored in the shared folder: computed once however often it is used,
    and a lost executor cannot bring in a later state of its source."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()

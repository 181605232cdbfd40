"""Session helpers shared by every operator."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, app: str = "loomspark") -> SparkSession:
    """A session for tests and benches on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder that the cluster names; only an unset one (tests, one machine) gets a temporary folder."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not named and not context.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="loomspark-"))


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared checkpoint folder and read back: lineage ends here, later steps read only
    the columns they need, and the loss of an executor costs nothing. `drop_cuts` removes a session's tables."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/cut-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_cuts(spark: SparkSession) -> None:
    """Remove what `cut` wrote; results that still read it must have been stored before."""
    folder = spark.sparkContext._jsc.sc().getCheckpointDir()
    if folder.isDefined():
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.get()}/cut-*")
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for found in files.globStatus(path) or []:
            files.delete(found.getPath(), True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

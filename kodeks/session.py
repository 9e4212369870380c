"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "kodeks", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator of the library assumes: UTC, AQE and Arrow on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for k, v in (base | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder all executors share. The session's ``spark.checkpoint.dir`` is used where it is set; a
    temporary folder is made only where it isn't, which is the case of local tests."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="kodeks-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at


_CUTS: dict[str, tuple] = {}  # folder of every application's tables, and what removes it


def cut(df: DataFrame) -> DataFrame:
    """The rows written once as a table in the shared folder and read back: lineage ends here, lost executors cost
    nothing, later steps read the columns they need, and Spark knows the table's size. The tables of an application lie
    in one folder, which is removed when its driver ends."""
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    if app not in _CUTS:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/kodeks-{app}")
        _CUTS[app] = folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())
        atexit.register(remove_cuts, app)
    at = f"{_CUTS[app][0].toString()}/{uuid.uuid4().hex}"
    df.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def remove_cuts(app: str) -> None:
    """Remove the tables that ``cut`` wrote for an application; frames that read them can't be used any more."""
    if app in _CUTS:
        folder, files = _CUTS.pop(app)
        files.delete(folder, True)


PART_BYTES = 64 << 20  # what a spread partition holds at most, by the plan's own estimate


def parts_for(df: DataFrame) -> int:
    """Number of partitions for CPU-heavy work on ``df``: three for every core, the session's number of shuffle
    partitions, or its estimated bytes in parts of PART_BYTES, whichever is most."""
    spark = df.sparkSession
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    by_bytes = -(-size // PART_BYTES) if size < 1 << 60 else 0  # no estimate is given as the largest number
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism, by_bytes)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` in as many partitions as its work on the CPU and its bytes ask for. A number that is given isn't lowered by
    AQE, which looks at bytes only. The keys must be nearly unique, as hot ones would stay together."""
    return df.repartition(parts_for(df), *keys)


def spread_scan(df: DataFrame, *keys: str) -> DataFrame:
    """A scan as it is, or spread by unique keys where its files give work to fewer than half of the cores."""
    if 2 * df.rdd.getNumPartitions() >= df.sparkSession.sparkContext.defaultParallelism:
        return df
    return spread(df, *keys)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

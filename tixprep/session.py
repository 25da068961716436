"""Session helpers: a tuned local session for tests/bench and checkpoint-directory handling."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the library relies on. AQE re-plans joins from runtime sizes (class tables are
# broadcast only when their measured size is below the threshold) and splits skewed join
# partitions, which protects the class-table joins against one hot label.
SPARK_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "tixprep") -> SparkSession:
    """Local session for tests and the benchmark (no UI, AQE on)."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for k, v in SPARK_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.split("[")[0] == "local"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must name a folder that driver and executors share; without it this
    raises, as tables in a machine-local folder could not be read back. Only in local mode (tests)
    is a private folder created, and removed when the JVM ends."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    current = sc.getCheckpointDir()
    if configured:
        if not current:
            sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if current:
        return current
    if not is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="tixprep-ckpt-")
    _remove_at_end(spark, path)
    sc.setCheckpointDir(path)
    return path


def _remove_at_end(spark: SparkSession, path: str) -> None:
    """The file system removes ``path`` when the driver's JVM ends."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)


def table_folder(spark: SparkSession, kind: str = "tixprep-tables") -> str:
    """This application's folder for intermediate tables: one owner, removed when the driver ends."""
    sc = spark.sparkContext
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}/{sc.applicationId}"
    if path not in _owned:
        jvm = sc._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).mkdirs(target)
        _remove_at_end(spark, path)
        _owned.add(path)
    return path


_owned: set[str] = set()


def write_table(df: DataFrame, by: str | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet under the shared checkpoint folder; the table read back, and its path. Filters on the last
    column, where it is ``by``, read only the files with their values."""
    path = f"{table_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    w = df.write.mode("overwrite")
    (w.partitionBy(by) if by else w).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def delete_table(spark: SparkSession, path: str) -> None:
    """Remove a table that no later plan reads."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    The plan is computed exactly once (``checkpoint()`` would compute it twice without a cache),
    the written files survive executor loss, and downstream plans start from a plain scan."""
    return write_table(df)[0]


LABEL_TABLE_MB = 16  # Parquet size up to which a label table is sent to the rows


def label_table(df: DataFrame) -> DataFrame:
    """A derived table by labels that rows with texts will be joined with, written once. Up to ``LABEL_TABLE_MB`` it is sent to
    the rows, as beyond ``spark.sql.autoBroadcastJoinThreshold`` every text would be moved and sorted by its labels; a larger
    one is left to the planner."""
    table, path = write_table(df)
    target = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration())
    return F.broadcast(table) if fs.getContentSummary(target).getLength() <= LABEL_TABLE_MB << 20 else table


def apply_conf(spark: SparkSession) -> None:
    """Apply the library's runtime SQL settings where the caller's session names none."""
    given = dict(spark.sparkContext.getConf().getAll())
    for k, v in SPARK_CONF.items():
        if k.startswith("spark.sql.") and k not in given:
            spark.conf.set(k, v)


def dimension(df: DataFrame) -> DataFrame:
    """A small derived table (class table, dictionary, per-triple plan) that will be joined to rows.

    Written once so the planner knows its real size: below ``spark.sql.autoBroadcastJoinThreshold``
    it is broadcast and the (large, text-carrying) row side is never shuffled for the join; above
    it the join stays a sort-merge join with AQE skew handling."""
    return cut_lineage(df)

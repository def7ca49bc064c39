"""Writing results, and keeping intermediate results that several stages read."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BOOKING_DATE = "booking_date_pt"


def _by_booking_date(bookings: DataFrame) -> DataFrame:
    # REBALANCE lets Spark cut a day with very many bookings into several tasks and files,
    # which a plain repartition by date would not.
    dated = bookings.withColumn(BOOKING_DATE, F.col("booking_at_pt").cast("date"))
    return dated.hint("rebalance", BOOKING_DATE)


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as it knows it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def remove_folder(spark: SparkSession, path: str) -> None:
    files, folder = _file_system(spark, path)
    files.delete(folder, True)


VERSIONS, POINTERS = "versions", "published"
#: The published version and the one before it stay, so that a reader of the latter can finish.
KEPT_VERSIONS = 2


def _published(spark: SparkSession, path: str) -> dict[int, str]:
    """Pointer number -> version folder, of all pointers below ``path``."""
    files, folder = _file_system(spark, f"{path.rstrip('/')}/{POINTERS}")
    if not files.exists(folder):
        return {}
    # Of writers that met, which both made this number, the last name counts for every reader.
    names = sorted(s.getPath().getName() for s in files.listStatus(folder))
    found = (re.fullmatch(r"([0-9]{12})-([0-9a-f]{32})", name) for name in names)
    return {int(m[1]): f"{path.rstrip('/')}/{VERSIONS}/{m[2]}" for m in found if m}


def published_folder(spark: SparkSession, path: str) -> str:
    """The folder of the bookings that are published at ``path``."""
    found = _published(spark, path)
    if not found:
        raise FileNotFoundError(f"no bookings are published at {path}")
    return found[max(found)]


def read_bookings(spark: SparkSession, path: str) -> DataFrame:
    """The bookings that are published at ``path``: always one whole version."""
    return spark.read.parquet(published_folder(spark, path))


def write_bookings(bookings: DataFrame, path: str) -> str:
    """Publish a new version of the bookings at ``path``; returns its folder.

    A version is a folder of parquet, one folder per Pacific booking date in it. When it is complete, one object is
    made whose name says its number and folder; readers take the object with the highest number. Making one empty object is
    atomic on object stores and file systems alike, and nothing is renamed, so at any time a reader sees
    one whole version, and a writer that fails or is killed leaves the published one. Versions before the last but
    one are removed.
    """
    spark = bookings.sparkSession
    base, version = path.rstrip("/"), uuid.uuid4().hex
    folder = f"{base}/{VERSIONS}/{version}"
    try:
        _by_booking_date(bookings).write.partitionBy(BOOKING_DATE).parquet(folder)
    except Exception:
        remove_folder(spark, folder)
        raise
    earlier = _published(spark, path)
    number = max(earlier, default=0) + 1
    files, pointer = _file_system(spark, f"{base}/{POINTERS}/{number:012d}-{version}")
    files.create(pointer, False).close()
    for old in sorted(earlier)[: max(0, len(earlier) + 1 - KEPT_VERSIONS)]:
        gone = earlier[old]
        # The pointer first: nobody finds a version that is being removed.
        remove_folder(spark, f"{base}/{POINTERS}/{old:012d}-{gone.rpartition('/')[2]}")
        remove_folder(spark, gone)
    return folder


def save_bookings_table(bookings: DataFrame, table: str) -> None:
    """Replace the bookings that the view ``table`` shows, partitioned by Pacific booking date.

    Every run writes a table of its own. The view switches to it when it is complete, then the tables of
    earlier runs are dropped.
    """
    spark = bookings.sparkSession
    database, _, name = table.rpartition(".")
    prefix = f"{database}." if database else ""
    run = f"{name}_run_{uuid.uuid4().hex[:12]}"
    try:
        _by_booking_date(bookings).write.partitionBy(BOOKING_DATE).saveAsTable(prefix + run)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}{run}")
        raise
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {prefix}{run}")
    for other in spark.catalog.listTables(database or None):
        if re.fullmatch(re.escape(name.lower()) + "_run_[0-9a-f]{12}", other.name) and other.name != run:
            spark.sql(f"DROP TABLE {prefix}{other.name}")


def session_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that the session names in ``spark.checkpoint.dir``.

    Only a local session without the setting, as in tests, gets a folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="bookledger-")


class Storage:
    """Keeps an intermediate result that more than one stage reads, as a parquet table, tightly packed.

    The tables go below ``folder``, which all executors have to reach, so they outlive a lost
    executor and cut the lineage. ``remove`` deletes them all at the end of a run.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.root = f"{folder.rstrip('/')}/bookledger-{uuid.uuid4().hex}"
        self._kept = 0
        self._tables: list[str] = []

    def keep(self, df: DataFrame) -> DataFrame:
        self._kept += 1
        path = f"{self.root}/{self._kept:03d}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep_in_buckets(self, df: DataFrame, key: str) -> DataFrame:
        """As ``keep``, but the table is known to lie by ``key``: what works by it reads without a shuffle.

        What lies by the key already, as windows, joins or sums by it yield, is not moved. There are as many
        buckets as shuffles have partitions. The key must not be skewed.
        """
        self._kept += 1
        name = f"bookledger_{uuid.uuid4().hex}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        writer = df.repartition(key).write.bucketBy(buckets, key)
        writer.option("compression", "zstd").option("path", f"{self.root}/{self._kept:03d}").saveAsTable(name)
        self._tables.append(name)
        return self.spark.table(name)

    def remove(self) -> None:
        for name in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._tables.clear()
        remove_folder(self.spark, self.root)

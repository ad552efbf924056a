"""Publication of whole folders: a table or one day of it changes in one step of the catalog.

A load writes into a folder that no reader knows. When the write has ended, the catalog is pointed to
it, and readers that plan their query from then on see all of the new rows, those before all of the old
ones. A load that fails leaves the old rows where they are. Folders that start with an underscore are
not listed by Spark's readers, so versions can live below their table's own folder.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

VERSIONS = "_versions"
ROOT_PROPERTY = "feedmetrics.root"


def _path(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    place, files = _path(spark, path)
    files.delete(place, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    place, files = _path(spark, path)
    return files.exists(place)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Give a folder its final place; an empty one where the source is missing."""
    (old, files), (new, _) = _path(spark, source), _path(spark, target)
    files.mkdirs(new.getParent())
    if not files.exists(old):
        files.mkdirs(new)
    elif not files.rename(old, new):
        raise OSError(f"{source} could not be moved to {target}")


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``, in order; none if there is no such folder."""
    place, files = _path(spark, path)
    if not files.exists(place):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(place) if s.isDirectory())


def table_location(spark: SparkSession, table: str, partition: str | None = None) -> str:
    """Where the catalog says that a table, or one partition of it, lies."""
    clause = f" PARTITION ({partition})" if partition else ""
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {table}{clause}").where("col_name = 'Location'")
    return details.first()["data_type"].rstrip("/")


class Version:
    """A folder for one load, named so that later loads sort after earlier ones."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.name = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        self.path = f"{self.root}/{self.name}"
        self.published = False

    def __enter__(self) -> "Version":
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is not None and not self.published:
            delete_folder(self.spark, self.path)

    def name_of(self, location: str) -> str | None:
        """The version that a location of the catalog stands for, or none if it lies elsewhere."""
        parent, _, name = location.rstrip("/").rpartition("/")
        same = _path(self.spark, parent)[0].toUri().getPath() == _path(self.spark, self.root)[0].toUri().getPath()
        return name if same else None

    def is_newest(self, published: str | None) -> bool:
        """Whether no load that started later has been published; ``published`` is the catalog's location."""
        return published is None or (self.name_of(published) or "") < self.name

    def remove_older(self, replaced: str | None) -> None:
        """Remove what was there before the version just replaced.

        The replaced one stays until the next load: queries planned before the change still read it.
        """
        kept = self.name_of(replaced) if replaced else None
        if kept:
            for name in subfolders(self.spark, self.root):
                if name < kept:
                    delete_folder(self.spark, f"{self.root}/{name}")


def publish_partitions(table: str, column: str, folders: dict[str, tuple[Version, str]]) -> list[str]:
    """Point partitions of ``table`` to written folders: value of ``column`` to version and folder.

    A load that started before the one already published withdraws; the values that changed are returned.
    """
    changed, sparks = [], None
    for value, (version, folder) in folders.items():
        spark = sparks = version.spark
        partition = f"{column} = '{value}'"
        before = None
        if spark.sql(f"SHOW PARTITIONS {table} PARTITION ({partition})").count():
            before = table_location(spark, table, partition)
        if not version.is_newest(before):
            delete_folder(spark, version.path)
            continue
        version.published = True                # from here on the catalog may name its folder
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({partition}) LOCATION '{folder}'")
        spark.sql(f"ALTER TABLE {table} PARTITION ({partition}) SET LOCATION '{folder}'")
        changed.append(value)
        version.remove_older(before)
        plain = f"{table_location(spark, table)}/{column}={value}"
        if before and version.name_of(before) and folder_exists(spark, plain):
            delete_folder(spark, plain)         # a day loaded in place, before versions were kept
    if sparks:
        sparks.catalog.refreshTable(table)
    return changed


def publish_table(df: DataFrame, table: str, key: str | None = None, buckets: int = 0) -> None:
    """Make ``df`` the content of ``table``, all at once; the table is created where there is none.

    ``key`` and ``buckets`` store it in that many buckets by ``key``, each sorted by it. A table keeps the
    buckets it was created with; other numbers for it raise.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    root = table_root(spark, table)
    with Version(spark, f"{root}/{VERSIONS}") as version:
        staged = f"{table}_{uuid.uuid4().hex}"
        writer = df.write.format("parquet").option("path", version.path)
        if key:
            writer = writer.bucketBy(buckets, key).sortBy(key)
        writer.saveAsTable(staged)
        if not exists:
            version.published = True
            spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
            spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{ROOT_PROPERTY}' = '{root}')")
            return
        spark.sql(f"DROP TABLE {staged}")       # its files stay: it is not managed
        if key and buckets_of(spark, table) != buckets:
            raise ValueError(f"{table} has {buckets_of(spark, table)} buckets, not {buckets}")
        before = table_location(spark, table)
        if not version.is_newest(before):
            delete_folder(spark, version.path)
            return
        version.published = True
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{version.path}'")
        version.remove_older(before)
    spark.catalog.refreshTable(table)


def table_root(spark: SparkSession, table: str) -> str:
    """The folder below which versions of a published table lie."""
    if spark.catalog.tableExists(table):
        found = spark.sql(f"SHOW TBLPROPERTIES {table}").where(f"key = '{ROOT_PROPERTY}'").first()
        if found is None:
            raise ValueError(f"{table} was not made by publish_table")
        return found["value"]
    database, _, name = table.rpartition(".")
    where = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{where.rstrip('/')}/{name}"


def buckets_of(spark: SparkSession, table: str) -> int:
    """Number of buckets of a table, 0 if it has none."""
    row = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Num Buckets'").first()
    return int(row["data_type"]) if row else 0


def drop_published(spark: SparkSession, table: str) -> None:
    """Drop a table made by ``publish_table``, with all versions of its data."""
    root = table_root(spark, table)
    spark.sql(f"DROP TABLE {table}")
    delete_folder(spark, root)

"""Tables that are switched, not overwritten.

Data go to a folder of their own; a version is a few manifest rows (part, folder, run) written after them. Readers take the newest
manifest, so a write that fails leaves the version before it readable, and an older run's version is its snapshot.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

MANIFEST = "part string, folder string, run string"


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """All manifest rows with their version; none where nothing was published."""
    schema = f"{MANIFEST}, version bigint"
    try:
        return spark.read.schema(schema).option("basePath", f"{path}/versions").json(f"{path}/versions")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def newest(spark: SparkSession, path: str, run: str | None = None, until: int | None = None) -> tuple[int, list[tuple[str, str]]]:
    """(version, [(part, folder)]) of the newest version, of a run's newest one, or of the newest up to a number; (-1, []) if there is none."""
    rows = manifests(spark, path)
    rows = rows if run is None else rows.filter(F.col("run") == run)
    rows = rows if until is None else rows.filter(F.col("version") <= until)
    top = rows.agg(F.max("version")).first()[0]
    if top is None:
        return -1, []
    return top, [(r.part, r.folder) for r in rows.filter(F.col("version") == top).collect() if r.folder]  # a row per part


def switch(spark: SparkSession, path: str, version: int, parts: list[tuple[str, str]], run: str = "") -> None:
    """Make these folders the table's version; a version without any folder is an empty table."""
    rows = [(part, folder, run) for part, folder in parts] or [("", "", run)]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").json(f"{path}/versions/version={version}")


def publish(df: DataFrame, path: str, run: str) -> int:
    """Make df the table's newest version under a run's name. df may read the table itself."""
    spark = df.sparkSession
    version = newest(spark, path)[0] + 1
    folder = f"{path}/data/version={version}"
    df.write.mode("overwrite").parquet(folder)
    switch(spark, path, version, [("", folder)], run)
    return version


def published(spark: SparkSession, path: str, schema: StructType | str, run: str | None = None) -> DataFrame:
    """The newest version, or a run's; an empty table if there is none."""
    return read_folders(spark, [folder for _, folder in newest(spark, path, run)[1]], schema)


def read_folders(spark: SparkSession, folders: list[str], schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def forget(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete manifests but the newest `keep`, and data folders that none of these names; returns the data folders that went."""
    rows = manifests(spark, path)
    top = [r.version for r in rows.select("version").distinct().orderBy(F.desc("version")).limit(keep).collect()]
    if not top:
        return []
    old = rows.filter(F.col("version") < top[-1])
    named = rows.filter((F.col("version") >= top[-1]) & (F.col("folder") != "")).select("folder").distinct()
    gone = [r.folder for r in old.filter("folder <> ''").select("folder").distinct().join(named, "folder", "left_anti").collect()]
    for version in [r.version for r in old.select("version").distinct().collect()]:
        delete(spark, f"{path}/versions/version={version}")
    for folder in gone:
        delete(spark, folder)
    return gone


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)

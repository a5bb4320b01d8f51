"""Stored tables: month loads, materialised results, versioned dimensions, views."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..session import shuffles_released


def check_schema(df: DataFrame, declared: StructType) -> DataFrame:
    """``df`` in the declared column order; raises on a missing column or another type."""
    have = {f.name.lower(): f.dataType for f in df.schema}
    wrong = [
        f"{f.name}: declared {f.dataType.simpleString()}, "
        f"found {have[f.name.lower()].simpleString() if f.name.lower() in have else 'none'}"
        for f in declared
        if have.get(f.name.lower()) != f.dataType
    ]
    if wrong:
        raise ValueError("schema mismatch: " + "; ".join(wrong))
    return df.select(*[F.col(f.name).alias(f.name) for f in declared])


def create_table(spark: SparkSession, schema: StructType, path: str) -> None:
    """An empty table with the declared columns, unless one is there already."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def replace_partitions(
    df: DataFrame, path: str, by: list[str], covers: Iterable[tuple] = ()
) -> list[tuple]:
    """Write ``df``, replacing only the partitions it has rows for.

    Running the same load again leaves the table as it was. ``covers`` names partitions, by
    their values of ``by``, that ``df`` stands for as a whole: of those, the ones it has no
    rows for are removed. Gives the removed ones.
    """
    spark = df.sparkSession
    folders = {values: f"{path}/{partition_folder(spark, by, values)}" for values in covers}
    before = {values: child_names(spark, folder) for values, folder in folders.items()}
    with shuffles_released(spark):
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*by)
            .parquet(path)
        )
    # a partition that was written has other files now
    left = [v for v, folder in folders.items() if before[v] and child_names(spark, folder) == before[v]]
    for values in left:
        delete_folder(spark, folders[values])
    return left


def partition_folder(spark: SparkSession, by: list[str], values: tuple) -> str:
    """The folder of a partition below its table, as Spark names it."""
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    return "/".join(name(column, None if value is None else str(value)) for column, value in zip(by, values))


def replace_table(df: DataFrame, path: str, by: Iterable[str] = ()) -> None:
    """Write ``df`` beside the table and put it in its place once it is complete."""
    spark = df.sparkSession
    with shuffles_released(spark):
        df.write.mode("overwrite").partitionBy(*by).parquet(f"{path}_next")
    delete_folder(spark, path)
    files, source = _folder(spark, f"{path}_next")
    if not files.rename(source, _folder(spark, path)[1]):
        raise OSError(f"cannot move {path}_next")


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder; none where there is no such folder."""
    files, root = _folder(spark, path)
    if not files.exists(root):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(root))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below a folder."""
    files, root = _folder(spark, path)
    return files.getContentSummary(root).getLength()


def delete_folder(spark: SparkSession, path: str) -> None:
    files, folder = _folder(spark, path)
    files.delete(folder, True)


def append_rows(df: DataFrame, path: str, by: list[str]) -> None:
    """Plain append: loading a file twice stores its rows twice."""
    df.write.mode("append").partitionBy(*by).parquet(path)


def materialize(df: DataFrame, path: str) -> None:
    """Store a result unless one is there already."""
    df.write.mode("ignore").parquet(path)


def _folder(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a completely written result is there."""
    files, marker = _folder(spark, f"{path}/_SUCCESS")
    return files.exists(marker)


def move_files(spark: SparkSession, source: str, target: str) -> None:
    """Moves the files of one folder into another, over files of their names; names stay."""
    files, root = _folder(spark, source)
    files.mkdirs(_folder(spark, target)[1])
    for status in files.listStatus(root):
        delete_folder(spark, f"{target}/{status.getPath().getName()}")
        if not files.rename(status.getPath(), _folder(spark, f"{target}/{status.getPath().getName()}")[1]):
            raise OSError(f"cannot move {status.getPath()}")


def collect_files(spark: SparkSession, source: str, column: str, target: str) -> None:
    """Moves the CSV files below ``column=value`` folders to ``n_value.csv`` in one folder."""
    files, root = _folder(spark, source)
    files.mkdirs(_folder(spark, target)[1])
    for folder in files.listStatus(root):
        name = folder.getPath().getName()
        if name.startswith(f"{column}="):
            for n, status in enumerate(files.listStatus(folder.getPath())):
                end = _folder(spark, f"{target}/{n}_{name.removeprefix(f'{column}=')}.csv")[1]
                if not files.rename(status.getPath(), end):
                    raise OSError(f"cannot move {status.getPath()}")


def versions(spark: SparkSession, path: str) -> list[int]:
    """Completely written versions of a table, oldest first."""
    files, root = _folder(spark, path)
    if not files.exists(root):
        return []
    names = [status.getPath().getName() for status in files.listStatus(root)]
    found = [int(n.removeprefix("version=")) for n in names if n.startswith("version=")]
    done = [v for v in found if files.exists(_folder(spark, f"{path}/version={v}/_SUCCESS")[1])]
    return sorted(done)


def write_version(df: DataFrame, path: str, keep: int | None = None) -> int:
    """Write the next version beside the current one, which ``df`` may be reading.

    Readers see the new version once its success marker is there, and a write that fails
    leaves the old one current. ``keep`` is how many versions stay; older ones are removed.
    """
    spark = df.sparkSession
    done = versions(spark, path)
    version = done[-1] + 1 if done else 1
    with shuffles_released(spark):
        df.write.mode("overwrite").parquet(f"{path}/version={version}")
    if keep:
        for old in [*done, version][:-keep]:
            delete_folder(spark, f"{path}/version={old}")
    return version


def replace_months(new: DataFrame, path: str, months: list[int], keep: int | None = None) -> int:
    """The next version: the current one's other months and the rows of ``new``.

    For results, which are small beside what they are made from.
    """
    spark = new.sparkSession
    old = read_version(spark, path).filter(~F.col("year_month").isin(months))
    return write_version(old.unionByName(new), path, keep)


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The given version, or the newest."""
    if version is None:
        done = versions(spark, path)
        if not done:
            raise FileNotFoundError(f"no complete version under {path}")
        version = done[-1]
    return spark.read.parquet(f"{path}/version={version}")

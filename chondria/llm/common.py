"""Storage and text pieces shared by the operators of this subpackage."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Only a local session without that setting gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="checkpoint-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder; what is there is deleted when the driver's JVM ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends there, and a lost executor loses nothing of it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forgotten(*frames: DataFrame) -> None:
    """Deletes tables that :func:`stored` made. Whatever was made of them must be stored itself."""
    for df in frames:
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            target = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def frees_shuffles(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """An operator whose jobs delete their shuffle files when they end, not when the driver's JVM collects what names them."""
    @functools.wraps(operator)
    def run(df: DataFrame, *args, **kwargs) -> DataFrame:
        conf = df.sparkSession.conf
        before = conf.get(CLEANUP, "false")
        conf.set(CLEANUP, "true")
        try:
            return operator(df, *args, **kwargs)
        finally:
            conf.set(CLEANUP, before)
    return run


def importable(spark: SparkSession) -> None:
    """Lets the Python workers of a local session import this package, from whatever folder it was started. A cluster has it installed."""
    if spark.sparkContext.master.startswith("local["):
        spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(df: DataFrame, text: str) -> Column:
    return F.coalesce(df[text].cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; 0 for NULL."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(F.length(trimmed) == 0, F.lit(0)).otherwise(F.size(F.split(trimmed, SPACE))).cast("long")


ROW = "row"


def row_of(df: DataFrame, columns: list[str]) -> Column:
    """The given columns of ``df`` as one, ``row``, so that no name of theirs can meet one of an operator's own."""
    return F.struct(*[df[c].alias(c) for c in columns]).alias(ROW)


def unpacked(columns: list[str]) -> list[Column]:
    return [F.col(ROW).getField(c).alias(c) for c in columns]

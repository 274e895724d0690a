"""Sample sheets, manifests, annotation tables and disease metadata."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from chondria import schema
from chondria.functions.casts import text_or_null
from chondria.sources.files import file_order, numbered_lines, require_columns


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Headerless sample sheet: ``row_no, id, file1, file2``; the third column may be absent."""
    cells = F.split(F.rtrim("value"), "\t")
    return numbered_lines(spark, path).select("row_no", *[F.get(cells, F.lit(i)).alias(f.name) for i, f in enumerate(schema.SHEET)])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``(row_no, s, path)``; further columns and blank lines are ignored."""
    cells = F.split(F.trim("value"), "\t")
    return numbered_lines(spark, path).select(
        "row_no", F.get(cells, F.lit(0)).alias("s"), F.get(cells, F.lit(1)).alias("path"))


def last_per_key(rows: DataFrame, keys: list[str], values: list[str], order: str) -> DataFrame:
    """One row per key, the last in ``order``. Combines on the map side, so a repeated key is no hot spot."""
    last = F.max_by(F.struct(*values), F.col(order)).alias("last")
    return rows.groupBy(*keys).agg(last, F.max(order).alias(order)).select(*keys, "last.*", order)


def read_commented(spark: SparkSession, path: str, needed: list[str], sep: str = "\t") -> DataFrame:
    """String table whose ``#`` starts a comment anywhere in a line; ``ord`` as in :func:`read_strings`."""
    lines = (spark.read.text(path)
             .select(F.regexp_replace("value", "#.*$", "").alias("value"), F.struct(*file_order()).alias("ord"))
             .filter(F.trim("value") != ""))
    header = lines.orderBy("ord").first()
    if header is None:
        raise ValueError(f"{path}: no header")
    names = [n.strip('"') for n in header["value"].split(sep)]
    ddl = ", ".join(f"`{n}` string" for n in names)
    parsed = (lines.filter(F.col("value") != header["value"])
              .select("ord", F.from_csv("value", ddl, {"sep": sep, "quote": '"', "escape": '"'}).alias("r"))
              .select("ord", "r.*"))
    require_columns(parsed, needed, path)
    return parsed.select(*[text_or_null(F.col(f"`{n}`")).alias(n) for n in needed], "ord")


def read_strings(spark: SparkSession, path: str, needed: list[str], sep: str = "\t") -> DataFrame:
    """String table with a header; ``ord`` is the line order for :func:`last_per_key`."""
    rows = spark.read.csv(path, sep=sep, header=True, quote='"', escape='"')
    require_columns(rows, needed, path)
    return rows.select(*[text_or_null(F.col(f"`{n}`")).alias(n) for n in needed],
                       F.struct(*file_order()).alias("ord"))


def read_disease_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``(s, category)`` as written; the separator and the column names are recognised in any case."""
    head = spark.read.text(path).first()
    if head is None:
        raise ValueError(f"{path}: empty metadata")
    sep = "," if "," in head["value"] and "\t" not in head["value"] else "\t"
    rows = spark.read.csv(path, sep=sep, header=True, quote='"', escape='"')
    by_name = {c.strip().lower(): c for c in reversed(rows.columns)}
    sample = next((by_name[c] for c in schema.SAMPLE_COLUMNS if c in by_name), None)
    if sample is None or "category" not in by_name:
        raise ValueError(f"{path}: no sample or category column in {rows.columns}")
    return rows.select(F.trim(F.col(f"`{sample}`")).alias("s"),
                       F.trim(F.col(f"`{by_name['category']}`")).alias("category"))

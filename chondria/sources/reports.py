"""BED site lists, contamination reports and coverage-metrics reports."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from chondria.functions.casts import integer, number
from chondria.operators.joins import lookup_join
from chondria.sources.files import path_key, read_or_empty, require_none, sample_before_dot

# 1-based report columns that must carry these names.
HAPLO_LAYOUT = {2: "Contamination", 6: "HgMajor", 8: "HgMinor", 14: "MeanHetLevelMajor", 15: "MeanHetLevelMinor"}


def read_bed(spark: SparkSession, path) -> DataFrame:
    """``(contig, start, end)`` with the half-open start of the format; short or non-numeric lines are skipped."""
    cells = F.split(F.trim("value"), r"\s+")
    return (spark.read.text(path)
            .select(F.get(cells, F.lit(0)).alias("contig"), integer(F.get(cells, F.lit(1))).alias("start"),
                    integer(F.get(cells, F.lit(2))).alias("end"))
            .dropna(subset=["start", "end"]))


def read_contamination(spark: SparkSession, path) -> DataFrame:
    """Contamination reports with their column positions checked.

    ``s, contamination, major_haplogroup, minor_haplogroup, major_level, minor_level``
    """
    cells = F.transform(F.split("value", "\t"), lambda c: F.replace(c, F.lit('"'), F.lit("")))
    rows = spark.read.text(path).filter(F.trim("value") != "").select(cells.alias("c"), F.input_file_name().alias("file"))
    header = F.array_contains("c", "SampleID")
    wrong = [~F.get(F.col("c"), F.lit(i - 1)).eqNullSafe(F.lit(name)) for i, name in HAPLO_LAYOUT.items()]
    bad = wrong[0]
    for w in wrong[1:]:
        bad = bad | w
    require_none(rows.filter(header & bad), "Bad contamination file format")
    heads = rows.groupBy("file").agg(F.count_if(header).alias("headers"))
    require_none(heads.filter("headers <> 1"), "Contamination file without one header row")
    at = {name: F.get(F.col("c"), F.lit(i - 1)) for i, name in HAPLO_LAYOUT.items()}
    return rows.filter(~header).select(
        F.get(F.col("c"), F.lit(0)).alias("s"), at["Contamination"].alias("contamination"),
        at["HgMajor"].alias("major_haplogroup"), at["HgMinor"].alias("minor_haplogroup"),
        number(at["MeanHetLevelMajor"]).alias("major_level"), number(at["MeanHetLevelMinor"]).alias("minor_level"))


def read_report_columns(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """Chosen columns of many report files, renamed; no matching file gives an empty table."""
    ddl = ", ".join(f"`{new}` string" for new in columns.values())
    return read_or_empty(
        lambda: spark.read.csv(path, sep="\t", header=True, quote='"', escape='"')
        .select(*[F.col(f"`{old}`").alias(new) for old, new in columns.items()]), spark, ddl)


def read_coverage_metrics(spark: SparkSession, path, manifest: DataFrame | None = None) -> DataFrame:
    """``(s, nuc_median, nuc_mean)`` from the first whole-genome metrics block of each report.

    With a manifest ``(s, path)`` only the listed files are kept and named by it; otherwise the sample id comes from the file name.
    """
    text = F.regexp_replace("value", "\r", "")
    block = F.regexp_extract(text, r"(?s)## METRICS CLASS[^\n]*WgsMetrics[^\n]*\n(.*?)(?:## HISTOGRAM|\z)", 1)
    lines = F.filter(F.split(block, "\n"), lambda line: F.trim(line) != "")
    names, values = F.split(F.get(lines, F.lit(0)), "\t"), F.split(F.get(lines, F.lit(1)), "\t")

    def field(name):
        place = F.array_position(names, name).cast("int")
        return number(F.when(place > 0, F.get(values, place - 1)))
    files = spark.read.text(path, wholetext=True)
    broken = F.coalesce(F.size(lines) < 2, F.lit(True)) | ~F.array_contains(names, "MEDIAN_COVERAGE") | \
        ~F.array_contains(names, "MEAN_COVERAGE")
    checked = F.when(broken, F.raise_error(F.concat(F.lit("no coverage metrics in "), "_metadata.file_path")))
    found = files.select(path_key(F.col("_metadata.file_path")).alias("path_key"), sample_before_dot(F.col("_metadata.file_name")).alias("s"),
                         checked.otherwise(field("MEDIAN_COVERAGE")).alias("nuc_median"),
                         field("MEAN_COVERAGE").alias("nuc_mean"))
    if manifest is not None:
        listed = manifest.select("s", path_key(F.col("path")).alias("path_key"))
        found = lookup_join(found.drop("s"), listed, ["path_key"], "inner")
    return found.select("s", "nuc_median", "nuc_mean")

"""Registered queries of readers and writers: rows of the driver tables go out as files and come back through a reader."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from chondria.operators import annotate as A, matrix as M, reads as R
from chondria.operators.storage import scratch_path as folder
from chondria.plans import documents, growth
from chondria.plans.lists import lists_job
from chondria.registry import queries as Q
from chondria.registry.inputs import derived, load
from chondria.registry.queries import query
from chondria.sinks import tables as sinks
from chondria.sinks.vcf import write_cohort_vcf
from chondria.sources import calls, coverage, files, reports, tables

HEADER = "\t".join(["#" + calls.FIXED[0], *calls.FIXED[1:]])


def _ordered(lines: DataFrame, order: str, path: str) -> str:
    """Text files whose names and lines follow ``order``."""
    lines.orderBy(order).select("value").write.text(path)
    return path


def _dealt(rows: DataFrame):
    """A writer of one folder and file per sample. The number of tasks is given, as Spark deals by bytes otherwise, and small files take time, not bytes:
    one task would write thousands of them. Tasks put their files in place themselves, so that the driver doesn't do it for all."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "s").write.partitionBy("s").option("mapreduce.fileoutputcommitter.algorithm.version", "2")


def _by_sample(lines: DataFrame, path: str) -> str:
    """One folder and file per sample."""
    _dealt(lines).text(path)
    return path


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    """``(s, path)`` of the files that :func:`_by_sample` wrote."""
    found = files.known_files(spark, path).filter(F.col("path_key").rlike("/s=[^/]+/part-"))
    return found.select(F.regexp_extract("path_key", "/s=([^/]+)/part-", 1).alias("s"), F.col("path_key").alias("path"))


def _read_back(spark: SparkSession, path: str, written: DataFrame) -> DataFrame:
    """All columns of a text table, as strings read and then of the types that were written. Empty texts come back as missing."""
    read = tables.read_strings(spark, path, written.columns)
    return read.select(*[F.col(c).cast(kind).alias(c) for c, kind in written.dtypes])


@query
def file_sheet(spark, sf):
    lines = derived(spark, sf, "sheet").select("row_no", F.concat_ws("\t", "id", "file1", "file2").alias("value"))
    return tables.read_sheet(spark, _ordered(lines, "row_no", folder(spark, "sheet")))


@query
def file_manifest(spark, sf):
    key = F.col("o_orderkey").cast("string")
    line = F.concat_ws("\t", F.concat(F.lit("S"), key), F.concat(F.lit("/calls/"), key), "o_orderstatus")
    lines = load(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, "  ").otherwise(line).alias("value"))
    return tables.read_manifest(spark, _ordered(lines, "o_orderkey", folder(spark, "manifest")))


@query
def file_names(spark, sf):
    stem = F.concat(F.lit("S"), F.col("o_orderkey").cast("string"))
    ends = [".merged.final.split.vcf", ".final.split.vcf.gz", ".merged.per_base_coverage.tsv.gz", ".per_base_coverage.tsv", ".wgs.txt"]
    end = F.element_at(F.array(*[F.lit(e) for e in ends]), (F.col("o_orderkey") % len(ends) + 1).cast("int"))
    return load(spark, sf, "orders").select(F.concat(stem, end).alias("file")).select(
        "file", F.col("file").rlike(files.CALL_FILES).alias("is_call"), F.col("file").rlike(files.COVERAGE_FILES).alias("is_coverage"),
        files.sample_of_file(F.col("file")).alias("s"), files.sample_before_dot(F.col("file")).alias("stem"))


@query
def file_coverage(spark, sf):
    path = folder(spark, "coverage")
    rows = derived(spark, sf, "coverage").select("s", F.lit("chrM").alias("chrom"), "pos", F.lit("t").alias("target"), "coverage")
    _dealt(rows).csv(path, sep="\t", header=True)
    return coverage.read_coverage(spark, f"{path}/s=*/part-*", _manifest(spark, path))


def _coverage_files(spark, rows, path):
    rows = rows.select("s", F.lit("chrM").alias("chrom"), "pos", F.lit("t").alias("target"), "coverage")
    _dealt(rows).mode("append").csv(path, sep="\t", header=True)


def _depth_counts(cells):
    return cells.groupBy("pos", F.col("coverage").alias("v")).agg(F.count(F.lit(1)).alias("n"))


@query
def grown_site_summary(spark, sf):
    """The site summary of a cohort that has grown: most samples come first, then the rest comes while some of the first go."""
    path, root = folder(spark, "coverage"), folder(spark, "cohort")
    found, late, gone = derived(spark, sf, "coverage"), F.col("s").endswith("7"), F.col("s").endswith("3")

    def read(paths, named):
        return coverage.read_coverage(spark, paths, named).drop("chrom")
    for rows, listed in ((found.filter(~late), F.lit(True)), (found.filter(late), ~gone)):
        _coverage_files(spark, rows, path)
        growth.grow(spark, root, _manifest(spark, path).filter(listed), path, read, {"depth": _depth_counts})
    n = growth.samples(spark, root).agg(F.count(F.lit(1))).scalar()
    return M.site_coverage_of_counts(growth.count(spark, root, "depth"), n)


@query
def file_commented_table(spark, sf):
    keys, values = ["ref", "position", "alt"], ["max_observed_heteroplasmy", "AF_hom", "AF_het"]
    cells = [F.coalesce(c, F.lit("")) for c in keys + values]
    note = F.when(F.col("ord") % 4 == 0, "# checked").otherwise("")
    lines = derived(spark, sf, "gnomad").select("ord", F.concat(F.concat_ws("\t", *cells), note).alias("value"))
    lines = lines.unionByName(lines.filter("ord % 5 = 0").select("ord", F.lit("# a whole line").alias("value")))
    head = spark.createDataFrame([(-2, "# source"), (-1, "\t".join(keys + values))], "ord bigint, value string")
    path = _ordered(head.unionByName(lines.withColumn("ord", F.col("ord").cast("long"))), "ord", folder(spark, "table"))
    return tables.last_per_key(tables.read_commented(spark, path, keys + values), keys, values, "ord").drop("ord")


@query
def file_plain_table(spark, sf):
    path, columns = folder(spark, "table"), ["rCRS", "Position", "Alt", "Quartile"]
    sinks.write_tsv(derived(spark, sf, "mitotip").select(*columns), path)
    return tables.read_strings(spark, path, columns).drop("ord")


@query
def file_calls(spark, sf):
    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit("."))
    name = F.when(F.col("flag") == "A", "PASS").when(F.col("flag") == "R", "strand_bias;FAIL").otherwise(".")
    info = F.concat(F.lit("MMQ=60,"), text("MQ"), F.lit(";TLOD="), text("TLOD"))
    cell = F.concat(F.lit("0/1:1,2:"), text("HL"), F.lit(":"), text("DP"))
    found = derived(spark, sf, "calls")
    lines = found.select("s", F.concat_ws("\t", F.lit("chrM"), text("pos"), F.lit("."), "ref", "alt", F.lit("."), name, info,
                                          F.lit("GT:AD:AF:DP"), cell).alias("value"))
    heads = found.select("s").distinct().select("s", F.inline(F.array(*[F.struct(F.lit(h).alias("value")) for h in (
        "##fileformat=VCFv4.2", f"{HEADER}\tx")])))
    path = _by_sample(lines.unionByName(heads), folder(spark, "calls"))
    rows = calls.read_calls(spark, f"{path}/s=*/part-*", _manifest(spark, path))
    return rows.select("s", "contig", "pos", F.array_join("alleles", ">").alias("alleles"), F.array_join("filters", ";").alias("filters"),
                       "DP", F.get("AF", F.lit(0)).alias("AF"), F.get("MMQ", F.lit(1)).alias("MMQ"), F.get("TLOD", F.lit(0)).alias("TLOD"))


@query
def file_cohort_vcf(spark, sf):
    path = folder(spark, "vcf")
    write_cohort_vcf(*Q.family_matrix(spark, sf), path)
    rows = A.long_records(*calls.read_annotated(spark, path))
    return A.format_by_tag(rows).select("SampleID", "POS", "REF", "ALT", "FILTER", "DP", "Heteroplasmy")


@query
def file_wide_coverage(spark, sf):
    """The sample-level text table, read back as lines of its files in their order, with the number of the line."""
    path = folder(spark, "wide")
    sinks.write_wide_coverage(derived(spark, sf, "family_coverage"), derived(spark, sf, "families"), path)
    return files.numbered_lines(spark, path)


@query
def file_bed(spark, sf):
    rows = derived(spark, sf, "bed").select(F.concat_ws(" ", "contig", "start", "end", F.lit("x")).alias("value"))
    track = spark.createDataFrame([("track name=x",), ("MT 5",), ("",)], "value string")
    path = folder(spark, "bed")
    rows.unionByName(track).write.text(path)
    return reports.read_bed(spark, path)


@query
def file_contamination(spark, sf):
    names = [reports.HAPLO_LAYOUT.get(i, "SampleID" if i == 1 else f"c{i}") for i in range(1, 16)]
    value = {"SampleID": "s", "Contamination": "contamination", "HgMajor": "haplogroup", "HgMinor": "haplogroup",
             "MeanHetLevelMajor": "major", "MeanHetLevelMinor": "minor"}
    found = load(spark, sf, "supplier").select(
        F.concat(F.lit("S"), "s_suppkey").alias("s"), F.when(F.col("s_suppkey") % 5 == 0, "YES").otherwise("NO").alias("contamination"),
        F.concat(F.lit("H"), "s_nationkey").alias("haplogroup"), (F.col("s_nationkey") / F.lit(64.0)).cast("string").alias("major"),
        F.when(F.col("s_suppkey") % 3 == 0, "NA").otherwise("0.015").alias("minor"))
    line = F.concat_ws("\t", *[F.concat(F.lit('"'), value[n] if n in value else F.lit("-"), F.lit('"')) for n in names])
    head = "\t".join(f'"{n}"' for n in names)
    path = _by_sample(found.select("s", F.inline(F.array(F.struct(F.lit(head).alias("value")), F.struct(line.alias("value"))))),
                      folder(spark, "reports"))
    return reports.read_contamination(spark, f"{path}/s=*/part-*")


@query
def file_report_metadata(spark, sf):
    path = folder(spark, "metadata")
    sinks.write_report_metadata(derived(spark, sf, "samples").withColumnRenamed("haplogroup", "major_haplogroup"), path)
    groups = reports.read_report_columns(spark, f"{path}/haplogroup_full", {"Sample_ID": "s", "Full_Haplogroup": "haplogroup"})
    status = reports.read_report_columns(spark, f"{path}/contamination", {"Sample_ID": "s", "Contamination_Status": "contamination"})
    return groups.join(status, "s")


@query
def file_metrics(spark, sf):
    number = (F.col("s_suppkey") / F.lit(4.0)).cast("string")
    block = F.concat(F.lit("# x\n## METRICS CLASS\tpicard.WgsMetrics\nTERRITORY\tMEAN_COVERAGE\tMEDIAN_COVERAGE\n9\t"), number,
                     F.lit("\t"), F.col("s_suppkey").cast("string"), F.lit("\n\n## HISTOGRAM\tInteger\ncoverage\tn\n0\t1"))
    lines = load(spark, sf, "supplier").select(F.concat(F.lit("S"), "s_suppkey").alias("s"), block.alias("value"))
    path = _by_sample(lines, folder(spark, "metrics"))
    return reports.read_coverage_metrics(spark, f"{path}/s=*/part-*", _manifest(spark, path))


@query
def file_disease_metadata(spark, sf):
    path = folder(spark, "metadata")
    sinks.write_tsv(derived(spark, sf, "samples").select("haplogroup", F.col("s").alias("Sample_ID"), F.col("category").alias("Category")), path)
    return tables.read_disease_metadata(spark, path)


@query
def file_matrix(spark, sf):
    return sinks.write_matrix(derived(spark, sf, "coverage"), folder(spark, "matrix"))


@query
def file_variant_lists(spark, sf):
    path = folder(spark, "lists")
    prefilter = Q.prefilter_single(spark, sf)
    lists_job(prefilter, path)
    both = [_read_back(spark, f"{path}/{name}", prefilter).withColumn("list", F.lit(name)) for name in ("variant_list_prefiltering", "variant_list")]
    return both[0].unionByName(both[1])


@query
def file_copy_number(spark, sf):
    path = folder(spark, "summary")
    summary = Q.sample_qc_mtcn(spark, sf)
    sinks.write_tsv(summary, path)
    return _read_back(spark, path, summary)


@query
def file_probands(spark, sf):
    path = folder(spark, "probands")
    sinks.write_probands(Q.proband_set(spark, sf), path)
    return files.numbered_lines(spark, path)


@query
def file_documents(spark, sf):
    path = folder(spark, "documents")
    sinks.write_documents(Q.doc_bulk_lines(spark, sf), path)
    return spark.read.text(path)


@query
def doc_store_merge(spark, sf):
    """A stored document table after two merges: orders as versions of their customer's document, then all of those again, which changes nothing."""
    root = folder(spark, "store")
    documents.write_store(derived(spark, sf, "stored"), root, "id", buckets=16)
    versions = load(spark, sf, "orders").select((F.col("o_custkey") * 2).alias("id"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("name"),
                                               F.col("o_orderkey").alias("version"))
    for operation in ("upsert", "update"):
        documents.merge_store(spark, root, versions, "id", operation, order="version")
    return documents.read_store(spark, root)


@query
def good_base_depth(spark, sf):
    """Depth over bases whose own quality is good; the quality falls and rises along a read."""
    width = F.col("end") - F.col("start")
    quals = F.transform(F.sequence(F.lit(0), width), lambda i: F.when(i % 31 != 0, (F.col("baseq") + i * i) % 41))
    return R.per_base_depth(R.good_bases(derived(spark, sf, "reads").withColumn("quals", quals)), Q._targets(spark))

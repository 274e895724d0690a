"""The same answers when every lookup counts as large, and when a third of the rows share one key."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from chondria.operators import annotate as A, joins, matrix as M, templates, sheet as S
from oracle_check import connect, differences

SF = "/root/testdata/sf0.001"
SHUFFLED = ["homref_resolve", "artifact_flag", "mask_overlap", "vcf_lines", "variant_long", "qc_gate", "sheet_usable",
          "annot_gnomad", "annot_haplogroup", "cohort_counts", "contaminated_out", "proband_filter", "proband_prefix",
          "proband_present", "final_single", "final_disease", "coverage_wide_lines"]


@pytest.fixture
def shuffled(spark):
    """No lookup is small, and any partition above the others is a skewed one."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


@pytest.mark.parametrize("name", SHUFFLED)
def test_large_lookups(spark, shuffled, name):
    assert differences(entry.queries()[name](spark, SF), connect(SF), entry.oracle_sql()[name]) == []


@pytest.fixture
def hot(spark):
    """3000 rows, a third of them on one position, another third of one sample."""
    i = F.col("id")
    return spark.range(3000).select(
        F.when(i % 3 == 1, F.lit("hot")).otherwise(F.concat(F.lit("s"), (i % 700).cast("string"))).alias("s"),
        F.when(i % 3 == 0, F.lit(100)).otherwise((i % 900 + 1).cast("int")).alias("pos"),
        (i % 1500).cast("int").alias("coverage"), i.alias("row_no"))


def largest_partition(df):
    """Rows in the largest partition; columns of both sides are read so that neither is optimised away."""
    per = df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"), F.max("text").alias("text"))
    return max(r["rows"] for r in per.collect())


def test_hot_key_is_spread(spark, shuffled, hot):
    hot = hot.withColumn("text", F.sha2(F.col("row_no").cast("string"), 256)).repartition(16, "row_no")
    facts = hot.groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    even = joins.lookup_join(hot, facts, ["s"])
    split = sorted(map(tuple, even.select("row_no", "n").collect()))
    after = largest_partition(even)
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        assert after < largest_partition(even.select("*")) / 1.5
        assert split == sorted(map(tuple, hot.join(facts, "s", "left").select("row_no", "n").collect()))
    finally:
        spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")


def test_hot_sample_in_a_sheet(spark, hot):
    sheet = hot.select("row_no", F.col("s").alias("id"), F.concat("row_no", F.lit(".fq.gz")).alias("file1"), F.lit(None).cast("string").alias("file2"))
    pairs = S.file_pairs(S.with_file_type(sheet))
    got = [r["pair_id"] for r in pairs.filter("id = 'hot'").orderBy(F.split("file1", r"\.")[0].cast("int")).collect()]
    assert got == list(range(1000))


def test_hot_site_in_the_matrix(spark, hot):
    cells = hot.groupBy("s", "pos").agg(F.max("coverage").alias("coverage"), F.max("row_no").alias("sample_idx"))
    sites = M.site_coverage(cells, F.lit(10)).filter("pos = 100").first()
    want = [r["coverage"] for r in cells.filter("pos = 100").collect()]
    assert sites["mean"] == pytest.approx(sum(want) / len(want))
    blocks = M.localize(cells, ["coverage"], ["pos"], block=16)
    assert blocks.agg(F.max(F.size("entries"))).first()[0] <= 16
    assert M.unlocalize(blocks, ["pos"]).count() == cells.count()


def test_hot_fragment(spark, hot):
    data = hot.select(F.concat(F.lit("r"), F.col("row_no").cast("string")).alias("qname"), F.lit("l").alias("library"), F.lit("m").alias("contig"),
                      F.col("pos").alias("five_prime"), F.lit(0).alias("strand"), F.lit(None).cast("int").alias("mate_five_prime"),
                      F.lit(None).cast("int").alias("mate_strand"), F.col("coverage").alias("sum_qual"))
    marked = templates.mark_duplicates(data)
    assert marked.filter("not is_duplicate").count() == data.select("five_prime").distinct().count()
    assert marked.count() == 3000


def test_hot_variant_counts(spark, hot):
    data = hot.select(F.col("s").alias("SampleID"), F.col("pos").cast("string").alias("POS"), F.lit("A").alias("REF"), F.lit("G").alias("ALT"),
                      F.lit(0.5).alias("Heteroplasmy"))
    got = A.cohort_counts(data).filter("POS = '100' and SampleID <> 'hot'").select("in_cohort_AC").distinct().collect()
    assert [r[0] for r in got] == [data.filter("POS = '100'").count()]

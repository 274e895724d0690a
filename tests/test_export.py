import glob
import gzip

from pyspark.sql import functions as F

from chondria.operators import annotate
from chondria.sinks import tables, vcf, wide

CELL = "contig string, pos int, ref string, alt string, s string, DP int, HL double, MQ double, TLOD double, FT array<string>"


def cohort(spark, n_sites=60, n_samples=7):
    cells = [("MT", p * 13 % 97 + 1, "A", alt, f"s{i}", p + i, i / 10, 50.0, 9.5, ["PASS"])
             for p in range(n_sites) for i in range(n_samples) for alt in "CG"[:1 + p % 2] if (p + i) % 3]
    cells = spark.createDataFrame(cells, CELL)
    sites = cells.select(*vcf.SITE).distinct().withColumn("filters", F.when(F.col("pos") % 5 > 0, F.array(F.lit("PASS"))))
    samples = spark.createDataFrame([(f"s{i}", i) for i in range(n_samples)], "s string, sample_idx int")
    return cells, sites, samples


def files_of(path):
    return [(gzip.open(f, "rt") if f.endswith(".gz") else open(f)).read().splitlines() for f in sorted(glob.glob(f"{path}/part-*"))]


def test_cohort_vcf_in_file_order(spark, tmp_path):
    cells, sites, samples = cohort(spark)
    vcf.write_cohort_vcf(cells, sites, samples, str(tmp_path / "out"), ["##one", "##two"], files=5, block=3)
    first, *rest = files_of(tmp_path / "out")
    assert first[:2] == ["##one", "##two"] and first[2].endswith("FORMAT\t" + "\t".join(f"s{i}" for i in range(7))) and len(first) == 3
    lines = [line for part in rest for line in part]
    want = sorted((r["pos"], r["ref"], r["alt"], r["line"]) for r in vcf.body_lines(cells, sites, samples, 3).collect())
    assert lines == [w[3] for w in want] and 3 <= len(rest) <= 5


def test_lines_are_made_once_and_not_moved(spark, tmp_path):
    """Every narrow text is read once to make lines, and nothing is exchanged after they are made."""
    cells, sites, samples = cohort(spark)
    seen = spark.sparkContext.accumulator(0)
    places = wide.ranged(sites.select(*vcf.SITE), vcf.SITE, 4)
    texts = wide.block_texts(vcf._known(cells), places.select(*vcf.SITE), samples, vcf.SITE, vcf.NO_CELL, 3)
    n = texts.count()

    @F.udf("string")
    def counted(text):
        seen.add(1)
        return text
    line = F.concat_ws("\t", "pos", "cells")
    wide.write_ordered(vcf.header(samples, []), texts.withColumn("_text", counted.asNondeterministic()("_text")), line, vcf.SITE, places, str(tmp_path / "o"))
    assert seen.value == n and sum(map(len, files_of(tmp_path / "o"))) == 1 + sites.count()
    dealt = texts.join(places, vcf.SITE).repartitionById(4, F.col("_range"))
    lines = wide.assembled(dealt, places.columns)
    lines.collect()
    plan = lines._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    top = plan[:plan.index("REPARTITION_BY_NUM")]
    assert top.count("Exchange") == 1 and "ObjectHashAggregate" in top


def test_wide_coverage_in_file_order(spark, tmp_path):
    rows = spark.createDataFrame([(p, f"s{i}", None if (p + i) % 4 == 0 else p * i) for p in range(40) for i in range(0, 6, 2)], "pos int, s string, coverage int")
    samples = spark.createDataFrame([(f"s{i}", i) for i in range(6)], "s string, sample_idx int")
    tables.write_wide_coverage(rows, samples, str(tmp_path / "w"), files=4)
    first, *rest = files_of(tmp_path / "w")
    assert first == ["pos\t" + "\t".join(f"s{i}" for i in range(6))] and len(rest) == 4
    assert [x for part in rest for x in part] == ["\t".join([str(p), *("NA" if i % 2 or (p + i) % 4 == 0 else str(p * i) for i in range(6))]) for p in range(40)]


def test_no_lines(spark, tmp_path):
    cells, sites, samples = cohort(spark)
    vcf.write_cohort_vcf(cells.limit(0), sites.limit(0), samples, str(tmp_path / "none"), [])
    assert [len(f) for f in files_of(tmp_path / "none")] == [1]


def test_texts_grow_with_the_known_cells(spark):
    """One sparse row a site: what is dealt is a text a known block and an end a site, and empty cells are in no text but between known ones of a block."""
    sites = spark.createDataFrame([("MT", p, "A", "C") for p in range(1, 9)], "contig string, pos int, ref string, alt string")
    cells = sites.filter("pos < 8").select(*vcf.SITE, F.concat(F.lit("s"), F.col("pos") * 10).alias("s"), F.lit("x").alias("cell"))
    samples = spark.range(100).select(F.concat(F.lit("s"), "id").alias("s"), F.col("id").alias("sample_idx"))
    texts = wide.block_texts(cells, sites, samples, vcf.SITE, "-", 8)
    assert texts.count() == 7 + 8 and {r["_text"] for r in texts.collect()} == {"x", "-"}
    got = {r["pos"]: r["cells"] for r in wide.wide_rows(cells, sites, samples, vcf.SITE, "-", 8).collect()}
    assert got == {p: "\t".join("x" if p < 8 and i == p * 10 else "-" for i in range(100)) for p in range(1, 9)}


def test_lines_are_not_split_again_for_each_proband(spark):
    """What makes the cells and the layout stands outside the lambdas over the probands, so it's evaluated once a line."""
    line = "\t".join(["MT", "5", ".", "A", "C", ".", "PASS", ".", "DP:HL", "3:0.5", ".:.", "9:0.0"])
    cells = F.split("line", "\t")
    records = spark.createDataFrame([(line,), (line.replace("0.5", "0.0"),)], "line string").repartition(2).select(
        *[F.get(cells, F.lit(i)).alias(n) for i, n in enumerate(["CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT"])],
        F.slice(cells, F.lit(10), F.lit(3)).alias("cells"))
    samples = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "idx int, SampleID string")
    lines, _ = vcf.proband_lines(records, samples, spark.createDataFrame([("a",), ("c",)], "s string"))
    assert [r["line"].split("\t")[9:] for r in lines.collect()] == [["3:0.5", "9:0.0"]]
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert "get(slice(split(" not in plan and "split(split(line" not in plan and "split(get(split(" not in plan


def test_known_cells_as_rows(spark):
    rows = [("A:B", [".:.", "1:.", ".", None, ".:.:."]), ("A", [".", "x"]), (None, ["."])]
    records = spark.createDataFrame(rows, "FORMAT string, cells array<string>")
    samples = spark.createDataFrame([(i, f"s{i}") for i in range(5)], "idx int, SampleID string")
    got = {known: {(r["FORMAT"], r["SampleID"], r["SAMPLE_DATA"]) for r in annotate.long_records(records, samples, known=known).collect()} for known in (True, False)}
    assert got[False] - got[True] == {("A:B", "s0", ".:."), ("A", "s0", ".")} and got[True] <= got[False] and len(got[False]) == 8


def test_finished_lines_meet_nothing(spark):
    """The filter of a site comes with its narrow rows, so no join, sort or exchange stands above the lines; of a site listed twice each has a line."""
    cells, sites, samples = cohort(spark)
    sites = sites.unionByName(sites.filter("pos = 1").withColumn("filters", F.array(F.lit("twice"))))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = vcf.body_lines(cells, sites, samples, 3)
        rows = lines.collect()
        plan = lines._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    top = plan[:plan.index("ObjectHashAggregate")]
    assert not any(x in top for x in ("Join", "Sort", "Exchange"))
    assert len(rows) == sites.count()
    assert {r["line"].split("\t")[6] for r in rows if r["pos"] == 1} == {"twice", "PASS"} and {r["line"].split("\t")[6] for r in rows if r["pos"] % 5 == 0} == {"."}


def test_cells_as_text(spark):
    """Records whose cells are one text give what those with an array do; lines that no proband can be kept for aren't split."""
    cells, sites, samples = cohort(spark, n_samples=40)
    cells = cells.filter("DP % 11 = 0").withColumn("HL", F.when(F.col("DP") % 2 == 0, F.col("HL")))
    lines = vcf.body_lines(cells, sites, samples, 16)
    names = ["CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", "cells"]
    text = lines.select(*[F.get(F.split("line", "\t", 10), F.lit(i)).alias(n) for i, n in enumerate(names)])
    text = text.unionByName(text.limit(3).withColumn("FORMAT", F.lit("DP:XX:MQ:TLOD:FT"))).unionByName(text.limit(3).withColumn("cells", F.lit(None).cast("string")))
    text = spark.createDataFrame(text.collect(), text.schema)
    array = text.withColumn("cells", F.split("cells", "\t"))
    named = samples.select(F.col("sample_idx").alias("idx"), F.col("s").alias("SampleID"))
    ids = spark.createDataFrame([("s3",), ("s7",), ("s39",)], "s string")

    def rows(df):
        return sorted(map(str, df.collect()))
    for known in (True, False):
        assert rows(annotate.long_records(text, named, known=known)) == rows(annotate.long_records(array, named, known=known))
    for by_level in (True, False):
        got, want = (rows(vcf.proband_lines(r, named, ids, by_level)[0]) for r in (text, array))
        assert got == want and 0 < len(got)
    assert len(rows(vcf.proband_lines(text, named, ids)[0])) < lines.count()

import glob
import re

import pytest
from pyspark.sql import functions as F

from chondria.operators import annotate as A
from chondria.plans.lists import read_resources
from chondria.registry import files as registry_files
from chondria.sources import calls, coverage, files, reports, tables


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_sheet_and_manifest(spark, write):
    sheet = tables.read_sheet(spark, write("sheet.tsv", "a\tx.cram\tx.crai\n\nb\ty.bam\nc\n"))
    assert rows(sheet, "row_no") == [(0, "a", "x.cram", "x.crai"), (1, "b", "y.bam", None), (2, "c", None, None)]
    manifest = tables.read_manifest(spark, write("m.tsv", "s1\t/p/1\textra\n  \ns2\t/p/2\n"))
    assert rows(manifest, "row_no") == [(0, "s1", "/p/1"), (1, "s2", "/p/2")]


def test_line_numbers_over_many_splits(spark, tmp_path):
    for part in range(3):
        (tmp_path / f"f{part}.txt").write_text("".join(f"{part}-{i:04d}\n\n" for i in range(500)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        got = rows(files.numbered_lines(spark, str(tmp_path)), "row_no")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [n for n, _ in got] == list(range(1500))
    assert [v for _, v in got] == sorted(v for _, v in got)


def test_file_discovery(spark, write, tmp_path):
    write("d/S1.merged.final.split.vcf", "x")
    write("d/deep/S2.merged.per_base_coverage.tsv.gz", "x")
    write("d/S3.other.txt", "x")
    assert rows(files.list_files(spark, str(tmp_path / "d"), files.CALL_FILES).select("s")) == [("S1",)]
    assert rows(files.list_files(spark, str(tmp_path / "d"), files.COVERAGE_FILES).select("s")) == [("S2",)]


def test_coverage(spark, write, tmp_path):
    head = "chrom\tpos\ttarget\tcoverage\n"
    one = write("cov/A.merged.per_base_coverage.tsv", head + "chrM\t1\tt\t10\nchrM\t2\tt\t20\n")
    write("cov/B.per_base_coverage.tsv", head + "chrM\t1\tt\t30\n")
    folder = str(tmp_path / "cov")
    assert rows(coverage.read_coverage(spark, folder), "s", "pos") == [
        ("chrM", 1, "A", 10), ("chrM", 2, "A", 20), ("chrM", 1, "B", 30)]
    manifest = spark.createDataFrame([("named", one), ("gone", "/no/such")], "s string, path string")
    assert rows(coverage.read_coverage(spark, folder, manifest), "pos") == [("chrM", 1, "named", 10), ("chrM", 2, "named", 20)]


def test_commented_table(spark, write):
    text = "# lead\nref\tpos\talt\tgbcnt\nA\t1\tG\t5# note\nA\t1\tG\t7\nC\t2\tT\tNA\n#x\nC\t3\tT\t\n"
    got = tables.read_commented(spark, write("t.tsv", text), ["ref", "pos", "alt", "gbcnt"])
    assert got.count() == 4
    last = tables.last_per_key(got, ["ref", "pos", "alt"], ["gbcnt"], "ord").drop("ord")
    assert rows(last, "pos") == [("A", "1", "G", "7"), ("C", "2", "T", None), ("C", "3", "T", None)]
    with pytest.raises(ValueError, match="missing columns"):
        tables.read_commented(spark, write("u.tsv", "ref\tpos\nA\t1\n"), ["ref", "pos", "alt", "gbcnt"])


@pytest.mark.parametrize("text", ["Sample_ID\tCATEGORY\na\tProband\nb\tcontrol\n", "x,category,ID\n1,PROBAND,a\n1,control,b\n"])
def test_disease_metadata(spark, write, text):
    meta = tables.read_disease_metadata(spark, write("meta.txt", text))
    assert rows(A.probands(meta)) == [("a",)]


def test_disease_metadata_without_columns(spark, write):
    with pytest.raises(ValueError):
        tables.read_disease_metadata(spark, write("meta.txt", "a\tb\n1\t2\n"))


VCF = ("##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tX\n"
       "chrM\t10\t.\tA\tG\t.\tPASS\tDP=5;MMQ=60,59;TLOD=7.5\tGT:AD:AF:DP\t0/1:1,2:0.25:40\n"
       "chrM\t11\t.\tC\tT\t.\t.\tMMQ=60\tGT:DP\t0/1:.\n"
       "chrM\t12\t.\tC\tT\t.\tweak_evidence;possible_numt\tTLOD=1\tGT:AF\t0/1\n")


def test_typed_calls(spark, write, tmp_path):
    path = write("v/S9.merged.final.split.vcf", VCF)
    got = rows(calls.read_calls(spark, str(tmp_path / "v")), "pos")
    assert got[0] == ("S9", "chrM", 10, ["A", "G"], [], 40, [0.25], [60.0, 59.0], [7.5])
    assert got[1] == ("S9", "chrM", 11, ["C", "T"], None, None, None, [60.0], None)
    assert got[2] == ("S9", "chrM", 12, ["C", "T"], ["weak_evidence", "possible_numt"], None, None, None, [1.0])
    named = calls.read_calls(spark, path, spark.createDataFrame([("n", path)], "s string, path string"))
    assert {r["s"] for r in named.collect()} == {"n"}


def test_annotated_records(spark, write):
    records, samples = calls.read_annotated(spark, write("a_vep.vcf", VCF))
    assert rows(samples.select("idx", "SampleID")) == [(0, "X")] and records.count() == 3
    assert calls.read_meta(spark, write("a_vep.vcf", VCF)) == ["##fileformat=VCFv4.2"]
    with pytest.raises(ValueError, match="no record"):
        calls.read_annotated(spark, write("e.vcf", VCF.split("chrM")[0]))
    with pytest.raises(ValueError, match="no header"):
        calls.read_annotated(spark, write("h.vcf", "##x\n"))


def test_bed(spark, write):
    assert rows(reports.read_bed(spark, write("b.bed", "chrM\t300 301\nbad\nchrM  5  9 name\n")), "start") == [
        ("chrM", 5, 9), ("chrM", 300, 301)]


def report(second="Contamination"):
    head = ["SampleID", second, "c3", "c4", "c5", "HgMajor", "c7", "HgMinor", *[f"c{i}" for i in range(9, 14)],
            "MeanHetLevelMajor", "MeanHetLevelMinor"]
    body = ["S1", "YES", "", "", "", "H1", "", "L2", "", "", "", "", "", "0.9", "0.1"]
    return "\n".join("\t".join(f'"{c}"' for c in line) for line in (head, body)) + "\n"


def test_contamination_report(spark, write, tmp_path):
    assert rows(reports.read_contamination(spark, write("r/one.txt", report()))) == [("S1", "YES", "H1", "L2", 0.9, 0.1)]
    with pytest.raises(ValueError, match="Bad contamination"):
        reports.read_contamination(spark, write("bad.txt", report("Other")))
    with pytest.raises(ValueError, match="one header"):
        reports.read_contamination(spark, write("bare.txt", report().split("\n")[1] + "\n"))
    both = reports.read_report_columns(spark, str(tmp_path / "r/*.txt"), {"SampleID": "Sample_ID", "HgMajor": "Full_Haplogroup"})
    assert rows(both) == [("S1", "H1")]
    none = reports.read_report_columns(spark, str(tmp_path / "none/*.txt"), {"SampleID": "Sample_ID"})
    assert none.columns == ["Sample_ID"] and none.count() == 0


METRICS = ("## htsjdk.samtools.metrics.StringHeader\n# tool\n\n## METRICS CLASS\tpicard.analysis.CollectWgsMetrics$WgsMetrics\n"
           "GENOME_TERRITORY\tMEAN_COVERAGE\tSD\tMEDIAN_COVERAGE\n100\t30.5\t2\t31\n\n## HISTOGRAM\tint\ncoverage\tn\n0\t5\n")


def test_coverage_metrics(spark, write, tmp_path):
    write("m/S1.wgs.txt", METRICS)
    write("m/S2.x.txt", METRICS.replace("30.5", "?").split("## HIST")[0])
    assert rows(reports.read_coverage_metrics(spark, str(tmp_path / "m")), "s") == [("S1", 31.0, 30.5), ("S2", 31.0, None)]
    with pytest.raises(Exception, match="no coverage metrics"):
        reports.read_coverage_metrics(spark, write("bad.txt", "nothing\n")).collect()


def test_resource_files(spark, write):
    paths = {
        "gnomad": write("g.tsv", "ref\tposition\talt\tmax_observed_heteroplasmy\tAF_hom\tAF_het\nA\t10\tG\t0.5\t0.1\tNA\n"),
        "mitomap_dis": write("d.tsv", "ref\tpos\talt\tstatus\thomoplasmy\theteroplasmy\tdisease\nA\t10\tG\tCfrm\t+\t\tLHON\n"),
        "apogee": write("ap.tsv", "Ref\tStart\tAlt\tAPOGEE1\tAPOGEE2\nA\t10\tG\tN\tNA\n"),
        "hmtvar": write("h.tsv", 'REF\tPOS\tALT\tHmtVar\nA\t10\tG\t{"pathogenicity": "likely"}\nC\t11\tT\t{bad\n'
                                  'T\t9\tC\t"{""pathogenicity"": ""quoted""}"\n'),
        "mitotip": write("t.tsv", "rCRS\tPosition\tAlt\tQuartile\nA\t10\tG\tQ1\nC\t11\tT\tQ9\n"),
        "helix": write("x.tsv", 'locus\talleles\tAF_hom\tAF_het\tmax_ARF\nchrM:10\t["A","G"]\t\t0.2\t0.7\n'
                                'chrM:11\t["C","T","A"]\t0.1\t0.2\t0.7\n'),
        "clinvar": write("c.tsv", "GRCh38Location\tCanonical SPDI\tGermline classification\n10\tN:9:A:G\t\n"
                                  "11\tN:10:C:T\tConflicting interpretations of pathogenicity\n12\tN:11:CA:C\tBenign\n"),
        "haplo": write("v.tsv", "Variant\tAssoc_haplogroups\nA10G\tH1,L2\n"),
    }
    table = read_resources(spark, paths)
    keys = spark.createDataFrame([("A", "10", "G", "l2"), ("C", "11", "T", "L2"), ("T", "9", "C", None)],
                                 "REF string, POS string, ALT string, Haplogroup string")
    out = {r["POS"]: r for r in A.annotated(keys, table).collect()}
    hit, partly, miss = out["10"], out["11"], out["9"]
    assert (hit["gnomad_max_hl"], hit["gnomad_af_hom"], hit["gnomad_af_het"]) == ("0.5", 0.1, None)
    assert (hit["mitomap_plasmy"], hit["mitomap_disease"], hit["apogee_class"]) == ("+/", "LHON", "N/")
    assert (hit["hmtvar_class"], hit["mitotip_class"], hit["clinvar_interp"]) == ("likely", "likely pathogenic", None)
    assert (hit["helix_max_hl"], hit["helix_af_hom"], hit["Haplogroup_Var_Status"]) == (0.7, 0.0, "haplo_var_match")
    assert (partly["hmtvar_class"], partly["mitotip_class"], partly["clinvar_interp"]) == ("", "", "")
    assert miss["hmtvar_class"] == "quoted"
    assert (miss["gnomad_max_hl"], miss["helix_max_hl"], miss["mitomap_af"]) == ("0", 0.0, 0.0)
    assert (miss["apogee_class"], miss["mitomap_plasmy"], miss["Haplogroup_Var_Status"]) == ("", "", "not_haplo_var")


def test_many_single_sample_files(spark, write, tmp_path):
    write("many/a_vep.vcf", VCF)
    write("many/b_vep.vcf", VCF.replace("FORMAT\tX", "FORMAT\tY").replace("0.25", "0.75"))
    records, samples = calls.read_annotated(spark, str(tmp_path / "many"))
    long = A.format_by_tag(A.long_records(records, samples, per_file=True))
    got = {(r["SampleID"], r["POS"]): r["Heteroplasmy"] for r in long.collect()}
    assert len(got) == 6 and (got[("X", "10")], got[("Y", "10")]) == (0.25, 0.75)


def test_a_file_a_sample_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.createDataFrame([(f"S{i}", f"{i}\t1") for i in range(40)], "s string, value string").coalesce(1)
    path = registry_files._by_sample(rows, str(tmp_path / "files"))
    found = [re.search(r"/s=(S\d+)/part-(\d+)-", f).groups() for f in glob.glob(f"{path}/s=*/part-*")]
    assert sorted(s for s, _ in found) == sorted(f"S{i}" for i in range(40))
    assert len({task for _, task in found}) > 3
    assert sorted(r["value"] for r in spark.read.text(f"{path}/s=*/part-*").collect()) == sorted(f"{i}\t1" for i in range(40))


def test_names_of_a_cohort_are_broadcast_whatever_its_size(spark, write):
    head = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ta\tb\n"
    path = write("wide.vcf", "##x\n" + head + "".join(f"MT\t{p}\t.\tA\tG\t.\tPASS\t.\tDP:HL\t.:.\t{p}:0.5\n" for p in range(1, 9)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        long = A.format_by_tag(A.long_records(*calls.read_annotated(spark, path)))
        got = [(r["POS"], r["SampleID"], r["DP"], r["Heteroplasmy"]) for r in long.collect()]
        plan = long._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(got) == sorted([(str(p), "a", None, None) for p in range(1, 9)] + [(str(p), "b", str(p), 0.5) for p in range(1, 9)])
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_cells_of_dots_and_near_dots(spark):
    data = [("GT:DP", ".:."), ("GT:DP", "."), ("GT:DP", "..:"), ("GT:DP", ".:"), ("GT:DP", ""), ("GT:DP", ":."), ("GT:DP", None), (None, ".:."),
            ("GT:DP", ".:.."), ("GT:DP:HL", ".:.:0.5"), ("GT:AD:DP", ":".join("." * 80))]
    got = A.format_by_tag(spark.createDataFrame(data, "FORMAT string, SAMPLE_DATA string"))
    assert [(r["GT"], r["DP"], r["Heteroplasmy"]) for r in got.collect()] == [
        (None, None, None), (None, None, None), ("..", "", None), (None, "", None), ("", None, None), ("", None, None), (None, None, None),
        (None, None, None), (None, "..", None), (None, None, 0.5), (None, None, None)]

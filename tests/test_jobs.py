import glob
import gzip
import os

import pytest
from pyspark.sql import functions as F

from chondria import schema
from chondria.plans import cohort, lists, quality
from chondria.sinks import tables as sinks
from chondria.sinks.vcf import proband_lines, write_vcf
from chondria.sources import calls as call_files, tables

HEAD = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tx\n"


def text_of(path):
    out = []
    for part in sorted(glob.glob(f"{path}/part-*")):
        opened = gzip.open(part, "rt") if part.endswith(".gz") else open(part)
        with opened as f:
            out += f.read().splitlines()
    return out


@pytest.fixture
def cohort_files(write):
    def call(pos, ref, alt, flt, af, dp):
        return f"chrM\t{pos}\t.\t{ref}\t{alt}\t.\t{flt}\tMMQ=60,50;TLOD=9.5\tGT:AD:AF:DP\t0/1:1,2:{af}:{dp}\n"
    paths = {
        "A": write("calls/A.final.split.vcf", HEAD + call(10, "A", "G", "PASS", 0.5, 300) + call(300, "AC", "A", "FAIL", 0.2, 90)),
        "B": write("calls/B.final.split.vcf", HEAD + call(10, "A", "G", "strand_bias;FAIL", 1, 500)),
        "C": write("calls/C.final.split.vcf", HEAD + call(20, "C", "T", "PASS", 0.9, 800)),
    }
    cov = {"A": {10: 300, 20: 150, 300: 90}, "B": {10: 500, 20: 40, 300: 101}, "C": {10: 100, 20: 800}}
    for s, depth in cov.items():
        write(f"cov/{s}.per_base_coverage.tsv", "chrom\tpos\ttarget\tcoverage\n" + "".join(
            f"chrM\t{p}\tt\t{d}\n" for p, d in depth.items()))
    root = paths["A"].rsplit("/calls/", 1)[0]
    write("calls.list", "".join(f"{s}\t{p}\n" for s, p in paths.items()))
    write("cov.list", "".join(f"{s}\t{root}/cov/{s}.per_base_coverage.tsv\n" for s in cov) + "gone\t/no/such.tsv\n")
    write("sites.bed", "chrM\t300\t301\n")
    return root


def test_coverage_and_combine_jobs(spark, cohort_files):
    root = cohort_files
    sites = cohort.coverage_job(spark, f"{root}/cov", f"{root}/cov.list", f"{root}/out")
    assert [tuple(r) for r in sites.orderBy("pos").collect()] == [
        (10, 300.0, 300, 0.5, 0.0), (20, 330.0, 150, 0.5, 0.0), (300, 95.5, 95, 0.25, 0.0)]
    assert text_of(f"{root}/out/coverage_sample_level") == [
        "pos\tA\tB\tC\tgone", "10\t300\t500\t100\tNA", "20\t150\t40\t800\tNA", "300\t90\t101\tNA\tNA"]
    assert text_of(f"{root}/out/coverage_sites_tsv")[0] == "pos\tmean\tmedian\tover_100\tover_1000"
    coverage = sinks.read_matrix(spark, f"{root}/out/coverage_matrix")
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        sinks.write_matrix(coverage, f"{root}/out/coverage_matrix")

    cells = cohort.combine_job(spark, f"{root}/calls", f"{root}/calls.list", coverage, f"{root}/sites.bed", f"{root}/vcf")
    got = {(r["s"], r["pos"]): (r["HL"], r["DP"], r["FT"]) for r in cells.collect()}
    assert got == {
        ("A", 10): (0.5, 300, ["PASS"]), ("A", 300): (0.2, 90, ["PASS"]), ("A", 20): (0.0, 150, ["PASS"]),
        ("B", 10): (1.0, 500, ["strand_bias"]), ("B", 20): (None, None, None), ("B", 300): (0.0, 101, ["PASS"]),
        ("C", 10): (None, None, None), ("C", 20): (0.9, 800, ["PASS"])}
    lines = text_of(f"{root}/vcf/combined_vcf")
    assert lines[:len(schema.VCF_META)] == schema.VCF_META
    assert lines[len(schema.VCF_META)].split("\t")[8:] == ["FORMAT", "A", "B", "C"]
    assert lines[len(schema.VCF_META) + 1:] == [
        "MT\t10\t.\tA\tG\t.\tPASS\t.\tDP:HL:MQ:TLOD:FT\t300:0.5:50.0:9.5:PASS\t500:1.0:50.0:9.5:strand_bias\t.:.:.:.:.",
        "MT\t20\t.\tC\tT\t.\tPASS\t.\tDP:HL:MQ:TLOD:FT\t150:0.0:.:.:PASS\t.:.:.:.:.\t800:0.9:50.0:9.5:PASS",
        "MT\t300\t.\tAC\tA\t.\tartifact_prone_site\t.\tDP:HL:MQ:TLOD:FT\t90:0.2:50.0:9.5:PASS\t101:0.0:.:.:PASS\t.:.:.:.:."]

    # The cohort VCF can be read back and cut down to probands.
    records, samples = call_files.read_annotated(spark, f"{root}/vcf/combined_vcf")
    ids = spark.createDataFrame([("C",), ("none",)], "s string")
    lines, kept = proband_lines(records, samples, ids)
    write_vcf(lines, kept, f"{root}/probands", call_files.read_meta(spark, f"{root}/vcf/combined_vcf"), compression=None)
    out = text_of(f"{root}/probands")
    assert out[0] == schema.VCF_META[0] and out[len(schema.VCF_META)].endswith("FORMAT\tC")
    assert [x.split("\t")[1] for x in out[len(schema.VCF_META) + 1:]] == ["20"]       # where the level is above 0
    by_text, _ = proband_lines(records, samples, ids, by_level=False)
    assert sorted(r["pos"] for r in by_text.collect()) == [10, 20, 300]
    with pytest.raises(ValueError, match="no proband"):
        proband_lines(records, samples, ids.filter("s = 'none'"))


def changed(root):
    """Times of the data files below ``root``."""
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{root}/**/part-*", recursive=True)}


def test_reruns(spark, cohort_files):
    root = cohort_files

    def coverage(**options):
        return cohort.coverage_job(spark, f"{root}/cov", f"{root}/cov.list", f"{root}/out", **options)

    def combine():
        stored = cohort.stored_coverage(spark, f"{root}/out")
        return cohort.combine_job(spark, f"{root}/calls", f"{root}/calls.list", stored, f"{root}/sites.bed", f"{root}/vcf")
    want = coverage().collect()
    assert combine().count() == 8
    before = changed(f"{root}/out") | changed(f"{root}/vcf")
    assert coverage().collect() == want and combine().count() == 8
    assert changed(f"{root}/out") | changed(f"{root}/vcf") == before                  # whole and unchanged: all kept

    # Cut off between stages and inside one: the marker of the end is missing.
    for name in ("vcf/matrix", "out/coverage_sites"):
        os.rename(f"{root}/{name}.done", f"{root}/{name.replace('/', '_')}.lost")
    assert coverage().collect() == want and combine().count() == 8
    again = changed(f"{root}/out") | changed(f"{root}/vcf")
    anew = {p.rsplit("/part-", 1)[0].split(f"{root}/")[1].split("/bucket")[0] for p in set(again) - set(before)}
    assert {p for p in anew if not p.endswith((".started", ".done"))} == {"vcf/matrix", "out/coverage_sites"}

    # A longer manifest makes every result of it stale.
    with open(f"{root}/cov.list", "a") as f:
        f.write(f"D\t{root}/cov/D.per_base_coverage.tsv\n")
    with open(f"{root}/cov/D.per_base_coverage.tsv", "w") as f:
        f.write("chrom\tpos\ttarget\tcoverage\nchrM\t10\tt\t1700\n")
    assert coverage().filter("pos = 10").first()["over_1000"] == 0.2
    assert text_of(f"{root}/out/coverage_sample_level")[0] == "pos\tA\tB\tC\tgone\tD"
    assert coverage(overwrite=True).count() == 3

    # A folder that is none of the job's own is not replaced.
    spark.range(1).write.parquet(f"{root}/other/samples")
    with pytest.raises(FileExistsError):
        cohort.coverage_job(spark, f"{root}/cov", f"{root}/cov.list", f"{root}/other")


def test_quality_job(spark, write, tmp_path):
    from test_sources import METRICS, report
    write("m/S1.wgs.txt", METRICS.replace("30.5", "4").replace("\t31\n", "\t5\n"))
    coverage = spark.createDataFrame([("S1", 1, 400), ("S1", 2, 600)], "s string, pos int, coverage int")
    table = quality.quality_job(spark, coverage, str(tmp_path / "m"), write("r/S1.txt", report()), str(tmp_path / "qc"))
    row = table.first()
    assert (row["mtCN_final"], row["mtCN_mean_mean"], round(row["Contamination"], 6), row["Pass_Filter"]) == (200.0, 250.0, 0.1, False)
    assert text_of(tmp_path / "qc/haplogroup_full") == ["Sample_ID\tFull_Haplogroup", "S1\tH1"]
    assert text_of(tmp_path / "qc/contamination") == ["Sample_ID\tContamination_Status", "S1\tYES"]
    assert text_of(tmp_path / "qc/mtCN_summary")[1].startswith("S1\t500.0\t500.0\t4.0\t5.0")
    clean = quality.quality_job(spark, coverage, str(tmp_path / "m"), None, str(tmp_path / "qc2"))
    assert clean.first()["Pass_Filter"] is True


VEP = ("##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tP1\tP10\n"
       "chrM\t10\t.\tA\tG\t.\tPASS\tCSQ=G|missense_variant|MODERATE|MT-ND1\tGT:AD:AF:DP\t0/1:1,2:0.3:100\t0/0:1,0:0:90\n"
       "chrM\t11\t.\tC\tT\t.\t.\tCSQ=T|synonymous_variant|LOW|MT-ND1\tGT:AD:AF:DP\t0/1:1,2:0.3:100\t0/1:1,0:0.4:90\n"
       "chrM\t12\t.\tC\tT\t.\tweak_evidence\tCSQ=T|stop_gained|HIGH|MT-ND1\tGT:AD:AF:DP\t0/1:1,2:0.3:100\t0/1:1,0:0.4:90\n")


def test_list_jobs(spark, write, tmp_path):
    from chondria.operators import annotate as A
    records, samples = call_files.read_annotated(spark, write("v/c_vep.vcf", VEP))
    rows = A.long_records(records, samples)
    gnomad = tables.read_commented(spark, write("g.tsv", "ref\tposition\talt\tmax_observed_heteroplasmy\tAF_hom\tAF_het\nA\t10\tG\t0.5\t0.001\t0\n"),
                                   ["ref", "position", "alt", "max_observed_heteroplasmy", "AF_hom", "AF_het"])
    table = [A.gnomad(gnomad)]
    pre = lists.cohort_prefilter(rows, table)
    final = lists.final_list(pre, disease_first=True)
    assert pre.columns == schema.COHORT_LIST and pre.count() == 4
    assert [(r["SampleID"], r["POS"], r["in_cohort_AC"], r["Freq"], r["gnomad_af_hom"]) for r in final.collect()] == [("P1", "10", 1, 2, 0.001)]
    written = lists.lists_job(pre, str(tmp_path / "out"), proband_mode=True, disease_first=True)
    assert written.collect() == final.collect()
    assert all("/Proband_prefilter/" in f for f in written.inputFiles())              # annotated once: the final plan reads the written rows
    assert lists.cohort_prefilter(rows, A.merged_resources(*table)).collect() == pre.collect()
    assert text_of(tmp_path / "out/Proband_variant_list")[0].split("\t") == schema.COHORT_LIST
    assert len(text_of(tmp_path / "out/Proband_variant_list_prefiltering")) >= 5
    ids = spark.createDataFrame([("P1",)], "s string")
    assert {r[0] for r in lists.cohort_prefilter(rows, table, ids).select("SampleID").collect()} == {"P1"}
    assert lists.cohort_prefilter(rows, table, ids, prefix=True).count() == 4
    assert lists.cohort_prefilter(rows, table, carriers_only=True).count() == 3

    groups = spark.createDataFrame([("P1", "H1"), ("P10", "L2")], "s string, haplogroup string")
    status = spark.createDataFrame([("P10", "yes")], "s string, contamination string")
    meta = spark.createDataFrame([("p1", "proband")], "s string, category string")
    pre = lists.single_prefilter(rows, table, groups, status, meta)
    final = lists.final_list(pre)
    assert pre.columns == schema.SINGLE_LIST
    assert {(r["SAMPLE_ID"], r["POS"], r["Haplogroup"], r["Freq"]) for r in pre.collect()} == {("P1", "10", "H1", 0), ("P1", "11", "H1", 0)}
    assert [r["POS"] for r in final.collect()] == ["10"]
    by_position = lists.single_prefilter(rows, table, groups, positional=True)
    assert by_position.filter("POS = '10' and SAMPLE_ID = 'P1'").first()["Heteroplasmy"] == 0.3


def test_small_sinks(spark, tmp_path):
    ids = spark.createDataFrame([("b",), ("a",), ("b",)], "s string")
    sinks.write_probands(ids, str(tmp_path / "p"))
    assert text_of(tmp_path / "p") == ["a", "b"]
    sinks.write_tsv(spark.createDataFrame([(1, None, "")], "a int, b string, c string"), str(tmp_path / "t"))
    assert set(text_of(tmp_path / "t")) == {"a\tb\tc", "1\t\t"}
    sinks.write_documents(spark.createDataFrame([("{}\n{}",)], "value string"), str(tmp_path / "d"))
    assert text_of(tmp_path / "d") == ["{}", "{}"]
    wide = sinks.pivoted_coverage(spark.createDataFrame([(1, "a", 5)], "pos int, s string, coverage int"), ["a", "b"])
    assert wide.columns == ["pos", "a", "b"] and tuple(wide.first()) == (1, 5, None)
    sinks.write_matrix(spark.createDataFrame([("a", 1, 2)], "s string, pos int, coverage int"), str(tmp_path / "m"))
    assert sinks.read_matrix(spark, str(tmp_path / "m")).columns == ["s", "pos", "coverage"]

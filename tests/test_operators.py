import pytest
from pyspark.sql import functions as F

from chondria.operators import annotate as A, blocks, calls as L, copynumber as N, documents as D, joins, matrix as M
from chondria.operators import reads as R, sheet as S, templates


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# --- joins that stay even ------------------------------------------------------------------------------

@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_shuffled_lookup_equals_broadcast(spark, how):
    left = spark.range(2000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"), "id")
    right = spark.range(0, 40, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    small = rows(joins.lookup_join(left, right, ["k"], how))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = rows(joins.lookup_join(left, right, ["k"], how))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(str, small)) == sorted(map(str, large))


def test_numbering_of_a_hot_key(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5)).alias("k"),
                                  (F.col("id") * 3).alias("at"))
    got = joins.number_within(df, ["k"], "at", "n", width=64)
    by_key = {}
    for r in got.orderBy("at").collect():
        assert r["n"] == by_key.get(r["k"], 0)
        by_key[r["k"]] = r["n"] + 1


def test_positions(spark):
    df = spark.createDataFrame([(1, 5, 9), (2, 9, 5), (3, 0, 0)], "k int, a int, b int")
    assert rows(joins.positions(df, "a", "b", ["k"], width=3), "k", "pos") == [(1, p) for p in range(5, 10)] + [(3, 0)]


# --- matrix ------------------------------------------------------------------------------------------------

def test_repeated_cell_is_an_error(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 1, 6)], "s string, pos int, coverage int")
    with pytest.raises(Exception, match="cell occurs twice"):
        M.unique_cells(df, ["s", "pos"]).collect()


def test_locus_off_the_contig(spark):
    df = spark.createDataFrame([(16569,), (None,)], "pos int")
    assert rows(df.select(*M.as_mt(F.col("pos")))) == [("MT", 16569), ("MT", None)]
    with pytest.raises(Exception, match="off the contig"):
        spark.createDataFrame([(16570,)], "pos int").select(*M.as_mt(F.col("pos"))).collect()


def test_site_coverage(spark):
    df = spark.createDataFrame([(1, 100), (1, 101), (1, 1001), (1, None), (2, None)], "pos int, coverage int")
    assert rows(M.site_coverage(df, F.lit(4)), "pos") == [(1, 1202 / 3, 101, 0.5, 0.25), (2, None, None, 0.0, 0.0)]
    even = spark.createDataFrame([(1, 100), (1, 101)], "pos int, coverage int")
    assert even.transform(lambda d: M.site_coverage(d, F.lit(2))).first()["median"] == 100
    assert even.transform(lambda d: M.site_coverage(d, F.lit(2), exact=True)).first()["median"] == 100.5


def test_filters(spark):
    df = spark.createDataFrame([(["FAIL"],), (["strand_bias", "FAIL", "base_qual"],), ([],), (None,)], "f array<string>")
    assert rows(df.select(M.cleaned_filters(F.col("f")))) == [(["PASS"],), (["base_qual", "strand_bias"],), (["PASS"],), (None,)]


CALL = "s string, pos int, ref string, alt string, DP int, HL double, MQ double, TLOD double, FT array<string>"


def test_hom_refs(spark):
    calls = spark.createDataFrame([
        ("a", 1, "A", "G", 50, 0.5, 1.0, 1.0, ["PASS"]), ("b", 1, "A", "T", 50, None, 1.0, 1.0, ["x"]),
        ("c", 1, "A", "G", 50, None, 1.0, 1.0, ["x"])], CALL)
    cov = spark.createDataFrame([("a", 1, 900), ("b", 1, 101), ("d", 1, 100), ("e", 1, None), ("a", 2, 500)],
                                "s string, pos int, coverage int")
    got = {(r["s"], r["alt"]): (r["HL"], r["DP"], r["FT"]) for r in M.resolve_hom_refs(calls, cov).collect()}
    assert got[("a", "G")] == (0.5, 50, ["PASS"])            # called: coverage is not used
    assert got[("a", "T")] == (0.0, 900, ["PASS"])           # reference
    assert got[("b", "T")] == (0.0, 101, ["PASS"])           # call without a level, deep enough
    assert got[("c", "G")] == (None, None, None)             # no level and no coverage
    assert got[("d", "G")] == (None, None, None)             # at the threshold: no call
    assert got[("e", "T")] == (None, None, None)
    assert len(got) == 9 and not any(k[0] == "a" and v[1] == 500 for k, v in got.items())
    states = M.state_counts(M.resolve_hom_refs(calls, cov), F.lit(5))
    assert rows(states, "alt") == [(1, "A", "G", 1, 1, 3), (1, "A", "T", 0, 2, 3)]


def test_resolved_cells_equal_the_dense_matrix(spark):
    calls = spark.createDataFrame([("a", 1, "A", "G", 50, 0.5, 1.0, 1.0, ["PASS"]), ("b", 2, "C", "T", 9, 0.1, 1.0, 1.0, ["x"])], CALL)
    cov = spark.createDataFrame([("b", 1, 500), ("c", 2, 20)], "s string, pos int, coverage int")
    samples = spark.createDataFrame([("a",), ("b",), ("c",)], "s string")
    dense = blocks.densify(calls, calls, samples, block=2)
    assert dense.count() == 2 * 3
    full = dense.join(cov, ["s", "pos"], "left").select("s", *M.SITE, "MQ", "TLOD", *M.resolved(
        F.col("HL"), F.col("DP"), F.col("FT"), F.col("coverage"), 100))
    sparse = {(r["s"], r["pos"]): r for r in M.resolve_hom_refs(calls, cov).collect()}
    for r in full.collect():
        other = sparse.get((r["s"], r["pos"]))
        assert (r["HL"], r["DP"], r["FT"]) == ((other["HL"], other["DP"], other["FT"]) if other else (None, None, None))


def test_localize_in_blocks(spark):
    df = spark.createDataFrame([(1, "A", "G", i, i * 10) for i in (5, 0, 3, 4)], "pos int, ref string, alt string, sample_idx long, DP int")
    blocks = M.localize(df, ["DP"], block=4)
    assert [(r["block"], [tuple(e) for e in r["entries"]]) for r in blocks.orderBy("block").collect()] == [
        (0, [(0, 0), (3, 30)]), (1, [(4, 40), (5, 50)])]
    assert rows(M.unlocalize(blocks), "sample_idx") == rows(df, "sample_idx")


def test_artifact_sites(spark):
    sites = spark.createDataFrame([("MT", 299, "AC", "A"), ("MT", 301, "A", "G"), ("MT", 302, "A", "G"), ("MT", 305, "AAA", "A")],
                                  "contig string, pos int, ref string, alt string")
    bed = spark.createDataFrame([("MT", 300, 301), ("MT", 306, 307), ("X", 301, 302)], "contig string, start int, end int")
    got = rows(M.flag_artifacts(sites, bed).select("pos", "filters"), "pos")
    assert got == [(299, ["PASS"]), (301, ["artifact_prone_site"]), (302, ["PASS"]), (305, ["artifact_prone_site"])]


# --- calls ------------------------------------------------------------------------------------------------------

def test_rotation(spark):
    moved = spark.range(8025, 9145).select(L.shifted_back(F.col("id")).alias("p"))
    assert sorted(r["p"] for r in moved.collect()) == list(range(1, 576)) + list(range(16025, 16570))
    rejects = L.lift_back(spark.createDataFrame([(30000,), (None,), (8569,), (8570,)], "pos int"))
    assert rows(rejects[0], "pos") == [(1,), (16569,)] and rejects[1].count() == 2


def test_stitch(spark):
    cov = "pos int, coverage int"
    got = L.stitch_coverage(spark.createDataFrame([(8000, 1)], cov), spark.createDataFrame([(16569, 2), (8025, 3), (8570, 4)], cov))
    assert rows(got, "pos") == [(1, 4), (8000, 1), (16025, 3)]


def test_contamination(spark):
    df = spark.createDataFrame([("YES", 0.0, 0.3, None), ("YES", 0.9, 0.3, 0.5), ("NO", 0.9, 0.3, 0.4), (None, 0.9, 0.3, None)],
                               "st string, major double, minor double, ext double")
    level = L.contamination(F.col("st"), F.col("major"), F.col("minor"))
    got = df.select(F.round(level, 6), F.round(L.applied_contamination(level, F.col("ext")), 6)).collect()
    assert [tuple(r) for r in got] == [(0.3, 0.3), (0.1, 0.5), (0.0, 0.4), (0.0, 0.0)]


def test_hard_filters_and_mask(spark):
    df = spark.createDataFrame([("MT", 10, "A", ["G"], [0.001], None), ("MT", 20, "ACG", list("ACGTN"), [0.5, None, 0.0, 0.0, 0.0], ["x"])],
                               "contig string, pos int, ref string, alts array<string>, AF array<double>, filters array<string>")
    assert [r["filters"] for r in L.hard_filters(df).orderBy("pos").collect()] == [["low_allele_frac"], ["x", "multiallelic"]]
    mask = spark.createDataFrame([("MT", 21, 22)], "contig string, start int, end int")
    assert [r["filters"] for r in L.mask_sites(df, mask).orderBy("pos").collect()] == [None, ["x", "blacklisted_site"]]


def test_split_alleles(spark):
    df = spark.createDataFrame([(1, ["G", "T"], [0.1], [5, 6, 7], 9)], "pos int, alts array<string>, AF array<double>, AD array<int>, AC int")
    got = L.split_alleles(df, ("AF",), ("AD",)).select("pos", "alt", "AF", "AD", "AC")
    assert rows(got, "alt") == [(1, "G", 0.1, [5, 6], 9), (1, "T", None, [5, 7], 9)]


# --- quality and sheet --------------------------------------------------------------------------------------------

def test_copy_number(spark):
    cov = spark.createDataFrame([("a", "100"), ("a", "300"), ("a", "x"), ("b", "50"), ("c", "500")], "s string, coverage string")
    nuclear = spark.createDataFrame([("a", 2.0, 4.0), ("b", 0.0, float("nan")), ("c", 10.0, 10.0)], "s string, nuc_mean double, nuc_median double")
    got = {r["Sample_ID"]: r for r in N.copy_number(N.mt_coverage(cov), nuclear).collect()}
    assert (got["a"]["mtCN_mean_mean"], got["a"]["mtCN_final"], got["a"]["Pass_Filter"]) == (200.0, 100.0, True)
    assert (got["b"]["mtCN_mean_mean"], got["b"]["mtCN_final"], got["b"]["Pass_Filter"]) == (None, None, False)
    assert got["c"]["Pass_Filter"] is True
    dirty = spark.createDataFrame([("a", 0.03), ("c", 0.02)], "s string, contamination double")
    flags = {r["Sample_ID"]: r["Pass_Filter"] for r in N.copy_number(N.mt_coverage(cov), nuclear, dirty).collect()}
    assert flags == {"a": False, "b": False, "c": True}


def test_pass_flag(spark):
    df = spark.createDataFrame([("True", True), (" PASS ", True), ("1", True), ("y", True), ("no", False), ("", False), (None, False)],
                               "v string, want boolean")
    assert all(r[0] == r[1] for r in df.select("want", S.passed(F.col("v"))).collect())
    assert [S.pass_column([n]) for n in ("Pass_Filter", "pass filter", "PASS", "PassFilter", "passed")] == [
        "Pass_Filter", "pass filter", "PASS", "PassFilter", None]


def test_gate_drops_and_reports(spark):
    data = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "s string, pos int")
    qc = spark.createDataFrame([("a", "yes"), ("b", "no")], "s string, pass string")
    kept, failed = S.gate(data, qc)
    assert rows(kept) == [("a", 1)] and rows(failed) == [("b", "no")]
    assert rows(S.gate(data, qc.withColumnRenamed("pass", "x"))[0]) == [("a", 1)]      # one column: the verdict
    assert rows(S.gate(data, qc.withColumnsRenamed({"pass": "x"}).withColumn("y", F.lit(1)))[0]) == []


def test_sheet_groups(spark):
    data = [("a", "1.fq.gz", "2"), ("a", "3.fastq.gz", None), ("b", "x.cram", None), ("c", "x.bam", None), ("c", "y.bam", None),
            ("d", "x.bam", None), ("d", "y.cram", "i"), ("e", "x.txt", None), ("f", "x.cram", "x.crai"), (" ", "x.bam", None), ("g", "", None)]
    sheet = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "row_no long, id string, file1 string, file2 string")
    typed = S.with_file_type(S.valid_rows(sheet))
    assert {r["id"]: r["problem"] for r in S.sample_groups(typed).collect()} == {
        "a": None, "b": "missing index", "c": "more than one file", "d": "mixed file types", "e": "unknown file type", "f": None}
    assert {r["id"] for r in S.usable_rows(typed).collect()} == {"a", "f"}
    assert rows(S.file_pairs(S.split_by_type(typed)["FASTQ"]), "pair_id") == [("a", 0, "1.fq.gz", "2"), ("a", 1, "3.fastq.gz", None)]
    merge, single = S.branch(S.sample_groups(typed))
    assert {r["id"] for r in merge.collect()} == {"a", "c", "d"} and single.count() == 3


def test_sample_ids_keep_names_that_look_like_a_header(spark):
    sheet = spark.createDataFrame([("Sample", "file1"), ("Sample1", "a.bam"), ("b", "b.bam"), ("b", "c.bam")], "id string, file1 string")
    assert rows(S.sample_ids(sheet)) == [("Sample1",), ("b",)]
    assert S.rows_of_sample(sheet, "b").count() == 2


# --- reads -----------------------------------------------------------------------------------------------------------

def brute_depth(blocks, first, last):
    return {p: sum(a <= p <= b for a, b in blocks) for p in range(first, last + 1)}


@pytest.mark.parametrize("width", [4, 16, 4096])
def test_depth(spark, width):
    blocks = [(1, 10), (5, 12), (5, 5), (30, 29), (18, 60)]
    data = spark.createDataFrame([("a", "m", *b) for b in blocks] + [("b", "m", 3, 3)], "s string, contig string, start int, end int")
    targets = spark.createDataFrame([("m", 4, 20), ("m", 50, 62)], "contig string, start int, end int")
    got = {(r["s"], r["pos"]): r["depth"] for r in R.per_base_depth(data, targets, cap=2, width=width).collect()}
    want = {p: min(d, 2) for a, b in ((4, 20), (50, 62)) for p, d in brute_depth(blocks, a, b).items()}
    assert {p: d for (s, p), d in got.items() if s == "a"} == want
    assert len(got) == 2 * len(want) and all(d == 0 for (s, _), d in got.items() if s == "b")


def test_runs_of_good_bases(spark):
    reads = spark.createDataFrame([("a", "m", 5, 30, [30, 9, 30, 30, None, 20]), ("b", "m", 5, 10, [30]), ("c", "m", 5, 30, []),
                                   ("d", "m", 5, 30, None), ("e", "m", 1, 20, [20, 20])],
                                  "s string, contig string, start int, mapq int, quals array<int>")
    assert rows(R.good_bases(reads), "s", "start") == [("a", "m", 5, 5), ("a", "m", 7, 8), ("a", "m", 10, 10), ("e", "m", 1, 2)]


def test_site_states_equal_the_resolved_matrix(spark):
    kinds = "s string, pos int, ref string, alt string, DP int, HL double, MQ double, TLOD double, FT array<string>"
    calls = spark.createDataFrame([("a", 1, "A", "G", 50, 0.5, 1.0, 1.0, ["PASS"]), ("b", 1, "A", "G", 50, None, 1.0, 1.0, None),
                                   ("c", 1, "A", "G", 50, 0.0, 1.0, 1.0, None), ("a", 1, "A", "T", 9, 0.1, 1.0, 1.0, None),
                                   ("d", 2, "C", "T", 9, None, 1.0, 1.0, None)], kinds)
    coverage = spark.createDataFrame([("a", 1, 500), ("b", 1, 101), ("c", 1, 100), ("e", 1, 900), ("f", 1, None), ("e", 3, 7)],
                                     "s string, pos int, coverage int")
    n = F.lit(8)
    want = M.state_counts(M.resolve_hom_refs(calls, coverage), n)
    assert rows(M.site_states(calls, coverage, n), *M.SITE) == rows(want, *M.SITE)


def test_duplicates(spark):
    schema = "qname string, library string, contig string, five_prime int, strand int, mate_five_prime int, mate_strand int, sum_qual int"
    data = [("r1", "l", "m", 1, 0, None, 0, 5), ("r2", "l", "m", 1, 0, None, 0, 9), ("r0", "l", "m", 1, 0, None, 0, 9), ("r3", "l", "m", 2, 0, 4, 0, 1)]
    marked = templates.mark_duplicates(spark.createDataFrame(data, schema))
    assert {r["qname"]: r["is_duplicate"] for r in marked.collect()} == {"r0": False, "r1": True, "r2": True, "r3": False}
    assert rows(R.duplicate_metrics(marked)) == [("l", 4, 2, 0.5)]


def test_duplicates_of_pairs(spark):
    schema = "qname string, library string, contig string, five_prime int, strand int, mate_five_prime int, mate_strand int, sum_qual int"
    pairs = [(name, "l", "m", a, s, b, 1 - s, q) for name, q in (("r1", 5), ("r2", 9)) for a, s, b in ((1, 0, 80), (80, 1, 1))]
    unmapped = [(f"u{i}", "l", None, None, None, None, None, i) for i in range(3)]
    marked = templates.mark_duplicates(spark.createDataFrame(pairs + unmapped, schema)).collect()
    assert sorted((r["qname"], r["is_duplicate"]) for r in marked) == [("r1", True)] * 2 + [("r2", False)] * 2 + [(f"u{i}", False) for i in range(3)]


# --- lists ---------------------------------------------------------------------------------------------------------------

def test_present(spark):
    cases = {"": False, ".": False, "0/0:5": False, "0|0": False, "./.:.": False, "0/1:3": True, "1|1": True, "0.3:5": True, ".:.": True}
    df = spark.createDataFrame(list(cases.items()) + [(None, False)], "v string, want boolean")
    assert all(r[0] == r[1] for r in df.select("want", A.present(F.col("v"))).collect())


def test_proband_match(spark):
    data = spark.createDataFrame([("P1",), ("P10",), ("P1_rep:x",), ("Q",)], "SampleID string")
    ids = spark.createDataFrame([("P1",)], "s string")
    assert rows(A.of_probands(data, ids, "SampleID")) == [("P1",)]
    assert {r[0] for r in A.of_probands(data, ids, "SampleID", prefix=True).collect()} == {"P1", "P10", "P1_rep:x"}


def test_candidates_and_missing_values(spark):
    base = dict(SampleID="a", POS="1", REF="A", ALT="G", gnomad_af_hom=0.0, helix_af_hom=0.0, mitomap_af=0.0, mitomap_disease="",
                Consequence="missense_variant", Freq=1, Heteroplasmy=0.5, clinvar_interp="")
    changes = [({}, True), ({"gnomad_af_hom": 0.01}, False), ({"gnomad_af_hom": None}, False), ({"Consequence": None}, True),
               ({"Consequence": "synonymous_variant"}, False), ({"Consequence": "synonymous_variant&x"}, True), ({"Freq": 100}, False),
               ({"Freq": None}, True), ({"Heteroplasmy": 0.05}, False), ({"Heteroplasmy": None}, False), ({"clinvar_interp": "Benign"}, False),
               ({"clinvar_interp": "Benign/Likely benign"}, True), ({"clinvar_interp": None}, True)]
    kinds = ("SampleID string, POS string, REF string, ALT string, gnomad_af_hom double, helix_af_hom double, mitomap_af double, "
             "mitomap_disease string, Consequence string, Freq int, Heteroplasmy double, clinvar_interp string")
    data = spark.createDataFrame([tuple({**base, **c, "POS": str(i)}.values()) for i, (c, _) in enumerate(changes)], kinds)
    kept = {int(r["POS"]) for r in A.keep_candidates(data).collect()}
    assert kept == {i for i, (_, keep) in enumerate(changes) if keep}


def test_list_order(spark):
    data = spark.createDataFrame([("a", "2", "A", "G", 0.001, ""), ("a", "1", "A", "G", None, ""), ("b", "2", "A", "G", 0.001, ""),
                                  ("a", "3", "A", "G", 0.002, "LHON")], "SampleID string, POS string, REF string, ALT string, gnomad_af_hom double, mitomap_disease string")
    data = data.withColumns({"helix_af_hom": F.lit(0.0), "mitomap_af": F.lit(0.0)})
    order = [(r["POS"], r["SampleID"]) for r in data.orderBy(*A.list_order(data, True)).collect()]
    assert order == [("3", "a"), ("2", "a"), ("2", "b"), ("1", "a")]
    order = [(r["POS"], r["SampleID"]) for r in data.orderBy(*A.list_order(data, False)).collect()]
    assert order == [("2", "a"), ("2", "b"), ("3", "a"), ("1", "a")]


def test_counts_of_carriers_and_rows(spark):
    data = spark.createDataFrame([("a", "1", "A", "G", 0.5), ("b", "1", "A", "G", 0.0), ("b", "2", "A", "G", None)],
                                 "SampleID string, POS string, REF string, ALT string, Heteroplasmy double")
    got = A.cohort_counts(data).select("variant_key", "SampleID", "in_cohort_AC", "Freq")
    assert rows(got, "variant_key", "SampleID") == [("1:A:G", "a", 1, 1), ("1:A:G", "b", 1, 0), ("2:A:G", "b", 0, 0)]
    every = A.cohort_counts(data, count_all_rows=True).select("variant_key", "SampleID", "in_cohort_AC", "Freq")
    assert rows(every, "variant_key", "SampleID") == [("1:A:G", "a", 2, 1), ("1:A:G", "b", 2, 2), ("2:A:G", "b", 1, 2)]


def test_layout_by_tag_and_by_position(spark):
    data = spark.createDataFrame([("GT:DP:HL", "0/1:7:0.3"), ("GT:AD:AF:DP:X", "0/1:1,2:0.4:8:q:r"), ("DP", ".")], "FORMAT string, SAMPLE_DATA string")
    cols = ("GT", "AD", "DP", "Heteroplasmy")
    assert [tuple(r[c] for c in cols) for r in A.format_by_tag(data).collect()] == [
        ("0/1", None, "7", 0.3), ("0/1", "1,2", "8", 0.4), (None, None, None, None)]
    assert tuple(A.format_by_position(data).collect()[1][c] for c in cols) == ("0/1", "1,2", "8.0", 0.4)


def test_consequence_is_read_by_name(spark):
    data = spark.createDataFrame([("CSQ=A|missense_variant|HIGH,A|x|LOW",), ("AS=1|2;CSQ=G|stop_gained;DP=3",), ("DP=1",), (None,)], "INFO string")
    got = A.consequence_fields(data, ["Allele", "Consequence", "IMPACT", "SYMBOL"]).drop("INFO")
    assert rows(got) == [("A", "missense_variant", "HIGH", None), ("G", "stop_gained", None, None), (None,) * 4, (None,) * 4]


# --- documents ---------------------------------------------------------------------------------------------------------------

@pytest.fixture
def docs(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, name string, tag string")
    new = spark.createDataFrame([(2, None, 5), (3, "c", 6)], "id int, name string, n int")
    return old, new


def test_document_operations(docs):
    assert rows(D.apply_documents(*docs, "id", "index"), "id") == [(1, "a", "x", None), (2, None, None, 5), (3, "c", None, 6)]
    assert rows(D.apply_documents(*docs, "id", "upsert"), "id") == [(1, "a", "x", None), (2, None, "y", 5), (3, "c", None, 6)]
    assert rows(D.apply_documents(*docs, "id", "update", ignore_errors=True), "id") == [(1, "a", "x", None), (2, None, "y", 5)]
    assert rows(D.apply_documents(*docs, "id", "create", ignore_errors=True), "id") == [(1, "a", "x", None), (2, "b", "y", None), (3, "c", None, 6)]


def test_document_errors(spark, docs):
    with pytest.raises(Exception, match="document 2 exists"):
        D.apply_documents(*docs, "id", "create").collect()
    with pytest.raises(Exception, match="document 3 does not exist"):
        D.apply_documents(*docs, "id", "update").collect()
    with pytest.raises(ValueError, match="unknown write operation"):
        D.apply_documents(*docs, "id", "delete")
    with pytest.raises(NotImplementedError):
        D.bulk_lines(spark.sql("select 1 as id, map('a', 1) as m"), "i")
    with pytest.raises(NotImplementedError):
        D.bulk_lines(spark.sql("select 1 as id, array(struct(date'2020-01-01' as d)) as m"), "i")


def test_bulk_lines(docs):
    old = docs[0].withColumnRenamed("tag", "_t.g")
    assert rows(D.bulk_lines(old, "v", "id"), "value")[0] == ('{"index":{"_index":"v","_id":"1"}}\n{"id":1,"name":"a","$_t_g":"x"}',)
    assert rows(D.bulk_lines(docs[1], "v", "id", "update"), "value")[0][0].endswith('{"doc":{"id":2,"name":null,"n":5}}')
    assert rows(D.bulk_lines(docs[1], "v"), "value")[0][0].startswith('{"index":{"_index":"v"}}\n')


def test_last_row_of_a_repeated_sample(spark):
    calls = spark.createDataFrame([("S1", 1), ("S2", 1)], "SampleID string, POS int")
    groups = spark.createDataFrame([("S1", "H9"), ("S2", "K"), ("S1", "A1")], "s string, haplogroup string").coalesce(1)
    assert {r["SampleID"]: r["Haplogroup"] for r in A.with_haplogroup(calls, groups, "SampleID").collect()} == {"S1": "A1", "S2": "K"}


def test_no_proband_is_an_error(spark):
    with pytest.raises(ValueError, match="no proband"):
        A.probands(spark.createDataFrame([("S1", "control")], "s string, category string"))


def test_cohort_counts_of_missing_keys(spark):
    """Missing keys find no count, empty ones do; alleles that hold the separator share the count of their key; resources come with the counts."""
    data = spark.createDataFrame([("a", "1", "A", "G", 0.5), (None, "1", "A", "G", 0.5), ("", None, "A", "G", 0.5), ("", "", "A", "G", 0.5), ("a", "2", "A:C", "G", 0.5), ("b", "2", "A", "C:G", 0.5)],
                                 "SampleID string, POS string, REF string, ALT string, Heteroplasmy double")
    table = spark.createDataFrame([("A", "1", "G", "x"), (None, None, None, "y"), ("A", None, "G", "z")], "ref string, pos string, alt string, t string").withColumn("gnomad", F.struct("t")).drop("t")
    got = A.cohort_counts(data, resources=table)
    values = sorted((r["SampleID"], r["POS"], r["REF"], r["variant_key"], r["in_cohort_AC"], r["Freq"], r["gnomad"] and r["gnomad"]["t"]) for r in got.fillna("-", ["SampleID", "POS"]).collect())
    assert {v[3:] for v in values} == {("1:A:G", 2, 2, "x"), ("1:A:G", 2, None, "x"), (None, None, 2, None), (":A:G", 1, 2, None), ("2:A:C:G", 2, 2, None), ("2:A:C:G", 2, 1, None)}


def test_cohort_rows_are_made_and_shuffled_once(spark):
    """The counts share the exchange that the rows come from, and the rows meet counts and resources in one join by variant."""
    rows = spark.range(4000).selectExpr("concat('s', id % 7) SampleID", "cast(id % 90 as string) POS", "'A' REF", "'G' ALT", "id % 3 / 10.0D Heteroplasmy", "id").groupBy(
        "SampleID", "POS", "REF", "ALT").agg(F.max("Heteroplasmy").alias("Heteroplasmy"))
    table = spark.range(90).selectExpr("'A' ref", "cast(id as string) pos", "'G' alt", "struct(id as t) gnomad").groupBy("ref", "pos", "alt").agg(F.first("gnomad").alias("gnomad"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = A.cohort_counts(rows, resources=table)
        assert len(out.collect()) == rows.count()
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("ReusedExchange") == 2

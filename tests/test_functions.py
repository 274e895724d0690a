from hypothesis import given, settings, strategies as st
import pytest
from pyspark.sql import functions as F

from chondria.functions.cells import known_cells
from chondria.functions import consequence as C, lof, names, variant as V
from chondria.functions.casts import if_known, number, text_or_null

TRANSCRIPT = "gene_id string, lof string, lof_flags string, lof_info string"
CASES = {
    "all_lc_lof": [("foo", "LC", ""), ("foo", "NC", ""), ("bar", "LC", ""), ("baz", "", ""), ("baz", "LC", "")],
    "some_lc_lof": [("foo", "LC", ""), ("foo", "", ""), ("bar", "LC", ""), ("baz", "HC", ""), ("baz", "LC", "")],
    "all_flags": [("foo", "HC", "flag1"), ("foo", "HC", "flag2"), ("bar", "LC", "flag1"), ("baz", "HC", "flag2"),
                  ("baz", "", "")],
    "some_flags": [("foo", "HC", "flag1"), ("foo", "HC", ""), ("bar", "", "flag1"), ("bar", "LC", "flag1"),
                   ("baz", "HC", "flag2"), ("baz", "HC", "flag3")],
    "empty": [],
    "unknown": [("foo", None, None)],
}


@pytest.fixture(scope="module")
def flags(spark):
    rows = [(name, [(*t, "") for t in case]) for name, case in CASES.items()] + [("null", None)]
    df = spark.createDataFrame(rows, f"name string, t array<struct<{TRANSCRIPT.replace(' ', ':')}>>".replace(",:", ","))
    t = F.col("t")
    out = df.select("name", lof.variant_low_confidence(t).alias("low"), lof.low_confidence_genes(t).alias("low_genes"),
                    lof.variant_flagged(t).alias("flagged"), lof.flagged_genes(t).alias("flagged_genes"))
    return {r["name"]: r for r in out.collect()}


def test_variant_flags(flags):
    assert flags["all_lc_lof"]["low"] is True and flags["some_lc_lof"]["low"] is False
    assert flags["all_flags"]["flagged"] is True and flags["some_flags"]["flagged"] is False
    assert flags["empty"]["low"] is False and flags["unknown"]["flagged"] is False
    assert flags["null"]["low"] is None


def test_gene_sets(flags):
    assert flags["all_lc_lof"]["low_genes"] == ["bar", "baz", "foo"]
    assert flags["some_lc_lof"]["low_genes"] == ["bar", "foo"]
    assert flags["all_flags"]["flagged_genes"] == ["bar", "baz", "foo"]
    assert flags["some_flags"]["flagged_genes"] == ["bar", "baz"]
    assert flags["unknown"]["low_genes"] == []


def test_transcript_flags(spark):
    rows = [("LC", "", True, False), ("HC", "foo", False, True), ("", "bar", False, False), ("", "", False, False),
            (None, None, False, False)]
    df = spark.createDataFrame(rows, "lof string, flags string, low boolean, flagged boolean")
    for r in df.select("*", lof.transcript_low_confidence(F.col("lof")).alias("x"),
                       lof.transcript_flagged(F.col("lof"), F.col("flags")).alias("y")).collect():
        assert (r["x"], r["y"]) == (r["low"], r["flagged"])


def test_xpos(spark):
    rows = [("1", 55505463, 1055505463), ("X", 18525192, 23018525192), ("chr2", 166847734, 2166847734),
            ("chrM", 5, 25000000005), ("MT", 5, 25000000005), ("chrY", 1, 24000000001), ("weird", 1, None)]
    df = spark.createDataFrame(rows, "c string, p int, x long")
    assert all(r[0] == r[1] for r in df.select("x", V.xpos(F.col("c"), F.col("p"))).collect())


def test_variant_text(spark):
    df = spark.createDataFrame([("chr1", 10, ["AT", "A", "ATT"])], "c string, p int, a array<string>")
    c, p, a = F.col("c"), F.col("p"), F.col("a")
    row = df.select(V.variant_id(c, p, a), V.variant_id(c, p, a, 4), V.variant_ids(c, p, a), V.variant_type(a),
                    V.end_pos(p, a), V.start_pos(p)).first()
    assert list(row) == ["1-10-AT-A", "1-10", ["chr1-10-AT-A", "chr1-10-AT-ATT"], "D", 12, 10]


def test_severity_and_category(spark):
    df = spark.createDataFrame([(t, i) for i, t in enumerate(C.SEVERITY)] + [("odd", None), (None, None)], "t string, r int")
    rows = {r["t"]: r for r in df.select("t", "r", C.severity_rank(F.col("t")).alias("x"),
                                         C.category(C.severity_rank(F.col("t"))).alias("k")).collect()}
    assert all(r["r"] == r["x"] for r in rows.values())
    want = {"frameshift_variant": "lof", "stop_lost": "missense", "missense_variant": "missense",
            "protein_altering_variant": "synonymous", "synonymous_variant": "synonymous", "intron_variant": "other",
            "odd": None, None: None}
    assert {k: rows[k]["k"] for k in want} == want


def test_major_term(spark):
    rows = [(["odd", "intron_variant", "stop_gained"], "stop_gained"), (["odd", "odd2"], "odd"), ([], None), (None, None)]
    df = spark.createDataFrame(rows, "t array<string>, want string")
    assert all(r[0] == r[1] for r in df.select("want", C.major_term(F.col("t"))).collect())


def test_hgvs(spark):
    rows = [("E:c.1A>G", None, "missense_variant", "K/N", "c.1A>G"),
            ("E:c.1A>G", "P:p.K1N", "splice_donor_variant", "K/N", "c.1A>G"),
            ("E:c.1A>G", "P:p.K1N", "missense_variant", "K/N", "p.K1N"),
            ("E:c.1A>G", "P:p.Met1%3D", "synonymous_variant", "M", "p.Met7Met"),
            ("E:c.1A>G", "P:p.(=)", "synonymous_variant", "*", "p.Ter7Ter"),
            ("E:c.1A>G", "P:p.(=)", "synonymous_variant", "MM", None)]
    df = spark.createDataFrame(rows, "c string, p string, m string, a string, want string")
    got = df.select("want", C.formatted_hgvs(F.col("c"), F.col("p"), F.col("m"), F.col("a"), F.lit(7)))
    assert all(r[0] == r[1] for r in got.collect())


VEP = ("struct<biotype:string,canonical:int,cdna_start:int,cdna_end:int,codons:string,gene_id:string,gene_symbol:string,"
       "hgvsc:string,hgvsp:string,transcript_id:string,amino_acids:string,lof:string,lof_filter:string,lof_flags:string,"
       "lof_info:string,polyphen_prediction:string,protein_id:string,protein_start:int,sift_prediction:string,"
       "consequence_terms:array<string>,domains:array<struct<db:string,name:string>>>")


def transcript(tid, terms, biotype="protein_coding", canonical=None, gene="g1", domains=None):
    return (biotype, canonical, 1, 2, "a/b", gene, gene, "E:c.1", "P:p.1", tid, "K", "", None, "", "", None, None, 3, None,
            terms, domains)


def test_ranking(spark):
    rows = [transcript("t1", ["intron_variant"], "lincRNA"), transcript("t2", ["missense_variant"]),
            transcript("t3", ["missense_variant"], canonical=1, domains=[("Pfam", "b"), ("Pfam", "a"), ("Pfam", "b")]),
            transcript("t4", ["upstream_gene_variant"]), transcript("t5", ["intron_variant", "upstream_gene_variant"]),
            transcript("t6", ["missense_variant"], biotype=None, gene="g2"), transcript("t7", ["intron_variant"], "lincRNA")]
    df = spark.createDataFrame([("v", rows), ("w", []), ("x", None)], f"id string, t array<{VEP}>")
    df = df.withColumn("r", C.ranked_transcripts(F.col("t"), F.lit("missense_variant")))
    out = {r["id"]: r for r in df.select(
        "id", "r", C.worst_transcript(F.col("r")).alias("worst"), C.transcript_ids(F.col("r")).alias("ids"),
        C.gene_consequence_json(F.col("r"), C.gene_ids(F.col("r"))).alias("genes"),
        C.protein_domains_of_ranked(F.col("r")).alias("domains")).collect()}
    ranked = out["v"]["r"]
    assert [t["transcript_id"] for t in ranked] == ["t3", "t2", "t5", "t6", "t1", "t7"]
    assert [t["transcript_rank"] for t in ranked] == list(range(6))
    assert ranked[2]["consequence_terms"] == ["intron_variant"]
    assert out["v"]["worst"]["domains"] == "Pfam:a,Pfam:b" and out["v"]["worst"]["transcript_id"] == "t3"
    assert out["v"]["genes"] == '{"g1":"missense_variant","g2":"missense_variant"}'
    assert out["v"]["domains"] == ["Pfam:a", "Pfam:b"]
    assert out["w"]["worst"]["gene_id"] is None and out["w"]["genes"] == "{}"
    assert out["x"]["worst"] is None
    plain = df.select(C.ranked_transcripts(F.col("t"), F.lit("x"), coding=False).alias("r"))
    fields = [f.name for f in plain.schema["r"].dataType.elementType]
    assert "domains" not in fields and "hgvsp" not in fields and "lof" not in fields and "hgvs" in fields
    assert C.worst_transcript is not None
    worst = plain.select(C.worst_transcript(F.col("r"), coding=False).alias("w")).schema["w"].dataType
    assert [f.name for f in worst] == list(C.WORST_FIELDS)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a_$.-+,#*()[]{}dot", max_size=12))
def test_name_codec_is_reversible(name):
    assert names.decode_name(names.encode_name(name)) == name


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a.b", "_c", "d#"])
    assert names.encode_columns(df).columns == ["a_b", "$_c", "d_$hash$_"]
    coded = names.encode_columns(df, dot=None)
    assert coded.columns[0] == "a_$dot$_b" and names.decode_columns(coded).columns == df.columns


def test_text_codec_equals_name_codec(spark):
    words = ["a.b", "$x", "_$dot$_", "", "-", "$$..", "_$$dot$$_", "a$.b", "+[]{}"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    code = names.encoded_text(F.col("w"))
    for r in df.select("w", code.alias("c"), names.decoded_text(code).alias("b")).collect():
        assert r["c"] == names.encode_name(r["w"]) and r["b"] == r["w"]


def test_missing_values(spark):
    rows = [("1.5", 1.5), ("NaN", None), ("x", None), ("", None), (None, None)]
    df = spark.createDataFrame(rows, "t string, want double")
    assert all(r[0] == r[1] for r in df.select("want", number(F.col("t"))).collect())
    na = spark.createDataFrame([("NA",), ("",), ("null",), ("0",)], "t string").select(text_or_null(F.col("t"))).collect()
    assert [r[0] for r in na] == [None, None, None, "0"]
    cond = spark.createDataFrame([(True,), (False,), (None,)], "c boolean")
    assert [r[0] for r in cond.select(if_known(F.col("c"), F.lit(1), F.lit(2))).collect()] == [1, 2, None]


def test_known_cells(spark):
    """Cells of a text are those of the text split whole: runs of empty cells, marks in the text, cells that go on after an empty one's text."""
    e = ".:.:."
    texts = [e, "", None, "\t".join([e] * 300), "\t".join([e] * 16 + ["1:2:x"] + [e] * 15), "\t".join(["1:2:x"] * 2000), "\t".join([e] * 40 + [e + "y"] + [e] * 40 + ["", ".", "z"]),
             "\t".join([e] * 40 + ["a\x01"] + [e] * 40 + ["\x02"]), "\t".join(["5:.:."] + [e] * 1000 + ["6:.:."] + [e] * 33 + ["é:.:."])]
    rows = spark.createDataFrame([(t, f) for t in texts for f in ("DP:HL:FT", "X", "", None)], "text string, layout string")
    got = rows.select("text", "layout", known_cells(F.col("text"), F.col("layout")).alias("got")).collect()
    for r in got:
        empty = None if r["layout"] is None else ":".join("." if n else "" for n in r["layout"].split(":"))
        want = None if r["text"] is None else [(i, c) for i, c in enumerate(r["text"].split("\t")) if c != empty]
        assert (r["got"] and [tuple(x) for x in r["got"]]) == want or r["got"] == want == []

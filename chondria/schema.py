"""Fixed schemas, column lists and thresholds shared by the operators."""

from pyspark.sql import types as T

CONTIG_LENGTH = 16569          # bases of chrM
MITOMAP_GENOMES = 61134.0      # denominator of the MITOMAP allele frequency
BLOCK = 256                    # samples per tile of a localised matrix

SHEET = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("file1", T.StringType()),
    T.StructField("file2", T.StringType()),
])

MANIFEST = T.StructType([
    T.StructField("s", T.StringType()),
    T.StructField("path", T.StringType()),
])

COVERAGE = T.StructType([
    T.StructField("chrom", T.StringType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("target", T.StringType()),
    T.StructField("coverage", T.IntegerType()),
])

# --- fixed values: must equal the source data formats ---------------------------------------

# Tokens that a string table reader treats as missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Sub-fields of one VEP consequence in the text form.
CSQ_FIELDS = [
    "Allele", "Consequence", "IMPACT", "SYMBOL", "Gene", "Feature_type", "Feature", "BIOTYPE", "EXON",
    "INTRON", "HGVSc", "HGVSp", "cDNA_position", "CDS_position", "Protein_position", "Amino_acids",
    "Codons", "Existing_variation", "DISTANCE", "STRAND", "FLAGS", "VARIANT_CLASS", "SYMBOL_SOURCE",
    "HGNC_ID", "HGVS_OFFSET",
]

# Filter names that exclude a record from the variant lists.
HARD_FILTERS = "base_qual|strand_bias|weak_evidence|blacklisted_site|contamination|position"

# Sample-level filter names with low performance, removed when samples are combined.
LOW_VALUE_FILTERS = ["possible_numt", "mt_many_low_hets", "FAIL", "blacklisted_site"]

MITOTIP_LABELS = {
    "Q1": "likely pathogenic",
    "Q2": "possibly pathogenic",
    "Q3": "possibly benign",
    "Q4": "likely benign",
}

CONFLICTING = "Conflicting interpretations of pathogenicity"
BENIGN = ["Benign", "Likely benign"]
PASS_WORDS = ["true", "pass", "1", "yes", "y"]
SAMPLE_COLUMNS = ["sample", "sample_id", "id", "sampleid"]

# Columns shared by both variant lists, in output order.
CONSEQUENCE_COLUMNS = ["Consequence", "SYMBOL", "BIOTYPE", "HGVSc", "HGVSp", "Codons", "VARIANT_CLASS"]
RESOURCE_COLUMNS = [
    "gnomad_max_hl", "gnomad_af_hom", "gnomad_af_het", "apogee_class", "mitotip_class", "hmtvar_class",
    "helix_max_hl", "helix_af_hom", "helix_af_het", "mitomap_gbcnt", "mitomap_af", "mitomap_status",
    "mitomap_plasmy", "mitomap_disease", "clinvar_interp",
]
SINGLE_LIST = (
    ["SAMPLE_ID", "CHROM", "POS", "REF", "ALT", "FILTER", "GT", "AD", "Heteroplasmy", "DP"]
    + CONSEQUENCE_COLUMNS + ["Haplogroup", "Haplogroup_Var_Status"] + RESOURCE_COLUMNS + ["Freq"]
)
COHORT_LIST = (
    ["SampleID", "variant_key", "CHROM", "POS", "REF", "ALT", "FILTER", "GT", "AD", "Heteroplasmy", "DP"]
    + CONSEQUENCE_COLUMNS + RESOURCE_COLUMNS + ["in_cohort_AC", "Freq"]
)

# Meta lines of the combined VCF.
VCF_META = [
    '##fileformat=VCFv4.2',
    '##FILTER=<ID=artifact_prone_site,Description="Variant overlaps an artifact_prone_site">',
    '##FORMAT=<ID=DP,Number=1,Type=Integer,Description="Depth of coverage">',
    '##FORMAT=<ID=HL,Number=1,Type=Float,Description="Heteroplasmy level">',
    '##FORMAT=<ID=MQ,Number=1,Type=Float,Description="Mapping quality">',
    '##FORMAT=<ID=TLOD,Number=1,Type=Float,Description="Log 10 likelihood ratio score of variant '
    'existing versus not existing">',
    '##FORMAT=<ID=FT,Number=.,Type=String,Description="Sample-level filters">',
    '##contig=<ID=MT,length=16569>',
]
VCF_FIXED = ["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT"]

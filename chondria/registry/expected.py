"""Constants of the check SQL, written out so that a slip in the checked code does not reach its check."""

# Fixed values.
SEVERITY = [
    "transcript_ablation", "splice_acceptor_variant", "splice_donor_variant", "stop_gained",
    "frameshift_variant", "stop_lost", "start_lost", "initiator_codon_variant",
    "transcript_amplification", "inframe_insertion", "inframe_deletion", "missense_variant",
    "protein_altering_variant", "splice_region_variant", "incomplete_terminal_codon_variant",
    "start_retained_variant", "stop_retained_variant", "synonymous_variant",
    "coding_sequence_variant", "mature_miRNA_variant", "5_prime_UTR_variant", "3_prime_UTR_variant",
    "non_coding_transcript_exon_variant", "non_coding_exon_variant", "intron_variant",
    "NMD_transcript_variant", "non_coding_transcript_variant", "nc_transcript_variant",
    "upstream_gene_variant", "downstream_gene_variant", "TFBS_ablation", "TFBS_amplification",
    "TF_binding_site_variant", "regulatory_region_ablation", "regulatory_region_amplification",
    "feature_elongation", "regulatory_region_variant", "feature_truncation", "intergenic_variant",
]
OMITTED_TERMS = ["upstream_gene_variant", "downstream_gene_variant"]
SPLICE_TERMS = ["splice_donor_variant", "splice_acceptor_variant", "splice_region_variant"]
AMINO_ACIDS = {
    "A": "Ala", "C": "Cys", "D": "Asp", "E": "Glu", "F": "Phe", "G": "Gly", "H": "His", "I": "Ile",
    "K": "Lys", "L": "Leu", "M": "Met", "N": "Asn", "P": "Pro", "Q": "Gln", "R": "Arg", "S": "Ser",
    "T": "Thr", "V": "Val", "W": "Trp", "Y": "Tyr", "X": "Ter", "*": "Ter", "U": "Sec",
}
SPECIAL = {
    ".": "_$dot$_", ",": "_$comma$_", "#": "_$hash$_", "*": "_$star$_", "(": "_$lp$_", ")": "_$rp$_",
    "[": "_$lsb$_", "]": "_$rsb$_", "{": "_$lcb$_", "}": "_$rcb$_",
}
CSQ_FIELDS = [
    "Allele", "Consequence", "IMPACT", "SYMBOL", "Gene", "Feature_type", "Feature", "BIOTYPE", "EXON",
    "INTRON", "HGVSc", "HGVSp", "cDNA_position", "CDS_position", "Protein_position", "Amino_acids",
    "Codons", "Existing_variation", "DISTANCE", "STRAND", "FLAGS", "VARIANT_CLASS", "SYMBOL_SOURCE",
    "HGNC_ID", "HGVS_OFFSET",
]
HARD_FILTERS = "base_qual|strand_bias|weak_evidence|blacklisted_site|contamination|position"
CONFLICTING = "Conflicting interpretations of pathogenicity"
CONSEQUENCE_COLUMNS = ["Consequence", "SYMBOL", "BIOTYPE", "HGVSc", "HGVSp", "Codons", "VARIANT_CLASS"]
RESOURCE_COLUMNS = [
    "gnomad_max_hl", "gnomad_af_hom", "gnomad_af_het", "apogee_class", "mitotip_class", "hmtvar_class",
    "helix_max_hl", "helix_af_hom", "helix_af_het", "mitomap_gbcnt", "mitomap_af", "mitomap_status",
    "mitomap_plasmy", "mitomap_disease", "clinvar_interp",
]

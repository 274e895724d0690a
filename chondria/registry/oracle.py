"""Check SQL, one statement per registered query, over the same derived inputs."""

from chondria.registry import expected
from chondria.registry.expected import AMINO_ACIDS, OMITTED_TERMS, SEVERITY, SPECIAL, SPLICE_TERMS
from chondria.registry.inputs import SQL
from chondria.registry.queries import FAMILIES, MAX_FREQ, TARGETS

ORACLE: dict[str, str] = {}
LENGTH = 16569


def texts(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


# Shared steps; each may use the derived inputs and the steps before it.
STEPS = {
    "n": "select count(*) as n from supplier",
    "entries": """
select s, pos, ref, alt, DP, HL, MQ, TLOD,
       case when DP % 17 = 0 then null when flag = 'A' then 'possible_numt' when flag = 'R' then 'strand_bias;FAIL'
            else 'PASS' end as FT from calls""",
    "clean": """
select s, pos, ref, alt, DP, HL, MQ, TLOD,
       case when DP % 17 = 0 then null when flag = 'R' then 'strand_bias' else 'PASS' end as FT from calls""",
    "covered": "select c.s, c.pos, t.ref, t.alt, c.coverage from coverage c join "
               "(select distinct pos, ref, alt from calls) t on c.pos = t.pos",
    "met": """
select coalesce(a.s, b.s) as s, coalesce(a.pos, b.pos) as pos, coalesce(a.ref, b.ref) as ref,
       coalesce(a.alt, b.alt) as alt, MQ, TLOD, HL, FT, case when HL is null then coverage else DP end as d
from clean a full join covered b on a.s = b.s and a.pos = b.pos and a.ref = b.ref and a.alt = b.alt""",
    "cells": """
select s, pos, ref, alt, MQ, TLOD, case when HL is null and d > 100 then 0.0::double else HL end as HL,
       case when HL is null and d <= 100 then null else d end as DP,
       case when HL is null and d is null then null when HL is null and d > 100 then 'PASS' else FT end as FT
from met""",
    "artifact": "select distinct unnest(range(start + 1, \"end\" + 1)) as base from bed",
    "flagged": """
select 'MT' as contig, pos, ref, alt,
       case when exists (select 1 from artifact where base >= pos and base < pos + length(ref))
            then 'artifact_prone_site' else 'PASS' end as filters
from (select distinct pos, ref, alt from calls)""",
    # families
    "fam_clean": """
select s, pos, ref, alt, DP, HL, MQ, TLOD,
       case when DP % 17 = 0 then null when flag = 'R' then 'strand_bias' else 'PASS' end as FT from family_calls""",
    "fam_sites": """
select pos, ref, alt, case when exists (select 1 from artifact where base >= pos and base < pos + length(ref))
                           then 'artifact_prone_site' else 'PASS' end as filters
from (select distinct pos, ref, alt from family_calls)""",
    "fam_grid": """
select t.pos, t.ref, t.alt, t.filters, f.s, f.sample_idx, DP, HL,
       coalesce(DP::varchar, '.') || ':' || coalesce(HL::varchar, '.') || ':' || coalesce(MQ::varchar, '.') || ':' ||
       coalesce(TLOD::varchar, '.') || ':' || coalesce(FT, '.') as cell
from fam_sites t, families f
left join fam_clean c on c.pos = t.pos and c.ref = t.ref and c.alt = t.alt and c.s = f.s""",
    # quality control
    "nuclear": """
select 'S' || s_suppkey as s, floor(s_acctbal) / 800.0::double as nuc_mean,
       case when s_suppkey % 9 = 0 then 0.0::double else floor(s_acctbal) / 800.0::double + 1.0::double end as nuc_median
from supplier""",
    "contam": """
select 'S' || s_suppkey as s,
       case when s_nationkey % 5 <> 0 then 0.0::double when s_nationkey = 5 then 0.015::double
            else 1.0::double - (1.0::double - s_nationkey::double / 100.0::double) end as reported from supplier""",
    "mtcn": """
select m.s as Sample_ID, mt_mean as Mean_mtDNA_Coverage, mt_median as Median_mtDNA_Coverage,
       nuc_mean as Mean_Nuclear_Coverage, nuc_median as Median_Nuclear_Coverage,
       case when nuc_mean > 0 then 2.0::double * mt_mean / nuc_mean end as mtCN_mean_mean,
       case when nuc_median > 0 then 2.0::double * mt_median / nuc_median end as mtCN_median_median,
       case when nuc_median > 0 then 2.0::double * mt_mean / nuc_median end as mtCN_final,
       reported as Contamination,
       coalesce(mt_mean >= 100 and nuc_median > 0 and 2.0::double * mt_mean / nuc_median between 50 and 500
                and reported <= 0.02::double, false) as Pass_Filter
from (select s, avg(coverage) as mt_mean, median(coverage) as mt_median from coverage group by s) m
join nuclear using (s) join contam using (s)""",
    # sample sheet
    "typed": """
select row_no, id, file1, file2,
       case when file1 like '%.fastq.gz' or file1 like '%.fq.gz' then 'FASTQ' when file1 like '%.cram' then 'CRAM'
            when file1 like '%.bam' then 'BAM' else 'UNKNOWN' end as type
from sheet where trim(id) <> '' and file1 <> ''""",
    "grouped": """
select id, min(type) as type, count(*) as n_files,
       case when count(distinct type) > 1 then 'mixed file types' when min(type) = 'UNKNOWN' then 'unknown file type'
            when min(type) in ('CRAM', 'BAM') and count(*) > 1 then 'more than one file'
            when min(type) = 'CRAM' and bool_or(coalesce(trim(file2), '') = '') then 'missing index' end as problem
from typed group by id""",
    # calls
    "wide": """
select s, pos, ref, l_orderkey, l_linenumber, q, flag, (['A', 'CC', 'G', 'TT', 'GA'])[1:l_linenumber % 5 + 1] as alts
from multi""",
    "hard": """
select s, pos, ref, l_orderkey, l_linenumber, q, alts, len(alts)::int as n_alts,
       concat_ws(';', case when flag = 'A' then 'weak_evidence' end,
                 case when q::double / 1000.0::double < 0.01::double then 'low_allele_frac' end,
                 case when len(alts) > 4 then 'multiallelic' end) as filters from wide""",
    # annotation
    "keys": "select s as SampleID, pos::varchar as POS, ref as REF, alt as ALT from calls",
    "g": "select ref, position as pos, alt, arg_max(struct_pack(m := max_observed_heteroplasmy, h := AF_hom, e := AF_het), "
         "ord) as v from gnomad group by all",
    "poly": "select ref, pos, alt, arg_max(struct_pack(c := gbcnt), ord) as v from mitomap_poly group by all",
    "dis": "select ref, pos, alt, arg_max(struct_pack(s := status, h := homoplasmy, e := heteroplasmy, d := disease), ord) "
           "as v from mitomap_dis group by all",
    "apo": "select \"Ref\" as ref, \"Start\" as pos, \"Alt\" as alt, arg_max(struct_pack(a := APOGEE1, b := APOGEE2), ord) "
           "as v from apogee group by all",
    "hmt": """
select "REF" as ref, "POS" as pos, "ALT" as alt, arg_max(struct_pack(
           l := case when json_valid(HmtVar) then json_extract_string(HmtVar, '$.pathogenicity') end), ord) as v
from hmtvar group by all""",
    "tip": """
select rCRS as ref, "Position" as pos, "Alt" as alt, arg_max(struct_pack(l := case Quartile
           when 'Q1' then 'likely pathogenic' when 'Q2' then 'possibly pathogenic' when 'Q3' then 'possibly benign'
           when 'Q4' then 'likely benign' end), ord) as v from mitotip group by all""",
    "hel": """
select split_part(alleles, '"', 2) as ref, split_part(locus, 'chrM:', 2) as pos, split_part(alleles, '"', 4) as alt,
       arg_max(struct_pack(
           m := case when coalesce(try_cast(AF_hom as double), 0) > 0 then 1.0::double
                     else coalesce(try_cast(max_ARF as double), 0.0::double) end,
           h := coalesce(try_cast(AF_hom as double), 0.0::double), e := try_cast(AF_het as double)), ord) as v
from helix where len(alleles) - len(replace(alleles, ',', '')) = 1 group by all""",
    "clin": f"""
select split_part(spdi, ':', 3) as ref, location as pos, split_part(spdi, ':', 4) as alt,
       arg_max(struct_pack(l := label), ord) as v
from clinvar where len(split_part(spdi, ':', 3)) = 1 and len(split_part(spdi, ':', 4)) = 1
  and split_part(spdi, ':', 3) <> split_part(spdi, ':', 4) and label is distinct from '{expected.CONFLICTING}'
group by all""",
    "hap": "select Variant as word, arg_max(lower(Assoc_haplogroups), ord) as groups from haplo group by all",
    "tags": """
select *, string_split(FORMAT, ':') as f, string_split(SAMPLE_DATA, ':') as x from records""",
    "parsed": """
select SampleID, CHROM, POS, REF, ALT, "FILTER", INFO, SAMPLE_DATA,
       nullif(x[list_position(f, 'GT')], '.') as GT, nullif(x[list_position(f, 'AD')], '.') as AD,
       nullif(x[list_position(f, 'DP')], '.') as DP,
       coalesce(try_cast(nullif(x[list_position(f, 'AF')], '.') as double),
                try_cast(nullif(x[list_position(f, 'HL')], '.') as double)) as Heteroplasmy,
       string_split(regexp_extract(INFO, 'CSQ=([^;]*)', 1), '|') as c
from tags""",
    "good": f"""
select * from parsed where "FILTER" is null or not regexp_matches("FILTER", '{expected.HARD_FILTERS}')""",
    "probands": "select s from samples where lower(category) = 'proband'",
}
_FIELD = {n: f"c[{i + 1}] as {n}" for i, n in enumerate(expected.CSQ_FIELDS)}
_POPULATION = {
    "gnomad_max_hl": "case when g.v is null then '0' else g.v.m end",
    "gnomad_af_hom": "try_cast(case when g.v is null then '0' else g.v.h end as double)",
    "gnomad_af_het": "try_cast(case when g.v is null then '0' else g.v.e end as double)",
    "helix_max_hl": "case when hel.v is null then 0.0::double else hel.v.m end",
    "helix_af_hom": "case when hel.v is null then 0.0::double else hel.v.h end",
    "helix_af_het": "case when hel.v is null then 0.0::double else hel.v.e end",
    "mitomap_gbcnt": "case when poly.v is null then '0' else poly.v.c end",
    "mitomap_af": "try_cast(case when poly.v is null then '0' else poly.v.c end as double) / 61134.0::double",
    "clinvar_interp": "case when clin.v is null then '' else clin.v.l end",
    "mitomap_status": "case when dis.v is null then '' else dis.v.s end",
    "mitomap_plasmy": "case when coalesce(dis.v.h, '') = '' and coalesce(dis.v.e, '') = '' then '' "
                      "else coalesce(dis.v.h, '') || '/' || coalesce(dis.v.e, '') end",
    "mitomap_disease": "case when dis.v is null then '' else dis.v.d end",
    "apogee_class": "case when apo.v is null then '' else coalesce(apo.v.a, '') || '/' || coalesce(apo.v.b, '') end",
    "mitotip_class": "coalesce(tip.v.l, '')", "hmtvar_class": "coalesce(hmt.v.l, '')",
}
_JOINS = {"gnomad": "g", "helix": "hel", "mitomap_poly": "poly", "mitomap_dis": "dis", "clinvar": "clin", "apogee": "apo",
          "mitotip": "tip", "hmtvar": "hmt"}


def _join(names) -> str:
    return " ".join(f"left join {_JOINS[n]} on {_JOINS[n]}.ref = k.REF and {_JOINS[n]}.pos = k.POS "
                    f"and {_JOINS[n]}.alt = k.ALT" for n in names)


STATUS = """case when coalesce(hap.groups, '') = '' then 'not_haplo_var'
                  when contains(hap.groups, lower(sm.haplogroup)) then 'haplo_var_match'
                  else 'haplo_var_diff_haplo' end"""
_CONSEQUENCES = ", ".join(_FIELD[n] for n in expected.CONSEQUENCE_COLUMNS)
_RESOURCES = ", ".join(f"{_POPULATION[n]} as {n}" for n in expected.RESOURCE_COLUMNS)
STEPS["single"] = f"""
select k.SampleID as SAMPLE_ID, CHROM, k.POS, k.REF, k.ALT, "FILTER", GT, AD, Heteroplasmy, DP, {_CONSEQUENCES},
       sm.haplogroup as Haplogroup, {STATUS} as Haplogroup_Var_Status, {_RESOURCES}, 0 as Freq
from good k join samples sm on sm.s = k.SampleID {_join(_JOINS)}
left join hap on hap.word = k.REF || k.POS || k.ALT
where upper(sm.contamination) <> 'YES'"""


def _cohort(source: str) -> str:
    return f"""
select k.SampleID, k.POS || ':' || k.REF || ':' || k.ALT as variant_key, CHROM, k.POS, k.REF, k.ALT, "FILTER", GT, AD,
       Heteroplasmy, DP, {_CONSEQUENCES}, {_RESOURCES},
       count(*) filter (Heteroplasmy > 0) over (partition by k.POS, k.REF, k.ALT) as in_cohort_AC,
       count(*) filter (Heteroplasmy > 0) over (partition by k.SampleID) as Freq
from {source} k {_join(_JOINS)}"""


STEPS["good_probands"] = "select good.* from good join probands on s = SampleID"
STEPS["cohort"] = _cohort("good")
STEPS["disease"] = _cohort("good_probands")
KEEP = """gnomad_af_hom < 0.01 and helix_af_hom < 0.01 and mitomap_af < 0.01
  and Consequence is distinct from 'synonymous_variant' and Heteroplasmy > 0.05
  and coalesce(clinvar_interp, '') not in ('Benign', 'Likely benign')"""

# --- transcripts ---------------------------------------------------------------------------------------
_KEY = """case when biotype = 'protein_coding' then 0 else 4 end
     + case when list_contains(kept, (select worst from severe v where v.variant = t.variant)) then 0 else 2 end
     + case when canonical = 1 then 0 else 1 end"""
_AA = "case amino_acids " + " ".join(f"when '{k}' then '{v}'" for k, v in AMINO_ACIDS.items()) + " end"
_RANK = {t: i for i, t in enumerate(SEVERITY)}


def _ranked(omit) -> str:
    return f"""
select *, row_number() over (partition by variant order by {_KEY}, transcript_id) - 1 as place
from (select *, list_filter([term_a, term_b], lambda x: not list_contains({texts(omit)}, x)) as kept,
             case when a <= b then term_a else term_b end as major, least(a, b) as major_rank from named) t
where len(kept) > 0"""


STEPS["tr"] = "select * from transcripts"
STEPS["named"] = f"select *, ({texts(SEVERITY)})[a + 1] as term_a, ({texts(SEVERITY)})[b + 1] as term_b from tr"
STEPS["severe"] = f"select variant, ({texts(SEVERITY)})[min(least(a, b)) + 1] as worst from tr group by variant"
STEPS["ranked"] = _ranked(OMITTED_TERMS)
STEPS["ranked_nc"] = _ranked(["intergenic_variant", "intron_variant"])
_CATEGORY = f"""case when major_rank <= {_RANK['frameshift_variant']} then 'lof'
     when major_rank <= {_RANK['missense_variant']} then 'missense'
     when major_rank <= {_RANK['synonymous_variant']} then 'synonymous' else 'other' end"""
_HGVS = f"""case when hgvsp is null or list_contains({texts(SPLICE_TERMS)}, major) then split_part(hgvsc, ':', 2)
     when contains(hgvsp, '%3D') then 'p.' || ({_AA}) || protein_start || ({_AA})
     else split_part(hgvsp, ':', 2) end"""

# --- reads ------------------------------------------------------------------------------------------------
_TARGETS = " union all ".join(f"select '{c}' as contig, unnest(range({a}, {b + 1})) as pos" for c, a, b in TARGETS)
# Ends and pairs of ends as texts; the order of two ends is any fixed one.
STEPS["ends"] = """
select library, qname, sum_qual, contig || ':' || five_prime || ':' || strand as e,
       mate_contig || ':' || mate_five_prime || ':' || mate_strand as m from mates where is_primary and five_prime is not null"""
STEPS["tpl"] = """
select library, qname, case when n > 1 or m is null then e0 else least(e0, m) end as a,
       case when n > 1 then e1 when m is not null then greatest(e0, m) end as b, score
from (select library, qname, min(e) as e0, max(e) as e1, min(m) as m, count(*) as n, sum(sum_qual) as score from ends group by library, qname)"""
STEPS["verdict"] = """
select t.*, row_number() over (partition by library, a, b order by score desc, qname) > 1
            or b is null and (library, a) in (select (library, unnest([a, b])) from tpl where b is not null) as d from tpl t"""
STEPS["dup"] = """
select m.*, coalesce(v.d, false) as is_duplicate from mates m left join verdict v on m.library = v.library and m.qname = v.qname"""
STEPS["points"] = """
select row_number() over () as i, library, a, b, split_part(qname, ':', 4) as lane, split_part(qname, ':', 5) as tile,
       split_part(qname, ':', 6)::bigint as x, split_part(qname, ':', 7)::bigint as y from tpl where b is not null"""
STEPS["close"] = """
select p.i as i, q.i as j from points p join points q on p.library = q.library and p.a = q.a and p.b = q.b and p.lane = q.lane and p.tile = q.tile
where p.i <> q.i and abs(p.x - q.x) <= 2500 and abs(p.y - q.y) <= 2500"""
STEPS["optic"] = """
select library, count(*) filter (i <> root) as optical from points join (
    with recursive reach as (select i, i as j from points union select r.i, c.j from reach r join close c on r.j = c.i)
    select i, min(j) as root from reach group by i) using (i) group by library"""
STEPS["bases"] = f"""
select s, contig, pos, count(*) as depth
from (select s, contig, unnest(range(start, "end" + 1)) as pos from reads where mapq >= 20 and baseq >= 20) group by all"""
STEPS["depth"] = f"""
select g.s, g.contig, t.pos, coalesce(b.depth, 0) as depth
from (select distinct s, contig from reads where mapq >= 20 and baseq >= 20) g
join ({_TARGETS}) t on t.contig = g.contig
left join bases b on b.s = g.s and b.contig = g.contig and b.pos = t.pos"""

STEPS["ring_good"] = 'select * from ring_reads where mapq >= 20 and baseq >= 20'
STEPS["ring_bases"] = f"""
select s, contig, (base - 1) % {LENGTH} + 1 as pos, count(*) as depth
from (select s, contig, unnest(range(start, "end" + 1)) as base from ring_good) group by all"""
STEPS["ring_depth"] = f"""
select g.s, g.contig, t.pos, coalesce(b.depth, 0) as depth from (select distinct s, contig from ring_good) g
cross join (select unnest(range(1, {LENGTH + 1})) as pos) t left join ring_bases b on b.s = g.s and b.contig = g.contig and b.pos = t.pos"""
# A run's name is the number of changes before it; the run at the end takes the name of the first one where the depth doesn't change over the origin.
STEPS["ring_changes"] = """
select *, case when depth = lag(depth, 1, -1) over (partition by s, contig order by pos) then 0 else 1 end as new from ring_depth"""
STEPS["ring_runs"] = """
select s, contig, run, any_value(depth) as depth, min(pos) as a, max(pos) as b
from (select *, sum(new) over (partition by s, contig order by pos) as run from ring_changes) group by s, contig, run"""


def sql(steps: str, body: str) -> str:
    """``body`` after the named inputs and steps, in the order given."""
    parts = [f"{n} as ({(SQL | STEPS)[n]})" for n in steps.split()]
    return f"with {', '.join(parts)} {body}" if parts else body


_MATRIX = "calls coverage clean covered met cells"
_FAMILY = "family_calls families bed artifact fam_clean fam_sites fam_grid"
_LIST = ("records samples gnomad mitomap_poly mitomap_dis apogee hmtvar mitotip helix clinvar haplo g poly dis apo hmt tip "
         "hel clin hap tags parsed good")
_TR = "transcripts tr named severe ranked"

ORACLE["coverage_site_summary"] = sql("coverage n", """
select pos, avg(coverage) as mean, floor(median(coverage))::int as median,
       count(*) filter (coverage > 100)::double / (select n from n) as over_100,
       count(*) filter (coverage > 1000)::double / (select n from n) as over_1000 from coverage group by pos""")
ORACLE["coverage_wide_pivot"] = sql("family_coverage", "select pos, " + ", ".join(
    f"max(case when s = '{f}' then coverage end) as {f}" for f in FAMILIES) + " from family_coverage group by pos")
ORACLE["coverage_wide_lines"] = sql("family_coverage families", """
select p.pos, p.pos || chr(9) || string_agg(coalesce(c.coverage::varchar, 'NA'), chr(9) order by sample_idx) as line
from (select distinct pos from family_coverage) p cross join families f
left join family_coverage c on c.pos = p.pos and c.s = f.s group by p.pos""")
ORACLE["cohort_union"] = sql("coverage", "select s, pos, coverage, case when pos > 8000 then true end as late from coverage")
ORACLE["entry_projection"] = sql("calls entries", "select * from entries")
ORACLE["ft_clean"] = sql("calls clean", "select s, pos, ref, alt, FT from clean")
ORACLE["homref_resolve"] = sql(_MATRIX, """
select *, case when HL is null then 'no_call' when HL > 0 then 'called' else 'hom_ref' end as state from cells""")
ORACLE["homref_colocated"] = ORACLE["homref_resolve"]
ORACLE["homref_blocks"] = sql(_MATRIX, "select s, pos, ref, alt, HL, DP, FT from cells where HL is not null or DP is not null")
_COUNTS = """select pos, ref, alt, count(*) filter (HL > 0) as n_called, count(*) filter (HL <= 0) as n_hom_ref,
       (select n from n) - count(*) filter (HL is not null) as n_no_call from cells group by pos, ref, alt"""
ORACLE["homref_state_counts"] = sql(_MATRIX + " n", _COUNTS)
ORACLE["artifact_flag"] = sql("calls bed artifact flagged", "select * from flagged")
ORACLE["circular_artifact_flag"] = sql("calls bed", f"""
select 'MT' as contig, pos, ref, alt,
       case when exists (select 1 from (select distinct (unnest(range(start, "end"))) % {LENGTH} + 1 as base from bed) l
                         where (base - pos + {LENGTH}) % {LENGTH} < length(ref))
            then 'artifact_prone_site' else 'PASS' end as filters
from (select distinct pos, ref, alt from calls)""")
ORACLE["locus_mt"] = sql("coverage", "select s, 'MT' as contig, pos, coverage from coverage")
ORACLE["matrix_blocks"] = sql("calls", f"""
select pos, ref, alt, substr(s, 2)::bigint // {256} as block,
       string_agg(substr(s, 2) || ':' || DP, ',' order by substr(s, 2)::bigint) as cells
from calls group by all""")
ORACLE["matrix_localize_roundtrip"] = sql("calls", """
select pos, ref, alt, substr(s, 2)::bigint as sample_idx, DP, HL from calls""")
ORACLE["matrix_densify"] = sql("family_calls families", """
select t.pos, t.ref, t.alt, f.s, DP, HL
from (select distinct pos, ref, alt from family_calls) t cross join (select s from families) f
left join family_calls c on c.pos = t.pos and c.ref = t.ref and c.alt = t.alt and c.s = f.s""")
ORACLE["vcf_lines"] = sql(_FAMILY, """
select 'MT' as contig, pos, ref, alt, concat_ws(chr(9), 'MT', pos::varchar, '.', ref, alt, '.', filters, '.',
       'DP:HL:MQ:TLOD:FT', string_agg(cell, chr(9) order by sample_idx)) as line
from fam_grid group by pos, ref, alt, filters""")
ORACLE["variant_long"] = sql(_FAMILY, """
select s as SampleID, pos::varchar as POS, ref as REF, alt as ALT, filters as "FILTER", DP::varchar as DP,
       HL as Heteroplasmy from fam_grid""")
ORACLE["variant_long_carriers"] = sql(_FAMILY, """
select s as SampleID, pos::varchar as POS, ref as REF, alt as ALT, HL as Heteroplasmy from fam_grid where HL > 0""")
ORACLE["proband_vcf"] = sql(_FAMILY + " samples", """
select pos, ref, alt, concat_ws(chr(9), 'MT', pos::varchar, '.', ref, alt, '.', filters, '.',
       'DP:HL:MQ:TLOD:FT', string_agg(cell, chr(9) order by sample_idx)) as line
from fam_grid where s in (select family from samples where lower(category) = 'proband')
group by pos, ref, alt, filters having max(HL) > 0""")

ORACLE["sample_qc_mtcn"] = sql("coverage nuclear contam mtcn", "select * from mtcn")
ORACLE["contamination_estimate"] = sql("contam", """
select c.s, reported, case when s_suppkey % 4 = 0 then reported
       else greatest((s_suppkey % 4)::double / 100.0::double, reported) end as applied
from contam c join supplier on 'S' || s_suppkey = c.s""")
ORACLE["qc_gate"] = sql("calls coverage nuclear contam mtcn", """
select s, pos, ref, alt, DP from calls where s in (select Sample_ID from mtcn where Pass_Filter)""")
ORACLE["qc_failed"] = sql("coverage nuclear contam mtcn", """
select Sample_ID as s, mtCN_final, Pass_Filter from mtcn where not Pass_Filter""")

ORACLE["sheet_file_types"] = sql("sheet typed", "select * from typed")
ORACLE["sheet_group_validate"] = sql("sheet typed grouped", "select * from grouped")
ORACLE["sheet_usable"] = sql("sheet typed grouped", """
select row_no, id, type from typed where id in (select id from grouped where problem is null)""")
ORACLE["sheet_pairs"] = sql("sheet typed", """
select id, row_number() over (partition by id order by row_no) - 1 as pair_id, file1, file2
from typed where type = 'FASTQ'""")
ORACLE["sheet_branch_union"] = sql("sheet typed grouped", """
select id, type, n_files, case when n_files > 1 then 'merge' else 'single' end as route
from grouped where problem is null""")
ORACLE["sheet_join"] = sql("sheet typed grouped", """
select id, type, n_files, c_mktsegment as segment, c_acctbal as cost from grouped
join customer on id = 'P' || c_custkey where c_acctbal > 0""")
ORACLE["sheet_sample_ids"] = sql("sheet", "select distinct id from sheet where trim(id) <> ''")
ORACLE["sheet_one_sample"] = sql("sheet", "select * from sheet where id = 'P7'")
ORACLE["manifest_subset"] = """
select 'S' || (o_custkey % 700) as s, arg_max('gs://calls/' || o_orderkey, o_orderkey) as path
from orders join customer on c_custkey = o_custkey
where c_mktsegment = 'BUILDING' and o_orderkey % 5 <> 0 and o_orderstatus <> 'P' group by 1"""

ORACLE["region_calls"] = sql("calls", "select s, pos, ref, alt from calls where pos between 576 and 16024")
ORACLE["lift_back_merge"] = sql("calls", """
select s, pos, ref, alt, 'main' as origin from calls where pos between 576 and 16024 union all
select s, case when pos < 8570 then pos + 8000 else pos - 8569 end, ref, alt, 'shifted' from calls
where pos between 8025 and 9144""")
ORACLE["lift_back_rejects"] = sql("calls", """
select s, pos * 2 - 8569 as pos, ref, alt from calls where pos * 2 - 8569 > 16569""")
ORACLE["shift_back_stitch"] = sql("coverage", """
select s, pos, coverage from coverage where pos between 576 and 16024 union all
select s, case when pos < 8570 then pos + 8000 else pos - 8569 end, coverage from coverage
where case when pos < 8570 then pos + 8000 else pos - 8569 end <> 8000""")
ORACLE["merge_stats"] = """
select l_returnflag as statistic, sum(l_quantity::bigint)::bigint as value from lineitem
where l_linestatus in ('F', 'O') group by 1"""
ORACLE["hard_filters"] = sql("multi wide hard", """
select s, pos, ref, l_orderkey, l_linenumber, q, filters, n_alts from hard""")
ORACLE["split_multiallelic"] = sql("multi wide", """
select s, pos, ref, l_orderkey, l_linenumber, q, alts[i + 1] as alt, i::int as alt_idx,
       q::double / (1000.0::double * (i + 1)) as AF, q || ',' || (q + i + 1) as AD
from (select *, unnest(range(len(alts))) as i from wide)""")
ORACLE["pass_only"] = sql("multi wide hard", """
select s, pos, ref, l_orderkey, l_linenumber, q, n_alts from hard where filters = ''""")
ORACLE["mask_overlap"] = sql("calls bed artifact entries", """
select s, pos, ref, alt, case when exists (select 1 from artifact where base >= pos and base < pos + length(ref))
       then concat_ws(';', FT, 'blacklisted_site') else FT end as filters from entries""")

for _name, _alias in _JOINS.items():
    _out = [n for n, e in _POPULATION.items() if f"{_alias}.v" in e]
    ORACLE[f"annot_{_name}"] = sql(f"calls {_name} {_alias} keys", "select k.SampleID, k.POS, k.REF, k.ALT, " + ", ".join(
        f"{_POPULATION[n]} as {n}" for n in _out) + f" from keys k {_join([_name])}")
ORACLE["annot_haplogroup"] = sql("calls samples haplo hap keys", f"""
select k.SampleID, k.POS, k.REF, k.ALT, sm.haplogroup as Haplogroup, {STATUS} as status,
       {STATUS.replace("contains(hap.groups, lower(sm.haplogroup))",
                       "list_contains(string_split(hap.groups, ','), lower(sm.haplogroup))")} as token_status
from keys k join samples sm on sm.s = k.SampleID left join hap on hap.word = k.REF || k.POS || k.ALT""")
ORACLE["annot_category"] = sql("calls samples keys", """
select lower(SampleID) || '-run1' as SampleID, POS, REF, ALT, category as Sample_Category
from keys join samples on s = SampleID""")
ORACLE["resources_merged"] = sql(
    "gnomad mitomap_poly mitomap_dis apogee hmtvar mitotip helix clinvar haplo g poly dis apo hmt tip hel clin hap", """
select u.ref, u.pos, u.alt, g.v.h as gnomad, hel.v.m as helix, clin.v.l as clinvar, tip.v.l as mitotip, hmt.v.l as hmtvar,
       hap.groups as groups
from (select ref, pos, alt from g union select ref, pos, alt from poly union select ref, pos, alt from dis union
      select ref, pos, alt from apo union select ref, pos, alt from hmt union select ref, pos, alt from tip union
      select ref, pos, alt from hel union select ref, pos, alt from clin union
      select regexp_extract(word, '^(\\D+)', 1), regexp_extract(word, '(\\d+)', 1), regexp_extract(word, '(\\D+)$', 1)
      from hap) u
left join g using (ref, pos, alt) left join hel using (ref, pos, alt) left join clin using (ref, pos, alt)
left join tip using (ref, pos, alt) left join hmt using (ref, pos, alt)
left join hap on hap.word = u.ref || u.pos || u.alt""")
ORACLE["consequence_parse"] = sql("records tags parsed", "select SampleID, POS, REF, ALT, " + ", ".join(
    (f"c[{i + 1}] as \"{n}\"") for i, n in enumerate(expected.CSQ_FIELDS)) + " from parsed")
ORACLE["format_tags"] = sql("records tags parsed good", """
select SampleID, POS, REF, ALT, "FILTER", GT, AD, DP, Heteroplasmy from good""")
ORACLE["format_positional"] = sql("records tags", """
select SampleID, POS, REF, ALT, x[1] as GT, x[2] as AD, try_cast(x[4] as double)::varchar as DP,
       try_cast(x[3] as double) as Heteroplasmy from tags""")
ORACLE["cohort_counts"] = sql("records tags parsed", """
select SampleID, POS || ':' || REF || ':' || ALT as variant_key,
       count(*) filter (Heteroplasmy > 0) over (partition by POS, REF, ALT) as in_cohort_AC,
       count(*) filter (Heteroplasmy > 0) over (partition by SampleID) as Freq from parsed""")
ORACLE["contaminated_out"] = sql("calls samples keys", """
select keys.* from keys join samples on s = SampleID where upper(contamination) <> 'YES'""")
ORACLE["proband_set"] = sql("samples probands", "select s from probands")
ORACLE["proband_filter"] = sql("calls samples keys probands", """
select keys.* from keys join probands on s = SampleID""")
ORACLE["proband_prefix"] = sql("calls samples keys probands", """
select keys.* from keys where exists (select 1 from probands where starts_with(SampleID, s))""")
ORACLE["proband_present"] = sql("records samples probands", """
select SampleID, POS, REF, ALT, SAMPLE_DATA from records
where SampleID in (select s from probands) and (POS, REF, ALT) in (
    select (POS, REF, ALT) from records join probands on s = SampleID
    where split_part(SAMPLE_DATA, ':', 1) not in ('0/0', '0|0', './.'))""")
ORACLE["prefilter_single"] = sql(_LIST + " single", "select * from single")
ORACLE["final_single"] = sql(_LIST + " single", f"""
select * from single where {KEEP} and Haplogroup_Var_Status <> 'haplo_var_match'""")
ORACLE["prefilter_cohort"] = sql(_LIST + " cohort", "select * from cohort")
ORACLE["final_cohort"] = sql(_LIST + " cohort", f"select * from cohort where {KEEP} and Freq < {MAX_FREQ}")
ORACLE["final_disease"] = sql(_LIST + " probands good_probands disease",
                              f"select * from disease where {KEEP} and Freq < {MAX_FREQ}")
ORACLE["cohort_site_report"] = sql(
    f"{_MATRIX} n bed artifact flagged gnomad helix mitomap_poly mitomap_dis clinvar g hel poly dis clin", f"""
select k.POS, k.REF, k.ALT, n_called, n_hom_ref, n_no_call, filters,
       {", ".join(f"{_POPULATION[n]} as {n}" for n in
                  ("gnomad_af_hom", "helix_af_hom", "mitomap_af", "mitomap_disease", "clinvar_interp"))}
from (select pos::varchar as POS, ref as REF, alt as ALT, n_called, n_hom_ref, n_no_call, filters
      from ({_COUNTS}) join flagged using (pos, ref, alt)) k
{_join(["gnomad", "helix", "mitomap_poly", "mitomap_dis", "clinvar"])}""")

_LOCI = """(select s, pos, ref, alt, case DP % 5 when 0 then 'chrX' when 1 then 'Y' when 2 then 'chrM' when 3 then 'MT'
            else 'chr12' end as chrom, regexp_replace(case DP % 5 when 0 then 'chrX' when 1 then 'Y' when 2 then 'chrM'
            when 3 then 'MT' else 'chr12' end, '^chr', '') as contig from calls)"""
ORACLE["variant_ids"] = sql("calls", f"""
select s, pos, ref, alt, contig, concat_ws('-', contig, pos, ref, alt) as id,
       substr(concat_ws('-', contig, pos, ref, alt), 1, 8) as short_id,
       concat_ws('-', chrom, pos, ref, alt) || ',' || concat_ws('-', chrom, pos, ref, alt || 'A') as ids,
       substr(concat_ws('-', chrom, pos, ref, alt), 1, 9) || ',' ||
       substr(concat_ws('-', chrom, pos, ref, alt || 'A'), 1, 9) as short_ids,
       concat_ws(':', pos, ref, alt) as variant_key from {_LOCI}""")
ORACLE["variant_type"] = sql("calls", """
select s, pos, ref, alt, case when length(ref) > length(alt) then 'D' when length(ref) < length(alt) then 'I'
       when length(ref) > 1 then 'M' else 'S' end as kind, pos as first, (pos + length(ref))::int as after from calls""")
_NUMBER = "case when contig = 'X' then 23 when contig = 'Y' then 24 when contig like 'M%' then 25 else 12 end"
ORACLE["xpos"] = sql("calls", f"""
select s, pos, ref, alt, {_NUMBER} as number, ({_NUMBER})::bigint * 1000000000 + pos as xpos from {_LOCI}""")

_LOF = "select distinct variant, gene_id, lof, lof_flags from transcripts where lof <> ''"


def _genes(weak: str) -> str:
    return f"""(select string_agg(gene_id, ',' order by gene_id) from (select gene_id from ({_LOF}) h
      where h.variant = v.variant group by gene_id having bool_and({weak})))"""


ORACLE["lof_flags"] = sql("transcripts", f"""
select v.variant,
       coalesce((select bool_and(lof <> 'HC') from ({_LOF}) h where h.variant = v.variant), false) as low_confidence,
       coalesce((select bool_and(lof_flags <> '') from ({_LOF}) h where h.variant = v.variant), false) as flagged,
       coalesce({_genes("lof <> 'HC'")}, '') as low_confidence_genes,
       coalesce({_genes("lof_flags <> ''")}, '') as flagged_genes
from (select distinct variant from transcripts) v""")
ORACLE["lof_transcript_flags"] = sql("transcripts", """
select variant, transcript_id, lof not in ('', 'HC') as low_confidence, lof <> '' and lof_flags <> '' as flagged
from transcripts""")
ORACLE["transcript_rank"] = sql(_TR, f"""
select variant, place::int as transcript_rank, transcript_id, array_to_string(kept, ',') as terms,
       major as major_consequence, major_rank as major_consequence_rank, {_CATEGORY} as category from ranked""")
ORACLE["hgvs_format"] = sql(_TR, f"select variant, transcript_id, {_HGVS} as hgvs from ranked")
ORACLE["transcript_rank_noncoding"] = sql("transcripts tr named severe ranked_nc", f"""
select variant, place::int as transcript_rank, transcript_id, {_HGVS} as hgvs from ranked_nc""")
ORACLE["worst_transcript"] = sql(_TR, f"""
select v.variant, biotype, canonical, case when r.variant is not null then {_CATEGORY} end as category,
       case when r.variant is not null then 1 end as cdna_start, case when r.variant is not null then 2 end as cdna_end,
       case when r.variant is not null then 'aaA/aaC' end as codons, gene_id, 'SYM' || gene_id as gene_symbol,
       {_HGVS} as hgvs, hgvsc, major as major_consequence, major_rank as major_consequence_rank, transcript_id,
       amino_acids, 'Pfam:' || domain as domains, hgvsp, lof, lof_flags, null::varchar as lof_filter,
       case when r.variant is not null then '' end as lof_info, null::varchar as polyphen_prediction,
       case when r.variant is not null then 'P1' end as protein_id, null::varchar as sift_prediction
from severe v left join ranked r on r.variant = v.variant and place = 0""")
ORACLE["consequence_json"] = sql(_TR, """
select v.variant,
       '{' || coalesce((select string_agg('"' || gene_id || '":"' || m || '"', ',' order by gene_id)
                        from (select gene_id, arg_min(major, place) as m from ranked r where r.variant = v.variant
                              group by gene_id)), '') || '}' as genes,
       '{' || coalesce((select string_agg('"' || transcript_id || '": "' || major || '"', ',' order by place)
                        from ranked r where r.variant = v.variant), '') || '}' as transcripts from severe v""")
ORACLE["vep_sets"] = sql(_TR, """
select variant, (select string_agg(t, ',' order by t) from (
           select term_a as t from named x where x.variant = v.variant union
           select term_b from named x where x.variant = v.variant)) as terms,
       string_agg(distinct gene_id, ',' order by gene_id) as genes,
       coalesce(string_agg(distinct gene_id, ',' order by gene_id) filter (biotype = 'protein_coding'), '') as coding_genes,
       string_agg(distinct transcript_id, ',' order by transcript_id) as transcript_ids,
       string_agg(distinct 'Pfam:' || domain, ',' order by 'Pfam:' || domain) as domains,
       coalesce((select string_agg(distinct 'Pfam:' || domain, ',' order by 'Pfam:' || domain) from ranked r
                 where r.variant = v.variant), '') as ranked_domains
from named v group by variant""")

ORACLE["read_subset"] = sql("reads", """
select qname, contig, mate_contig, mate_unmapped from reads
where contig = 'chrM' and (mate_contig = contig or mate_unmapped) and not (is_unmapped and mate_unmapped)""")
ORACLE["read_revert"] = sql("reads", """
select qname, library, sum_qual, 'NM' as tag_names, mapq::varchar as tag_values from reads""")
ORACLE["merge_runs"] = sql("reads", "select qname, library, contig, pos from reads")
_DUP = "mates ends tpl verdict"
ORACLE["mark_duplicates"] = sql(f"{_DUP} dup", "select qname, library, contig, five_prime, is_primary, is_duplicate from dup")
ORACLE["duplicate_metrics"] = sql(f"{_DUP} dup", """
select library, count(*) as reads, count(*) filter (is_duplicate) as duplicates,
       count(*) filter (is_duplicate)::double / count(*) as duplicate_rate from dup group by library""")
ORACLE["optical_copies"] = sql("mates ends tpl points close optic", "select library, optical from optic")
ORACLE["library_metrics"] = sql(f"{_DUP} points close optic", """
, kinds as (select library, count(*) filter (b is null) as lone, count(b) as pairs, count(*) filter (b is null and d) as lone_duplicates,
                   count(*) filter (b is not null and d) as pair_duplicates from verdict group by library),
rest as (select library, count(*) filter (is_primary and five_prime is null) as unplaced, count(*) filter (not is_primary) as secondary from mates group by library)
select k.library, lone, pairs, unplaced, secondary, lone_duplicates, pair_duplicates, optical as optical_pairs,
       (lone_duplicates + 2 * pair_duplicates)::double / (lone + 2 * pairs) as duplicate_share, round(c * (lo + hi) / 2)::bigint as library_size
from kinds k join rest using (library) join optic using (library) left join (
    with recursive top as (
        select library, (pairs - optical)::double as n, (pairs - pair_duplicates)::double as c, 100.0::double as hi from kinds join optic using (library)
        where pairs - optical > pairs - pair_duplicates
        union all select library, n, c, hi * 10 from top where 1.0::double / hi - 1 + exp(-n / (hi * c)) > 0),
    half as (
        select library, n, c, 1.0::double as lo, max(hi) as hi, 0 as i from top group by library, n, c
        union all select library, n, c, case when up then (lo + hi) / 2 else lo end, case when up then hi else (lo + hi) / 2 end, i + 1
        from (select *, 1.0::double / ((lo + hi) / 2) - 1 + exp(-n / ((lo + hi) / 2 * c)) > 0 as up from half) where i < 40)
    select library, c, lo, hi from half where i = 40) s using (library)""")
STEPS["read_bases"] = """
select s, qname, contig, start + i as pos, case when mapq < 20 then 'mapq' when is_duplicate then 'dupe' when not paired then 'unpaired'
       when i % 31 = 0 or (baseq + i * i) % 41 < 20 then 'baseq' end as why
from (select *, unnest(range(0, "end" - start + 1)) as i from dup where is_primary and start is not null)"""
STEPS["piles"] = """
select s, contig, pos, count(distinct qname) filter (why is null) as depth, count(*) filter (why = 'mapq') as exc_mapq,
       count(*) filter (why = 'dupe') as exc_dupe, count(*) filter (why = 'unpaired') as exc_unpaired, count(*) filter (why = 'baseq') as exc_baseq,
       count(*) filter (why is null) - count(distinct qname) filter (why is null) as exc_overlap from read_bases group by all"""
_LOST = ["mapq", "dupe", "unpaired", "baseq", "overlap"]
STEPS["template_piles"] = f"""
select g.s, g.contig, t.pos, coalesce(depth, 0) as depth, {', '.join(f'coalesce(exc_{n}, 0) as exc_{n}' for n in _LOST)}
from (select distinct s, contig from read_bases) g join ({_TARGETS}) t on t.contig = g.contig left join piles p on p.s = g.s and p.contig = g.contig and p.pos = t.pos"""
ORACLE["template_depth"] = sql(f"{_DUP} dup read_bases piles template_piles", "select *, 0::bigint as exc_capped from template_piles")
_ALL = " + ".join(["sum(least(depth, 3))", *(f"sum(exc_{n})" for n in _LOST), "sum(greatest(depth - 3, 0))"])
ORACLE["coverage_shares"] = sql(f"{_DUP} dup read_bases piles template_piles", f"""
select s, count(*) as territory, avg(least(depth, 3)) as mean_coverage, median(least(depth, 3)) as median_coverage,
       {', '.join(f"count(*) filter (least(depth, 3) >= {x})::double / count(*) as share_{x}x" for x in (1, 5, 10, 20, 30))},
       {', '.join(f"sum(exc_{n})::double / ({_ALL})::double as exc_{n}" for n in _LOST)}, sum(greatest(depth - 3, 0))::double / ({_ALL})::double as exc_capped,
       (({_ALL}) - sum(least(depth, 3)))::double / ({_ALL})::double as exc_total from template_piles group by s""")
ORACLE["per_base_depth"] = sql("reads bases depth", "select s, contig, pos, least(depth, 4) as depth from depth")
_RING = "ring_reads ring_good ring_bases ring_depth"
ORACLE["circular_depth"] = sql(_RING, "select s, contig, pos, depth from ring_depth")
ORACLE["circular_depth_runs"] = sql(f"{_RING} ring_changes ring_runs", f"""
select t.s, t.contig, t.depth, t.a as start, t.b + coalesce(h.b, 0) as "end"
from ring_runs t left join ring_runs h on t.b = {LENGTH} and t.a > 1 and h.a = 1 and h.s = t.s and h.contig = t.contig and h.depth = t.depth
where not (t.a = 1 and t.b < {LENGTH} and exists (
    select 1 from ring_runs e where e.b = {LENGTH} and e.s = t.s and e.contig = t.contig and e.depth = t.depth))""")
ORACLE["wgs_summary"] = sql("reads bases depth", """
select s, avg(depth) as mean_coverage, median(depth) as median_coverage, floor(avg(depth))::bigint as mean_coverage_floor
from depth group by s""")

_BOTH = "from stored o full join incoming i on o.id = i.id"
ORACLE["doc_merge_index"] = sql("stored incoming", f"""
select coalesce(o.id, i.id) as id, case when i.id is null then o.name else i.name end as name,
       case when i.id is null then o.balance end as balance, case when i.id is null then o.segment end as segment,
       i.orders as orders {_BOTH}""")
ORACLE["doc_merge_upsert"] = sql("stored incoming", f"""
select coalesce(o.id, i.id) as id, case when i.id is null then o.name else i.name end as name,
       o.balance, o.segment, i.orders {_BOTH}""")
ORACLE["doc_merge_update"] = sql("stored incoming", f"""
select o.id, case when i.id is null then o.name else i.name end as name, o.balance, o.segment, i.orders
{_BOTH} where o.id is not null""")
ORACLE["doc_merge_create"] = sql("stored incoming", f"""
select coalesce(o.id, i.id) as id, case when o.id is null then i.name else o.name end as name, o.balance, o.segment,
       case when o.id is null then i.orders end as orders {_BOTH}""")
ORACLE["doc_bulk_lines"] = sql("incoming", """
select '{"index":{"_index":"orders","_id":"' || id || '"}}' || chr(10) || '{"id":' || id ||
       coalesce(',"o_name":"' || name || '"', '') || ',"orders":' || orders || '}' as value from incoming""")
ORACLE["doc_bulk_upsert"] = sql("incoming", """
select '{"update":{"_index":"orders","_id":"' || id || '"}}' || chr(10) || '{"doc":{"id":' || id || ',"name":' ||
       coalesce('"' || name || '"', 'null') || ',"orders":' || orders || '},"doc_as_upsert":true}' as value from incoming""")
_code = "replace(raw, '$', '$$')"
for _char, _token in SPECIAL.items():
    _code = f"replace({_code}, '{_char}', '{_token}')"
ORACLE["field_name_codec"] = f"""
select page_id, raw, case when code[1] in ('_', '-', '+', '$') then '$' || code else code end as code, raw as back
from (select page_id, raw, {_code} as code from (
      select page_id, (case page_id % 3 when 0 then '_' when 1 then '$' else '' end) || url ||
             '#a$(b)[c]{{d}}*,_$dot$_' as raw from pages))"""

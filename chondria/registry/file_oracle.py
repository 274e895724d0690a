"""Check SQL of the file queries: what must come back is what the tables say. Constants are written out."""

from chondria.registry.inputs import SQL
from chondria.registry.oracle import ORACLE, sql
from chondria.schema import SINGLE_LIST

ORACLE["file_sheet"] = sql("sheet", """
select row_number() over (order by row_no) - 1 as row_no, id, file1, file2 from sheet""")
ORACLE["file_manifest"] = """
select row_number() over (order by o_orderkey) - 1 as row_no, 'S' || o_orderkey as s, '/calls/' || o_orderkey as path
from orders where o_orderkey % 7 <> 0"""
ORACLE["file_names"] = """
select stem || ['.merged.final.split.vcf', '.final.split.vcf.gz', '.merged.per_base_coverage.tsv.gz', '.per_base_coverage.tsv',
                '.wgs.txt'][k + 1] as file, k = 0 as is_call, k = 2 as is_coverage,
       case when k = 4 then stem || '.wgs.txt' else stem end as s, stem
from (select 'S' || o_orderkey as stem, (o_orderkey % 5)::int as k from orders)"""
ORACLE["file_coverage"] = sql("coverage", "select 'chrM' as chrom, pos, s, coverage from coverage")
ORACLE["grown_site_summary"] = sql("coverage", """
, here as (select * from coverage where s not like '%3'), n as (select count(distinct s) as n from here)
select pos, avg(coverage) as mean, floor(median(coverage))::int as median, count(*) filter (coverage > 100)::double / (select n from n) as over_100,
       count(*) filter (coverage > 1000)::double / (select n from n) as over_1000 from here group by pos""")
ORACLE["file_commented_table"] = sql("gnomad g", """
select ref, pos as position, alt, v.m as max_observed_heteroplasmy, v.h as AF_hom, v.e as AF_het from g""")
ORACLE["file_plain_table"] = sql("mitotip", 'select rCRS, "Position", "Alt", "Quartile" from mitotip')
ORACLE["file_calls"] = sql("calls", """
select s, 'chrM' as contig, pos, ref || '>' || alt as alleles, case flag when 'A' then '' when 'R' then 'strand_bias;FAIL' end as filters,
       DP, HL as AF, MQ as MMQ, TLOD from calls""")
ORACLE["file_cohort_vcf"] = ORACLE["variant_long"]
ORACLE["file_bed"] = sql("bed", 'select contig, start, "end" from bed')
ORACLE["file_contamination"] = """
select 'S' || s_suppkey as s, case when s_suppkey % 5 = 0 then 'YES' else 'NO' end as contamination,
       'H' || s_nationkey as major_haplogroup, 'H' || s_nationkey as minor_haplogroup,
       s_nationkey::double / 64.0::double as major_level, case when s_suppkey % 3 <> 0 then 0.015::double end as minor_level
from supplier"""
ORACLE["file_report_metadata"] = sql("samples", "select s, haplogroup, contamination from samples")
ORACLE["file_metrics"] = "select 'S' || s_suppkey as s, s_suppkey::double as nuc_median, s_suppkey::double / 4.0::double as nuc_mean from supplier"
ORACLE["file_disease_metadata"] = sql("samples", "select s, category from samples")
ORACLE["file_matrix"] = sql("coverage", "select s, pos, coverage from coverage")
ORACLE["file_copy_number"] = ORACLE["sample_qc_mtcn"]
ORACLE["file_documents"] = f"select unnest(string_split(value, chr(10))) as value from ({ORACLE['doc_bulk_lines']})"
_NUMBERS = {"Heteroplasmy", "gnomad_af_hom", "gnomad_af_het", "helix_max_hl", "helix_af_hom", "helix_af_het", "mitomap_af", "Freq"}
_LISTED = "select " + ", ".join(f'"{c}"' if c in _NUMBERS else f"nullif(\"{c}\", '') as \"{c}\"" for c in SINGLE_LIST)
ORACLE["file_variant_lists"] = f"""
{_LISTED}, 'variant_list_prefiltering' as list from ({ORACLE['prefilter_single']})
union all {_LISTED}, 'variant_list' as list from ({ORACLE['final_single']})"""
ORACLE["file_wide_coverage"] = f"""
select row_number() over (order by pos) as row_no, line as value from ({ORACLE['coverage_wide_lines']})
union all select 0 as row_no, 'pos' || chr(9) || string_agg(s, chr(9) order by sample_idx) as value from ({SQL['families']})"""
ORACLE["file_probands"] = f"""
select row_number() over (order by s) - 1 as row_no, s as value from ({ORACLE['proband_set']})"""
ORACLE["doc_store_merge"] = sql("stored", """
, incoming as (select o_custkey * 2 as id, case when o_orderkey % 3 <> 0 then o_orderpriority end as name, o_orderkey as version from orders
               qualify row_number() over (partition by o_custkey order by o_orderkey desc) = 1)
select coalesce(o.id, i.id) as id, case when i.id is null then o.name else i.name end as name, o.balance, o.segment, i.version
from stored o full join incoming i on o.id = i.id""")
ORACLE["good_base_depth"] = sql("reads", """
, cells as (select s, contig, start, mapq, baseq, unnest(range(0, "end" - start + 1)) as i from reads where mapq >= 20),
good as (select s, contig, start + i as pos from cells where i % 31 <> 0 and (baseq + i * i) % 41 >= 20),
bases as (select s, contig, pos, count(*) as depth from good group by all),
t as (select 'chrM' as contig, unnest(range(576, 16025)) as pos union all select 'chr1', unnest(range(1, 2001)))
select g.s, g.contig, t.pos, coalesce(b.depth, 0) as depth from (select distinct s, contig from good) g
join t on t.contig = g.contig left join bases b on b.s = g.s and b.contig = g.contig and b.pos = t.pos""")

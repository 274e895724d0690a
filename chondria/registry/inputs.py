"""Inputs of the registered queries, derived from the driver tables.

The driver tables hold no genomics, so each input is a projection written once as SQL that both engines read.
Every projection is linear in its tables: one row, or a bounded number of rows, per table row.
"""

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


# Columns of the tables in use; a given schema saves the job that reads it from the files.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "pages": "page_id bigint, url string, html string",
}


def _site(key: str, shift: str) -> dict[str, str]:
    """Position and alleles of a whole-number key; ``shift`` chooses the alternate base."""
    return {
        "pos": f"cast(({key} * 37) % 16569 + 1 as int)",
        "ref": f"substr('ACGT', cast({key} % 4 + 1 as int), 1) || case when {key} % 11 = 0 then 'TT' else '' end",
        "alt": f"substr('ACGT', cast(({key} + 1 + {shift}) % 4 + 1 as int), 1)"
               f" || case when {key} % 13 = 0 then 'G' else '' end",
    }


def _cols(exprs: dict[str, str]) -> str:
    return ", ".join(f"{e} as {n}" for n, e in exprs.items())


LINE_SITE = _site("l_partkey", "l_linenumber % 3")
PART_SITE = _site("p_partkey", "0")
PART_SITE_1 = _site("p_partkey", "1")
EVENT_SITE = _site("event_id", "1")

SQL: dict[str, str] = {}

SQL["samples"] = """
select 'S' || cast(s_suppkey as string) as s, s_suppkey as sample_idx,
       'F' || cast(s_nationkey as string) as family,
       case when s_suppkey % 3 = 0 then 'Proband' else 'control' end as category,
       'BRAND#' || cast(s_nationkey + 1 as string) as haplogroup,
       case when s_suppkey % 10 = 4 then 'yes' else 'NO' end as contamination
from supplier"""

# Numbers that determine position and alleles of a line item; grouping is by these, texts are made afterwards.
_LINE_KEYS = """l_suppkey as supp, cast((l_partkey * 37) % 16569 + 1 as int) as pos, cast(l_partkey % 4 as int) as rb,
             case when l_partkey % 11 = 0 then 1 else 0 end as rl,
             cast((l_partkey + 1 + l_linenumber % 3) % 4 as int) as ab, case when l_partkey % 13 = 0 then 1 else 0 end as al"""
_LINE_VALUES = """cast(floor(l_quantity * 40) as int) as dp, cast(floor(l_quantity) as int) as q, l_quantity as tlod,
             cast(round(l_discount * 100) as int) as hl, cast(round(l_tax * 500) as int) as mq, l_linenumber as ln,
             case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end as flag"""
_ALLELES = """substr('ACGT', rb + 1, 1) || case when rl = 1 then 'TT' else '' end as ref,
       substr('ACGT', ab + 1, 1) || case when al = 1 then 'G' else '' end as alt"""

# One row per called cell. HL is NULL for some calls, filters are NULL for some.
SQL["calls"] = f"""
select 'S' || cast(supp as string) as s, pos, {_ALLELES}, dp as DP,
       case when ln = 7 then null else cast(hl as double) / cast(10 as double) end as HL, cast(mq as double) as MQ,
       tlod as TLOD, substr('ANR', flag + 1, 1) as flag
from (select supp, pos, rb, rl, ab, al, max(dp) as dp, max(hl) as hl, max(mq) as mq, max(tlod) as tlod, min(ln) as ln,
             min(flag) as flag
      from (select {_LINE_KEYS}, {_LINE_VALUES} from lineitem) as l group by supp, pos, rb, rl, ab, al) as g"""
# The same under other sample names, for the queries whose output has one column or cell per sample.
SQL["family_calls"] = SQL["calls"].replace("'S' ||", "'F' ||")
SQL["families"] = """
select 'F' || cast(s_suppkey as string) as s, cast(s_suppkey as bigint) as sample_idx from supplier"""

# Depth at the site of a line item or at that of the neighbouring part, so that calls and coverage overlap.
SQL["coverage"] = """
select 'S' || cast(supp as string) as s, pos, coverage
from (select supp, pos, max(cov) as coverage
      from (select l_suppkey as supp,
                   cast(((case when l_linenumber % 2 = 0 then l_partkey
                               else l_partkey + 1 - 2 * (l_partkey % 2) end) * 37) % 16569 + 1 as int) as pos,
                   case when (l_suppkey + l_partkey) % 29 = 0 then null
                        else cast(floor(l_quantity * 30) as int) end as cov
            from lineitem) as l
      group by supp, pos) as g"""
SQL["family_coverage"] = SQL["coverage"].replace("'S' ||", "'F' ||")

SQL["bed"] = """
select 'MT' as contig, cast((p_partkey * 37 + 5) % 16569 as int) as start,
       cast((p_partkey * 37 + 5) % 16569 + 1 + p_size % 3 as int) as "end"
from part"""

# Multi-allelic calls with per-alternate and per-allele arrays, before splitting.
SQL["multi"] = f"""
select 'S' || cast(l_suppkey as string) as s, {LINE_SITE['pos']} as pos, {LINE_SITE['ref']} as ref,
       l_linenumber, l_partkey, l_orderkey, cast(floor(l_quantity) as int) as q, l_discount as af, l_returnflag as flag
from lineitem"""

_INFO = ("'AC=' || cast(ln as string) || ';CSQ=' || alt || '|' || "
         "(case when ln % 3 = 0 then 'synonymous_variant' when ln % 3 = 1 then 'missense_variant' else 'stop_gained' end) || "
         "'|MODERATE|MT-' || substr('ANR', flag + 1, 1) || '|ENSG' || cast(ln as string) || "
         "'|Transcript|ENST1|protein_coding|1/1||ENST1:c.' || cast(pos as string) || ref || '>' || alt || "
         "'|ENSP1:p.X|1|2|3|K/N|aaA/aaC||0|1||SNV'")
# Annotated records in long form; the cell layout varies and FILTER is missing for some.
SQL["records"] = f"""
select 'S' || cast(supp as string) as SampleID, 'chrM' as CHROM, cast(pos as string) as POS, ref as REF, alt as ALT,
       case when ln = 6 then null when flag = 2 then 'weak_evidence;strand_bias' when flag = 0 then 'possible_numt'
            else 'PASS' end as "FILTER",
       {_INFO} as INFO,
       case when ln % 4 = 0 then 'GT:DP:HL' else 'GT:AD:AF:DP' end as FORMAT,
       case when ln % 4 = 0 then '0/1:' || cast(dp as string) || ':0.' || cast(hl as string)
            else (case when ln = 5 then '0/0' else '0/1' end) || ':10,' || cast(q as string) ||
                 (case when ln = 7 then ':.:' else ':0.' || cast(hl as string) || ':' end) || cast(dp as string)
            end as SAMPLE_DATA
from (select supp, pos, {_ALLELES}, dp, hl, q, ln, flag
      from (select supp, pos, rb, rl, ab, al, max(dp) as dp, max(hl) as hl, max(q) as q, min(ln) as ln, min(flag) as flag
            from (select {_LINE_KEYS}, {_LINE_VALUES} from lineitem) as l group by supp, pos, rb, rl, ab, al) as g) as t"""

_P, _P1, _E = (_cols(s) for s in (PART_SITE, PART_SITE_1, EVENT_SITE))
SQL["gnomad"] = f"""
select ref, cast(pos as string) as position, alt, max_observed_heteroplasmy, AF_hom, AF_het, ord
from (select {_P}, case when p_size = 50 then null else '0.' || cast(p_size as string) end as max_observed_heteroplasmy,
             case when p_size = 49 then null when p_size % 3 = 0 then '0.0' || cast(p_size as string)
                  else '0.00' || cast(p_size as string) end as AF_hom,
             case when p_size = 48 then 'x' else '0.000' || cast(p_size as string) end as AF_het, p_partkey as ord
      from part) as p"""
SQL["mitomap_poly"] = f"""
select ref, cast(pos as string) as pos, alt, case when p_size = 7 then null else cast(p_size * 20 as string) end as gbcnt,
       ord from (select {_P1}, p_size, p_partkey as ord from part) as p"""
SQL["mitomap_dis"] = f"""
select ref, cast(pos as string) as pos, alt, status, homoplasmy, heteroplasmy, disease, ord
from (select {_P1}, p_type as status, case when p_size % 2 = 0 then '+' end as homoplasmy,
             case when p_size % 5 = 0 then '-' end as heteroplasmy,
             case when p_size % 3 = 0 then p_name end as disease, p_partkey as ord from part) as p"""
SQL["apogee"] = f"""
select ref as Ref, cast(pos as string) as Start, alt as Alt, APOGEE1, APOGEE2, ord
from (select {_P}, case when p_size % 4 = 0 then null when p_size % 2 = 0 then 'N' else 'P' end as APOGEE1,
             case when p_size % 6 = 0 then null else p_type end as APOGEE2, p_partkey as ord from part) as p"""
SQL["hmtvar"] = f"""
select ref as REF, cast(pos as string) as POS, alt as ALT, HmtVar, ord
from (select {_E}, case when value < 3 then '{{bad' when value < 6 then '{{"other": 1}}' when value < 8 then null
                        else '{{"pathogenicity": "' || event_type || '"}}' end as HmtVar, event_id as ord
      from events) as e"""
SQL["mitotip"] = f"""
select ref as rCRS, cast(pos as string) as Position, alt as Alt, 'Q' || cast(p_size % 5 as string) as Quartile, ord
from (select {_P}, p_size, p_partkey as ord from part) as p"""
SQL["helix"] = f"""
select 'chrM:' || cast(pos as string) as locus,
       '["' || ref || '","' || alt || '"' || (case when p_size % 7 = 0 then ',"T"' else '' end) || ']' as alleles,
       case when p_size % 2 = 0 then '0' when p_size = 3 then null else '0.00' || cast(p_size as string) end as AF_hom,
       '0.0' || cast(p_size as string) as AF_het,
       case when p_size % 11 = 0 then null when p_size = 13 then 'x' else '0.' || cast(p_size as string) end as max_ARF,
       ord from (select {_P}, p_size, p_partkey as ord from part) as p"""
SQL["clinvar"] = f"""
select cast(pos as string) as location, 'NC_1:' || cast(pos - 1 as string) || ':' || ref || ':' || alt as spdi,
       case p_type when 'ECONOMY' then 'Benign' when 'STANDARD' then 'Conflicting interpretations of pathogenicity'
                   when 'PROMO' then 'Pathogenic' when 'SMALL' then 'Likely benign'
                   when 'LARGE' then 'Benign/Likely benign' end as label, ord
from (select {_P1}, p_type, p_partkey as ord from part) as p"""
SQL["haplo"] = f"""
select ref || cast(pos as string) || alt as Variant, p_brand || ',H' || cast(p_size as string) as Assoc_haplogroups, ord
from (select {_P}, p_brand, p_size, p_partkey as ord from part) as p"""

# Alignments, one per event; a few positions and pairs repeat, so fragments have copies.
SQL["reads"] = """
select 'R' || cast(event_id as string) as qname, event_type as library, event_type as s,
       case when event_id % 10 < 8 then 'chrM' else 'chr1' end as contig,
       cast((event_id * 37) % 16000 + 1 as int) as start,
       cast(least((event_id * 37) % 16000 + 100 + event_id % 50, 16569) as int) as "end",
       cast((event_id * 37) % 16000 + 1 as int) as pos,
       cast(event_id % 61 as int) as mapq, cast((event_id * 7) % 41 as int) as baseq,
       cast(user_id % 40 as int) as five_prime, cast(event_id % 2 as int) as strand,
       case when event_id % 9 = 0 then null else cast(user_id % 3 as int) end as mate_five_prime,
       cast(event_id % 2 as int) as mate_strand,
       case when event_id % 7 = 0 then 'chr1' else 'chrM' end as mate_contig,
       event_id % 13 = 0 as is_unmapped, event_id % 13 = 0 or event_id % 17 = 0 as mate_unmapped,
       cast(floor(value * 10) as bigint) as sum_qual
from events"""

# Alignments around the whole contig; those near its end go on over the origin, so their end lies beyond the contig.
SQL["ring_reads"] = """
select 'R' || cast(event_id as string) as qname, event_type as s, 'chrM' as contig, cast((event_id * 37) % 16569 + 1 as int) as start,
       cast((event_id * 37) % 16569 + 150 + event_id % 50 as int) as "end", cast(event_id % 61 as int) as mapq, cast((event_id * 7) % 41 as int) as baseq
from events"""

# Two reads per template, one per event; names carry tile, x and y. Fragments have copies in either order of mates; some mates are unplaced, on
# another contig or not there, some places of lone reads have a pair, and some reads have a secondary alignment.
_READ = """
select event_id, value, cast(floor(event_id / 2) as bigint) as k, event_id % 2 as side, {primary} as is_primary from events{where}"""
_MATE = """
select *, 'M:7:FC:' || cast(1 + k % 2 as string) || ':' || cast(1101 + k % 3 as string) || ':' || cast((k * 7919) % 30011 as string) || ':' ||
       cast((k * 104729) % 20011 as string) as qname, 'L' || cast(k % 3 as string) as library, 'S' || cast(k % 3 as string) as s,
       (k * 37) % 400 as f, case when k % 11 = 0 then 1 - side else side end as strand from ({rows}) as r""".replace(
    "{rows}", _READ.format(primary="true", where="") + " union all " + _READ.format(primary="false", where=" where event_id % 38 = 0"))
SQL["mates"] = f"""
select qname, library, s, is_primary, cast(case when unplaced then null else strand end as int) as strand,
       case when unplaced then null when side = 1 and k % 17 = 0 then 'chr1' else 'chrM' end as contig,
       cast(case when unplaced then null when side = 0 then five0 else five1 end as int) as five_prime,
       cast(case when side = 1 or gone then case when k % 26 = 13 then null else five0 end when k % 9 = 0 then null else five1 end as int) as mate_five_prime,
       cast(1 - strand as int) as mate_strand, case when side = 0 and k % 17 = 0 then 'chr1' else 'chrM' end as mate_contig,
       cast(case when unplaced then null when side = 0 then five0 else five1 - 99 - k % 50 end as int) as start,
       cast(case when unplaced then null when side = 0 then five0 + 99 + k % 50 else five1 end as int) as "end",
       cast((k * 7 + side * 3) % 61 as int) as mapq, cast((k * 5 + side) % 41 as int) as baseq, k % 9 <> 0 as paired,
       cast(floor(value * 10) as bigint) as sum_qual
from (select *, side = 1 and k % 9 = 0 as unplaced, k % 13 = 0 as gone,
             case when not is_primary then 9000 + f else f * 37 % 15000 + 700 end as five0, f * 37 % 15000 + 800 + f % 90 as five1
      from ({_MATE}) as t) as m
where not (k % 13 = 0 and side = 1)"""

# Sample sheet, one row per order: several file types, blanks and missing indexes.
SQL["sheet"] = """
select o_orderkey as row_no,
       case when o_orderkey % 97 = 0 then ' ' else 'P' || cast(o_custkey as string) end as id,
       case when o_orderkey % 89 = 0 then '' when o_custkey % 5 = 4 and o_orderstatus = 'P' then o_orderpriority || '.txt'
            when o_custkey % 5 = 0 then o_orderpriority || '.cram' when o_custkey % 5 = 1 then o_orderpriority || '.bam'
            when o_custkey % 5 = 2 then cast(o_orderkey as string) || '.fq.gz'
            else cast(o_orderkey as string) || '_R1.fastq.gz' end as file1,
       case when o_orderstatus = 'F' then null else cast(o_orderkey as string) || '_2' end as file2
from orders"""

# Transcripts of a variant. All fields follow from a line number, one of 39 residues, a flag and a status, so a
# variant has at most a fixed number of distinct ones. ``a`` and ``b`` are ranks of its two consequence terms.
SQL["transcript_codes"] = """
select distinct l_partkey as variant, l_linenumber as ln, cast(l_suppkey % 39 as int) as res,
       case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end as fl, case l_linestatus when 'O' then 0 else 1 end as st
from lineitem"""
TRANSCRIPT_FIELDS = {
    "transcript_id": "'T' || cast(x.ln as string) || '_' || cast(x.res as string) || substr('ANR', x.fl + 1, 1) || "
                     "substr('OF', x.st + 1, 1)",
    "gene_id": "'G' || cast(x.ln % 3 as string)",
    "lof": "case x.fl when 0 then 'HC' when 2 then 'LC' else '' end",
    "lof_flags": "case when x.res % 4 = 0 then 'flag1' else '' end",
    "biotype": "case x.st when 0 then 'protein_coding' else 'lincRNA' end",
    "canonical": "cast(x.ln % 2 as int)",
    "a": "cast((x.ln * 5 + x.res) % 39 as int)",
    "b": "cast((x.res * 7) % 39 as int)",
    "hgvsc": "'ENST:c.' || cast(x.ln as string) || 'A>G'",
    "hgvsp": "case x.ln when 3 then null when 4 then 'ENSP:p.(Met1%3D)' else 'ENSP:p.Lys' || cast(x.ln as string) || 'Asn' end",
    "amino_acids": "case when x.res % 5 = 0 then 'K/N' else substr('ACDEFGHIKL', x.ln, 1) end",
    "protein_start": "cast(x.ln * 10 as int)",
    "domain": "substr('OF', x.st + 1, 1)",
}
SQL["transcripts"] = f"select x.variant, {_cols(TRANSCRIPT_FIELDS)} from ({SQL['transcript_codes']}) as x"

SQL["stored"] = """
select c_custkey as id, c_name as name, c_acctbal as balance, c_mktsegment as segment from customer"""
# Incoming documents: some update a stored id, some are new; the name is missing in some.
SQL["incoming"] = """
select o_custkey * 2 as id, case when max(o_orderkey) % 3 = 0 then null else max(o_orderpriority) end as name,
       count(*) as orders from orders group by o_custkey"""


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived input as a DataFrame."""
    text = SQL[name].replace('"end"', "`end`").replace('"FILTER"', "`FILTER`")
    used = [t for t in TABLES if f"from {t}" in text]
    for t in used:
        text = text.replace(f"from {t}", "from {" + t + "}")
    text = text.replace("'{bad'", "'{{bad'").replace("'{\"", "'{{\"").replace("\"}'", "\"}}'").replace("1}'", "1}}'")
    return spark.sql(text, **{t: load(spark, sf_dir, t) for t in used})

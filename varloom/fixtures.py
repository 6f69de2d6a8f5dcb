"""Test views over the driver's tables.

Each view is one SQL text that Spark and DuckDB both accept, so the oracle reads exactly the rows Spark reads. Coverage
of the annotation tables follows the part type: real sources each list only part of all variants.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Columns the views use; a given schema saves Spark from opening the files to infer one.
BASE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string",
    "events": "event_id bigint, user_id bigint, event_type string, value double, props string",
}
BASE_TABLES = list(BASE_SCHEMAS)

_CHROM = """CASE WHEN {key} % 25 < 22 THEN CAST({key} % 25 + 1 AS STRING)
    WHEN {key} % 25 = 22 THEN 'X' WHEN {key} % 25 = 23 THEN 'Y' ELSE 'M' END"""

VIEWS: dict[str, str] = {}

# One row per variant site.
VIEWS["sites"] = f"""
SELECT site_id, chrom, pos, CAST(floor(pos / 1000000) AS INT) AS blk_pos, ref, alt, p_size, p_type,
  concat(chrom, ':', CAST(pos AS STRING), ':', ref, ':', alt) AS var_id
FROM (SELECT p_partkey AS site_id, {_CHROM.format(key='p_partkey')} AS chrom,
  CAST(1 + (p_partkey * 7919) % 2500000 AS INT) AS pos,
  CASE WHEN p_size % 10 = 0 THEN 'AC' ELSE substr('ACGT', CAST(p_partkey % 4 + 1 AS INT), 1) END AS ref,
  CASE WHEN p_size % 10 = 1 THEN 'ACG'
       ELSE substr('ACGT', CAST((p_partkey + 1 + p_size % 3) % 4 + 1 AS INT), 1) END AS alt,
  p_size, p_type FROM part) s"""

_SITE = "var_id, chrom, pos, ref, alt, blk_pos"

VIEWS["dbsnp"] = f"""
SELECT {_SITE}, concat('rs', CAST(site_id AS STRING)) AS rs_id, CAST(100 + p_size AS STRING) AS dbsnp_buildid
FROM sites WHERE p_type IN ('ECONOMY', 'LARGE', 'MEDIUM')"""

VIEWS["kaviar"] = f"""
SELECT {_SITE}, CAST(p_size AS DOUBLE) / 500 AS kav_freq, 'synthetic' AS kav_source
FROM sites WHERE p_type <> 'PROMO'"""

VIEWS["clinvar"] = f"""
SELECT {_SITE},
  CASE p_size % 8 WHEN 0 THEN '5' WHEN 1 THEN '4' WHEN 2 THEN '5|255' WHEN 3 THEN '255'
    WHEN 4 THEN '2|5' WHEN 5 THEN '5|3' WHEN 6 THEN '2' ELSE '0' END AS clin_sig,
  concat('condition_', CAST(p_size AS STRING)) AS clin_dbn,
  concat('GENE', CAST(site_id % 25 AS STRING)) AS gene
FROM sites WHERE p_type <> 'STANDARD'"""

# Some variants have two rows here, to exercise the left-join fan-out.
VIEWS["hgmd"] = f"""
SELECT {_SITE}, concat('CM', CAST(site_id AS STRING)) AS id, 'DM' AS var_class
FROM sites WHERE p_type IN ('SMALL', 'LARGE')
UNION ALL
SELECT {_SITE}, concat('CX', CAST(site_id AS STRING)) AS id, 'DM?' AS var_class
FROM sites WHERE p_type = 'SMALL'"""

VIEWS["dbnsfp"] = f"""
SELECT {_SITE}, CAST(p_size AS DOUBLE) / 10 AS cadd_raw,
  CAST(p_size AS DOUBLE) / 50 AS dann_score, concat('dom', CAST(p_size % 4 AS STRING)) AS interpro_domain,
  CASE WHEN p_size % 6 = 0 THEN 'T;D;' ELSE 'T;' END AS sift_pred,
  CASE WHEN p_size % 9 = 0 THEN 'H' ELSE 'L' END AS mutation_assessor_pred
FROM sites WHERE p_type <> 'MEDIUM'"""

VIEWS["coding"] = f"""
SELECT {_SITE}, concat('GENE', CAST(site_id % 25 AS STRING)) AS gene,
  CASE p_size % 5 WHEN 0 THEN 'missense_variant' WHEN 1 THEN 'frameshift_variant'
    WHEN 2 THEN 'synonymous_variant' WHEN 3 THEN 'stop_retained_variant' ELSE 'intron_variant' END AS effect,
  CASE p_size % 5 WHEN 1 THEN 'HIGH' WHEN 0 THEN 'MODERATE' WHEN 4 THEN 'MODIFIER' ELSE 'LOW' END AS impact,
  concat('ENST', CAST(site_id AS STRING)) AS feature_id
FROM sites WHERE p_type <> 'LARGE'"""

# Raw annotation text, one or two comma-separated effects per record.
VIEWS["vcf_info"] = """
SELECT chrom, pos, var_id, ref, alt, concat('ANN=', alt, '|', effect, '|', impact, '|', gene, '|', gene,
  '|transcript|', feature_id, '|protein_coding|1|c.1|p.1',
  CASE WHEN pos % 2 = 0 THEN concat(',', alt, '|downstream_gene_variant|MODIFIER|', gene, '|', gene,
  '|transcript|', feature_id, 'b|protein_coding|2|c.2|p.2') ELSE '' END) AS info
FROM coding"""

# Gene intervals of about 0.9 Mb, overlapping the coordinate range of the sites.
VIEWS["genes"] = f"""
SELECT concat('GENE', CAST(n_nationkey AS STRING)) AS gene_name, {_CHROM.format(key='n_nationkey')} AS chrom,
  CAST(1 + (n_nationkey * 40009) % 300000 AS INT) AS txstart,
  CAST(900001 + (n_nationkey * 40009) % 300000 AS INT) AS txstop,
  CASE WHEN n_nationkey % 2 = 0 THEN '+' ELSE '-' END AS strand FROM nation"""

VIEWS["gene_list"] = """
SELECT concat('GENE', CAST(n_nationkey AS STRING)) AS gene,
  CASE WHEN n_nationkey % 3 = 0 THEN 'AD' ELSE 'AR' END AS inheritance,
  concat('phenotype_', CAST(n_regionkey AS STRING)) AS phenotype
FROM nation WHERE n_regionkey < 4"""

# Genotype calls, one per line item. Open orders' items fall on 100 common sites that families share, the others on their
# own part's site, so a few sites are hot and the number of sites grows with the data.
VIEWS["calls"] = """
SELECT l_orderkey, l_linenumber, subject_id, family_id,
  CASE subject_id % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'NB' END AS member,
  concat('101-', lpad(CAST(family_id AS STRING), 9, '0'), '-',
    CASE subject_id % 3 WHEN 0 THEN '01' WHEN 1 THEN '02' ELSE '03' END) AS sample_id,
  chrom, pos, blk_pos, ref, alt, var_id, qual, dp, filter, gt
FROM (SELECT l.l_orderkey, l.l_linenumber, o.o_custkey AS subject_id,
    CAST(floor(o.o_custkey / 3) AS BIGINT) AS family_id, st.chrom, st.pos, st.blk_pos, st.ref, st.alt, st.var_id,
    CAST(l.l_quantity AS INT) AS qual, CAST(l.l_partkey % 40 AS INT) AS dp,
    CASE WHEN l.l_returnflag = 'R' THEN 'LowQual' ELSE 'PASS' END AS filter,
    CASE WHEN l.l_orderkey % 97 = 0 THEN NULL WHEN l.l_linenumber % 3 = 0 THEN '1/1'
         WHEN l.l_linenumber % 7 = 1 THEN '1/2' ELSE '0/1' END AS gt
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN sites st ON st.site_id = CASE WHEN l.l_linestatus = 'O' THEN l.l_partkey % 100 ELSE l.l_partkey END) c"""

# Interval-style two-allele calls.
VIEWS["cgi_calls"] = """
SELECT concat('101-', CAST(family_id AS STRING), '-', member) AS sample_id, chrom AS chr, pos AS start,
  CAST(pos + length(ref) AS INT) AS stop, ref, CASE WHEN gt = '1/1' THEN alt ELSE ref END AS allele1seq, alt AS allele2seq,
  CASE WHEN gt = '1/1' THEN 'hom' ELSE 'het-ref' END AS zygosity, qual AS allele1varquality, dp AS totalreadcount
FROM calls WHERE gt IS NOT NULL"""

VIEWS["vcf_file"] = """
SELECT c_custkey AS subject_id, concat('vendor_', CAST(c_custkey AS STRING)) AS genome FROM customer
WHERE c_mktsegment <> 'MACHINERY'"""

VIEWS["panel"] = """
SELECT c.c_custkey AS sample, n.n_name AS pop, r.r_name AS super_pop,
  CASE WHEN c.c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS gender
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE c.c_mktsegment <> 'HOUSEHOLD'"""

# Population fractions per sample.
VIEWS["admix_q"] = """
SELECT c_custkey AS sample, CAST(c_custkey % 7 AS DOUBLE) / 10 AS q1, 1 - CAST(c_custkey % 7 AS DOUBLE) / 10 AS q2
FROM customer"""

VIEWS["irg"] = """
SELECT chrom, pos AS strata_id, subject_id, CASE WHEN gt = '1/1' THEN 2 ELSE 1 END AS zygosity
FROM calls WHERE gt IS NOT NULL"""

VIEWS["sts"] = "SELECT chrom, pos, p_size AS mac FROM sites"

VIEWS["feature_fm"] = """
SELECT concat(CASE WHEN site_id % 3 = 0 THEN 'N:METH:' ELSE 'N:GEXP:' END, CAST(site_id AS STRING)) AS feature_id,
  chrom AS chr, pos FROM sites"""

VIEWS["ml_matrix"] = """
SELECT CASE WHEN l_discount > 0.05 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS label, l_quantity AS f1,
  l_extendedprice AS f2, l_tax AS f3, l_discount AS f4, l_orderkey, l_linenumber FROM lineitem"""


@cache
def _needs(name: str) -> tuple[str, ...]:
    """Views ``name`` reads, in definition order, itself last."""
    words = set(re.findall(r"\w+", VIEWS[name]))
    parents = {up for view in VIEWS if view != name and view in words for up in _needs(view)}
    return tuple(v for v in VIEWS if v in parents) + (name,)


def ctes(*names: str) -> str:
    """Comma-separated CTE definitions of the views and all they need."""
    wanted = {v for n in names for v in _needs(n)}
    return ",\n".join(f"{v} AS ({VIEWS[v]})" for v in VIEWS if v in wanted)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table or a view over the Parquet files in ``sf_dir``."""

    def base(table: str) -> DataFrame:
        return spark.read.schema(BASE_SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")

    if name in BASE_SCHEMAS:
        return base(name)
    text = ctes(name)
    words = set(re.findall(r"\w+", text))
    for table in BASE_SCHEMAS:
        if table in words:
            base(table).createOrReplaceTempView(table)
    return spark.sql(f"WITH {text}\nSELECT * FROM {name}")

"""Pathogenic variants, cohort comparison, strata and overlap counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.labels import STRICT
from bindings.registry import query, sql
from varloom.functions.columns import pathogenic, reorder_id_parts, report_key
from varloom.operators.joins import join_on_variant, members_in
from varloom.plans import overlap as O
from varloom.plans import pathogenic as P
from varloom.plans.strata import strata_mac as strata

SETS = "clin_sig IS NOT NULL AND (list_contains(codes, '4') OR list_contains(codes, '5')) AND NOT list_contains(codes, '2') AND NOT list_contains(codes, '3')"
KNOWN = f"known AS (SELECT * FROM (SELECT *, string_split(clin_sig, '|') AS codes FROM clinvar) WHERE {SETS})"


@query(
    "clinvar_pathogenic",
    sql(
        "calls clinvar",
        """SELECT c.sample_id, c.member, c.chrom, c.pos, c.ref, c.alt, c.qual, c.filter, c.gt, k.gene, k.clin_sig, k.clin_dbn
        FROM calls c JOIN known k ON c.chrom = k.chrom AND c.pos = k.pos AND c.ref = k.ref AND c.alt = k.alt
        WHERE c.member IN ('M', 'NB') AND c.filter = 'PASS'""",
        KNOWN,
    ),
)
def clinvar_pathogenic(t):
    calls = t("calls").select("sample_id", "member", "chrom", "pos", "ref", "alt", "qual", "filter", "gt")
    known = t("clinvar").select("chrom", "pos", "ref", "alt", "gene", "clin_sig", "clin_dbn")
    return P.clinvar_pathogenic(calls, known, {"member": "M,NB", "filter": "PASS", "chrom": "all"})


@query(
    "clinvar_pathogenic_cgi",
    sql(
        "cgi_calls clinvar",
        """SELECT g.*, k.pos, k.alt, k.clin_sig FROM cgi_calls g JOIN known k ON g.chr = k.chrom AND g.ref = k.ref
        AND k.pos BETWEEN g.start AND g.stop AND (k.alt = g.allele1seq OR k.alt = g.allele2seq)""",
        KNOWN,
    ),
)
def clinvar_pathogenic_cgi(t):
    known = t("clinvar").select("chrom", "pos", "ref", "alt", "clin_sig")
    return P.clinvar_pathogenic(t("cgi_calls"), known, platform="cgi").drop("chrom")


LOOSE = "NOT regexp_matches(clin_sig, '3|2[^5]') AND regexp_matches(clin_sig, '4|[^25]5')"


@query(
    "clinvar_with_gene_list",
    sql(
        "clinvar gene_list",
        f"""SELECT c.var_id, c.clin_sig, c.gene, l.inheritance, l.phenotype FROM clinvar c LEFT JOIN gene_list l
        ON c.gene = l.gene WHERE {LOOSE}""",
    ),
)
def clinvar_with_gene_list(t):
    return P.clinvar_with_gene_list(t("clinvar").select("var_id", "clin_sig", "gene"), t("gene_list"))


COHORTS = f"""
  clin AS (SELECT c.*, l.inheritance, l.phenotype FROM clinvar c LEFT JOIN gene_list l ON c.gene = l.gene WHERE {LOOSE}),
  ours AS (SELECT g.sample_id, g.chr, g.start, g.ref, g.allele1seq, g.allele2seq, k.pos, k.alt, k.gene, k.clin_sig, k.inheritance,
    CASE WHEN k.alt = g.allele1seq AND k.alt = g.allele2seq THEN 'hom_alt'
      WHEN k.alt <> g.allele1seq AND k.alt <> g.allele2seq THEN 'hom_ref' ELSE 'other' END AS alt_call,
    k.gene || ':' || g.chr || ':' || g.ref || '->' || g.allele1seq || ':' || g.sample_id AS report_id
    FROM cgi_calls g JOIN clin k ON g.chr = k.chrom AND g.ref = k.ref AND k.pos BETWEEN g.start AND g.stop
    AND (k.alt = g.allele1seq OR k.alt = g.allele2seq)
    WHERE (g.sample_id LIKE '%F' OR g.sample_id LIKE '%M') AND g.zygosity = 'hom'),
  theirs AS (SELECT k.gene || ':' || c.chrom || ':' || c.ref || '->' || c.alt || ':101-' || family_id || '-' || member AS report_id,
    k.gene, '101-' || family_id || '-' || member AS sample_id FROM calls c JOIN clinvar k ON c.var_id = k.var_id
    WHERE {STRICT} AND c.member IN ('M', 'F') AND c.gt = '1/1' AND c.filter = 'PASS'),
  sides AS (SELECT report_id, gene, sample_id, bool_or(side = 'o') AS o, bool_or(side = 't') AS t FROM (
    SELECT report_id, gene, sample_id, 'o' AS side FROM ours UNION ALL SELECT *, 't' FROM theirs) GROUP BY ALL)"""


def _ours(t):
    calls = t("cgi_calls").select("sample_id", "chr", "start", "stop", "ref", "allele1seq", "allele2seq", "zygosity")
    known = t("clinvar").select("chrom", "pos", "ref", "alt", "gene", "clin_sig")
    return P.cohort_findings(calls, known, t("gene_list").select("gene", "inheritance"))


def _theirs(t):
    key = ["chrom", "pos", "ref", "alt"]
    vendor = F.concat_ws("-", "member", F.lit("101"), F.col("family_id").cast("string")).alias("sample_id")
    homs = t("calls").where("member IN ('M', 'F') AND gt = '1/1' AND filter = 'PASS'").select(vendor, *key)
    known = t("clinvar").where(pathogenic(F.col("clin_sig"))).select(*key, "gene")
    found = join_on_variant(reorder_id_parts(homs), known)
    return found.withColumn("report_id", report_key("gene", "chrom", "ref", "alt", "sample_id"))


@query(
    "cohort_findings",
    sql(
        "cgi_calls clinvar gene_list calls",
        "SELECT sample_id, chr, start, ref, allele1seq, pos, alt, gene, clin_sig, inheritance, alt_call, report_id FROM ours",
        COHORTS,
    ),
)
def cohort_findings(t):
    columns = ["sample_id", "chr", "start", "ref", "allele1seq", "pos", "alt", "gene", "clin_sig", "inheritance", "alt_call"]
    return _ours(t).select(*columns, "report_id")


@query(
    "compare_cohorts",
    sql(
        "cgi_calls clinvar gene_list calls",
        """SELECT CASE WHEN o AND t THEN 'shared' WHEN o THEN 'only_ours' ELSE 'only_theirs' END AS side, count(*) AS n_findings,
        count(DISTINCT gene) AS n_genes, count(DISTINCT sample_id) AS n_samples FROM sides GROUP BY ALL""",
        COHORTS,
    ),
)
def compare_cohorts(t):
    return P.compare_cohorts(_ours(t), _theirs(t))


# The samples that the file metadata lists as loaded.
LISTED = "sample_id IN (SELECT '101-' || family_id || '-' || member FROM calls JOIN vcf_file USING (subject_id))"


def _listed(t):
    loaded = t("calls").join(t("vcf_file").select("subject_id"), "subject_id", "left_semi")
    return loaded.select(F.concat_ws("-", F.lit("101"), F.col("family_id").cast("string"), "member").alias("sample_id")).distinct()


@query(
    "only_ours",
    sql(
        "cgi_calls clinvar gene_list calls vcf_file",
        f"""SELECT report_id, gene, sample_id, chr, start, alt_call FROM ours WHERE {LISTED}
        AND report_id NOT IN (SELECT report_id FROM theirs WHERE report_id IS NOT NULL)""",
        COHORTS,
    ),
)
def only_ours(t):
    calls = t("cgi_calls").select("sample_id", "chr", "start", "stop", "ref", "allele1seq", "allele2seq", "zygosity")
    known = t("clinvar").select("chrom", "pos", "ref", "alt", "gene", "clin_sig")
    ours = P.cohort_findings(calls, known, t("gene_list").select("gene", "inheritance"), _listed(t))
    return P.only_in(ours, _theirs(t)).select("report_id", "gene", "sample_id", "chr", "start", "alt_call")


@query(
    "only_theirs",
    sql(
        "cgi_calls clinvar gene_list calls vcf_file",
        f"""SELECT report_id, gene, sample_id FROM theirs WHERE {LISTED} AND report_id NOT IN (SELECT report_id FROM ours
        WHERE report_id IS NOT NULL)""",
        COHORTS,
    ),
)
def only_theirs(t):
    theirs = members_in(_theirs(t), _listed(t), ["sample_id"])
    return P.only_in(theirs, _ours(t)).select("report_id", "gene", "sample_id")


@query(
    "strata_mac",
    sql(
        "irg sts",
        """SELECT i.strata_id AS pos, i.subject_id, i.zygosity, s.mac, round(s.mac / 5008 * 100, 9) AS mac_share, i.chrom,
        CAST(i.strata_id // 1000000 AS INT) AS blk_pos FROM irg i JOIN sts s ON i.chrom = s.chrom AND i.strata_id = s.pos""",
    ),
)
def strata_mac(t):
    return strata(t("irg"), t("sts")).drop("adj_mac").withColumn("mac_share", F.round("mac_share", 9))


JOINED = """dbsnp a FULL JOIN kaviar b ON a.chrom = b.chrom AND a.pos = b.pos AND a.ref = b.ref AND a.alt = b.alt"""
KEYS = "coalesce(a.chrom, b.chrom) AS chrom, coalesce(a.pos, b.pos) AS pos, coalesce(a.ref, b.ref) AS ref, coalesce(a.alt, b.alt) AS alt"
BOTH = f"SELECT DISTINCT {KEYS} FROM {JOINED} WHERE a.chrom = '1' AND b.chrom = '1'"


@query(
    "variant_overlap_count",
    sql(
        "dbsnp kaviar",
        f"""SELECT 'tables' AS shape, count(*) AS n FROM ({BOTH}) UNION ALL SELECT 'views', count(*) FROM ({BOTH})
        UNION ALL SELECT 'inner_filter', count(*) FROM ({BOTH})
        UNION ALL SELECT 'outer_filter', count(*) FROM (SELECT DISTINCT {KEYS} FROM {JOINED}) WHERE chrom = '1'""",
    ),
)
def variant_overlap_count(t):
    left, right = t("dbsnp"), t("kaviar")
    counts = [O.variant_overlap_count(left, right, s).select(F.lit(s).alias("shape"), "n") for s in O.SHAPES]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])

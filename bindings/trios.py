"""Trio findings and reports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from bindings.annotation import EFFECT_ROWS
from bindings.labels import STRICT
from bindings.registry import query, sql
from varloom.operators import trio as R
from varloom.operators.aggregates import concat_findings as concat
from varloom.operators.aggregates import summarize_findings as summarize
from varloom.operators.effects import first_effect
from varloom.operators.joins import locate_genes
from varloom.plans import stored as X
from varloom.plans import trio as P
from varloom.session import stage, staging_root
from varloom.sources.writers import save_rows

VIEWS = "calls kaviar clinvar dbnsfp vcf_info genes gene_list"
SAME = "n.chrom = p.chrom AND n.pos = p.pos AND n.ref = p.ref AND n.alt = p.alt"


def _annotated(member: str, family: str, damaging: str) -> str:
    return f"""{EFFECT_ROWS},
  annotated AS (SELECT DISTINCT c.sample_id, c.chrom, c.pos, c.ref, c.alt, c.qual, c.filter, replace(c.gt, '1/2', '0/1') AS gt,
    {member} AS member, {family} AS family_id, l.gene, l.inheritance, l.phenotype, g.strand, k.clin_sig, k.clin_dbn,
    d.sift_pred, d.mutation_assessor_pred, d.cadd_raw, d.dann_score, d.interpro_domain, v.kav_freq, e.effect, e.impact,
    e.feature_id, e.biotype, e.hgvs_c, e.hgvs_p,
    CASE WHEN v.kav_freq < 0.03 OR v.kav_freq IS NULL THEN 'Y' ELSE 'N' END AS kaviar_rare,
    CASE WHEN {STRICT} THEN 'Y' ELSE 'N' END AS clin_patho,
    CASE WHEN {damaging} THEN 'Y' ELSE 'N' END AS predicted_damaging,
    coalesce(({STRICT}) OR ((v.kav_freq < 0.03 OR v.kav_freq IS NULL) AND (e.impact = 'HIGH' OR ({damaging})
      OR d.dann_score >= 0.96)), FALSE) AS predictive, c.var_id
    FROM calls c JOIN genes g ON c.chrom = g.chrom AND c.pos BETWEEN g.txstart AND g.txstop
    JOIN gene_list l ON l.gene = g.gene_name
    LEFT JOIN clinvar k ON c.chrom = k.chrom AND c.pos = k.pos AND c.alt = k.alt
    JOIN dbnsfp d ON c.chrom = d.chrom AND c.pos = d.pos AND c.alt = d.alt
    LEFT JOIN kaviar v ON c.chrom = v.chrom AND c.pos = v.pos AND c.ref = v.ref AND c.alt = v.alt
    JOIN effects e ON c.var_id = e.var_id AND e.effect_no = 0
    WHERE c.chrom NOT IN ('X', 'Y'))"""


CALLS_DAMAGING = "d.sift_pred LIKE '%D%' OR d.mutation_assessor_pred LIKE '%H%'"
ACMG = _annotated("c.member", "c.family_id", CALLS_DAMAGING)
NBS = _annotated(
    "CASE right(c.sample_id, 2) WHEN '01' THEN 'M' WHEN '02' THEN 'F' WHEN '03' THEN 'NB' END",
    "substr(c.sample_id, 1, length(c.sample_id) - 3)",
    f"{CALLS_DAMAGING} OR d.dann_score >= 0.96",
)
CLASSES = f"""
  matched AS (SELECT DISTINCT n.*, p.member AS from_parent FROM annotated n JOIN annotated p ON {SAME}
    AND n.family_id = p.family_id WHERE n.member = 'NB' AND n.predictive AND n.inheritance = 'AR' AND n.gt = '0/1'
    AND p.member IN ('M', 'F') AND p.gt = '0/1'),
  comp AS (SELECT * FROM matched WHERE (gene, family_id) IN (SELECT (gene, family_id) FROM matched GROUP BY gene, family_id
    HAVING count(DISTINCT pos) > 1 AND bool_or(from_parent = 'M') AND bool_or(from_parent = 'F'))),
  findings AS (SELECT *, 'NA' AS from_parent, 'dominant' AS var_class FROM annotated
      WHERE member = 'NB' AND predictive AND inheritance = 'AD'
    UNION ALL SELECT *, 'NA', 'hom_recessive' FROM annotated
      WHERE member = 'NB' AND predictive AND inheritance = 'AR' AND gt = '1/1'
    UNION ALL SELECT *, 'comp_het' FROM comp)"""


def _inputs(t):
    return {
        "regions": locate_genes(t("gene_list"), t("genes")),
        "kaviar": t("kaviar"),
        "clinvar": t("clinvar"),
        "dbnsfp": t("dbnsfp"),
        "effects": first_effect(t("vcf_info").select("chrom", "pos", "ref", "alt", "info")),
    }


def _acmg(t):
    return P.annotate_trios(t("calls"), keep=["member", "family_id"], **_inputs(t))


@query("annotate_trios", sql(VIEWS, "SELECT * FROM annotated", ACMG))
def annotate_trios(t):
    return _acmg(t)


@query(
    "dominant",
    sql(VIEWS, "SELECT * FROM annotated WHERE member = 'NB' AND predictive AND inheritance = 'AD'", ACMG),
)
def dominant(t):
    return R.dominant(_acmg(t))


@query(
    "hom_recessive",
    sql(VIEWS, "SELECT * FROM annotated WHERE member = 'NB' AND predictive AND inheritance = 'AR' AND gt = '1/1'", ACMG),
)
def hom_recessive(t):
    return R.hom_recessive(_acmg(t))


@query("parent_match", sql(VIEWS, "SELECT * FROM matched", ACMG + "," + CLASSES))
def parent_match(t):
    rows = stage(_acmg(t), "trios")
    return R.parent_match(R.het_recessive(rows), R.het_parents(rows))


@query(
    "parent_match_any_family",
    sql(
        "calls",
        """SELECT DISTINCT n.sample_id, n.family_id, n.chrom, n.pos, n.ref, n.alt, p.member AS from_parent FROM calls n
        JOIN (SELECT DISTINCT chrom, pos, ref, alt, member FROM calls WHERE member IN ('M', 'F') AND gt = '0/1') p
        ON n.chrom = p.chrom AND n.pos = p.pos AND n.ref = p.ref AND n.alt = p.alt WHERE n.member = 'NB' AND n.gt = '0/1'""",
    ),
)
def parent_match_any_family(t):
    calls = t("calls")
    newborn = calls.where("member = 'NB' AND gt = '0/1'").select("sample_id", "family_id", "chrom", "pos", "ref", "alt")
    return R.parent_match(newborn, R.het_parents(calls), same_family=False)


@query("compound_hets", sql(VIEWS, "SELECT * FROM comp", ACMG + "," + CLASSES))
def compound_hets(t):
    rows = stage(_acmg(t), "trios")
    return R.compound_hets(R.parent_match(R.het_recessive(rows), R.het_parents(rows)))


@query(
    "concat_findings",
    sql(
        "calls",
        """SELECT sample_id, var_id, 'NA' AS from_parent, 'hom' AS var_class FROM calls WHERE gt = '1/1'
        UNION ALL SELECT sample_id, var_id, member, 'het' FROM calls WHERE gt = '0/1'""",
    ),
)
def concat_findings(t):
    calls = t("calls")
    hom = calls.where("gt = '1/1'").select("sample_id", "var_id")
    het = calls.where("gt = '0/1'").select("sample_id", "var_id", F.col("member").alias("from_parent"))
    return concat(hom=hom, het=het)


@query("acmg_report", sql(VIEWS, "SELECT * FROM findings", ACMG + "," + CLASSES))
def acmg_report(t):
    members = t("calls").select("sample_id", "member").distinct()
    return P.acmg_report(t("calls"), members=members, **_inputs(t))


@query("nbs_report", sql(VIEWS, "SELECT * FROM findings", NBS + "," + CLASSES))
def nbs_report(t):
    return P.nbs_report(t("calls").drop("member", "family_id"), **_inputs(t))


@query(
    "summarize_findings",
    sql(
        VIEWS,
        """SELECT var_class, 'total' AS section, 'all' AS value, count(*) AS n FROM findings GROUP BY ALL
        UNION ALL SELECT var_class, 'phenotype', phenotype, count(*) FROM findings GROUP BY ALL
        UNION ALL SELECT var_class, 'gene', gene, count(*) FROM findings GROUP BY ALL""",
        NBS + "," + CLASSES,
    ),
)
def summarize_findings(t):
    return summarize(P.nbs_report(t("calls").drop("member", "family_id"), **_inputs(t)))


@query(
    "review_findings",
    sql(
        VIEWS,
        """SELECT sample_id, var_id, gene, family_id, var_class, 'not_dominant' AS reason FROM doubtful
          WHERE var_class = 'dominant' AND inheritance <> 'AD'
        UNION ALL SELECT sample_id, var_id, gene, family_id, var_class, 'not_homozygous_recessive' FROM doubtful
          WHERE var_class = 'hom_recessive' AND (inheritance <> 'AR' OR gt <> '1/1')
        UNION ALL SELECT sample_id, var_id, gene, family_id, var_class, 'not_heterozygous_recessive' FROM doubtful
          WHERE var_class = 'comp_het' AND (inheritance <> 'AR' OR gt <> '0/1')
        UNION ALL SELECT sample_id, var_id, gene, family_id, var_class, 'one_position' FROM doubtful WHERE var_class = 'comp_het'
          AND (gene, family_id) IN (SELECT (gene, family_id) FROM matched GROUP BY gene, family_id HAVING count(DISTINCT pos) = 1)
        UNION ALL SELECT sample_id, var_id, gene, family_id, var_class, 'no_mother_variant' FROM doubtful
          WHERE var_class = 'comp_het' AND (gene, family_id) NOT IN (SELECT (gene, family_id) FROM matched WHERE from_parent = 'M')
        UNION ALL SELECT sample_id, var_id, gene, family_id, var_class, 'no_father_variant' FROM doubtful
          WHERE var_class = 'comp_het' AND (gene, family_id) NOT IN (SELECT (gene, family_id) FROM matched WHERE from_parent = 'F')""",
        ACMG
        + ","
        + CLASSES
        + """,
        doubtful AS (SELECT *, 'NA' AS from_parent, 'dominant' AS var_class FROM annotated
            WHERE member = 'NB' AND predictive AND gt = '0/1'
          UNION ALL SELECT *, 'NA', 'hom_recessive' FROM annotated
            WHERE member = 'NB' AND predictive AND gt IS NOT NULL AND inheritance = 'AR'
          UNION ALL SELECT *, 'comp_het' FROM matched)""",
    ),
)
def review_findings(t):
    rows = stage(_acmg(t), "trios")
    newborn = rows.where((F.col("member") == "NB") & F.col("predictive"))
    candidates = stage(R.parent_match(R.het_recessive(rows), R.het_parents(rows)), "candidates")
    findings = concat(
        dominant=newborn.where("gt = '0/1'"),
        hom_recessive=newborn.where("gt IS NOT NULL AND inheritance = 'AR'"),
        comp_het=candidates,
    )
    return R.review_findings(findings).select("sample_id", "var_id", "gene", "family_id", "var_class", "reason")


HIGH_RISK = sql(
        VIEWS + " coding sites",
        f"""SELECT c.sample_id, c.chrom, c.pos, c.ref, c.alt, c.qual, c.dp, replace(c.gt, '1/2', '0/1') AS gt, l.gene, l.inheritance,
        g.txstart + 1000 AS region_start, g.txstop + 1000 AS region_stop, v.kav_freq, k.clin_sig, d.dann_score, e.effect, e.impact
        FROM calls c JOIN genes g ON c.chrom = g.chrom AND c.pos BETWEEN g.txstart + 1000 AND g.txstop + 1000
        JOIN gene_list l ON l.gene = g.gene_name JOIN sites s ON c.var_id = s.var_id
        LEFT JOIN kaviar v ON c.var_id = v.var_id LEFT JOIN clinvar k ON c.var_id = k.var_id
        LEFT JOIN dbnsfp d ON c.var_id = d.var_id JOIN coding e ON c.var_id = e.var_id
        WHERE c.qual >= 30 AND c.dp >= 10 AND c.gt IS NOT NULL
        AND (((v.kav_freq < 0.01 OR v.kav_freq IS NULL) AND e.impact = 'HIGH') OR ({STRICT}))""",
    )


@query("nbs_high_risk", HIGH_RISK)
def nbs_high_risk(t):
    key = ["chrom", "pos", "ref", "alt"]
    known = t("sites").select(*key)
    for table, column in {"kaviar": "kav_freq", "clinvar": "clin_sig", "dbnsfp": "dann_score"}.items():
        known = known.join(t(table).select(*key, column), key, "left")
    calls = t("calls").select("sample_id", *key, "blk_pos", "qual", "dp", "gt")
    regions = locate_genes(t("gene_list"), t("genes")).drop("strand", "phenotype")
    return P.nbs_high_risk(calls, regions, known, t("coding").select(*key, "effect", "impact")).drop("blk_pos")


@query("high_risk_stored", HIGH_RISK)
def high_risk_stored(t):
    """The same report over stored tables with statistics and histograms."""
    key = ["chrom", "pos", "ref", "alt"]
    known = t("sites").select(*key)
    for table, column in {"kaviar": "kav_freq", "clinvar": "clin_sig", "dbnsfp": "dann_score"}.items():
        known = known.join(t(table).select(*key, column), key, "left")
    regions = locate_genes(t("gene_list"), t("genes")).drop("strand", "phenotype")
    tables = {
        "calls": t("calls").select("sample_id", *key, "qual", "dp", "gt"),
        "located": X.locate_variants(known, regions, shift=1000),
        "variants": known,
        "coding": t("coding").select(*key, "effect", "impact"),
    }
    names = {n: f"{n}_{uuid.uuid4().hex}" for n in tables}
    for n, rows in tables.items():
        save_rows(rows, names[n], path=f"{staging_root(t.spark)}/{names[n]}")
    X.analyze(t.spark, *names.values())
    with X.session_settings(t.spark, X.COST_BASED):
        return stage(X.high_risk_stored(t.spark, *[names[n] for n in ("calls", "located", "variants", "coding")]), "high-risk")

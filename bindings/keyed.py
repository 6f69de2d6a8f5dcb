"""Equality joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import query, sql
from varloom import schema as S
from varloom.functions.columns import dosage
from varloom.operators import aggregates as A
from varloom.operators import joins as J
from varloom.operators.statistics import sample_dosages

SAME = "{a}.chrom = {b}.chrom AND {a}.pos = {b}.pos AND {a}.ref = {b}.ref AND {a}.alt = {b}.alt"


@query(
    "join_on_variant",
    sql(
        "calls clinvar",
        f"""SELECT c.sample_id, c.chrom, c.pos, c.ref, c.alt, k.clin_sig, k.gene FROM calls c JOIN clinvar k
        ON {SAME.format(a='c', b='k')}""",
    ),
)
def join_on_variant(t):
    calls = t("calls").select("sample_id", *S.VARIANT_KEY)
    return J.join_on_variant(calls, t("clinvar").select(*S.VARIANT_KEY, "clin_sig", "gene"))


def _annotation(name: str, columns: dict[str, str], step):
    picked = ", ".join(f"a.{old} AS {new}" for old, new in columns.items())
    oracle = sql(
        f"sites {name}",
        f"""SELECT s.var_id, s.chrom, s.blk_pos, s.pos, {picked} FROM sites s LEFT JOIN {name} a
        ON s.var_id = a.var_id""",
    )

    @query(f"annotate_{name}", oracle)
    def run(t):
        return step(t("sites").select("var_id", "chrom", "blk_pos", "pos"), t(name))


_annotation("dbsnp", {"rs_id": "rs_id", "dbsnp_buildid": "dbsnp_buildid"}, J.annotate_dbsnp)
_annotation("kaviar", {"kav_freq": "kav_freq", "kav_source": "kav_source"}, J.annotate_kaviar)
_annotation("clinvar", {"clin_sig": "clin_sig", "clin_dbn": "clin_dbn"}, J.annotate_clinvar)
_annotation("hgmd", {"id": "hgmd_id", "var_class": "hgmd_varclass"}, J.annotate_hgmd)
_annotation(
    "dbnsfp",
    {"cadd_raw": "cadd_raw", "dann_score": "dann_score", "interpro_domain": "interpro_domain"},
    J.annotate_dbnsfp,
)


@query(
    "left_join_variant",
    sql(
        "calls kaviar",
        f"""SELECT c.sample_id, c.chrom, c.pos, c.ref, c.alt, k.kav_freq FROM calls c LEFT JOIN kaviar k
        ON {SAME.format(a='c', b='k')}""",
    ),
)
def left_join_variant(t):
    calls = t("calls").select("sample_id", *S.VARIANT_KEY)
    return J.left_join_variant(calls, t("kaviar").select(*S.VARIANT_KEY, "kav_freq"))


@query(
    "join_locus_alt",
    sql(
        "calls clinvar dbnsfp",
        """SELECT c.sample_id, c.chrom, c.pos, c.alt, k.clin_sig, d.dann_score FROM calls c
        LEFT JOIN clinvar k ON c.chrom = k.chrom AND c.pos = k.pos AND c.alt = k.alt
        JOIN dbnsfp d ON c.chrom = d.chrom AND c.pos = d.pos AND c.alt = d.alt""",
    ),
)
def join_locus_alt(t):
    calls = t("calls").select("sample_id", *S.LOCUS_ALT_KEY)
    known = J.join_locus_alt(calls, t("clinvar").select(*S.LOCUS_ALT_KEY, "clin_sig"), "left")
    return J.join_locus_alt(known, t("dbnsfp").select(*S.LOCUS_ALT_KEY, "dann_score"), "inner")


@query(
    "locate_genes",
    sql(
        "gene_list genes",
        """SELECT DISTINCT l.gene, l.inheritance, l.phenotype, g.chrom, g.txstart, g.txstop, g.strand
        FROM gene_list l JOIN genes g ON l.gene = g.gene_name""",
    ),
)
def locate_genes(t):
    return J.locate_genes(t("gene_list"), t("genes"))


@query(
    "full_merge_variants",
    sql(
        "dbsnp kaviar",
        f"""SELECT DISTINCT coalesce(a.chrom, b.chrom) AS chrom, coalesce(a.pos, b.pos) AS pos, coalesce(a.ref, b.ref) AS ref,
        coalesce(a.alt, b.alt) AS alt FROM dbsnp a FULL JOIN kaviar b ON {SAME.format(a='a', b='b')}""",
    ),
)
def full_merge_variants(t):
    return J.full_merge_variants(t("dbsnp"), t("kaviar"))


@query(
    "unmatched_ids",
    sql(
        "calls vcf_file",
        """SELECT a.subject_id AS left_subject_id, b.subject_id AS right_subject_id
        FROM (SELECT DISTINCT subject_id FROM calls) a FULL JOIN (SELECT DISTINCT subject_id FROM vcf_file) b
        ON a.subject_id = b.subject_id WHERE a.subject_id IS NULL OR b.subject_id IS NULL""",
    ),
)
def unmatched_ids(t):
    return J.unmatched_ids(t("calls"), t("vcf_file"), "subject_id")


@query(
    "members_in",
    sql("calls vcf_file", "SELECT subject_id, var_id FROM calls WHERE subject_id IN (SELECT subject_id FROM vcf_file)"),
)
def members_in(t):
    return J.members_in(t("calls").select("subject_id", "var_id"), t("vcf_file"), ["subject_id"])


@query(
    "members_not_in",
    sql(
        "calls vcf_file",
        """SELECT subject_id, var_id FROM calls c
        WHERE NOT EXISTS (SELECT 1 FROM vcf_file f WHERE f.subject_id = c.subject_id)""",
    ),
)
def members_not_in(t):
    return J.members_not_in(t("calls").select("subject_id", "var_id"), t("vcf_file"), ["subject_id"])


@query(
    "exists_predicates",
    sql(
        "calls clinvar hgmd",
        f"""SELECT c.sample_id, c.var_id FROM calls c WHERE EXISTS (SELECT 1 FROM clinvar k WHERE {SAME.format(a='c', b='k')})
        AND NOT EXISTS (SELECT 1 FROM hgmd h WHERE {SAME.format(a='c', b='h')})""",
    ),
)
def exists_predicates(t):
    calls = t("calls").select("sample_id", "var_id", *S.VARIANT_KEY)
    listed = J.exists_predicates(calls, t("clinvar"), S.VARIANT_KEY)
    return J.exists_predicates(listed, t("hgmd"), S.VARIANT_KEY, negate=True).select("sample_id", "var_id")


@query(
    "join_coding",
    sql(
        "sites coding",
        """SELECT s.var_id, s.chrom, s.blk_pos, e.effect, e.impact FROM sites s LEFT JOIN coding e ON s.var_id = e.var_id""",
    ),
)
def join_coding(t):
    effects = t("coding").select("chrom", "blk_pos", "var_id", "effect", "impact")
    return J.join_coding(t("sites").select("var_id", "chrom", "blk_pos"), effects)


@query(
    "map_population",
    sql(
        "vcf_file panel",
        """SELECT f.subject_id AS sample, coalesce(p.super_pop, '-') AS super_pop, coalesce(p.pop, '-') AS sub_pop
        FROM vcf_file f LEFT JOIN panel p ON f.subject_id = p.sample""",
    ),
)
def map_population(t):
    samples, panel = t("vcf_file").select(F.col("subject_id").alias("sample")), t("panel")
    wide = J.map_population(samples, panel, "super").withColumnRenamed("known_pop", "super_pop")
    return J.map_population(wide, panel, "sub").withColumnRenamed("known_pop", "sub_pop")


@query(
    "attach_subject",
    sql(
        "admix_q vcf_file",
        """SELECT q.q1, q.q2, 'vendor_' || q.sample AS vendor_id, f.subject_id FROM admix_q q
        LEFT JOIN vcf_file f ON 'vendor_' || q.sample = f.genome""",
    ),
)
def attach_subject(t):
    vendor = F.concat(F.lit("vendor_"), F.col("sample").cast("string"))
    return J.attach_subject(t("admix_q").select("q1", "q2", vendor.alias("vendor_id")), t("vcf_file"))


@query(
    "strata_join",
    sql(
        "irg sts",
        """SELECT i.chrom, i.strata_id AS pos, i.subject_id, i.zygosity, s.mac FROM irg i JOIN sts s
        ON i.chrom = s.chrom AND i.strata_id = s.pos""",
    ),
)
def strata_join(t):
    return J.strata_join(t("irg"), t("sts"))


@query(
    "zip_columns",
    sql(
        "admix_q panel",
        "SELECT q.sample, q.q1, q.q2, p.pop, p.super_pop, p.gender FROM admix_q q JOIN panel p ON q.sample = p.sample",
    ),
)
def zip_columns(t):
    return J.zip_columns(t("admix_q"), t("panel"), "sample")


@query(
    "union_distinct_variants",
    sql(
        "calls dbnsfp kaviar clinvar dbsnp hgmd",
        "\nUNION\n".join(
            f"SELECT chrom, blk_pos, pos, ref, alt AS allele FROM {name}"
            for name in ("calls", "dbnsfp", "kaviar", "clinvar", "dbsnp", "hgmd")
        ),
    ),
)
def union_distinct_variants(t):
    return A.union_distinct_variants(*[t(n) for n in ("calls", "dbnsfp", "kaviar", "clinvar", "dbsnp", "hgmd")])


@query(
    "append_subject",
    sql("panel", "SELECT sample AS family, sample FROM panel UNION ALL SELECT -1, -1"),
)
def append_subject(t):
    listed = t("panel").select(F.col("sample").alias("family"), "sample")
    return A.append_subject(listed, "-1")


@query(
    "merge_genotypes",
    sql(
        "calls panel",
        f"""SELECT * FROM both_sets b WHERE EXISTS (SELECT 1 FROM known k WHERE {SAME.format(a='b', b='k')})
        AND EXISTS (SELECT 1 FROM others o WHERE {SAME.format(a='b', b='o')})""",
        """one AS (SELECT subject_id, chrom, pos, ref, alt, max(CASE WHEN gt = '1/1' THEN 2 ELSE 1 END) AS dosage
             FROM calls WHERE gt IS NOT NULL GROUP BY ALL),
        known AS (SELECT * FROM one WHERE subject_id IN (SELECT sample FROM panel)),
        others AS (SELECT * FROM one WHERE subject_id NOT IN (SELECT sample FROM panel)),
        both_sets AS (SELECT * FROM known UNION ALL SELECT * FROM others)""",
    ),
)
def merge_genotypes(t):
    dosages = sample_dosages(dosage(t("calls")))
    samples = t("panel").select(F.col("sample").alias("subject_id"))
    return A.merge_genotypes(
        J.members_in(dosages, samples, ["subject_id"]), J.members_not_in(dosages, samples, ["subject_id"])
    )


@query(
    "difference",
    sql(
        "calls",
        """SELECT chrom, pos, ref, alt FROM calls WHERE member = 'NB' AND (chrom, pos, ref, alt) NOT IN
        (SELECT (chrom, pos, ref, alt) FROM calls WHERE member = 'M' AND qual > 40)""",
    ),
)
def difference(t):
    calls = t("calls")
    return A.difference(
        calls.where("member = 'NB'").select(*S.VARIANT_KEY), calls.where("member = 'M' AND qual > 40").select(*S.VARIANT_KEY)
    )

"""Derived columns and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import query, sql
from varloom.functions import columns as C
from varloom.functions import predicates as P

STRICT = "NOT regexp_matches(clin_sig, '3|2[^5]|2$') AND regexp_matches(clin_sig, '4|[^25]5|^5')"


@query("project", sql("calls", "SELECT sample_id AS sample, chrom, pos, gt AS genotype FROM calls"))
def project(t):
    return t("calls").select(F.col("sample_id").alias("sample"), "chrom", "pos", F.col("gt").alias("genotype"))


@query(
    "with_var_id",
    sql("calls", "SELECT sample_id, chrom || ':' || pos || ':' || ref || ':' || alt AS var_id FROM calls"),
)
def with_var_id(t):
    return C.with_var_id(t("calls").drop("var_id")).select("sample_id", "var_id")


@query(
    "with_blk_pos",
    sql("calls", "SELECT chrom, pos, CAST(pos // 1000000 AS INT) AS blk_pos, CAST(pos // 100000 AS INT) AS fine FROM calls"),
)
def with_blk_pos(t):
    df = C.with_blk_pos(t("calls").select("chrom", "pos"))
    return C.with_blk_pos(df, 100_000, name="fine")


@query(
    "with_var_type",
    sql(
        "calls",
        """SELECT var_id, CASE WHEN length(ref) > length(alt) THEN 'deletion' WHEN length(ref) < length(alt) THEN 'insertion'
        WHEN length(ref) = length(alt) THEN 'snv' ELSE 'other' END AS var_type FROM calls""",
    ),
)
def with_var_type(t):
    return C.with_var_type(t("calls")).select("var_id", "var_type")


PPC = """CASE
  WHEN length(ref) = length({alt}) AND effect IN ('codings_sequence_variant', 'chromosome', 'missense_variant',
    'initator_codon_variant', 'stop_retained_variant', 'transcript_variant') THEN 'non-synonymous'
  WHEN length(ref) <> length({alt}) AND effect = 'frameshift_variant' THEN 'frameshift-non-synonymous'
  WHEN length(ref) > length({alt}) AND effect = 'disruptive_inframe_insertion' THEN 'non-synonymous'
  WHEN length(ref) < length({alt}) AND effect = 'disruptive_inframe_deletion' THEN 'non-synonymous'
  ELSE 'synonymous' END"""


@query("with_ppc_rating", sql("coding", f"SELECT var_id, effect, {PPC.format(alt='alt')} AS ppc_rating FROM coding"))
def with_ppc_rating(t):
    return C.with_ppc_rating(t("coding")).select("var_id", "effect", "ppc_rating")


@query(
    "with_kaviar_rare",
    sql(
        "sites kaviar",
        """SELECT s.var_id, k.kav_freq, CASE WHEN k.kav_freq < 0.03 OR k.kav_freq IS NULL THEN 'Y' ELSE 'N' END AS kaviar_rare
        FROM sites s LEFT JOIN kaviar k ON s.var_id = k.var_id""",
    ),
)
def with_kaviar_rare(t):
    listed = t("sites").select("var_id").join(t("kaviar").select("var_id", "kav_freq"), "var_id", "left")
    return C.with_kaviar_rare(listed, 0.03)


@query(
    "with_clin_patho",
    sql(
        "sites clinvar",
        f"""SELECT s.var_id, clin_sig, CASE WHEN {STRICT} THEN 'Y' ELSE 'N' END AS clin_patho,
        CASE WHEN NOT regexp_matches(clin_sig, '3|2[^5]') AND regexp_matches(clin_sig, '4|[^25]5') THEN 'Y' ELSE 'N' END AS loose
        FROM sites s LEFT JOIN clinvar c ON s.var_id = c.var_id""",
    ),
)
def with_clin_patho(t):
    listed = t("sites").select("var_id").join(t("clinvar").select("var_id", "clin_sig"), "var_id", "left")
    strict = C.with_clin_patho(listed)
    loose = C.with_clin_patho(strict.withColumnRenamed("clin_patho", "strict"), patterns=C.S.PATHOGENIC_LOOSE)
    return loose.select("var_id", "clin_sig", F.col("strict").alias("clin_patho"), F.col("clin_patho").alias("loose"))


@query(
    "with_predicted_damaging",
    sql(
        "dbnsfp",
        """SELECT var_id, CASE WHEN sift_pred LIKE '%D%' OR mutation_assessor_pred LIKE '%H%' THEN 'Y' ELSE 'N' END AS by_calls,
        CASE WHEN sift_pred LIKE '%D%' OR mutation_assessor_pred LIKE '%H%' OR dann_score >= 0.96 THEN 'Y' ELSE 'N' END AS by_all
        FROM dbnsfp""",
    ),
)
def with_predicted_damaging(t):
    calls = C.with_predicted_damaging(t("dbnsfp")).withColumnRenamed("predicted_damaging", "by_calls")
    both = C.with_predicted_damaging(calls, dann=0.96).withColumnRenamed("predicted_damaging", "by_all")
    return both.select("var_id", "by_calls", "by_all")


@query(
    "with_member",
    sql(
        "calls",
        """SELECT sample_id, CASE right(sample_id, 2) WHEN '01' THEN 'M' WHEN '02' THEN 'F' WHEN '03' THEN 'NB' END AS member,
        member AS looked_up FROM calls""",
    ),
)
def with_member(t):
    calls = t("calls")
    lookup = calls.select("sample_id", "member").distinct()
    by_suffix = C.with_member(calls.select("sample_id")).withColumnRenamed("member", "by_suffix")
    both = C.with_member_lookup(by_suffix, lookup).withColumnRenamed("member", "looked_up")
    return both.select("sample_id", F.col("by_suffix").alias("member"), "looked_up")


@query(
    "with_family_id",
    sql(
        "calls",
        """SELECT sample_id, substr(sample_id, 1, length(sample_id) - 3) AS family_id, substr(sample_id, 7) AS tail
        FROM calls""",
    ),
)
def with_family_id(t):
    tail = C.with_family_id(t("calls").select("sample_id"), start=7).withColumnRenamed("family_id", "tail")
    return C.with_family_id(tail)


@query(
    "with_alt_call",
    sql(
        "cgi_calls clinvar",
        """SELECT sample_id, c.alt, allele1seq, allele2seq, CASE WHEN c.alt = allele1seq AND c.alt = allele2seq THEN 'hom_alt'
        WHEN c.alt <> allele1seq AND c.alt <> allele2seq THEN 'hom_ref' ELSE 'other' END AS alt_call
        FROM cgi_calls g JOIN clinvar c ON g.chr = c.chrom AND g.start = c.pos""",
    ),
)
def with_alt_call(t):
    calls, known = t("cgi_calls"), t("clinvar").select("chrom", "pos", "alt")
    at_site = calls.join(known, (calls.chr == known.chrom) & (calls.start == known.pos))
    return C.with_alt_call(at_site).select("sample_id", "alt", "allele1seq", "allele2seq", "alt_call")


@query(
    "allele_flags",
    sql(
        "cgi_calls",
        """SELECT sample_id, chr || ':' || start || ':' || stop AS locus,
        CASE WHEN allele1seq <> ref THEN 1 ELSE 0 END AS allele1_alt_count,
        CASE WHEN allele2seq <> ref THEN 1 ELSE 0 END AS allele2_alt_count FROM cgi_calls""",
    ),
)
def allele_flags(t):
    flagged = C.allele_flags(t("cgi_calls"))
    return flagged.select(
        "sample_id", C.locus_text("chr", "start", "stop").alias("locus"), "allele1_alt_count", "allele2_alt_count"
    )


@query("normalize_gt", sql("calls", "SELECT sample_id, var_id, replace(gt, '1/2', '0/1') AS gt FROM calls"))
def normalize_gt(t):
    return C.normalize_gt(t("calls")).select("sample_id", "var_id", "gt")


@query("add_chr_prefix", sql("sites", "SELECT var_id, 'chr' || chrom AS chrom FROM sites"))
def add_chr_prefix(t):
    return C.add_chr_prefix(t("sites")).select("var_id", "chrom")


@query(
    "strip_chr_prefix",
    sql(
        "sites",
        "SELECT var_id, raw_chrom, replace(replace(raw_chrom, 'chrMT', 'M'), 'chr', '') AS chrom FROM named",
        "named AS (SELECT var_id, CASE WHEN chrom = 'M' THEN 'chrMT' ELSE 'chr' || chrom END AS raw_chrom FROM sites)",
    ),
)
def strip_chr_prefix(t):
    raw = F.when(F.col("chrom") == "M", "chrMT").otherwise(F.concat(F.lit("chr"), "chrom"))
    named = t("sites").select("var_id", raw.alias("raw_chrom"), raw.alias("chrom"))
    return C.strip_chr_prefix(named)


@query(
    "adjusted_mac",
    sql("sts", "SELECT chrom, pos, mac, round(mac / 5008 * 100, 9) AS mac_share, TRUE AS jitter_in_range FROM sts"),
)
def adjusted_mac(t):
    share = C.adjusted_mac(t("sts"), seed=11)
    jitter = F.col("adj_mac") - F.col("mac_share")
    return share.select(
        "chrom", "pos", "mac", F.round("mac_share", 9).alias("mac_share"),
        jitter.between(-1e-9, 100 / 5008 + 1e-9).alias("jitter_in_range"),
    )


@query(
    "clean_gene_list",
    sql(
        "clinvar",
        """SELECT gene AS Gene_Name, replace(replace(clin_dbn || ',a;b', ',', ':'), ';', ':') AS condition_,
        clin_sig AS rating, CASE WHEN clin_sig = '5' THEN 'red' END AS level FROM clinvar""",
    ),
)
def clean_gene_list(t):
    raw = t("clinvar").select(
        F.col("gene").alias("Gene Name"),
        F.concat("clin_dbn", F.lit(",a;b")).alias("condition (#)"),
        F.col("clin_sig").alias("rating"),
    )
    return C.clean_gene_list(raw, F.when(F.col("rating") == "5", "red"))


@query(
    "label_predictive",
    sql(
        "sites kaviar clinvar dbnsfp coding",
        f"""SELECT s.var_id, coalesce(({STRICT}) OR ((kav_freq < 0.03 OR kav_freq IS NULL) AND (impact = 'HIGH'
          OR sift_pred LIKE '%D%' OR mutation_assessor_pred LIKE '%H%' OR dann_score >= 0.96)), FALSE) AS predictive
        FROM sites s LEFT JOIN kaviar k ON s.var_id = k.var_id LEFT JOIN clinvar c ON s.var_id = c.var_id
        LEFT JOIN dbnsfp d ON s.var_id = d.var_id LEFT JOIN coding e ON s.var_id = e.var_id""",
    ),
)
def label_predictive(t):
    df = t("sites").select("var_id")
    for table, names in {
        "kaviar": ["kav_freq"],
        "clinvar": ["clin_sig"],
        "dbnsfp": ["sift_pred", "mutation_assessor_pred", "dann_score"],
        "coding": ["impact"],
    }.items():
        df = df.join(t(table).select("var_id", *names), "var_id", "left")
    labelled = C.with_predicted_damaging(C.with_clin_patho(C.with_kaviar_rare(df)))
    return P.label_predictive(labelled, 0.96).select("var_id", "predictive")

"""Counts, orders and quality checks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from bindings.registry import query, sql
from varloom import schema as S
from varloom.operators import aggregates as A
from varloom.operators import quality as Q
from varloom.operators import sketches as K
from varloom.operators.joins import join_on_variant
from varloom.session import staging_root

CHROMS = ", ".join(f"('{c}')" for c in S.CHROMOSOMES if c != "M")


@query(
    "count_rows",
    sql(
        "calls clinvar",
        """SELECT 'calls' AS source, count(*) AS n FROM calls UNION ALL SELECT 'pathogenic', count(*) FROM calls c
        JOIN clinvar k ON c.var_id = k.var_id WHERE k.clin_sig IN ('4', '5')""",
    ),
)
def count_rows(t):
    key = t("calls").select(*S.VARIANT_KEY)
    known = t("clinvar").where(F.col("clin_sig").isin("4", "5")).select(*S.VARIANT_KEY)
    counts = {"calls": A.count_rows(key), "pathogenic": A.count_rows(join_on_variant(key, known))}
    a, b = [df.select(F.lit(name).alias("source"), "n") for name, df in counts.items()]
    return a.unionByName(b)


@query(
    "count_distinct_samples",
    sql(
        "calls clinvar",
        """SELECT count(DISTINCT c.sample_id) AS n_samples FROM calls c JOIN clinvar k ON c.var_id = k.var_id
        WHERE k.clin_sig IN ('4', '5')""",
    ),
)
def count_distinct_samples(t):
    known = t("clinvar").where(F.col("clin_sig").isin("4", "5")).select(*S.VARIANT_KEY)
    return A.count_distinct_samples(join_on_variant(t("calls").select("sample_id", *S.VARIANT_KEY), known))


@query(
    "sample_sketches",
    sql(
        "calls",
        """SELECT chrom, n_samples, true AS near, true AS same FROM (
          SELECT chrom, count(DISTINCT sample_id) AS n_samples FROM calls GROUP BY chrom
          UNION ALL SELECT 'all', count(DISTINCT sample_id) FROM calls)""",
    ),
)
def sample_sketches(t):
    """Sketches per position block, stored in two batches, merged by block and chromosome or at once, beside the exact count.

    ``near``: the estimate is within 3 percent of the exact count; ``same``: merging in steps gives the same estimate.
    """
    path = f"{staging_root(t.spark)}/sketches-{uuid.uuid4().hex}"
    calls = t("calls").select("chrom", "blk_pos", "sample_id", "filter")
    K.add_sketches(calls.where("filter = 'PASS'"), path)
    K.add_sketches(calls.where("filter <> 'PASS'"), path)
    stored = t.spark.read.schema("chrom string, blk_pos int, sketch binary").parquet(path)
    by_block = K.merge_sketches(stored, ["chrom", "blk_pos"])
    whole = F.lit("all").alias("chrom")
    in_steps = K.merge_sketches(by_block, ["chrom"])
    in_steps = in_steps.unionByName(K.merge_sketches(in_steps).select(whole, "sketch"))
    at_once = K.merge_sketches(stored, ["chrom"]).unionByName(K.merge_sketches(stored).select(whole, "sketch"))
    exact = calls.groupBy("chrom").agg(F.countDistinct("sample_id").alias("n_samples"))
    exact = exact.unionByName(calls.agg(F.countDistinct("sample_id").alias("n_samples")).select(whole, "n_samples"))
    found = exact.join(K.estimated_samples(in_steps, "stepped"), "chrom").join(K.estimated_samples(at_once, "direct"), "chrom")
    near = F.abs(F.col("direct") - F.col("n_samples")) * 100 <= F.col("n_samples") * 3
    return found.select("chrom", "n_samples", near.alias("near"), (F.col("stepped") == F.col("direct")).alias("same"))


@query("count_by_chrom", sql("calls", "SELECT chrom, count(*) AS n FROM calls GROUP BY chrom"))
def count_by_chrom(t):
    return A.count_by_chrom(t("calls"))


@query(
    "groups_below",
    sql(
        "calls",
        """SELECT chrom, member, count(*) AS n, 'below' AS side FROM calls GROUP BY ALL HAVING count(*) < (SELECT avg(n) FROM sizes)
        UNION ALL SELECT chrom, member, count(*), 'above' FROM calls GROUP BY ALL HAVING count(*) > (SELECT avg(n) FROM sizes)""",
        "sizes AS (SELECT count(*) AS n FROM calls GROUP BY chrom, member)",
    ),
)
def groups_below(t):
    calls, keys = t("calls"), ["chrom", "member"]
    mean = calls.groupBy(*keys).count().agg(F.avg("count")).first()[0]
    below = A.groups_below(calls, keys, mean).withColumn("side", F.lit("below"))
    return below.unionByName(A.groups_above(calls, keys, mean).withColumn("side", F.lit("above")))


@query("distinct_variants", sql("calls", "SELECT DISTINCT chrom, pos, ref, alt FROM calls"))
def distinct_variants(t):
    return A.distinct_variants(t("calls"))


@query("order_desc", sql("feature_fm", "SELECT * FROM feature_fm WHERE feature_id LIKE '%METH%' ORDER BY chr DESC, feature_id"))
def order_desc(t):
    return A.order_desc(t("feature_fm"), "feature_id", "%METH%", "chr", then=["feature_id"])


@query("preview", sql("feature_fm", "SELECT * FROM feature_fm ORDER BY feature_id LIMIT 5"))
def preview(t):
    return A.preview(t("feature_fm"), ["feature_id"], 5)


@query("sort_panel", sql("panel", "SELECT * FROM panel ORDER BY super_pop, pop, sample"))
def sort_panel(t):
    return A.sort_panel(t("panel"))


@query("marker_list", sql("calls", "SELECT DISTINCT 'chr' || chrom AS chrom, pos FROM calls ORDER BY 1, 2"))
def marker_list(t):
    return A.marker_list(t("calls"))


@query(
    "sort_by_reference",
    sql(
        "calls admix_q",
        """SELECT c.subject_id AS sample, c.var_id, q.sample % 7 AS rank FROM calls c JOIN admix_q q ON c.subject_id = q.sample
        ORDER BY rank, sample, var_id""",
    ),
)
def sort_by_reference(t):
    order = t("admix_q").select("sample", (F.col("sample") % 7).alias("rank"))
    calls = t("calls").select(F.col("subject_id").alias("sample"), "var_id")
    return A.sort_by_reference(calls, order, then=["sample", "var_id"])


# --- checks ---------------------------------------------------------------------------------------------------------


@query("check_not_null", sql("calls", "SELECT sample_id, var_id, gt FROM calls WHERE chrom IS NULL OR gt IS NULL"))
def check_not_null(t):
    return Q.check_not_null(t("calls"), ["chrom", "gt"]).select("sample_id", "var_id", "gt")


@query(
    "check_chrom_set",
    sql(
        "calls",
        f"""SELECT coalesce(f.chrom, e.c) AS chrom, CASE WHEN f.chrom IS NULL THEN 'missing' ELSE 'unexpected' END AS problem
        FROM (SELECT DISTINCT chrom FROM calls) f
        FULL JOIN (VALUES {CHROMS}, ('MT')) e(c) ON f.chrom = e.c WHERE f.chrom IS NULL OR e.c IS NULL""",
    ),
)
def check_chrom_set(t):
    return Q.check_chrom_set(t("calls"), [*[c for c in S.CHROMOSOMES if c != "M"], "MT"])


@query(
    "check_min_rows",
    sql(
        "calls",
        """SELECT chrom, count(*) AS n FROM calls GROUP BY chrom
        HAVING count(*) < CASE chrom WHEN 'M' THEN 100 WHEN 'X' THEN 1000000 ELSE (SELECT count(*) // 25 FROM calls) END""",
    ),
)
def check_min_rows(t):
    return Q.check_min_rows(t("calls"), n=t("calls").count() // 25, other={"M": 100, "X": 1_000_000})


@query(
    "check_no_chr_prefix",
    sql("calls", "SELECT sample_id, chrom FROM named WHERE lower(chrom) LIKE '%chr%'",
        "named AS (SELECT sample_id, CASE WHEN qual > 40 THEN 'Chr' || chrom ELSE chrom END AS chrom FROM calls)"),
)
def check_no_chr_prefix(t):
    named = F.when(F.col("qual") > 40, F.concat(F.lit("Chr"), "chrom")).otherwise(F.col("chrom"))
    return Q.check_no_chr_prefix(t("calls").select("sample_id", named.alias("chrom")))


@query(
    "check_mt_renamed",
    sql("calls", "SELECT sample_id, chrom FROM named WHERE chrom = 'MT' OR chrom = 'mt'",
        "named AS (SELECT sample_id, CASE WHEN chrom = 'M' AND qual > 25 THEN 'mt' ELSE chrom END AS chrom FROM calls)"),
)
def check_mt_renamed(t):
    named = F.when((F.col("chrom") == "M") & (F.col("qual") > 25), "mt").otherwise(F.col("chrom"))
    return Q.check_mt_renamed(t("calls").select("sample_id", named.alias("chrom")))


ALLELES = """named AS (SELECT sample_id, var_id, CASE WHEN qual > 45 THEN alt || '[7:5[' WHEN qual < 5 THEN lower(alt)
  ELSE alt END AS alt FROM calls)"""


def _named_alleles(t):
    alt = F.col("alt")
    text = F.when(F.col("qual") > 45, F.concat(alt, F.lit("[7:5["))).when(F.col("qual") < 5, F.lower(alt)).otherwise(alt)
    return t("calls").select("sample_id", "var_id", text.alias("alt"))


@query(
    "check_allele_alphabet",
    sql("calls", "SELECT * FROM named WHERE regexp_replace(alt, 'A|T|G|C|N|\\.', '', 'g') <> ''", ALLELES),
)
def check_allele_alphabet(t):
    return Q.check_allele_alphabet(_named_alleles(t))


@query("check_no_brackets", sql("calls", "SELECT * FROM named WHERE instr(alt, '[') <> 0 OR instr(alt, ']') <> 0", ALLELES))
def check_no_brackets(t):
    return Q.check_no_brackets(_named_alleles(t))


@query(
    "check_max_alleles",
    sql(
        "calls",
        """SELECT chrom, pos, ref, alt, subject_id, sample_id, count(*) AS n FROM calls
        WHERE length(ref) = length(alt) AND alt <> '.' GROUP BY ALL HAVING count(*) > 2""",
    ),
)
def check_max_alleles(t):
    return Q.check_max_alleles(t("calls"))


@query(
    "check_subjects_loaded",
    sql(
        "calls vcf_file",
        """SELECT a.subject_id AS left_subject_id, b.subject_id AS right_subject_id
        FROM (SELECT DISTINCT subject_id FROM calls) a FULL JOIN vcf_file b ON a.subject_id = b.subject_id
        WHERE a.subject_id IS NULL OR b.subject_id IS NULL""",
    ),
)
def check_subjects_loaded(t):
    return Q.check_subjects_loaded(t("calls"), t("vcf_file"))


@query(
    "check_chroms_per_subject",
    sql(
        "calls",
        "SELECT subject_id, count(DISTINCT chrom) AS n_chroms FROM calls GROUP BY subject_id HAVING count(DISTINCT chrom) < 25",
    ),
)
def check_chroms_per_subject(t):
    return Q.check_chroms_per_subject(t("calls"))


@query(
    "check_known_position",
    sql(
        "dbsnp",
        """SELECT rs_id, chrom, pos FROM named WHERE rs_id = 'rsX' AND NOT (chrom = '1' AND pos = 5)""",
        "named AS (SELECT CASE WHEN chrom IN ('1', '2') THEN 'rsX' ELSE rs_id END AS rs_id, chrom, pos FROM dbsnp)",
    ),
)
def check_known_position(t):
    rs_id = F.when(F.col("chrom").isin("1", "2"), "rsX").otherwise(F.col("rs_id"))
    return Q.check_known_position(t("dbsnp").select(rs_id.alias("rs_id"), "chrom", "pos"), "rsX", "1", 5)


@query(
    "check_not_shrunk",
    sql(
        "sites dbsnp hgmd",
        """SELECT * FROM (SELECT 'joined' AS step, (SELECT count(*) FROM sites) AS n_previous,
          (SELECT count(*) FROM sites s LEFT JOIN hgmd h ON s.var_id = h.var_id) AS n_following
        UNION ALL SELECT 'filtered', (SELECT count(*) FROM sites), (SELECT count(*) FROM dbsnp))
        WHERE n_following < n_previous OR n_previous < 1000""",
    ),
)
def check_not_shrunk(t):
    sites = t("sites").select("var_id")
    steps = {"joined": sites.join(t("hgmd").select("var_id"), "var_id", "left"), "filtered": t("dbsnp").select("var_id")}
    a, b = [Q.check_not_shrunk(sites, df).select(F.lit(n).alias("step"), "*") for n, df in steps.items()]
    return a.unionByName(b)


@query(
    "run_checks",
    sql(
        "calls vcf_file",
        """SELECT 'gt_null' AS "check", count(*) AS n_bad FROM calls WHERE gt IS NULL
        UNION ALL SELECT 'chr_prefix', count(*) FROM calls WHERE lower(chrom) LIKE '%chr%'
        UNION ALL SELECT 'mt', count(*) FROM calls WHERE chrom = 'MT'
        UNION ALL SELECT 'alphabet', count(*) FROM calls WHERE regexp_replace(alt, 'A|T|G|C|N|\\.', '', 'g') <> ''
        UNION ALL SELECT 'brackets', count(*) FROM calls WHERE alt LIKE '%[%' OR alt LIKE '%]%'
        UNION ALL SELECT 'subjects', count(*) FROM (SELECT DISTINCT subject_id FROM calls) a
          FULL JOIN vcf_file b ON a.subject_id = b.subject_id WHERE a.subject_id IS NULL OR b.subject_id IS NULL
        UNION ALL SELECT 'chroms', count(*) FROM (SELECT subject_id FROM calls GROUP BY 1 HAVING count(DISTINCT chrom) < 25)""",
    ),
)
def run_checks(t):
    calls = t("calls")
    rules = {
        "gt_null": Q.null_rule(["gt"]),
        "chr_prefix": Q.prefix_rule(),
        "mt": Q.mt_rule(),
        "alphabet": Q.alphabet_rule(),
        "brackets": Q.bracket_rule(),
    }
    groups = {
        "subjects": Q.check_subjects_loaded(calls, t("vcf_file")),
        "chroms": Q.check_chroms_per_subject(calls),
    }
    return Q.run_checks(calls, rules, groups)

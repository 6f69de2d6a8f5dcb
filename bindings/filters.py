"""Row filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.labels import STRICT
from bindings.registry import query, sql
from varloom.functions import predicates as P

CALL = ["sample_id", "var_id", "qual", "dp", "filter", "gt"]


@query(
    "filter_quality",
    sql("calls", f"SELECT {', '.join(CALL)} FROM calls WHERE qual >= 30 AND dp >= 10 AND gt IS NOT NULL AND filter = 'PASS'"),
)
def filter_quality(t):
    return P.filter_quality(t("calls").select(*CALL), 30, 10, passed=True)


@query("filter_autosomes", sql("calls", "SELECT sample_id, var_id, chrom FROM calls WHERE chrom NOT IN ('X', 'Y')"))
def filter_autosomes(t):
    return P.filter_autosomes(t("calls").select("sample_id", "var_id", "chrom"))


@query(
    "filter_trio",
    sql(
        "calls",
        """SELECT sample_id, var_id FROM calls WHERE (sample_id LIKE '%03' OR sample_id LIKE '%01')
        AND sample_id IN ('101-000000004-01', '101-000000004-02', '101-000000004-03', '101-000000009-03')""",
    ),
)
def filter_trio(t):
    family = [f"101-000000004-0{i}" for i in (1, 2, 3)]
    return P.filter_trio(t("calls").select("sample_id", "var_id"), ["NB", "M"], [*family, "101-000000009-03"])


@query(
    "build_predicate",
    sql("calls", "SELECT sample_id, chrom, member, gt FROM calls WHERE chrom IN ('1', '2', 'X') AND member = 'NB'"),
)
def build_predicate(t):
    chosen = P.build_predicate({"chrom": "1,2,X", "member": "NB", "gt": "all"})
    return t("calls").select("sample_id", "chrom", "member", "gt").where(chosen)


@query(
    "filter_find_in_set",
    sql(
        "clinvar",
        """SELECT var_id, clin_sig FROM clinvar WHERE (list_contains(string_split(clin_sig, '|'), '4')
        OR list_contains(string_split(clin_sig, '|'), '5')) AND NOT list_contains(string_split(clin_sig, '|'), '2')
        AND NOT list_contains(string_split(clin_sig, '|'), '3')""",
    ),
)
def filter_find_in_set(t):
    return P.filter_find_in_set(t("clinvar").select("var_id", "clin_sig"), sep="|")


@query(
    "basic_predicates",
    sql(
        "feature_fm",
        """SELECT feature_id, chr, pos, chr BETWEEN '1' AND '3' AS text_between, pos BETWEEN 1000 AND 900000 AS between_,
        chr IN ('1', 'X') AS in_, feature_id LIKE '%METH%' AS like_, chr <> '1' AS unequal, pos > 500000 AS over,
        pos <= 500000 AS upto, NOT feature_id LIKE 'N:M%' AS not_like FROM feature_fm WHERE pos >= 100""",
    ),
)
def basic_predicates(t):
    chrom, pos, name = F.col("chr"), F.col("pos"), F.col("feature_id")
    return t("feature_fm").where(pos >= 100).select(
        "feature_id", "chr", "pos",
        chrom.between("1", "3").alias("text_between"), pos.between(1000, 900000).alias("between_"),
        chrom.isin("1", "X").alias("in_"), name.like("%METH%").alias("like_"), (chrom != "1").alias("unequal"),
        (pos > 500000).alias("over"), (pos <= 500000).alias("upto"), (~name.like("N:M%")).alias("not_like"),
    )


@query(
    "filter_high_risk",
    sql(
        "kaviar clinvar coding",
        f"""SELECT e.var_id, kav_freq, clin_sig, impact FROM coding e LEFT JOIN kaviar k ON e.var_id = k.var_id
        LEFT JOIN clinvar c ON e.var_id = c.var_id
        WHERE ((kav_freq < 0.01 OR kav_freq IS NULL) AND impact = 'HIGH') OR ({STRICT})""",
    ),
)
def filter_high_risk(t):
    df = t("coding").select("var_id", "impact")
    df = df.join(t("kaviar").select("var_id", "kav_freq"), "var_id", "left")
    df = df.join(t("clinvar").select("var_id", "clin_sig"), "var_id", "left")
    return P.filter_high_risk(df).select("var_id", "kav_freq", "clin_sig", "impact")

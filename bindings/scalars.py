"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import query, sql
from varloom.functions import columns as C


@query(
    "string_scalars",
    sql(
        "calls",
        """SELECT var_id, sample_id, chrom || '-' || CAST(pos AS VARCHAR) AS joined, CAST(length(sample_id) AS INT) AS n_chars,
        substr(sample_id, 5) AS tail, right(sample_id, 2) AS last_two, substr(sample_id, 1, 3) AS head,
        CAST(instr(sample_id, '-0') AS INT) AS dash_at FROM calls""",
    ),
)
def string_scalars(t):
    sample = F.col("sample_id")
    return t("calls").select(
        "var_id", "sample_id",
        F.concat_ws("-", "chrom", F.col("pos").cast("string")).alias("joined"), F.length(sample).alias("n_chars"),
        sample.substr(F.lit(5), F.length(sample)).alias("tail"), F.substring(sample, -2, 2).alias("last_two"),
        F.substring(sample, 1, 3).alias("head"), F.instr(sample, "-0").alias("dash_at"),
    )


@query(
    "regex_scalars",
    sql(
        "calls",
        """SELECT sample_id, var_id, regexp_replace(gt, '1/2', '0/1', 'g') AS replaced, regexp_matches(alt, '^[ACGT]+$') AS plain,
        NOT regexp_matches(alt, 'AC') AS without_ac, regexp_matches(member, '^F|^M') AS parent FROM calls""",
    ),
)
def regex_scalars(t):
    return t("calls").select(
        "sample_id", "var_id", F.regexp_replace("gt", "1/2", "0/1").alias("replaced"),
        F.col("alt").rlike("^[ACGT]+$").alias("plain"), (~F.col("alt").rlike("AC")).alias("without_ac"),
        F.col("member").rlike("^F|^M").alias("parent"),
    )


@query(
    "like_scalars",
    sql(
        "calls",
        """SELECT sample_id, sample_id LIKE '%03' AS ends, sample_id LIKE '101%' AS starts, sample_id LIKE '%00%' AS holds,
        sample_id LIKE '10%1' AS both_ends FROM calls""",
    ),
)
def like_scalars(t):
    sample = F.col("sample_id")
    return t("calls").select(
        "sample_id", sample.endswith("03").alias("ends"), sample.startswith("101").alias("starts"),
        sample.contains("00").alias("holds"), sample.like("10%1").alias("both_ends"),
    )


@query(
    "reorder_id_parts",
    sql("calls", "SELECT '101-' || family_id || '-' || member AS sample_id, var_id FROM calls"),
)
def reorder_id_parts(t):
    vendor = F.concat_ws("-", "member", F.lit("101"), F.col("family_id").cast("string"))
    return C.reorder_id_parts(t("calls").select(vendor.alias("sample_id"), "var_id"))


@query(
    "coalesce_keys",
    sql(
        "dbsnp kaviar",
        """SELECT coalesce(d.chrom, k.chrom) AS chrom, coalesce(d.pos, k.pos) AS pos, coalesce(d.ref, k.ref) AS ref,
        coalesce(d.alt, k.alt) AS alt, rs_id, kav_freq FROM dbsnp d FULL JOIN kaviar k
        ON d.chrom = k.chrom AND d.pos = k.pos AND d.ref = k.ref AND d.alt = k.alt""",
    ),
)
def coalesce_keys(t):
    key = ["chrom", "pos", "ref", "alt"]
    a, b = t("dbsnp").select(*key, "rs_id").alias("a"), t("kaviar").select(*key, "kav_freq").alias("b")
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in key]
    merged = a.join(b, same, "full")
    return merged.select(*[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in key], "rs_id", "kav_freq")


@query(
    "case_scalars",
    sql(
        "calls",
        """SELECT sample_id, var_id, CASE WHEN gt = '1/1' THEN 'hom' WHEN gt IS NULL THEN 'none' ELSE 'het' END AS with_else,
        CASE WHEN member = 'NB' THEN 'child' WHEN member IN ('M', 'F') AND qual > 25 THEN 'parent' END AS without_else
        FROM calls""",
    ),
)
def case_scalars(t):
    gt, member = F.col("gt"), F.col("member")
    return t("calls").select(
        "sample_id", "var_id", F.when(gt == "1/1", "hom").when(gt.isNull(), "none").otherwise("het").alias("with_else"),
        F.when(member == "NB", "child").when(member.isin("M", "F") & (F.col("qual") > 25), "parent").alias("without_else"),
    )


@query(
    "math_scalars",
    sql(
        "sts",
        """SELECT chrom, pos, CAST(pos // 1000000 AS INT) AS block, CAST(pos % 1000000 AS INT) AS inside,
        round((mac + 1) / 5008 * 100, 9) AS share, TRUE AS random_in_range FROM sts""",
    ),
)
def math_scalars(t):
    pos, mac = F.col("pos"), F.col("mac")
    return t("sts").select(
        "chrom", "pos", F.floor(pos / 1000000).cast("int").alias("block"), (pos % 1000000).alias("inside"),
        F.round((mac + 1) / 5008 * 100, 9).alias("share"), F.rand(3).between(0, 1).alias("random_in_range"),
    )


@query(
    "json_scalars",
    sql(
        "",
        """SELECT event_id, json_extract_string(props, '$.k') AS k,
        json_extract_string('{"hits":[{"dbsnp":' || props || '}]}', '$.hits[0].dbsnp.k') AS nested FROM events""",
    ),
)
def json_scalars(t):
    document = F.concat(F.lit('{"hits":[{"dbsnp":'), "props", F.lit("}]}"))
    return t("events").select(
        "event_id",
        F.get_json_object("props", "$.k").alias("k"),
        F.get_json_object(document, "$.hits[0].dbsnp.k").alias("nested"),
    )


@query(
    "missing_ids",
    sql(
        "sites dbsnp",
        """SELECT s.var_id, coalesce(d.rs_id, s.chrom || ':' || s.pos || '[b37]' || s.ref || ',' || s.alt) AS rs_id
        FROM sites s LEFT JOIN dbsnp d ON s.var_id = d.var_id""",
    ),
)
def missing_ids(t):
    df = t("sites").select("var_id", "chrom", "pos", "ref", "alt")
    df = df.join(t("dbsnp").select("var_id", "rs_id"), "var_id", "left")
    return C.missing_ids(df).select("var_id", "rs_id")

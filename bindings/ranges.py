"""Interval joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings.registry import query, sql
from varloom import schema as S
from varloom.operators import ranges as R
from varloom.operators.hints import STRATEGIES
from varloom.operators.interval_tree import tree_join as by_tree
from varloom.operators.joins import join_on_variant

BOUNDS = {"start": "txstart", "stop": "txstop"}


@query(
    "range_join",
    sql(
        "sites genes",
        """SELECT s.var_id, s.chrom, s.pos, g.gene_name, g.txstart, g.txstop, g.strand FROM sites s LEFT JOIN genes g
        ON s.chrom = g.chrom AND s.pos BETWEEN g.txstart AND g.txstop""",
    ),
)
def range_join(t):
    return R.range_join(t("sites").select("var_id", "chrom", "pos"), t("genes"), **BOUNDS)


@query(
    "range_join_inner",
    sql(
        "calls genes",
        """SELECT c.sample_id, c.chrom, c.pos, g.gene_name, g.txstart, g.txstop, g.strand FROM calls c JOIN genes g
        ON c.chrom = g.chrom AND c.pos BETWEEN g.txstart AND g.txstop""",
    ),
)
def range_join_inner(t):
    return R.range_join_inner(t("calls").select("sample_id", "chrom", "pos"), t("genes"), **BOUNDS)


@query(
    "range_join_padded",
    sql(
        "calls genes",
        """SELECT c.sample_id, c.chrom, c.pos, g.gene_name, 'shift' AS form FROM calls c JOIN genes g
        ON c.chrom = g.chrom AND c.pos BETWEEN g.txstart + 1000 AND g.txstop + 1000
        UNION ALL SELECT c.sample_id, c.chrom, c.pos, g.gene_name, 'pad' FROM calls c JOIN genes g
        ON c.chrom = g.chrom AND c.pos BETWEEN g.txstart - 1000 AND g.txstop + 1000""",
    ),
)
def range_join_padded(t):
    calls, genes = t("calls").select("sample_id", "chrom", "pos"), t("genes")
    columns = ["sample_id", "chrom", "pos", "gene_name"]
    shifted = R.range_join_inner(calls, genes, shift=1000, **BOUNDS).selectExpr(*columns, "'shift' AS form")
    padded = R.range_join_inner(calls, genes, pad=1000, **BOUNDS).selectExpr(*columns, "'pad' AS form")
    return shifted.unionByName(padded)


@query(
    "interval_allele_join",
    sql(
        "cgi_calls clinvar",
        """SELECT g.sample_id, g.chr, g.start, g.stop, g.ref, g.allele1seq, g.allele2seq, c.pos, c.alt, c.clin_sig
        FROM cgi_calls g JOIN clinvar c ON g.chr = c.chrom AND g.ref = c.ref AND c.pos BETWEEN g.start AND g.stop
        AND (c.alt = g.allele1seq OR c.alt = g.allele2seq)""",
    ),
)
def interval_allele_join(t):
    columns = ["sample_id", "chr", "start", "stop", "ref", "allele1seq", "allele2seq"]
    known = t("clinvar").select("chrom", "pos", "ref", "alt", "clin_sig")
    return R.interval_allele_join(t("cgi_calls").select(*columns), known).drop("chrom")


# Genes, the span of each site's block of parts, and every chromosome as a whole: nested, equal and very long intervals.
LAYERS = """layers AS (
  SELECT chrom, txstart AS lo, txstop AS hi, gene_name AS name FROM genes UNION ALL
  SELECT chrom, min(pos), max(pos), 'whole' FROM sites GROUP BY chrom UNION ALL
  SELECT chrom, pos, pos + p_size * 37, 'near' FROM sites UNION ALL
  SELECT chrom, pos, pos, 'point' FROM sites WHERE p_type = 'PROMO')"""


def _layers(t):
    sites, genes = t("sites"), t("genes")
    parts = [
        genes.select("chrom", F.col("txstart").alias("lo"), F.col("txstop").alias("hi"), F.col("gene_name").alias("name")),
        sites.groupBy("chrom").agg(F.min("pos").alias("lo"), F.max("pos").alias("hi")).withColumn("name", F.lit("whole")),
        sites.select("chrom", F.col("pos").alias("lo"), (F.col("pos") + F.col("p_size") * 37).alias("hi"), F.lit("near").alias("name")),
        sites.where("p_type = 'PROMO'").select("chrom", F.col("pos").alias("lo"), F.col("pos").alias("hi"), F.lit("point").alias("name")),
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "tree_join",
    sql(
        "dbsnp genes sites",
        """SELECT v.var_id, l.name, count(*) AS n, min(l.lo) AS lo, max(l.hi) AS hi FROM dbsnp v LEFT JOIN layers l ON v.chrom = l.chrom
        AND v.pos BETWEEN l.lo AND l.hi GROUP BY v.var_id, l.name""",
        LAYERS,
    ),
)
def tree_join(t):
    found = by_tree(t("dbsnp").select("var_id", "chrom", "pos"), _layers(t), start="lo", stop="hi")
    return found.groupBy("var_id", "name").agg(F.count("*").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


@query(
    "tree_join_inner",
    sql(
        "calls genes",
        """SELECT c.sample_id, c.chrom, c.pos, g.gene_name, g.strand FROM calls c JOIN genes g
        ON c.chrom = g.chrom AND c.pos BETWEEN g.txstart - 1000 AND g.txstop + 1000""",
    ),
)
def tree_join_inner(t):
    found = by_tree(t("calls").select("sample_id", "chrom", "pos"), t("genes"), "inner", pad=1000, **BOUNDS)
    return found.drop("txstart", "txstop")


@query(
    "join_strategies",
    sql(
        "calls clinvar",
        "SELECT s.strategy, c.sample_id, k.clin_sig, count(*) AS n FROM calls c JOIN clinvar k USING (var_id), s GROUP BY ALL",
        "s AS (SELECT unnest(['broadcast', 'shuffle_hash', 'shuffle_merge']) AS strategy)",
    ),
)
def join_strategies(t):
    """One join under each strategy hint."""
    calls, known = t("calls").select("sample_id", *S.VARIANT_KEY), t("clinvar").select(*S.VARIANT_KEY, "clin_sig")
    joined = [join_on_variant(calls, known, s).select(F.lit(s).alias("strategy"), "sample_id", "clin_sig") for s in STRATEGIES]
    return reduce(DataFrame.unionByName, joined).groupBy("strategy", "sample_id", "clin_sig").agg(F.count("*").alias("n"))

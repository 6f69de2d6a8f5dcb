"""Effect text and the global variants table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from bindings.labels import PPC
from bindings.registry import query, sql
from varloom.operators import effects as E
from varloom.operators.aggregates import distinct_variants, union_distinct_variants
from varloom.operators.joins import merge_effects as merge
from varloom.plans.global_variants import annotate_variants, create_global, extend_global, write_global_variants
from varloom.plans.global_variants import global_variants as build
from varloom.session import staging_root
from varloom.sources.bucketed import bucket_count, save_bucketed

CALL_ROWS = """SELECT chrom AS CHROM, pos AS POS, var_id AS ID, ref AS REF, alt AS ALT, qual AS QUAL, filter AS FILTER,
  '.' AS INFO, 'GT' AS FORMAT, coalesce(gt, '.') AS GT FROM calls"""


@query(
    "to_vcf_rows",
    sql(
        "sites",
        """SELECT chrom AS CHROM, pos AS POS, var_id AS ID, ref AS REF, alt AS ALT, 100 AS QUAL, 'PASS' AS FILTER,
        '.' AS INFO, 'GT' AS FORMAT, '.' AS GT FROM sites""",
    ),
)
def to_vcf_rows(t):
    return E.to_vcf_rows(t("sites"))


EFFECT_ROWS = """entries AS (SELECT v.*, unnest(string_split(substr(info, 5), ',')) AS entry,
    generate_subscripts(string_split(substr(info, 5), ','), 1) AS k FROM vcf_info v),
  effects AS (SELECT chrom, pos, var_id, ref, alt, CAST(k - 1 AS INT) AS effect_no, f[4] AS gene, f[5] AS gene_id,
    f[2] AS effect, f[3] AS impact, f[6] AS feature, f[7] AS feature_id, f[8] AS biotype, CAST(f[9] AS INT) AS rank,
    CAST(NULL AS VARCHAR) AS distance, f[10] AS hgvs_c, f[11] AS hgvs_p
    FROM (SELECT *, string_split(entry, '|') AS f FROM entries))"""


@query("explode_effects", sql("vcf_info", "SELECT * FROM effects", EFFECT_ROWS))
def explode_effects(t):
    return E.explode_effects(t("vcf_info"))


@query("first_effect", sql("vcf_info", "SELECT * EXCLUDE (effect_no) FROM effects WHERE effect_no = 0", EFFECT_ROWS))
def first_effect(t):
    return E.first_effect(t("vcf_info"))


FINAL = """SELECT pos, var_id, ref, alt, gene, gene_id, effect AS affect, impact, feature, feature_id, biotype, rank, distance,
  hgvs_c, hgvs_p, chrom, CAST(pos // 1000000 AS INT) AS blk_pos FROM effects"""


@query("finalize_effects", sql("vcf_info", FINAL, EFFECT_ROWS))
def finalize_effects(t):
    lines = E.explode_effects(t("vcf_info"))
    comments = lines.withColumn("chrom", F.concat(F.lit("#"), "chrom"))
    return E.finalize_effects(lines.unionByName(comments))


@query(
    "merge_effects",
    sql(
        "calls vcf_info",
        """SELECT DISTINCT c.sample_id, c.var_id, e.effect, e.impact FROM calls c JOIN effects e ON c.var_id = e.var_id
        WHERE e.effect_no = 0""",
        EFFECT_ROWS,
    ),
)
def merge_effects(t):
    first = E.first_effect(t("vcf_info")).select("var_id", "effect", "impact")
    return merge(t("calls").select("sample_id", "var_id"), first)


@query("pipe_partitions", sql("calls", CALL_ROWS))
def pipe_partitions(t):
    rows = E.to_vcf_rows(t("calls"), gt="gt")
    return E.pipe_partitions(rows, "cat", T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields]))


@query(
    "pipe_chain",
    sql(
        "calls",
        """SELECT 'chr' || chrom AS CHROM, pos AS POS, var_id AS ID, ref AS REF, alt AS ALT, qual AS QUAL, 'KEPT' AS FILTER,
        '.' AS INFO, 'GT' AS FORMAT, coalesce(gt, '.') AS GT FROM calls WHERE filter <> 'LowQual'""",
    ),
)
def pipe_chain(t):
    """Three programs in a row: one drops lines, one edits a field, one edits the start of the line."""
    rows = E.to_vcf_rows(t("calls"), gt="gt")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
    return E.pipe_chain(rows, ["sed /LowQual/d", "sed s/PASS/KEPT/", "sed s/^/chr/"], schema, timeout=600)


def _global(source: str, call_rows: str) -> str:
    union = "\nUNION\n".join(
        [call_rows] + [f"SELECT chrom, blk_pos, pos, ref, alt FROM {n}" for n in ("dbnsfp", "kaviar", "clinvar", "dbsnp", "hgmd")]
    )
    return sql(
        f"{source} dbsnp kaviar clinvar hgmd dbnsfp coding genes",
        f"""SELECT v.chrom, v.blk_pos, v.pos, v.ref, v.alt AS allele, d.rs_id, d.dbsnp_buildid, k.kav_freq, k.kav_source,
        c.clin_sig, c.clin_dbn, h.id AS hgmd_id, h.var_class AS hgmd_varclass, n.cadd_raw, n.dann_score, n.interpro_domain,
        e.effect, e.impact, e.feature_id, g.strand, g.gene_name,
        CASE WHEN length(v.ref) > length(v.alt) THEN 'deletion' WHEN length(v.ref) < length(v.alt) THEN 'insertion'
          ELSE 'snv' END AS var_type, {PPC.format(alt='v.alt').replace('length(ref)', 'length(v.ref)')} AS ppc_rating, v.var_id
        FROM (SELECT *, chrom || ':' || pos || ':' || ref || ':' || alt AS var_id FROM vars) v
        LEFT JOIN dbsnp d ON v.var_id = d.var_id LEFT JOIN kaviar k ON v.var_id = k.var_id
        LEFT JOIN clinvar c ON v.var_id = c.var_id LEFT JOIN hgmd h ON v.var_id = h.var_id
        LEFT JOIN dbnsfp n ON v.var_id = n.var_id LEFT JOIN coding e ON v.var_id = e.var_id
        LEFT JOIN genes g ON v.chrom = g.chrom AND v.pos BETWEEN g.txstart AND g.txstop""",
        f"vars AS ({union})",
    )


def _build(t, calls, build=build):
    tables = {n: t(n) for n in ("dbsnp", "kaviar", "clinvar", "hgmd", "dbnsfp", "coding", "genes")}
    others = [tables[n] for n in ("dbnsfp", "kaviar", "clinvar", "dbsnp", "hgmd")]
    return build([calls, *others], **tables)


@query("global_variants", _global("calls", "SELECT chrom, blk_pos, pos, ref, alt FROM calls"))
def global_variants(t):
    return _build(t, t("calls"))


@query("global_variants_written", _global("calls", "SELECT chrom, blk_pos, pos, ref, alt FROM calls"))
def global_variants_written(t):
    path = f"{staging_root(t.spark)}/global-{uuid.uuid4().hex}"
    return _build(t, t("calls"), lambda sources, **tables: write_global_variants(sources, path, floor=100, **tables))


@query("global_variants_extended", _global("calls", "SELECT chrom, blk_pos, pos, ref, alt FROM calls"))
def global_variants_extended(t):
    """Stored from three sources, then two more added, then one: the same rows as the build from all six."""
    path = f"{staging_root(t.spark)}/global-{uuid.uuid4().hex}"

    def build(sources, **tables):
        first = create_global(sources[3:], path, floor=100, **tables)
        extend_global(sources[1:3], path, schema=first.schema, **tables)
        return extend_global(sources[:1], path, schema=first.schema, **tables)

    return _build(t, t("calls"), build)


ANNOTATIONS = ("dbsnp", "kaviar", "clinvar", "hgmd", "dbnsfp", "coding")


def bucketed_tables(t, buckets: int) -> dict:
    """The six keyed annotation tables, stored in buckets of the variant key."""
    return {
        n: save_bucketed(t(n), f"{n}_{uuid.uuid4().hex}", buckets, path=f"{staging_root(t.spark)}/bucketed-{uuid.uuid4().hex}")
        for n in ANNOTATIONS
    }


@query("global_variants_bucketed", _global("calls", "SELECT chrom, blk_pos, pos, ref, alt FROM calls"))
def global_variants_bucketed(t):
    """The distinct variants and the six annotation tables in the same buckets: six left joins without a shuffle."""
    sources = [t("calls"), *[t(n) for n in ("dbnsfp", "kaviar", "clinvar", "dbsnp", "hgmd")]]
    variants = union_distinct_variants(*sources)
    buckets = bucket_count(t("calls"))
    stored = save_bucketed(variants, f"variants_{uuid.uuid4().hex}", buckets, path=f"{staging_root(t.spark)}/bucketed-{uuid.uuid4().hex}")
    return annotate_variants(stored, genes=t("genes"), **bucketed_tables(t, buckets))


@query(
    "global_variants_cgi",
    _global(
        "cgi_calls",
        "SELECT chr AS chrom, CAST(start // 1000000 AS INT) AS blk_pos, start AS pos, ref, allele2seq AS alt FROM cgi_calls",
    ),
)
def global_variants_cgi(t):
    block = F.floor(F.col("start") / 1_000_000).cast("int").alias("blk_pos")
    position = [F.col("chr").alias("chrom"), block, F.col("start").alias("pos"), "ref"]
    return _build(t, t("cgi_calls").select(*position, F.col("allele2seq").alias("allele")))

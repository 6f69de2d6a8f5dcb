"""Allele statistics and ancestry inputs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from bindings.registry import query, sql
from varloom import schema as S
from varloom.functions.columns import allele_flags, dosage
from varloom.operators import allele_counts as C
from varloom.operators import statistics as A
from varloom.operators.joins import members_in, members_not_in
from varloom.operators.pruning import prune_by_frequency as by_frequency
from varloom.plans.ancestry import ancestry_inputs as inputs
from varloom.plans.ancestry import ancestry_results as results
from varloom.session import stage, staging_root

DOSE = """dose AS (SELECT subject_id, chrom, pos, ref, alt, max(CASE WHEN gt = '1/1' THEN 2 ELSE 1 END) AS dosage FROM {source}
    WHERE gt IS NOT NULL GROUP BY ALL)"""
# No row: two reference alleles. A sample whose calls all lack a genotype is missing and leaves the denominator.
ANY = """every AS (SELECT subject_id, chrom, pos, ref, alt, max(CASE WHEN gt = '1/1' THEN 2 WHEN gt IS NOT NULL THEN 1 END) AS dosage
    FROM {source} GROUP BY ALL)"""
RATES = "alt_alleles / (2 * n_samples) AS alt_freq, least(alt_alleles / (2 * n_samples), 1 - alt_alleles / (2 * n_samples)) AS maf"
FREQ = """freq AS (SELECT *, {rates} FROM (SELECT {marker}, CAST(coalesce(sum(dosage), 0) AS BIGINT) AS alt_alleles,
    {cohort} - count(*) FILTER (dosage IS NULL) AS n_samples FROM every GROUP BY ALL))"""
SITES = "chrom, pos, ref, alt"
CUSTOMERS = "(SELECT count(*) FROM customer)"
IDX = """idx AS (SELECT *, row_number() OVER (PARTITION BY chrom ORDER BY pos, ref, alt) - 1 AS idx
    FROM (SELECT DISTINCT chrom, pos, ref, alt FROM {dose}))"""
PAIRS = """placed AS (SELECT d.subject_id, d.chrom, i.idx, d.dosage FROM {dose} d JOIN idx i
    ON d.chrom = i.chrom AND d.pos = i.pos AND d.ref = i.ref AND d.alt = i.alt),
  sums AS (SELECT a.chrom, a.idx AS idx_i, b.idx AS idx_j, count(*) AS n, CAST(sum(a.dosage) AS DOUBLE) AS sx,
    CAST(sum(b.dosage) AS DOUBLE) AS sy, CAST(sum(a.dosage * a.dosage) AS DOUBLE) AS sxx,
    CAST(sum(b.dosage * b.dosage) AS DOUBLE) AS syy, CAST(sum(a.dosage * b.dosage) AS DOUBLE) AS sxy
    FROM placed a JOIN placed b ON a.subject_id = b.subject_id AND a.chrom = b.chrom AND b.idx > a.idx
      AND b.idx < a.idx // 5 * 5 + 50 GROUP BY ALL),
  pairs AS (SELECT chrom, idx_i, idx_j, n, CASE WHEN n * sxx - sx * sx > 0 AND n * syy - sy * sy > 0
    THEN (n * sxy - sx * sy) * (n * sxy - sx * sy) / ((n * sxx - sx * sx) * (n * syy - sy * sy)) END AS r2 FROM sums)"""


def _dosages(t):
    return A.sample_dosages(dosage(t("calls")))


def _every(t, marker=S.VARIANT_KEY):
    return A.sample_dosages(dosage(t("calls")), marker, missing=True)


def _cohort(t):
    return t("customer").select("c_custkey")


@query(
    "allele_frequency",
    sql(
        "cgi_calls",
        f"""SELECT *, {RATES}
        FROM (SELECT chr, start, ref, CAST(sum(CAST(allele1seq <> ref AS INT) + CAST(allele2seq <> ref AS INT)) AS BIGINT)
          AS alt_alleles, {CUSTOMERS} AS n_samples FROM cgi_calls GROUP BY ALL)""",
    ),
)
def allele_frequency(t):
    return A.allele_frequency(allele_flags(t("cgi_calls")), _cohort(t), ["chr", "start", "ref"])


@query(
    "dosage_frequency",
    sql("calls", "SELECT * FROM freq", ANY.format(source="calls") + "," + FREQ.format(rates=RATES, marker=SITES, cohort=CUSTOMERS)),
)
def dosage_frequency(t):
    return A.dosage_frequency(_every(t), _cohort(t))


# Whole chromosomes as markers: carriers are common enough for frequencies over one half, sites and strands for rare ones.
@query(
    "filter_maf",
    sql(
        "calls",
        """SELECT 'site' AS level, chrom, alt_alleles, n_samples, alt_freq, maf FROM freq WHERE maf BETWEEN 0.05 AND 0.49
        UNION ALL SELECT 'chrom', chrom, alt_alleles, n_samples, alt_freq, maf FROM wide WHERE maf BETWEEN 0.05 AND 0.49""",
        ",".join(
            [
                ANY.format(source="calls"),
                FREQ.format(rates=RATES, marker=SITES, cohort=CUSTOMERS),
                ANY.format(source="calls").replace("every AS", "whole AS").replace("subject_id, chrom, pos, ref, alt,", "subject_id, chrom,"),
                FREQ.format(rates=RATES, marker="chrom", cohort=CUSTOMERS).replace("freq AS", "wide AS").replace("FROM every", "FROM whole"),
            ]
        ),
    ),
)
def filter_maf(t):
    columns = ["chrom", "alt_alleles", "n_samples", "alt_freq", "maf"]
    cohort = A.cohort_size(_cohort(t))
    sites = A.filter_maf(A.dosage_frequency(_every(t), cohort)).select(F.lit("site").alias("level"), *columns)
    whole = A.filter_maf(A.dosage_frequency(_every(t, ["chrom"]), cohort, ["chrom"])).select(F.lit("chrom").alias("level"), *columns)
    return sites.unionByName(whole)


@query(
    "filter_missing",
    sql(
        "calls",
        """SELECT chrom, pos, ref, alt, avg(CASE WHEN gt IS NULL THEN 1 ELSE 0 END) AS missing_rate FROM calls
        GROUP BY ALL HAVING avg(CASE WHEN gt IS NULL THEN 1 ELSE 0 END) <= 0.02""",
    ),
)
def filter_missing(t):
    return A.filter_missing(t("calls"), 0.02)


@query(
    "biallelic_only",
    sql(
        "calls",
        """SELECT sample_id, chrom, pos, ref, alt, dosage FROM named WHERE (chrom, pos) IN (SELECT (chrom, pos) FROM named
        GROUP BY chrom, pos HAVING count(DISTINCT ref) = 1 AND count(DISTINCT alt) = 1 AND NOT bool_or(alt LIKE '%,%')
        AND coalesce(sum(dosage), 0) >= 2)""",
        """named AS (SELECT sample_id, chrom, pos, ref, CASE WHEN chrom IN ('1', '2') AND qual > 48 THEN alt || ',T' ELSE alt END
        AS alt, CASE WHEN gt = '1/1' THEN 2 WHEN gt IS NOT NULL THEN 1 END AS dosage FROM calls)""",
    ),
)
def biallelic_only(t):
    many = F.col("chrom").isin("1", "2") & (F.col("qual") > 48)
    alt = F.when(many, F.concat("alt", F.lit(",T"))).otherwise(F.col("alt"))
    named = dosage(t("calls").withColumn("alt", alt)).select("sample_id", *S.VARIANT_KEY, "dosage")
    return A.biallelic_only(named, min_alt=2)


@query(
    "population_frequency",
    sql(
        "calls panel",
        f"""SELECT *, {RATES} FROM (SELECT chrom, pos, ref, alt, super_pop, CAST(coalesce(sum(dosage), 0) AS BIGINT) AS alt_alleles,
        max(size) - count(*) FILTER (dosage IS NULL) AS n_samples FROM every d JOIN panel p ON d.subject_id = p.sample
        JOIN (SELECT super_pop AS s, count(DISTINCT sample) AS size FROM panel GROUP BY ALL) ON s = super_pop GROUP BY ALL)""",
        ANY.format(source="calls"),
    ),
)
def population_frequency(t):
    return A.population_frequency(_every(t), t("panel"), "super_pop")


@query("marker_index", sql("calls", "SELECT * FROM idx", IDX.format(dose="calls")))
def marker_index(t):
    return A.marker_index(t("calls"))


LD = ",".join([DOSE.format(source="calls"), IDX.format(dose="dose"), PAIRS.format(dose="dose")])


@query("ld_pairs", sql("calls", "SELECT * FROM pairs", LD))
def ld_pairs(t):
    return A.ld_pairs(_dosages(t))


@query(
    "ld_prune",
    sql(
        "calls",
        """SELECT * FROM idx i WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.chrom = i.chrom AND p.idx_i = i.idx
        AND p.r2 > 0.5)""",
        LD,
    ),
)
def ld_prune(t):
    return A.ld_prune(_dosages(t))


# One event after the other: in a window the next pair of a pass, a new pass, or the next window.
PRUNE = """mafs AS (SELECT i.chrom, i.idx, f.maf FROM idx i JOIN freq f USING (chrom, pos, ref, alt)),
  edges AS MATERIALIZED (SELECT p.chrom, p.idx_i AS i, p.idx_j AS j, a.maf < b.maf * (1 - 1e-9) AS first_goes FROM pairs p
    JOIN mafs a ON a.chrom = p.chrom AND a.idx = p.idx_i JOIN mafs b ON b.chrom = p.chrom AND b.idx = p.idx_j WHERE p.r2 > {cutoff}),
  walk(chrom, n, s, here, changed, gone) AS (
    SELECT chrom, max(idx) + 1, 0::BIGINT, -1::BIGINT, false, []::BIGINT[] FROM idx GROUP BY chrom
    UNION ALL
    SELECT chrom, n, CASE WHEN e IS NULL AND NOT changed THEN s + 5 ELSE s END, CASE WHEN e IS NULL THEN -1 ELSE e.i END, e IS NOT NULL,
      CASE WHEN e IS NULL THEN gone ELSE list_append(gone, CASE WHEN e.first_goes THEN e.i ELSE e.j END) END
    FROM (SELECT w.chrom, w.n, w.s, w.here, w.changed, w.gone, min({{'i': e.i, 'j': e.j, 'first_goes': e.first_goes}}) FILTER (e.i IS NOT NULL) AS e
      FROM walk w LEFT JOIN edges e ON e.chrom = w.chrom AND e.i >= w.s AND e.i > w.here AND e.j < w.s + 50
        AND NOT list_contains(w.gone, e.i) AND NOT list_contains(w.gone, e.j)
      WHERE w.s < w.n GROUP BY ALL))"""
FREQUENCIES = ANY.format(source="calls") + "," + FREQ.format(rates=RATES, marker=SITES, cohort=CUSTOMERS)


@query(
    "prune_by_frequency",
    sql(
        "calls",
        """SELECT i.* FROM idx i WHERE NOT EXISTS (SELECT 1 FROM walk w WHERE w.s >= w.n AND w.chrom = i.chrom
        AND list_contains(w.gone, i.idx))""",
        ",".join([LD, FREQUENCIES, PRUNE.format(cutoff=0.5)]),
        recursive=True,
    ),
)
def prune_by_frequency(t):
    every = stage(_every(t), "every")
    return by_frequency(every.where(F.col("dosage").isNotNull()), A.dosage_frequency(every, _cohort(t)))


@query(
    "stored_frequency",
    sql("calls", "SELECT * FROM freq", FREQUENCIES),
)
def stored_frequency(t):
    """Counts of two load batches, each stored on its own: the rows of ``dosage_frequency``."""
    path = f"{staging_root(t.spark)}/counts-{uuid.uuid4().hex}"
    samples = t("customer").select(F.col("c_custkey").alias("subject_id"), "c_mktsegment")
    for batch, segment in (("first", F.col("c_mktsegment") < "F"), ("second", F.col("c_mktsegment") >= "F")):
        of = samples.where(segment).select("subject_id")
        C.add_batch(A.sample_dosages(dosage(members_in(t("calls"), of, ["subject_id"])), missing=True), of, path, batch)
    return C.stored_frequency(t.spark, path)


@query(
    "stored_population_frequency",
    sql(
        "calls panel",
        f"""SELECT *, {RATES} FROM (SELECT chrom, pos, ref, alt, super_pop, CAST(coalesce(sum(dosage), 0) AS BIGINT) AS alt_alleles,
        max(size) - count(*) FILTER (dosage IS NULL) AS n_samples FROM every d JOIN panel p ON d.subject_id = p.sample
        JOIN (SELECT super_pop AS s, count(DISTINCT sample) AS size FROM panel GROUP BY ALL) ON s = super_pop GROUP BY ALL)""",
        ANY.format(source="calls"),
    ),
)
def stored_population_frequency(t):
    """The same by population, in batches by the gender of the panel's samples."""
    path = f"{staging_root(t.spark)}/counts-{uuid.uuid4().hex}"
    for batch in ("male", "female"):
        of = t("panel").where(F.col("gender") == batch).select(F.col("sample").alias("subject_id"), "super_pop")
        dosages = A.sample_dosages(dosage(members_in(t("calls"), of, ["subject_id"])), missing=True)
        C.add_batch(dosages, of, path, batch, by=["super_pop"])
    return C.stored_frequency(t.spark, path, by=["super_pop"])


@query(
    "thin_markers",
    sql(
        "calls",
        "SELECT chrom, pos FROM kept",
        """markers AS (SELECT DISTINCT chrom, pos FROM calls),
        hops AS (SELECT a.chrom, a.pos, min(b.pos) AS next_pos FROM markers a LEFT JOIN markers b
          ON a.chrom = b.chrom AND b.pos >= a.pos + 60000 GROUP BY ALL),
        kept AS (SELECT chrom, min(pos) AS pos FROM markers GROUP BY chrom UNION ALL
          SELECT h.chrom, h.next_pos FROM kept k JOIN hops h ON k.chrom = h.chrom AND k.pos = h.pos
          WHERE h.next_pos IS NOT NULL)""",
        recursive=True,
    ),
)
def thin_markers(t):
    return A.thin_markers(t("calls"), 60_000)


@query(
    "ancestry_inputs",
    sql(
        "calls panel",
        """SELECT m.subject_id AS sample, m.chrom, m.pos, m.ref, m.alt, m.dosage, coalesce(p.super_pop, '-') AS known_pop
        FROM merged m LEFT JOIN panel p ON m.subject_id = p.sample""",
        ",".join(
            [
                """known_calls AS (SELECT * FROM calls WHERE subject_id IN (SELECT sample FROM panel)),
                new_calls AS (SELECT * FROM calls WHERE subject_id NOT IN (SELECT sample FROM panel))""",
                DOSE.format(source="known_calls"),
                ANY.format(source="known_calls"),
                FREQ.format(rates=RATES, marker=SITES, cohort="(SELECT count(DISTINCT sample) FROM panel)"),
                """common AS (SELECT d.* FROM dose d JOIN freq f ON d.chrom = f.chrom AND d.pos = f.pos AND d.ref = f.ref
                  AND d.alt = f.alt WHERE f.maf BETWEEN 0.05 AND 0.49)""",
                IDX.format(dose="common"),
                PAIRS.format(dose="common"),
                """markers AS (SELECT chrom, pos, ref, alt FROM idx i WHERE NOT EXISTS (SELECT 1 FROM pairs p
                  WHERE p.chrom = i.chrom AND p.idx_i = i.idx AND p.r2 > 0.5)),
                at_markers AS (SELECT * FROM new_calls WHERE (chrom, pos) IN (SELECT (chrom, pos) FROM markers)),
                usable AS (SELECT * FROM at_markers WHERE (chrom, pos) IN (SELECT (chrom, pos) FROM at_markers GROUP BY chrom, pos
                  HAVING count(DISTINCT ref) = 1 AND count(DISTINCT alt) = 1)),
                called AS (SELECT * FROM usable WHERE (chrom, pos, ref, alt) IN (SELECT (chrom, pos, ref, alt) FROM usable
                  GROUP BY chrom, pos, ref, alt HAVING avg(CASE WHEN gt IS NULL THEN 1 ELSE 0 END) <= 0.999)),
                subjects AS (SELECT subject_id, chrom, pos, ref, alt, max(CASE WHEN gt = '1/1' THEN 2 ELSE 1 END) AS dosage
                  FROM called WHERE gt IS NOT NULL GROUP BY ALL),
                reference AS (SELECT * FROM dose WHERE (chrom, pos, ref, alt) IN (SELECT (chrom, pos, ref, alt) FROM markers)),
                merged AS (SELECT subject_id, chrom, pos, ref, alt, dosage FROM reference
                  WHERE (chrom, pos, ref, alt) IN (SELECT (chrom, pos, ref, alt) FROM subjects)
                  UNION ALL SELECT * FROM subjects
                  WHERE (chrom, pos, ref, alt) IN (SELECT (chrom, pos, ref, alt) FROM reference))""",
            ]
        ),
    ),
)
def ancestry_inputs(t):
    calls, panel = t("calls").withColumn("rs_id", F.lit(None).cast("string")), t("panel")
    samples = panel.select(F.col("sample").alias("subject_id"))
    known, new = members_in(calls, samples, ["subject_id"]), members_not_in(calls, samples, ["subject_id"])
    return inputs(known, new, panel)


@query(
    "ancestry_results",
    sql(
        "admix_q panel",
        """SELECT q.sample, q.q1 AS EUR, q.q2 AS AFR FROM admix_q q WHERE q.sample NOT IN (SELECT sample FROM panel)""",
    ),
)
def ancestry_results(t):
    fractions = t("admix_q")
    return results(fractions, fractions.select("sample"), t("panel"), {"q1": "EUR", "q2": "AFR"})

"""Shapes of the physical plans that matter at scale, and whole reports on small stored tables."""

import pytest
from pyspark.sql import functions as F

import bindings
from bindings.registry import Tables
from tests.conftest import rows
from varloom import schema as S
from varloom.functions import with_blk_pos
from varloom.operators.joins import annotate_kaviar, locate_genes
from varloom.operators.statistics import ld_pairs, marker_index
from varloom.plans import trio as P
from varloom.plans.overlap import SHAPES, variant_overlap_count
from varloom.sources import insert_partitioned


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key in changed:
        spark.conf.unset(key)
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.fixture()
def stored(spark, sf_dir, tmp_path):
    """Views written once, so that plans show the operators and not the derivation of the test data."""

    def load(name):
        path = str(tmp_path / name)
        Tables(spark, sf_dir)(name).write.parquet(path)
        return spark.read.parquet(path)

    return load


def test_variants_are_shuffled_once_for_all_annotations(spark, stored, no_broadcast):
    names = ["dbsnp", "kaviar", "clinvar", "hgmd", "dbnsfp", "coding", "genes"]
    tables = {n: stored(n) for n in names}
    from varloom.plans.global_variants import global_variants

    text = plan(global_variants([stored("calls"), *[tables[n] for n in names[:5]]], **tables))
    # one for the distinct union and one for each of six tables; the gene list is broadcast after being counted
    assert text.count("Exchange hashpartitioning") == 7
    assert text.count("BroadcastExchange") == 1


def test_calls_are_shuffled_twice_in_a_trio_report(spark, stored, no_broadcast):
    calls = stored("calls")
    effects = bindings.QUERIES["first_effect"](spark, "/root/testdata/sf0.001")
    effects = effects.select(*S.VARIANT_KEY, *P.EFFECT_COLUMNS)
    tables = {n: stored(n) for n in ("kaviar", "clinvar", "dbnsfp")}
    regions = locate_genes(stored("gene_list"), stored("genes"))
    text = plan(P.annotate_trios(calls, regions, effects=effects, keep=["member", "family_id"], **tables))
    above_calls = [line for line in text.splitlines() if "Exchange hashpartitioning" in line and "sample_id" in line]
    assert len(above_calls) == 1, "deduplication; the other exchange is the keyed join"
    assert "BroadcastHashJoin" in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_stored_calls_are_read_only_in_region_blocks(spark, sf_dir, tmp_path):
    t = Tables(spark, sf_dir)
    columns = ["sample_id", *S.VARIANT_KEY, "blk_pos", "qual", "filter", "gt", "member", "family_id"]
    calls = t("calls").select(*columns)
    path = str(tmp_path / "calls")
    insert_partitioned(calls, path)
    kept = spark.read.schema(calls.schema).parquet(path)
    inputs = bindings.trios._inputs(t)
    inputs["regions"] = inputs["regions"].where("gene = 'GENE2'")
    pruned = P.annotate_trios(kept, keep=["member", "family_id"], **inputs)
    whole = P.annotate_trios(calls.drop("blk_pos"), keep=["member", "family_id"], **inputs)
    assert rows(pruned) == rows(whole) and pruned.count() > 0
    assert "dynamicpruning" in plan(pruned)


def test_no_plan_pairs_everything(spark, sf_dir):
    for name in ("ld_pairs", "range_join", "interval_allele_join", "parent_match_any_family", "compare_cohorts"):
        text = plan(bindings.QUERIES[name](spark, sf_dir))
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text, name


def test_marker_order_is_sorted_by_block(spark, stored):
    text = plan(marker_index(stored("calls")))
    inside = [line for line in text.splitlines() if "Window [row_number()" in line]
    assert inside and all("__blk" in line.split("windowspecdefinition(")[1].split("ASC")[0] for line in inside)


def test_linkage_groups_stay_small_when_samples_repeat_calls(spark):
    """Two samples hold most rows; pairs still meet within a window only."""
    calls = spark.range(0, 3000).select(
        (F.col("id") % 2).alias("subject_id"), F.lit("1").alias("chrom"), (F.floor(F.col("id") / 2) * 7).cast("int").alias("pos"),
        F.lit("A").alias("ref"), F.lit("C").alias("alt"), (F.col("id") % 3).cast("int").alias("dosage"),
    )
    out = ld_pairs(calls, 10, 5)
    assert out.count() == sum(min(i // 5 * 5 + 10, 1500) - i - 1 for i in range(1500))


def test_overlap_shapes(spark, stored):
    left, right = stored("dbsnp"), stored("kaviar")
    key = S.VARIANT_KEY
    a, b = [{tuple(r) for r in df.where("chrom = '1'").select(*key).collect()} for df in (left, right)]
    counts = {shape: variant_overlap_count(left, right, shape).collect()[0].n for shape in SHAPES}
    assert counts == {"tables": len(a & b), "views": len(a & b), "inner_filter": len(a & b), "outer_filter": len(a | b)}
    for shape in SHAPES:
        assert plan(variant_overlap_count(left, right, shape)).count("EqualTo(chrom,1)") >= 2


def test_the_gene_is_the_region_and_not_the_effect(spark, sf_dir):
    t = Tables(spark, sf_dir)
    inputs = bindings.trios._inputs(t)
    inputs["effects"] = with_blk_pos(inputs["effects"]).withColumn("gene", F.lit("other"))
    out = P.annotate_trios(t("calls"), keep=["member", "family_id"], **inputs)
    assert "other" not in {r.gene for r in out.select("gene").distinct().collect()} and "blk_pos" not in out.columns


def test_high_risk_does_not_depend_on_the_block_column(spark, sf_dir):
    t = Tables(spark, sf_dir)
    key = S.VARIANT_KEY
    known = t("sites").select(*key).join(t("kaviar").select(*key, "kav_freq"), key, "left")
    known = known.join(t("clinvar").select(*key, "clin_sig"), key, "left")
    calls = t("calls").select("sample_id", *key, "qual", "dp", "gt")
    regions = locate_genes(t("gene_list"), t("genes"))
    coding = t("coding").select(*key, "impact")
    plain = P.nbs_high_risk(calls, regions, known, coding)
    blocked = P.nbs_high_risk(with_blk_pos(calls), regions, known, coding).drop("blk_pos")
    assert rows(plain, *sorted(plain.columns)) == rows(blocked, *sorted(plain.columns)) and plain.count() > 0


def test_annotation_tables_are_pruned_with_the_variants(spark, sf_dir, tmp_path):
    t = Tables(spark, sf_dir)
    kept = {}
    for name, columns in {"sites": ["var_id", "pos"], "kaviar": ["var_id", "kav_freq", "kav_source"]}.items():
        df = t(name).select(*columns, "chrom", "blk_pos")
        insert_partitioned(df, str(tmp_path / name))
        kept[name] = spark.read.schema(df.schema).parquet(str(tmp_path / name))
    chosen = kept["sites"].where("chrom = '1' AND blk_pos = 0")
    out = annotate_kaviar(chosen, kept["kaviar"])
    filters = [line.split("PartitionFilters: ")[1] for line in plan(out).splitlines() if "FileScan" in line]
    assert len(filters) == 2 and all("(chrom" in f and "(blk_pos" in f for f in filters)
    whole = annotate_kaviar(t("sites"), t("kaviar")).where("chrom = '1' AND blk_pos = 0")
    assert rows(out, "var_id", "kav_freq") == rows(whole, "var_id", "kav_freq")


def test_partitioned_insert_balances_partitions(spark, sf_dir, tmp_path):
    """Few files per partition, whatever the number of input tasks."""
    calls = Tables(spark, sf_dir)("calls").select("var_id", "pos", "chrom", "blk_pos").repartition(16)
    path = tmp_path / "calls"
    insert_partitioned(calls, str(path))
    files = list(path.rglob("*.parquet"))
    assert len(files) == calls.select("chrom", "blk_pos").distinct().count()
    assert spark.read.parquet(str(path)).count() == calls.count()

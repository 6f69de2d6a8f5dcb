"""Tables that grow: Bloom filter, added sources, bucketed storage, the observed gate and stored sketches."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from varloom.fixtures import load
from varloom.operators import sketches as K
from varloom.operators.aggregates import union_distinct_variants
from varloom.operators.bloom import WORDS, build_filter, filter_load, merge_filters, with_maybe
from varloom.plans import global_variants as G
from varloom.session import stage
from varloom.sources.bucketed import SORTED_SCAN, bucket_count, save_bucketed

KEY = G.KEY
KIND = "chrom string, blk_pos int, pos int, ref string, allele string"


def keys(spark, n, seed, chroms="12X"):
    rng = random.Random(seed)
    made = {(c := rng.choice(chroms), (p := rng.randrange(5_000_000)) // 1_000_000, p, rng.choice("ACGT"), rng.choice("ACGT")) for _ in range(n)}
    return spark.createDataFrame(sorted(made), KIND)


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    names = ["dbsnp", "kaviar", "clinvar", "hgmd", "dbnsfp", "coding", "genes"]
    return {n: load(spark, sf_dir, n) for n in names}


# --- Bloom filter ---------------------------------------------------------------------------------------------------


def test_filter_never_misses_and_seldom_errs(spark):
    stored, other = keys(spark, 6000, 1), keys(spark, 6000, 2)
    merged = merge_filters(build_filter(stored, KEY))
    assert with_maybe(stored, merged, KEY).where(~F.col("maybe")).count() == 0
    strange = other.join(stored, KEY, "left_anti")
    wrong = with_maybe(strange, merged, KEY).where("maybe").count()
    assert 0 < strange.count() and wrong < 0.03 * strange.count()
    assert with_maybe(other, merged, KEY).columns == [*KEY, "maybe"]
    assert rows(filter_load(merged).where("load > 0.6")) == []


def test_filter_of_batches_is_the_filter_of_all(spark):
    both = keys(spark, 3000, 3)
    first, second = both.where("pos % 2 = 0"), both.where("pos % 2 = 1")
    stored = build_filter(first, KEY)
    added = stored.unionByName(build_filter(second, KEY, known=stored))
    assert with_maybe(both, merge_filters(added), KEY).where(~F.col("maybe")).count() == 0
    assert merge_filters(added).select("chrom", "blk_pos", "segment").distinct().count() == merge_filters(added).count()


def test_filter_made_anew_replaces_the_small_one(spark):
    many = keys(spark, 4000, 4, "1")
    full = build_filter(many, KEY, per_segment=4000)
    assert full.where(" and ".join(f"{w} <> 0" for w in WORDS)).count() > 0
    stored = merge_filters(full.unionByName(build_filter(many, KEY)))
    assert stored.groupBy("chrom", "blk_pos").agg(F.count_distinct("segments").alias("n")).where("n > 1").count() == 0
    assert with_maybe(many, stored, KEY).where(~F.col("maybe")).count() == 0
    assert stored.count() > 20 * full.count()


def test_probe_of_nulls_and_nothing(spark):
    odd = spark.createDataFrame([("1", 0, 5, None, "A"), (None, None, None, None, None), ("9", 0, 5, "A", "C")], KIND)
    merged = merge_filters(build_filter(keys(spark, 50, 5), KEY))
    assert sorted((r.chrom or "", r.maybe) for r in with_maybe(odd, merged, KEY).collect()) == [("", True), ("1", True), ("9", False)]
    none = merge_filters(build_filter(odd.limit(0), KEY))
    assert none.count() == 0 and with_maybe(odd.where("chrom = '9'"), none, KEY).first().maybe is False


# --- added sources --------------------------------------------------------------------------------------------------


def as_set(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("per_segment", [32, 1_000_000])
def test_added_sources_give_the_full_build(spark, sf_dir, tables, tmp_path, per_segment):
    """Also with a filter so full that it answers 'maybe' for everything: the anti join decides."""
    names = ["clinvar", "dbsnp", "hgmd", "dbnsfp", "kaviar"]
    sources = [load(spark, sf_dir, n) for n in names]
    odd = spark.createDataFrame([("1", 0, 7, None, "A"), ("1", 0, 7, None, "A"), ("Z", 9, 9_000_001, "A", "C")], KIND)
    path = str(tmp_path / "table")
    first = G.create_global([*sources[:3], odd], path, floor=1, per_segment=per_segment, **tables)
    before = first.count()
    grown = G.extend_global([*sources[3:], odd, sources[0]], path, schema=first.schema, per_segment=per_segment, **tables)
    whole = G.global_variants([*sources, odd], **tables)
    assert as_set(grown) == as_set(whole.select(*grown.columns)) and grown.count() > before
    # The same batch once more, as after a failure, adds nothing.
    again = G.extend_global(sources[3:], path, schema=first.schema, per_segment=per_segment, **tables)
    assert again.count() == grown.count()
    G.rebuild_filter(spark, path, first.schema)
    assert G.extend_global(sources, path, schema=first.schema, **tables).count() == grown.count()


def test_a_batch_that_died_before_its_rows_is_added_again(spark, sf_dir, tables, tmp_path):
    sources = [load(spark, sf_dir, n) for n in ("hgmd", "dbnsfp")]
    path = str(tmp_path / "table")
    first = G.create_global(sources[:1], path, floor=1, **tables)
    stored = G._read_filter(spark, path)
    fresh = G.unseen_variants(sources[1:], first.select(*KEY), stored)
    build_filter(fresh, KEY, known=stored).write.mode("append").parquet(f"{path}/filter")
    grown = G.extend_global(sources[1:], path, schema=first.schema, **tables)
    assert grown.select(*KEY).distinct().count() == union_distinct_variants(*sources).count()


def test_filter_is_probed_where_the_sources_are_read(spark, sf_dir, tmp_path):
    """In the plan that makes the union distinct, both filter joins lie below its exchange and move no source row."""
    source = load(spark, sf_dir, "kaviar").withColumnRenamed("alt", "allele").select(*KEY)
    build_filter(source, KEY).write.parquet(str(tmp_path / "f"))
    merged = spark.read.schema(G.FILTER_SCHEMA).parquet(str(tmp_path / "f"))
    plan = with_maybe(source, merged, KEY).distinct()._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning") < plan.index("BroadcastHashJoin")
    source_line = next(x for x in plan.splitlines() if "FileScan" in x)
    above = plan[plan.index("BroadcastHashJoin") : plan.index(source_line)]
    assert "Exchange" not in above
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan and "Python" not in plan


def test_only_unseen_variants_are_annotated(spark, sf_dir, tables, tmp_path, monkeypatch):
    sources = [load(spark, sf_dir, n) for n in ("hgmd", "kaviar")]
    path, seen = str(tmp_path / "table"), []
    first = G.create_global(sources[:1], path, floor=1, **tables)
    plain = G.annotate_variants
    monkeypatch.setattr(G, "annotate_variants", lambda v, **t: seen.append(v.count()) or plain(v, **t))
    G.extend_global(sources, path, schema=first.schema, **tables)
    whole = union_distinct_variants(*sources).count()
    assert seen == [whole - union_distinct_variants(sources[0]).count()]


# --- gate -----------------------------------------------------------------------------------------------------------


def test_gate_reads_the_sources_once(spark, sf_dir, tables, tmp_path):
    """The count comes from the write itself: files of a source are opened by one job only."""
    path = str(tmp_path / "source")
    load(spark, sf_dir, "dbsnp").write.parquet(path)
    source = spark.read.parquet(path)
    counted = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            counted.add(b.num_rows)
            yield b

    n = source.count()
    G.write_global_variants([source.mapInArrow(count, source.schema)], str(tmp_path / "t"), floor=1, **tables)
    assert counted.value == n


def test_gate_still_raises(spark, sf_dir, tables, tmp_path):
    source = load(spark, sf_dir, "dbsnp")
    with pytest.raises(ValueError, match="annotation left"):
        G.write_global_variants([source], str(tmp_path / "t"), floor=1, coding_how="inner", **tables)
    with pytest.raises(ValueError, match="expected"):
        G.write_global_variants([source], str(tmp_path / "t"), floor=10**9, **tables)
    assert not (tmp_path / "t").exists()


# --- buckets --------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def bucketed(spark, sf_dir, tables, tmp_path_factory):
    path = tmp_path_factory.mktemp("buckets")
    names = ["dbsnp", "kaviar", "clinvar", "hgmd", "dbnsfp", "coding"]
    variants = union_distinct_variants(*[tables[n] for n in names[:4]])
    stored = {n: save_bucketed(tables[n], f"tb_{n}", 8, path=str(path / n)) for n in names}
    yield save_bucketed(variants, "tb_variants", 8, path=str(path / "variants")), stored, path
    for n in [*names, "variants"]:
        spark.sql(f"DROP TABLE tb_{n}")
    spark.conf.unset(SORTED_SCAN)


def plan_of(spark, df):
    """The plan with every keyed join as a merge join."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return df()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_six_left_joins_without_a_shuffle(spark, tables, bucketed):
    variants, stored, _ = bucketed
    plan = plan_of(spark, lambda: G.annotate_variants(variants, genes=tables["genes"], **stored))
    lines = plan.splitlines()
    joins = [i for i, x in enumerate(lines) if "SortMergeJoin" in x and "LeftOuter" in x]
    assert len(joins) == 6
    below = "\n".join(lines[joins[0] :])
    below = below[: below.index("BroadcastExchange")] if "BroadcastExchange" in below else below
    assert "Exchange" not in below and not re.search(r"\bSort \[", below)
    plain = plan_of(spark, lambda: G.annotate_variants(variants, genes=tables["genes"], **{n: tables[n] for n in stored}))
    assert plain.count("Exchange hashpartitioning") >= 6


def test_a_new_batch_is_all_that_moves(spark, sf_dir, tables, bucketed):
    _, stored, _ = bucketed
    fresh = stage(union_distinct_variants(load(spark, sf_dir, "hgmd")), "fresh")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    plan = plan_of(spark, lambda: G.annotate_variants(fresh, genes=tables["genes"], **stored))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert plan.count("Exchange hashpartitioning") == 1


def test_buckets_hold_every_row_in_one_file_each(spark, tables, bucketed):
    _, stored, path = bucketed
    for n, table in stored.items():
        assert table.count() == tables[n].count() and "alt" not in table.columns
        assert len(list((path / n).glob("*.parquet"))) <= 8
    odd = spark.createDataFrame([("1", 0, 5, None, None)] * 2 + [(None, None, None, "A", "C")], KIND)
    assert rows(save_bucketed(odd, "tb_odd", 3)) == rows(odd)
    assert save_bucketed(odd.limit(0), "tb_odd", 3).count() == 0
    spark.sql("DROP TABLE tb_odd")
    assert bucket_count(odd) == 8 and bucket_count(odd, bucket_bytes=10) == 32


# --- sketches -------------------------------------------------------------------------------------------------------


def test_sketches_merge_and_can_be_added_twice(spark, tmp_path):
    calls = spark.range(30_000).select(
        (F.col("id") % 3).cast("string").alias("chrom"), (F.col("id") % 7).cast("int").alias("blk_pos"), (F.col("id") % 20_000).cast("string").alias("sample_id")
    )
    path = str(tmp_path / "sketches")
    K.add_sketches(calls.where("blk_pos < 4"), path)
    K.add_sketches(calls.where("blk_pos >= 3"), path)
    once = rows(K.stored_samples(spark, path, ["chrom"]))
    K.add_sketches(calls.where("blk_pos >= 3"), path)
    assert rows(K.stored_samples(spark, path, ["chrom"])) == once
    whole = K.stored_samples(spark, path).first().n_samples
    assert abs(whole - 20_000) <= 600
    direct = K.estimated_samples(K.merge_sketches(K.sample_sketches(calls))).first().n_samples
    assert direct == whole
    small = spark.createDataFrame([("1", 0, "a"), ("1", 0, "a"), ("1", 0, None), ("1", 0, "b")], "chrom string, blk_pos int, sample_id string")
    assert rows(K.estimated_samples(K.sample_sketches(small))) == [("1", 0, 2)]
    assert K.sample_sketches(small.limit(0)).count() == 0
    none = K.sample_sketches(small.where("sample_id is null"))
    assert rows(K.estimated_samples(none)) == [("1", 0, 0)]

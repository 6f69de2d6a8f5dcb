"""Joins: hand-written bounds, brute-force comparisons and skew."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from varloom import schema as S
from varloom.operators import aggregates as A
from varloom.operators import joins as J
from varloom.operators.hints import with_strategy
from varloom.operators.ranges import interval_allele_join, range_join, range_join_inner


def test_interval_bounds(spark):
    points = spark.createDataFrame(
        [("1", 99), ("1", 100), ("1", 200), ("1", 201), ("1", 1_000_000), ("2", 150), ("1", None)], "chrom string, pos int"
    )
    genes = spark.createDataFrame(
        [("1", 100, 200, "a"), ("1", 150, 250, "b"), ("1", 999_000, 1_001_000, "c"), ("1", 300, 250, "empty")],
        "chrom string, start int, stop int, gene string",
    )
    out = rows(range_join(points, genes, width=50), "chrom", "pos", "gene")
    want = [
        ("1", 99, None), ("1", 100, "a"), ("1", 200, "a"), ("1", 200, "b"), ("1", 201, "b"), ("1", 1_000_000, "c"),
        ("1", None, None), ("2", 150, None),
    ]
    assert sorted(out, key=repr) == sorted(want, key=repr)
    assert rows(range_join_inner(points, genes, shift=1), "pos", "gene") == [
        (200, "a"), (200, "b"), (201, "a"), (201, "b"), (1_000_000, "c")
    ]
    assert (99, "a") in rows(range_join_inner(points, genes, pad=1), "pos", "gene")
    assert range_join(points, genes, "left_semi").count() == 4
    assert range_join(points, genes, "left_anti").count() == 3


@pytest.mark.parametrize("width", [7, 100, 5000])
@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_binned_join_equals_plain_join(spark, width, how):
    rng = random.Random(width)
    points = spark.createDataFrame([(i, rng.choice("123"), rng.randint(0, 2000)) for i in range(400)], "id int, chrom string, pos int")
    spans = [(i, rng.choice("123"), s := rng.randint(0, 2000), s + rng.randint(-5, 300)) for i in range(60)]
    intervals = spark.createDataFrame(spans, "gene int, chrom string, start int, stop int")
    right = intervals.withColumnRenamed("chrom", "c")
    plain = points.join(right, (F.col("chrom") == F.col("c")) & F.col("pos").between(F.col("start"), F.col("stop")), how)
    columns = ["id"] if how == "left_semi" else ["id", "gene"]
    assert rows(range_join(points, intervals, how, width=width), *columns) == rows(plain, *columns)


def test_many_listed_bins_are_not_broadcast(spark, monkeypatch):
    """A few intervals that cover very many bins would outgrow a broadcast that only counts intervals."""
    points = spark.range(0, 1000).select(F.lit("1").alias("chrom"), F.col("id").cast("int").alias("pos"))
    genes = spark.createDataFrame([("1", 0, 2_000_000, "long"), ("1", 10, 20, "short")], "chrom string, start int, stop int, gene string")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(range_join(points, genes, width=100_000))
    wide = range_join(points, genes, width=1)
    assert "BroadcastHashJoin" not in plan(wide)
    assert wide.where("gene = 'long'").count() == 1000 and wide.where("gene = 'short'").count() == 11


def test_only_the_blocks_of_the_regions_are_read(spark, tmp_path):
    path = str(tmp_path / "calls")
    calls = spark.range(0, 400).select(
        (F.col("id") % 2 + 1).cast("string").alias("chrom"), (F.col("id") * 50_000).cast("int").alias("pos"), "id"
    )
    calls = calls.withColumn("blk_pos", F.floor(F.col("pos") / 1_000_000).cast("int"))
    calls.write.partitionBy("chrom", "blk_pos").parquet(path)
    stored = spark.read.schema(calls.schema).parquet(path)
    genes = spark.createDataFrame([("1", 2_900_000, 3_100_000, "a")], "chrom string, start int, stop int, gene string")
    out = range_join_inner(stored, genes, block="blk_pos", width=1_000_000)
    assert rows(out, "id") == rows(range_join_inner(calls, genes), "id") == [(58,), (60,), (62,)]
    assert "dynamicpruning" in out._jdf.queryExecution().executedPlan().toString()


def test_interval_allele_join_meets_once(spark):
    calls = spark.createDataFrame(
        [("s", "1", 95, 105, "A", "T", "T"), ("s", "1", 95, 105, "A", "A", "T"), ("s", "1", 95, 105, "A", "A", "G")],
        "sample_id string, chr string, start int, stop int, ref string, allele1seq string, allele2seq string",
    )
    known = spark.createDataFrame(
        [("1", 105, "A", "T"), ("1", 106, "A", "T"), ("1", 100, "C", "T")], "chrom string, pos int, ref string, alt string"
    )
    out = rows(interval_allele_join(calls, known, widths=(10,)), "allele1seq", "pos", "alt")
    assert out == [("A", 105, "T"), ("T", 105, "T")]


def test_left_join_keeps_fan_out(spark):
    variants = spark.createDataFrame([("1", 0, "a"), ("1", 0, "b"), ("1", 0, "c")], "chrom string, blk_pos int, var_id string")
    table = spark.createDataFrame(
        [("1", 0, "a", "x"), ("1", 0, "b", "y"), ("1", 0, "b", "z")], "chrom string, blk_pos int, var_id string, id string"
    )
    out = rows(J.annotate(variants, table, {"id": "found"}), "var_id", "found")
    assert sorted(out, key=repr) == sorted([("a", "x"), ("b", "y"), ("b", "z"), ("c", None)], key=repr)


def test_join_coding_forms(spark):
    variants = spark.createDataFrame([("1", 0, "a"), ("1", 0, "b")], "chrom string, blk_pos int, var_id string")
    effects = spark.createDataFrame([("1", 0, "a", "HIGH")], "chrom string, blk_pos int, var_id string, impact string")
    assert J.join_coding(variants, effects).count() == 2
    assert J.join_coding(variants, effects, "inner").count() == 1


@pytest.fixture()
def two_tables(spark):
    rng = random.Random(3)
    draw = lambda: (rng.choice(["1", "2"]), rng.randint(1, 30), rng.choice("AC"), rng.choice("GT"))
    kind = "chrom string, pos int, ref string, alt string"
    return [spark.createDataFrame([draw() for _ in range(150)], kind) for _ in range(2)]


def test_full_merge_equals_full_outer_join(two_tables):
    a, b = two_tables
    joined = a.join(b, S.VARIANT_KEY, "full").select(*S.VARIANT_KEY).distinct()
    assert rows(J.full_merge_variants(a, b)) == rows(joined)
    only = F.col("chrom") == "1"
    assert rows(J.full_merge_variants(a, b, where=only)) == rows(joined.where(only))


def test_key_filter_reaches_both_scans(spark, tmp_path, two_tables):
    paths = []
    for i, df in enumerate(two_tables):
        paths.append(str(tmp_path / str(i)))
        df.write.partitionBy("chrom").parquet(paths[-1])
    a, b = [spark.read.schema(two_tables[0].schema).parquet(p) for p in paths]
    plan = J.full_merge_variants(a, b).where(F.col("chrom") == "1")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(chrom") == 2


def test_semi_and_anti_make_the_whole(two_tables):
    a, b = two_tables
    parts = J.members_in(a, b, S.VARIANT_KEY).unionAll(J.members_not_in(a, b, S.VARIANT_KEY))
    assert rows(parts) == rows(a)
    assert rows(J.exists_predicates(a, b, ["pos"], negate=True)) == rows(J.members_not_in(a, b, ["pos"]))


def test_unmatched_ids(spark):
    a, b = [spark.createDataFrame([(i,) for i in ids], "subject_id int") for ids in ([1, 1, 2, 3], [2, 4, 4])]
    assert sorted(rows(J.unmatched_ids(a, b, "subject_id")), key=repr) == [(1, None), (3, None), (None, 4)]


def test_strategies(spark):
    df = spark.range(10)
    assert "ResolvedHint (strategy=broadcast)" in with_strategy(df, "broadcast")._jdf.queryExecution().analyzed().toString()
    assert with_strategy(df, "broadcast", max_bytes=9) is df
    assert "shuffle_hash" in with_strategy(df, "shuffle_hash")._jdf.queryExecution().analyzed().toString()
    with pytest.raises(ValueError):
        with_strategy(df, "nested_loop")


def test_hot_key_is_split_at_run_time(spark):
    """A third of all calls at one site: the join splits that partition and loses no row."""
    keep = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    try:
        for k, v in keep.items():
            spark.conf.set(k, v)
        pos = F.when(F.col("id") % 3 == 0, 7).otherwise((F.col("id") % 5000).cast("int"))
        calls = spark.range(0, 60_000, 1, 8).select(
            F.lit("1").alias("chrom"), pos.alias("pos"), F.lit("A").alias("ref"), F.lit("C").alias("alt"), "id",
            F.xxhash64("id").alias("payload"),
        )
        known = calls.select(*S.VARIANT_KEY).distinct().withColumn("sig", F.lit("5"))
        joined = J.join_on_variant(calls, known)
        assert joined.agg(F.count_distinct("id")).collect()[0][0] == joined.count() == 60_000
        joined.write.format("noop").mode("overwrite").save()
        frame = J.left_join_variant(calls, known)
        frame.collect()
        assert "skew=true" in frame._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in keep:
            spark.conf.unset(k)


def test_set_operations(spark):
    kind = "chrom string, pos int, ref string, alt string"
    a = spark.createDataFrame([("1", 1, "A", "C")] * 3 + [("1", 2, "A", "C")], kind)
    b = spark.createDataFrame([("1", 1, "A", "C")], kind)
    assert rows(A.difference(a, b), "pos") == [(2,)]
    # Copies stay or go together, nulls are equal.
    c = spark.createDataFrame([("1", 1, "A", None)] * 2 + [("2", 5, "A", "C")] * 2, kind)
    assert rows(A.difference(c, b), "pos") == [(1,), (1,), (5,), (5,)]
    assert rows(A.difference(c, spark.createDataFrame([("1", 1, "A", None)], kind)), "pos") == [(5,), (5,)]
    merged = A.union_distinct_variants(a, b.withColumnRenamed("alt", "allele"), key=S.VARIANT_KEY)
    assert merged.columns == ["chrom", "pos", "ref", "allele"] and merged.count() == 2
    both = A.merge_genotypes(a.withColumn("s", F.lit(1)), b.withColumn("s", F.lit(2)))
    assert rows(both, "s", "pos") == [(1, 1), (1, 1), (1, 1), (2, 1)]


def test_full_outer_merge_has_one_shuffle(two_tables):
    plan = J.full_merge_variants(*two_tables)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_map_population_and_subject_order(spark):
    panel = spark.createDataFrame([(1, "GBR", "EUR"), (2, "YRI", "AFR")], "sample int, pop string, super_pop string")
    samples = spark.createDataFrame([(1,), (3,)], "sample int")
    assert rows(J.map_population(samples, panel)) == [(1, "EUR"), (3, "-")]
    assert rows(J.map_population(samples, panel, "sub")) == [(1, "GBR"), (3, "-")]
    listed = panel.select(F.col("sample").alias("family"), "sample")
    assert rows(A.append_subject(listed, "9")) == [(1, 1), (2, 2), (9, 9)]
    order = spark.createDataFrame([(3, 0), (1, 1)], "sample int, rank int")
    assert [r.sample for r in A.sort_by_reference(samples, order).collect()] == [3, 1]


def test_interval_alleles_by_length_tier(spark):
    """Calls of one base to many megabases equal the plain join; short calls meet few candidates on dense input."""
    rng = random.Random(5)
    known = [("1", rng.randint(1, 60_000_000), rng.choice("AC"), rng.choice("GT"), i) for i in range(400)]
    known += [("1", 5_000 + i // 2, "A", "GT"[i % 2], 1000 + i) for i in range(2000)]
    calls = []
    for i, length in enumerate([0, 1, 2, 999, 1000, 99_999, 100_000, 9_999_999, 10_000_000, 25_000_000] * 8):
        start = rng.choice([5_000 + rng.randint(0, 900), rng.randint(1, 40_000_000)])
        calls.append((i, "1", start, start + length, rng.choice("AC"), rng.choice("ACGT"), rng.choice("GT")))
    calls += [(900, "1", 10, 5, "A", "G", "G"), (901, "1", 5_001, 5_001, "A", "G", "G")]
    k = spark.createDataFrame(known, "chrom string, pos int, ref string, alt string, k int")
    c = spark.createDataFrame(calls, "c int, chr string, start int, stop int, ref string, allele1seq string, allele2seq string")
    want = sorted(
        (x[0], v[4]) for x in calls for v in known if v[2] == x[4] and x[2] <= v[1] <= x[3] and v[3] in (x[5], x[6])
    )
    assert rows(interval_allele_join(c, k), "c", "k") == want
    # One site in every thousand bases: bins of a call's own width hold little but its matches.
    sites = spark.createDataFrame([("1", 1000 * i + 7, "A", a, i) for i in range(100) for a in "GT"], k.schema)
    dense = spark.createDataFrame([(i, "1", 1000 * i + 6, 1000 * i + 8, "A", "G", "T") for i in range(100)], c.schema)
    found = interval_allele_join(dense, sites).count()
    short, wide = [dense.join(sites, F.expr(f"floor(start / {w}) = floor(pos / {w})")).count() for w in (1_000, 100_000)]
    assert found == 200 and short < 1.5 * found < wide

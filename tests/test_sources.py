"""Readers, writers and catalog helpers on small files."""

from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from varloom import schema as S
from varloom import session
from varloom import sources as IO
from varloom.operators import effects as E
from varloom.operators.learning import labelled_points


@pytest.fixture()
def variants(spark):
    data = [("1:5:A:C", 5, "A", "C", "1", 0), ("1:2000000:A:C", 2_000_000, "A", "C", "1", 2), ("2:7:G:T", 7, "G", "T", "2", 0)]
    return spark.createDataFrame(data, S.DISTINCT_VARIANTS)


def test_tsv_with_comments_and_columns(spark, tmp_path):
    path = tmp_path / "m.bim"
    path.write_text("# made by hand\n1\trs1\t0\t76838\tA\tC\n2\trs2\t0\t99\tG\tT\n")
    df = IO.read_tsv(spark, str(path), S.MARKER_MAP, columns=["chrom", "pos"])
    assert rows(df) == [("1", 76838), ("2", 99)]


def test_panel_header_and_family_file(spark, tmp_path):
    (tmp_path / "p.panel").write_text("sample\tpop\tsuper_pop\tgender\nHG1\tGBR\tEUR\tmale\n")
    assert rows(IO.read_tsv(spark, str(tmp_path / "p.panel"), S.PANEL, header=True)) == [("HG1", "GBR", "EUR", "male")]
    (tmp_path / "a.fam").write_text("f1 s1 0 0 1 -9\n")
    assert rows(IO.read_tsv(spark, str(tmp_path / "a.fam"), S.FAMILY_FILE, sep=" "), "subject", "sex") == [("s1", 1)]


def test_external_table(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "part-0.tsv").write_text("5\trs9\n")
    schema = T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("id", T.StringType())])
    IO.external_tsv_table(spark, "external_markers", str(tmp_path / "x"), schema)
    assert rows(spark.table("external_markers")) == [(5, "rs9")]
    spark.sql("DROP TABLE external_markers")
    assert (tmp_path / "x" / "part-0.tsv").exists()


def test_numbers_lines_csv_and_libsvm(spark, tmp_path):
    (tmp_path / "n.txt").write_text("1 2.5 3\n\n0 4 5\n")
    numbers = IO.read_numeric_lines(spark, str(tmp_path / "n.txt"))
    assert rows(numbers) == [([0.0, 4.0, 5.0],), ([1.0, 2.5, 3.0],)]
    points = labelled_points(numbers).collect()
    assert sorted((p.label, list(p.features)) for p in points) == [(0.0, [4.0, 5.0]), (1.0, [2.5, 3.0])]
    (tmp_path / "ids.txt").write_text("F-1\nM-2\n")
    assert rows(IO.read_lines(spark, str(tmp_path / "ids.txt"))) == [("F-1",), ("M-2",)]
    (tmp_path / "c.csv").write_text("a,b\n1,x\n")
    assert rows(IO.read_csv(spark, str(tmp_path / "c.csv"), "a int, b string")) == [(1, "x")]
    (tmp_path / "s.svm").write_text("1 1:0.5 3:2\n0 2:1\n")
    loaded = sorted((r.label, list(r.features.toArray())) for r in IO.read_libsvm(spark, str(tmp_path / "s.svm"), 3).collect())
    assert loaded == [(0.0, [0.0, 1.0, 0.0]), (1.0, [0.5, 0.0, 2.0])]


def test_partitioned_insert_can_run_twice(spark, tmp_path, variants):
    path = str(tmp_path / "v")
    IO.insert_partitioned(variants, path)
    IO.insert_partitioned(variants.where("chrom = '1'"), path)
    df = IO.read_variants(spark, path)
    assert dict(df.dtypes)["chrom"] == "string"
    assert rows(df, "var_id", "chrom", "blk_pos") == rows(variants, "var_id", "chrom", "blk_pos")
    plan = IO.read_variants(spark, path, S.DISTINCT_VARIANTS).where("chrom = '1' AND blk_pos = 2")
    assert "PartitionFilters: [isnotnull(chrom" in plan._jdf.queryExecution().executedPlan().toString()
    assert plan.count() == 1
    IO.insert_partitioned(variants.where("chrom = '1'"), path, mode="append")
    assert IO.read_variants(spark, path).count() == 5


def test_binary_text_reads_as_string(spark, tmp_path):
    path = str(tmp_path / "b.parquet")
    pq.write_table(pa.table({"s": pa.array([b"abc"], pa.binary())}), path)
    assert rows(IO.read_variants(spark, path)) == [("abc",)]


def test_vcf_file(spark, tmp_path):
    data = [("X", 9, "X:9:A:C"), ("10", 3, "10:3:A:C"), ("2", 800, "2:800:A:C"), ("2", 70, "2:70:A:C")]
    df = spark.createDataFrame(data, "chrom string, pos int, var_id string")
    df = df.select("*", F.lit("A").alias("ref"), F.lit("C").alias("alt"), F.lit("0/1").alias("gt")).repartition(3)
    path = str(tmp_path / "vcf")
    IO.write_vcf(E.to_vcf_rows(df, gt="gt"), path)
    parts = sorted((tmp_path / "vcf").glob("part-*"))
    lines = [line for p in parts for line in p.read_text().splitlines()]
    assert lines[0] == "##fileformat=VCFv4.0" and lines[2] == "##reference=grch37v47"
    assert lines[3].split("\t") == ["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", "GT"]
    assert [line.split("\t")[2] for line in lines[4:]] == ["2:70:A:C", "2:800:A:C", "10:3:A:C", "X:9:A:C"]
    assert lines[4].split("\t")[5:] == ["100", "PASS", ".", "GT", "0/1"]


def test_reports_and_parquet(spark, tmp_path, variants):
    path = str(tmp_path / "r")
    IO.write_report(variants, path, sep="\t")
    IO.write_report(variants, path, sep="\t", mode="append")
    assert spark.read.option("sep", "\t").option("header", True).csv(path).count() == 6
    IO.write_variants(variants, str(tmp_path / "q"))
    assert list((tmp_path / "q").glob("*.snappy.parquet"))


def test_tables(spark, variants):
    stored = IO.materialize(variants, "stored_variants")
    assert stored.count() == 3
    assert IO.materialize(variants.limit(1), "stored_variants", replace=False).count() == 3
    assert IO.materialize(variants.limit(1), "stored_variants").count() == 1
    IO.save_rows(variants, "stored_variants", append=True)
    assert spark.table("stored_variants").count() == 4
    with pytest.raises(Exception, match="already exists"):
        IO.save_rows(variants, "stored_variants")
    IO.compute_stats(spark, "stored_variants")
    details = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED stored_variants").collect()}
    assert "4 rows" in details["Statistics"]
    variants.createOrReplaceTempView("passing_variants")
    listed = rows(IO.describe_tables(spark))
    assert ("default", "stored_variants", "pos", "int") in listed and ("", "passing_variants", "pos", "int") in listed
    assert rows(IO.describe_tables(spark, "default")) == listed
    spark.sql("DROP TABLE stored_variants")


def test_views(spark, variants):
    left = variants.withColumnRenamed("allele", "alt")
    right = left.where("chrom = '2'")
    assert IO.variant_view(left, "v_left").count() == 3
    assert IO.variant_union_view(left, right, "v_any").count() == 3
    assert IO.variant_union_view(left, right, "v_any_1", chrom="1").count() == 2
    assert rows(IO.variant_union_view(left, right, "v_both", both=True), "pos") == [(7,)]
    assert rows(spark.sql("SELECT pos FROM v_both")) == [(7,)]


def test_pipe_runs_one_process_per_partition(spark, variants):
    lines = variants.select(F.col("chrom"), F.col("pos")).repartition(2)
    schema = T.StructType([T.StructField("chrom", T.StringType()), T.StructField("pos", T.IntegerType())])
    out = E.pipe_partitions(lines, "sed s/^/9/", schema)
    assert rows(out) == [("91", 5), ("91", 2_000_000), ("92", 7)]
    assert E.pipe_partitions(lines, "sed s/^/#/", schema).count() == 0
    gaps = E.pipe_partitions(variants.select(F.lit(None).cast("string").alias("chrom"), F.lit(None).alias("pos")), "cat", schema)
    assert set(rows(gaps)) == {(".", None)}
    with pytest.raises(Exception, match="non-zero|return"):
        E.pipe_partitions(lines, "false", schema).count()


def test_effect_text(spark):
    df = spark.createDataFrame(
        [("v1", "DP=3;ANN=C|missense_variant|MODERATE|G|g1|transcript|T1|coding|2/5|c.1|p.1|||| ,C|x|LOW"), ("v2", "DP=3"), ("v3", None)],
        "var_id string, info string",
    )
    out = rows(E.explode_effects(df), "var_id", "effect_no", "effect", "impact", "rank", "hgvs_p")
    want = [("v1", 0, "missense_variant", "MODERATE", 2, "p.1"), ("v1", 1, "x", "LOW", None, None)]
    assert sorted(out, key=repr) == sorted(want, key=repr)
    assert rows(E.first_effect(df), "var_id", "effect", "gene") == [("v1", "missense_variant", "G")]


def test_staging_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        conf = Conf({"spark.master": "yarn"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.staging_root(Session())
    Session.conf = Conf({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///shared/"})
    assert session.staging_root(Session()) == "hdfs:///shared"


def test_staged_folders_are_released(spark, variants, monkeypatch):
    monkeypatch.setattr(session, "_STAGED", [])
    staged = session.stage(variants, "released")
    folder = staged.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert session.release(spark) == 1 and not Path(folder).exists()


def test_configure_keeps_what_a_session_has_set(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        assert session.configure(spark).conf.get("spark.sql.session.timeZone") == "Europe/Paris"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_staged_rows_are_pruned_and_filtered_at_the_scan(spark, variants):
    staged = session.stage(variants, "test")
    assert rows(staged) == rows(variants)
    plan = staged.where("pos > 6").select("var_id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(pos), GreaterThan(pos,6)]" in plan and "ReadSchema: struct<var_id:string,pos:int>" in plan

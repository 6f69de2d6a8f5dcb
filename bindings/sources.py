"""Tables, partitioned storage and views."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from bindings.annotation import EFFECT_ROWS, FINAL
from bindings.cohort import JOINED, KEYS
from bindings.registry import query, sql
from varloom import schema as S
from varloom.functions.columns import date_stamp as stamp
from varloom.functions.columns import tidy_columns as tidy
from varloom.operators import effects as E
from varloom.session import staging_root
from varloom.sources import catalog as C
from varloom.sources import readers as R
from varloom.sources import writers as W


def _folder(t, name: str) -> str:
    return f"{staging_root(t.spark)}/{name}-{uuid.uuid4().hex}"


@query("register_table", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def register_table(t):
    R.register_table(t.spark, f"{t.sf_dir}/lineitem.parquet", "registered_lineitem")
    return t.spark.sql("SELECT l_returnflag, l_linestatus, count(*) AS n FROM registered_lineitem GROUP BY ALL")


@query("read_variants", sql("sites", "SELECT var_id, pos, ref, alt AS allele, chrom, blk_pos FROM sites"))
def read_variants(t):
    path = _folder(t, "variants")
    variants = t("sites").withColumnRenamed("alt", "allele").select(*[f.name for f in S.DISTINCT_VARIANTS.fields])
    W.insert_partitioned(variants, path)
    return R.read_variants(t.spark, path, S.DISTINCT_VARIANTS)


@query("load_effects", sql("vcf_info", FINAL, EFFECT_ROWS))
def load_effects(t):
    path = _folder(t, "effects")
    W.load_effects(E.finalize_effects(E.explode_effects(t("vcf_info"))), path)
    return R.read_variants(t.spark, path, S.EFFECT_RESULTS)


@query(
    "variant_union_view",
    sql(
        "dbsnp kaviar",
        f"""SELECT 'all' AS form, * FROM (SELECT DISTINCT {KEYS} FROM {JOINED}) UNION ALL
        SELECT 'shared', * FROM (SELECT DISTINCT {KEYS} FROM {JOINED} WHERE a.chrom IS NOT NULL AND b.chrom IS NOT NULL)""",
    ),
)
def variant_union_view(t):
    left, right = C.variant_view(t("dbsnp"), "dbsnp_view"), C.variant_view(t("kaviar"), "kaviar_view")
    every = C.variant_union_view(left, right, "either_view").select(F.lit("all").alias("form"), *S.VARIANT_KEY)
    shared = C.variant_union_view(left, right, "both_view", both=True).select(F.lit("shared").alias("form"), *S.VARIANT_KEY)
    return every.unionByName(shared)


def _path(t, name: str, write) -> str:
    """A folder under the staging root after ``write(path)`` has filled it."""
    path = _folder(t, name)
    write(path)
    return path


SITE_ROWS = "SELECT var_id, chrom, pos, ref, alt FROM sites"
SITE_TEXT = "var_id string, chrom string, pos int, ref string, alt string"


def _sites(t):
    return t("sites").select("var_id", "chrom", "pos", "ref", "alt")


@query("read_tsv", sql("sites", SITE_ROWS))
def read_tsv(t):
    lines = _sites(t).select(F.concat_ws("\t", "var_id", "chrom", "pos", "ref", "alt").alias("value"))
    noted = lines.union(t.spark.sql("SELECT '# a comment'"))
    return R.read_tsv(t.spark, _path(t, "tsv", noted.write.text), SITE_TEXT)


@query("external_tsv_table", sql("sites", "SELECT chrom, count(*) AS n, CAST(sum(pos) AS BIGINT) AS pos FROM sites GROUP BY ALL"))
def external_tsv_table(t):
    path = _path(t, "external", lambda p: W.write_report(_sites(t), p, sep="\t"))
    name = f"external_{uuid.uuid4().hex}"
    rows = R.read_tsv(t.spark, path, SITE_TEXT, header=True)
    plain = _path(t, "external-plain", lambda p: rows.write.option("sep", "\t").csv(p))
    C.external_tsv_table(t.spark, name, plain, rows.schema)
    return t.spark.table(name).groupBy("chrom").agg(F.count("*").alias("n"), F.sum("pos").alias("pos"))


@query("read_numeric_lines", "SELECT l_quantity AS a, l_discount AS b, l_tax AS c FROM lineitem")
def read_numeric_lines(t):
    lines = t("lineitem").select(F.concat_ws(" ", "l_quantity", "l_discount", "l_tax").alias("value"))
    values = R.read_numeric_lines(t.spark, _path(t, "numbers", lines.write.text))
    return values.select(*[F.get("values", F.lit(i)).alias(n) for i, n in enumerate("abc")])


@query("read_libsvm", "SELECT l_linenumber * 1.0::DOUBLE AS label, l_quantity AS f1, l_tax AS f2 FROM lineitem")
def read_libsvm(t):
    from pyspark.ml.functions import vector_to_array

    lines = t("lineitem").select(F.format_string("%d 1:%s 2:%s", "l_linenumber", F.col("l_quantity").cast("string"), F.col("l_tax").cast("string")).alias("value"))
    points = R.read_libsvm(t.spark, _path(t, "libsvm", lines.write.text), 2)
    values = vector_to_array("features")
    return points.select("label", F.get(values, F.lit(0)).alias("f1"), F.get(values, F.lit(1)).alias("f2"))


@query("read_csv", sql("sites", SITE_ROWS))
def read_csv(t):
    return R.read_csv(t.spark, _path(t, "csv", lambda p: W.write_report(_sites(t), p)), SITE_TEXT)


@query("read_lines", sql("sites", "SELECT var_id AS id FROM sites"))
def read_lines(t):
    return R.read_lines(t.spark, _path(t, "ids", t("sites").select("var_id").write.text))


RANK = "CASE WHEN chrom = 'X' THEN 23 WHEN chrom = 'Y' THEN 24 WHEN chrom IN ('M', 'MT') THEN 25 ELSE CAST(chrom AS INT) END"


@query(
    "write_vcf",
    sql(
        "sites",
        f"""SELECT line, row_number() OVER (ORDER BY rank, pos, line) AS place FROM (SELECT {RANK} AS rank, pos,
        concat_ws(chr(9), chrom, pos, var_id, ref, alt, '100', 'PASS', '.', 'GT', '.') AS line FROM sites)""",
    ),
)
def write_vcf(t):
    """Body lines with their place in the file, which is the order of parts and of lines inside a part."""
    path = _path(t, "vcf", lambda p: W.write_vcf(E.to_vcf_rows(_sites(t)), p))
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int")
    lines = t.spark.read.text(path).select(F.col("value").alias("line"), part.alias("part"), F.monotonically_increasing_id().alias("at"))
    body = lines.where(~F.col("line").startswith("#"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("at"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = body.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return body.withColumn("inside", inside).join(starts, "part").select("line", (F.col("start") + F.col("inside")).alias("place"))


@query("write_report", sql("sites", f"{SITE_ROWS} UNION ALL {SITE_ROWS} WHERE chrom = 'X'"))
def write_report(t):
    def write(path):
        W.write_report(_sites(t), path)
        W.write_report(_sites(t).where("chrom = 'X'"), path, mode="append")

    return R.read_csv(t.spark, _path(t, "report", write), SITE_TEXT)


@query("write_variants", sql("sites", SITE_ROWS))
def write_variants(t):
    return t.spark.read.parquet(_path(t, "plain", lambda p: W.write_variants(_sites(t), p)))


@query(
    "insert_append",
    sql("sites", "SELECT var_id, chrom, blk_pos FROM sites UNION ALL SELECT var_id, chrom, blk_pos FROM sites WHERE chrom IN ('1', 'X')"),
)
def insert_append(t):
    rows = t("sites").select("var_id", "chrom", "blk_pos")

    def write(path):
        W.insert_partitioned(rows, path)
        W.insert_partitioned(rows.where("chrom IN ('1', 'X')"), path, mode="append")

    return R.read_variants(t.spark, _path(t, "appended", write), rows.schema)


def _table(t, name: str) -> tuple[str, str]:
    return f"{name}_{uuid.uuid4().hex}", _folder(t, name)


@query("materialize", sql("sites", SITE_ROWS))
def materialize(t):
    name, path = _table(t, "materialized")
    W.materialize(_sites(t), name, path=path)
    return W.materialize(_sites(t).where("chrom = 'X'"), name, replace=False)


@query("save_rows", sql("sites", f"{SITE_ROWS} UNION ALL {SITE_ROWS} WHERE chrom = '2'"))
def save_rows(t):
    name, path = _table(t, "saved")
    W.save_rows(_sites(t), name, path=path)
    W.save_rows(_sites(t).where("chrom = '2'"), name, append=True)
    return t.spark.table(name)


@query(
    "describe_tables",
    """SELECT column_name AS "column", CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'BIGINT' THEN 'bigint'
    ELSE 'int' END AS type FROM (DESCRIBE SELECT l_orderkey, l_quantity, l_returnflag FROM lineitem)""",
)
def describe_tables(t):
    name = f"described_{uuid.uuid4().hex}"
    C.variant_view(t("lineitem").select("l_orderkey", "l_quantity", "l_returnflag"), name)
    return C.describe_tables(t.spark, "default").where(F.col("table") == name).select("column", "type")


@query("compute_stats", sql("sites", "SELECT count(*) AS n_rows, min(pos) AS low, max(pos) AS high FROM sites"))
def compute_stats(t):
    name, path = _table(t, "analyzed")
    W.save_rows(_sites(t), name, path=path)
    C.compute_stats(t.spark, name)
    size = t.spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Statistics'").select(F.regexp_extract("data_type", r"(\d+) rows", 1).cast("long").alias("n_rows"))
    column = t.spark.sql(f"DESCRIBE EXTENDED {name} pos").where("info_name IN ('min', 'max')")
    bounds = {r["info_name"]: int(r["info_value"]) for r in column.collect()}
    return size.select("n_rows", F.lit(bounds["min"]).alias("low"), F.lit(bounds["max"]).alias("high"))


@query("tidy_columns", sql("calls", "SELECT gt AS genotype, var_id, sample_id FROM calls"))
def tidy_columns(t):
    wide = t("calls").select("var_id", "sample_id", "gt", F.lit(1).alias("pos_y"), F.lit(2).alias("ref_y"))
    return tidy(wide, ["genotype", "var_id", "sample_id"], "_y", {"gt": "genotype"})


@query("date_stamp", sql("sites", "SELECT var_id || '_' || strftime(current_date, '%y%m%d') AS name FROM sites"))
def date_stamp(t):
    return t("sites").select(F.concat_ws("_", "var_id", stamp()).alias("name"))

"""Variant-effect text: VCF lines out, an external annotator per partition, annotation text back into columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varloom import schema as S
from varloom.functions.columns import with_blk_pos

_EFFECT_OUTPUT = [
    "gene", "gene_id", "effect", "impact", "feature", "feature_id", "biotype", "rank", "distance", "hgvs_c", "hgvs_p",
]


def _field(parts: Column, name: str) -> Column:
    """One sub-field by name; null when the entry is shorter or the field empty. The rank may read ``2/5``."""
    value = F.nullif(F.get(parts, F.lit(S.EFFECT_FIELDS.index(name))), F.lit(""))
    return F.get(F.split(value, "/"), F.lit(0)).try_cast("int") if name == "rank" else value


def _entries(info: str) -> Column:
    """The annotation entries of an INFO text; empty without an ANN key."""
    return F.split(F.regexp_extract(F.col(info), r"(?:^|;)ANN=([^;]*)", 1), ",")


def explode_effects(vcf: DataFrame, info: str = "info") -> DataFrame:
    """One row per listed effect, numbered from 0 in file order; records without annotation give none."""
    keep = [c for c in vcf.columns if c != info]
    listed = vcf.select(*keep, F.posexplode(_entries(info)).alias("effect_no", "__entry")).where(F.col("__entry") != "")
    parts = F.split("__entry", r"\|")
    return listed.select(*keep, "effect_no", *[_field(parts, f).alias(f) for f in _EFFECT_OUTPUT])


def first_effect(vcf: DataFrame, info: str = "info") -> DataFrame:
    """Only the first listed effect, which is the most damaging one; read in place, without a window or shuffle."""
    keep = [c for c in vcf.columns if c != info]
    entry = F.get(_entries(info), F.lit(0))
    parts = F.split(entry, r"\|")
    return vcf.where(entry != "").select(*keep, *[_field(parts, f).alias(f) for f in _EFFECT_OUTPUT])


def finalize_effects(df: DataFrame, width: int = S.BLOCK_WIDTH) -> DataFrame:
    """Effect rows in table order: comment rows dropped, typed, chromosome last, then the position block."""
    rows = df.where(~F.col("chrom").startswith("#")).withColumnRenamed("effect", "affect")
    return with_blk_pos(rows.withColumn("pos", F.col("pos").cast("int")), width).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.EFFECT_RESULTS.fields]
    )


def to_vcf_rows(df: DataFrame, qual: int = 100, filter_: str = "PASS", gt: str | None = None) -> DataFrame:
    """Variant rows in VCF column order, with constants where the table has no value."""
    listed = df.columns
    alt = "alt" if "alt" in listed else "allele"
    columns = ["qual", "filter"]
    constants = {"qual": F.lit(qual), "filter": F.lit(filter_)}
    call = F.lit(".") if gt is None else F.coalesce(F.col(gt), F.lit("."))
    return df.select(
        F.col("chrom").alias("CHROM"),
        F.col("pos").alias("POS"),
        F.col("var_id").alias("ID"),
        F.col("ref").alias("REF"),
        F.col(alt).alias("ALT"),
        *[(F.col(c) if c in listed else constants[c]).alias(c.upper()) for c in columns],
        F.lit(".").alias("INFO"),
        F.lit("GT").alias("FORMAT"),
        call.alias("GT"),
    )


def tab_line(columns: Sequence[str]) -> Column:
    """A row as one tab-separated line; a missing value is a dot."""
    return F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in columns])


def pipe_partitions(df: DataFrame, command: str, schema: T.StructType, sep: str = "\t") -> DataFrame:
    """Rows as tab text through one external process per partition, and its output lines back as typed rows."""
    return pipe_chain(df, [command], schema, sep=sep)


def pipe_chain(
    df: DataFrame, commands: Sequence[str], schema: T.StructType, sep: str = "\t", timeout: float | None = None, error_bytes: int = 4096
) -> DataFrame:
    """Rows as tab text through a chain of external processes per partition, and the last one's lines back as typed rows.

    Each process reads what the one before it writes, through the system's pipes, so a slow one holds the others back and no
    output piles up. Lines that start with ``#`` are skipped, and an empty or dotted cell of a non-text column is null.

    If any process fails, or the whole chain takes more than ``timeout`` seconds in a partition, all of them are ended and the task
    fails with the command, its status and the last ``error_bytes`` of its error text; Spark then retries the task. A process
    that stops reading early is no failure if it ends well. No process outlives its task. Lines cross to Python in Arrow batches,
    are written by a thread of its own while output is read, and are built and parsed by Spark functions.
    """
    if not commands:
        raise ValueError("a chain needs at least one command")

    # What runs in tasks refers only to installed packages, so executors need no copy of this one.
    def run(batches):
        import shlex
        import subprocess
        import threading

        import pyarrow as pa

        chain, errors, failed, culprits, late = [], [], [], [], threading.Event()

        def end_all():
            for process in chain:
                if process.poll() is None:
                    process.kill()

        def feed(sink):
            try:
                for batch in batches:
                    text = "".join(f"{line}\n" for line in batch.column(0).to_pylist())
                    sink.write(text.encode())
                sink.close()
            except BrokenPipeError:
                pass  # the exit codes tell
            except Exception as error:
                failed.append(error)
                end_all()

        def watch(i):
            code = chain[i].wait()
            # A process cut off by the early end of a later one has not failed.
            if code and not (code == -13 and i + 1 < len(commands)) and not late.is_set() and not culprits:
                culprits.append((i, code))
                end_all()

        def keep_tail(stream, held):
            for piece in iter(lambda: stream.read1(4096), b""):
                held[:] = [(b"".join(held) + piece)[-error_bytes:]]

        def too_late():
            late.set()
            end_all()

        def rows(lines):
            return pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["line"])

        threads = []
        clock = threading.Timer(timeout, too_late) if timeout else None
        try:
            for command in commands:
                source = chain[-1].stdout if chain else subprocess.PIPE
                chain.append(subprocess.Popen(shlex.split(command), stdin=source, stdout=subprocess.PIPE, stderr=subprocess.PIPE))
                if source is not subprocess.PIPE:
                    source.close()  # the next process alone holds that end, so an early end is felt upstream
                errors.append([])
                threads.append(threading.Thread(target=keep_tail, args=(chain[-1].stderr, errors[-1]), daemon=True))
            threads.append(threading.Thread(target=feed, args=(chain[0].stdin,), daemon=True))
            threads += [threading.Thread(target=watch, args=(i,), daemon=True) for i in range(len(chain))]
            for thread in threads:
                thread.start()
            if clock:
                clock.start()
            held: list[str] = []
            for line in chain[-1].stdout:
                text = line.decode().rstrip("\n")
                if text and not text.startswith("#"):
                    held.append(text)
                if len(held) >= 10_000:
                    yield rows(held)
                    held = []
            for thread in threads:
                thread.join()
            if late.is_set():
                raise RuntimeError(f"the processes took more than {timeout} seconds")
            if failed:
                raise failed[0]
            if culprits:
                i, code = culprits[0]
                said = b"".join(errors[i]).decode(errors="replace").strip()
                raise RuntimeError(f"{commands[i]!r} returned non-zero exit status {code}: {said}")
            if held:
                yield rows(held)
        finally:
            if clock:
                clock.cancel()
            end_all()
            for process in chain:
                process.wait()

    lines = df.select(tab_line(df.columns).alias("line")).mapInArrow(run, "line string")
    cells = F.split("line", sep)

    def cell(i: int, kind: T.DataType) -> Column:
        value = F.get(cells, F.lit(i))
        return value if kind == T.StringType() else F.when(~value.isin("", "."), value).cast(kind)

    return lines.select(*[cell(i, f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])

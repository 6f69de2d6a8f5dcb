"""Reports over genotypes compute their calls once, and tasks of merged partitions stay small."""

from tests.conftest import rows
from varloom import session
from varloom.operators import pruning as P
from varloom.operators import statistics as A
from varloom.plans.ancestry import ancestry_inputs

KIND = "subject_id long, chrom string, pos int, ref string, alt string, {}"


def _counted(df):
    """The frame, computed by tasks that count its rows each time they make them."""
    seen = df.sparkSession.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    return df.mapInPandas(run, df.schema), seen


def _dosages(spark):
    made = [(s, c, p, "A", "C", (s * p // 7) % 3) for s in range(130) for c in "12" for p in range(100, 1300, 100) if (s + p // 100) % 4]
    odd = [(None, "1", 100, "A", "C", 1), (5, "1", 5000, "A", "C", None), (5, None, 100, "A", "C", 1), *made[:3]]
    return spark.createDataFrame(made + odd, KIND.format("dosage int"))


def _pairs(found, window, step):
    """Sums over the samples called at both markers, pair by pair."""
    order = {}
    for c in "12":
        order |= {m: i for i, m in enumerate(sorted({m for m in found if m[0] == c}))}
    out = []
    for a, i in order.items():
        for b, j in order.items():
            if a[0] == b[0] and i < j < i // step * step + window:
                both = [(x, found[b][s]) for s, x in found[a].items() if s in found[b]]
                n, sx, sy = len(both), sum(x for x, _ in both), sum(y for _, y in both)
                vx, vy = n * sum(x * x for x, _ in both) - sx * sx, n * sum(y * y for _, y in both) - sy * sy
                cov = n * sum(x * y for x, y in both) - sx * sy
                if n:
                    out.append((a[0], i, j, n, round(cov * cov / (vx * vy), 9) if vx and vy else None))
    return sorted(out)


def test_pairs_of_many_samples_from_one_shuffle(spark):
    dosages, seen = _counted(_dosages(spark))
    found = {}
    for r in _dosages(spark).collect():
        if r.chrom and r.subject_id is not None:
            of = found.setdefault((r.chrom, r.pos), {})
            if r.dosage is not None:
                of[r.subject_id] = r.dosage
    for window, step in ((4, 2), (1, 1), (50, 5)):
        pairs = A.ld_pairs(dosages, window, step)
        got = sorted((r.chrom, r.idx_i, r.idx_j, r.n, r.r2 if r.r2 is None else round(r.r2, 9)) for r in pairs.collect())
        assert got == _pairs(found, window, step)
    assert seen.value == 3 * _dosages(spark).count()
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan[: plan.index("Window")]


def test_dosages_of_pruning_are_computed_once(spark):
    plain = _dosages(spark)
    dosages, seen = _counted(plain)
    frequencies, counted = _counted(A.dosage_frequency(plain, 130))
    kept = P.prune_by_frequency(dosages, frequencies, 4, 2, 0.1)
    assert rows(kept, "chrom", "pos")
    assert seen.value == plain.count() and counted.value == A.dosage_frequency(plain, 130).count()


def test_calls_of_ancestry_inputs_are_computed_once(spark):
    gt = lambda s, p: (None, "0/1", "1/1", "0/1")[(s + p) % 4]
    made = [(s, "1", p, "A", "C", gt(s, p), None) for s in range(40) for p in range(1, 9) if (s * p) % 5 == 1]
    calls = spark.createDataFrame(made, KIND.format("gt string, rs_id string"))
    panel = spark.createDataFrame([(s, "x", "X") for s in range(30)], "sample long, pop string, super_pop string")
    known, seen = _counted(calls.where("subject_id < 30"))
    new, counted = _counted(calls.where("subject_id >= 30"))
    out = ancestry_inputs(known, new, panel, low=0.0, cutoff=2.0)
    assert {r.known_pop for r in out.collect()} == {"X", "-"}
    assert seen.value == calls.where("subject_id < 30").count()
    assert counted.value == calls.where("subject_id >= 30").count()


def test_merged_partitions_are_small_unless_the_session_says_otherwise(spark):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    other = spark.newSession()
    assert spark.conf.get(name) == "8m"
    other.conf.set(name, "5m")
    assert session.configure(other).conf.get(name) == "5m"

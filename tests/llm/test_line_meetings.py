"""Near-duplicate lines meet on shared keys only, in one shuffle."""

import random

from pyspark.sql import functions as F

from varloom.llm import lines as L


def _docs(spark):
    rng = random.Random(4)
    base = ["".join(rng.choice("aab cd") for _ in range(30)) for _ in range(12)]
    texts = []
    for k in range(40):
        line = list(base[k % 12])
        if k >= 12:
            at = rng.randrange(len(line))
            line[at : at + 1] = rng.choice([["z"], [], [line[at]] * 2, [line[at]]])
        texts.append("".join(line))
    texts += ["one line that is like no other line here, number " + w for w in ("twenty", "ninety-eight", "four")]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), [t.strip() for t in texts]


def test_earliest_line_within_one_edit(spark):
    docs, texts = _docs(spark)
    want = {}
    for i, line in enumerate(texts):
        near = [j for j in range(i) if texts[j] != line and L.within_one(texts[j], line)]
        same = [j for j in range(i) if texts[j] == line]
        others = [j for k in range(len(texts)) if texts[k] == line for j in range(k) if texts[j] != line and L.within_one(texts[j], line)]
        first = min(k for k in range(len(texts)) if texts[k] == line)
        others = [j for j in others if j < first]
        if near and others:
            want[i] = (min(others), 1)
        elif same:
            want[i] = (min(same), 0)
    found = {r.doc_id: (r.kept_doc_id, r.distance) for r in L.duplicate_lines(docs).collect()}
    assert found == want and any(d == 1 for _, d in want.values()) and any(d == 0 for _, d in want.values())


def test_only_variants_of_shared_keys_go_on(spark):
    """Lines without a neighbour stop at the count of their keys; what goes on takes one shuffle."""
    docs, texts = _docs(spark)
    lines = spark.createDataFrame([(i, t) for i, t in enumerate(dict.fromkeys(texts))], "h long, text string")
    spelled = L.variants(lines).cache()
    shared = L.shared_keys(spelled)
    assert shared.count() * 4 < spelled.count()
    placed = spelled.join(F.broadcast(shared), "key", "left_semi").withColumn("place", F.struct(F.col("h").alias("doc_id"), F.lit(0).alias("line")))
    met = L.meetings(placed)
    assert met._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(key") <= 2  # the count and the meeting
    got = {(r.h, r.to.h) for r in met.collect()}
    assert got and all(to < h for h, to in got)
    spelled.unpersist()

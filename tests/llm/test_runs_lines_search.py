"""Periodic runs, line-first cleaning and ranked search: brute force, odd rows, empty tables, clashing columns."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from varloom.llm import lexical, line_rules, periods, queries
from varloom.llm.lexical import ranked_documents
from varloom.llm.line_rules import cleaned_lines
from varloom.llm.periods import frequent_segments, periodic_runs, runs_of, scan_lags
from varloom.llm.queries import with_planted_periods
from varloom.llm.words import words_of

DOC = "doc_id long, text string, lang string, source string, n_words long, runs long, term string, item long, score long, kept int, w int"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "en", "s", 1, 2, "t", 3, 4, 5, 6) for i, t in rows], DOC).repartition(parts)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# ------------------------------------------------------------------------------------------------------ periodic runs


def brute_runs(w):
    """Every stretch for every period, the smallest period of a stretch kept."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = j
    return sorted((s, n, q) for (s, n), q in found.items())


def texts_with_runs(rng, n):
    out = []
    for _ in range(n):
        w = [rng.choice("abcdefgh"[: rng.choice([1, 2, 3, 5, 8])]) for _ in range(rng.randint(0, 50))]
        if rng.random() < 0.6:
            base = [rng.choice("abAB") for _ in range(rng.randint(1, 9))]
            w += (base * rng.randint(2, 9))[: rng.randint(1, 80)] + [rng.choice("abc") for _ in range(rng.randint(0, 10))]
        out.append(w * rng.randint(2, 6) if rng.random() < 0.3 else w)
    return out


def test_runs_against_brute_force():
    rng = random.Random(1)
    met = 0
    for _ in range(120):
        listed = texts_with_runs(rng, 6)
        batch = pa.RecordBatch.from_arrays([pa.array([" ".join(w) for w in listed])], names=["text"])
        split = words_of(batch, "text", fold=False)
        text, start, length, period = (x.tolist() for x in runs_of(split, split.hashes()))
        got = list(zip(text, start, length, period, strict=True))
        want = [(t, *run) for t, w in enumerate(listed) for run in brute_runs(w)]
        assert got == want
        met += len(want)
    assert met > 500


def test_splitting_only_saves_work(monkeypatch):
    """Without a single round of splitting the scan finds the same runs."""
    rng = random.Random(2)
    for w in texts_with_runs(rng, 60):
        ids = np.array([ord(x) for x in w], np.uint64)
        whole = np.zeros(len(ids), np.int64)
        split = scan_lags(ids, *frequent_segments(ids, whole))
        with monkeypatch.context() as m:
            m.setattr(periods, "ROUNDS", 0)
            plain = scan_lags(ids, *frequent_segments(ids, whole))
        assert sorted(zip(*[x.tolist() for x in split], strict=True)) == sorted(zip(*[x.tolist() for x in plain], strict=True))


def test_rare_words_split_until_stable():
    """The c's part the a's into stretches in which b gets rare as well."""
    text = "a b a b a b a c a a a a a a a c a b a".split()
    place, segment = frequent_segments(np.array([ord(x) for x in text], np.uint64), np.zeros(len(text), np.int64))
    assert place.tolist() == list(range(8, 15)) and len(set(segment.tolist())) == 1


def expected_op11(doc_id, text):
    w = words(text)
    if doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs = brute_runs(w)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = None
    for s, n, q in runs:
        if best is None or n * best[2] > best[1] * q:
            best = (s, n, q)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    kept = " ".join(x for i, x in enumerate(w) if i not in dropped)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(kept))


def test_query_of_runs(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, rng.choice([" ", "\n", "\t "]).join(w)) for i, w in enumerate(texts_with_runs(rng, 150))]
    rows += [(200 + i, " ".join(f"w{rng.randint(0, 9)}é" for _ in range(rng.randint(1, 400)))) for i in range(60)]
    rows += [(500, None), (501, ""), (502, " \n "), (None, "a a a a a a a"), (503, "x " * 5000), (503, "x " * 5000), (504, "a A a A a A a A a A"), (-7, "b b b b b b")]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect()]
    assert Counter(got) == Counter(expected_op11(*r) for r in rows)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows if i is not None) > 5


def test_runs_keep_texts_and_columns(spark):
    rows = [(1, "go go go go go go now"), (2, None), (None, "one two")]
    got = {r.doc_id: (r.lang, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(frame(spark, rows), keep=("doc_id", "lang")).collect()}
    assert got == {1: ("en", 7, [(0, 6, 1)], "go now"), 2: ("en", 0, [], ""), None: ("en", 2, [], "one two")}
    assert periodic_runs(frame(spark, [])).count() == 0
    assert with_planted_periods(frame(spark, [])).count() == 0


# ---------------------------------------------------------------------------------------------------------- line rules


def brute_counts(text):
    text = text or ""
    w = words(text)
    windows = defaultdict(list)
    for i in range(len(w) - 2):
        windows[tuple(w[i : i + 3])].append(i)
    covered = {i + k for places in windows.values() if len(places) > 1 for i in places for k in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_counts_against_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", " \n\t ", "a b", "a b c", "a b c a b c", "a a a a", "é｡ ü\n\né｡ ü", "x\x0by\x0cz\r\n x", "ab c a bc " * 3]
    for _ in range(150):
        some = [rng.choice(["a", "b", "ab", "c|", "#é", "d."]) + str(rng.randint(0, rng.choice([1, 5, 40]))) for _ in range(rng.randint(1, 120))]
        texts.append("".join(x + rng.choice([" ", " ", " ", "\n", "  "]) for x in some))
    texts.append(" ".join(f"{i % 700} w" for i in range(20_000)))
    rows = list(enumerate(texts)) + [(None, "a b"), (3, "repeated id")]
    got = Counter((r.doc_id, *[r[c] for c in COUNTS]) for r in cleaned_lines(frame(spark, rows)).collect())
    assert got == Counter((i, *brute_counts(t)) for i, t in rows)


def prose(n):
    return "\n".join(" ".join(f"w{(i * 20 + k) ** 2 % 9973}" for k in range(20)) + "." for i in range(n))


@pytest.mark.parametrize(
    "line, rule",
    [
        ("Home | News | Sport | Weather | Contact", "navigation"),
        ("Start » Shop » Shoes", "navigation"),
        ("Skip to main content", "navigation"),
        ("© 2021 Example Corp. All rights reserved.", "boilerplate"),
        ("By going on you accept our Cookie Policy.", "boilerplate"),
        ("a$$$ b%%% c### d&&& e***", "symbols"),
        ("BUY!! NOW!! ALL!! MUST!! GO!!", "marks"),
        ("just some words in a row", "no_sentence"),
        ("She left.", None),
        ("“Is it so?”", None),
        ("They came early. Then the rest of the line was cut", None),
        ("彼は来た。", None),
        ("Contact with the enemy was lost at noon.", None),
        ("   ", None),
    ],
)
def test_line_rules(spark, line, rule):
    row = cleaned_lines(frame(spark, [(1, f"{prose(6)}\n{line}")])).first()
    assert list(row.lost) == ([rule] if rule else []) and row.kept
    assert row.cleaned == (prose(6) if rule else f"{prose(6)}\n{line}")


def test_documents_that_lose_too_much_go(spark):
    menu = "Home | News | Sport | Weather | Contact"
    rows = [(1, prose(6)), (2, "\n".join([prose(6), *[menu] * 4])), (3, "\n".join([prose(6), *[menu + f" | x{i}" for i in range(12)]])), (4, prose(2)), (5, None)]
    got = {r.doc_id: (r.kept, r.base_failed) for r in cleaned_lines(frame(spark, rows)).collect()}
    assert got == {1: (True, False), 2: (True, False), 3: (False, False), 4: (False, True), 5: (False, True)}
    assert cleaned_lines(frame(spark, [])).count() == 0


def test_line_rules_are_native(spark):
    plan = cleaned_lines(frame(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    # The one exchange is the test's own repartition.
    assert plan.count("Exchange") == 1


# --------------------------------------------------------------------------------------------------------- lexical search


def terms(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute_ranks(docs, items, top=10):
    listed = [(i, terms(t)) for i, t in docs]
    big_n, big_l = sum(bool(t) for _, t in listed), sum(len(t) for _, t in listed)
    df = Counter(x for _, t in listed for x in set(t))
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(terms(t))
    out = Counter()
    for item, want in wanted.items():
        scores = []
        for doc_id, t in listed:
            tf = Counter(t)
            score = 0
            for x in want & set(tf):
                w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[x] + 1)))
                m = 100 - 90 + (90 * len(t) * big_n) // big_l
                score += w * ((1000000000 * tf[x]) // (1000 * tf[x] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scores, key=lambda s: s[:3])[:top], 1):
            out[(item, rank, doc_id, -score)] += 1
    return out


def corpus(rng, n):
    word = lambda: rng.choice(["a", "b", "AB", "ab", "x1", "é", "ß9", "Zoo", "zoo", "q"]) + rng.choice(["", "", "b", "2"])
    return [(i, "".join(word() + rng.choice([" ", ", ", "-", "\n", "\x00", "  "]) for _ in range(rng.randint(0, 40)))) for i in range(n)]


def item_frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "item_id long, text string, doc_id long, rank int")


def test_ranks_against_brute_force(spark):
    rng = random.Random(7)
    docs = corpus(rng, 120) + [(200, None), (201, ""), (202, "--- !"), (None, "zoo zoo"), (None, "zoo zoo"), (203, "zoo zoo"), (203, "zoo zoo"), (204, "ab " * 9000)]
    items = [(1, "Zoo ab"), (2, "é-ß9"), (3, None), (4, "nowhere"), (5, "a b, a b"), (None, "x1 q"), (5, "q2"), ((1 << 53) + 1, "AB zoo x1b"), (-4, "b")]
    want = brute_ranks(docs, items)
    got = Counter(tuple(r) for r in ranked_documents(frame(spark, docs), item_frame(spark, items)).collect())
    assert got == want and sum(want.values()) > 40


def test_blocks_of_items_do_not_change_ranks(spark, monkeypatch):
    rng = random.Random(8)
    docs, items = corpus(rng, 80), [(i, " ".join(t for _, t in corpus(rng, 2))) for i in range(12)]
    monkeypatch.setattr(lexical, "SALT", 1)
    got = Counter(tuple(r) for r in ranked_documents(frame(spark, docs, 7), item_frame(spark, items), top=3, max_pairs=40).collect())
    assert got == brute_ranks(docs, items, 3)


def test_search_of_nothing(spark):
    some = [(1, "a b")]
    assert ranked_documents(frame(spark, []), item_frame(spark, some)).count() == 0
    assert ranked_documents(frame(spark, some), item_frame(spark, [])).count() == 0
    assert ranked_documents(frame(spark, [(1, None)]), item_frame(spark, some)).count() == 0
    assert ranked_documents(frame(spark, some), item_frame(spark, [(1, "-")])).columns == ["item_id", "rank", "doc_id", "score"]


@pytest.mark.parametrize("name", ["op12_quality_rules", "op13_lexical_search"])
def test_queries_match_their_oracles(spark, sf_dir, name):
    from tests.compare import compare

    duck = duckdb.connect()
    for table in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    assert compare(spark, duck, queries.QUERIES[name], queries.ORACLES[name], sf_dir)[0] == "ok"


def test_clean_documents_stay(spark, sf_dir):
    """Of documents labelled good with enough words, none is rejected; of those labelled bad, none stays."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = queries.op12_quality_rules(spark, sf_dir).join(labels, "doc_id")
    bad = judged.where("(quality = 1 and not base_failed and not kept) or (quality = 0 and kept)")
    assert bad.count() == 0 and line_rules.MAX_LOST == 30
    assert judged.where(F.col("kept")).count() > 0


# -------------------------------------------------------------------------------------------------------- decontamination


def test_item_ids_come_back_as_they_are(spark):
    """Null, negative and large ids, which a column of doubles could not hold."""
    from varloom.llm.decontaminate import contaminated

    rng = random.Random(31)
    made = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))
    ids = [(1 << 53) + 1, None, -5, 7, (1 << 63) - 1]
    items = [(i, made(30) + ". " + made(4) + ".") for i in ids]
    docs = [(k, made(40) + " " + t + " " + made(40)) for k, (_, t) in enumerate(items)] + [(9, made(90))]
    bench = spark.createDataFrame([*items, (3, None), (None, "")], "item_id long, text string")
    for size in (5_000, 2):
        got = {(r.doc_id, r.item_id): r.cosine for r in contaminated(frame(spark, docs), bench, items_per_pass=size).collect()}
        assert set(got) == {(k, i) for k, i in enumerate(ids)} and all(c > 0.8 for c in got.values())


def test_far_windows_are_no_candidates(spark, monkeypatch):
    """The cosine decides what is looked at: with a threshold over 1 nothing is, whatever the shared words."""
    from varloom.llm import decontaminate

    text = " ".join(f"w{i}" for i in range(40))
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    assert decontaminate.contaminated(frame(spark, [(1, text)]), bench).count() == 1
    monkeypatch.setattr(decontaminate, "COSINE", 1.1)
    assert decontaminate.contaminated(frame(spark, [(1, text)]), bench).count() == 0


def test_dense_and_sparse_products_agree(monkeypatch):
    from varloom.llm import decontaminate

    rng = np.random.default_rng(4)
    key = np.unique(rng.integers(0, 3000, 4000) * 100 + rng.integers(0, 100, 4000))
    passage, term, probe = key // 100, key % 100, rng.normal(size=(100, 7)).astype(np.float32)
    whole = np.zeros((3000, 100))
    whole[passage, term] = 1
    for most in (4096, 0):
        monkeypatch.setattr(decontaminate, "DENSE", most)
        total = np.zeros((100, 7))
        decontaminate._times_itself(passage, term, 3000, probe, total)
        assert np.allclose(total, whole.T @ (whole @ probe), rtol=1e-4, atol=1e-3)


# ---------------------------------------------------------------------------------------------------- groups in batches


def test_whole_groups_over_batches():
    from varloom.llm.blocks import whole_groups

    rng = random.Random(12)
    rows = sorted((rng.randint(0, 30), rng.randint(0, 2), i) for i in range(400))
    for size in (1, 3, 7, 400):
        batches = [pa.RecordBatch.from_pylist([{"k": k, "l": m, "v": v} for k, m, v in rows[i : i + size]]) for i in range(0, 400, size)]
        batches.insert(1, batches[0].slice(0, 0))
        groups = []
        for batch, begin in whole_groups(iter(batches), 2):
            assert begin[-1] == batch.num_rows or len(begin) > 1
            found = [tuple(r.values()) for r in batch.to_pylist()]
            edges = begin.tolist() if begin[-1] == batch.num_rows else [*begin.tolist(), batch.num_rows]
            groups += [found[a:b] for a, b in zip(edges[:-1], edges[1:])]
        want = defaultdict(list)
        for r in rows:
            want[r[:2]].append(r)
        assert groups == list(want.values())
    assert list(whole_groups(iter([]), 2)) == []


def test_stacked_labels_are_components():
    from varloom.llm.blocks import local_links, stacked_labels

    rng = np.random.default_rng(3)
    near = rng.random((40, 9, 9)) < 0.12
    near |= near.transpose(0, 2, 1)
    for matrix, label in zip(near, stacked_labels(near)):
        assert [(i, int(k)) for i, k in enumerate(label) if i != k] == local_links(matrix)

"""Small cases of each operator: planted finds, brute force, nulls, repeats, empty tables, clashing columns."""

from __future__ import annotations

import itertools
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from varloom.llm import charlm, chat, lattice
from varloom.llm.chat import maximal_chats
from varloom.llm.decontaminate import contaminated, lcs
from varloom.llm.langid import identify
from varloom.llm.lattice import near_vectors
from varloom.llm.lines import duplicate_lines, within_one, without_duplicate_lines
from varloom.llm.lmscore import scored
from varloom.llm.mixing import fit, mixed
from varloom.llm.near_dedup import near_duplicates
from varloom.llm.queries import remainder
from varloom.llm.sharding import sharded
from varloom.llm.shingles import superminhash
from varloom.llm.toxicity import toxicity
from varloom.llm.words import mix, words_of

DOC = "doc_id long, text string, lang string, source string, n_chars long, shard string, n long, h long, word string"
SYLLABLES = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt", "ea", "ti"]


def words(rng, n):
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]


def prose(rng, n):
    return " ".join(words(rng, n))


def frame(spark, rows, parts=3):
    """Documents with columns whose names occur inside the operators."""
    full = [(i, t, *(list(more) + [None] * (2 - len(more))), 1, "x", 2, 3, "y") for i, t, *more in rows]
    return spark.createDataFrame(full, DOC).repartition(parts)


def tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


# ------------------------------------------------------------------------------------------------ words and signatures


def test_words_of_bytes():
    texts = ["Ab cé\tAB", None, "", "x" * 50, " ", "a b", " z"]
    found = words_of(pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"]))
    assert found.counts().tolist() == [3, 0, 0, 1, 0, 2, 1]
    h = found.hashes()
    assert len(set(h[:2].tolist())) == 2 and h[0] == h[2]


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(0)
    pool = mix(np.arange(1, 1501, dtype=np.uint64))
    a, b = np.sort(pool[:1000]), np.sort(pool[250:1250])
    sig = superminhash(np.concatenate([a, b]), np.array([0, 1000, 2000]), 256)
    assert abs((sig[0] == sig[1]).mean() - 0.6) < 0.1
    tiny = superminhash(np.sort(rng.choice(pool, 3)), np.array([0, 3]), 96)
    assert np.isfinite(tiny).all()
    assert (superminhash(pool[:0], np.array([0, 0]), 8) == np.inf).all()


# ---------------------------------------------------------------------------------------------------------- operators


def brute_near(rows):
    sets = {}
    for i, t in rows:
        w = tokens(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    changed = True
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return {(i, len(sets[i]), label[i], label[i] == i) for i in sets}


def test_near_duplicates(spark):
    rng = random.Random(1)
    rows = []
    for g in range(12):
        base = words(rng, rng.choice([4, 30, 120]))
        rows.append((len(rows) * 3 + 1, " ".join(base)))
        for _ in range(g % 5):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = "zz" + str(rng.random())
            rows.append((len(rows) * 3 + 1, " ".join(copy).upper() if rng.random() < 0.3 else " ".join(copy)))
    rows += [(1000 + k, rows[0][1]) for k in range(40)] + [(2000, ""), (2001, None), (2002, "  \t"), (2003, "a b"), (2004, "A  b\n")]
    got = {tuple(r) for r in near_duplicates(frame(spark, rows)).collect()}
    assert got == brute_near(rows)


def test_near_duplicates_odd_rows(spark):
    rows = [(5, "a b c"), (5, "a b c"), (None, "q w"), (6, "A b C")]
    got = {tuple(r) for r in near_duplicates(frame(spark, rows)).collect()}
    assert got == {(5, 1, 5, True), (6, 1, 5, False), (None, 1, None, True)}
    assert near_duplicates(frame(spark, [])).count() == 0


def test_noisy_channel():
    rng = random.Random(2)
    text = " ".join(words(rng, 3000) + ["idiot", "stupid", "loser", "moron"] * 40)
    c = charlm.codes(np.frombuffer(text.encode(), np.uint8))
    counts = np.bincount((c[:-2] * 28 + c[1:-1]) * 28 + c[2:], minlength=28**3).astype(float)
    model = charlm.log_model(counts)
    for said, meant in (("1d10t", "idiot"), ("stuuuupid", "stupid"), ("l0ser", "loser"), ("s t u p i d", "stupid"), ("m0r0n", "moron")):
        assert charlm.restore(said, model) == meant
    for plain in ("the", "cat"):
        assert charlm.restore(plain, model) == plain


def test_toxicity_learns_and_restores(spark):
    rng = random.Random(3)
    bad = ["idiot", "stupid", "loser", "moron"]
    rows, labels = [], []
    for i in range(400):
        w, toxic = words(rng, 60), i % 4 == 0
        if toxic:
            for _ in range(4):
                w[rng.randrange(60)] = rng.choice(bad)
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    hidden = words(rng, 30) + ["1d10t", "stuuuupid", "l0ser", "m0r0n"]
    rows += [(500, " ".join(hidden)), (501, None), (502, ""), (None, "idiot"), (503, prose(rng, 60)), (503, prose(rng, 60))]
    marks = spark.createDataFrame([*labels, (3, None), (None, 1), (8, 1)], "doc_id long, toxic int")
    got = toxicity(frame(spark, rows), marks, learn=remainder(3) != 1).toPandas()
    assert len(got) == len(rows)
    by = got.dropna().drop_duplicates("doc_id").set_index("doc_id")
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([by.loc[i, "predicted"] == (i % 4 == 0) for i in held]) > 0.97
    assert by.loc[500, "predicted"] == 1 and by.loc[500, "n_restored"] == 4
    assert by.loc[501, "predicted"] == by.loc[502, "predicted"] == by.loc[503, "predicted"] == 0
    assert got["score"].between(0, 1).all()


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity(frame(spark, [(1, "a b"), (2, None)]), none).collect()
    assert [r["score"] for r in got] == [0.5, 0.5]
    assert toxicity(frame(spark, []), none).count() == 0


def test_bounded_knapsack():
    assert fit(np.array([3, 5]), np.array([2, 2]), 11).tolist() == [2, 1]
    assert fit(np.array([7]), np.array([3]), 20).tolist() == [2]
    assert fit(np.array([2, 4]), np.array([1, 1]), 100).tolist() == [1, 1]
    assert fit(np.array([2]), np.array([1]), 0).tolist() == [0]
    rng = np.random.default_rng(4)
    for _ in range(30):
        lengths = np.unique(rng.integers(1, 30, 6))
        counts = rng.integers(1, 4, len(lengths))
        budget = int(rng.integers(1, (lengths * counts).sum()))
        taken = fit(lengths, counts, budget)
        assert (taken >= 0).all() and (taken <= counts).all()
        assert (taken * lengths).sum() <= budget
    big = rng.integers(100, 9000, 3000)
    lengths, counts = np.unique(big, return_counts=True)
    budget = int(big.sum()) // 3
    assert (fit(lengths, counts, budget) * lengths).sum() == budget


def test_mixed(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randint(0, 40)), "en", rng.choice(["a", "b", "c", "c", "c", None])) for i in range(300)]
    rows += [(900, None, "en", "a"), (901, "one two", "en", "z"), (901, "one two", "en", "z")]
    got = mixed(frame(spark, rows)).toPandas()
    again = mixed(frame(spark, rows, parts=7)).toPandas()
    key = ["doc_id", "size", "taken"]
    assert sorted(got[key].values.tolist()) == sorted(again[key].values.tolist())
    size = Counter()
    for _, t, _, s in rows:
        size[s] += len(tokens(t))
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    target, free, left = {}, set(names), 1.5 * sum(size.values())
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > 2 * size[s]}
        for s in full or free:
            target[s] = 2.0 * size[s] if full else level * weight[s]
        left -= sum(target[s] for s in full)
        free = free - full if full else set()
    source = {i: s for i, _, _, s in rows}
    got["source"] = got["doc_id"].map(source)
    for s in names:
        mine = got[got["source"].isna() if s is None else got["source"] == s]
        assert math.isclose(mine["target"].iloc[0], target[s]) and mine["source_size"].iloc[0] == size[s]
        assert abs(mine["taken"].sum() - target[s]) <= 2
    assert (got["taken"] <= 2 * got["size"]).all()
    assert mixed(frame(spark, [])).count() == 0
    assert mixed(frame(spark, [(1, None, "en", "a")])).first()["taken"] == 0


def test_lcs():
    a, b = np.array([1, 2, 3, 2, 5]), np.array([9, 2, 3, 5, 5])
    assert lcs(a, b) == 3 and lcs(a, a) == 5 and lcs(a, b[:0]) == 0


def test_contaminated(spark):
    rng = random.Random(6)
    items = [(k, prose(rng, 35) + ". " + " ".join(words(rng, 6)) + ".") for k in range(8)]
    docs = [(i, prose(rng, 200)) for i in range(60)]
    whole = docs[7][1].split(" ")
    docs[7] = (7, " ".join(whole[:53] + tokens(items[2][1]) + whole[53:]))
    edited = tokens(items[5][1])
    edited[3] = edited[17] = "changed"
    docs[9] = (9, prose(rng, 91) + " " + " ".join(edited[:20] + ["more"] + edited[20:]) + " " + prose(rng, 40))
    docs += [(None, items[0][1]), (70, None), (71, ""), (7, "again")]
    bench = spark.createDataFrame([*items, (90, None), (91, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(frame(spark, docs), bench).collect()}
    assert got == {(7, 2), (9, 5), (None, 0)}
    split = {(r["doc_id"], r["item_id"]) for r in contaminated(frame(spark, docs), bench, items_per_pass=4).collect()}
    assert split == got
    assert contaminated(frame(spark, []), bench).count() == 0
    assert contaminated(frame(spark, docs), bench.limit(0)).count() == 0


def test_contaminated_finds_every_edit(spark):
    """Kept and foreign words alike come from the items, so half-replaced copies are far from their item by cosine."""
    rng = random.Random(16)
    items = [(k, " ".join(words(rng, rng.randint(15, 50))) + ". " + prose(rng, 4) + ".") for k in range(40)]
    pool = [w for _, t in items for w in tokens(t)]
    docs = []
    for i in range(160):
        copy = tokens(items[i % 40][1])
        for at in rng.sample(range(len(copy) - 4), round((0, 0.2, 0.3, 0.45)[i // 40] * len(copy))):
            copy[at] = rng.choice(pool)
        docs.append((i, " ".join(words(rng, rng.randint(0, 60)) + rng.choices(pool, k=20) + copy + words(rng, 40))))
    want = set()
    for (i, text), (k, item) in itertools.product(docs, items):
        seq, answer = np.array([zlib.crc32(w.encode()) for w in tokens(item)]), len(tokens(item.split(". ")[1]))
        h = np.array([zlib.crc32(w.encode()) for w in tokens(text)])
        wide = 8 * (max(1, round(len(seq) / 8)) + (len(seq) < 40))
        for a in range(0, len(h), 8):
            piece = h[max(0, a - 8) : a + wide + 8]
            share = lcs(seq, piece) / len(seq)
            if share >= 0.7 or share >= 0.5 and lcs(seq[-answer:], piece) == answer:
                want.add((i, k))
    assert len(want) > 120
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in contaminated(frame(spark, docs), bench).collect()} == want


def test_contaminated_by_frequent_words(spark):
    """Copies count whatever share of the passages holds their words: three documents, a hot leak, stop words only."""
    rng = random.Random(26)
    common = ["the", "of", "and", "to", "in", "is", "that", "it", "for", "as"]
    items = [(0, prose(rng, 32)), (1, " ".join(rng.choices(common, k=32)))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    few = [(0, items[0][1]), (1, items[1][1]), (2, prose(rng, 32))]
    many = [(i, items[0][1] if i % 3 == 0 else " ".join(rng.choices(common + words(rng, 5), k=96))) for i in range(90)] + [(90, items[1][1])]
    for docs, want in ((few, {(0, 0), (1, 1)}), (many, {(i, 0) for i in range(0, 90, 3)} | {(90, 1)})):
        got = {(r["doc_id"], r["item_id"]): r["cosine"] for r in contaminated(frame(spark, docs), bench).collect()}
        assert {k for k, c in got.items() if c > 0.99} == want <= set(got)


def test_scored(spark):
    rng = random.Random(7)
    common, rare = words(rng, 40), words(rng, 400)
    rows = [(i, " ".join(rng.choice(common if rng.random() < 0.8 else rare) for _ in range(50))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "never seen"), (None, "x"), (203, rows[0][1]), (203, rows[0][1])]
    got = scored(frame(spark, rows), learn=remainder(10) != 0).toPandas()
    counts = Counter()
    for i, t in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            counts.update([*tokens(t), "\0"])
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for i, t in rows:
        w = [*tokens(t), "\0"]
        base = sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        want[(i if i is not None else -1, len(w), sum(counts[x] > 0 for x in w), n, round(base, 6))] += 1
    have = Counter((int(r.doc_id) if r.doc_id == r.doc_id else -1, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got.itertuples())
    assert have == want
    assert np.isfinite(got["score"]).all() and (got["score"] < 0).all()
    assert scored(frame(spark, [])).count() == 0


def test_scored_is_normalised(spark):
    """Over all first words that could follow an empty context, probabilities sum to one less the classes' unknown words."""
    rows = [(i, w) for i, w in enumerate(["aa", "bb", "cc", "aa bb", "bb cc aa"])]
    probe = [(100 + k, w) for k, w in enumerate(["aa", "bb", "cc", ""])]
    got = {r["doc_id"]: r["score"] for r in scored(frame(spark, rows + probe), learn=F.col("doc_id") < 100).collect()}
    end = 10 ** got[103]
    assert 0 < end < 1 and all(got[k] < 0 for k in (100, 101, 102))


def test_chat_collapse(spark):
    turns = []

    def talk(conv, said):
        turns.extend((conv, k, "user" if k % 2 == 0 else "assistant", t, "x") for k, t in enumerate(said))

    talk(1, ["hi", "hello"])
    talk(2, ["hi", "hello", "how", "well"])
    talk(3, ["hi", "hello", "how", "well"])
    talk(4, ["hi", "other"])
    talk(5, ["a"] * 5)
    talk(6, ["a"] * 600)
    talk(7, ["hi"])
    talk(8, [None, "<|x"])
    turns += [turns[0], (None, 0, "user", "hi", "x"), (9, None, None, "hi", "x")]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, place string")
    got = maximal_chats(table).toPandas()
    assert sorted(set(got["conv_id"])) == [2, 4, 6, 8, 9]
    assert got.set_index("conv_id").loc[2, "copies"] == 2
    six = got[got["conv_id"] == 6].sort_values("part")
    assert six["part"].tolist() == [0, 1, 2] and "".join(six["text"]).count("<|end|>") == 600
    assert got.set_index("conv_id").loc[8, "text"] == "<|user|>\n<|end|>\n<|assistant|>\n< |x<|end|>\n"
    con = duckdb.connect()
    con.register("conversations", table.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    want = con.execute(chat.ORACLE).df()
    key = ["conv_id", "part", "n_turns", "copies", "text"]
    assert sorted(map(tuple, got[key].values.tolist())) == sorted(map(tuple, want[key].values.tolist()))
    assert maximal_chats(table.limit(0)).count() == 0


def test_chat_is_native(spark):
    table = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    plan = maximal_chats(table)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_sharded(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, 8)) for i in range(300)] + [(400 + i, f"copy {i % 20}") for i in range(160)] + [(600 + i, "hot") for i in range(240)]
    rows += [(None, "n"), (900, None), (901, ""), (901, "")]
    got = sharded(frame(spark, rows)).toPandas()
    again = sharded(frame(spark, rows, parts=5)).toPandas()
    order = ["doc_id", "size", "shard", "slot"]
    assert sorted(map(str, got[order].values.tolist())) == sorted(map(str, again[order].values.tolist()))
    sizes = got.groupby("shard")["slot"].agg(["count", "min", "max", "nunique"])
    assert len(sizes) == 16 and sizes["count"].max() - sizes["count"].min() <= 1
    assert (sizes["min"] == 0).all() and (sizes["max"] == sizes["count"] - 1).all() and (sizes["nunique"] == sizes["count"]).all()
    text = {i: t for i, t in rows if i is not None}
    for r in got.dropna(subset=["doc_id"]).itertuples():
        t = text[int(r.doc_id)] or ""
        assert r.size == len(t.encode()) + 1 and r.text_crc32 == zlib.crc32(t.encode())
    got["text"] = got["doc_id"].map(text)
    copies = got[got["text"].fillna("").str.startswith("copy")].groupby("text")["shard"].nunique()
    assert copies.mean() < 2
    assert sharded(frame(spark, [])).count() == 0


def test_duplicate_lines(spark):
    rng = random.Random(9)
    base = [prose(rng, 8) for _ in range(30)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(4):
            line = rng.choice(base)
            at = rng.randrange(len(line))
            kind = rng.randrange(5)
            lines.append([line, line, line[:at] + "é" + line[at + 1 :], line[:at] + line[at + 1 :], line[:at] + "qq" + line[at:]][kind])
        rows.append((i, "\n".join([*lines, "", "ok", "-" * rng.randint(18, 24)])))
    rows += [(70, None), (71, ""), (None, base[0]), (72, base[0]), (72, base[0])]
    want, first = set(), {}
    every = [(i, k, x.strip()) for i, t in dict(r for r in rows if r[0] is not None).items() for k, x in enumerate((t or "").split("\n")) if x.strip()]
    for i, k, x in sorted(every, key=lambda r: r[:2]):
        first.setdefault(x, (i, k))
    for i, k, x in every:
        near = [q for y, q in first.items() if len(x) >= 20 and len(y) >= 20 and y != x and q < first[x] and within_one(x, y)]
        to = min(near, default=first[x])
        if to != (i, k):
            want.add((i, k, *to, int(bool(near))))
    docs = frame(spark, rows)
    got = {tuple(r) for r in duplicate_lines(docs).collect()}
    assert got == want
    left = {r["doc_id"]: r["text"] for r in without_duplicate_lines(docs).collect()}
    gone = {(i, k) for i, k, *_ in want}
    for i, t in dict(r for r in rows if r[0] is not None).items():
        assert left[i] == (None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone))
    assert duplicate_lines(frame(spark, [])).count() == 0


def test_duplicate_lines_inside_runs(spark):
    """A character replaced at any place of a run of equal ones, by brute force over every place."""
    rng = random.Random(19)
    lines = ["invoice 100 of the year 2000", "the committee book 111122", "aabbccddeeffgghhiijjkk", "x" * 22]
    lines += ["".join(c * rng.randint(1, 4) for c in rng.choices("ab10", k=14))[:40].ljust(20, "z") for _ in range(10)]
    every = list(dict.fromkeys(lines))
    for line in list(every):
        every += [line[:at] + rng.choice("5n01") + line[at + 1 :] for at in range(len(line))]
        every += [line[:at] + line[at] + line[at:] for at in rng.sample(range(len(line)), 3)]
    rows = list(enumerate(every))
    first = {}
    for i, x in rows:
        first.setdefault(x, i)
    want = set()
    for i, x in rows:
        near = [q for y, q in first.items() if y != x and q < first[x] and within_one(x, y)]
        to = min(near, default=first[x])
        if to != i:
            want.add((i, 0, to, 0, int(bool(near))))
    docs = frame(spark, rows)
    assert {tuple(r) for r in duplicate_lines(docs).collect()} == want
    pair = [(1, lines[0]), (2, lines[0].replace("100", "105")), (3, lines[1]), (4, lines[1].replace("mm", "mn"))]
    assert {tuple(r) for r in duplicate_lines(frame(spark, pair)).collect()} == {(2, 0, 1, 0, 1), (4, 0, 3, 0, 1)}


def test_within_one():
    for a, b, near in (("abc", "abc", 1), ("abc", "abd", 1), ("abc", "ab", 1), ("abc", "xabc", 1), ("abc", "acb", 0), ("abc", "a", 0), ("", "a", 1), ("ab", "cd", 0)):
        assert within_one(a, b) == bool(near)


def test_identify(spark):
    rng = random.Random(10)
    sound = {"en": ["th", "ing", "and", "er"], "de": ["sch", "ein", "ü", "ung"], "fr": ["eau", "é", "oi", "que"]}
    rows = [(i, " ".join("".join(rng.choices(sound[k], k=3)) for _ in range(20)), k) for i, k in enumerate(rng.choices(list(sound), k=240))]
    rows += [(500, None, "en"), (501, "", None), (502, "12 34 !", "de"), (503, "schüung ein", None), (503, "schüung ein", None), (None, "thing and", "en")]
    got = identify(frame(spark, rows), learn=remainder(4) != 2).toPandas()
    assert len(got) == len(rows) and got["score"].between(0, 1).all()
    truth = {i: k for i, _, k in rows if i is not None and i < 240}
    held = got[got["doc_id"].isin([i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2])]
    assert len(held) > 20 and (held["lang_pred"] == held["doc_id"].map(truth)).mean() > 0.97
    odd = got.drop_duplicates("doc_id").set_index("doc_id")["lang_pred"]
    assert odd[500] == odd[501] == odd[502] == "und" and odd[503] == "de"
    assert identify(frame(spark, [])).count() == 0
    assert {r["lang_pred"] for r in identify(frame(spark, [(1, "abc", None)])).collect()} == {"und"}


def test_e8_points():
    short = lattice.roots()
    assert len(short) == 240 and np.allclose((short**2).sum(1), 2)
    rng = np.random.default_rng(11)
    x = rng.normal(size=(200, 8)) * 2
    near = lattice.nearest_e8(x)
    gap = ((x - near) ** 2).sum(1)
    others = ((x[:, None] - near[:, None] - short[None]) ** 2).sum(2)
    assert (gap <= others.min(1) + 1e-9).all() and gap.max() <= 1 + 1e-9


def test_near_vectors(spark):
    rng = np.random.default_rng(12)
    base = rng.normal(size=(150, 64))
    rows = [(i, v.tolist(), 0, 1) for i, v in enumerate(base)]
    for k in range(120):
        v = base[k % 30] / np.linalg.norm(base[k % 30])
        u = rng.normal(size=64)
        u -= (u @ v) * v
        c = rng.uniform(0.93, 0.999)
        rows.append((1000 + k, (3 * (c * v + math.sqrt(1 - c * c) * u / np.linalg.norm(u))).tolist(), 1, 1))
    rows += [(2000 + k, rows[3][1], 2, 1) for k in range(40)]
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    ids = np.array([r[0] for r in rows])
    label = ids.copy()
    for _ in range(50):
        label = np.minimum(label, np.where(near, label[None, :], 10**9).min(1))
    bad = [(3000, None), (3001, [0.0] * 64), (3002, [float("nan")] * 64), (3003, [None] * 64), (3004, []), (3005, [1.0, 2.0]), (3006, [1.0, 2.0])]
    rows += [(i, v, 0, 1) for i, v in bad] + [(None, rows[0][1], 0, 1), rows[5]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, member int").repartition(4)
    got = {r["vec_id"]: tuple(r)[1:] for r in near_vectors(table).collect()}
    want = {int(i): (int(n), int(c), bool(c == i)) for i, n, c in zip(ids, near.sum(1), label, strict=True)}
    found = sum(got[i][0] for i in want) / max(sum(w[0] for w in want.values()), 1)
    assert found >= 0.99 and all(got[i][0] <= want[i][0] for i in want)
    assert sum(got[i] != want[i] for i in want) <= 2
    for i in (3000, 3001, 3002, 3003, 3004):
        assert got[i] == (0, i, True)
    assert got[3005] == (1, 3005, True) and got[3006] == (1, 3005, False) and got[None] == (0, None, True)
    assert near_vectors(table.limit(0)).count() == 0


# ----------------------------------------------------------------------------------------------------------- pipeline


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sizes = [docs.count()]
    for name, apply in corpus_pipeline.STAGES[:-1]:
        after = apply(spark, docs, sf_dir)
        assert after.columns == docs.columns, name
        docs = after.cache()
        sizes.append(docs.count())
    assert sizes[1] <= sizes[0] and sizes[2] < sizes[1] and sizes[3] < sizes[2]
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert out.count() == sizes[-1]


@pytest.mark.parametrize("column", ["text", "source", "lang"])
def test_pipeline_stages_take_nulls(spark, sf_dir, column):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(20).withColumn(column, F.lit(None).cast("string")).withColumn("copies", F.lit("x"))
    for name, apply in corpus_pipeline.STAGES[1:4]:
        out = apply(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        assert out.count() >= 0


# ------------------------------------------------------------------------------------------------ queries and entry


def test_registered_queries():
    import __spark_entry__ as driver
    from varloom.llm import queries

    names = set(driver.queries())
    assert set(queries.QUERIES) < names and "pipeline" in names
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in queries.QUERIES)] == []


def test_chat_query_matches_its_oracle(spark, sf_dir):
    from tests.compare import compare
    from varloom.llm import queries

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf_dir}/conversations.parquet')")
    verdict, n = compare(spark, con, queries.QUERIES["op6_chat"], queries.ORACLES["op6_chat"], sf_dir)
    assert verdict == "ok" and n > 0


def test_library_does_not_need_this_package(tmp_path):
    """With the package and the pipeline gone, the entry still lists the other queries."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[2]
    for name in ("varloom", "bindings"):
        shutil.copytree(root / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    script = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and 'pipeline' not in q and set(e.oracle_sql()) == set(q)"
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-1000:]

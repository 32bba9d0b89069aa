"""Lines of any length and script, and the exact join of crowded regions, by brute force."""

import os
import random
import time

import numpy as np
from pyspark.sql import functions as F

from fadecast import session
from fadecast.llm import common, crowded, linededup
from tests.llm.test_queries import gone_lines


def test_short_lines_and_lines_without_blanks(spark):
    china = "机器学习模型需要大量的训练数据才能获得良好的泛化能力并且避免过拟合"
    texts = {
        1: f"one\n}}\n{china}\n\n  \nyes no", 2: f"One \n}}\n{china[:-1]}。\n\nno yes", 3: "}\nöne\none\n" + china, 4: None, 5: "",
        6: "abcdefgh\nabcdefg", 7: "abcdefgh\nabcdefg\nabcdefghi", 8: "x" * 100_000, 9: "x" * 100_001,
    }
    rows = linededup.dedup_lines(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {(r.doc_id, k) for r in rows for k in r.removed_lines or []} == gone_lines(texts)
    assert len(rows) == len(texts)


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(0)
    for n in (5, 300, 5000):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        for drop in (0, 1, n // 5, n):
            b = np.concatenate([a[drop:], rng.integers(0, 2**63, drop).astype(np.uint64)])
            apart = np.bitwise_count(crowded.sketch(a) ^ crowded.sketch(b)).sum()
            assert apart <= len(np.setxor1d(a, b)) and (drop or not apart)


def test_candidates_hold_all_similar_pairs(spark, monkeypatch):
    """Variants of one text, in tiles of few rows."""
    monkeypatch.setattr(crowded, "PART", 7)
    rng = random.Random(2)
    base = [f"w{k}" for k in range(60)]
    bodies = []
    for _ in range(80):
        w = list(base)
        for k in rng.sample(range(60), rng.randint(0, 14)):
            w[k] = f"v{rng.randint(0, 9)}"
        bodies.append(" ".join(w))
    shingles = lambda body: np.unique(linededup.char_shingles(body.decode()))
    rows = [(k, k % 20, b.encode()) for k, b in enumerate(bodies)]
    sets = spark.createDataFrame(rows, "id long, part_of long, body binary").repartition(3)
    got = {(r.id_a, r.id_b) for r in crowded.candidates(sets, 80, shingles).collect()}
    own = [set(shingles(b).tolist()) for _, _, b in rows]
    want = {
        (i, j) for j in range(80) for i in range(j)
        if i % 20 != j % 20 and 5 * len(own[i] & own[j]) >= 4 * len(own[i] | own[j])
    }
    assert want and want <= got and len(got) < 3 * len(want) + 200
    assert spark.createDataFrame([], sets.schema).select(F.count("id")).first()[0] == 0
    assert crowded.candidates(spark.createDataFrame([], sets.schema), 80, shingles).collect() == []


def test_folded_sketches_bound_the_difference():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (5, 200, 256, 257, 512, 513, 3000)]
    sets += [np.concatenate([s[1:], s[:1] + np.uint64(1)]) for s in sets]
    n = np.array([len(s) for s in sets])
    rows = [crowded.folded(crowded.sketch(s), int(crowded._folds(k))).tobytes() for s, k in zip(sets, n)]
    assert {len(r) for r in rows} == {32, 64, 128}
    i, j = np.triu_indices(len(sets), 1)
    apart = crowded.Sketches(rows, n).apart(i, j)
    assert all(d <= len(np.setxor1d(sets[a], sets[b])) for d, a, b in zip(apart, i, j)) and apart.max() > 100


def test_only_lines_that_share_a_band_are_sorted(spark, monkeypatch):
    """Lines without a near copy go no further than their chunk, whatever the chunks."""
    rng = random.Random(3)
    texts = {k: "\n".join(" ".join(f"w{rng.randint(0, 10**9)}" for _ in range(9)) for _ in range(4)) for k in range(60)}
    texts |= {100 + k: texts[k].replace("w", "v", 1) for k in range(5)} | {200: texts[0], 201: "short\nshort", 202: None}
    seen, pairs = [], linededup.close_pairs

    def counted(ordered, *a, **b):
        seen.append(ordered.select("key").distinct().count())
        return pairs(ordered, *a, **b)

    monkeypatch.setattr(linededup, "close_pairs", counted)
    for size in (7, 80_000):
        monkeypatch.setattr(linededup, "CHUNK_LINES", size, raising=False)
        rows = linededup.dedup_lines(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
        assert {(r.doc_id, k) for r in rows for k in r.removed_lines or []} == gone_lines(texts)
    assert max(seen) <= 12


def _variants(rng, n, most):
    """Texts that share much: many pairs near the threshold, few equal."""
    base = [f"w{k}" for k in range(60)]
    out = []
    for _ in range(n):
        w = list(base)
        for k in rng.sample(range(60), rng.randint(0, most)):
            w[k] = f"v{rng.randint(0, 9)}"
        out.append(" ".join(w))
    return out


def test_lines_without_a_partner_are_not_shuffled(spark, monkeypatch):
    """Only lines that are repeated or share a band leave their chunk; their columns and bands stay as they were."""
    rng = random.Random(5)
    texts = {k: "\n".join(" ".join(f"w{rng.randint(0, 10**9)}" for _ in range(9)) for _ in range(4)) for k in range(60)}
    texts |= {100 + k: texts[k].replace("w", "v", 1) for k in range(5)} | {200: texts[0], 201: "short\nshort\nalone", 202: None}
    seen, meeting = [], linededup._meeting

    def counted(*a, **b):
        out = meeting(*a, **b)
        seen.append(out.count())
        return out

    monkeypatch.setattr(linededup, "_meeting", counted)
    rows = linededup.dedup_lines(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)).collect()
    assert {(r.doc_id, k) for r in rows for k in r.removed_lines or []} == gone_lines(texts)
    assert seen == [46, 26]  # of 267: all lines of the texts with a copy, and the short ones; distinct ones


def test_pairs_within_regions_are_all_similar_ones(spark):
    """Regions of many rows, and one that goes over batches, by brute force."""
    bodies = _variants(random.Random(6), 90, 14)
    own = [np.unique(linededup.char_shingles(b)) for b in bodies]
    bits = crowded.sketches(np.concatenate(own), np.array([len(s) for s in own]), 512)
    assert all((b == crowded.sketch(s, 512)).all() for b, s in zip(bits, own))
    rows = [(k % 2, f"{k:03d}".encode(), f"{k % 20}".encode(), len(s), b.tobytes()) for k, (s, b) in enumerate(zip(own, bits))]
    rows += [(2 + k, r[1], r[2], r[3], r[4]) for k, r in enumerate(rows)]  # alone in their regions
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.createDataFrame(rows, "band long, key binary, root binary, size long, bits binary")
        found = crowded.within(df, "band", 80, 512).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = {(int(r.key_a), int(r.key_b)) for r in found}
    sets = [set(s.tolist()) for s in own]
    want = {
        (i, j) for j in range(90) for i in range(j)
        if i % 2 == j % 2 and i % 20 != j % 20 and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])
    }
    assert want and want <= got and len(got) == len(found) < 3 * len(want) + 200


def test_crowded_lines_equal_brute_force_on_both_ways(spark, monkeypatch):
    """Regions up to WHOLE rows by their pairs, larger ones by prefixes."""
    texts = dict(enumerate(_variants(random.Random(7), 250, 20)))
    want = gone_lines(texts)
    df = spark.createDataFrame([*texts.items(), *texts.items()], "doc_id long, text string")  # every row comes twice
    for whole in (crowded.WHOLE, 5):
        monkeypatch.setattr(crowded, "WHOLE", whole, raising=False)
        rows = linededup.dedup_lines(df).collect()
        assert {(r.doc_id, k) for r in rows for k in r.removed_lines or []} == want and len(rows) == 500


def test_similar_pairs_of_lines_at_once():
    lines = [x.replace(" ", "") for x in _variants(random.Random(8), 60, 14)] + ["abcdefgh", "abcdefghi", "a" * 300, "a" * 301, "é" * 9]
    sets = [set(linededup.char_shingles(x).tolist()) for x in lines]
    pairs = [(i, j) for j in range(len(lines)) for i in range(j)]
    got = linededup._similar([lines[i] for i, _ in pairs], [lines[j] for _, j in pairs])
    assert got.tolist() == [5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) for i, j in pairs] and 0 < got.sum() < len(pairs)


def test_tables_and_shuffle_files_go_with_their_last_reader(spark):
    """Of what the removed lines are found with, only the result stays on disk."""
    before = set(session._made)
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {x for x in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in x and x.endswith(".data")}
    old = shuffled()
    texts = dict(enumerate(_variants(random.Random(9), 40, 14)))
    docs = common.written(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5, "doc_id"), "docs")
    for _ in range(50):  # files are deleted in the background
        if not (left := shuffled() - old):
            break
        time.sleep(0.1)
    assert not left
    gone = linededup.removed_lines(docs)
    assert {(r.doc_id, r.line_no) for r in gone.collect()} == gone_lines(texts)
    there = [p for p in session._made if p not in before and os.path.exists(p.removeprefix("file:"))]
    assert sorted(p.rsplit("/", 1)[-1].rsplit("-", 1)[0] for p in there) == ["llm-docs", "llm-removed-lines"]


def test_texts_are_read_where_they_lie(spark, monkeypatch):
    """The lines to compare are picked by a filter, by a shuffle of the texts only beyond its size; lines
    that pass it unasked, copies of documents and ids with two texts make no difference."""
    texts = dict(enumerate(_variants(random.Random(10), 30, 14)))
    texts |= {100 + k: "\n".join(f"filler {k} {j} of some length" for j in range(9)) + "\n" + texts[k] for k in range(20)}
    want = gone_lines(texts)
    rows = [*texts.items(), *list(texts.items())[::3], (None, texts[1]), (900, None), (901, " \n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    plans, written = [], common.written

    def seen(out, name):
        if name == "line-texts":
            plans.append(out._jdf.queryExecution().executedPlan().toString())
        return written(out, name)

    monkeypatch.setattr(common, "written", seen)
    docs = written(df, "docs")
    for small, spare, moved in ((1 << 14, 12, False), (1 << 14, 1, False), (0, 12, True)):
        monkeypatch.setattr(common, "SMALL", small)
        monkeypatch.setattr(linededup, "SPARE", spare, raising=False)
        got = linededup.dedup_lines(docs).collect()
        assert {(r.doc_id, k) for r in got for k in r.removed_lines or []} == want and len(got) == len(rows)
        assert ("Exchange" in plans[-1]) == moved


def test_forests_join_what_all_pairs_join(spark, monkeypatch):
    """Of a region's pairs a spanning forest leaves a task; lines that its similar pairs do not join are looked at again."""
    bodies = _variants(random.Random(11), 90, 14)
    own = [np.unique(linededup.char_shingles(b)) for b in bodies]
    bits = crowded.sketches(np.concatenate(own), np.array([len(s) for s in own]), 512)
    rows = [(k % 2, f"{k:03d}".encode(), f"{k % 20}".encode(), len(s), b.tobytes()) for k, (s, b) in enumerate(zip(own, bits))]
    df = spark.createDataFrame(rows, "band long, key binary, root binary, size long, bits binary")

    def joined(pairs):
        up = list(range(20))
        for r in pairs:
            a, b = up[int(r.key_a) % 20], up[int(r.key_b) % 20]
            up = [min(a, b) if x in (a, b) else x for x in up]
        return up

    every, tree = (crowded.within(df, "band", 80, 512, spanning=s).collect() for s in (False, True))
    assert joined(tree) == joined(every) and len(set(tree)) < 40 < len(every)
    at = np.array([5, 5, 5, 7, 7])
    regions = [[5, 3], [3, 5], [5], [7, 3, 9], [7, 9]]
    i, j = np.array([0, 0, 1, 3]), np.array([1, 2, 2, 4])
    assert crowded._met_before(regions, at, i, j).tolist() == [True, False, False, False]
    assert crowded._met_before(regions, at, i[:0], j[:0]).tolist() == []
    copies = df.withColumn("band", F.explode(F.array(F.col("band"), F.col("band") + 2, F.col("band") + 4)))
    assert sorted(crowded.within(copies, "band", 80, 512, once=True).collect()) == sorted(every)
    texts = dict(enumerate(_variants(random.Random(12), 120, 20)))
    monkeypatch.setattr(crowded, "FEW", 3)
    out = linededup.dedup_lines(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {(r.doc_id, k) for r in out for k in r.removed_lines or []} == gone_lines(texts)

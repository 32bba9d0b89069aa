"""The language model against plain counts, enumerated seatings and customer-by-customer Gibbs."""

import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest

from fadecast.llm import pitmanyor as py

DOCS = "doc_id long, text string, held_out boolean, part int, key string, kind int, ids long, base double"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, h, 1, "k", 2, 3, 0.5) for i, t, h in rows], DOCS)


def corpus(n, seed=5):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(30)]
    follow = {w: rng.sample(words, 4) for w in words}
    rows = []
    for k in range(n):
        w, text = rng.choice(words), []
        for _ in range(rng.randint(3, 25)):
            text.append(w)
            w = rng.choice(follow[w]) if rng.random() < 0.85 else f"rare{rng.randint(0, 200)}"
            w = w if w in follow or rng.random() < 0.5 else rng.choice(words)
            follow.setdefault(w, rng.sample(words, 4))
        rows.append((k, " ".join(text), zlib.crc32(str(k).encode()) % 7 == 2))
    return rows


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in low.translate({c: 32 for c in range(9, 14)}).split(" ") if w]


def counted(rows):
    train = Counter()
    for _, t, h in rows:
        if not h:
            train.update([*words_of(t), None])
    N, V = sum(train.values()), len(train)
    out = []
    for i, t, h in rows:
        toks = [*words_of(t), None]
        base = sum(math.log10((train[w] + 1) / (N + 1 * (V + 1))) for w in toks)
        out.append((i, bool(h), len(toks), sum(train[w] > 0 for w in toks), N, round(base, 8)))
    return sorted(out, key=str)


ODD = [(900, None, False), (901, "", None), (902, " \t\n\x0b ", True), (903, "W1 w1 w1 x \x1f Ü ü", False),
       (904, "w1 w2 w3", False), (904, "w1 w2 w3", False), (None, "w4 w4", True), (905, "nie gesehen \U0001f600", True)]


@pytest.mark.parametrize("run, cell", [(3_000_000, 2_000_000), (40, 20)])
def test_counts_and_base_score(spark, monkeypatch, run, cell):
    monkeypatch.setattr(py, "RUN", run)
    monkeypatch.setattr(py, "CELL", cell)
    monkeypatch.setattr(py, "LEAST_CELLS", 3)
    rows = corpus(60) + ODD + [(950, " ".join(["again"] * 3000), False)]
    got = py.score_texts(docs(spark, rows).repartition(3)).collect()
    assert sorted((tuple(r)[:5] + (round(r.base_score, 8),) for r in got), key=str) == counted(rows)
    assert all(r.score < 0 for r in got)
    equal = {r.score for r in got if r.doc_id == 904}
    assert len(equal) == 1


def test_nothing_and_no_training_rows(spark):
    assert py.score_texts(docs(spark, [])).collect() == []
    (r,) = py.score_texts(docs(spark, [(1, "a b", True)])).collect()
    # Two dishes, the end and the rare word with one member more than it has.
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0)
    assert r.score == pytest.approx(3 * math.log10(0.5))
    (r,) = py.score_texts(docs(spark, [(1, None, False)])).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (1, 1, 1) and r.score <= 0


def plain_gibbs(rows, d_root, sweeps=60, burn=20, seed=1):
    """Every customer leaves its table and sits down again; every table is a customer above."""
    rng = random.Random(seed)
    train = Counter(w for _, t, h in rows if not h for w in [*words_of(t), 0])
    once = sum(1 for w, n in train.items() if n == 1 and w != 0)
    name = lambda w: w if w == 0 or train[w] >= 2 else 1
    K = sum(1 for w, n in train.items() if n >= 2 and w != 0) + 2
    pairs = Counter()
    for _, t, h in rows:
        if not h:
            s = [0, *[name(w) for w in words_of(t)], 0]
            pairs.update(zip(s, s[1:]))
    by = Counter(pairs.values())
    d = {0: min(0.95, max(0.05, by[1] / (by[1] + 2 * by[2]))), 1: d_root}
    tables = defaultdict(lambda: defaultdict(list))  # restaurant -> dish -> sizes
    size, open_ = Counter(), Counter()

    def prob(u, w):
        if u is None:
            return 1.0 / K
        level, up = (1, None) if u == "root" else (0, "root")
        n, t = sum(tables[u][w]), len(tables[u][w])
        return (n - d[level] * t + (1 + d[level] * open_[u]) * prob(up, w)) / (1 + size[u])

    def sit(u, w):
        level, up = (1, None) if u == "root" else (0, "root")
        sizes = tables[u][w]
        weights = [n - d[level] for n in sizes] + [(1 + d[level] * open_[u]) * prob(up, w)]
        k = rng.choices(range(len(weights)), weights)[0]
        size[u] += 1
        if k < len(sizes):
            sizes[k] += 1
            return
        sizes.append(1)
        open_[u] += 1
        if up:
            sit(up, w)

    def leave(u, w):
        sizes = tables[u][w]
        k = rng.choices(range(len(sizes)), sizes)[0]
        size[u] -= 1
        sizes[k] -= 1
        if not sizes[k]:
            sizes.pop(k)
            open_[u] -= 1
            if u != "root":
                leave("root", w)

    customers = [(f"c{u}", w) for (u, w), n in pairs.items() for _ in range(n)]
    for u, w in customers:
        sit(u, w)
    total = defaultdict(float)
    sequences = [[0, *[name(w) for w in words_of(t)], 0] for _, t, _ in rows]
    wanted = {ab for q in sequences for ab in zip(q, q[1:])}
    for s in range(sweeps):
        for u, w in customers:
            leave(u, w)
            sit(u, w)
        if s >= burn:
            for a, b in wanted:
                total[a, b] += prob(f"c{a}", b) / (sweeps - burn)
    return [
        sum(math.log10(total[a, b] / (once + 1 if b == 1 else 1)) for a, b in zip(q, q[1:])) for q in sequences
    ]


def test_scores_are_near_those_of_customer_by_customer_gibbs(spark):
    rows = corpus(120)
    got = {r.doc_id: r for r in py.score_texts(docs(spark, rows)).collect()}
    want = plain_gibbs(rows, d_root=0.3)
    for (i, _, h), score in zip(rows, want):
        assert got[i].score / got[i].n_tokens == pytest.approx(score / got[i].n_tokens, abs=0.08)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.15 * sum(r.n_tokens for r in held)
    tokens = sum(r.n_tokens for r in got.values())
    assert sum(r.score for r in got.values()) / tokens == pytest.approx(sum(want) / tokens, abs=0.02)


def test_probabilities_of_a_restaurant_sum_to_one():
    """All dishes of the vocabulary in each context, for any seating."""
    rng = np.random.default_rng(0)
    contexts, words = 5, 12
    keys = np.array([(u << 32) | w for u in range(contexts) for w in range(words)], np.uint64)
    c = rng.integers(0, 6, len(keys))
    t = np.minimum(c, rng.integers(1, 4, len(keys)))
    cell = py.Cell([py.pack(keys, sorted_=True), py.pack(c.astype(np.int64))], 3, np.array([], np.uint64))
    up = np.bincount(cell.word, weights=t, minlength=words)
    tables = np.minimum(up, 2)
    root = py.Root(int(up.sum()), int(tables.sum()), 0.4, words)
    p_root = root.probability(up - 0.4 * tables)
    assert p_root.sum() == pytest.approx(1.0)
    total = cell.per_context(t)[cell.context]
    p = (c - 0.7 * t + (1 + 0.7 * total) * p_root[cell.word]) / (1 + cell.per_context(c)[cell.context])
    assert cell.per_context(p * 1e9) == pytest.approx(np.full(contexts, 1e9), rel=1e-6)


def test_tables_follow_the_enumerated_seatings():
    """Weights of all seatings of four customers, each customer joining or opening a table."""
    d, theta, p, others, n = 0.6, 1.0, 0.07, 3, 4
    weight = Counter()
    for choice in product(range(n), repeat=n):
        sizes, w, ok = [], 1.0, True
        for k in choice:
            if k < len(sizes):
                w *= sizes[k] - d
                sizes[k] += 1
            elif k == len(sizes):
                w *= (theta + d * (others + len(sizes))) * p
                sizes.append(1)
            else:
                ok = False
                break
        if ok:
            weight[len(sizes)] += w
    rng, m = np.random.default_rng(0), 200_000
    t = py.draw_tables(rng, np.full(m, n), np.full(m, others), np.full(m, p), d, theta, py.stirling(d, n))
    for k in range(1, n + 1):
        assert (t == k).mean() == pytest.approx(weight[k] / sum(weight.values()), abs=0.004)


@pytest.mark.parametrize("d", [0.3, 0.7])
@pytest.mark.parametrize("p", [0.3, 0.01, 1e-5])
def test_large_dishes_follow_the_stirling_numbers(d, p):
    theta, n = 1.0, 300
    numbers, tables = py.stirling(d, n), np.arange(1, n + 1)
    for others in (40, 20_000):
        w = numbers[n, 1:] + np.cumsum(np.log(theta + d * (others + tables - 1))) + tables * np.log(p)
        w = np.exp(w - w.max())
        w /= w.sum()
        mean = (w * tables).sum()
        sd = math.sqrt((w * (tables - mean) ** 2).sum())
        m = 20_000
        t = py._draw_many(np.random.default_rng(1), np.full(m, n), np.full(m, others), np.full(m, np.log(p)), d, theta)
        assert t.mean() == pytest.approx(mean, abs=1.1) and t.std() == pytest.approx(sd, abs=0.35)


def test_packing():
    rng = np.random.default_rng(2)
    for kind in (np.uint32, np.uint64, np.int64):
        for n in (0, 1, 1000):
            a = np.sort(rng.integers(0, 1 << 30, n)).astype(kind)
            assert (py.unpack(py.pack(a), kind) == a).all() and (py.unpack(py.pack(a, sorted_=True), kind, sorted_=True) == a).all()


def test_runs_are_dealt_to_cells_in_pieces(monkeypatch):
    """Messages do not depend on the pieces, and a piece bounds what is held beside the tokens."""
    rng = np.random.default_rng(5)
    n = 2_000_000
    tokens = np.minimum(rng.zipf(1.2, n), 300_000).astype(np.uint32) + 1
    tokens[999::1000] = py.END
    hot = np.array([py.END, py.RARE, 2, 3], np.uint64)

    def made(fn, tokens):
        texts = len(tokens) // 1000
        row = {"run": 5, "tokens": py.pack(tokens), "held": [k % 7 == 2 for k in range(texts)], "n_tokens": [1000] * texts}
        return fn(row)

    for fn in (py._counted(67, hot), py._occurring(67, hot, {3: 2})):
        tracemalloc.start()
        sum(1 for _ in made(fn, tokens))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert most < 32 * n
        whole = list(made(fn, tokens[:200_000]))
        with monkeypatch.context() as m:
            m.setattr(py, "PIECE", 7001)
            assert list(made(fn, tokens[:200_000])) == whole
    assert sum(r[2] for r in made(py._counted(67, hot), tokens)) == n

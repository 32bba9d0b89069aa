"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import re

import pytest
from pyspark.sql import functions as F

from fadecast.llm import decontaminate, langid, licenses, linededup, mixing, neardup, pii, quality, urls, warc
from fadecast.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, n long, h string"
LONG = " ".join(f"w{k % 977}x{k % 1013}" for k in range(40_000))
LINE = "the quick brown fox jumps over the lazy dog near the river bank"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "src1", len(t or ""), "k", 1, "h") for i, t in rows], DOCS)


ROWS = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, LONG), (6, LINE), (6, LINE), (None, LINE), (7, "a")]


CLASHING = ("n_words", "lost_words", "removed", "removed_lines", "leaf", "copies", "token", "n", "root", "_key", "_id", "a b")


def test_clashing_columns_pass_through_the_stages(spark, tmp_path):
    rows = [(k, " ".join(f"w{k}x{i}" for i in range(60)) + f"\n{LINE}") for k in range(4)]
    d = docs(spark, rows).withColumns({c: F.lit(7) for c in CLASHING})
    spark.createDataFrame([(1, "no such words anywhere in here")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for run in (quality.stage, linededup.stage, neardup.stage, decontaminate.stage):
        out = run(spark, d, str(tmp_path))
        assert out.columns == d.columns and {r["root"] for r in out.collect()} == {7} and out.count() == 4
    mixed = mixing.stage(spark, d, "")
    assert set(mixed.columns) == set(d.columns) and {r["a b"] for r in mixed.collect()} == {7}


def by_id(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, str(r)))


@pytest.mark.parametrize(
    "run",
    [
        lambda d: langid.identify(d),
        lambda d: licenses.scan_documents(d),
        lambda d: quality.judge(d.withColumn("host", F.col("source"))),
        lambda d: linededup.dedup_lines(d),
        lambda d: neardup.near_duplicates(d),
        lambda d: mixing.mix(d.withColumn("domain", F.lit("web")), mixing.WEIGHTS),
        lambda d: decontaminate.contamination(d, d.select(F.col("doc_id").alias("item_id"), "text")),
        lambda d: quality.stage(d.sparkSession, d, ""),
        lambda d: linededup.stage(d.sparkSession, d, ""),
        lambda d: neardup.stage(d.sparkSession, d, ""),
        lambda d: mixing.stage(d.sparkSession, d, ""),
    ],
)
def test_empty_table_and_odd_rows(spark, run):
    assert run(docs(spark, [])).count() == 0
    rows = run(docs(spark, ROWS)).collect()
    assert len(rows) <= len(ROWS)


def test_languages(spark):
    rows = [(k, "the cat and the dog sat on the mat with that thing") for k in range(1, 30)]
    d = spark.createDataFrame(
        [(k, t, "en") for k, t in rows] + [(k + 100, "der hund und die katze saßen auf der matte mit dem ding", "de") for k, _ in rows],
        "doc_id long, text string, lang string",
    )
    extra = spark.createDataFrame([(500, None, "en"), (501, "", "en"), (502, "12 34 !", "en"), (None, "der hund", None)], d.schema)
    out = {r.doc_id: r for r in langid.identify(d.union(extra)).collect()}
    assert all(out[k].lang_pred == ("en" if k < 100 else "de") for k in out if k and k < 500)
    assert [(out[k].lang_pred, out[k].score) for k in (500, 501, 502)] == [("und", 0.0)] * 3
    assert out[None].lang_pred == "de" and out[None].held_out is False


def test_mixture_of_two_languages():
    import numpy as np

    en, de = "the cat and the dog with that thing ", "der hund und die katze auf der matte "
    counts = np.zeros((langid.BUCKETS, 2))
    for k, t in enumerate((de, en)):
        own, n = langid.grams(t * 50)
        counts[own, k] = n
    model = langid.Model(["de", "en"], counts)
    lang, score, parts = model.predict(en * 30 + de * 10)
    assert lang == "en" and set(parts) == {"de", "en"} and 0.6 < score < 0.9
    assert model.predict(en * 30)[2] == {"en": 1.0}


def test_long_text_counts_every_trigram(monkeypatch):
    own, n = langid.grams(LONG)
    monkeypatch.setattr(langid, "PIECE", 1000)
    own2, n2 = langid.grams(LONG)
    assert (own == own2).all() and (n == n2).all()


def test_licenses():
    t = licenses.Templates(licenses.TEMPLATES)
    n, found = licenses.scan("foo\nReleased under the MIT License.\nbar\nLicensed under CC BY-NC 4.0.\nx", t)
    assert n == 2 and [f[0] for f in found] == ["MIT", "CC-BY-NC-4.0"]
    assert licenses.scan("Licensed under CC BY 4.0.", t)[1][0][0] == "CC-BY-4.0"
    two = "This work is licensed under the GNU General Public License, version 2."
    assert licenses.scan(two, t)[1][0][0] == "GPL-2.0"
    whole = " ".join(licenses.TEMPLATES["MIT"][3].split()).replace("free of charge", "free of all charge")
    ((name, _, _, _, diff),) = licenses.scan(whole, t)[1]
    assert name == "MIT" and diff == "+all"
    assert licenses.scan("the licensee of the pub " * 50, t)[1] == []
    assert licenses.scan("", t) == (0, [])


def test_quality_boilerplate_goes_and_copies_do_not_count(spark):
    words = [f"{a}{b}" for a in "abcdefgh" for b in "mnopqrst"]
    unique = lambda k: " ".join(f"{w}{k}" for w in words)
    rows = [(k, f"{unique(k)}\nAccept   all 17 cookies") for k in range(60)]
    rows += [(100 + k, unique(1000)) for k in range(80)]  # one text, many copies
    rows += [(200, "\n".join(["accept all 23 cookies"] * 30)), (201, None)]
    out = {r.doc_id: r for r in quality.judge(docs(spark, rows).withColumn("host", F.lit("h1"))).collect()}
    assert all(out[k].kept and out[k].lost_words == 4 for k in range(60))
    assert all(out[100 + k].kept and out[100 + k].lost_words == 0 for k in range(80))
    assert out[200].base_failed and not out[200].kept and out[201].base_failed
    kept = quality.stage(spark, docs(spark, rows), "")
    assert kept.columns == [f.split()[0] for f in DOCS.split(", ")]
    texts = {r.doc_id: r for r in kept.collect()}
    assert texts[3].text == unique(3) and texts[3].n_chars == len(unique(3)) and len(texts) == 140


def test_url_rules_and_parts(spark):
    known = [
        (1, "http://WWW.Example.NET/en/x?y#z", "www.example.net", "/en/x", "example.net/en/", "allow"),
        (2, "https://a.example.net/de/", "a.example.net", "/de/", "net/", "block"),
        (3, "https://notexample.com/de/1", "notexample.com", "/de/1", None, None),
        (4, "https://example.com/de/1", "example.com", "/de/1", "example.com/de/", "block"),
        (5, "ftp://x.org/fr/a://b", "x.org", "/fr/a://b", "org/fr/", "allow"),
        (6, None, "", "", None, None),
        (7, "no scheme/x", "", "", None, None),
        (8, "https://host.net", "host.net", "", None, None),
        (9, "https://h.net?x=/a", "h.net", "", None, None),
        (10, "http://best-casino.example/slots/jackpot", "best-casino.example", "/slots/jackpot", None, "block"),
        (11, "https://www.library.example/docs/guide", "www.library.example", "/docs/guide", None, "allow"),
    ]
    d = spark.createDataFrame([(k[0], k[1], "x", 1.0) for k in known], "page_id long, url string, rule string, score double")
    out = {r.page_id: r for r in urls.judge(d, urls.RULES, urls.train(urls.labelled(spark))).collect()}
    for page, _, host, path, rule, verdict in known:
        r = out[page]
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or r.verdict)
    assert urls.judge(d.limit(0), urls.RULES, urls.train(urls.labelled(spark))).count() == 0


def test_warc_round_trip(spark, tmp_path):
    odd = "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n0\r\n\r\n é \x00"
    pages = [(1, "http://a/\r\nX: y", None), (2, None, ""), (3, "u", odd), (4, "u", odd * 5000), (5, "u", odd * 5000), (6, "u", "x" * 70)]
    pages += [(6, "u", "x" * 70), (None, "u", "x" * 70), (7, "u", "x")]
    d = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, kind string")
    path = str(tmp_path / "warc")
    warc.write_archives(d.repartition(3), path, segment=1000)
    rows = warc.read_archives(spark, path).collect()
    assert len(rows) == len(pages) and not any(r.problem for r in rows)
    found = {(r.page_id, r.record_type, r.refers_to): r for r in rows}
    assert found[(5, "response", None)].payload.decode() == odd * 5000
    assert found[(4, "revisit", 5)].payload_bytes == len((odd * 5000).encode())
    assert found[(4, "revisit", 5)].payload_digest == warc.base32_sha1((odd * 5000).encode())
    assert found[(1, "revisit", 2)].payload_bytes == 0
    assert (None, "revisit", 6) in found and sum(r.page_id == 6 and r.record_type == "response" for r in rows) == 2
    assert found[(7, "response", None)].payload == b"x"


def test_warc_finds_what_is_missing():
    parts = list(warc.page_records("1", 1, "u", b"y" * 5000, None, False, 1000))
    parsed = [next(warc.records(p)) for p in parts]
    assert len(parts) == 6 and b"".join(b for _, b in parsed).endswith(b"0\r\n\r\n")
    with pytest.raises(ValueError):
        list(warc.records(parts[0][:-10]))
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc")


def test_warc_incomplete_pages_have_a_problem(spark, tmp_path):
    import gzip

    whole = [p for k in (1, 2, 3) for p in warc.page_records(str(k), k, "u", b"z" * 3000, None, False, 1000)]
    n = len(whole) // 3
    lost = whole[: n - 1] + whole[n + 1 : n + 2] + whole[n + 2 : 2 * n] + whole[2 * n :][::-1]  # 1: no last, 2: no first
    (tmp_path / "a.gz").write_bytes(b"".join(gzip.compress(p) for p in lost))
    rows = {r.page_id: r for r in warc.read_archives(spark, str(tmp_path)).collect()}
    assert rows[1].problem == "the last segment is missing" and rows[1].payload is None
    assert rows[None].problem == "the first segment is missing"
    assert rows[3].problem is None and rows[3].payload == b"z" * 3000


def test_pii_rules_and_windows():
    text = "x a.b@c.example.com y 4202965827824311 to +1 (263) 555-5300 or 10.0.0.256 and 9.8.7.6."
    found = [(k, text[a:b]) for k, a, b in pii.base_spans(text)]
    assert ("email", "a.b@c.example.com") in found and ("phone", "+1 (263) 555-5300") in found
    assert ("ip", "9.8.7.6") in found and ("ip", "10.0.0.256") not in found
    assert pii.base_spans("") == [] and pii.base_spans("@" * 50) == []
    merged = pii.merged([("email", 2, 8)], [("phone", 7, 9), ("ip", 20, 25)])
    assert merged == [("email", 2, 8), ("ip", 20, 25)]


def test_pii_email_search_equals_the_pattern():
    import random

    r = random.Random(3)
    for _ in range(3000):
        text = "".join(r.choice("ab@.- é@.") for _ in range(r.randint(0, 25)))
        want = [("email", m.start(), m.end()) for m in pii.PATTERNS["email"].finditer(text)]
        assert pii._emails(text) == want, text


def test_pii_gradients_and_decoding():
    import numpy as np

    tagger = pii.Tagger()
    s, y = pii.windows_of(pii.labelled(2, seed=3))
    s, y = s[:2, :12], y[:2, :12]
    for row in y:
        if pii.TAGS[row[0]][0] == "I":
            row[0] -= 1
    _, g = tagger.gradients(s, y)
    r = np.random.default_rng(1)
    for name, grad in g.items():
        at = tuple(r.integers(0, d) for d in grad.shape)
        if name == "move" and not pii.ALLOWED[at]:
            continue
        values = []
        for e in (1e-5, -2e-5):
            tagger.w[name][at] += e
            values.append(tagger.gradients(s, y)[0])
        tagger.w[name][at] += 1e-5
        assert abs((values[0] - values[1]) / 2e-5 - grad[at]) < 1e-5
    # The best path by trying all of them.
    import itertools

    score = tagger.scores(s[:1, :4])[0]
    move = tagger.moves()
    paths = itertools.product(range(len(pii.TAGS)), repeat=4)
    best = max(paths, key=lambda p: sum(score[0, k, t] for k, t in enumerate(p)) + sum(move[a, b] for a, b in zip(p, p[1:])) + (0 if pii.START[p[0]] else pii.NEVER))
    assert tuple(tagger.decode(score)[0]) == best


def test_pii_reading_equals_the_plain_passes():
    """The fast forms against the plain ones: scores, probabilities, search over a stretch."""
    import numpy as np

    tagger, r = pii.Tagger(), np.random.default_rng(2)
    s = r.integers(0, pii.SYMBOLS, (6, pii.WINDOW))
    plain = tagger.scores(s)[0]
    assert np.abs(tagger.read(s) - plain).max() < 1e-4
    assert np.abs(tagger.chances(plain) - tagger.marginals(plain)[0]).max() < 1e-3
    for cells in (1, 2, 9, 30):
        score = r.normal(0, 2, (cells, pii.CELL, len(pii.TAGS)))
        whole = tagger.decode(score.reshape(1, cells * pii.CELL, -1))[0]
        assert (tagger.decode_long(score, block=4).ravel() == whole).all()
    # The weights of the two windows around a cell add up to one.
    flat = np.arange(8 * pii.CELL) % (pii.SYMBOLS - 1) + 1
    ones = pii._of_windows(flat, np.array([2, 3, 5]), lambda x: np.ones((*x.shape, 1), np.float32), 1)
    assert np.allclose(ones, 1)


def test_pii_long_numbers_and_many_spans_take_linear_time():
    import random
    import time

    began = time.perf_counter()
    assert pii.base_spans("7" * 1_000_000) == [] and pii.base_spans("1." * 500_000 + "1")[0] == ("ip", 0, 7)
    many = [("phone", 10 * k, 10 * k + 8) for k in range(100_000)]
    assert pii.merged(many, [("ip", 10 * k + 8, 10 * k + 9) for k in range(100_000)])[100_000] == many[0]
    assert time.perf_counter() - began < 20
    r = random.Random(5)
    as_given = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    for _ in range(5000):
        text = "".join(r.choice("0123.. a") for _ in range(r.randrange(40)))
        assert [m.span() for m in pii.PATTERNS["ip"].finditer(text)] == [m.span() for m in as_given.finditer(text)]
        spans = lambda: [(k, a, a + r.randrange(1, 9)) for k in pii.KINDS for a in range(r.randrange(9), 60, 17)]
        base, more = spans(), spans()
        free = [x for x in more if not any(a < x[2] and x[1] < b for _, a, b in base)]
        assert pii.merged(base, more) == sorted(base + free, key=lambda x: (pii.KINDS.index(x[0]), x[1], x[2]))


def test_pii_held_out_accuracy_and_window_borders(spark):
    tagger = pii.trained()
    test = pii.labelled(80, seed=12345)
    got = pii.tag_texts([t for t, _ in test], tagger)
    right = sum(len(set(a) & set(b)) for a, (_, b) in zip(got, test))
    assert right / max(1, sum(map(len, got))) > 0.95
    assert right / sum(len(b) for _, b in test) > 0.85
    # Rules and tagger together, by kind: spans that are met by one of the same kind.
    found, asked = dict.fromkeys(pii.KINDS, 0), dict.fromkeys(pii.KINDS, 0)
    for more, (text, gold) in zip(got, test):
        both = pii.merged(pii.base_spans(text), more)
        for kind, a, b in gold:
            asked[kind] += 1
            found[kind] += any(k == kind and x < b and a < y for k, x, y in both)
    assert all(found[k] >= 0.9 * asked[k] for k in pii.KINDS), (found, asked)
    # An address spelled out, with neither a digit nor an at sign in the text.
    assert pii.tag_texts(["write to anna_lee at mail.de, thanks"], tagger) == [[("email", 9, 28)]]
    # The same text at any distance from a window border gives the same spans.
    text = "write to the office of anna at (555) 321-9876 or later please "
    spans = [pii.tag_texts(["word " * k + text], tagger)[0] for k in range(0, 40, 3)]
    moved = {tuple((kind, a - 5 * k, b - 5 * k) for kind, a, b in s) for k, s in zip(range(0, 40, 3), spans)}
    assert len(moved) == 1
    rows = [(1, None), (2, ""), (3, "a@b.example.com" + " x" * 300_000), (3, "a@b.example.com" + " x" * 300_000), (None, "no number")]
    out = pii.find(docs(spark, rows).withColumn("spans", F.lit("clash")), tagger)
    assert by_id(out.select("doc_id", "spans")) == [(1, ""), (2, ""), (3, "email:0:15"), (3, "email:0:15"), (None, "")]
    assert pii.find(docs(spark, []), tagger).count() == 0


def test_line_dedup(spark):
    near = LINE + "s"
    rows = [(5, f"first line of this page here\n{LINE}"), (3, f"{near}\nshort one\nshort one"), (9, f"  {LINE.upper()}  \nunique text of nine stands alone"), (None, LINE), (10, None), (3, f"{near}\nshort one\nshort one")]
    out = by_id(linededup.dedup_lines(docs(spark, rows)).select("doc_id", "removed_lines"))
    assert out == [(3, None), (3, None), (5, [1]), (9, [0]), (10, None), (None, None)]
    left = {r.doc_id: r.text for r in linededup.stage(spark, docs(spark, rows), "").collect()}
    assert left[5] == "first line of this page here" and left[10] is None and left[None] == LINE


def test_one_id_with_two_texts(spark):
    other = "completely different sentence about mountains rivers and old stone bridges"
    out = by_id(linededup.dedup_lines(docs(spark, [(1, LINE), (1, other), (2, other)])).select("doc_id", "text", "removed_lines"))
    assert [r[2] for r in out if r[0] == 1] == [None, None] and [r[2] for r in out if r[0] == 2] == [[0]]
    same = by_id(neardup.near_duplicates(docs(spark, [(1, LINE), (5, LINE), (5, other), (7, other)])))
    assert [r[2] for r in same] == [1, 1, 1, 1]


def test_near_duplicates(spark):
    out = by_id(neardup.near_duplicates(docs(spark, ROWS)).select("doc_id", "component_id", "kept"))
    assert out == [(1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 4, False), (6, 6, True), (6, 6, True), (7, 7, True), (None, None, True)]


def test_components(spark):
    rows = [(k, k + 1) for k in range(200)] + [(500, 300), (400, 500), (7, 7), (900, 800), (900, 850)]
    d = spark.createDataFrame(rows, "a long, b long")
    got = {r.node: r.root for r in components(d).collect()}
    assert got == {**{k: 0 for k in range(1, 201)}, 500: 300, 400: 300, 900: 800, 850: 800}
    assert components(d.limit(0)).count() == 0


def test_decontamination(spark):
    item = " ".join(f"w{k}" for k in range(14))
    items = spark.createDataFrame([(1, item), (2, "only three words"), (10, "solo"), (3, None), (4, ""), (None, "lonely item")], "item_id long, text string")
    rows = [
        (1, "x y " + item.upper() + " z"),
        (2, " ".join(f"w{k}" for k in range(9))),
        (3, "here only, THREE words end"),
        (4, "solo solo"),
        (5, None),
        (6, " ".join(f"w{k}" for k in range(4, 14)) + " only three words solo"),
        (7, "a lonely item"),
    ]
    out = {r.doc_id: r for r in decontaminate.contamination(docs(spark, rows), items).collect()}
    assert [(out[k].n_hit, out[k].n_items) for k in range(1, 8)] == [(14, 1), (0, 0), (3, 1), (2, 1), (0, 0), (14, 3), (2, 0)]
    import hashlib

    assert out[6].items_sha256 == hashlib.sha256(b"1,10,2").hexdigest() and out[2].items_sha256 == hashlib.sha256(b"").hexdigest()
    assert decontaminate.contamination(docs(spark, rows), items.limit(0)).filter("contaminated").count() == 0


def test_mix_budgets(spark):
    leaves = spark.createDataFrame(
        [("a", "x", "s1", 10), ("a", "x", "s2", 1000), ("a", "y", "s3", 1000), ("b", "x", "s4", 50), ("c", "x", "s5", 900)],
        "domain string, lang string, source string, tokens long",
    )
    got = {r.leaf: r.budget for r in mixing.budgets(leaves, {"c": 0}, 600, 2).collect()}
    # b takes all it has (100); a takes the rest; within a/x the shortage of s1 goes to s2 first.
    assert got == {"a/x/s1": 20, "a/x/s2": 230, "a/y/s3": 250, "b/x/s4": 100, "c/x/s5": 0}


def test_mix_prefix_fits_the_budget(spark):
    d = docs(spark, [(k, "w " * (k % 7)) for k in range(3000)] + [(5, "w w"), (None, "w")]).withColumn("domain", F.lit("web"))
    out = mixing.mix(d, {}, share=130, max_epochs=3).collect()
    total, used = sum(r.n_tokens for r in out), sum(r.n_tokens * r.copies for r in out)
    assert total * 1.3 - 30 <= used <= total * 1.3 and {r.copies for r in out if r.n_tokens} == {1, 2}
    assert all(r.copies == 0 for r in out if r.n_tokens == 0) and len(out) == 3002


def crowd(n, seed=5):
    """Lines of one template whose names differ, each with one real partner."""
    import random

    r = random.Random(seed)
    word = lambda k: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(k))
    text = "the annual report of the regional library was sent to all members on time and in full, then read at the general meeting of may and approved without a vote against it by those present and signed "
    rows = [text[:150] + word(22) for _ in range(n)]
    rows += [x[:-12] + word(12) for x in rows]
    return rows


def test_line_dedup_of_a_crowded_band_equals_all_pairs(spark):
    lines = crowd(300)
    n = linededup.SHINGLE
    sets = [frozenset(x[i : i + n] for i in range(len(x) - n + 1)) for x in lines]
    partners = [{j for j in range(len(lines)) if j != i and 100 * len(a & sets[j]) >= linededup.PERCENT * len(a | sets[j])} for i, a in enumerate(sets)]
    assert all(partners[i] == {(i + 300) % 600} for i in range(600))
    out = linededup.dedup_lines(docs(spark, [*enumerate(lines), (900, LINE), (901, LINE)])).collect()
    assert {r.doc_id for r in out if r.removed_lines} == {*range(300, 600), 901}

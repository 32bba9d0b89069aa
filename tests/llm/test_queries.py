"""The registered queries on whole small tables: against their SQL, or by brute force."""

import hashlib
import os
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from fadecast.llm import catalog, common, decontaminate, licenses, linededup, mixing, neardup, pii, quality, urls
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
SPACE = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def texts(spark):
    return {r[0]: r[1] for r in common.table(spark, SF, "documents").select("doc_id", "text").collect()}


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, connect(SF), catalog.QUERIES[name], catalog.ORACLES[name], SF) == "ok"


def linked(sets, percent):
    """Smallest id reachable over links of similar non-empty sets; all pairs are tried."""
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                n = len(x & y)
                if 100 * n >= percent * (len(x) + len(y) - n):
                    p, q = root(a), root(b)
                    up[max(p, q)] = min(p, q)
    return {d: root(d) for d in ids}


def shingle_set(text, width):
    w = SPACE.findall((text or "").translate(LOWER))
    runs = [tuple(w[i : i + width]) for i in range(len(w) - width + 1)] or ([tuple(w)] if w else [])
    return frozenset(runs)


def test_near_duplicates_equal_all_pairs(spark, texts):
    want = linked({d: shingle_set(t, 3) for d, t in texts.items()}, 85)
    rows = neardup.op8_minhash_forest(spark, SF).collect()
    assert {r.doc_id: r.component_id for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) and r.n_shingles == len(shingle_set(texts[r.doc_id], 3)) for r in rows)


def gone_lines(texts):
    """Lines that are not the first of their component of similar lines."""
    where = defaultdict(list)
    for d, t in texts.items():
        for k, line in enumerate((t or "").split("\n")):
            line = linededup.normal(line)
            if line:
                where[line].append((d, k))
    n = linededup.SHINGLE
    # A line without a shingle is like its equals only.
    sets = {min(v): frozenset(x[i : i + n] for i in range(len(x) - n + 1)) or frozenset([x]) for x, v in where.items()}
    root = linked(sets, linededup.PERCENT)
    return {p for v in where.values() for p in v if p != root[min(v)]}


def test_line_dedup_equals_all_pairs(spark, texts):
    rows = linededup.op7_line_dedup(spark, SF).collect()
    got = {(r.doc_id, int(k)) for r in rows for k in r.removed_lines.split(",") if k}
    assert got == gone_lines(texts) and len(rows) == len(texts)
    assert all(r.n_lines == len(texts[r.doc_id].split("\n")) for r in rows)


def test_languages_on_held_out_documents(spark):
    d = "/root/testdata/sf0.01"
    rows = catalog.QUERIES["op1_language_mixture"](spark, d)
    rows = rows.join(common.table(spark, d, "documents").select("doc_id", "lang", "text"), "doc_id").filter("held_out").collect()
    judged = [r for r in rows if r.lang_pred != "und"]
    assert len(judged) > 100 and sum(r.lang == r.lang_pred for r in judged) / len(judged) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_licenses_equal_a_search_for_their_lines(spark, texts):
    known = {t: name for name, all_texts in licenses.TEMPLATES.items() for t in all_texts if "\n" not in t}
    rows = licenses.op2_license_scan(spark, SF).collect()
    found = 0
    for r in rows:
        names = {known[x] for x in texts[r.doc_id].split("\n") if x in known}
        assert names <= set(r.licenses.split(",")), r
        found += bool(names)
        if not re.search(licenses.CUES, texts[r.doc_id], re.IGNORECASE):
            assert r.n_blocks == 0 and r.licenses == ""
    assert len(rows) == len(texts) and found > 3


def test_url_rules_equal_brute_force(spark):
    rows = {r.page_id: r for r in urls.op4_url_filter(spark, SF).collect()}
    pages = common.table(spark, SF, "pages").select("page_id", "url").collect()
    assert len(rows) == len(pages)
    for p in pages:
        rest = p.url.split("://", 1)[1] if p.url and "://" in p.url else ""
        host = re.match("[^/?#]*", rest).group()
        path = re.match("[^?#]*", rest[len(host) :]).group()
        host = host.translate(LOWER)
        fit = [k for k in urls.RULES if ("." + host).endswith("." + k.split("/")[0]) and path.startswith(k[k.index("/") :])]
        rule = max(fit, key=len) if fit else None
        r = rows[p.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (urls.RULES[rule] if rule else "block" if r.score >= 0.5 else "allow")


def test_personal_data_equals_the_patterns(spark, texts):
    for r in pii.op6_pii_tagger(spark, SF).collect():
        base = []
        for kind, pattern in pii.PATTERNS.items():
            for m in pattern.finditer(texts[r.doc_id]):
                digits = re.sub("[^0-9]", "", m.group())
                fits = {
                    "email": True,
                    "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                    "card": 16 <= len(digits) <= 19 and pii.luhn(digits),
                    "phone": 8 <= len(digits) <= 15,
                }[kind]
                if fits:
                    base.append((kind, m.start(), m.end()))
        n = Counter(k for k, _, _ in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(n[k] for k in pii.KINDS)
        assert r.base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert set(pii.joined(base).split(",")) <= set(r.spans.split(","))


def test_pipeline_equals_brute_force(spark):
    """Each stage against SQL or all pairs over its own input."""
    con = connect(SF)
    docs = common.table(spark, SF, "documents")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = common.written(stage(spark, docs, SF), "test")
        rows = out.collect()
        before = {r.doc_id: r for r in docs.collect()}
        after = {r.doc_id: r for r in rows}
        con.register("stage_docs", docs.toPandas())
        con.execute("CREATE OR REPLACE VIEW documents AS SELECT * FROM stage_docs")
        if name == "quality rules":
            sql = con.execute(quality.ORACLE).df()
            assert set(after) == set(sql[sql.kept].doc_id)
            lost = dict(zip(sql.doc_id, sql.lost_words))
            assert all(len(SPACE.findall(before[d].text)) - len(SPACE.findall(r.text)) == lost[d] for d, r in after.items())
        elif name == "line dedup":
            gone = gone_lines({d: r.text for d, r in before.items()})
            for d, r in before.items():
                left = [x for k, x in enumerate(r.text.split("\n")) if (d, k) not in gone]
                assert (d in after) == bool("".join(left).strip()) and (d not in after or after[d].text == "\n".join(left))
        elif name == "minhash near-dedup":
            root = linked({d: shingle_set(r.text, 5) for d, r in before.items()}, 80)
            assert set(after) == {d for d in before if root[d] == d}
        elif name == "benchmark decontamination":
            sql = con.execute(decontaminate.ORACLE).df()
            assert set(after) == set(sql[~sql.contaminated].doc_id)
        else:
            sql = con.execute(mixing.ORACLE).df()
            assert {d: (r.leaf, r.copies) for d, r in after.items()} == {
                x.doc_id: (x.leaf, x.copies) for x in sql.itertuples() if x.copies > 0
            }
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == names and all(r.n_chars == len(r.text) for r in rows)
        docs = out
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, rows))

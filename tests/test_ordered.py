import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fadecast.operators import ordered


def skewed(n=200, seed=1):
    """One key holds most rows; ordinals have holes; values repeat."""
    rnd = random.Random(seed)
    keys = ["hot" if rnd.random() < 0.7 else rnd.choice(["a", "b", "c"]) for _ in range(n)]
    ids = sorted(rnd.sample(range(3 * n), n))
    return pd.DataFrame({"k": keys, "id": ids, "v": [rnd.randint(0, 5) for _ in range(n)]})


def by_key(pdf, order):
    pdf = pdf.sort_values(["k", *order])
    pdf["want"] = pdf.groupby("k").cumcount()
    pdf["n_want"] = pdf.groupby("k")["k"].transform("size")
    return pdf


@pytest.mark.parametrize("size", [1, 7, 1000])
@pytest.mark.parametrize("parts", [1, 5])
def test_positions(spark, size, parts):
    pdf = skewed()
    df = spark.createDataFrame(pdf).repartition(parts)
    got = ordered.positions(df, ["k"], "id", total="n", size=size).toPandas()
    want = by_key(pdf, ["id"])
    m = got.merge(want, on=["k", "id", "v"])
    assert len(m) == len(pdf)
    assert (m["pos"] == m["want"]).all() and (m["n"] == m["n_want"]).all()


@pytest.mark.parametrize("parts", [1, 6])
def test_sorted_positions_with_ties(spark, parts):
    pdf = skewed(300, 2)
    df = spark.createDataFrame(pdf).repartition(parts)
    got = ordered.sorted_positions(df, ["k"], ["v", "id"], total="n").toPandas()
    m = got.merge(by_key(pdf, ["v", "id"]), on=["k", "id", "v"])
    assert len(m) == len(pdf)
    assert (m["pos"] == m["want"]).all() and (m["n"] == m["n_want"]).all()


def test_sorted_positions_of_a_whole_table(spark):
    df = spark.createDataFrame([(i,) for i in (5, 3, 9, 1)], "x int")
    got = ordered.sorted_positions(df, [], ["x"], total="n").orderBy("x").collect()
    assert [(r["pos"], r["n"]) for r in got] == [(0, 4), (1, 4), (2, 4), (3, 4)]


def test_null_keys_keep_their_rows(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, id int")
    got = ordered.positions(df, ["k"], "id").collect()
    assert sorted((r["k"] or "", r["pos"]) for r in got) == [("", 0), ("", 1), ("a", 0)]
    got = ordered.sorted_positions(df, ["k"], ["id"]).collect()
    assert sorted((r["k"] or "", r["pos"]) for r in got) == [("", 0), ("", 1), ("a", 0)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(size=st.integers(1, 40), back=st.integers(0, 9), ahead=st.integers(0, 9))
def test_sliding_frames_cross_chunks(spark, size, back, ahead):
    pdf = by_key(skewed(120, 3), ["id"])
    df = spark.createDataFrame(pdf.rename(columns={"want": "pos"}))
    got = ordered.sliding(
        df, ["k"], "pos", lambda w: {"s": F.sum("v").over(w.rowsBetween(-back, ahead))},
        back=back, ahead=ahead, size=size,
    ).toPandas()
    assert len(got) == len(pdf)
    for _, g in got.groupby("k"):
        g = g.sort_values("pos")
        v = g["v"].to_list()
        want = [sum(v[max(0, i - back) : i + ahead + 1]) for i in range(len(v))]
        assert g["s"].to_list() == want


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("size", [1, 6, 500])
def test_running(spark, inclusive, size):
    pdf = by_key(skewed(150, 4), ["id"])
    df = spark.createDataFrame(pdf.rename(columns={"want": "pos"}))
    got = ordered.running(
        df, ["k"], "pos",
        {"s": ("sum", F.col("v")), "hi": ("max", F.when(F.col("v") > 2, F.col("pos"))), "lo": ("min", F.col("v"))},
        inclusive=inclusive, size=size,
    ).toPandas()
    for _, g in got.groupby("k"):
        g = g.sort_values("pos")
        v, p = g["v"].to_list(), g["pos"].to_list()
        for i in range(len(v)):
            part = list(zip(p, v))[: i + 1 if inclusive else i]
            row = g.iloc[i]
            seen = [q for q, x in part if x > 2]
            assert (pd.isna(row["s"]) and not part) or row["s"] == sum(x for _, x in part)
            assert (pd.isna(row["lo"]) and not part) or row["lo"] == min(x for _, x in part)
            assert (pd.isna(row["hi"]) and not seen) or row["hi"] == max(seen)


def test_segments_own_every_row_once(spark):
    pdf = by_key(skewed(130, 5), ["id"]).rename(columns={"want": "pos"})
    segs = ordered.segments(spark.createDataFrame(pdf), ["k"], "pos", ["v"], back=3, ahead=2, size=10).collect()
    for k, g in pdf.groupby("k"):
        v = g.sort_values("pos")["v"].to_list()
        owned = []
        for s in (s for s in segs if s["k"] == k):
            stop = s["start"] + len(s["v"])
            assert s["v"] == v[s["start"] : stop]
            assert s["start"] == max(0, s["own_from"] - 3)
            assert stop == min(len(v), s["own_to"] + 2)
            owned += range(s["own_from"], min(s["own_to"], len(v)))
        assert sorted(owned) == list(range(len(v)))

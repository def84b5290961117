"""A hot key (a third of all rows) gives the same answers as a brute-force computation."""

from __future__ import annotations

import random

import pandas as pd

from tradeflow.operators import align_pair, keep_latest
from tradeflow.operators.increment import profile_sources


def _rows(n=3000, seed=7):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else f"k{rnd.randint(0, 200)}"
        out.append((key, rnd.randint(0, 5), float(rnd.randint(1, 100)), rnd.randint(0, 1_000_000)))
    return out


def test_align_with_hot_key(spark):
    rows = _rows()
    v = spark.createDataFrame([(k, x) for k, _s, x, _o in rows if _s % 2 == 0], "k string, value double")
    w = spark.createDataFrame([(k, x) for k, _s, x, _o in rows if _s % 3 == 0], "k string, weight double")
    got = {r.k: (r.value, r.weight) for r in align_pair(v.repartition(8), w.repartition(8), ["k"]).collect()}
    pv = pd.DataFrame([(k, x) for k, s, x, _o in rows if s % 2 == 0], columns=["k", "value"])
    pw = pd.DataFrame([(k, x) for k, s, x, _o in rows if s % 3 == 0], columns=["k", "weight"])
    want = pv.groupby("k").sum().merge(pw.groupby("k").sum(), on="k", how="inner")
    assert got == {k: (r.value, r.weight) for k, r in want.iterrows()}
    assert "hot" in got


def test_keep_latest_with_hot_key(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "k string, s int, x double, o long").repartition(8)
    got = {r.k: (r.x, r.o) for r in keep_latest(df, ["k"], ["o", "s"]).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "s", "x", "o"]).sort_values(["o", "s"], kind="stable")
    want = pdf.drop_duplicates("k", keep="last").set_index("k")
    assert got == {k: (r.x, r.o) for k, r in want.iterrows()}


def test_profile_with_hot_source(spark):
    import datetime as dt
    rows = [("hot" if i % 3 == 0 else f"s{i % 17}", dt.date(2015 + i % 7, 1 + i % 12, 1)) for i in range(3000)]
    got = {r.source: (r.years_text, r.row_count)
           for r in profile_sources(spark.createDataFrame(rows, "source string, date date").repartition(8),
                                    "source", "date").collect()}
    pdf = pd.DataFrame(rows, columns=["source", "date"])
    for src, grp in pdf.groupby("source"):
        years = "|".join(str(y) for y in sorted({d.year for d in grp["date"]}))
        assert got[src] == (years, len(grp))

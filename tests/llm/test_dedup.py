"""Exact, substring and line dedup against brute force."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
from messy import by_id, frame, lower, rows, words

from tradeflow.llm.exact_dedup import exact_dedup, misra_gries
from tradeflow.llm.line_dedup import remove_boilerplate
from tradeflow.llm.substring_dedup import substring_dedup


def test_exact_dedup(spark):
    own = rows()
    groups = defaultdict(list)
    for i, t, *_ in own:
        groups[hashlib.sha256(lower(t).encode()).hexdigest()].append(i)
    found = exact_dedup(frame(spark), carry=("lang",)).collect()
    assert len(found) == len(own)
    kept = Counter()
    for r in found:
        ids = groups[r.text_sha256]
        known = [i for i in ids if i is not None]
        assert r.group_size == len(ids) and r.keep_id == (max(known) if known else None)
        if r.kept:
            kept[r.text_sha256] += 1
            assert r.doc_id == r.keep_id
    assert kept == Counter(groups.keys())
    assert set(r.lang for r in found) == {"en", "de", None}


def test_exact_dedup_is_the_same_with_few_counters(spark):
    many = spark.createDataFrame([(k, "hot" if k % 3 else f"t{k % 50}") for k in range(3000)], "doc_id long, text string")
    found = [by_id(exact_dedup(many, counters=c).collect()) for c in (1, 4, 1024)]
    assert found[0] == found[1] == found[2]
    assert sum(r[-1] for r in found[0]) == len({r[1] for r in found[0]})
    assert exact_dedup(many.limit(0)).collect() == []


def test_misra_gries_bounds(spark):
    values = ["a"] * 500 + ["b"] * 200 + [f"r{k}" for k in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(5)
    found = {r.v: r.estimate for r in misra_gries(df, "v", 9).collect()}
    for v, n in Counter(values).items():
        assert n - len(values) / 10 <= found.get(v, 0) <= n


def removed_brute(own, window):
    texts = [words(t) for _, t, *_ in own]
    seen = Counter(b" ".join(w[k:k + window]) for w in texts for k in range(len(w) - window + 1))
    out = []
    for (i, *_), w in zip(own, texts):
        gone = set()
        for k in range(len(w) - window + 1):
            if seen[b" ".join(w[k:k + window])] > 1:
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return by_id(out)


@pytest.mark.parametrize("window, anchor", [(35, 16), (5, 2)])
def test_substring_dedup(spark, window, anchor):
    assert by_id(substring_dedup(frame(spark), window, anchor).collect()) == removed_brute(rows(), window)


def test_substring_dedup_splits_hot_buckets(spark, monkeypatch):
    import tradeflow.llm.substring_dedup as module
    monkeypatch.setattr(module, "SPLIT_PLACES", 8)
    monkeypatch.setattr(module, "HEAVY_PARTS", 64)
    own = rows()[:40]
    assert by_id(substring_dedup(frame(spark, own), 6, 3).collect()) == removed_brute(own, 6)


def test_substring_dedup_of_nothing(spark):
    assert substring_dedup(frame(spark).limit(0)).collect() == []


def lines_brute(own, min_sites, min_chars, max_share):
    sites = defaultdict(set)
    for _, t, _, s in own:
        for x in (t or "").split("\n"):
            sites[x.strip(" ")].add(s)
    bad = {x for x, s in sites.items() if len(s - {None}) >= min_sites and len(x) >= min_chars}
    out = []
    for i, t, *_ in own:
        lines = (t or "").split("\n")
        lost = [x for x in lines if x.strip(" ") in bad]
        if t and sum(len(x.strip(" ")) for x in lost) <= max_share * len(t):
            out.append((i, "\n".join(x for x in lines if x.strip(" ") not in bad), len(lines), len(lost)))
        else:
            out.append((i, t, len(lines), 0))
    return by_id(out)


def test_line_dedup(spark):
    found = remove_boilerplate(frame(spark), min_sites=5, min_chars=10)
    assert found.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    assert by_id(found.select("doc_id", "text", "n_lines", "n_removed").collect()) == lines_brute(rows(), 5, 10, 0.5)
    assert found.filter("n_removed > 0").count() > 15
    assert found.filter("n_chars <> char_length(text)").count() == 0


def test_line_dedup_counts_near_lines_exactly(spark):
    # Lines on 5 to 15 sites around a threshold of 10, within the margin.
    own = [(100 * n + s, f"the line of {n} sites is this one\nown words of {n} and {s} fill the rest of the text here", "en", f"s{s}")
           for n in range(5, 16) for s in range(n)]
    found = remove_boilerplate(frame(spark, own), min_sites=10).filter("n_removed = 1").select("doc_id").collect()
    assert sorted(r[0] for r in found) == sorted(100 * n + s for n in range(10, 16) for s in range(n))
    assert remove_boilerplate(frame(spark).limit(0)).collect() == []


def test_pages_of_mostly_boilerplate_lose_it_but_copies_stay(spark):
    from corpus_pipeline import line_dedup
    line = "this very long line of boilerplate stands on each of the sites of this corpus"
    story = "\n".join(f"line {k} of a story that was copied to many sites word for word {k * k}" for k in range(9))
    page = [" ".join(f"own{k}{j}" for j in range(9)) for k in range(12)]
    own = [(k, f"{page[k]}\n{line}", "en", f"s{k}") for k in range(12)]
    own += [(100 + k, story + (f" {k}" if k % 2 else ""), "en", f"s{k}") for k in range(12)]
    own += [(200, line, "en", "s1"), (201, story.split("\n")[0] + "\nno copy", "en", "s3")]
    found = {r.doc_id: r.text for r in line_dedup(spark, frame(spark, own), "").collect()}
    assert all(found[k] == page[k] for k in range(12)) and found[200] == ""
    assert all(found[i] == t for i, t, *_ in own if 100 <= i < 200) and found[201] == "no copy"

"""Source divergence, spelling variants and secret scans against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from messy import by_id, frame, lower, rows

from tradeflow.llm import divergence as dv
from tradeflow.llm import runs, secret_scan, spelling

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
RUN = re.compile("[A-Za-zÀ-ÿ]+")


# --- runs ------------------------------------------------------------------

@pytest.mark.parametrize("size", [1, 7, 50, 1 << 20])
def test_runs_are_the_same_in_blocks_of_any_size(size):
    texts = ["", "One two ONE", None, "é" * 40 + " Ünder two", "x" * 100, "a1b2c3 a", " ", "end"]
    inside = dv._INSIDE
    found = defaultdict(Counter)
    for part in runs.counted_runs(pa.array(texts), ~inside, dv._terms, size):
        for r, t, n in zip(part.row.tolist(), part.term.tolist(), part.count.tolist()):
            assert part.terms[t].as_py().decode() not in found[r]  # all of a text at once
            found[r][part.terms[t].as_py().decode()] += n
    for k, text in enumerate(texts):
        assert found[k] == Counter(lower(x) for x in TERM.findall(text or ""))


def test_no_run_crosses_texts():
    texts = pa.array(["abc", "def", "gh ij", "kl"])
    found = [part.terms.to_pylist() for part in runs.counted_runs(texts, ~dv._INSIDE, dv._terms)]
    assert found == [[b"abc", b"def", b"gh", b"ij", b"kl"]]


# --- source divergence ------------------------------------------------------

def audit_brute(own, least, top):
    seen, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in own:
        words = [lower(w) for w in TERM.findall(text or "")]
        groups.add((lang or "", source or ""))
        seen[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    out = set()
    for lang in {x for x, _ in groups}:
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        sources = sorted(s for x, s in groups if x == lang)

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10 ** 9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}
        p = {s: shares(seen[lang, s]) for s in sources}
        q = shares(sum((seen[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // (p[s][t] + q[t]), t) for t in kept
                     if seen[lang, s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, len(pairs)), ("term", terms, top)):
                order = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out |= {(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(order)}
    return out


@pytest.mark.parametrize("least,top", [(10, 10), (1, 3), (10_000, 10)])
def test_divergence_equals_brute_force(spark, least, top):
    own = rows() + [(900 + k, "Copied TEXT of many sites, ça et là", None if k % 2 else "fr", f"site{k % 5}") for k in range(30)]
    found = dv.divergence(frame(spark, own).repartition(5), least, top).collect()
    assert len(found) == len(set(found))
    assert {tuple(r) for r in found} == audit_brute(own, least, top)


def test_divergence_with_more_sources_than_an_array_holds(spark, monkeypatch):
    own = [(k, f"same words here {k % 3}", "en", f"s{k}") for k in range(40)]
    monkeypatch.setattr(dv, "SOURCES_A_ROW", 4)
    found = dv.divergence(frame(spark, own), 2, 10).collect()
    assert {tuple(r) for r in found} == audit_brute(own, 2, 10)


def test_divergence_weights_in_parts(monkeypatch):
    monkeypatch.setattr(dv, "ENTRIES", 3)
    batch = pa.RecordBatch.from_pylist(
        [{"lang": "en", "text": "a b a", "copies": [{"source": "x", "n": 2}, {"source": "y", "n": 1}]},
         {"lang": "fr", "text": "a", "copies": [{"source": "x", "n": 5}]}])
    got = Counter()
    for part in dv._weighted(batch):
        for r in part.to_pylist():
            got[r["lang"], r["source"], r["term"]] += r["n"] * 100 + r["docs"]
    assert got == {("en", "x", "a"): 402, ("en", "x", "b"): 202, ("en", "y", "a"): 201, ("en", "y", "b"): 101,
                   ("fr", "x", "a"): 505}


def test_divergence_of_nothing(spark):
    empty = frame(spark).limit(0)
    assert dv.divergence(empty).collect() == []
    blank = frame(spark, [(1, None, None, None), (2, "", None, "s")])
    assert {tuple(r) for r in dv.divergence(blank, 1).collect()} == {
        ("", "", "pair", "s", 0, 1), ("", "s", "pair", "", 0, 1)}


def test_shares_are_exact_beyond_64_bits(spark):
    n, total, v = 123_456_789_012_345_678, 987_654_321_098_765_432, 1_000_003
    got = spark.range(1).select(dv.share(dv.F.lit(n), dv.F.lit(total), dv.F.lit(v))).first()[0]
    assert got == 1 + 10 ** 9 * (n + 2) // (total + 2 * v)


# --- spelling variants ------------------------------------------------------

def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def counts_brute(own, least):
    out = Counter()
    for i, text, *_ in own:
        for run in RUN.findall(text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                out[run] += 1
    return out


def variants_brute(own, least=7, least_n=2, ratio=10):
    n = {w: c for w, c in counts_brute(own, least).items() if c >= least_n}
    near = {w: [x for x in n if abs(len(x) - len(w)) <= 1 and one_edit(w, x)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), None if form[w] is None else n[form[w]]))
    return out


def spelled(seed=3):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abeinorstéß") for _ in range(rng.randrange(6, 12))) for _ in range(40)]
    own = []
    for k in range(60):
        words = []
        for _ in range(120):
            w = rng.choice(base[:4]) if rng.random() < 0.6 else rng.choice(base)
            if rng.random() < 0.2:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice("abé") + w[at + 1:], w[:at] + "o" + w[at:]])
            words.append(w.upper() if rng.random() < 0.1 else w)
        own.append((k if k else None, rng.choice([" ", "-", "1"]).join(words), "en", "s"))
    # A chain of forms: each ten times as frequent as the one before.
    chain = ["chainword", "chainwordx", "chainwordxy", "chainwordxyz"]
    own.append((500, " ".join(w for k, w in enumerate(chain) for _ in range(3 * 11 ** k)), "en", "s"))
    own.append((501, "anagrams smanagra anagrams smanagra Àccents×÷ Àccents×÷ Àccents×ÿ Àccents×ÿ", "en", "s"))
    return own


def test_variants_equal_brute_force(spark):
    own = rows() + spelled()
    expected = variants_brute(own)
    assert len(expected) >= 300 and any(r[2] != r[1] for r in expected if r[1])
    found = spelling.variants(frame(spark, own).repartition(4)).collect()
    assert len(found) == len(expected)
    assert {tuple(r) for r in found} == expected


@pytest.mark.parametrize("letters,classes", [(40, 3), (100, 5), (1 << 20, 9)])
def test_variants_do_not_depend_on_blocks(spark, monkeypatch, letters, classes):
    own = spelled(seed=letters)
    monkeypatch.setattr(spelling, "BLOCK_LETTERS", letters)
    monkeypatch.setattr(spelling, "letter_classes", lambda n: classes)
    assert {tuple(r) for r in spelling.variants(frame(spark, own)).collect()} == variants_brute(own)


def test_variants_with_small_matrices(monkeypatch):
    monkeypatch.setattr(spelling, "CELLS", 5)
    words = sorted({w for r in variants_brute(spelled()) for w in [r[0]] if len(w) == 8})
    codes = np.array([list(w.encode("latin-1")) for w in words], np.uint8)
    i, j = spelling.near_pairs(codes, spelling._block(codes), codes, spelling._block(codes))
    assert sorted(zip(i.tolist(), j.tolist())) == [
        (a, b) for a in range(len(words)) for b in range(len(words)) if one_edit(words[a], words[b])]


def test_crc_goes_on_from_a_prefix():
    rng = random.Random(1)
    parts = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 7, 30, 300]))) for _ in range(400)]
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    prefix = np.array([zlib.crc32(f"{k}:".encode()) for k in range(len(parts))], np.uint32)
    got = spelling.crc32_with_prefix(prefix, data, ends - [len(p) for p in parts], ends)
    assert got.tolist() == [zlib.crc32(f"{k}:".encode() + p) for k, p in enumerate(parts)]


def test_variants_of_very_long_words(spark):
    long = "ab" * 30_000
    own = [(1, f"{long} {long} {long}c {long}c", "en", "s"), (2, f"{long}c " * 30, "en", "s")]
    assert {tuple(r) for r in spelling.variants(frame(spark, own), damage=10 ** 9 + 7).collect()} == {
        (long, f"{long}c", f"{long}c", 2, 1, 32), (f"{long}c", None, f"{long}c", 32, 1, None)}


def test_variants_of_nothing(spark):
    assert spelling.variants(frame(spark).limit(0)).collect() == []
    assert spelling.variants(frame(spark, [(1, None, None, None), (2, "", "en", "s"), (3, "short one", "en", "s")])).collect() == []


# --- secret scans -----------------------------------------------------------

BASE = {"assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                             re.I | re.A),
        "access": re.compile("AKIA[A-Z0-9]+"), "hex": re.compile("[0-9a-f]+")}
KEY = "wJalrXUtnFEMI9K7MDENGbPxRfiCYzT3q8LpQ0vN2sHd"


def base_brute(text):
    out = []
    for place, (kind, pattern) in enumerate(BASE.items()):
        for m in pattern.finditer(text or ""):
            size = len(m[2]) if kind == "assign" else len(m[0])
            if size >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                out.append((m.start(), place, m.end(), kind))
    return sorted(out)


def secret_rows():
    code = "def load_configuration_manager(settings):\n    return settings.connection_timeout\n"
    hexes = "0123456789abcdef" * 3
    return [
        (1, None), (2, ""), (3, "no secrets at all"), (4, 'password = "hunter22" and pass'), (5, "token: abc"),
        (6, f"é ñ token={hexes} ü {hexes}"), (7, "AKIA" + "A" * 16 + " AKIAAKIA" + "Z" * 11), (8, "TOKEN==a.b-c/d+e"),
        (9, "f" * 23 + " " + "f" * 24 + "g" + "0" * 24), (10, "api_key:'K1234567' apikey \"x\" apikey\" : \"yyyyyyy"),
        (11, code * 3 + f"Authorization: Bearer {KEY}\n" + code),
        (12, code * 3 + "bearer load_configuration_manager2 connection_timeout1\n" + code),
        (13, f"aws_secret_access_key  {KEY} and é"), (14, f"nothing sensitive {KEY}"),
        (14, f"nothing sensitive {KEY}"), (None, f"credential\n{KEY}"), (15, "password password=secret=tokentoken"),
        (16, ("prose of many words. " * 90_000) + "passwd=zzzzzzz " + "a1" * 12 + " end"), (17, hexes),
    ]


def test_secret_scan(spark):
    own = secret_rows()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in own], "doc_id long, text string, spans string, n_hex int")
    found = secret_scan.scan(docs.repartition(3)).collect()
    expected = []
    for i, text in own:
        base = base_brute(text)
        listed = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in base)
        count = Counter(kind for *_, kind in base)
        expected.append((i, count["assign"], count["access"], count["hex"], hashlib.sha256(listed.encode()).hexdigest()))
    assert by_id([tuple(r)[:5] for r in found]) == by_id(expected)
    spans = defaultdict(list)
    for r in found:
        spans[r.doc_id].append(r.spans)
        kept = [s for s in r.spans.split(",") if s and not s.startswith("novel")]
        assert hashlib.sha256(",".join(kept).encode()).hexdigest() == r.base_sha256
        assert kept == [s for s in r.spans.split(",") if s and not s.startswith("novel")]
    texts = dict(own)
    novel = {i: [texts[i][int(a):int(b)] for s in every[0].split(",") if s for k, a, b in [s.split(":")] if k == "novel"]
             for i, every in spans.items()}
    assert novel[11] == [KEY] and novel[13] == [KEY]  # random, after a sensitive word
    assert novel[12] == []  # made of the identifiers around
    assert novel[14] == [] and novel[None] == []  # no sensitive word, or on another line
    assert all(novel[i] == [] for i in (1, 2, 3, 4, 5, 9, 16, 17))


def test_secret_scan_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert secret_scan.scan(empty).collect() == []


def test_identifiers_leave_secrets_out(spark):
    docs = spark.createDataFrame([(k, f"the settings bearer {KEY} connection") for k in range(5)], "doc_id long, text string")
    found = {r.word: r.n for r in secret_scan.identifiers(docs).collect()}
    assert found == {"the": 5, "settings": 5, "bearer": 5, "connection": 5}
    assert set(secret_scan.dictionary(docs).split()) == {b"the", b"settings", b"bearer", b"connection"}
    assert secret_scan.dictionary(docs, size=12) in (b"connection", b"bearer")


@pytest.mark.parametrize("block", [1, 3, 24, 25, 1 << 20])
def test_hex_runs_across_blocks(monkeypatch, block):
    monkeypatch.setattr(secret_scan, "BLOCK_BYTES", block)
    for text in ("", "f" * 24, "f" * 23, "x" + "0" * 30, "a" * 24 + "z" + "b" * 25 + "zz", "g" * 50):
        raw = np.frombuffer(text.encode(), np.uint8)
        assert secret_scan.hex_runs(raw) == [(m.start(), m.end()) for m in re.finditer("[0-9a-f]{24,}", text)]


def test_novelty_is_what_a_string_adds():
    words = b"configuration manager settings connection timeout handler"
    plain, primed = secret_scan.Novelty(b""), secret_scan.Novelty(words)
    text = b"bearer configuration_manager_timeout1 end"
    a, b = 7, 37
    assert text[a:b] == b"configuration_manager_timeout1"
    assert primed.share(text, a, b) < 0.6 < plain.share(text, a, b)
    key = b"bearer " + KEY.encode() + b" end"
    assert primed.share(key, 7, 7 + len(KEY)) >= 0.6

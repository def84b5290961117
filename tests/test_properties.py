"""Property: decoding a flat cube index recovers the coordinates it was encoded from."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from tradeflow.functions import mixed_radix

shapes = st.lists(st.integers(min_value=1, max_value=9), min_size=1, max_size=7)


@st.composite
def cells(draw):
    sizes = draw(shapes)
    coords = draw(st.lists(st.tuples(*[st.integers(0, s - 1) for s in sizes]), min_size=1, max_size=20))
    return sizes, coords


def _encode(sizes, coord):
    flat = 0
    for size, c in zip(sizes, coord):
        flat = flat * size + c
    return flat


@settings(max_examples=25, deadline=None)
@given(cells())
def test_decode_of_encode_is_identity(spark, case):
    sizes, coords = case
    rows = [(sizes, _encode(sizes, c)) for c in coords]
    df = spark.createDataFrame(rows, "s array<bigint>, k bigint")
    got = [tuple(r[0]) for r in df.select(mixed_radix("k", "s")).collect()]
    assert got == [tuple(c) for c in coords]


@settings(max_examples=15, deadline=None)
@given(cells())
def test_decode_cube_recovers_codes(spark, case):
    import json

    from tradeflow.operators.cube import decode_cube
    from tradeflow.sources.cubes import parse_cubes

    sizes, coords = case
    ids = [f"d{i}" for i in range(len(sizes))]
    dimension = {d: {"category": {"index": {f"{d}_{p}": p for p in reversed(range(s))},
                                  "label": {f"{d}_{p}": f"L{p}" for p in range(s) if p % 2 == 0}}}
                 for d, s in zip(ids, sizes)}
    value = {str(_encode(sizes, c)): float(i) for i, c in enumerate(coords)}
    doc = json.dumps({"id": ids, "size": sizes, "dimension": dimension, "value": value})
    cubes = parse_cubes(spark.createDataFrame([("x.json", doc)], "source_path string, json string"))
    got = {r.flat_index: (dict(r.codes), dict(r.labels)) for r in decode_cube(cubes).collect()}
    for c in coords:
        codes, labels = got[_encode(sizes, c)]
        assert codes == {d: f"{d}_{p}" for d, p in zip(ids, c)}
        assert labels == {d: (f"L{p}" if p % 2 == 0 else f"{d}_{p}") for d, p in zip(ids, c)}

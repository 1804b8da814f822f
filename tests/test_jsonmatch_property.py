"""json_contains against a brute-force containment check on random JSON."""

import json

from hypothesis import HealthCheck, given, settings, strategies as st

from eventide.functions.jsonmatch import json_contains

scalars = st.one_of(st.none(), st.booleans(), st.integers(-3, 3), st.sampled_from([1.0, 2.5, -0.5, 1e-11, 1e30, 2**63]),
                    st.sampled_from(["a", "b", "true", "1", ""]))
values = st.recursive(scalars, lambda inner: st.one_of(
    st.lists(inner, max_size=3), st.dictionaries(st.sampled_from(["a", "é", "q\"q", "b\\c"]), inner, max_size=3)),
    max_leaves=6)


def _eq(d, p):
    if isinstance(p, bool) or isinstance(d, bool):
        return isinstance(p, bool) and isinstance(d, bool) and d == p
    if isinstance(p, (int, float)) and p is not None:
        return isinstance(d, (int, float)) and not isinstance(d, bool) and float(d) == float(p)
    if p is None:
        return d is None
    return isinstance(d, str) and d == p


def contains(doc, pat, top=True):
    if isinstance(pat, dict):
        return isinstance(doc, dict) and all(k in doc and contains(doc[k], v, False) for k, v in pat.items())
    if isinstance(pat, list):
        return isinstance(doc, list) and all(any(contains(d, p, False) for d in doc) for p in pat)
    if isinstance(doc, list) and top:
        return any(not isinstance(d, (list, dict)) and _eq(d, pat) for d in doc)
    if isinstance(doc, (list, dict)):
        return False
    return _eq(doc, pat)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(values, min_size=1, max_size=6), values)
def test_matches_brute_force(spark, docs, pattern):
    rows = [(i, json.dumps(d)) for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "i int, doc string")
    got = {r.i: r.m for r in df.select("i", json_contains("doc", json.dumps(pattern)).alias("m")).collect()}
    want = {i: contains(d, pattern) for i, d in enumerate(docs)}
    assert got == want, (docs, pattern)

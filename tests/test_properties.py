"""Randomised checks against brute force in plain Python (small inputs)."""

import hashlib
from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from docrel.operators import division, documents, grouping, integrity, sampling

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

pairs_st = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 5), st.integers(0, 4)), max_size=40)
divisor_st = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 4)), max_size=6)


def brute_divide(dividend, divisor, grouped):
    need = defaultdict(set)
    for g, i in divisor:
        need[g if grouped else None].add(i)
    have = defaultdict(set)
    for g, e, i in dividend:
        have[(g if grouped else None, e)].add(i)
    out = set()
    for (g, e), items in have.items():
        req = need.get(g)
        if req and req <= items:
            out.add((g, e) if grouped else (e,))
    return out


@SETTINGS
@given(pairs_st, divisor_st, st.booleans())
def test_division_matches_brute_force(spark, dividend, divisor, grouped):
    dd = spark.createDataFrame(dividend, "g long, e long, i long")
    dv = spark.createDataFrame(divisor, "g long, i long")
    g = "g" if grouped else None
    if not grouped:
        dv = dv.select("i")
        divisor = [(0, i) for _, i in divisor]
    want = brute_divide(dividend, divisor, grouped)
    a = {tuple(r) for r in division.divide(dd, dv, "e", "i", group=g).collect()}
    b = {tuple(r) for r in division.divide_by_containment(dd, dv, "e", "i", group=g).collect()}
    assert a == b == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 30)), max_size=80), st.integers(1, 6))
def test_bucketed_embed_invariants(spark, children, max_len):
    parent = spark.createDataFrame([(k,) for k in range(5)], "k long")
    child = spark.createDataFrame(children, "k long, v long")
    out = documents.embed(parent, child, "k", "k", "v", "arr", max_len=max_len).collect()
    got = defaultdict(list)
    chunks = defaultdict(dict)
    for r in out:
        got[r["k"]] += r["arr"] or []
        chunks[r["k"]][r["_chunk"]] = r["arr"]
    for k in range(5):
        vals = [v for kk, v in children if kk == k]
        assert Counter(got[k]) == Counter(vals)                  # nothing lost or added
        if vals:
            home = {c: a for c, a in chunks[k].items() if c >= 0}
            over = {c: a for c, a in chunks[k].items() if c < 0}
            for v in set(vals):                                  # one home row per value
                assert sum(v in a for a in home.values()) == 1
                assert max(a.count(v) for a in home.values()) == min(max_len, vals.count(v))
            for a in over.values():                              # overflow: bounded repeats
                assert 0 < len(a) <= max_len and len(set(a)) == 1
                assert any(a[0] in h for h in home.values())
            assert len(vals) > max_len or set(chunks[k]) == {0}
        else:
            assert not chunks[k]


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 10 ** 6)), min_size=1, max_size=60,
                unique_by=lambda t: t[1]),
       st.integers(1, 5))
def test_assign_ids_dense_in_order(spark, rows, parts):
    df = spark.createDataFrame(rows, "g long, x long")
    ids = {r["x"]: r["id"] for r in integrity.assign_ids(df, ["x"], "id", num_partitions=parts).collect()}
    assert [ids[x] for x in sorted(ids)] == list(range(1, len(rows) + 1))
    gid = {r["x"]: r["gid"] for r in
           integrity.assign_ids(df, ["x"], "gid", start=0, group_cols=["g"], num_partitions=parts).collect()}
    for g in {g for g, _ in rows}:
        xs = sorted(x for gg, x in rows if gg == g)
        assert [gid[x] for x in xs] == list(range(len(xs)))


@SETTINGS
@given(st.lists(st.integers(0, 6), max_size=30), st.integers(1, 6))
def test_top_k_with_ties_matches_rank(spark, values, k):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v long")
    got = sorted(r["id"] for r in grouping.top_k_with_ties(df, "v", k).collect())
    want = sorted(i for i, v in enumerate(values) if 1 + sum(w > v for w in values) <= k)
    assert got == want


def md5_int(*parts):
    return int(hashlib.md5("|".join(str(p) for p in parts).encode()).hexdigest()[:8], 16)


def py_sample(seed, entity, m, k):
    drawn = []
    for j in range(min(k, m)):
        v = md5_int(seed, entity, j) % (m - j)
        for c in sorted(drawn):
            if v >= c:
                v += 1
        drawn.append(v)
    return drawn


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 50)), max_size=40, unique_by=lambda t: t[1]),
       st.integers(1, 5), st.integers(0, 99))
def test_sampling_matches_python(spark, items, k, seed):
    ents = [(e, e % 3) for e in range(12)]
    edf = spark.createDataFrame(ents, "e long, g long")
    idf = spark.createDataFrame([(g, i) for g, i in items] or [(9, 0)], "g long, i long")
    got = sorted(tuple(r) for r in sampling.sample_per_entity(edf, idf, "e", "g", "i", k, seed).collect())
    by_g = defaultdict(list)
    for g, i in items or [(9, 0)]:
        by_g[g].append(i)
    want = []
    for e, g in ents:
        its = sorted(by_g.get(g, []))
        want += [(e, its[p]) for p in py_sample(seed, e, len(its), k)]
    assert got == sorted(want)


@SETTINGS
@given(st.lists(st.lists(st.integers(0, 6), max_size=8), min_size=1, max_size=25), st.integers(1, 4))
def test_bucketed_lookup_in_array_matches_counts(spark, arrays, max_len):
    owners = spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "_id long, arr array<long>")
    items = spark.createDataFrame([(k,) for k in range(8)], "k long")
    out = documents.lookup_in_array(items, owners, "k", "arr", "docs", max_len=max_len,
                                    doc_cols=["_id"]).collect()
    got = defaultdict(list)
    for r in out:
        got[r["k"]] += [d["_id"] for d in r["docs"]]
    assert set(got) == set(range(8))                    # a row for every item
    for k in range(8):
        want = sorted(i for i, a in enumerate(arrays) if k in a)
        assert sorted(got[k]) == want                    # each owner once, none lost
    counts = {r["k"]: r["n"] for r in documents.lookup_count(
        items, owners, "k", "arr", "n", foreign_is_array=True).collect()}
    assert counts == {k: len(got[k]) for k in range(8)}

from collections import Counter

import numpy as np
import xxhash
from llm_cases import DOCS, SPACED, awkward, documents, plain, text, words
from pyspark.sql import functions as F

from clickpath.llm import simhash
from clickpath.llm.components import components, contract


def fingerprint(t):
    w = SPACED.findall(plain(t))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    votes = Counter(b for s in shingles for b in range(64) if xxhash.xxh64_intdigest(s, 42) >> b & 1)
    return sum(1 << b for b, n in votes.items() if 2 * n > len(shingles))


def closure(edges):
    low = {}

    def find(x):
        while low.setdefault(x, x) != x:
            x = low[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        low[max(a, b)] = min(a, b)
    return {x: find(x) for x in low}


def brute_components(prints):
    values = sorted(set(prints))
    return closure([(a, b) for a in values for b in values if (a ^ b).bit_count() <= 3])


def near_rows():
    base = words(40, 120)
    rows = awkward()
    for k in range(40):
        changed = list(base)
        for j in range(k % 4):
            changed[(7 * k + 31 * j) % 120] = "changed" + str(k * j)
        rows.append((100 + k, " ".join(changed)))
    return rows + [(200, base[0].upper() + "  " + " ".join(base[1:]))]


def test_fingerprints_and_components(spark):
    rows = near_rows()
    prints = [fingerprint(t) for _, t in rows]
    roots = brute_components(prints)
    smallest = {}
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            smallest[roots[p]] = min(i, smallest.get(roots[p], i))
    want = Counter((i, f"{p:016x}", smallest.get(roots[p])) for (i, _), p in zip(rows, prints, strict=True))
    got = simhash.near_duplicates(documents(spark, rows)).select("doc_id", simhash.hex_digits(F.col("bits")).alias("f"), "component_id").collect()
    assert Counter((r.doc_id, r.f, r.component_id) for r in got) == want
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).collect() == []


def test_one_of_each_keeps_columns(spark):
    rows = near_rows()
    docs = documents(spark, rows)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    prints = {(i, t): fingerprint(t) for i, t in rows}
    roots = brute_components(prints.values())
    groups = Counter(roots[prints[(r.doc_id, r.text)]] for r in kept.collect())
    assert set(groups.values()) == {1} and set(groups) == set(roots.values())


def flipped(random, value, n):
    for b in random.choice(64, n, replace=False).tolist():
        value ^= 1 << b
    return value


def test_links_equal_brute_force_in_calm_and_crowded_keys(spark):
    random = np.random.default_rng(5)
    values = {int(x) for x in random.integers(0, 1 << 64, 200, dtype=np.uint64)}
    for centre in list(values)[:5]:
        values |= {flipped(random, centre, int(n)) for n in random.integers(1, 6, 60)}
    signed = [v - (1 << 64) if v >> 63 else v for v in sorted(values)]
    prints = spark.createDataFrame([(v,) for v in signed], "bits long")
    want = closure([(a, b) for a in signed for b in signed if ((a ^ b) & (2**64 - 1)).bit_count() <= 3])
    for crowd in (1000, 2):
        found = closure([(r.u, r.v) for r in simhash.links(prints, crowd=crowd).collect()])
        assert {v: found.get(v, v) for v in signed} == want, crowd


def test_golay_code_is_perfect():
    checks, errors = simhash.golay()
    assert len({int(m << 11 | checks[m]) for m in range(4096)}) == 4096
    weights = [[bin(e).count("1") for e in row if e >= 0] for row in errors.tolist()]
    assert all(w[0] <= 3 and sum(x <= 3 for x in w) == 1 for w in weights)


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(501, 560)] + [(700, 701), (701, 702), (702, 700)] + [(9, 9), (1, 2), (2, 1), (-5, 3)]
    want = {v: r for v, r in closure(edges).items() if v != r}
    frame = spark.createDataFrame(edges, "u long, v long")
    assert {r.u: r.root for r in components(frame).collect()} == want
    assert components(frame.limit(0)).collect() == []
    u, v = contract(*map(np.array, zip(*edges, strict=True)))
    assert dict(zip(u.tolist(), v.tolist(), strict=True)) == want


def test_star_rounds_without_contraction(spark, monkeypatch):
    from clickpath.llm import components as module

    monkeypatch.setattr(module, "CHUNK", 7)
    edges = [(k, k + 1) for k in range(100, 130)] + [(50, 60), (60, 40), (40, 99)]
    frame = spark.createDataFrame(edges, "u long, v long")
    want = {v: r for v, r in closure(edges).items() if v != r}
    assert {r.u: r.root for r in module.components(frame).collect()} == want


def test_no_join_of_the_keys_is_broadcast(spark, monkeypatch):
    """Spark takes the keys for a table of the fingerprints' size: at any size it must not be sent to the driver."""
    plans, kept = [], simhash.stored
    monkeypatch.setattr(simhash, "stored", lambda df, name: (plans.append((name, df._jdf.queryExecution().executedPlan().toString())), kept(df, name))[1])
    docs = documents(spark, near_rows())
    simhash.near_duplicates(docs).collect()
    simhash.one_of_each(docs, crowd=2).collect()
    found = [plan for name, plan in plans if name == "simhash-links"]
    assert len(found) == 2
    for plan in found:
        assert "SortMergeJoin" in plan
        assert not [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "Inner" in line]

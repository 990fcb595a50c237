import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from llm_cases import text

from clickpath.llm.contraction import subtree_totals, with_children
from clickpath.llm.prefix_tree import prefix_tree
from clickpath.llm.running import running_sums
from pyspark.sql import functions as F

SCHEMA = "conv_id long, turn long, role string, text string, key string, c long, d long, n long, size long, place string, mark string"


def mark(role, said):
    return hashlib.md5(f"{len(role.encode())}:{role}{said}".encode()).hexdigest()


def brute(rows):
    """The nodes as the definition has them: dictionaries of turn tuples, recursion over children."""
    turns = defaultdict(list)
    for c, turn, role, said in rows:
        if c is not None:
            role, said = role or "", said or ""
            turns[c].append((turn is not None, turn or 0, mark(role, said), len(said.encode()), (role, said)))
    own = {c: [t[-1] for t in sorted(x)] for c, x in turns.items()}
    members, ending = defaultdict(set), defaultdict(set)
    for c in own:
        h, family = zlib.crc32(str(c).encode()) % 9, c - (abs(c) % 5) * (1 if c >= 0 else -1)
        whole = tuple(own.get(family, [])[:h] + own[c][h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].add(c)
        ending[whole].add(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[x] for x in children[p]) or 1
        saved[p] = sum(saved[x] for x in children[p]) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    return Counter((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(ending[p]))).encode()).hexdigest()) for p, m in members.items())


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 2, 3, 4, "p", "m") for r in rows], SCHEMA)


def got(spark, rows):
    return Counter(tuple(r) for r in prefix_tree(conversations(spark, rows)).collect())


def awkward():
    rng = random.Random(7)
    rows = [(None, 0, "user", "nobody's"), (1, None, None, None), (1, None, "", ""), (1, 3, "user", "ü" * 5), (1, 3, "user", "ü" * 5), (1, 2, "user", text(1, 3000)),
            (0, 1, "a", "x"), (0, 1, "a", "x"), (0, 1, "b", "x"), (3, 0, "user:", "x"), (4, 0, "user", ":x"), (-3, 1, "user", "minus"), (-7, 1, "user", "minus"), (2**62, 0, "user", "big")]
    for c in range(5, 60):          # some families without their first conversation, many equal turns
        if c not in (10, 25):
            rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(["", "a", "b"])) for t in range(rng.randint(1, 11))]
    rows += [(c, t, "user", "copy") for c in range(100, 400) for t in range(2)]                 # a group of copies
    rows += [(c, t, "user", f"one {c}" if t == 30 else f"line {t}") for c in (500, 505, 510) for t in range(40)]     # chains
    rng.shuffle(rows)
    return rows


def test_nodes_against_brute_force(spark):
    rows = awkward()
    assert got(spark, rows) == brute(rows)


def test_empty_and_rootless(spark):
    assert got(spark, []) == Counter() and got(spark, [(None, 1, "user", "x")]) == Counter()
    one = [(1, 0, "user", "x")]          # conversation 0 is absent: a turnless member of the root alone
    assert got(spark, one) == brute(one) and len(brute(one)) == 1


@pytest.mark.parametrize("shape", ["chain", "star", "random", "forest"])
def test_contraction_of_any_tree(spark, shape):
    rng, n = random.Random(shape), 60
    up = {"chain": lambda k: k - 1, "star": lambda k: 0, "random": lambda k: rng.randrange(max(0, k - 4), k), "forest": lambda k: None if k % 7 == 0 else k - 1}[shape]
    parent = [None] + [up(k) for k in range(1, n)]
    weight = [rng.randrange(100) for _ in range(n)]
    total = list(weight)
    for k in range(n - 1, 0, -1):
        if parent[k] is not None:
            total[parent[k]] += total[k]
    rows = [(k, k % 3, p, None if p is None else p % 3, weight[k], 1) for k, p in enumerate(parent)]
    nodes = spark.createDataFrame(rows, "c long, d long, up_c long, up_d long, w long, one long")
    found = {r.c: (r.d, r.w) for r in subtree_totals(with_children(nodes), ["w", "one"]).collect()}
    assert found == {k: (k % 3, total[k]) for k in range(n)}


def test_running_sums_do_not_depend_on_the_cut(spark):
    rng = random.Random(3)
    rows = [(0 if k < 150 else rng.randrange(1, 30), k, rng.randrange(-5, 50)) for k in range(400)]
    df = spark.createDataFrame(rows, "key long, at long, value long").withColumn("wide", F.floor(F.col("key") / 10).cast("long"))
    want, sums, wide = {}, defaultdict(int), defaultdict(int)
    for key, at, value in sorted(rows):
        sums[key] += value
        wide[key // 10] += value
        want[at] = (sums[key], wide[key // 10])
    for parts in (1, 7, 40):
        found = running_sums(df, [F.col("key").asc(), F.col("at").asc()], [("key", "value", "upto"), ("wide", "value", "of_wide")], parts)
        assert {r.at: (r.upto, r.of_wide) for r in found.collect()} == want

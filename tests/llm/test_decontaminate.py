import random
from collections import Counter

import numpy as np
import pytest
from llm_cases import DOCS, NOT_WORD, awkward, documents, plain, text, words

from clickpath.llm import decontaminate
from clickpath.llm.decontaminate import ShardIndex, contamination, suffix_order


def items():
    shared = " ".join(words(77, 30))
    return [(1, text(50, 40)), (2, shared + " tail"), (3, "Head " + shared), (4, "short item"), (5, None), (6, "..."), (None, text(51, 20)), (2, shared + " tail"), (7, "la " * 20)]


def brute(rows, bench, size=13):
    windows = {}
    for i, t in bench:
        w = NOT_WORD.findall(plain(t))
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[k:k + size]), set()).add(i)
    out = Counter()
    for i, t in rows:
        w = NOT_WORD.findall(plain(t))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= {str(x) for x in windows[tuple(w[k:k + n])] if x is not None}
        out[(i, len(w), len(hit), ",".join(sorted(found)), bool(hit) and 20 * len(hit) >= len(w))] += 1
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 150])
def test_contamination_equals_brute_force(spark, block_bytes):
    bench = items()
    passage = bench[0][1]
    rows = awkward() + [(30, text(1, 100) + " " + passage.upper() + "! " + text(2, 100)), (31, passage[:60]), (32, "a short, ITEM here"), (33, bench[1][1] + " " + bench[2][1]),
                        (34, text(3, 2000) + " short item"), (35, bench[6][1]), (36, "la " * 30), (37, " ".join(passage.split()[:12])), (38, " ".join(passage.split()[:13])), (38, passage)]
    frame = spark.createDataFrame([(i, t, "x") for i, t in bench], "item_id long, text string, doc string")
    got = contamination(documents(spark, rows), frame, block_bytes=block_bytes).collect()
    assert Counter((r.doc.doc_id, r.n_words, r.n_hit, ",".join(sorted(r["items"])), r.contaminated) for r in got) == brute(rows, bench)
    for r in got:
        assert sum(b - a for a, b in zip(r.starts, r.ends, strict=True)) == r.n_hit


def test_driver_holds_one_block(spark, monkeypatch):
    """Of a benchmark of many blocks, one is drawn, and one passed over, at a time; results are whole."""
    import gc
    import weakref
    bench = [(k, text(900 + k, 20)) for k in range(30)] + [(99, None), (100, text(950, 400))]
    rows = [(k, text(k, 5) + " " + bench[k][1]) for k in range(30)] + [(40, text(950, 400)), (41, text(41, 50)), (42, None)]
    alive, held, sizes = weakref.WeakSet(), [], []

    made = decontaminate.Phrases

    def counted(ids, texts, size):
        gc.collect()
        block = made(ids, texts, size)
        alive.add(block)
        held.append(len(alive))
        sizes.append(sum(len(t or "") for t in texts))
        return block

    monkeypatch.setattr(decontaminate, "Phrases", counted)
    frame = spark.createDataFrame(bench, "item_id long, text string").repartition(5)
    found = contamination(documents(spark, rows), frame, block_bytes=400)
    assert len(held) >= 8 and max(held) == 1
    assert max(sizes) <= max(400 + max(len(t or "") for _, t in bench[:-1]), 400 + len(bench[-1][1]))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    got = found.collect()
    assert Counter((r.doc.doc_id, r.n_words, r.n_hit, ",".join(sorted(r["items"])), r.contaminated) for r in got) == brute(rows, bench)


@pytest.mark.parametrize("block_bytes", [1 << 20, 1])
def test_results_without_texts_are_the_same(spark, block_bytes):
    bench = spark.createDataFrame([(k, text(k, 20)) for k in range(4)], "item_id long, text string")
    docs = documents(spark, [(k, text(k, 20) + " " + text(k + 50, 30)) for k in range(8)] + [(9, None)])
    whole, bare = (contamination(docs, bench, block_bytes=block_bytes, keep_text=k) for k in (True, False))
    assert "text" in whole.schema["doc"].dataType.names and "text" not in bare.columns + bare.schema["doc"].dataType.names
    cols = ["doc.doc_id", "n_words", "starts", "ends", "items", "n_hit", "contaminated"]
    assert sorted(map(str, whole.select(*cols).collect())) == sorted(map(str, bare.select(*cols).collect()))
    assert bare.filter("contaminated").count() >= 4


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([], DOCS), spark.createDataFrame([], "item_id long, text string")
    assert contamination(docs, bench).collect() == []
    got = contamination(documents(spark, [(1, "a b"), (2, None)]), bench).collect()
    assert sorted((r.doc.doc_id, r.n_words, r.n_hit, r.contaminated) for r in got) == [(1, 2, 0, False), (2, 0, 0, False)]


def test_suffix_order_and_search():
    random_ = random.Random(4)
    for _ in range(20):
        symbols = np.array([0] + [random_.choice([0, 1, 1, 2, 3]) for _ in range(200)] + [1] * 40 + [0], np.int64)
        order = suffix_order(symbols)
        keyed = [[(0, k) if s == 0 else (s, 0) for k, s in enumerate(symbols.tolist())][k:] for k in range(len(symbols))]
        assert order.tolist() == sorted(range(len(symbols)), key=lambda k: keyed[k])
        index = ShardIndex(symbols, 3)
        phrases = np.array([[0, 1, 1], [1, 2, 1], [3, 3, 3], [0, 0, 2], [1, 1, 1]])
        which, low, high = index.search(phrases)
        found = {w: sorted(index.locate(np.arange(a, b)).tolist()) for w, a, b in zip(which.tolist(), low, high, strict=True)}
        for k, row in enumerate(phrases.tolist()):
            p = [s for s in row if s]
            places = [i for i in range(len(symbols)) if symbols[i:i + len(p)].tolist() == p]
            assert found.get(k, []) == places

from collections import Counter

from llm_cases import DOCS, NOT_WORD, awkward, documents, plain, text

from clickpath.llm.licenses import BASE, licenses

NOTICE = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"


def base_places(t):
    w = NOT_WORD.findall(plain(t))
    return len(w), [(k, label) for phrase, label in BASE.items() for k in range(len(w)) if w[k:k + len(phrase.split())] == phrase.split()]


def test_base_places_on_awkward_rows(spark):
    rows = awkward() + [(20, "the GNU General, Public-LICENSE cc by cc by; MIT license"), (21, "cc  BY\napache license apache\nlicense"), (22, text(1, 90) + " CC BY " + text(2, 90))]
    got = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses(documents(spark, rows)).collect())
    want = Counter()
    for i, t in rows:
        n, places = base_places(t)
        at = [k for k, _ in places]
        want[(i, n, len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))] += 1
    assert got == want


def test_method_finds_changed_notices(spark):
    changed = NOTICE.replace("free of charge", "free of any charge").replace("associated ", "")
    rows = [(1, text(1, 50) + " " + NOTICE), (2, changed), (3, NOTICE[:40]), (4, "Permission " + text(3, 400) + " granted"), (5, text(9, 400))]
    got = {r.doc_id: (r.labels, r.score) for r in licenses(documents(spark, rows)).collect()}
    assert got[1] == ("mit", 1.0)
    assert got[2][0] == "mit" and 0.75 <= got[2][1] < 1.0
    assert got[3] == got[4] == got[5] == ("", 0.0)


def test_plan_is_native_and_empty_table_has_no_rows(spark):
    empty = spark.createDataFrame([], DOCS)
    found = licenses(empty)
    assert found.collect() == []
    from clickpath.llm.licenses import diagonals
    plan = diagonals(empty)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan

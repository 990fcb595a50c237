import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import DOCS, NOT_WORD, awkward, documents, plain, text
from pyspark.sql import types as T
from test_decontaminate import brute
from test_simhash import brute_components, fingerprint

import corpus_pipeline
from clickpath.llm import html_text, toxicity

BAD = ["grobnik", "vellash", "torquid"]


def toxic_rows(n=400):
    random_ = random.Random(8)
    rows, labels = [], []
    for k in range(n):
        t, bad = text(1000 + k, random_.randint(20, 200)).split(), k % 5 == 0
        if bad:
            for _ in range(4):
                t.insert(random_.randrange(len(t)), random_.choice(BAD) + random_.choice(["", "en", "er", "ly"]))
        rows.append((k, " ".join(t)))
        labels.append((k, 1, int(bad), "x"))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int, score string"


def test_folding_undoes_disguises():
    assert toxicity.fold("1D10T tr@sh ѕtupіd l0s​er ｃｌｏｗｎ") == "idiot trash stupid loser clown"
    assert toxicity.fold("in 2024, 50 $ for a 4x4!") == "in 2024, 50 $ for a 4x4!"
    assert toxicity.fold(None) == ""


def test_toxicity_learns_stems_and_leaves_clean_texts(spark):
    rows, labels = toxic_rows()
    rows += [(k + 5000, t) for k, (i, t) in enumerate(awkward())] + [(None, "grobnik vellashen torquid"), (9000, "gr0bnik vellаshly t0rquider " + text(1, 30))]
    labels += [(7, None, None, "x"), (None, 0, 1, "x"), (5, 0, 0, "x")]
    got = toxicity.toxicity(documents(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc.doc_id: r for r in got}
    wrong = sum(by_id[k].predicted != (k % 5 == 0) for k in range(400))
    assert wrong <= 2
    held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 4 == 2]
    assert sum(by_id[k].predicted != (k % 5 == 0) for k in held) <= 1
    assert by_id[9000].predicted == 1
    assert all(by_id[5000 + k].predicted == 0 for k in range(len(awkward())))
    assert all(0 <= r.score <= 1 for r in got)


def test_exceptions_excuse_hits():
    lexicon = toxicity.Lexicon({"scum": 5.0}, {"grob": 4.0}, ["pond scum"])
    auto = lexicon.automaton()
    assert [h[2] for h in lexicon.hits(auto, "pond scum, scum grobly agrob scummy")] == ["scum", "grob"]
    empty = toxicity.Lexicon()
    assert empty.hits(empty.automaton(), "anything") == []


def _plain_hits(lexicon, text):
    """All entries at all places, one by one."""
    found = {}
    for start in range(len(text)):
        if start and text[start - 1].isalnum():
            continue
        for end in range(start + 1, len(text) + 1):
            entry, whole = text[start:end], end == len(text) or not text[end].isalnum()
            weight = max(lexicon.words.get(entry, 0) if whole else 0, lexicon.stems.get(entry, 0))
            if weight > found.get(start, (0, 0, 0, 0))[3]:
                found[start] = (start, end, entry, weight)
    places = [m.span() for e in lexicon.exceptions for m in re.finditer(rf"(?<![^\W_]){re.escape(e)}(?![^\W_])", text)]
    return [h for _, h in sorted(found.items()) if not any(a <= h[0] and h[1] <= b for a, b in places)]


def test_hits_equal_a_plain_scan():
    rnd = random.Random(5)
    parts = ["ab", "abc", "abcd", "b", "ba", "bab", "c"]
    for _ in range(60):
        words = {rnd.choice(parts): rnd.randint(1, 9) for _ in range(3)}
        stems = {rnd.choice(parts): rnd.randint(1, 9) + 0.5 for _ in range(2)}
        lexicon = toxicity.Lexicon(words, stems, [f"{rnd.choice(parts)} {rnd.choice(parts)}" for _ in range(2)])
        line = "".join(rnd.choice(parts) + rnd.choice([" ", " ", "", ", ", "_"]) for _ in range(30))
        assert lexicon.hits(lexicon.automaton(), line) == _plain_hits(lexicon, line)


def test_neighbours_of_any_length():
    long = "x" * 500
    line = f"{long} scum {long}y, scum"
    assert toxicity.with_neighbours(line, 501, 505) == {f"{long} scum", f"scum {long}y"}
    assert toxicity.with_neighbours(line, len(line) - 4, len(line)) == set()          # a comma before it
    assert toxicity.with_neighbours("scum", 0, 4) == toxicity.with_neighbours(" scum ", 1, 5) == set()


def test_scores_without_texts_are_the_same(spark):
    lexicon, docs = toxicity.Lexicon({"scum": 5.0}), documents(spark, awkward() + [(77, "scum " * 9)])
    beta = np.array([-2.0, 1.0, 0.5, 0.5])
    whole, bare = (toxicity.score(docs, lexicon, beta, keep_text=k) for k in (True, False))
    assert "text" in whole.schema["doc"].dataType.names and "text" not in bare.schema["doc"].dataType.names
    assert sorted(map(str, whole.select("doc.doc_id", "score").collect())) == sorted(map(str, bare.select("doc.doc_id", "score").collect()))


def test_learning_from_tasks_without_entries(spark):
    """Tasks whose texts hold nothing that is counted give nothing, and learning goes on."""
    rows = [("grobnik " + text(k, 5) if k < 6 else text(500 + k, 3) if k % 2 else None, int(k < 6)) for k in range(60)]
    lexicon, _ = toxicity.learn(spark.createDataFrame(rows, "text string, toxic int").repartition(20))
    assert "grobnik" in lexicon.words


def test_toxicity_without_labels(spark):
    docs = documents(spark, awkward())
    none = spark.createDataFrame([], LABELS)
    assert {(r.score, r.predicted) for r in toxicity.toxicity(docs, none).collect()} == {(0.0, 0)}
    assert toxicity.toxicity(spark.createDataFrame([], DOCS), none).collect() == []


ARTICLE = "<h1>A &amp; B</h1><p>First paragraph, with commas, and enough words to be taken for prose.<p>Second&#32;one <b>bold</b>ly\n said.<ul><li>point</ul>"
TEXT = "A & B First paragraph, with commas, and enough words to be taken for prose. Second one boldly said. point"


@pytest.mark.parametrize("page", [
    "<html><body><nav><a href=/>Home</a></nav><article>{}</article><footer>foot, note, and more, much more of it</footer>",
    "<body><div id=top class='site-header'><h2>Site</h2></div><div class=page><div class='main content'>{}<div class='ad-slot'>Buy, buy, buy it now, really, do.</div></div><aside><p>Aside, with, many, commas, in it, for sure.</p></aside></div>",
    "<main><form><input value=x><p>Sign up, now, please, to get, our, letters.</p></form>{}<script>var a='<p>no</p>';</script><style>p{{}}</style></main><section class=comments><p>I, too, have, words, to say, here, now.</p></section>",
    "<div class=cookie-notice><p>We, use, cookies, and, so on, and so, forth.</p></div><section>{}</section><div role=complementary><p>Read, this, too, or, that, one, as well.</p></div>",
])
def test_extraction(page):
    assert html_text.main_text(page.format(ARTICLE)) == TEXT


PROSE = "Words, of an article, that go on, and on, long enough to count as prose."


@pytest.mark.parametrize("part, kept", [
    ('<h2 id="legal-status">Legal status</h2>', "Legal status"),
    ('<h2 id="search"><a href="#search">Search</a></h2>', "Search"),
    ('<h2><span id="Legal_status">Legal status</span></h2>', "Legal status"),
    ('<section id="search-basics"><h2>Basics</h2><p>Short.</p></section>', "Basics Short."),
    (f'<section id="related-work"><p>{PROSE}</p></section>', PROSE),
    ('<div id="social-history"><p>Yes.</p></div>', "Yes."),
    ('<p id="notice-period">One month.</p>', "One month."),
    (f'<section id="comments-on-method">{PROSE}</section>', PROSE),
    (f'<section id="recommendations"><p>{PROSE}</p></section>', PROSE),
    (f'<section id="header-files"><p>{PROSE}</p></section>', PROSE),
    (f'<div class="ad-slot"><p>{PROSE}</p></div>', ""),
    (f'<div class="cookie-notice"><p>{PROSE}</p></div>', ""),
    (f'<div id="comments"><p>{PROSE}</p></div>', ""),
    (f'<div id="share"><p>{PROSE}</p></div>', ""),
    (f'<section class="legal"><h2>Legal status</h2><p>{PROSE}</p></section>', f"Legal status {PROSE}"),
    ('<h3 class="status">Status</h3>', "Status"),
    (f'<div class="map"><p>{PROSE} {PROSE} {PROSE}</p></div>', " ".join([PROSE] * 3)),
    ('<div class="legal"><p>All rights reserved, as ever.</p></div>', ""),
    ('<div class="social"><h4>Share</h4><a href="/x">With your friends, now, please</a></div>', ""),
    (f'<div class="search-form"><h4>Search</h4><p>{PROSE}</p></div>', ""),
    (f'<div class="notice"><p>{PROSE}</p></div>', ""),
    ('<div id="social-web"><a href="/x">Follow us now, please, and at any time.</a></div>', ""),
    ('<div id="related-pages">Two of them</div>', ""),
    ('<p>So <math><mi>x</mi><mspace/><mo>=</mo><mn>2</mn><annotation encoding="application/x-tex">x = 2</annotation></math> holds.</p>', "So x=2 holds."),
    ("<xmp><b>raw</b> &amp; more</xmp>", "<b>raw</b> &amp; more"),
])
def test_names_made_from_headings_stay(part, kept):
    page = f"<body><article><h1>Title</h1><p>{PROSE}</p>{part}<p>{PROSE}</p></article></body>"
    assert html_text.main_text(page) == " ".join(["Title", PROSE, *filter(None, [kept]), PROSE])


def test_extraction_of_odd_pages(spark):
    pages = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<p>", "x"), (4, "u", "<nav>a</nav><footer>b</footer>", "x"), (4, "u", "<nav>a</nav><footer>b</footer>", "x"), (5, "u", "bare &lt;text&gt; here", "x"),
             (6, "u", "<div>" * 3000 + "<p>" + "deep words, " * 20, "x"), (7, "u", "<p>" + text(3, 40_000) + "</p>", "x"), (8, "u", "<a title='unclosed>x<p>broken, but, readable, all, the same, is it not", "x"), (9, "u", "<!-- open <p>x", "x"), (10, "u", "<script>no end <p>x", "x")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, text string")
    got = {(r.page_id, r.text) for r in html_text.extract(frame).collect()}
    assert {(1, ""), (2, ""), (None, ""), (4, ""), (5, "bare <text> here"), (6, " ".join(["deep words,"] * 20)), (7, text(3, 40_000)), (9, ""), (10, "")} <= got
    assert html_text.extract(frame).count() == len(pages) and html_text.extract(frame.limit(0)).collect() == []
    assert all(r.n_chars == len(r.text) for r in html_text.extract(frame).collect())


def test_pipeline_stages_against_brute_force(spark, scratch):
    rows, labels = toxic_rows(200)
    passage = text(50, 60)
    rows += [(1000, passage), (1001, text(2, 30) + " " + passage + " " + text(3, 30)), (1002, text(4, 3000) + " " + passage), (1003, text(5, 100) + " token=abcdef0123456789abcdef " + text(6, 50)),
             (1004, rows[1][1]), (1005, rows[2][1] + " "), (None, text(9, 80)), (None, None), (1006, "")]
    for name, frame in (("documents", documents(spark, rows)), ("labels", spark.createDataFrame(labels, LABELS)), ("benchmark", spark.createDataFrame([(1, passage)], "item_id long, text string"))):
        frame.write.parquet(f"{scratch}/{name}.parquet")
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, scratch).write.parquet(f"{scratch}/stage{k}")
        after = spark.read.parquet(f"{scratch}/stage{k}")
        if name != "packing":
            assert after.columns == docs.columns
        kept[name], docs = [r.asDict() for r in after.collect()], after
    ids = {name: Counter(r["doc_id"] for r in found) for name, found in kept.items()}
    assert not {k for k in range(0, 200, 5)} & set(ids["toxicity"]) and {1000, 1001, 1002, 1003, 1004, 1005, None} <= set(ids["toxicity"])
    roots = brute_components([fingerprint(r["text"]) for r in kept["toxicity"]])
    assert sorted(roots[fingerprint(r["text"])] for r in kept["near_duplicates"]) == sorted(set(roots.values()))
    assert 1004 not in ids["near_duplicates"] and 1005 not in ids["near_duplicates"] and 1 in ids["near_duplicates"]
    clean = Counter({k[0]: n for k, n in brute([(r["doc_id"], r["text"]) for r in kept["near_duplicates"]], [(1, passage)]).items() if not k[4]})
    assert {i for i in ids["decontamination"]} == set(clean) and 1000 not in ids["decontamination"] and 1002 in ids["decontamination"]
    assert ids["secrets"] == ids["decontamination"]
    assert "<SECRET>" in next(r["text"] for r in kept["secrets"] if r["doc_id"] == 1003)
    assert {r["doc_id"] for r in kept["packing"]} == set(ids["secrets"])
    assert corpus_pipeline.run(spark, scratch).count() == len(kept["packing"])


def test_pipeline_on_empty_tables(spark, scratch):
    for name, schema in (("documents", DOCS), ("labels", LABELS), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{scratch}/{name}.parquet")
    assert corpus_pipeline.run(spark, scratch).collect() == []

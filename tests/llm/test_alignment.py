import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_cases import DOCS, awkward, documents, text

from clickpath.llm.alignment import _checked, align, byte_characters, shared_cuts

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [(30, "x▁ y"), (31, "▁"), (32, "  two  spaces "), (33, "<s> </s> <|endoftext|> <0x41>"), (34, "a\x00b퟿   ​"), (35, "ﬁ Ａ é é 日本語 😀😀"), (36, " "), (37, "a" * 300)]


def brute(rows):
    """Whole texts through both libraries, and every pair of tokens compared by end."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    one, other, of = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B), byte_characters()
    one.encode_special_tokens = True
    found, pairs = [], Counter()
    for doc, said in rows:
        links, written, n = [], "", (0, 0)
        if said:
            want = (" " + said).encode()
            a = one.encode(" " + said, add_special_tokens=False).ids
            b = other.encode(said)
            a_bytes = [bytes(of[c] for c in one.id_to_token(k)) for k in a]
            b_bytes = [bytes([int(other.id_to_piece(k)[3:5], 16)]) if other.is_byte(k) else other.id_to_piece(k).replace("▁", " ").encode() for k in b]
            if b"".join(a_bytes) == want == b"".join(b_bytes):
                a_end, b_end = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
                at = {e: k for k, e in enumerate(b_end)}
                links = [(a[k], b[at[e]]) for k, e in enumerate(a_end) if e in at]
                cuts, groups, i, j = sorted(set(a_end) & set(b_end)), [], 0, 0
                for c in cuts:
                    i2, j2 = a_end.index(c) + 1, b_end.index(c) + 1
                    groups.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2])))
                    i, j = i2, j2
                written, n = ";".join(groups), (len(a), len(b))
        pairs.update(links)
        found.append((doc, n, links, written))
    top = defaultdict(int)
    for (_, b), n in pairs.items():
        top[b] = max(top[b], n)
    return Counter((doc, *n, len(links), len(links), sum(pairs[x] == top[x[1]] for x in links), sum(pairs[x] for x in links),
                    hashlib.sha256(written.encode()).hexdigest() if written else "", written) for doc, n, links, written in found)


def rows():
    rng = random.Random(2)
    made = [(100 + k, "".join(rng.choice(["the", " of", "ing", " ", "\n", "é", "日", ".", "x", "▁", " un", "12"]) for _ in range(rng.randint(0, 60)))) for k in range(150)]
    return [(i, t if t is None else t[:40_000]) for i, t in awkward()] + ODD + made + made[:20]


@pytest.mark.parametrize("block_links", [1 << 20, 300])
def test_groups_and_counts_against_brute_force(spark, block_links):
    found = align(documents(spark, rows()), A, B, with_groups=True, block_links=block_links)
    got = Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256, r.groups) for r in found.collect())
    assert got == brute(rows())


def test_empty_table_and_no_tokens(spark):
    assert align(spark.createDataFrame([], DOCS), A, B).collect() == []
    got = align(documents(spark, [(1, None), (2, ""), (3, "▁")]), A, B).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [(k, 0, 0, 0, "", 0, 0, 0) for k in (1, 2, 3)]


def test_shared_cuts_of_any_ends():
    """The halving finds every common end, and no other."""
    rng = np.random.default_rng(4)
    for density in (0.02, 0.3, 0.9):
        a, b, a_off, b_off, base = [], [], [0], [0], 0
        for _ in range(60):
            size = int(rng.integers(1, 200))
            one, other = ({*np.flatnonzero(rng.random(size) < d).tolist(), size - 1} for d in (density, min(0.95, density * 2)))
            a += [base + x + 1 for x in sorted(one)]
            b += [base + x + 1 for x in sorted(other)]
            base += size
            a_off.append(len(a))
            b_off.append(len(b))
        to_a, to_b = shared_cuts(*map(np.array, (a, b, a_off, b_off)))
        common = sorted(set(a) & set(b))
        assert [a[k - 1] for k in to_a] == common == [b[k - 1] for k in to_b]
    none = shared_cuts(np.zeros(0, int), np.zeros(0, int), np.array([0, 0]), np.array([0, 0]))
    assert len(none[0]) == len(none[1]) == 0


def test_empty_entries_are_refused_and_long_text(spark):
    with pytest.raises(ValueError):
        _checked([b"a", b""])
    long = text(3, 60_000)
    got = align(documents(spark, [(1, long)]), A, B).first()
    assert got.n_links == got.n_groups > 50_000

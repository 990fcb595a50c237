import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import DOCS, awkward, documents, text
from tokenizers import Tokenizer

from clickpath.llm import mixing_coder, packing, token_counts, token_files, tokens
from clickpath.llm.tokens import encoder

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = ["a.b", "x,'s y.'t z''", "foo...bar,,baz", "<a>=≠ ≠", "é, é. ü!", "x.́y z.\x01,", " a", "a ", "  a  b  ", "x\n\ny", "x \n y", "\x01 hi \x01", "don't they're 'S",
       "a b c", "<|endoftext|> x <|endoftext|>", "?start !x\n?y", "..\n..\n\n. .", "日本 語 。", "\t\ta\tb", "a\r\nb", "\n", "İstanbul ΣΑΣ", "x\n y", " ́a"]


def plain_ids(path, t):
    return Tokenizer.from_file(path).encode(t or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_pieces_encode_like_whole_texts(path):
    texts = [t for _, t in awkward()] + ODD
    ids, off = encoder(path).encode(pa.array(texts, pa.string()), 1)
    tokenizer = Tokenizer.from_file(path)
    for k, t in enumerate(texts):
        assert ids[off[k]:off[k + 1]].tolist() == [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], t


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abC .,'!\n\t é́日1_<|>\x01")), max_size=40))
def test_pieces_encode_like_any_text(t):
    for path in (WORD, BYTE):
        enc = encoder(path)
        assert enc.encode(pa.array([t, t]), None)[0].tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids * 2


def test_new_words_need_no_normalizer(monkeypatch):
    # Normalizer and patterns were most of the library's time; words of lower-case letters go to the model alone.
    enc, seen = tokens.PieceEncoder(WORD), []
    ids_of = enc._ids
    monkeypatch.setattr(enc, "_ids", lambda texts: seen.extend(texts) or ids_of(texts))
    texts = [text(1, 300), "Über straße naïve\nÉté çà d'été it's " + text(2, 300), "A capital Begins. \nNext <|ENDOFTEXT|> <|endoftext|> H\u0331 \u0130x", None]
    ids, off = enc.encode(pa.array(texts, pa.string()), None)
    for k, t in enumerate(texts):
        assert ids[off[k]:off[k + 1]].tolist() == plain_ids(WORD, t), t
    assert sum(map(len, seen)) < 400


def test_pieces_with_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(tokens, "_hashes", lambda pieces: np.full(len(pieces), 7, np.uint64))
    for path in (WORD, BYTE):
        enc, t = tokens.PieceEncoder(path), text(3, 60) + " Some. words, more"
        for _ in range(2):
            assert enc.encode(pa.array([t, t]), None)[0].tolist() == plain_ids(path, t) * 2


def test_pieces_are_forgotten_and_encoded_again(monkeypatch):
    monkeypatch.setattr(tokens, "MEMORY_PIECES", 50)
    enc = tokens.PieceEncoder(WORD)
    for k in range(6):
        t = text(k % 3, 40)
        assert enc.encode(pa.array([t]), None)[0].tolist() == plain_ids(WORD, t)
    assert len(enc.known) < 150


def test_packing_places_every_id_once(spark):
    rows = awkward() + [(100 + k, text(k, 5 * k)) for k in range(60)]
    got = packing.pack_documents(documents(spark, rows), BYTE, 256).collect()
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for placed in by_sequence.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 256
    total = 0
    for i, t in rows:
        ids = np.array([*plain_ids(BYTE, t), 1], "<u4")
        total += len(ids)
        if sum(x == i for x, _ in rows) == 1:
            at = 0
            for r in sorted(by_doc[i], key=lambda r: r.start):
                assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at:at + r.length].tobytes()))
                at += r.length
            assert at == len(ids)
    assert sum(r.length for r in got) == total
    assert total >= 0.97 * 256 * (len(by_sequence) - 1)
    assert packing.pack_documents(spark.createDataFrame([], DOCS), BYTE).collect() == []


def test_windows_are_the_fullest_possible():
    random = np.random.default_rng(3)
    for _ in range(30):
        lengths = random.integers(1, 30, 7)
        counts = Counter(lengths.tolist())
        first = int(lengths.max())
        rest = list((counts - Counter([first])).elements())
        best = max(s for s in (sum(x for k, x in enumerate(rest) if m >> k & 1) for m in range(1 << len(rest))) if s <= 40 - first)
        used = packing.fullest(counts, first, 40 - first)
        assert sum(x * c for x, c in used.items()) == first + best
        assert all(c <= counts[x] for x, c in used.items())
        plan = packing.plan_windows(counts, 40)
        placed = Counter()
        for window, times in plan:
            assert sum(x * c for x, c in window.items()) <= 40
            for x, c in window.items():
                placed[x] += c * times
        assert placed == counts


def test_packed_ids_are_real(spark):
    rows = [(k, text(k, 40)) for k in range(20)]
    for r in packing.pack_documents(documents(spark, rows), BYTE, 64, with_ids=True).collect():
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 5), st.integers(0, 65535)), min_size=1, max_size=80), min_size=1, max_size=5))
def test_coder_round_trip(blocks):
    blocks = [np.array(b, np.uint32) for b in blocks]
    back = mixing_coder.decode_blocks(mixing_coder.encode_blocks(blocks))
    assert [b.tolist() for b in back] == [b.tolist() for b in blocks]


def test_coder_round_trip_past_all_adaptions():
    # Longer than order 0 looks back, beside blocks that end inside and right at its stretches.
    rng = np.random.default_rng(7)
    sizes = (20_001, 4096, 3072, 33, 32, 1)
    blocks = [rng.zipf(1.3, n).clip(max=65535).astype(np.uint32) for n in sizes] + [rng.integers(0, 1 << 16, 9000).astype(np.uint32)]
    coded = mixing_coder.encode_blocks(blocks)
    assert [b.tolist() for b in mixing_coder.decode_blocks(coded)] == [b.tolist() for b in blocks]
    for payload, block in zip(coded, blocks, strict=True):      # each is a stream of its own
        assert mixing_coder.decode_blocks([payload])[0].tolist() == block.tolist()


def test_coder_saves_space_and_detects_damage():
    same = np.tile(np.arange(40, dtype=np.uint32) * 1000, 100)
    skewed = np.random.default_rng(1).zipf(1.4, 4096).clip(max=60000).astype(np.uint32)
    coded = mixing_coder.encode_blocks([same, skewed])
    assert len(coded[0]) < len(same) * 2 / 20 and len(coded[1]) < len(skewed) * 2 * 0.7
    damaged = bytearray(coded[1])
    damaged[40] ^= 1
    for broken in (bytes(damaged), coded[1][:-2], b"xx" + coded[1][2:]):
        with pytest.raises(ValueError):
            mixing_coder.decode_blocks([broken])
    with pytest.raises(ValueError):
        mixing_coder.encode_blocks([np.array([1 << 16], np.uint32)])


def test_coder_sends_new_ids_as_a_table():
    # Ids that a block has once cost 16 plain bits and an escape each; in a table of the block they cost their gaps.
    rng = np.random.default_rng(11)
    block = np.concatenate([rng.permutation(4000)[:1500], rng.integers(0, 4000, 500)]).astype(np.uint32)
    coded = mixing_coder.encode_blocks([block, np.zeros(5, np.uint32), np.full(70_000, 9, np.uint32), rng.permutation(1 << 16).astype(np.uint32)])
    assert len(coded[0]) < 4000
    assert mixing_coder.decode_blocks(coded)[0].tolist() == block.tolist()
    assert mixing_coder.decode_blocks(coded)[3].tolist() == mixing_coder.decode_blocks([coded[3]])[0].tolist()
    for at in range(len(coded[0]) - 800, len(coded[0]), 50):          # within the table
        damaged = bytearray(coded[0])
        damaged[at] ^= 16
        with pytest.raises(ValueError):
            mixing_coder.decode_blocks([bytes(damaged)])


def test_blocks_are_joined_to_whole_batches():
    batches = [pa.record_batch({"block": list(range(a, b))}) for a, b in ((0, 0), (0, 700), (700, 1400), (1400, 4000), (4000, 4001))]
    got = list(token_files._lane_batches(iter(batches)))
    assert [len(x) for x in got] == [mixing_coder.LANES] * (4001 // mixing_coder.LANES) + [4001 % mixing_coder.LANES]
    assert [x for b in got for x in b.column("block").to_pylist()] == list(range(4001))


def test_crc_carried_over_pieces():
    data = bytes(range(256)) * 9
    for cuts in ([0, 10, 500], [0, 1, 2303], [0, 4, 8, 2300]):
        ends = [*cuts[1:], len(data)]
        shares = token_files.crc_carried(np.array([zlib.crc32(data[a:b]) for a, b in zip(cuts, ends)]), np.array([len(data) - b for b in ends]))
        assert np.bitwise_xor.reduce(shares) == zlib.crc32(data)


def test_token_files_read_back(spark):
    rows = awkward() + [(100 + k, text(k, 5 * k)) for k in range(40)]
    got = token_files.write_and_read(documents(spark, rows), WORD).collect()
    assert len(got) == len(rows)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    want, at = Counter(), 0
    for i, t in ordered:
        ids = [*plain_ids(WORD, t), 1]
        want[(i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
        at += len(ids)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    place = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == place
        place += r.n_tokens
    assert place == at
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [i for i, _ in ordered]
    assert token_files.write_and_read(spark.createDataFrame([], DOCS), WORD).collect() == []


@pytest.mark.parametrize(("block", "chunk"), [(65536, 1024), (7, 3)])
def test_separator_scan(spark, block, chunk, monkeypatch):
    monkeypatch.setattr(token_counts.stitch, "__defaults__", (chunk,))
    rows = [r for r in awkward() if r[0] != 7] + [(30, "<|endoftext|> spelled <|endoftext|>")]
    got = token_counts.count_documents(documents(spark, rows).repartition(3), BYTE, 50256, block).collect()
    tokenizer = Tokenizer.from_file(BYTE)
    tokenizer.encode_special_tokens = True
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter((i, len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in rows)
    for file in {r.file for r in got}:
        at = 0
        for r in sorted((r for r in got if r.file == file), key=lambda r: r.start):
            assert r.start == at
            at += r.n_tokens


def test_separator_scan_of_plain_binary_files(spark, scratch):
    ids = np.array([9, 9, 0, 0, 5, 0, 7, 7, 7], "<u2")
    ids.tofile(f"{scratch}/a.bin")
    got = token_counts.stitch(token_counts.scan_blocks(token_counts.read_binary(spark, scratch, block_ids=2), 0)).orderBy("start").collect()
    assert [(r.ordinal, r.start, r.n_tokens, r.closed) for r in got] == [(0, 0, 3, True), (1, 3, 1, True), (2, 4, 2, True), (3, 6, 3, False)]
    assert token_counts.count_documents(spark.createDataFrame([], DOCS), BYTE, 50256).collect() == []


def test_binary_files_of_any_size_and_cut_off(spark, scratch):
    import os

    os.makedirs(scratch + "/flat")
    rng = np.random.default_rng(6)
    ids = {name: rng.integers(0, 9, n).astype("<u2") for name, n in (("a.bin", 1000), ("b.bin", 7), ("c.bin", 0), ("d.bin", 64))}
    for name, x in ids.items():
        with open(f"{scratch}/flat/{name}", "wb") as f:
            f.write(x.tobytes() + (b"\x05" if name == "b.bin" else b""))          # b ends within an id
    blocks = token_counts.read_binary(spark, scratch + "/flat", block_ids=16, run_blocks=3)
    got = {}
    for r in sorted(blocks.collect(), key=lambda r: (r.file, r.block)):
        got.setdefault(os.path.basename(r.file), []).append(bytes(r.data))
    assert {k: b"".join(v) for k, v in got.items()} == {k: x.tobytes() for k, x in ids.items() if len(x)}
    assert len(got["a.bin"]) == 63
    counted = token_counts.stitch(token_counts.scan_blocks(blocks, 8)).filter("closed").groupBy("file").count().collect()
    assert {os.path.basename(r.file): r["count"] for r in counted} == {k: int((x == 8).sum()) for k, x in ids.items() if (x == 8).any()}


def test_equal_and_missing_doc_ids_span_files_and_start_alike(spark, scratch):
    rows = [(None, text(k, 40)) for k in range(120)] + [(7, text(k, 40)) for k in range(120, 240)] + [(7, text(1, 5))] * 3
    starts = []
    for k, given in enumerate((rows, rows[::-1])):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")        # so few rows would share a task
        try:
            token_files.write_files(documents(spark, given), WORD, f"{scratch}/{k}")
        finally:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        read = token_files.read_documents(spark, f"{scratch}/{k}").collect()
        assert len(read) == len(rows)
        starts.append(sorted((r.start, r.n_tokens, r.ids_crc32) for r in read))
        assert token_files.read_pieces(spark, f"{scratch}/{k}").filter("doc_id is null").select("file").distinct().count() > 1
    assert starts[0] == starts[1]


def test_token_files_longer_than_one_coded_stretch(spark, scratch):
    # A file of many times LANES * block_ids ids: documents lie across the ends of its coded stretches.
    rows = [(k, text(k, 3 + k % 60)) for k in range(600)]
    token_files.write_files(documents(spark, rows), WORD, scratch + "/files", block_ids=2)
    want, at = [], 0
    for i, t in rows:
        ids = np.array([*plain_ids(WORD, t), 1], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert at > 10 * 2 * mixing_coder.LANES
    assert [tuple(r) for r in token_files.read_documents(spark, scratch + "/files").orderBy("start").collect()] == want

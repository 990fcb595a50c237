"""Token ids of whole texts with the ``tokenizers`` library.

The library spends its time on pre-tokens, and a corpus repeats them.  Texts are cut before
a white-space character that stands between non-space characters, and between an ASCII
letter and a punctuation mark (not an apostrophe, nor a character of a special token): no pre-token of the supported tokenizers
reaches over such a place, so the ids of a text are the ids of its pieces, one after the
other.  Each distinct piece is encoded once per worker; everything else
is array work.

Most new pieces are words of lower-case letters.  Where a tokenizer reads such a word as one
pre-token, with no change by its normalizer, and marks the id that ends it, many words go to its
model at once, without the normalizer and the patterns.
"""

from __future__ import annotations

import re
from itertools import chain
from string import ascii_lowercase, ascii_uppercase
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from clickpath.llm.common import byte_table, flat_bytes

if TYPE_CHECKING:
    from tokenizers import Tokenizer

END_ID = 1
#: Distinct pieces that a worker remembers before it starts anew (memory, never results).
MEMORY_PIECES = 1_000_000
_JOINED = 256           # pieces handed to the library as one text
_MARK = "\x01"
#: What a byte is, as bits; a point is the letter's bit moved up, as a cut looks at both.
_LETTER, _PRINTED, _SEEN, _POINT, _SPACE, _BREAK = 1, 2, 4, 8, 16, 32
_KINDS = [(_LETTER, r"[A-Za-z]"), (_PRINTED, r"[!-~]"), (_SEEN, r"[!-~\xC3]"), (_POINT, r"[!-/:-@\[-`{-~]"), (_SPACE, r"\x20"), (_BREAK, r"\n")]
#: Letters that are their own lower case and NFC form in any order.
_LOWER = "a-z\u00df-\u00f6\u00f8-\u00ff"
_WORD, _ASCII_WORD = f"^ ?[{_LOWER}]+$", "^ ?[a-z]+$"
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ENCODERS: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(path: str, plain_specials: bool = False) -> PieceEncoder:
    """The encoder of a vocabulary file, kept by the worker between tasks."""
    key = (path, plain_specials)
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(path, plain_specials)
    return _ENCODERS[key]


class PieceEncoder:
    """Encodes columns of texts; ``plain_specials`` reads special tokens as ordinary text."""

    def __init__(self, path: str, plain_specials: bool = False):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        # Tokenizers that drop white space read "a\\n" like "a"; byte-level ones keep it.
        self.drops_space = not self._ids([" "])[0]
        mark = self._ids([f" {_MARK}"])[0]
        self.mark = mark[0] if len(mark) == 1 else None
        special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        kinds = sum(bit * byte_table(keep).astype(np.uint8) for bit, keep in _KINDS)
        kinds[list(("'" + "".join(special)).encode())] &= 0xFF ^ _POINT
        self.kinds = kinds.tobytes()
        # A capital after white space may be lowered where that changes no id and makes no special token.
        self.lowers = self.drops_space and not any(x[:1].isalpha() for x in special) and all(a == b for a, b in zip(*(self._ids(list(x)) for x in (ascii_uppercase, ascii_lowercase)), strict=True))
        self.words = self._word_tokenizers()
        self._forget()

    def _word_tokenizers(self) -> tuple[Tokenizer, Tokenizer] | None:
        """The tokenizer's model behind a cut at spaces alone, if that reads words like the whole does: for words of ASCII letters, and for others."""
        from tokenizers import Tokenizer, pre_tokenizers

        whole, suffix = self.tokenizer, getattr(self.tokenizer.model, "end_of_word_suffix", None)
        if not (self.drops_space and suffix and whole.normalizer and whole.pre_tokenizer):
            return None
        plain, words, split = Tokenizer(whole.model), Tokenizer(whole.model), pre_tokenizers.CharDelimiterSplit(" ")
        plain.pre_tokenizer, words.pre_tokenizer = split, pre_tokenizers.Sequence([split, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        letters = [chr(c) for c in range(0x61, 0x100) if re.match(f"[{_LOWER}]", chr(c))]
        for word in ("".join(letters), "".join(letters[::-1]), *(2 * x for x in letters)):
            got = whole.pre_tokenizer.pre_tokenize_str(whole.normalizer.normalize_str(word))
            if [x for x, _ in got] != [x for x, _ in words.pre_tokenizer.pre_tokenize_str(word)] or len(got) != 1 or (word.isascii() and got[0][0] != word):
                return None
        self.ends = np.zeros(whole.get_vocab_size(), bool)
        self.ends[[k for x, k in whole.get_vocab(with_added_tokens=False).items() if x.endswith(suffix)]] = True
        return plain, words

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _forget(self) -> None:
        self.known = pa.array([], pa.string())
        self.hashes = np.zeros(0, np.uint64)
        self.table = np.full(1 << 12, -1, np.int32)      # places of known pieces by hash, probed one by one
        self.lengths = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint16)

    def _look_up(self, hashes: np.ndarray, pieces: pa.Array) -> np.ndarray:
        """Places of the pieces among the known ones; -1 for a new one."""
        found, mask = np.full(len(hashes), -1, np.int64), len(self.table) - 1
        left, slots = np.arange(len(hashes)), (hashes & np.uint64(mask)).astype(np.int64)
        while len(left):
            at = self.table[slots[left]]
            left, at = left[at >= 0], at[at >= 0]
            same = self.hashes[at] == hashes[left]
            found[left[same]] = at[same]
            left = left[~same]
            slots[left] = slots[left] + 1 & mask
        # Equal hashes are no proof; a piece with another's hash is encoded anew every time.
        some = np.flatnonzero(found >= 0)
        equal = pc.equal(self.known.take(pa.array(found[some])), pieces.take(pa.array(some)))
        found[some[~equal.to_numpy(zero_copy_only=False)]] = -1
        return found

    def _remember(self, hashes: np.ndarray, pieces: pa.Array) -> None:
        places = np.arange(len(self.known), len(self.known) + len(pieces), dtype=np.int32)
        self.known = pa.concat_arrays([self.known, pieces])
        self.hashes = np.concatenate([self.hashes, hashes])
        if 2 * len(self.known) > len(self.table):
            self.table = np.full(1 << (4 * len(self.known)).bit_length(), -1, np.int32)
            places, hashes = np.arange(len(self.known), dtype=np.int32), self.hashes
        left, mask = np.arange(len(places)), len(self.table) - 1
        slots = (hashes & np.uint64(mask)).astype(np.int64)
        while len(left):
            free = left[self.table[slots[left]] < 0]
            self.table[slots[free]] = places[free]
            left = left[self.table[slots[left]] != places[left]]
            slots[left] = slots[left] + 1 & mask

    def _encode_words(self, tokenizer: Tokenizer, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of words of lower-case letters, one after the other, and how many each has (None: not told)."""
        texts = [" ".join(words[k:k + _JOINED]) for k in range(0, len(words), _JOINED)]
        got = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(e.ids for e in got), np.int64)
        ends = np.flatnonzero(self.ends[ids])
        return (ids, np.diff(ends, prepend=-1)) if len(ends) == len(words) else None

    def _encode_new(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, one after the other, and how many each has."""
        counts, begins, parts = np.zeros(len(pieces), np.int32), np.empty(len(pieces), np.int64), [np.zeros(0, np.int64)]
        left = np.ones(len(pieces), bool)
        for tokenizer, pattern in zip(self.words or (), (_ASCII_WORD, _WORD)):
            these = pc.match_substring_regex(pieces, pattern).to_numpy(zero_copy_only=False) & left
            got = self._encode_words(tokenizer, pc.utf8_ltrim(pieces.filter(pa.array(these)), " ").to_pylist())
            if got is not None:
                parts.append(got[0])
                counts[these], left = got[1], left & ~these
                begins[these] = sum(map(len, parts[:-1])) + np.cumsum(got[1]) - got[1]
        other, counts[left] = self._encode_pieces(pieces.filter(pa.array(left)).to_pylist())
        begins[left] = sum(map(len, parts)) + np.cumsum(counts[left]) - counts[left]
        return spread(np.concatenate([*parts, other]), begins, counts), counts

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, one after the other, and how many each has."""
        counts = np.zeros(len(pieces), np.int32)
        alone, joined = [], []
        for k, piece in enumerate(pieces):
            plain = self.mark is not None and _MARK not in piece and (self.drops_space or piece[:1] in (" ", "\n"))
            (joined if plain else alone).append(k)
        parts: list[tuple[list[int], np.ndarray]] = []
        if joined:
            groups = [joined[i:i + _JOINED] for i in range(0, len(joined), _JOINED)]
            texts = [f" {_MARK}".join(["", *(pieces[k] if pieces[k][:1] in (" ", "\n") else " " + pieces[k] for k in g), ""])
                     for g in groups]
            for g, ids in zip(groups, self._ids(texts), strict=True):
                ids = np.array(ids, np.int64)
                marks = np.flatnonzero(ids == self.mark)
                if len(marks) != len(g) + 1:
                    alone += g
                    continue
                counts[g] = np.diff(marks) - 1
                parts.append((g, np.delete(ids, marks)))
        if alone:
            got = self._ids([pieces[k] for k in alone])
            counts[alone] = [len(x) for x in got]
            parts.append((alone, np.fromiter(chain.from_iterable(got), np.int64)))
        order = np.array([k for g, _ in parts for k in g], np.int64)
        flat = np.concatenate([x for _, x in parts]) if parts else np.zeros(0, np.int64)
        # back into the order of the pieces
        given = counts[order].astype(np.int64)
        begins = np.empty(len(pieces), np.int64)
        begins[order] = np.cumsum(given) - given
        return spread(flat, begins, counts), counts

    def encode(self, column: pa.Array, end_id: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a string column and its row offsets into them (null: empty text).

        ``end_id`` is appended to every row, or nothing where it is None.
        """
        data, offsets = flat_bytes(column)
        rows = len(offsets) - 1
        if len(self.known) > MEMORY_PIECES:
            self._forget()
        cut = np.zeros(len(data) + 1, bool)
        if len(data) > 2:
            kinds = np.frombuffer(data.tobytes().translate(self.kinds), np.uint8)
            before, here, after = kinds[:-2], kinds[1:-1], kinds[2:]
            inner = (here >> 3) & before & _LETTER
            inner |= (here & _SPACE) & (after << 2)                # seen, moved to the space's bit
            inner |= (here & _BREAK) & (before << 4) & (after << 3)
            cut[1:-2] = inner
        cut[offsets] = True
        at = np.flatnonzero(cut)
        if self.drops_space and len(at) > 1:
            data = self._plainer(data, at[:-1])
        places = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)) if len(at) > 1 else pa.array([], pa.string())
        words = places.dictionary_encode()
        texts = words.dictionary
        hashes = _hashes(texts)
        index = self._look_up(hashes, texts)
        new = np.flatnonzero(index < 0)
        if len(new):
            pieces = texts.take(pa.array(new))
            flat, counts = self._encode_new(pieces)
            base = len(self.lengths)
            index[new] = base + np.arange(len(new))
            self._remember(hashes[new], pieces)
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(counts, dtype=np.int64) - counts])
            self.lengths = np.concatenate([self.lengths, counts])
            kind = np.uint16 if self.flat.dtype == np.uint16 and (not len(flat) or flat.max() < 65536) else np.uint32
            self.flat = np.concatenate([self.flat.astype(kind, copy=False), flat.astype(kind)])
        used = index[words.indices.to_numpy()]
        counts = self.lengths[used]
        ids = spread(self.flat, self.starts[used], counts).astype(np.uint32)
        total = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        ends = total[np.searchsorted(at, offsets)]
        if end_id is None:
            return ids, ends
        shifted = ends + np.arange(rows + 1)
        out = np.empty(len(ids) + rows, np.uint32)
        last = np.zeros(len(out), bool)
        last[shifted[1:] - 1] = True
        out[last] = end_id
        out[~last] = ids
        return out, shifted

    def _plainer(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The bytes with fewer spellings of pieces that begin ``at``: a space for a line break, and
        the capital behind it lowered, unless a mark may follow that joins it."""
        data = np.concatenate([data, np.zeros(2, np.uint8)])
        first = data[at]
        data[at[first == 0x0A]] = 0x20
        if self.lowers:
            at = at[(first == 0x20) | (first == 0x0A)] + 1
            letter = data[at]
            at = at[(letter >= 0x41) & (letter <= 0x5A) & (data[at + 1] < 0x80)]
            data[at] |= 0x20
        return data


def _hashes(pieces: pa.Array) -> np.ndarray:
    """64-bit hashes of pieces without nulls."""
    data, offsets = flat_bytes(pieces)
    sizes = np.diff(offsets)
    place = (np.arange(len(data)) - np.repeat(offsets[:-1], sizes)).astype(np.uint64)
    place *= _ODD
    place += data
    place ^= place >> np.uint64(29)
    place *= np.uint64(0xBF58476D1CE4E5B9)
    place ^= place >> np.uint64(32)
    place *= np.uint64(0x94D049BB133111EB)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(place, dtype=np.uint64)])
    out = total[offsets[1:]] - total[offsets[:-1]]
    out ^= out >> np.uint64(31)
    return out


def spread(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``flat[starts[0]:starts[0]+counts[0]]``, then the next range, and so on."""
    ends = np.cumsum(counts, dtype=np.int64)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    at = np.repeat(starts - (ends - counts), counts)
    at += np.arange(ends[-1])
    return flat[at]

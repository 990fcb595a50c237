"""A context-mixing range coder for token ids, many blocks at a time.

Each block of ids is a stream of its own: its model starts empty, and it carries the number
and the CRC-32 of its ids.  All blocks of a batch are coded in step, one array operation
serving the same place of every block (a *lane*).

Ids of up to 16 bits are coded in two parts:

* Order 2 and order 1 (hashes of the last two ids, and of the last) each remember the id that
  followed last and how often in a row it did.  The id that came more often in a row is
  proposed, and a yes or no is coded.  Its probability mixes what the hit rates at the
  confidence of order 2, of order 1, and the overall rate (order 0) say, in the logistic domain,
  with weights that learn from every answer.
* On a no the id is coded by order 0: how often each id of the block was not the proposed one.
  These counts are a deflated table behind the coded words.

The memories follow every id.  Rates and weights are taken anew at the places of ``_ADAPT``,
always over all ids before; between them they stand still, which makes a yes one look into a
table.  Order 0 needs no table of all ids: in the sorted list of the ids it codes, a count *is* a
place.

The coder keeps 48 bits of the interval and moves 16 bits at a time; carries run back into
what is already written.  Everything is integer arithmetic (the interval's in doubles, which hold
such integers exactly), or a double quotient that is exact when rounded down, so a file reads
back the same on any machine.
"""

from __future__ import annotations

import math
import struct
import zlib

import numpy as np

BLOCK_IDS = 4096
LANES = 1536
MAGIC = 0x4D58
_FORMAT = 4
_HEADER = struct.Struct("<HHIIII")              # magic, format, ids, crc32, 16-bit words, ids of the table behind them
_YES = 14                                       # bits of the probability of a yes
_SLOTS2, _SLOTS1 = 1024, 512
_RUNS = 8                                       # how often in a row an id came: 0 to 7 (or more)
_LEARN = 2                                      # steps of the weights at each place of _ADAPT
_TOP, _FLOOR = 1 << 48, 1 << 32
_TILE = 16
#: Places at which the mixing takes its rates anew; longer blocks go on by powers of two.
_ADAPT = (64, 256, 768, 1792)
#: Order 0 counts at most so many ids, larger counts are scaled down to it.
_MOST_COUNTED = 1 << 15
#: The table has a byte for each gap between ids and for each count; from this on 16 bits follow.
_LARGE = 255

#: Logistic tables over 12-bit probabilities and over -2047..2047 (8 fractional bits).
_SQUASH = np.array([min(4095, max(1, round(4096 / (1 + math.exp(-x / 256))))) for x in range(-2047, 2048)], np.int64)
_STRETCH = np.array([max(-2047, min(2047, round(256 * math.log((p + 0.5) / (4095.5 - p))))) for p in range(4096)], np.int64)


class _Memory:
    """Orders 1 and 2 of all lanes; starts empty.  Rows: order 2, order 1."""

    def __init__(self, lanes: int):
        lane = np.arange(lanes)
        self.after = np.zeros(lanes * (_SLOTS2 + _SLOTS1), np.uint32)        # id | how often in a row << 16
        #: A slot of all lanes lies together: frequent contexts are the same in most lanes.
        self.bases, self.width = np.stack([lane, lanes * _SLOTS2 + lane]), np.uint32(lanes)
        self.at = self.bases.copy()
        self.hashes = np.zeros((2, lanes), np.uint32)
        self.last = np.zeros(lanes, np.uint32)
        self.cells = (lane * _RUNS * _RUNS).astype(np.uint32)
        self.was, self.run, self.more = (np.empty((2, lanes), np.uint32) for _ in range(3))
        self.same = np.empty((2, lanes), bool)

    def propose(self, cells: np.ndarray) -> np.ndarray:
        """The proposed ids; sets the lanes' cells: order 2's run, order 1's run."""
        self.after.take(self.at, out=self.was, mode="clip")
        np.right_shift(self.was, 16, out=self.run)
        np.multiply(self.run[0], _RUNS, out=cells)
        cells += self.run[1]
        cells += self.cells
        return np.maximum(self.was[0], self.was[1]).astype(np.uint16)        # the longer run is the larger

    def learn(self, ids: np.ndarray) -> None:
        """What came."""
        ids = ids.astype(np.uint32)
        np.bitwise_and(self.was, 0xFFFF, out=self.run)
        np.equal(self.run, ids, out=self.same)
        np.add(self.was, 1 << 16, out=self.more)
        np.minimum(self.more, ids | np.uint32((_RUNS - 1) << 16), out=self.more)
        self.after[self.at] = np.where(self.same, self.more, ids | np.uint32(1 << 16))
        ahead = ids * np.uint32(0x9E3779B1)
        self.last += ahead
        np.right_shift(self.last, 32 - _SLOTS2.bit_length() + 1, out=self.hashes[0])
        np.right_shift(ahead, 32 - _SLOTS1.bit_length() + 1, out=self.hashes[1])
        self.hashes *= self.width
        np.add(self.hashes, self.bases, out=self.at)
        self.last = np.multiply(ids, np.uint32(0x85EBCA6B), out=ids)


class _Mixer:
    """The chance of a yes in each cell of all lanes."""

    def __init__(self, lanes: int):
        self.lanes = lanes
        self.came = np.zeros((_RUNS, _RUNS, lanes), np.int64)
        self.hit = np.zeros((_RUNS, _RUNS, lanes), np.int64)
        self.weights = np.full((3, lanes), 1 << 15, np.int64)
        self._mix(0)

    def adapt(self, cells: np.ndarray, hits: np.ndarray) -> None:
        """After a stretch, with the cells and answers of its places: take the hit rates anew, let
        the weights learn, and mix."""
        self.came += self._counted(cells.ravel())
        self.hit += self._counted(cells[hits])
        self._mix(_LEARN)

    def _counted(self, cells: np.ndarray) -> np.ndarray:
        return np.bincount(cells, minlength=self.came.size).reshape(self.lanes, -1).T.reshape(self.came.shape)

    def _mix(self, steps: int) -> None:
        x2, x1, x0 = (_STRETCH[((self.hit.sum(axis) << 12) + (1 << 11)) // (self.came.sum(axis) + 2)] for axis in (1, 0, (0, 1)))
        slower = 32 * np.maximum(self.came.sum((0, 1)), 1)
        for left in range(steps, -1, -1):
            w2, w1, w0 = self.weights
            dot = (x2 * w2)[:, None] + (x1 * w1 + x0 * w0)
            dot >>= 16
            dot += 2047                                                # beyond the table: its ends
            chance = _SQUASH.take(dot, mode="clip")
            if left:
                missed = self.hit << 12
                missed -= self.came * chance
                by2, by1 = missed.sum(1), missed.sum(0)
                self.weights += np.stack([(by2 * x2).sum(0), (by1 * x1).sum(0), by1.sum(0) * x0]) // slower
                np.clip(self.weights, -(1 << 18), 1 << 18, out=self.weights)
        #: Counts of ``1 << _YES`` that say yes.
        self.yes = (chance << (_YES - 12)).reshape(-1, self.lanes).T.astype(np.float64).ravel()


class _Counts:
    """Order 0 of all lanes: the sorted distinct ``ids`` of each, one lane after the other, and
    their counts; lane k has ``bounds[k]`` to ``bounds[k + 1]`` of them."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, bounds: np.ndarray):
        self.ids, self.sizes, self.bounds = ids, sizes, bounds
        ends = np.concatenate([[0], np.cumsum(sizes)])
        #: Places of all lanes; those of lane k begin at ``bases[k]``.
        self.bases = ends[bounds[:-1]]
        self.total = ends[bounds[1:]] - self.bases
        self.first = ends[:-1] - np.repeat(self.bases, np.diff(bounds))

    @classmethod
    def of(cls, grid: np.ndarray, counted: np.ndarray) -> _Counts:
        """Counts of the ids of the grid (a row a lane) that are ``counted``."""
        lanes, total = len(grid), np.count_nonzero(counted, axis=1)
        # Rows sort much faster than all ids with their lanes; the others go behind the counted ones.
        rows = np.sort(np.where(counted, grid, np.uint16(0xFFFF)), axis=1)
        opens = np.ones(rows.shape, bool)
        np.not_equal(rows[:, 1:], rows[:, :-1], out=opens[:, 1:])
        real = np.arange(rows.shape[1]) < total[:, None]
        edges = np.flatnonzero(opens[real])
        ids, sizes = rows[real][edges].astype(np.int64), np.diff(edges, append=total.sum())
        bounds = np.searchsorted(edges, np.concatenate([[0], np.cumsum(total)]))
        of = np.repeat(np.arange(lanes), np.diff(bounds))
        much = total[of] > _MOST_COUNTED
        if much.any():
            sizes[much] = np.maximum(1, sizes[much] * _MOST_COUNTED // total[of[much]])
        return cls(ids, sizes, bounds)

    def intervals(self, grid: np.ndarray) -> tuple[np.ndarray, int]:
        """``first | size << bits`` of the grid's counted ids (a row a lane; of others anything), and ``bits``."""
        kind, bits = (np.uint32, 16) if self.total.max(initial=0) < 1 << 16 else (np.uint64, 32)
        packed = (self.first | self.sizes << bits).astype(kind)
        table, out = np.zeros(1 << 16, kind), np.empty(grid.shape, kind)
        for k, (a, b) in enumerate(zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist(), strict=True)):
            table[self.ids[a:b]] = packed[a:b]
            table.take(grid[k], out=out[k], mode="clip")
        return out, bits

    def places(self) -> np.ndarray:
        """What stands at each place, as ``id | first << 16 | size << 36``."""
        return np.append(np.repeat(self.ids | self.first << 16 | self.sizes << 36, self.sizes), 1 << 36)

    def tables(self) -> list[bytes]:
        """The counts of each lane, written."""
        return [_written(self.ids[a:b], self.sizes[a:b]) for a, b in zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist(), strict=True)]


def _written(ids: np.ndarray, sizes: np.ndarray) -> bytes:
    gaps, more = np.diff(ids, prepend=-1) - 1, sizes - 1
    small = np.minimum(np.concatenate([gaps, more]), _LARGE).astype(np.uint8).tobytes()
    return zlib.compress(small + np.concatenate([gaps[gaps >= _LARGE], more[more >= _LARGE]]).astype("<u2").tobytes(), 1)


def _read(table: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, counts) of a written table of ``n`` ids."""
    try:
        table = zlib.decompress(table)
    except zlib.error as damage:
        raise ValueError("a block's table is damaged or cut short") from damage
    both = np.frombuffer(table, np.uint8, 2 * n).astype(np.int64)
    large, rest = (both == _LARGE).nonzero()[0], np.frombuffer(table[2 * n:], "<u2")
    if len(rest) != len(large):
        raise ValueError("a block's table is damaged or cut short")
    both[large] = rest
    both += 1
    ids, sizes = np.cumsum(both[:n]) - 1, both[n:]
    if n and (ids[-1] > 0xFFFF or sizes.sum() > _MOST_COUNTED + (1 << 16)):
        raise ValueError("a block's table is damaged")
    return ids, sizes


def _turned(rows: np.ndarray) -> np.ndarray:
    """The transpose as a copy, tile by tile: whole columns would miss the cache at every value."""
    out = np.empty(rows.shape[::-1], rows.dtype)
    for k in range(0, len(rows), _TILE):
        for m in range(0, rows.shape[1], 16 * _TILE):
            out[m:m + 16 * _TILE, k:k + _TILE] = rows[k:k + _TILE, m:m + 16 * _TILE].T
    return out


def _stretches(steps: int) -> list[tuple[int, int]]:
    """The stretches of a block between which order 0 takes its counts anew."""
    cuts = [0, *_ADAPT]
    while cuts[-1] < steps:
        cuts.append(2 * cuts[-1] if cuts[-1] & (cuts[-1] - 1) == 0 else 1 << cuts[-1].bit_length())
    cuts = [x for x in cuts if x < steps] + [steps]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


class _Writer:
    """Interval and words of all lanes.  Doubles, as they hold integers below 2 ** 53 exactly."""

    def __init__(self, lanes: int, steps: int):
        self.low, self.range = np.zeros(lanes), np.full(lanes, _TOP - 1.0)
        #: Words of all lanes; those that ``used`` says are written.
        self.words, self.used, self.moves = np.empty((steps * 5 // 4 + 64, lanes), np.uint32), np.empty((steps * 5 // 4 + 64, lanes), bool), 0

    def put(self, hit: np.ndarray, yes: np.ndarray, first: np.ndarray, size: np.ndarray, total: np.ndarray) -> None:
        """Narrow hit lanes to a yes, the others to a no and to ``size`` places of ``total``."""
        edge, place = _parts(self.range, yes, total)
        no = (~hit).astype(np.float64)
        add = place * first
        add += edge
        add *= no
        self.low += add
        place *= size
        self.range = _either(edge, place, no)
        self._move(self.range < _FLOOR)
        while self.range.min(initial=_TOP) < _FLOOR:
            self._move(self.range < _FLOOR)

    def _move(self, lanes: np.ndarray) -> None:
        # A word may have a 17th bit, the carry into the words before it.
        word = self.low * (1 / _FLOOR)
        np.floor(word, out=word)
        if self.moves == len(self.words):
            self.words, self.used = (np.concatenate([x, np.empty_like(x)]) for x in (self.words, self.used))
        self.words[self.moves], self.used[self.moves] = word, lanes
        self.moves += 1
        # Without masks, which cost more than the arithmetic.
        moved = lanes.astype(np.float64)
        word *= moved
        word *= _FLOOR
        self.low -= word
        moved *= 65535
        moved += 1
        self.low *= moved
        self.range *= moved

    def finish(self) -> list[np.ndarray]:
        """The words of each lane."""
        for _ in range(3):
            self._move(np.ones(len(self.low), bool))
        used = _turned(self.used[:self.moves])
        words = _turned(self.words[:self.moves])[used]
        over = np.flatnonzero(words >> 16)
        while len(over):
            carry = words[over] >> 16
            words[over] &= 0xFFFF
            over -= 1
            words[over] += carry
            over = over[words[over] > 0xFFFF]
        return np.split(words.astype("<u2"), np.cumsum(np.count_nonzero(used, axis=1))[:-1])


def _parts(size: np.ndarray, yes: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(size of a yes, size of one of ``total`` places of a no) in intervals of ``size``."""
    part = size * (1 / (1 << _YES))
    np.floor(part, out=part)
    edge = part * yes
    part *= 1 << _YES
    part -= edge
    # The quotient is below 2 ** 48 / total, so as a double it is off by less than 1 / total.
    part /= total
    return edge, np.floor(part, out=part)


def _either(yes: np.ndarray, no: np.ndarray, is_no: np.ndarray) -> np.ndarray:
    """``no`` where ``is_no`` is 1, ``yes`` where it is 0; without a mask, which costs more.  Overwrites ``no``."""
    no -= yes
    no *= is_no
    no += yes
    return no


class _Reader:
    def __init__(self, streams: list[np.ndarray]):
        # Words past the end of a stream read as zeros.
        words = np.zeros((len(streams), max(map(len, streams), default=0) + 8), np.uint16)
        for row, stream in zip(words, streams, strict=True):
            row[:len(stream)] = stream
        first = words[:, :3].astype(np.float64)
        self.words = words.ravel()
        self.at = np.arange(len(streams)) * words.shape[1] + 3
        self.code = (first[:, 0] * 65536 + first[:, 1]) * 65536 + first[:, 2]
        self.range = np.full(len(streams), _TOP - 1.0)

    def take(self, yes: np.ndarray, hit: np.ndarray, places: np.ndarray, bases: np.ndarray, total: np.ndarray) -> np.ndarray:
        """What stands at the place that the code of each lane says, where it is no hit; sets ``hit``; narrows like the writer."""
        edge, place = _parts(self.range, yes, total)
        np.less(self.code, edge, out=hit)
        no = (~hit).astype(np.float64)
        # Exact when rounded down, as both numbers are below 2 ** 48.
        at = self.code - edge
        at /= place
        at = at.astype(np.int64)
        at += bases
        found = places.take(at, mode="clip")
        add = (found >> 16 & 0xFFFFF).astype(np.float64)
        add *= place
        add += edge
        add *= no
        self.code -= add
        place *= (found >> 36).astype(np.float64)
        self.range = _either(edge, place, no)
        self._fill(self.range < _FLOOR)
        while self.range.min(initial=_TOP) < _FLOOR:
            self._fill(self.range < _FLOOR)
        return found

    def _fill(self, lanes: np.ndarray) -> None:
        moved = lanes.astype(np.float64)
        word = self.words.take(self.at, mode="clip").astype(np.float64)
        word *= moved
        moved *= 65535
        moved += 1
        self.range *= moved
        self.code *= moved
        self.code += word
        self.at += lanes


def _encode_lanes(grid: np.ndarray) -> list[tuple[np.ndarray, int, bytes]]:
    """The words of each lane, how many distinct ids order 0 has, and their table."""
    lanes, steps = grid.shape
    memory, columns = _Memory(lanes), _turned(grid)
    cells, hits = np.empty((steps, lanes), np.uint32), np.empty((steps, lanes), bool)
    for ids, cell, hit in zip(columns, cells, hits, strict=True):
        np.equal(memory.propose(cell), ids, out=hit)
        memory.learn(ids)
    counts = _Counts.of(grid, ~_turned(hits))
    places, bits = counts.intervals(grid)
    mixer, writer, total = _Mixer(lanes), _Writer(lanes, steps), np.maximum(counts.total, 1).astype(np.float64)
    for begin, end in _stretches(steps):
        for place, cell, hit in zip(_turned(places[:, begin:end]), cells[begin:end], hits[begin:end], strict=True):
            first = (place & place.dtype.type((1 << bits) - 1)).astype(np.float64)
            writer.put(hit, mixer.yes.take(cell, mode="clip"), first, (place >> place.dtype.type(bits)).astype(np.float64), total)
        if end < steps:
            mixer.adapt(cells[begin:end], hits[begin:end])
    return list(zip(writer.finish(), np.diff(counts.bounds).tolist(), counts.tables(), strict=True))


def _decode_lanes(streams: list[np.ndarray], tables: list[tuple[np.ndarray, np.ndarray]], steps: int) -> np.ndarray:
    lanes = len(streams)
    memory, mixer, reader = _Memory(lanes), _Mixer(lanes), _Reader(streams)
    counts = _Counts(*(np.concatenate(x) for x in zip(*tables, strict=True)), np.cumsum([0, *(len(ids) for ids, _ in tables)]))
    places, total = counts.places(), np.maximum(counts.total, 1).astype(np.float64)
    grid = np.empty((lanes, steps), np.uint16)
    for begin, end in _stretches(steps):
        out = np.empty((end - begin, lanes), np.uint16)
        cells, hits = np.empty((end - begin, lanes), np.uint32), np.empty((end - begin, lanes), bool)
        for ids, cell, hit in zip(out, cells, hits, strict=True):
            guess = memory.propose(cell)
            found = reader.take(mixer.yes.take(cell, mode="clip"), hit, places, counts.bases, total)
            ids[:] = np.where(hit, guess, found.astype(np.uint16))
            memory.learn(ids)
        grid[:, begin:end] = _turned(out)
        if end < steps:
            mixer.adapt(cells, hits)
    return grid


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Code blocks of ids below 65536 (each of at least one id); any number, any lengths."""
    out: list[bytes] = []
    for k in range(0, len(blocks), LANES):
        part = blocks[k:k + LANES]
        grid = np.empty((len(part), max(map(len, part))), np.uint16)
        for row, ids in zip(grid, part, strict=True):
            if int(ids.max()) > 0xFFFF:
                raise ValueError("the coder takes ids below 65536")
            row[:len(ids)], row[len(ids):] = ids, ids[-1]
        for ids, (words, distinct, table) in zip(part, _encode_lanes(grid), strict=True):
            out.append(_HEADER.pack(MAGIC, _FORMAT, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), len(words), distinct) + words.tobytes() + table)
    return out


def decode_blocks(payloads: list[bytes]) -> list[np.ndarray]:
    """The blocks' ids (uint32); a block that does not read back to its checksum is an error."""
    out: list[np.ndarray] = []
    for k in range(0, len(payloads), LANES):
        part = payloads[k:k + LANES]
        heads = [_HEADER.unpack_from(p) for p in part]
        behind = [_HEADER.size + 2 * h[4] for h in heads]
        if any(h[:2] != (MAGIC, _FORMAT) or at > len(p) for h, p, at in zip(heads, part, behind, strict=True)):
            raise ValueError("not a block of this format, or cut short")
        streams = [np.frombuffer(p, "<u2", h[4], _HEADER.size) for h, p in zip(heads, part, strict=True)]
        tables = [_read(p[at:], h[5]) for h, p, at in zip(heads, part, behind, strict=True)]
        with np.errstate(all="ignore"):                 # of damaged blocks, which their checksum tells
            grid = _decode_lanes(streams, tables, max(h[2] for h in heads))
        for row, (_, _, n, crc, _, _) in zip(grid, heads, strict=True):
            ids = row[:n].astype(np.uint32)
            if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
                raise ValueError("a block does not match its checksum")
            out.append(ids)
    return out

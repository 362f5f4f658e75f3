"""Token ids as bytes: context mixing in front of a range coder, for many blocks at once.

Ids are numbered in the order in which a segment first has them; a new one is an escape, number 0, and 32 bits. A number
is coded by its hexadecimal digits, the highest first, as many as the numbers so far need. Each digit is predicted by counts in three
contexts: the digits before it, with no, one or two ids before. The predictions are mixed with weights that
follow which of them did well in the block. Every id is counted before the next one is predicted, in all three contexts,
and the counts are those of all blocks of a segment: all blocks take the same step in one operation on arrays.
Everything is in whole numbers, so the reader repeats the writer's predictions exactly.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 1_024  # ids
LANES = 5_120  # blocks that are coded side by side
SLOT_BITS = 16  # contexts of an order that are kept apart, by hash
MOST = 240  # weight of a prediction that takes all
TOP, BOTTOM = np.uint64(1 << 48), np.uint64(1 << 32)
SHIFT = np.uint64(16)
ONE = np.int32(1)  # of the counts' type, without which adding is slow
HEAD = "<4sII"
MARK = b"TID3"


class Counts:
    """Counts of digits in their contexts, of all blocks, and weights of each of ``n`` blocks."""

    def __init__(self, n: int):
        self.rows = np.zeros((3, 16 << SLOT_BITS), np.int32)
        self.sums = np.zeros((3, 1 << SLOT_BITS), np.int32)
        self.weights = np.full((8, 3, n), MOST // 3, np.int32)  # by digit
        self.before = np.zeros((2, n), np.uint32)
        self.at = np.arange(n) * 16

    def begin(self, k: int, known: int) -> None:
        """The first ``k`` blocks go on, with numbers up to ``known``."""
        self.k, self.places = k, max(1, -(-known.bit_length() // 4))
        one = self.before[0, :k] * np.uint32(0x9E3779B1) + np.uint32(0x632BE5AB)
        self.contexts = np.stack([np.zeros(k, np.uint32), one, one + self.before[1, :k] * np.uint32(0xC2B2AE3D) + np.uint32(1)])

    def predict(self, place: int, so_far: np.ndarray) -> np.ndarray:
        """Shares of each digit at ``place``, a column per block."""
        keys = self.contexts + (so_far.astype(np.uint32) * np.uint32(8) + np.uint32(place)) * np.uint32(0x85EBCA6B)
        keys = (keys ^ keys >> np.uint32(15)) * np.uint32(0x2C1B3C6D)
        keys = (keys ^ keys >> np.uint32(13)) * np.uint32(0x297A2D39)
        self.slots = (keys >> np.uint32(32 - SLOT_BITS)).astype(np.int64)
        self.weight = self.weights[place, :, : self.k]
        shares = None
        self.found, self.scales = [], []
        for slots, rows, sums, weight in zip(self.slots, self.rows, self.sums, self.weight):
            # The fewer ids a context has seen, the less it says; its largest count times the scale is below 2^28.
            scale = weight * np.int32(3 << 20) // (sums.take(slots) * np.int32(3) + ONE)
            found = rows.reshape(-1, 16).take(slots, axis=0)
            self.found.append(found)
            self.scales.append(scale)
            part = found * scale[:, None]
            shares = part if shares is None else np.add(shares, part, out=shares)
        shares = np.ascontiguousarray(shares.T)
        shares >>= 12
        shares += ONE
        return shares

    def learn(self, digit: np.ndarray) -> None:
        at = self.at[: self.k] + digit
        said = np.stack([found.ravel().take(at) * scale for found, scale in zip(self.found, self.scales)])
        said >>= 12
        said += 1
        self.weight += (said * np.int32(MOST) // said.sum(axis=0, dtype=np.int32) - self.weight) >> 4
        np.maximum(self.weight, 1, out=self.weight)
        for slots, rows, sums in zip(self.slots, self.rows, self.sums):
            np.add.at(rows, slots * 16 + digit, ONE)
            np.add.at(sums, slots, ONE)

    def step(self, numbers: np.ndarray) -> None:
        self.before[1, : self.k] = self.before[0, : self.k]
        self.before[0, : self.k] = numbers


class Even:
    """Four digits of which nothing is known."""

    places = 4

    def predict(self, place: int, so_far: np.ndarray) -> np.ndarray:
        return np.ones((16, len(so_far)), np.int32)

    def learn(self, digit: np.ndarray) -> None:
        pass


class Lanes:
    """The range coder's state of every block: 64 bits, of which 16 leave at a time."""

    def __init__(self, n: int, words: np.ndarray):
        self.low, self.span = np.zeros(n, np.uint64), np.full(n, 2**64 - 1, np.uint64)
        self.words, self.used = words, np.zeros(n, np.int64)

    def narrow(self, at: np.ndarray, counts: Counts | Even, given: np.ndarray | None = None) -> np.ndarray:
        """A number of each block in ``at``, digit by digit; the writer has it ``given``, the reader finds it."""
        number, first = np.zeros(len(at), np.int64), np.arange(len(at))
        for place in reversed(range(counts.places)):
            shares = counts.predict(place, number)
            upto = shares.copy()
            for before, end in zip(upto, upto[1:]):  # faster than cumsum
                end += before
            share = self.span[at] // upto[-1].astype(np.uint64)
            digit = self.found(at, share, upto) if given is None else given >> 4 * place & 15
            place_of = digit * len(at) + first
            size, end = shares.ravel().take(place_of), upto.ravel().take(place_of)
            self.take(at, share * (end - size).astype(np.uint64), share * size.astype(np.uint64))
            counts.learn(digit)
            number = number << 4 | digit
        return number

    def take(self, at: np.ndarray, start: np.ndarray, span: np.ndarray) -> None:
        """Take the part ``span`` from ``start`` on, in the blocks ``at``, and move what is settled."""
        low = self.low[at] + start
        self.low[at], self.span[at] = low, span
        todo = np.flatnonzero(((low ^ (low + span)) < TOP) | (span < BOTTOM))
        low, span, todo = low[todo], span[todo], at[todo]
        while len(todo):
            same = (low ^ (low + span)) < TOP
            if not same.all():
                span = np.where(same, span, (~low + np.uint64(1)) & (BOTTOM - np.uint64(1)))
            self.move(todo, low)
            low, span = low << SHIFT, span << SHIFT
            self.low[todo], self.span[todo] = low, span
            self.used[todo] += 1
            again = np.flatnonzero(((low ^ (low + span)) < TOP) | (span < BOTTOM))
            todo, low, span = todo[again], low[again], span[again]


class Writer(Lanes):
    def move(self, todo: np.ndarray, low: np.ndarray) -> None:
        used = self.used[todo]
        if int(used.max()) >= self.words.shape[1] - 4:  # room for the last four
            self.words = np.concatenate([self.words, np.zeros_like(self.words)], axis=1)
        self.words.reshape(-1)[todo * self.words.shape[1] + used] = low >> np.uint64(48)

    def streams(self) -> list[bytes]:
        for _ in range(4):
            self.words[np.arange(len(self.low)), self.used] = self.low >> np.uint64(48)
            self.low <<= SHIFT
            self.used += 1
        return [row[:n].tobytes() for row, n in zip(self.words, self.used.tolist())]


class Reader(Lanes):
    def __init__(self, n: int, words: np.ndarray):
        super().__init__(n, words)
        self.code = np.zeros(n, np.uint64)
        for k in range(4):
            self.code = self.code << SHIFT | words[:, k]
        self.used += 4

    def move(self, todo: np.ndarray, low: np.ndarray) -> None:
        place = np.minimum(self.used[todo], self.words.shape[1] - 1)  # a damaged stream may ask for more
        self.code[todo] = self.code[todo] << SHIFT | self.words.reshape(-1)[todo * self.words.shape[1] + place]

    def found(self, at: np.ndarray, share: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """The digits whose parts the streams lie in."""
        value = np.minimum((self.code[at] - self.low[at]) // share, (upto[-1] - ONE).astype(np.uint64)).astype(np.int32)
        return (upto <= value).sum(axis=0, dtype=np.int8).astype(np.int64)


def running(sizes: np.ndarray, row: int) -> int:
    """How many blocks, longest first, have an id at ``row``."""
    return int(np.searchsorted(-sizes, -row, side="left"))


def encode_lanes(ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Streams of blocks, which are columns of ``ids``, longest first."""
    n = len(sizes)
    out, counts, even, lanes = Writer(n, np.zeros((n, 512), np.uint16)), Counts(n), Even(), np.arange(n)
    top, places = int(ids.max()), ids
    if top >= 1 << 20:  # a table of numbers by id would be large
        distinct, places = np.unique(ids, return_inverse=True)
        top, places = len(distinct), places.reshape(ids.shape)
    numbers, known = np.zeros(top + 1, np.int64), 0
    for t in range(int(sizes[0])):
        k = running(sizes, t)
        place = places[t, :k]
        given = numbers[place]
        counts.begin(k, known)
        out.narrow(lanes[:k], counts, given)
        new = np.flatnonzero(given == 0)
        if len(new):
            for shift in (16, 0):
                out.narrow(new, even, (ids[t, new] >> shift & 65535).astype(np.int64))
            first = np.unique(place[new])
            numbers[first] = known + 1 + np.arange(len(first))
            known += len(first)
            given = numbers[place]
        counts.step(given)
    return out.streams()


def decode_lanes(streams: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """The blocks of ``streams`` as columns, longest first."""
    words = np.zeros((len(streams), max(map(len, streams)) // 2 + 4), np.uint16)
    for row, stream in zip(words, streams):
        row[: len(stream) // 2] = np.frombuffer(stream, "<u2", len(stream) // 2)
    n, ids = len(sizes), np.zeros((int(sizes[0]), len(sizes)), np.uint32)
    read, counts, even, lanes = Reader(n, words), Counts(n), Even(), np.arange(n)
    names, known = np.zeros(1, np.uint32), 0
    for t in range(len(ids)):
        k = running(sizes, t)
        counts.begin(k, known)
        found = np.minimum(read.narrow(lanes[:k], counts), known)  # a damaged stream may have more
        ids[t, :k] = names[found]
        new = np.flatnonzero(found == 0)
        if len(new):
            high, low = (read.narrow(new, even) for _ in range(2))
            ids[t, new] = high << 16 | low
            first, place = np.unique(ids[t, new], return_inverse=True)
            found[new] = known + 1 + place
            known += len(first)
            if known >= len(names):
                names = np.concatenate([names, np.zeros(known + 1, np.uint32)])
            names[known + 1 - len(first) : known + 1] = first
        counts.step(found)
    return ids


def pack(ids: np.ndarray) -> bytes:
    """A segment: mark, number of ids and of blocks; length and crc32 of each block's stream; the streams.

    The crc32 is that of the block's ids as little-endian 32-bit numbers.
    """
    if len(ids) and not 0 <= int(ids.min()) <= int(ids.max()) < 1 << 32:
        raise ValueError("ids must be below 2^32")
    ids = ids.astype("<u4")
    blocks = -(-len(ids) // BLOCK)
    sizes = np.minimum(BLOCK, len(ids) - BLOCK * np.arange(blocks))
    whole = np.zeros(blocks * BLOCK, np.uint32)
    whole[: len(ids)] = ids
    columns = np.ascontiguousarray(whole.reshape(blocks, BLOCK).T) if blocks else whole.reshape(BLOCK, 0)
    streams = [
        s
        for i in range(0, blocks, LANES)
        for s in encode_lanes(columns[: sizes[i], i : i + LANES], sizes[i : i + LANES])
    ]
    table = np.array([[len(s), zlib.crc32(ids[i * BLOCK : (i + 1) * BLOCK])] for i, s in enumerate(streams)], "<u4")
    return struct.pack(HEAD, MARK, len(ids), blocks) + table.tobytes() + b"".join(streams)


def unpack(data: bytes) -> np.ndarray:
    """The ids of a segment; a damaged one is an error that names the first block that differs."""
    mark, count, n = struct.unpack_from(HEAD, data)
    if mark != MARK:
        raise ValueError("not a segment of token ids")
    table = np.frombuffer(data, "<u4", 2 * n, struct.calcsize(HEAD)).reshape(n, 2)
    ends = struct.calcsize(HEAD) + table.nbytes + np.cumsum(table[:, 0], dtype=np.int64)
    streams = [data[e - size : e] for e, size in zip(ends.tolist(), table[:, 0].tolist())]
    sizes = np.minimum(BLOCK, count - BLOCK * np.arange(n))
    ids = np.zeros(n * BLOCK, "<u4")
    for i in range(0, n, LANES):
        columns = decode_lanes(streams[i : i + LANES], sizes[i : i + LANES])
        ids.reshape(n, BLOCK)[i : i + LANES, : len(columns)] = columns.T
    ids = ids[:count]
    for i in range(n):
        if zlib.crc32(ids[i * BLOCK : (i + 1) * BLOCK]) != table[i, 1]:
            raise ValueError(f"block {i} is damaged")
    return ids

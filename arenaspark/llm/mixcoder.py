"""Adaptive context-mixing range coder for token ids.

A stream of ids is cut into blocks of ``BLOCK_IDS`` ids. Every block starts
from the same fixed state, so it can be decoded without its neighbours, and
carries a checksum. Model of one block:

* order 2 and order 1: a table keyed by the last two ids, and one keyed by the
  last id, each holding the id that followed last time and how often in a row it
  did (confidence 0 to 3);
* order 0: adaptive counts of what happened (order-2 hit, order-1 hit, or the
  size class of an unpredicted id), without context;
* mixing: the counts seen under the two present confidences and the order-0
  counts are added, and the sum drives the arithmetic coder. An unpredicted id
  is then placed within its size class.

Blocks are independent, so all blocks of a chunk advance together, one id of
each per step, as array operations: the coder's cost is spread over thousands
of blocks and no id is handled by interpreted code alone.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"MIXC"
BLOCK_IDS = 1024
MAX_ID = 65_534
_SLOTS = 1024  # places per block and order, as many as a block has ids
# first id of each size class, and the end of the last
_BOUNDS = np.array([0, 256, 1024, 4096, 16384, 65536], dtype=np.int64)
_SYMBOLS = len(_BOUNDS) + 1  # order-2 hit, order-1 hit, five size classes
_COLUMNS = _SYMBOLS + 1  # cumulative counts: 8 of 16 bits, moved as one 16-byte item
_INC, _INC0 = 44, 16  # added per id; a block's counts stay below 2 ** 16
_START = 4
_LIMIT = 1 << 32  # the range is kept in [2 ** 32, 2 ** 48]; 16 bits leave at a time
_LOW = _LIMIT - 1

_CLASS_OF = (np.searchsorted(_BOUNDS, np.arange(MAX_ID + 2), side="right") - 1).astype(np.int64)
_BASE, _WIDTH = _BOUNDS[:-1], np.diff(_BOUNDS)
_STEP = (np.arange(_COLUMNS)[None, :] > np.arange(_SYMBOLS)[:, None]).astype(np.uint16)


def _items(counts: np.ndarray) -> np.ndarray:
    """Rows of eight 16-bit counts as single 16-byte items, which move faster."""
    return np.ascontiguousarray(counts).view(np.complex128).reshape(-1)


def _counts(items: np.ndarray) -> np.ndarray:
    return items.view(np.uint16).reshape(-1, _COLUMNS)


_STEP_MIXED, _STEP_ORDER0 = _items(_STEP * np.uint16(_INC)), _items(_STEP * np.uint16(_INC0))


class _Model:
    """Prediction state of ``lanes`` blocks that advance together."""

    def __init__(self, lanes: int):
        self.lane = np.arange(lanes, dtype=np.int64)
        self.origin = self.lane * _SLOTS
        self.tab1 = np.zeros(lanes * _SLOTS, dtype=np.uint32)  # id + 1, confidence << 16; 0: empty
        self.tab2 = np.zeros(lanes * _SLOTS, dtype=np.uint32)
        start = np.tile((np.arange(_COLUMNS) * _START).astype(np.uint16), (lanes, 1))
        self.mixed = np.repeat(_items(start), 16)
        self.order0 = start
        self.row8, self.row16 = self.lane * _COLUMNS, self.lane * 16
        self.last = np.zeros(lanes, dtype=np.int64)
        self.before = np.zeros(lanes, dtype=np.int64)

    def predict(self) -> None:
        """Sets ``cum``, the cumulative counts of the outcomes, one row per block, and ``total``."""
        mixed = self.last * 40503
        self.s1 = self.origin + (mixed >> 5 & (_SLOTS - 1))
        self.s2 = self.origin + (mixed + self.before * 30011 >> 4 & (_SLOTS - 1))
        self.e1, self.e2 = self.tab1.take(self.s1), self.tab2.take(self.s2)
        self.p1, self.p2 = (self.e1 & 0xFFFF).astype(np.int64) - 1, (self.e2 & 0xFFFF).astype(np.int64) - 1
        self.ctx = self.row16 + ((self.e2 >> 16) * 4 + (self.e1 >> 16))
        self.row = _counts(self.mixed.take(self.ctx))
        self.cum = self.row + self.order0
        self.total = self.cum[:, -1].astype(np.int64)

    def interval(self, outcome: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cumulative count below each block's outcome, and the outcome's own count."""
        flat, at = self.cum.reshape(-1), self.row8 + outcome
        lo = flat.take(at).astype(np.int64)
        return lo, flat.take(at + 1) - lo

    def outcome(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids == self.p2, 0, np.where(ids == self.p1, 1, 2 + _CLASS_OF.take(ids)))

    def update(self, ids: np.ndarray, outcome: np.ndarray) -> None:
        self.mixed[self.ctx] = _items(self.row + _counts(_STEP_MIXED.take(outcome)))
        self.order0 += _counts(_STEP_ORDER0.take(outcome))
        fresh = (ids + 1).astype(np.uint32)
        for tab, at, entry, p in ((self.tab1, self.s1, self.e1, self.p1), (self.tab2, self.s2, self.e2, self.p2)):
            tab[at] = np.where(p == ids, entry + ((entry < 3 << 16).astype(np.uint32) << 16), fresh)
        self.before, self.last = self.last, ids


def _share(rng: np.ndarray, total: np.ndarray) -> np.ndarray:
    """A unit with unit * total <= rng; the added one makes rounding safe."""
    return (rng / (total + 1)).astype(np.int64)


def _place(code: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """floor(code / unit)."""
    q = (code / unit).astype(np.int64)
    return q - (q * unit > code)


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """One byte string per block of ``ids``; the last block is filled up with zeros, which the reader drops."""
    lanes = -(-len(ids) // BLOCK_IDS)
    if not lanes:
        return []
    if int(ids.max()) > MAX_ID:
        raise ValueError(f"ids above {MAX_ID} are not supported")
    grid = np.zeros(lanes * BLOCK_IDS, dtype=np.int64)
    grid[:len(ids)] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, BLOCK_IDS).T)
    model = _Model(lanes)
    low, rng = np.zeros(lanes, dtype=np.int64), np.full(lanes, 1 << 48, dtype=np.int64)
    words = np.zeros((2 * BLOCK_IDS + 4) * lanes, dtype=np.uint32)
    at = model.lane.copy()  # place of each block's next word in ``words``, a row of all blocks per word

    def shift(some: np.ndarray) -> None:
        part, to = low.take(some), at.take(some)
        words[to] = part >> 32
        low[some] = (part & _LOW) << 16
        rng[some] = rng.take(some) << 16
        at[some] = to + lanes

    for now in grid:
        model.predict()
        outcome = model.outcome(now)
        lo, own = model.interval(outcome)
        unit = _share(rng, model.total)
        low += unit * lo
        rng = unit * own
        shift(np.flatnonzero(rng < _LIMIT))
        some = np.flatnonzero(outcome > 1)
        kind = outcome.take(some) - 2
        unit = _share(rng.take(some), _WIDTH.take(kind))
        low[some] += unit * (now.take(some) - _BASE.take(kind))
        rng[some] = unit
        shift(some[unit < _LIMIT])
        model.update(now, outcome)
    for _ in range(3):
        shift(model.lane)
    words = words.reshape(-1, lanes)
    for k in range(len(words) - 1, 0, -1):  # carries
        words[k - 1] += words[k] >> 16
    packed = np.ascontiguousarray((words & 0xFFFF).astype("<u2").T)
    return [packed[i, :n].tobytes() for i, n in enumerate((at // lanes).tolist())]


def decode_blocks(blocks: list[bytes], n_ids: int) -> np.ndarray:
    lanes = len(blocks)
    if not lanes:
        return np.zeros(0, dtype=np.uint32)
    sizes = np.array([len(b) // 2 for b in blocks], dtype=np.int64)
    words = np.append(np.frombuffer(b"".join(blocks), dtype="<u2"), np.zeros(4, dtype=np.uint16)).astype(np.int64)
    at = np.cumsum(sizes) - sizes
    code = (words[at] << 32) | (words[at + 1] << 16) | words[at + 2]
    at += 3
    rng = np.full(lanes, 1 << 48, dtype=np.int64)
    model = _Model(lanes)
    grid = np.zeros((BLOCK_IDS, lanes), dtype=np.int64)

    def shift(some: np.ndarray) -> None:
        to = at.take(some)
        code[some] = (code.take(some) << 16) | words.take(to)
        rng[some] = rng.take(some) << 16
        at[some] = to + 1

    for k in range(BLOCK_IDS):
        model.predict()
        unit = _share(rng, model.total)
        place = np.minimum(_place(code, unit), model.total - 1).astype(np.uint16)
        below = (model.cum <= place[:, None]).view(np.uint64).reshape(-1)  # one byte per column
        outcome = np.bitwise_count(below).astype(np.int64) - 1
        lo, own = model.interval(outcome)
        code -= unit * lo
        rng = unit * own
        shift(np.flatnonzero(rng < _LIMIT))
        now = np.where(outcome == 0, model.p2, model.p1)
        some = np.flatnonzero(outcome > 1)
        kind = outcome.take(some) - 2
        width = _WIDTH.take(kind)
        unit = _share(rng.take(some), width)
        rest = code.take(some)
        offset = np.minimum(_place(rest, unit), width - 1)
        code[some] = rest - unit * offset
        rng[some] = unit
        now[some] = _BASE.take(kind) + offset
        shift(some[unit < _LIMIT])
        grid[k] = now
        model.update(now, outcome)
    return np.ascontiguousarray(grid.T).reshape(-1)[:n_ids].astype(np.uint32)


def pack_chunk(ids: np.ndarray) -> bytes:
    """Magic, ids per block, number of ids, number of blocks; per block its bytes and checksum; the blocks."""
    blocks = encode_blocks(ids)
    head = struct.pack("<4sIQI", MAGIC, BLOCK_IDS, len(ids), len(blocks))
    table = b"".join(struct.pack("<II", len(b), zlib.crc32(b)) for b in blocks)
    return head + table + b"".join(blocks)


def unpack_chunk(data: bytes) -> np.ndarray:
    """Ids of a chunk; raises ValueError when a checksum or a length does not fit."""
    magic, block_ids, n_ids, n_blocks = struct.unpack_from("<4sIQI", data)
    if magic != MAGIC or block_ids != BLOCK_IDS or n_blocks != -(-n_ids // BLOCK_IDS):
        raise ValueError("not a chunk of this format")
    at, blocks = 20 + 8 * n_blocks, []
    for i in range(n_blocks):
        size, crc = struct.unpack_from("<II", data, 20 + 8 * i)
        block = data[at:at + size]
        if len(block) != size or zlib.crc32(block) != crc:
            raise ValueError(f"block {i} is damaged")
        blocks.append(block)
        at += size
    return decode_blocks(blocks, n_ids)

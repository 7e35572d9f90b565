"""Adaptive context-mixing range coder for token ids, many blocks side by side (numpy).

A sequence of ids is cut into blocks of ``BLOCK`` ids, whatever its length; each starts with a fresh model and a fresh coder
and carries the crc32 of its ids and its coded form. Three predictions of the next id are mixed: the id that last followed the last two ids
(order 2), the id that last followed the last id (order 1), and the frequencies of whole ids in the block (order 0). The
weights of the mixture are adaptive, one set per pair of confidences of the two context predictions.

Order 0 is a tree over the four nibbles of an id: every node holds the cumulative frequencies of its 16 branches, which move
towards each branch taken, fast in a new node and slower with every visit, so any id can be coded and a frequent one is
cheap. It learns from the ids that the contexts missed, which are the ones it has to code. One range-coder step codes
which prediction holds and the id's high byte, a second one the low byte of ids left to order 0.

Ids of 65,536 or more are coded as two planes, the low and the high 16 bits. Blocks are coded in step, one id of each at a
time, as numpy vectors over at most ``GROUP`` blocks; blocks do not depend on each other, so neither does the coded form on ``GROUP``.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"LTC2"
BLOCK = 4_096
GROUP = 1_024

_U = np.uint64
_TOTAL_BITS = 30
_TOP = _U(1 << 48)
_LOW_RANGE = _U(1 << 40)
_LOW_MASK = _U((1 << 40) - 1)
_SLOT_BITS = 11
_MIX = (1 << _TOTAL_BITS) - (1 << 26)
_LEAST = 1 << 18
_RATE = 4
#: Order 0: cumulative frequencies of a node sum to 2**_NODE_BITS; two nodes (a byte) take twice as many bits.
_NODE_BITS = 13
_BYTE_BITS = 2 * _NODE_BITS
_NODE = 1 << _NODE_BITS
#: Shift by which a node moves towards the branch taken, by its number of visits so far.
_SHIFTS = np.array([1, 1, 2, 2, 2] + [3] * 5 + [4] * 10 + [5] * 20 + [6], dtype=np.int16)
_BRANCHES = np.arange(16, dtype=np.int16)
#: Where the frequencies move when branch n is taken: every other branch keeps a frequency of 1.
_TARGETS = np.where(_BRANCHES[None, :] <= _BRANCHES[:, None], _BRANCHES[None, :], _NODE - 16 + _BRANCHES[None, :]).astype(np.int16)
_EVEN = (_BRANCHES * (_NODE // 16)).astype(np.int16)
#: First weights of orders 2 and 1 by confidence of order 2, then of order 1.
_FIRST = np.array([1 / 16, 1 / 6, 1 / 3, 1 / 2])


class _Model:
    """The state of a group of blocks; block b owns its own part of every (flat) table."""

    def __init__(self, lanes: int):
        self.lanes = np.arange(lanes, dtype=np.int64)
        self.slots = self.lanes << _SLOT_BITS
        self.mixes = self.lanes << 4
        self.t1 = np.zeros(lanes << _SLOT_BITS, dtype=np.int32)
        self.t2 = np.zeros(lanes << _SLOT_BITS, dtype=np.int32)
        self.w2 = np.tile(np.repeat(_FIRST * _MIX, 4).astype(np.int64), lanes)
        self.w1 = np.tile(np.outer(1 - _FIRST, _FIRST * _MIX).ravel().astype(np.int64), lanes)
        # Nodes of level k come after those of the levels before; entry 0 of a node counts its visits, entry i is the
        # cumulative frequency of the branches before i.
        self.base = [lanes * n for n in (0, 1, 17, 273)]
        self.nodes = np.empty((lanes * 4369, 16), dtype=np.int16)
        self.nodes[:] = _EVEN
        self.whole = self.nodes.view("V32").ravel()  # a node as one item: much faster to write at many places
        self.prev = np.zeros(lanes, dtype=np.int64)
        self.prev2 = np.zeros(lanes, dtype=np.int64)

    def predict(self, n: int) -> None:
        p, q = self.prev[:n], self.prev2[:n]
        self.i1 = self.slots[:n] + ((p * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - _SLOT_BITS))
        self.i2 = self.slots[:n] + ((p * 0x9E3779B1 + q * 0x85EBCA6B & 0xFFFFFFFF) >> (32 - _SLOT_BITS))
        self.e1, self.e2 = self.t1.take(self.i1, mode="clip"), self.t2.take(self.i2, mode="clip")
        self.p1, self.p2 = self.e1 >> 2, self.e2 >> 2
        self.ctx = self.mixes[:n] + ((self.e2 & 3) << 2 | self.e1 & 3)
        self.m2, self.m1 = self.w2.take(self.ctx, mode="clip"), self.w1.take(self.ctx, mode="clip")
        self.known = self.m2 + self.m1
        # Where both contexts predict one id it has both weights.
        same = self.p1 == self.p2
        self.a2 = np.where(same, self.known, self.m2)
        self.a1 = self.known - self.a2

    def update(self, n: int, x: np.ndarray, hit2: np.ndarray, only1: np.ndarray) -> None:
        hit1 = self.p1 == x
        self.w2[self.ctx] = self.m2 + (hit2 * (_MIX - 2 * _LEAST) + _LEAST - self.m2 >> _RATE)
        self.w1[self.ctx] = self.m1 + (only1 * (_MIX - 2 * _LEAST) + _LEAST - self.m1 >> _RATE)
        new = (x << 2).astype(np.int32)
        self.t2[self.i2] = np.where(hit2, np.minimum(self.e2 + 1, self.e2 | 3), new)
        self.t1[self.i1] = np.where(hit1, np.minimum(self.e1 + 1, self.e1 | 3), new)
        self.prev2[:n] = self.prev[:n]
        self.prev[:n] = x

    def learn(self, at: np.ndarray, held: np.ndarray, n: np.ndarray) -> None:
        """Nodes ``at``, which hold ``held``, have taken branches ``n``."""
        visits = held[:, 0].copy()
        step = _TARGETS.take(n, axis=0)
        step -= held
        step >>= _SHIFTS.take(visits, mode="clip")[:, None]
        step += held
        step[:, 0] = np.minimum(visits + 1, len(_SHIFTS))
        self.whole[at] = step.view("V32").ravel()

    def branch(self, level: int, lanes: np.ndarray, prefix: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(branch, its cumulative frequency, its frequency) that holds ``y`` in the nodes under ``prefix``; they learn it."""
        at = self.base[level] + (lanes << 4 * level) + prefix
        held = self.nodes.take(at, axis=0)
        under = held <= y.astype(np.int16)[:, None]
        under[:, 0] = False  # the visits
        n = np.bitwise_count(under.view(_U)).sum(axis=1, dtype=np.int64)
        low, f = _interval(held, n)
        self.learn(at, held, n)
        return n, low, f

    def literal(self, lanes: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cumulative frequencies, frequencies) of the two bytes of ids; the nodes learn them."""
        prefix = np.concatenate((np.zeros(len(x), dtype=np.int64), x >> 12, x >> 8, x >> 4))
        at = np.concatenate([b + (lanes << 4 * k) for k, b in enumerate(self.base)]) + prefix
        n = np.concatenate((x >> 12, x >> 8, x >> 4, x)) & 15
        held = self.nodes.take(at, axis=0)
        low, f = _interval(held, n)
        self.learn(at, held, n)
        low, f = low.reshape(2, 2, -1), f.reshape(2, 2, -1)
        return (low[:, 0] << _NODE_BITS) + low[:, 1] * f[:, 0], f[:, 0] * f[:, 1]

    def find(self, lanes: np.ndarray, prefix: np.ndarray, level: int, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(prefix with the byte that holds ``y``, its cumulative frequency, its frequency); the nodes learn it."""
        n, low, f = self.branch(level, lanes, prefix, y >> _NODE_BITS)
        prefix = prefix << 4 | n
        start = low << _NODE_BITS
        n, low, g = self.branch(level + 1, lanes, prefix, (y - start) // f)
        return prefix << 4 | n, start + low * f, f * g


def _interval(held: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cumulative frequency, frequency) of branch ``n`` of each node."""
    at = np.arange(0, held.size, 16) + n
    flat = held.ravel()
    low = flat.take(at, mode="clip") * (n > 0)
    high = np.where(n < 15, flat.take(at + 1, mode="clip"), np.int16(_NODE))
    return low.astype(np.int64), (high - low).astype(np.int64)


def _shifts(low: np.ndarray, span: np.ndarray):
    """The blocks, again and again until there are none, whose top 16 bits are settled or whose range has become too small to
    go on, with these bits; they are then moved out. A small range that straddles a carry is cut at the carry."""
    settled = (low ^ (low + span)) < _TOP
    k = np.flatnonzero(settled | (span < _LOW_RANGE))
    if not len(k):
        return
    lw, sp, settled = low[k], span[k], settled[k]
    while len(k):
        yield k, lw >> _U(48)
        sp = np.where(settled, sp, (~lw + _U(1)) & _LOW_MASK) << _U(16)
        lw = lw << _U(16)
        low[k], span[k] = lw, sp
        settled = (lw ^ (lw + sp)) < _TOP
        more = np.flatnonzero(settled | (sp < _LOW_RANGE))
        k, lw, sp, settled = k[more], lw[more], sp[more], settled[more]


def _encode_group(ids: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """(words used, coded form) of each block of at most ``GROUP`` blocks of ids below 65,536."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    grid = np.zeros((blocks, BLOCK), dtype=np.uint16)
    grid.ravel()[:n] = ids
    grid = np.ascontiguousarray(grid.T)
    tail = n - (blocks - 1) * BLOCK  # the last block may be shorter
    model = _Model(blocks)
    low = np.zeros(blocks, dtype=_U)
    span = np.full(blocks, 2**64 - 1, dtype=_U)
    width = BLOCK * 4 + 8
    words = np.zeros(blocks * width, dtype=np.uint16)
    at_word = np.arange(blocks, dtype=np.int64) * width

    def out(lw, sp, aw):
        for k, top in _shifts(lw, sp):
            at = aw[k]
            words[at] = top
            aw[k] = at + 1

    for t in range(BLOCK):
        m = blocks if t < tail else blocks - 1
        if not m:
            break
        x = grid[t, :m].astype(np.int64)
        model.predict(m)
        hit2 = model.p2 == x
        only1 = (model.p1 == x) & ~hit2
        cum = np.where(only1, model.a2, 0)
        freq = np.where(hit2, model.a2, model.a1)
        k = np.flatnonzero(~(hit2 | only1))
        if len(k):
            lo, f = model.literal(k, x[k])
            known = model.known[k]
            rest = (1 << _TOTAL_BITS) - known
            first = lo[0] * rest >> _BYTE_BITS
            cum[k] = known + first
            freq[k] = ((lo[0] + f[0]) * rest >> _BYTE_BITS) - first
        lw, sp, aw = low[:m], span[:m], at_word[:m]
        sp >>= _U(_TOTAL_BITS)
        lw += cum.view(_U) * sp
        sp *= freq.view(_U)
        out(lw, sp, aw)
        if len(k):
            unit = sp[k] >> _U(_BYTE_BITS)
            lw[k] += lo[1].view(_U) * unit
            sp[k] = f[1].view(_U) * unit
            out(lw, sp, aw)
        model.update(m, x, hit2, only1)
    for k in range(4):
        words[at_word] = low >> _U(48 - 16 * k) & _U(0xFFFF)
        at_word += 1
    used = at_word - np.arange(blocks) * width
    words = words.reshape(blocks, width)
    return used, [words[b, :used[b]].astype("<u2").tobytes() for b in range(blocks)]


def _decode_group(words: np.ndarray, at_word: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of the blocks whose coded words start at ``at_word``."""
    blocks = len(at_word)
    at_word = at_word.copy()
    model = _Model(blocks)
    low = np.zeros(blocks, dtype=_U)
    span = np.full(blocks, 2**64 - 1, dtype=_U)
    code = np.zeros(blocks, dtype=_U)
    for _ in range(4):
        code = code << _U(16) | words.take(at_word, mode="clip")
        at_word += 1
    tail = n - (blocks - 1) * BLOCK
    grid = np.zeros((BLOCK, blocks), dtype=np.uint16)
    most = (1 << _TOTAL_BITS) - 1

    def out(lw, sp, cd, aw):
        for k, _ in _shifts(lw, sp):
            at = aw[k]
            cd[k] = cd[k] << _U(16) | words.take(at, mode="clip")
            aw[k] = at + 1

    for t in range(BLOCK):
        m = blocks if t < tail else blocks - 1
        if not m:
            break
        model.predict(m)
        lw, sp, cd, aw = low[:m], span[:m], code[:m], at_word[:m]
        sp >>= _U(_TOTAL_BITS)
        v = np.minimum((cd - lw) // sp, _U(most)).view(np.int64)
        hit2 = v < model.a2
        x = np.where(hit2, model.p2, model.p1).astype(np.int64)
        cum = np.where(hit2, 0, model.a2)
        freq = np.where(hit2, model.a2, model.a1)
        miss = v >= model.known
        k = np.flatnonzero(miss)
        if len(k):
            known = model.known[k]
            rest = (1 << _TOTAL_BITS) - known
            y = np.minimum((((v[k] - known + 1) << _BYTE_BITS) - 1) // rest, (1 << _BYTE_BITS) - 1)
            byte, lo, f = model.find(k, np.zeros(len(k), dtype=np.int64), 0, y)
            first = lo * rest >> _BYTE_BITS
            cum[k] = known + first
            freq[k] = ((lo + f) * rest >> _BYTE_BITS) - first
        lw += cum.view(_U) * sp
        sp *= freq.view(_U)
        out(lw, sp, cd, aw)
        if len(k):
            lk = lw[k]
            unit = sp[k] >> _U(_BYTE_BITS)
            y = np.minimum((cd[k] - lk) // unit, _U((1 << _BYTE_BITS) - 1)).view(np.int64)
            x[k], lo, f = model.find(k, byte, 2, y)
            lw[k] = lk + lo.view(_U) * unit
            sp[k] = f.view(_U) * unit
            out(lw, sp, cd, aw)
        model.update(m, x, hit2, ~(hit2 | miss))
        grid[t, :m] = x
    return np.ascontiguousarray(grid.T).ravel()[:n].astype("<u4")


def _group(blocks: int) -> int:
    """Blocks a group: as few groups as ``GROUP`` allows, of even size."""
    return -(-blocks // -(-blocks // GROUP))


def _encode_plane(ids: np.ndarray) -> bytes:
    used, coded = [], []
    step = _group(-(-len(ids) // BLOCK)) * BLOCK
    for at in range(0, len(ids), step):
        some, parts = _encode_group(ids[at:at + step])
        used.append(some)
        coded += parts
    flat = ids.astype("<u4")
    index = np.empty((len(coded), 2), dtype="<u4")
    index[:, 0] = np.concatenate(used)
    index[:, 1] = [zlib.crc32(part, zlib.crc32(flat[b * BLOCK:(b + 1) * BLOCK].tobytes())) for b, part in enumerate(coded)]
    return index.tobytes() + b"".join(coded)


def _decode_plane(data: bytes, at: int, n: int) -> tuple[np.ndarray, int]:
    """(the ``n`` ids of the plane that starts at byte ``at``, where it ends)."""
    blocks = -(-n // BLOCK)
    index = np.frombuffer(data, dtype="<u4", count=blocks * 2, offset=at).reshape(blocks, 2).astype(np.int64)
    at += blocks * 8
    total = int(index[:, 0].sum())
    words = np.concatenate((np.frombuffer(data, dtype="<u2", count=total, offset=at).astype(_U), np.zeros(8, dtype=_U)))
    starts = np.cumsum(index[:, 0]) - index[:, 0]
    step = _group(blocks)
    ids = np.concatenate([_decode_group(words, starts[b:b + step], min(n, (b + step) * BLOCK) - b * BLOCK) for b in range(0, blocks, step)])
    for b, (first, used) in enumerate(zip((at + starts * 2).tolist(), (index[:, 0] * 2).tolist(), strict=True)):
        if zlib.crc32(data[first:first + used], zlib.crc32(ids[b * BLOCK:(b + 1) * BLOCK].tobytes())) != index[b, 1]:
            raise ValueError(f"block {b} is damaged")
    return ids, at + total * 2


def encode(ids: np.ndarray) -> bytes:
    """Coded form of a sequence of ids below 2**32."""
    ids = np.asarray(ids)
    n = len(ids)
    if n and (int(ids.min()) < 0 or int(ids.max()) >= 1 << 32):
        raise ValueError("ids must be whole numbers from 0 to 2**32 - 1")
    planes = 2 if n and int(ids.max()) >= 1 << 16 else 1
    head = MAGIC + struct.pack("<QII", n, BLOCK, planes)
    return head + b"".join(_encode_plane(ids >> 16 * p & 0xFFFF) for p in range(planes)) if n else head


def decode(data: bytes) -> np.ndarray:
    """The ids of a coded sequence; a damaged block raises ValueError."""
    if data[:4] != MAGIC:
        raise ValueError("not a coded token sequence")
    n, block, planes = struct.unpack("<QII", data[4:20])
    if block != BLOCK or planes not in (1, 2):
        raise ValueError("the head is damaged, or of another version")
    ids, at = np.zeros(n, dtype=np.uint32), 20
    for p in range(planes if n else 0):
        part, at = _decode_plane(data, at, n)
        ids |= part << 16 * p
    return ids

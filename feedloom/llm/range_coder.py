"""Context-mixing range coder for id sequences, many blocks at a time.

Each block of ids is coded on its own: its model starts empty and its bytes carry a checksum, so
any block can be read, or found damaged, without the others. All arrays here have one row per
block; a step codes one id of every block.

Model. Within a block ids are numbered by first appearance, so frequent ids get short numbers. Two
predictions compete for the next id: the one that last followed the two ids before it (order 2)
and the one that last followed the id before it (order 1), each with a confidence. What is coded
is an event: the order-2 prediction holds, the order-1 prediction holds, the id is new, or its
number is of a class of size (order 0). Event probabilities mix two adaptive counts: those met under
the same two confidences, and those of order 0; a context weighs the more, the more it has seen.
The bits of a number, or of a new id, follow as they are.
"""

from __future__ import annotations

import zlib

import numpy as np

#: Ids in a block, at most and at least. A short sequence has shorter blocks, as a step costs about
#: as much for one block as for some hundred.
BLOCK, LEAST_BLOCK, ABREAST = 4096, 256, 1024
#: Events: order-2 hit, order-1 hit, new id, number of a class; a class is so many bits wide.
ORDER2, ORDER1, NEW, NUMBERS = 0, 1, 2, 3
CLASS_BITS = (3, 6, 9, 11, BLOCK.bit_length())
EVENTS = NUMBERS + len(CLASS_BITS)
#: Total of coded frequencies, as bits; with the bits that follow, a step takes 32 at most.
SCALE = 16
CONFIDENCE = 4
STATES = (CONFIDENCE + 1) ** 2
#: Events that the order-0 counts stand for in the mixture, in units of a context's event.
PRIOR, UNIT = 32.0, 16.0
#: Ids below this are numbered by a table of their first places.
SMALL = 1 << 16
MAGIC = b"CMRC2\x00\x00\x00"
_U = np.uint64
_ADDED_UP = np.triu(np.ones((EVENTS, EVENTS), dtype=np.float32))
_STEPS = np.arange(1, EVENTS + 1, dtype=np.float32)
_WIDTH = np.array([0, 0, 0, *CLASS_BITS], dtype=np.int64)
_CLASS = NUMBERS + np.searchsorted([1 << bits for bits in CLASS_BITS], np.arange(BLOCK + 1),
                                   side="right")
_EDGES = np.arange(1, EVENTS + 1, dtype=np.int32)
# What a guess of each confidence gains if it is wrong, and if it is right.
_SURER = np.array([-1] * 8 + [int(sure < CONFIDENCE) for sure in range(8)], dtype=np.int32)
_MASK, _WORD = _U(0xFFFFFFFF), _U(32)


class Model:
    """Adaptive state of a number of blocks.

    A prediction is held as a number and, in its last three bits, a confidence: 16 bits in all.
    Those of order 2 lie in front of those of order 1.
    """

    def __init__(self, blocks: int, size: int):
        self.width, self.offset = size + 1, blocks * BLOCK
        self.after = np.zeros(blocks * (BLOCK + self.width), dtype=np.uint16)
        self.counts = np.zeros((blocks * STATES, EVENTS), dtype=np.float32)
        self.counts0 = np.full((blocks, EVENTS), 0.125, dtype=np.float32)
        self.flat = self.counts.reshape(-1)
        # Numbers start at 1; 0 stands before the first id.
        self.last = np.zeros(blocks, dtype=np.int32)
        self.before = np.zeros(blocks, dtype=np.int32)
        self.seen = np.zeros(blocks, dtype=np.int32)
        self.steps = 0
        self.shorten(blocks)

    def shorten(self, blocks: int) -> None:
        """Go on with the first ``blocks`` blocks; the others have ended."""
        for name in ("counts0", "last", "before", "seen"):
            setattr(self, name, getattr(self, name)[:blocks])
        self.flat0 = self.counts0.reshape(-1)
        rows = np.arange(blocks)
        self.row_slot = np.stack([rows * BLOCK, rows * self.width + self.offset])
        self.row_state, self.row_event = rows * STATES, rows * EVENTS
        self.at = np.empty((2, blocks), dtype=np.int64)

    def predict(self) -> np.ndarray:
        """Added-up weights of the events, one row per block."""
        at = self.at
        np.bitwise_and(self.before * 40503 + self.last * 60493 >> 3, BLOCK - 1, out=at[0])
        at[1] = self.last
        at += self.row_slot
        self.held = self.after.take(at).astype(np.int32)
        self.sure, self.guess = self.held & 7, self.held >> 3
        self.context = self.sure[0] * (CONFIDENCE + 1) + self.sure[1] + self.row_state
        # Whole numbers, so that adding them up in any order gives the same, on any machine.
        mixed = np.floor(self.counts0 * np.float32(PRIOR / (self.steps + 0.125 * EVENTS)))
        mixed += self.counts.take(self.context, axis=0)
        upper = mixed @ _ADDED_UP
        upper += _STEPS
        return upper

    def event_of(self, number: np.ndarray) -> np.ndarray:
        """Event for known next numbers."""
        event = _CLASS.take(number)
        np.putmask(event, number > self.seen, NEW)
        self.right = self.guess == number
        np.putmask(event, self.right[1], ORDER1)
        np.putmask(event, self.right[0], ORDER2)
        return event

    def update(self, event: np.ndarray, number: np.ndarray) -> None:
        self.flat[self.context * EVENTS + event] += np.float32(UNIT)
        self.flat0[self.row_event + event] += np.float32(1)
        self.steps += 1
        self.seen += event == NEW
        # A right guess grows sure, a wrong one loses, and is replaced at the bottom.
        kept = self.held + _SURER.take(self.right << 3 | self.sure)
        np.copyto(kept, number << 3 | 1, where=~(self.right | (self.sure > 1)))
        self.after[self.at] = kept
        self.before, self.last = self.last, number


def _scale(upper: np.ndarray) -> np.ndarray:
    """Factor that brings added-up weights to the total of the coder, less one per event."""
    return np.float32((1 << SCALE) - EVENTS - 1) / upper[:, -1]


def interval(upper: np.ndarray, event: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cumulated frequencies in front of and behind an event."""
    scale, flat = _scale(upper), upper.reshape(-1)
    at = np.arange(len(event)) * EVENTS + event
    end = (flat.take(at) * scale).astype(np.int64) + event + 1
    start = (flat.take(at - 1, mode="wrap") * scale).astype(np.int64) + event
    end[event == EVENTS - 1] = 1 << SCALE
    start[event == 0] = 0
    return start, end


def event_at(upper: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Event whose interval holds a cumulated frequency, and that interval."""
    edges = (upper * _scale(upper)[:, None]).astype(np.int32)
    edges += _EDGES
    edges[:, -1] = 1 << SCALE
    event = (edges > target[:, None]).argmax(axis=1)
    flat, at = edges.reshape(-1), np.arange(0, edges.size, EVENTS) + event
    return event, np.where(event > 0, flat.take(at - 1, mode="wrap"), 0), flat.take(at)


def _numbers(ids: np.ndarray) -> np.ndarray:
    """Numbers from 1 by first appearance."""
    if len(ids) and int(ids.max()) < SMALL:
        # The last place written counts, so places are written from the last to the first.
        places = np.arange(len(ids))
        table = np.empty(SMALL, dtype=np.int64)
        table[ids[::-1]] = places[::-1]
        first = table[ids]
        return np.cumsum(first == places)[first]
    values, first, back = np.unique(ids, return_index=True, return_inverse=True)
    number = np.empty(len(values), dtype=np.int64)
    number[np.argsort(first, kind="stable")] = np.arange(1, len(values) + 1)
    return number[back]


class Coder:
    """Low end and range of a number of blocks, 64 bits, moved out 32 at a time.

    A range that gets short across a carry is cut there, so nothing ever has to be carried.
    """

    def __init__(self, blocks: int):
        self.low = np.zeros(blocks, dtype=np.uint64)
        self.range = np.full(blocks, (1 << 64) - 1, dtype=np.uint64)

    def shorten(self, blocks: int) -> None:
        self.low, self.range = self.low[:blocks], self.range[:blocks]

    def narrow(self, start, end, unit) -> None:
        self.low += unit * start.astype(np.uint64)
        self.range = unit * (end - start).astype(np.uint64)

    def shift(self):
        """Blocks whose next word is settled, and the word."""
        at = np.flatnonzero(self.range <= _MASK)
        low, wide = self.low[at], self.range[at]
        across = (low ^ (low + wide - _U(1))) > _MASK
        wide = np.where(across, (_U(0) - low) & _MASK, wide)
        self.low[at], self.range[at] = low << _WORD, wide << _WORD
        return at, low >> _WORD


def encode(ids: np.ndarray, id_bits: int = 16) -> bytes:
    """Bytes of a sequence of ids of at most ``id_bits`` bits (16 or 32), in independent blocks."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    block = min(BLOCK, max(LEAST_BLOCK, len(ids) // ABREAST))
    cut = [ids[i:i + block] for i in range(0, len(ids), block)]
    lengths = [len(one) for one in cut]
    blocks, size = len(cut), max(lengths, default=0)
    numbers = np.ones((size, blocks), dtype=np.uint16)
    whole = np.zeros((size, blocks), dtype=np.uint32)
    for i, one in enumerate(cut):
        numbers[:len(one), i] = _numbers(one)
        whole[:len(one), i] = one
    room = 256
    words = np.zeros((blocks, room), dtype=np.uint32)
    used = np.zeros(blocks, dtype=np.int64)

    def put(at, word):
        words[at, used[at]] = word
        used[at] += 1

    def finish(start):
        at = np.arange(start, len(coder.low))
        put(at, coder.low[at] >> _WORD)
        put(at, coder.low[at] & _MASK)

    model, coder, active = Model(blocks, size), Coder(blocks), blocks
    for step in range(size):
        if step >= lengths[active - 1]:  # only the last block can be shorter
            active -= 1
            finish(active)
            model.shorten(active)
            coder.shorten(active)
        if used.max() + 8 > room:
            room *= 2
            words = np.concatenate([words, np.zeros_like(words)], axis=1)
        number = numbers[step, :active].astype(np.int32)
        plain = whole[step, :active].astype(np.uint64)
        upper = model.predict()
        event = model.event_of(number)
        coder.narrow(*interval(upper, event), coder.range >> _U(SCALE))
        new = event == NEW
        width = _WIDTH.take(event)
        value = np.where(width > 0, number, 0)
        if id_bits == 16:
            width[new] = 16
            value[new] = plain[new]
        width = width.astype(np.uint64)
        coder.range >>= width
        coder.low += coder.range * value.astype(np.uint64)
        put(*coder.shift())
        if id_bits != 16:
            for part in (_U(16), _U(0)):
                coder.range >>= np.where(new, _U(16), _U(0))
                coder.low += coder.range * np.where(
                    new, plain >> part & _U(0xFFFF), _U(0))
                put(*coder.shift())
        model.update(event, number)
    finish(0)
    head = np.zeros((blocks, 3), dtype="<u4")
    head[:, 0], head[:, 1] = lengths, used
    head[:, 2] = [zlib.crc32(one.tobytes()) for one in cut]
    body = b"".join(words[i, :used[i]].astype("<u4").tobytes() for i in range(blocks))
    return MAGIC + np.array([blocks, id_bits], dtype="<u4").tobytes() + head.tobytes() + body


class Damaged(ValueError):
    """A block does not hold what its checksum says."""


def decode(data) -> np.ndarray:
    """The ids of ``encode``'s bytes; raises ``Damaged`` for any other bytes."""
    if bytes(data[:len(MAGIC)]) != MAGIC or len(data) < len(MAGIC) + 8:
        raise Damaged("not a coded id sequence")
    blocks, id_bits = (int(x) for x in np.frombuffer(data, "<u4", 2, len(MAGIC)))
    start = len(MAGIC) + 8 + 12 * blocks
    if len(data) < start or (len(data) - start) % 4:
        raise Damaged("cut short")
    head = np.frombuffer(data, "<u4", 3 * blocks, len(MAGIC) + 8).reshape(blocks, 3)
    lengths, used = head[:, 0].astype(np.int64), head[:, 1].astype(np.int64)
    body = np.frombuffer(data, "<u4", -1, start)
    if len(body) != used.sum() or (lengths > BLOCK).any() or (used < 2).any():
        raise Damaged("cut short")
    if not blocks:
        return np.empty(0, dtype="<u4")
    body = np.concatenate([body, np.zeros(1, dtype="<u4")]).astype(np.uint64)
    read, size = np.cumsum(used) - used, int(lengths.max())
    out = np.zeros((size, blocks), dtype=np.uint32)
    width = size + 2
    names = np.zeros(blocks * width, dtype=np.uint16 if id_bits == 16 else np.uint32)
    code = body[read] << _WORD | body[read + 1]
    read += 2
    model, coder, active = Model(blocks, size), Coder(blocks), blocks

    def take(at, _):
        # A damaged block may want words behind the end; its checksum will tell.
        code[at] = code[at] << _WORD | body[np.minimum(read[at], len(body) - 1)]
        read[at] += 1

    def bits(width):
        coder.range >>= width
        value = (code - coder.low) // np.maximum(coder.range, _U(1))
        np.minimum(value, (_U(1) << width) - _U(1), out=value)
        coder.low += coder.range * value
        return value

    for step in range(size):
        if step >= lengths[active - 1]:
            active -= 1
            model.shorten(active)
            coder.shorten(active)
            code, read = code[:active], read[:active]
        upper = model.predict()
        unit = coder.range >> _U(SCALE)
        target = ((code - coder.low) // np.maximum(unit, _U(1))).astype(np.int32)
        np.minimum(np.maximum(target, 0, out=target), (1 << SCALE) - 1, out=target)
        event, begin, end = event_at(upper, target)
        coder.narrow(begin, end, unit)
        new = event == NEW
        length = _WIDTH.take(event)
        if id_bits == 16:
            length[new] = 16
        value = bits(length.astype(np.uint64))
        take(*coder.shift())
        number = np.minimum(value, _U(size)).astype(np.int32)
        np.copyto(number, model.guess[1], where=event == ORDER1)
        np.copyto(number, model.guess[0], where=event == ORDER2)
        np.copyto(number, model.seen + 1, where=new)
        if id_bits != 16:
            value = bits(np.where(new, _U(16), _U(0)))
            take(*coder.shift())
            value = value << _U(16) | bits(np.where(new, _U(16), _U(0)))
            take(*coder.shift())
        name = np.arange(active) * width + number
        names[name[new]] = value[new]
        out[step, :active] = names.take(name)
        model.right = model.guess == number
        model.update(event, number)
    parts = [out[:lengths[i], i].astype("<u4") for i in range(blocks)]
    for i, part in enumerate(parts):
        if zlib.crc32(part.tobytes()) != head[i, 2]:
            raise Damaged(f"block {i} is damaged")
    return np.concatenate(parts)

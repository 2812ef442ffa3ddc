"""A context-mixing range coder for token ids.

Contexts of order 0, 1 and 2 (none, the previous id, the two previous ids) each
predict one id, with a confidence that grows with every hit. Coding an id asks
for each order in turn, from the highest, whether its prediction is right; the
probability of a yes mixes, by weights that adapt, what all orders that predict
the same id have learned about their confidences. An id that no order predicts
is coded by its magnitude class, with adaptive counts, and its bits within the
class.

A block starts from a fresh model and is decoded on its own. All arithmetic is
on integers, so every machine computes the same. Blocks are independent, so many
are coded in step, one id of each at a time, with numpy doing all lanes at once.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

MOST_IDS = 1 << 16
ORDERS = (2, 1, 0)
SLOT_BITS = {2: 12, 1: 11, 0: 0}
CONFIDENCES = 16
TOP, BOTTOM = np.uint64(1 << 56), np.uint64(1 << 48)
U = np.uint64
STEP, MOST_TOTAL = 24, 4000

# Magnitude classes: two to an octave.
_starts = [0, 1, 2, 3] + [s for b in range(2, 16) for s in (1 << b, 3 << (b - 1))]
STARTS = np.array(sorted(set(_starts)), np.int32)
WIDTHS = np.diff(np.append(STARTS, MOST_IDS))
CLASS_BITS = np.ceil(np.log2(WIDTHS)).astype(np.uint64)
CLASSES = len(STARTS)
CLASS_OF = (np.searchsorted(STARTS, np.arange(MOST_IDS), side="right") - 1).astype(np.int32)

# Logistic mixing in whole numbers: probabilities have 12 bits, their logits 8 fractional bits.
_p = (np.arange(4096) + 0.5) / 4096
STRETCH = np.round(np.log(_p / (1 - _p)) * 256).astype(np.int32)
LOGITS = 2047
SQUASH = np.clip(np.round(4096 / (1 + np.exp(-np.arange(-LOGITS, LOGITS + 1) / 256))), 64, 4032).astype(np.int32)


def _narrow(low: np.ndarray, whole: np.ndarray, lanes: np.ndarray, bit: np.ndarray, p: np.ndarray) -> None:
    """Take a yes's or a no's part of the range, in place, where `lanes` holds."""
    bound = (whole >> U(12)) * p.astype(U)
    low += bound * (lanes & ~bit)
    np.copyto(whole, np.where(bit, bound, whole - bound), where=lanes)


class Encoder:
    """Writes decisions of many lanes; `binary` and the others return what they were told."""

    def __init__(self, lanes: int, most_bytes: int):
        self.low, self.range = np.zeros(lanes, U), np.full(lanes, ~U(0))
        self.out, self.done = np.zeros((lanes, most_bytes), np.uint8), np.zeros(lanes, np.int64)

    def binary(self, lanes: np.ndarray, p: np.ndarray, bit: np.ndarray) -> np.ndarray:
        _narrow(self.low[:len(lanes)], self.range[:len(lanes)], lanes, bit, p)
        return bit

    def class_of(self, lanes: np.ndarray, upto: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Here and in `bits`, `lanes` are the numbers of the lanes meant."""
        rows = np.arange(len(lanes))
        high, start = upto[rows, k], np.where(k > 0, upto[rows, k - 1], 0)
        part = self.range[lanes] // upto[:, -1].astype(U)
        self.low[lanes] += part * start.astype(U)
        self.range[lanes] = part * (high - start).astype(U)
        return k

    def bits(self, lanes: np.ndarray, n: np.ndarray, value: np.ndarray) -> np.ndarray:
        part = self.range[lanes] >> n
        self.low[lanes] += part * value.astype(U)
        self.range[lanes] = part
        return value

    def settle(self, active: int) -> None:
        """Write the leading bytes that no later decision can change."""
        low, whole = self.low[:active], self.range[:active]
        while True:
            fixed = (low ^ (low + whole)) < TOP
            narrow = ~fixed & (whole < BOTTOM)
            lanes = np.flatnonzero(fixed | narrow)
            if not len(lanes):
                return
            cut = np.flatnonzero(narrow)
            whole[cut] = (~low[cut] + U(1)) & (BOTTOM - U(1))
            self.out[lanes, self.done[lanes]] = (low[lanes] >> U(56)).astype(np.uint8)
            self.done[lanes] += 1
            low[lanes] <<= U(8)
            whole[lanes] <<= U(8)

    def finished(self) -> list[bytes]:
        for _ in range(8):
            lanes = np.arange(len(self.low))
            self.out[lanes, self.done] = (self.low >> U(56)).astype(np.uint8)
            self.done += 1
            self.low <<= U(8)
        return [row[:n].tobytes() for row, n in zip(self.out, self.done, strict=True)]


class Decoder:
    """Reads the decisions back; the last argument of each method is ignored."""

    def __init__(self, codes: Sequence[bytes]):
        width = max(map(len, codes)) + 16
        self.data = np.frombuffer(b"".join(c.ljust(width, b"\0") for c in codes), np.uint8).reshape(len(codes), width)
        self.low, self.range = np.zeros(len(codes), U), np.full(len(codes), ~U(0))
        self.code, self.read = np.zeros(len(codes), U), np.full(len(codes), 8, np.int64)
        for k in range(8):
            self.code = (self.code << U(8)) | self.data[:, k].astype(U)

    def binary(self, lanes: np.ndarray, p: np.ndarray, _bit: None) -> np.ndarray:
        n = len(lanes)
        bit = (self.code[:n] - self.low[:n]) < (self.range[:n] >> U(12)) * p.astype(U)
        _narrow(self.low[:n], self.range[:n], lanes, bit, p)
        return bit

    def class_of(self, lanes: np.ndarray, upto: np.ndarray, _k: None) -> np.ndarray:
        rows = np.arange(len(lanes))
        part = np.maximum(self.range[lanes] // upto[:, -1].astype(U), U(1))
        value = np.minimum((self.code[lanes] - self.low[lanes]) // part, (upto[:, -1] - 1).astype(U)).astype(np.int32)
        k = (upto <= value[:, None]).sum(1)
        start = np.where(k > 0, upto[rows, k - 1], 0)
        self.low[lanes] += part * start.astype(U)
        self.range[lanes] = part * (upto[rows, k] - start).astype(U)
        return k

    def bits(self, lanes: np.ndarray, n: np.ndarray, _value: None) -> np.ndarray:
        part = np.maximum(self.range[lanes] >> n, U(1))
        value = np.minimum((self.code[lanes] - self.low[lanes]) // part, (U(1) << n) - U(1))
        self.low[lanes] += part * value
        self.range[lanes] = part
        return value.astype(np.int32)

    def settle(self, active: int) -> None:
        low, whole = self.low[:active], self.range[:active]
        while True:
            fixed = (low ^ (low + whole)) < TOP
            narrow = ~fixed & (whole < BOTTOM)
            lanes = np.flatnonzero(fixed | narrow)
            if not len(lanes):
                return
            cut = np.flatnonzero(narrow)
            whole[cut] = (~low[cut] + U(1)) & (BOTTOM - U(1))
            more = self.data[lanes, np.minimum(self.read[lanes], self.data.shape[1] - 1)]
            self.code[lanes] = (self.code[lanes] << U(8)) | more.astype(U)
            self.read[lanes] += 1
            low[lanes] <<= U(8)
            whole[lanes] <<= U(8)


class Mixer:
    """The model of many lanes, each fresh; `next` codes one id of each lane."""

    def __init__(self, lanes: int):
        self.guess = {o: np.full(lanes << SLOT_BITS[o], -1, np.int32) for o in ORDERS}
        self.sure = {o: np.zeros(lanes << SLOT_BITS[o], np.uint8) for o in ORDERS}
        self.chance = {o: np.tile((np.arange(CONFIDENCES) * 3600 + 4000).astype(np.int32), lanes) for o in ORDERS}
        self.weight = {(o, q): np.full(lanes, 40_000 if o == q else 12_000, np.int32) for o in ORDERS for q in ORDERS}
        self.counts = np.full((lanes, CLASSES), 12, np.int16)
        self.lane = np.arange(lanes, dtype=np.int32)
        self.first = {o: self.lane << SLOT_BITS[o] for o in ORDERS}
        self.one, self.two = np.zeros(lanes, np.uint32), np.zeros(lanes, np.uint32)

    def _slots(self, n: int) -> dict[int, np.ndarray]:
        one, two = self.one[:n], self.two[:n]
        first = (one * np.uint32(0x9E3779B1)) >> np.uint32(32 - SLOT_BITS[1])
        second = (one * np.uint32(0x85EBCA6B) + two * np.uint32(0xC2B2AE35)) >> np.uint32(32 - SLOT_BITS[2])
        return {0: self.first[0][:n], 1: self.first[1][:n] + first.astype(np.int32), 2: self.first[2][:n] + second.astype(np.int32)}

    def next(self, coder: Encoder | Decoder, n: int, ids: np.ndarray | None) -> np.ndarray:
        """Code one id of the first `n` lanes (given to an encoder, returned by a decoder)."""
        slot = self._slots(n)
        guess = {o: self.guess[o][slot[o]] for o in ORDERS}
        sure = {o: self.sure[o][slot[o]] for o in ORDERS}
        cell = {o: (self.lane[:n] << 4) + sure[o] for o in ORDERS}
        chance = {o: self.chance[o][cell[o]] for o in ORDERS}
        logit = {o: STRETCH[chance[o] >> 4] for o in ORDERS}
        # Which orders predict the same id.
        same = {(2, 1): guess[2] == guess[1], (2, 0): guess[2] == guess[0], (1, 0): guess[1] == guess[0]}
        same |= {(q, o): m for (o, q), m in same.items()}
        known = {o: guess[o] >= 0 for o in ORDERS}
        asked_of = {2: known[2], 1: known[1] & ~same[2, 1], 0: known[0] & ~same[2, 0] & ~same[1, 0]}
        open_, token = np.ones(n, bool), np.zeros(n, np.int32)
        for o in ORDERS:
            asked = open_ & asked_of[o]
            inputs = {q: logit[o] if q == o else logit[q] * same[o, q] for q in ORDERS}
            total = sum((self.weight[o, q][:n] >> 4) * x for q, x in inputs.items()) >> 12
            p = SQUASH[np.clip(total, -LOGITS, LOGITS) + LOGITS]
            bit = coder.binary(asked, p, None if ids is None else ids == guess[o])
            error = (bit.astype(np.int32) * 4096 - p) * asked
            for q, x in inputs.items():
                self.weight[o, q][:n] += (x * error) >> 10
            right = asked & bit
            token = np.where(right, guess[o], token)
            open_ &= ~right
        lanes = np.flatnonzero(open_)
        if len(lanes):
            upto = np.cumsum(self.counts[lanes], axis=1, dtype=np.int32)
            k = coder.class_of(lanes, upto, None if ids is None else CLASS_OF[ids[lanes]])
            start = STARTS[k]
            value = start + coder.bits(lanes, CLASS_BITS[k], None if ids is None else ids[lanes] - start)
            token[lanes] = value
            self.counts[lanes, k] += STEP
            full = lanes[upto[:, -1] + STEP > MOST_TOTAL]
            if len(full):
                self.counts[full] = (self.counts[full] + 1) >> 1
        coder.settle(n)
        for o in ORDERS:
            hit = guess[o] == token
            self.chance[o][cell[o]] = chance[o] + ((hit.astype(np.int32) * 65535 - chance[o]) >> 5) * known[o]
            self.guess[o][slot[o]] = np.where(~hit & (sure[o] == 0), token, guess[o])
            self.sure[o][slot[o]] = np.where(hit, np.minimum(sure[o] + 1, CONFIDENCES - 1), sure[o] >> 1)
        self.two[:n] = self.one[:n]
        self.one[:n] = token + 1
        return token


def encode_blocks(blocks: Sequence[np.ndarray]) -> list[bytes]:
    """The code of each block of ids below 65,536. Blocks of any lengths are coded side by side."""
    if any(len(b) and int(b.max()) >= MOST_IDS for b in blocks):
        raise ValueError(f"ids must be below {MOST_IDS}")
    order = sorted(range(len(blocks)), key=lambda k: -len(blocks[k]))
    lengths = np.array([len(blocks[k]) for k in order], np.int64)
    longest = int(lengths[0]) if len(lengths) else 0
    grid = np.zeros((longest, len(blocks)), np.int32)
    for lane, k in enumerate(order):
        grid[:lengths[lane], lane] = blocks[k]
    coder, mixer = Encoder(len(blocks), 4 * longest + 64), Mixer(len(blocks))
    for step in range(longest):
        n = int(np.searchsorted(-lengths, -step, side="left"))
        mixer.next(coder, n, grid[step, :n])
    out: list[bytes] = [b""] * len(blocks)
    for k, code in zip(order, coder.finished() if blocks else [], strict=True):
        out[k] = code
    return out


def decode_blocks(codes: Sequence[bytes], lengths: Sequence[int]) -> list[np.ndarray]:
    """The ids of each block, given its code and number of ids."""
    if not codes:
        return []
    order = sorted(range(len(codes)), key=lambda k: -lengths[k])
    sizes = np.array([lengths[k] for k in order], np.int64)
    coder, mixer = Decoder([codes[k] for k in order]), Mixer(len(codes))
    grid = np.zeros((int(sizes[0]), len(codes)), np.uint32)
    for step in range(int(sizes[0])):
        n = int(np.searchsorted(-sizes, -step, side="left"))
        grid[step, :n] = mixer.next(coder, n, None)
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(codes)
    for lane, k in enumerate(order):
        out[k] = grid[:sizes[lane], lane].copy()
    return out

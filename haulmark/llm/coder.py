"""Token ids as compressed binary blocks: an adaptive context-mixing range coder.

A block holds up to ``BLOCK`` ids and starts from nothing, so it can be read alone; a CRC-32 of its ids goes with it.
For each id there are three predictions from what the block has shown so far: the id that last followed the two ids
before (order 2), the one that last followed the id before (order 1), and the frequencies of the id's upper and lower
byte (order 0). Whether the order-2 and then the order-1 guess is right is coded with a probability that mixes the
block's hit rate with that of the guess's own history; if both miss, the two bytes are coded by their frequencies.
All of it drives one range coder of 48 bits that writes 16 bits at a time.

Blocks do not depend on each other, so many are coded side by side: each step is a NumPy operation over all of them.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 4096
_SLOTS = 1 << 12
_SCALE = 12  # probabilities have 12 bits, frequencies sum to at most 2^15
_TOP, _FULL = np.uint64(1 << 32), np.uint64((1 << 48) - 1)
_LEAST = np.uint64(1 << 16)
_EVERY = 32  # ids between two renewals of the order-0 sums


class _Models:
    """Predictions of all lanes; encoder and decoder make the same calls in the same order."""

    def __init__(self, lanes: int):
        self.rows = np.arange(lanes)
        self.guess = [np.zeros((lanes, _SLOTS), dtype=np.int32) for _ in range(2)]
        self.trust = [np.zeros((lanes, _SLOTS), dtype=np.uint8) for _ in range(2)]
        self.rate = [np.full(lanes, 1 << (_SCALE - 1)) for _ in range(2)]
        self.by_trust = [np.full((lanes, 8), 1 << (_SCALE - 1)) for _ in range(2)]
        self.counts = np.ones((2, lanes, 256), dtype=np.int64)
        self.one, self.two = np.zeros(lanes, dtype=np.int64), np.zeros(lanes, dtype=np.int64)
        self.step = 0

    def begin(self) -> None:
        if self.step % _EVERY == 0:
            over = self.counts.sum(axis=2) > (1 << 15) - 256
            self.counts[over] = (self.counts[over] + 1) >> 1
            self.below = np.zeros((2, len(self.rows), 257), dtype=np.int64)
            np.cumsum(self.counts, axis=2, out=self.below[:, :, 1:])
            self.frozen = self.counts.copy()
        self.step += 1
        self.slot = [(self.one * 40503 + self.two * 30011) >> 3 & (_SLOTS - 1), self.one * 40503 >> 2 & (_SLOTS - 1)]
        self.held = [self.guess[k][self.rows, self.slot[k]] - 1 for k in range(2)]  # -1: no guess

    def hit_chance(self, k: int) -> np.ndarray:
        """Of 2^12: that the guess of order 2 - k is right."""
        self.grade = self.trust[k][self.rows, self.slot[k]]
        mixed = (self.rate[k] + self.by_trust[k][self.rows, self.grade]) >> 1
        return np.clip(mixed, 16, (1 << _SCALE) - 16)

    def learn_hit(self, k: int, asked: np.ndarray, hit: np.ndarray) -> None:
        to = np.where(hit, 1 << _SCALE, 0)
        rows = self.rows[asked]
        self.rate[k][rows] += ((to - self.rate[k]) >> 5)[rows]
        grade = self.grade[rows]
        old = self.by_trust[k][rows, grade]
        self.by_trust[k][rows, grade] = old + ((to[rows] - old) >> 4)
        self.trust[k][rows, self.slot[k][rows]] = np.where(hit[rows], np.minimum(grade + 1, 7), grade >> 1)

    def learn(self, ids: np.ndarray, plain: np.ndarray) -> None:
        for k in range(2):
            self.guess[k][self.rows, self.slot[k]] = ids + 1
        rows = self.rows[plain]
        self.counts[0, rows, ids[plain] >> 8] += 24
        self.counts[1, rows, ids[plain] & 255] += 24
        self.one, self.two = ids, self.one


class _Encoder:
    def __init__(self, lanes: int, most: int):
        self.low, self.range = np.zeros(lanes, dtype=np.uint64), np.full(lanes, _FULL)
        self.out, self.size = np.zeros((lanes, most), dtype=">u2"), np.zeros(lanes, dtype=np.int64)

    def _emit(self, rows: np.ndarray) -> None:
        self.out[rows, self.size[rows]] = (self.low[rows] >> np.uint64(32)).astype(np.uint16)
        self.size[rows] += 1
        self.low[rows] = (self.low[rows] << np.uint64(16)) & _FULL
        self.range[rows] = np.minimum(self.range[rows] << np.uint64(16), _FULL)

    def put(self, rows: np.ndarray, low: np.ndarray, freq: np.ndarray, total: np.ndarray) -> None:
        part = self.range[rows] // total.astype(np.uint64)
        self.low[rows] += part * low.astype(np.uint64)
        self.range[rows] = part * freq.astype(np.uint64)
        rows = _settle(self, rows)
        while len(rows):
            self._emit(rows)
            rows = _settle(self, rows)

    def finish(self) -> list[bytes]:
        rows = np.arange(len(self.low))
        for _ in range(3):
            self._emit(rows)
        return [self.out[k, :n].tobytes() for k, n in enumerate(self.size.tolist())]


class _Decoder:
    def __init__(self, payloads: list[bytes]):
        lanes = len(payloads)
        most = max(map(len, payloads)) // 2 + 4
        self.data = np.zeros((lanes, most), dtype=np.uint64)
        for k, payload in enumerate(payloads):
            self.data[k, :len(payload) // 2] = np.frombuffer(payload, dtype=">u2")
        self.low, self.range = np.zeros(lanes, dtype=np.uint64), np.full(lanes, _FULL)
        self.code = (self.data[:, 0] << np.uint64(32)) | (self.data[:, 1] << np.uint64(16)) | self.data[:, 2]
        self.at = np.full(lanes, 3)

    def target(self, rows: np.ndarray, total: np.ndarray) -> np.ndarray:
        self.part = self.range[rows] // total.astype(np.uint64)
        return np.minimum((self.code[rows] - self.low[rows]) // self.part, total.astype(np.uint64) - np.uint64(1)).astype(np.int64)

    def take(self, rows: np.ndarray, low: np.ndarray, freq: np.ndarray) -> None:
        self.low[rows] += self.part * low.astype(np.uint64)
        self.range[rows] = self.part * freq.astype(np.uint64)
        rows = _settle(self, rows)
        while len(rows):
            self.code[rows] = ((self.code[rows] << np.uint64(16)) & _FULL) | self.data[rows, np.minimum(self.at[rows], self.data.shape[1] - 1)]
            self.at[rows] += 1
            self.low[rows] = (self.low[rows] << np.uint64(16)) & _FULL
            self.range[rows] = np.minimum(self.range[rows] << np.uint64(16), _FULL)
            rows = _settle(self, rows)


def _settle(coder, rows: np.ndarray) -> np.ndarray:
    """Lanes whose upper 16 bits are settled, after cutting ranges that have become too small to the next border."""
    low, wide = coder.low[rows], coder.range[rows]
    same = (low ^ (low + wide - np.uint64(1))) < _TOP
    small = ~same & (wide < _LEAST)
    if small.any():
        cut = rows[small]
        coder.range[cut] = np.minimum(_TOP - (coder.low[cut] & (_TOP - np.uint64(1))), wide[small])
        same |= (coder.low[rows] ^ (coder.low[rows] + coder.range[rows] - np.uint64(1))) < _TOP
    return rows[same]


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """Payloads of blocks of ids below 2^16, each of 1 to BLOCK ids."""
    order = sorted(range(len(blocks)), key=lambda k: -len(blocks[k]))
    sizes = np.array([len(blocks[k]) for k in order])
    if not len(sizes):
        return []
    ids = np.zeros((len(order), sizes[0]), dtype=np.int64)
    for lane, k in enumerate(order):
        ids[lane, :len(blocks[k])] = blocks[k]
    coder, models = _Encoder(len(order), int(sizes[0]) * 4 + 16), _Models(len(order))
    for t in range(sizes[0]):
        models.begin()
        now, live = ids[:, t], sizes > t
        ask = live
        for k in range(2):
            ask = ask & (models.held[k] >= 0) if k == 0 else ask & (models.held[1] >= 0) & (models.held[1] != models.held[0])
            hit = models.held[k] == now
            chance = models.hit_chance(k)
            rows = models.rows[ask]
            if len(rows):
                right = hit[rows]
                coder.put(rows, np.where(right, 0, chance[rows]), np.where(right, chance[rows], (1 << _SCALE) - chance[rows]),
                          np.full(len(rows), 1 << _SCALE))
                models.learn_hit(k, ask, hit)
            done = ask & hit if k == 0 else done | (ask & hit)
            ask = live & ~done
        for half, symbol in enumerate((now >> 8, now & 255)):
            rows = models.rows[ask]
            if len(rows):
                coder.put(rows, models.below[half, rows, symbol[rows]], models.frozen[half, rows, symbol[rows]],
                          models.below[half, rows, 256])
        models.learn(now, ask)
    out: list[bytes] = [b""] * len(order)
    for lane, payload in enumerate(coder.finish()):
        out[order[lane]] = payload
    return out


def decode(payloads: list[bytes], counts: list[int]) -> list[np.ndarray]:
    """The ids of blocks, given their payloads and numbers of ids."""
    order = sorted(range(len(payloads)), key=lambda k: -counts[k])
    sizes = np.array([counts[k] for k in order])
    if not len(sizes):
        return []
    coder, models = _Decoder([payloads[k] for k in order]), _Models(len(order))
    ids = np.zeros((len(order), sizes[0]), dtype=np.int64)
    for t in range(sizes[0]):
        models.begin()
        now, live = np.zeros(len(order), dtype=np.int64), sizes > t
        ask = live
        for k in range(2):
            ask = ask & (models.held[k] >= 0) if k == 0 else ask & (models.held[1] >= 0) & (models.held[1] != models.held[0])
            hit = np.zeros(len(order), dtype=bool)
            chance = models.hit_chance(k)
            rows = models.rows[ask]
            if len(rows):
                right = coder.target(rows, np.full(len(rows), 1 << _SCALE)) < chance[rows]
                coder.take(rows, np.where(right, 0, chance[rows]), np.where(right, chance[rows], (1 << _SCALE) - chance[rows]))
                hit[rows] = right
                now[rows[right]] = models.held[k][rows[right]]
                models.learn_hit(k, ask, hit)
            done = ask & hit if k == 0 else done | (ask & hit)
            ask = live & ~done
        rows = models.rows[ask]
        for half in range(2):
            if len(rows):
                target = coder.target(rows, models.below[half, rows, 256])
                symbol = np.zeros(len(rows), dtype=np.int64)
                for bit in (128, 64, 32, 16, 8, 4, 2, 1):  # the last symbol whose sum below is at most the target
                    symbol += np.where(models.below[half, rows, symbol + bit] <= target, bit, 0)
                coder.take(rows, models.below[half, rows, symbol], models.frozen[half, rows, symbol])
                now[rows] += symbol << 8 if half == 0 else symbol
        models.learn(now, ask)
        ids[:, t] = now
    out: list[np.ndarray] = [ids[0, :0]] * len(order)
    for lane, k in enumerate(order):
        out[k] = ids[lane, :counts[k]]
    return out


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())

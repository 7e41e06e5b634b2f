"""A context-mixing range coder for token ids.

A block codes its ids in `lanes` streams side by side, one id of each lane per step, so that every step is a
few array operations; all lanes share the block's model, which starts anew with each block. For an id the
model names two candidates: the id that last followed the two ids before (order 2) and the one that last
followed the id before (order 1). "Is it the order-2 candidate" and "is it the order-1 candidate" are yes/no
decisions. Each has predictions from how often candidates of that standing were right and, for the second,
from the candidate's share of all ids (order 0); their logits are mixed with weights that learn from each
step's errors. An id that is neither is coded by the order-0 counts. All model arithmetic is on integers, so
decoding repeats it exactly. The range coder keeps a 48-bit interval per lane and puts out 16-bit words.

A block is: magic, counts, zlib-packed document ids and lengths, words per lane, words, CRC-32 of it all.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"LTC1"
LANES = 8192
LANE_IDS = 256  # ids of a lane, at least, before there are more lanes
P_BITS, SUM_BITS = 12, 20
HASH_BITS = 18
GAIN = 32  # counts that one occurrence adds at order 0, over the one that each id starts with
U = np.uint64
_ONE = 1 << P_BITS

#: Logits (8 fractional bits) of probabilities in 1/4096, and back.
STRETCH = np.array([0, *(round(256 * np.log(p / (_ONE - p))) for p in range(1, _ONE))], np.int64)
STRETCH[0] = STRETCH[1]
SQUASH = np.array([min(_ONE - 16, max(16, round(_ONE / (1 + np.exp(-x / 256))))) for x in range(-2047, 2048)], np.int64)
#: How sure a candidate is that was right once more; which weights an order-1 candidate's standing uses.
BUMP = np.array([1, 2, 3, 4, 5, 6, 7, 7], np.int32)
SET_B = (np.arange(64) % 8 > 1).astype(np.int64)
WIDE = 1024  # lanes from which a decoder keeps the id of every place, in place of a search


def _between(x: np.ndarray, low: int, high: int) -> np.ndarray:
    return np.minimum(np.maximum(x, low), high)


class Mixer:
    """Mixes two logits with weights (16 fractional bits) chosen by a yes/no context."""

    def __init__(self):
        self.w = np.full((2, 2), 40_000, np.int64)

    def mix(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The probability, for logits already times their weights."""
        return SQUASH[_between(one + two >> 16, -2047, 2047) + 2047]

    def learn(self, n: list[int], sums: list[list[int]]) -> None:
        """`n` is how many lanes had either context, `sums` their errors times each logit."""
        for w, s in zip(self.w, sums):
            w += np.array([s[0] // (max(1, n[0]) << 6), s[1] // (max(1, n[1]) << 6)])


class Rates:
    """How often candidates of each standing were right."""

    def __init__(self, contexts: int):
        self.hit, self.all = np.ones(contexts, np.int64), np.full(contexts, 2, np.int64)
        self.refresh()

    def refresh(self) -> None:
        self.st = STRETCH[_between((self.hit << P_BITS) // self.all, 16, _ONE - 16)]

    def learn(self, hit: np.ndarray, n: np.ndarray) -> None:
        self.hit += hit
        self.all += n
        self.refresh()


class Model:
    """What the lanes share. A candidate and how sure it is lie in one number, `8 * id + sure`. Whatever depends on
    the standing alone is worked out once for each of the few standings, not for each lane."""

    def __init__(self, size: int, lanes: int, inverse: bool = False):
        self.size = size
        self.next1, self.next2 = np.zeros(size + 1, np.int32), np.zeros(1 << HASH_BITS, np.int32)
        self.count = np.ones(size, np.int64)
        self.seen: list[np.ndarray] = []
        self.first, self.second = Rates(8 * 8 * 2), Rates(8 * 8)
        self.alone = Rates(8)
        self.mix_first, self.mix_second = Mixer(), Mixer()
        self.p1 = np.full(lanes, size, np.int64)
        self.p2 = np.full(lanes, size, np.int64)
        self.step = 0
        self.inverse = inverse and lanes >= WIDE
        self.sums()

    def sums(self) -> None:
        if self.seen:
            self.count += GAIN * np.bincount(np.concatenate(self.seen), minlength=self.size)
            self.seen = []
        total = int(self.count.sum())
        cum = np.concatenate([[0], np.cumsum(self.count)])
        cum = cum * ((1 << SUM_BITS) - self.size) // total + np.arange(self.size + 1)
        width = np.diff(cum)
        self.cum, self.width = cum.astype(U), width.astype(U)
        self.share = STRETCH[_between(width >> SUM_BITS - P_BITS, 1, _ONE - 1)]
        if self.inverse:
            self.id_at = np.repeat(np.arange(self.size, dtype=np.int32), width)

    def find(self, at: np.ndarray) -> np.ndarray:
        """The ids whose shares of the interval hold the places `at`."""
        at = np.minimum(at, U((1 << SUM_BITS) - 1))
        if self.inverse:
            return self.id_at.take(at.astype(np.int64)).astype(np.int64)
        return np.searchsorted(self.cum, at, side="right") - 1

    def guess(self, m: int) -> None:
        """Candidates of the first m lanes, and where in the tables of `begin` and `width` a hit or a miss lies."""
        self.m = m
        c1 = self.c1 = self.p1[:m]
        c2 = self.c2 = (self.p2[:m] * 40503 + c1 * 2654435761 >> 7) & ((1 << HASH_BITS) - 1)
        two, one = self.next2.take(c2), self.next1.take(c1)
        self.a, self.b = two >> 3, one >> 3
        self.s2, self.s1 = two & 7, one & 7
        self.same = self.a == self.b
        self.ctx = (self.s2 << 4 | self.s1 << 1 | self.same).astype(np.int64)
        w = self.mix_first.w
        self.logits = self.first.st, np.repeat(self.alone.st, 16)
        self.prob = self.mix_first.mix(np.tile(w[0], 64) * self.logits[0], np.tile(w[1], 64) * self.logits[1])

    def guess_second(self, at: np.ndarray) -> np.ndarray:
        """Probabilities of the order-1 candidate for lanes `at`, where the order-2 one was wrong."""
        self.kb = self.ctx.take(at) >> 1
        self.st_b = self.share.take(self.b.take(at))
        w = self.mix_second.w
        self.prob_b = self.mix_second.mix((w[0].take(SET_B) * self.second.st).take(self.kb), w[1].take(SET_B).take(self.kb) * self.st_b)
        return self.prob_b

    def learn(self, ids: np.ndarray, hit_a: np.ndarray, hit_b: np.ndarray) -> None:
        m = self.m
        n, hit = (np.bincount(c, minlength=128) for c in (self.ctx, self.ctx[hit_a]))
        err = (hit << P_BITS) - n * self.prob
        self.mix_first.learn([int(n[k::2].sum()) for k in (0, 1)], [[int(err[k::2] @ st[k::2]) for k in (0, 1)] for st in self.logits])
        self.first.learn(hit, n)
        self.alone.learn(hit.reshape(8, 16).sum(1), n.reshape(8, 16).sum(1))
        if len(self.kb):
            n, hit = (np.bincount(c, minlength=64) for c in (self.kb, self.kb[hit_b]))
            err = (hit_b.astype(np.int64) << P_BITS) - self.prob_b
            # sums of whole numbers far below 2^53, so that doubles hold them exactly
            by = [np.bincount(self.kb, e, 64).astype(np.int64) for e in (err, err * self.st_b)]
            by[0] *= self.second.st
            self.mix_second.learn([int(n[SET_B == k].sum()) for k in (0, 1)], [[int(e[SET_B == k].sum()) for k in (0, 1)] for e in by])
            self.second.learn(hit, n)
        now = (ids << 3).astype(np.int32)
        self.next2[self.c2] = now | BUMP.take(self.s2) * hit_a
        self.next1[self.c1] = now | BUMP.take(self.s1) * (self.b == ids)
        self.seen.append(ids)
        self.p2[:m] = self.p1[:m]
        self.p1[:m] = ids
        self.step += 1
        if self.step & (self.step - 1) == 0 or self.step % 16 == 0:
            self.sums()


def _shape(n: int) -> tuple[int, np.ndarray]:
    """Lanes, and the ids that each lane codes (the first ones may have one more)."""
    lanes = max(1, min(LANES, n // LANE_IDS))
    return lanes, n // lanes + (np.arange(lanes) < n % lanes)


def _steps(lanes: int, ids: np.ndarray, back: np.ndarray | None = None) -> np.ndarray:
    """The ids of each step side by side, the lanes lying one after the other in `ids`; with `back`, which is such a
    table, `ids` is filled from it instead."""
    long, extra = divmod(len(ids), lanes)
    table = np.zeros((long + 1, lanes), ids.dtype) if back is None else back
    first, rest = ids[: extra * (long + 1)].reshape(extra, long + 1), ids[extra * (long + 1):].reshape(lanes - extra, long)
    for lane, step in ((first, table[:, :extra]), (rest, table[:long, extra:])):
        if back is None:
            step[...] = lane.T
        else:
            lane[...] = step.T
    return table


def encode_ids(ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(words of each lane, words of all lanes one after the other)."""
    lanes, length = _shape(len(ids))
    steps = _steps(lanes, ids)
    model = Model(size, lanes)
    low, rng = np.zeros(lanes, U), np.full(lanes, (1 << 48) - 1, U)
    out_lane, out_word = [], []

    def put(at, begin: np.ndarray, width: np.ndarray, bits: int) -> None:
        """`at`: lanes, or a slice of them."""
        r = rng[at] >> U(bits)
        l2, g2 = low[at] + r * begin, r * width
        more = np.flatnonzero(g2 < U(1 << 32))
        if len(more):
            lm = l2[more]
            out_lane.append((more if isinstance(at, slice) else at[more]).astype(np.uint16))
            out_word.append((lm >> U(32)).astype(np.int64))
            l2[more] = (lm & U(0xFFFFFFFF)) << U(16)
            g2[more] <<= U(16)
        low[at], rng[at] = l2, g2

    every = np.arange(lanes)
    for t in range(int(length[0]) if len(ids) else 0):
        m = int(np.count_nonzero(length > t))
        now = steps[t, :m].astype(np.int64)
        model.guess(m)
        hit = model.a == now
        p = model.prob.astype(U)
        case = model.ctx << 1 | hit
        begin, width = np.stack([p, np.zeros_like(p)], 1).ravel(), np.stack([U(_ONE) - p, p], 1).ravel()
        put(slice(0, m), begin.take(case), width.take(case), P_BITS)
        left = np.flatnonzero(~hit)
        at = left[~model.same[left]]
        hit_b = model.b[at] == now[at]
        p = model.guess_second(at).astype(U)
        put(at, np.where(hit_b, U(0), p), np.where(hit_b, p, U(_ONE) - p), P_BITS)
        miss = ~hit
        miss[at[hit_b]] = False
        left = np.flatnonzero(miss)
        x = now[left]
        put(left, model.cum.take(x), model.width.take(x), SUM_BITS)
        model.learn(now, hit, hit_b)
    for _ in range(3):
        out_lane.append(every.astype(np.uint16))
        out_word.append((low >> U(32)).astype(np.int64))
        low = (low & U(0xFFFFFFFF)) << U(16)
    lane, word = np.concatenate(out_lane), np.concatenate(out_word)
    order = np.argsort(lane, kind="stable")
    word = word[order]
    while (carry := word >> 16).any():
        word &= 0xFFFF
        word[:-1] += carry[1:]
    return np.bincount(lane, minlength=lanes), word.astype("<u2")


def decode_ids(n: int, size: int, per_lane: np.ndarray, words: np.ndarray) -> np.ndarray:
    lanes, length = _shape(n)
    ids = np.empty(n, np.int64)
    steps = np.empty((n // lanes + 1, lanes), np.int64)
    model = Model(size, lanes, inverse=True)
    words = np.concatenate([words, np.zeros(1, "<u2")]).astype(U)
    ptr = np.concatenate([[0], np.cumsum(per_lane)])[:-1].astype(np.int64)
    code = words[ptr] << U(32) | words[ptr + 1] << U(16) | words[ptr + 2] if n else np.zeros(lanes, U)
    ptr += 3
    rng = np.full(lanes, (1 << 48) - 1, U)

    def take(at, r: np.ndarray, begin: np.ndarray, width: np.ndarray) -> None:
        """`at`: lanes, or a slice of them."""
        c2, g2 = code[at] - r * begin, r * width
        more = np.flatnonzero(g2 < U(1 << 32))
        if len(more):
            who = more if isinstance(at, slice) else at[more]
            c2[more] = c2[more] << U(16) | words[ptr[who]]
            g2[more] <<= U(16)
            ptr[who] += 1
        code[at], rng[at] = c2, g2

    for t in range(int(length[0]) if n else 0):
        m = int(np.count_nonzero(length > t))
        model.guess(m)

        def decide(at, p: np.ndarray) -> np.ndarray:
            p, r = p.astype(U), rng[at] >> U(P_BITS)
            hit = code[at] < r * p
            take(at, r, np.where(hit, U(0), p), np.where(hit, p, U(_ONE) - p))
            return hit

        hit = decide(slice(0, m), model.prob.take(model.ctx))
        now = np.where(hit, model.a, 0).astype(np.int64)
        left = np.flatnonzero(~hit)
        at = left[~model.same[left]]
        hit_b = decide(at, model.guess_second(at))
        right = at[hit_b]
        now[right] = model.b[right]
        miss = ~hit
        miss[right] = False
        left = np.flatnonzero(miss)
        r = rng[left] >> U(SUM_BITS)
        x = model.find(code[left] // r)
        now[left] = x
        take(left, r, model.cum.take(x), model.width.take(x))
        model.learn(now, hit, hit_b)
        steps[t, :m] = now
    _steps(lanes, ids, steps)
    return ids


def pack_block(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, size: int) -> bytes:
    """One block of whole documents: `ids` one after the other, each below `size`."""
    per_lane, words = encode_ids(ids, size)
    head = zlib.compress(
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes()
        + np.array([d is None for d in doc_ids], "u1").tobytes() + np.asarray(lengths, "<u4").tobytes()
    )
    body = MAGIC + struct.pack("<IQIII", len(doc_ids), len(ids), size, len(head), len(per_lane)) + head
    body += per_lane.astype("<u4").tobytes() + words.tobytes()
    return body + struct.pack("<I", zlib.crc32(body))


def unpack_block(block: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(document ids, lengths, ids); a block that is not whole is refused."""
    if block[:4] != MAGIC or zlib.crc32(block[:-4]) != struct.unpack("<I", block[-4:])[0]:
        raise ValueError("damaged block of token ids")
    docs, n, size, packed, lanes = struct.unpack_from("<IQIII", block, 4)
    at = 4 + struct.calcsize("<IQIII")
    head = zlib.decompress(block[at: at + packed])
    who, null = np.frombuffer(head, "<i8", docs), np.frombuffer(head, "u1", docs, 8 * docs)
    lengths = np.frombuffer(head, "<u4", docs, 9 * docs).astype(np.int64)
    per_lane = np.frombuffer(block, "<u4", lanes, at + packed).astype(np.int64)
    words = np.frombuffer(block[at + packed + 4 * lanes: -4], "<u2")
    return [None if z else w for w, z in zip(who.tolist(), null.tolist())], lengths, decode_ids(n, size, per_lane, words)

"""A context-mixing range coder for token ids, many blocks side by side.

A segment has a model that its blocks share and none of them changes: how often
each id occurs (order 0), and the id that most often follows each id, with a class
of how sure that is (order 1). Every block starts from that model, an empty memory
of what followed two ids (order 2) and the same adaptive state, so blocks are
coded and read on their own. All blocks of a segment are worked on in step: lane
k of every array belongs to block k, and one numpy operation advances all blocks
by one id. Only whole numbers are used, so a reader on another machine takes
the same decisions.

An id is one three-way decision: the id that followed the last two ids before,
else the one that mostly follows the last id, else neither, and then its place
among the order-0 frequencies, all in one division of the interval. The
probabilities of the three mix two adaptive estimates, one by the predictions'
confidence and one by the recent answers, with a weight that learns. An estimate
is one number that holds the first two probabilities in two fields, so that both
are mixed and moved by the same operations; the third is what they leave.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

BITS = 15  # estimates are fractions of 1 << BITS
CODED = 12  # probabilities are coded as fractions of 1 << CODED
FIELD = 16  # order 2's probability is below this bit, order 1's from it on
LOW_FIELD = (1 << FIELD) - 1
FAST, SLOW = 4, 5  # an answer moves an estimate by 1 / 16, 1 / 32
# added to the field of an answer; below 1 / 16, so that "neither" keeps a part
STEP = (1 << BITS - FAST) - 8
WEIGHT_BITS, MIX_BITS = 12, 4  # of the weight as it is learned, and as it is used
SLOTS = 1 << 10  # remembered pairs of ids per block
HASH_SHIFT = 32 - 10
CLASSES = 8
# the interval lies in WINDOW bits, and the WORD uppermost leave once it is below BOTTOM
WINDOW, WORD = 63, np.uint64(32)
KEPT = np.uint64(31)
BOTTOM, BELOW = np.uint64(1 << 31), np.uint64((1 << 31) - 1)
MOST_SYMBOLS = 1 << 31 - CODED  # an interval of BOTTOM has room for each
# A prediction is one number: its symbol above NOTE_BITS bits. Of order 2 these hold the
# confidence (1 to 7) and that there is one, of order 1 how sure it is.
NOTE_BITS = 7
CONFIDENCE, PREDICTS, SURE = 7 << 4, 2, 7 << 1
FOLLOWER_BITS = 20
FOLLOWERS = (1 << FOLLOWER_BITS) - 1
NO_PREDICTION = MOST_SYMBOLS << NOTE_BITS
# the notes of order 2 after an answer, by its confidence and if it was right: raised when
# right; halved when wrong, or a new prediction's, where there was none or that of 1
NEXT_NOTE = np.array([[max(1, c >> 1) << 4 | PREDICTS, min(c + 1, 7) << 4 | PREDICTS]
                      for c in range(8)], np.int32).ravel()


@dataclass
class Model:
    """What the blocks of a segment share; symbols number its ids from 0."""

    ids: np.ndarray  # id of each symbol, ascending
    starts: np.ndarray  # order 0: cumulative frequencies, one more than symbols
    follower: np.ndarray  # order 1: the symbol that mostly follows
    sure: np.ndarray  # 0 to CLASSES - 1: how often it does

    @property
    def total_bits(self) -> int:
        return int(self.starts[-1]).bit_length() - 1

    @classmethod
    def of(cls, ids: np.ndarray) -> tuple[Model, np.ndarray]:
        """The model of a segment's ids, and the ids as symbols."""
        counts = np.bincount(ids)
        known = np.nonzero(counts)[0]
        number = np.zeros(len(counts), np.int32)
        number[known] = np.arange(len(known))
        counts, symbols, n = counts[known], number.take(ids), len(known)
        if n > MOST_SYMBOLS:
            raise ValueError(f"{n} different ids in a segment, at most {MOST_SYMBOLS} can be coded")
        bits = max(16, min(n.bit_length() + 2, 31 - CODED))
        sizes = 1 + counts * ((1 << bits) - n) // len(ids)
        sizes[np.argmax(counts)] += (1 << bits) - sizes.sum()
        follower, hits = np.zeros(n, np.int64), np.zeros(n, np.int64)
        if len(symbols) > 1:
            pairs = symbols[:-1] * (np.int32(n) if n * n < 1 << 31 else np.int64(n))
            pairs += symbols[1:]
            pairs.sort()
            ends = np.append(np.flatnonzero(pairs[1:] != pairs[:-1]), len(pairs) - 1)
            times, (first, second) = np.diff(ends, prepend=-1), np.divmod(pairs[ends].astype(np.int64), n)
            # the most frequent second symbol of each first, the smaller of two alike
            groups = np.flatnonzero(np.diff(first, prepend=-1))
            best = np.maximum.reduceat(times << FOLLOWER_BITS | FOLLOWERS - second, groups)
            first = first[groups]
            follower[first], hits[first] = FOLLOWERS - (best & FOLLOWERS), best >> FOLLOWER_BITS
        sure = np.minimum(CLASSES - 1, hits * 2 * CLASSES // np.maximum(1, counts))
        starts = np.concatenate([[0], np.cumsum(sizes)])
        return cls(known, starts, follower, sure), symbols

    def dumps(self) -> bytes:
        parts = [np.diff(self.ids, prepend=0), np.diff(self.starts), self.follower, self.sure]
        return zlib.compress(b"".join(x.astype("<u4").tobytes() for x in parts), 6)

    @classmethod
    def loads(cls, data: bytes) -> Model:
        ids, sizes, follower, sure = np.frombuffer(zlib.decompress(data), "<u4").astype(
            np.int64).reshape(4, -1)
        return cls(np.cumsum(ids), np.concatenate([[0], np.cumsum(sizes)]), follower, sure)


class _Lanes:
    """Range coder states of all blocks; WORD bits enter or leave at a time, at most once
    an id. A writer's words keep the carries into the word before until the end; a
    reader's ``low`` is where the code lies inside the interval. Words of one number
    lie side by side for all lanes."""

    def __init__(self, lanes: int, steps: int, data: list[np.ndarray] | None = None):
        self.n = lanes
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, np.uint64(1 << WINDOW))
        self.at = np.arange(lanes)
        self.reads = data is not None
        if self.reads:
            words = np.zeros((lanes, max(map(len, data), default=0) + 2), np.uint64)
            for k, d in enumerate(data):
                words[k, :len(d)] = d
            words = np.ascontiguousarray(words.T)
            self.low |= words[0] >> (WORD - KEPT) << WORD
            # the first KEPT bits are in, so a word begins inside a word of the data
            words[:-1] = words[:-1] << KEPT | words[1:] >> (WORD - KEPT)
            words &= np.uint64(0xFFFFFFFF)
            self.low |= words[0]
            self.words = words.reshape(-1).view(np.int64)
            self.at += lanes
        else:  # memory that no word is written to is never taken
            self.words = np.zeros((steps + 1) * lanes, np.uint64)

    def value(self, bits: int) -> np.ndarray:
        """Where in 0 .. 2 ** bits the code lies inside the lanes' intervals."""
        part = self.low // (self.range >> np.uint64(bits))
        return np.minimum(part, np.uint64((1 << bits) - 1), out=part).astype(np.int32)

    def narrow(self, start: np.ndarray, size: np.ndarray, bits: int) -> None:
        """To a part of 2 ** bits, then move a word in or out of the lanes that have to."""
        low, span = self.low, self.range
        span >>= np.uint64(bits)
        start = start.astype(np.uint64)
        start *= span
        span *= size.astype(np.uint64)
        if self.reads:
            low -= start
        else:
            low += start
        moves = (span < BOTTOM).view(np.int8).astype(np.int64)
        by = (moves << 5).view(np.uint64)
        if self.reads:  # past the end only if the data are not what was written
            word = self.words.take(self.at, mode="clip")
            word &= -moves
            low <<= by
            low |= word.view(np.uint64)
        else:  # what a lane that does not move writes here is written over later
            self.words[self.at] = low >> KEPT
            low &= (moves - 1).view(np.uint64) | BELOW
            low <<= by
        span <<= by
        moves *= self.n
        self.at += moves

    def finish(self) -> list[bytes]:
        # one more word is inside every interval, whatever follows it
        self.words[self.at] = (self.low + BELOW) >> KEPT
        sizes = self.at // self.n + 1
        words = self.words.reshape(-1, self.n)[:sizes.max(initial=0)]
        for k in range(len(words) - 1, 0, -1):
            carry = words[k] >> WORD
            carry[sizes <= k] = 0
            words[k - 1] += carry
        words = np.ascontiguousarray(words.T.astype("<u4"))  # without the carries
        return [words[k, :size].tobytes() for k, size in enumerate(sizes)]


class _Estimate:
    """Adaptive probabilities of order 2 and order 1 by a context, for every lane; those
    of a context lie side by side, as most lanes are in one of a few.

    A context in which an order makes no prediction of its own starts, and so
    stays, at 0 for it; no other field ever gets to 0."""

    def __init__(self, lanes: int, start: np.ndarray, rate: int):
        self.n, self.lanes = lanes, np.arange(lanes, dtype=np.int32)
        self.table = np.repeat(start.astype(np.int32), lanes)
        self.rate = rate

    def ask(self, context: np.ndarray) -> np.ndarray:
        """Both fields of all lanes, one after the other."""
        context *= self.n
        context += self.lanes
        self.at = context.astype(np.int64)
        self.held = self.table.take(self.at, mode="clip").view(np.int16)
        return self.held

    def learn(self, step: np.ndarray) -> None:
        """``step``: STEP in the answer's field, scaled to the rate."""
        moved = self.held >> self.rate
        np.subtract(self.held, moved, out=moved)
        moved += step
        self.table[self.at] = moved.view(np.int32)


def _starts(order2: np.ndarray, order1: np.ndarray) -> np.ndarray:
    """Estimates to begin with, given in sixty-fourths."""
    return order2 << BITS - 6 | order1 << BITS - 6 + FIELD


def _work(coder: _Lanes, n: int, steps: int, model: Model,
          symbols: np.ndarray | None) -> np.ndarray | None:
    """Code ``symbols``, or read ``steps`` ids in each of ``n`` lanes. Choices between arrays
    are made by masks of all bits, several times faster than ``np.where``."""
    zero_bits = model.total_bits
    bits = CODED + zero_bits
    if symbols is not None:
        symbols = np.ascontiguousarray(symbols.T)
    else:  # symbol at every place of the order-0 frequencies
        found = np.zeros((steps, n), np.int32)
        place_of = np.repeat(np.arange(len(model.ids), dtype=np.int32), np.diff(model.starts))
    starts = model.starts[:-1].astype(np.int32)
    frequency = np.diff(model.starts).astype(np.int32)
    follower = ((model.follower << NOTE_BITS) | (model.sure << 1)).astype(np.int32)
    memory = np.full(n * SLOTS, NO_PREDICTION, np.int32)
    lanes = np.arange(n)
    # contexts: confidence of order 2, how sure order 1 is, and if both predict the same
    c = np.arange(CONFIDENCE + 16)
    by_sure = _Estimate(n, _starts(c >> 4 << 2, ~c % 2 * (2 * (c & SURE) + 1)), FAST)
    # and: the last two answers, if order 2 predicts, if both predict the same
    c = np.arange(64)
    by_answers = _Estimate(n, _starts((c & PREDICTS) << 2, ~c % 2 << 3), SLOW)
    weight = np.full(n, 1 << WEIGHT_BITS - 1, np.int32)  # of by_sure
    ones = (1 << BITS) - 1
    ones |= ones << FIELD
    step_fast, step_slow = STEP | STEP << FIELD, STEP >> 1 | STEP >> 1 << FIELD
    index, before = np.zeros(n, np.int64), np.zeros(n, np.uint32)
    last, recent = np.zeros(n, np.int32), np.zeros(n, np.int32)
    for t in range(steps):
        pair = last.view(np.uint32) * np.uint32(2654435769)
        pair += before
        pair >>= HASH_SHIFT
        place = pair.astype(np.int64)
        place *= n
        place += lanes
        held, known = memory.take(place, mode="clip"), follower.take(index, mode="clip")
        p2, p1 = held >> NOTE_BITS, known >> NOTE_BITS
        same = (p1 == p2).view(np.int8).astype(np.int32)
        trust = held & CONFIDENCE
        known &= SURE
        known |= trust
        known |= same
        p = by_sure.ask(known)
        held &= PREDICTS
        held |= recent
        held |= same
        q = by_answers.ask(held)
        apart = q - p
        part = weight >> WEIGHT_BITS - MIX_BITS
        part |= part << FIELD
        part = part.view(np.int16) * (apart >> MIX_BITS)
        mixed = q - part  # never less than both, or 0
        first = (mixed >> BITS - CODED).view(np.int32)
        second = first >> FIELD
        first &= LOW_FIELD
        rest = first + second
        left = (1 << CODED) - rest
        if symbols is not None:
            got = symbols[t]
            all2 = -(got == p2).view(np.int8).astype(np.int32)
            all1 = -(got == p1).view(np.int8).astype(np.int32)
            all1 &= ~all2
            neither = ~(all2 | all1)
            index = got.astype(np.int64)
        else:
            v = coder.value(bits)
            over = v - (rest << zero_bits)
            neither = ~(over >> 31)
            over &= neither
            all2 = (v >> zero_bits) - first >> 31
            all1 = ~(all2 | neither)
            got = place_of.take(over // left, mode="clip")
            got &= neither
            got |= p2 & all2
            got |= p1 & all1
            index = got.astype(np.int64)
            found[t] = got
        # order 2 has the first part of the interval, order 1 the second
        start = first & all1
        start |= rest & neither
        start <<= zero_bits
        first &= all2
        second &= all1
        first |= second
        first <<= zero_bits
        left &= neither
        start += left * starts.take(index, mode="clip")
        left *= frequency.take(index, mode="clip")
        left += first
        coder.narrow(start, left, bits)
        answer = all1 << FIELD
        answer |= all2 & LOW_FIELD  # all bits of the answer's field
        by_sure.learn((answer & step_fast).view(np.int16))
        by_answers.learn((answer & step_slow).view(np.int16))
        # towards the estimate that said more of the answer, by how far the mix was off
        off = mixed - (answer & ones).view(np.int16)
        off >>= 8
        apart >>= 8
        off *= apart
        both = off.view(np.int32)
        both += both << FIELD  # the upper field is the sum of both
        both >>= FIELD + 3
        weight += both
        np.maximum(weight, 0, out=weight)
        np.minimum(weight, 1 << WEIGHT_BITS, out=weight)
        # a prediction of more than the least confidence outlives a wrong answer
        kept = got ^ p2
        kept &= 16 - trust >> 31
        kept ^= got
        kept <<= NOTE_BITS
        trust >>= 3
        trust -= all2
        kept |= NEXT_NOTE.take(trust, mode="clip")
        memory[place] = kept
        recent &= 12
        recent <<= 2
        all2 &= 8
        all1 &= 4
        recent |= all2
        recent |= all1
        before = last.view(np.uint32) * np.uint32(2246822519)
        last = got
    return None if symbols is not None else found.T


def encode_blocks(ids: np.ndarray, block: int) -> tuple[bytes, list[tuple[int, int, bytes]]]:
    """The shared model, and (number of ids, crc32 of the ids as uint32, data) of
    each block; the last block is filled up with the first symbol."""
    if not len(ids):
        return b"", []
    model, symbols = Model.of(ids)
    n = -(-len(ids) // block)
    sizes = np.full(n, block)
    sizes[-1] = len(ids) - block * (n - 1)
    padded = np.zeros(n * block, np.int32)
    padded[:len(ids)] = symbols
    coder = _Lanes(n, block)
    _work(coder, n, block, model, padded.reshape(n, block))
    raw = ids.astype("<u4")
    return model.dumps(), [
        (int(sizes[k]), zlib.crc32(raw[k * block:k * block + int(sizes[k])].tobytes()), d)
        for k, d in enumerate(coder.finish())]


def decode_blocks(model: bytes, blocks: list[tuple[int, int, bytes]]) -> np.ndarray:
    """The ids of all blocks, in order; raises if a checksum does not hold.

    All blocks but the last have one size, the last is not larger. Any of the
    blocks can be read alone."""
    if not blocks:
        return np.empty(0, "<u4")
    shared = Model.loads(model)
    sizes = np.array([n for n, _, _ in blocks])
    coder = _Lanes(len(blocks), int(sizes[0]), [np.frombuffer(d, "<u4") for _, _, d in blocks])
    found = shared.ids.take(_work(coder, len(sizes), int(sizes[0]), shared, None)).astype("<u4")
    for k, (n, crc, _) in enumerate(blocks):
        if zlib.crc32(found[k, :n].tobytes()) != crc:
            raise ValueError(f"block {k}: checksum does not hold")
    return np.concatenate([found[k, :n] for k, n in enumerate(sizes)])

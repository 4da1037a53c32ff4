"""Context-mixing range coder for token ids, many blocks in step.

Every block is coded on its own. Its payload starts with the block's distinct
ids and how often each occurs; its ids follow in their order, range coded.
Three predictions of the next id are added up: order 0 gives every id a share
by its count in the block, order 1 gives one to the id that followed the last
id before, order 2 to the id that followed the last two. An id that several of
them foretell has the sum of its shares. How much orders 1 and 2 get is learnt,
by how often each has held of late and whether they agree. The predictions of
both and all their weights are renewed after every id.

Inside a block an id goes by its place: the sum of the counts of all smaller
ids. So the places are the lower ends of order 0's shares, too. The same model
code drives encoder and decoder. Blocks are columns of numpy arrays, so one
step handles one id of each of a thousand blocks.
"""

from __future__ import annotations

import numpy as np

#: Shares of a prediction are out of this.
TOTAL_BITS = 20
TOTAL = 1 << TOTAL_BITS
#: Ids are below this.
ID_BITS = 16
#: The range stays above the floor, so that one word a step is enough to widen it. Numbers up to the ceiling are whole and exact in doubles.
FLOOR, CEILING, WORD = 2.0**32, 2.0**48, 2.0**16
#: Ids of a block at most.
LONGEST_BITS = 12
LONGEST = 1 << LONGEST_BITS
PLACE = LONGEST - 1
#: Blocks whose headings are made together, so that they stay in the processor's memory; numbers of ids counted together there.
GROUP, COUNTED = 64, 1 << 18
#: Slots of order 2.
SLOTS, FACTOR = 1024, 2377
#: A prediction is an integer of the id that it foretells, how many times in a row it has held, up to three, and the last id; with a slot that fixes the one before it. None yet is 0.
ONCE, SURE, LAST_BITS = np.int32(1 << LONGEST_BITS), np.int32(3 << LONGEST_BITS), LONGEST_BITS + 2
CAP = SURE - ONCE
#: Two weights share an integer, order 2's above order 1's. Each is out of 32,768 and counts ``WEIGHT`` times in ``TOTAL``; every id takes a 32nd of both and adds ``HIT`` to the one that foretold it.
#: Both together stay so low that order 0 keeps a sixteenth of the range, and each id at least 16 shares, which the widening needs.
WEIGHT, RATE, HIT_1 = np.int32(30), 5, 1022
HIT_2, FALL, LOW15 = HIT_1 << 16, 0x03FF03FF, 0x7FFF


def _priors() -> np.ndarray:
    """Weights before anything is learnt, by how sure order 2 is, how sure order 1 is, and whether they agree."""
    found = np.zeros((4, 4, 2), np.int32)
    for sure_2, sure_1, agree in np.ndindex(found.shape):
        two = (0, (0.06, 0.10)[agree] if sure_1 < 2 else (0.16, 0.6)[agree], 0.6, 0.95)[sure_2]
        one = 0 if agree else (0, 0.04, 0.2, 0.6)[sure_1] * (1 - two)
        found[sure_2, sure_1, agree] = int(32000 * two) << 16 | int(32000 * one)
    return found.ravel()


PRIORS = _priors()
CONTEXTS = len(PRIORS)


class Encoder:
    def __init__(self, lanes: int, longest: int):
        self.low, self.range = np.zeros(lanes), np.full(lanes, CEILING)
        #: The word of each step and lane, if the range is widened there.
        self.words, self.wide = np.zeros((longest, lanes), np.int32), np.zeros((longest, lanes), bool)

    def code(self, step, n, unit, below, size):
        """Code the share from ``below``, of ``size`` / TOTAL, in the first ``n`` lanes."""
        span = size * unit
        wide = np.less(span, FLOOR, out=self.wide[step, :n])
        low = self.low[:n]
        low += below * unit
        # The word may hold a carry, which ``finish`` moves to the words before it.
        word = np.floor(low * (1 / FLOOR))
        word *= wide
        self.words[step, :n] = word
        wider = np.where(wide, WORD, 1.0)
        word *= FLOOR
        low -= word
        low *= wider
        np.multiply(span, wider, out=self.range[:n])

    def finish(self) -> list[bytes]:
        low, out = self.low.astype(np.int64).tolist(), []
        for start in range(0, len(low), GROUP):
            words, wide = (np.ascontiguousarray(x[:, start : start + GROUP].T) for x in (self.words, self.wide))
            for row, kept, rest in zip(words, wide, low[start : start + GROUP], strict=True):
                found = np.append(row[kept], np.array([rest >> 32, rest >> 16 & 0xFFFF, rest & 0xFFFF], np.int32))
                while (carry := found >> 16).any():
                    found &= 0xFFFF
                    found[:-1] += carry[1:]
                out.append(found.astype(">u2").tobytes())
        return out


class Decoder:
    def __init__(self, payloads: list[bytes]):
        lanes, width = len(payloads), max(3, max(map(len, payloads)) // 2) + 1
        data = np.zeros((lanes, width), np.uint16)
        for i, p in enumerate(payloads):
            data[i, : len(p) // 2] = np.frombuffer(p, ">u2", len(p) // 2)
        self.range = np.full(lanes, CEILING)
        #: How far the written number lies above the range's lower end.
        self.above = data[:, :3] @ np.array([FLOOR, WORD, 1.0])
        self.data, self.at = data.ravel(), np.arange(lanes) * width + 3

    def place(self, n, unit):
        # Exact: a quotient's distance from a whole number is over its rounding.
        return np.minimum(self.above[:n] / unit, TOTAL - 1).astype(np.int32)

    def code(self, step, n, unit, below, size):
        span = size * unit
        wide = span < FLOOR
        wider = np.where(wide, WORD, 1.0)
        above, at = self.above[:n], self.at[:n]
        above -= below * unit
        above *= wider
        above += self.data.take(at, mode="clip") * wide
        at += wide
        np.multiply(span, wider, out=self.range[:n])


def run(coder, lengths: np.ndarray, places: np.ndarray, counts: np.ndarray | None = None, shares: np.ndarray | None = None) -> None:
    """Code blocks in step; ``lengths`` fall.

    ``places`` is (longest, lanes), which a decoder fills, and so is
    ``counts``, which an encoder needs. A decoder needs ``shares``, (lanes,
    longest): for every place of a block's ids in ascending order the id's own
    place and, above it, its count.
    """
    longest, lanes = places.shape
    kept = np.zeros(lanes * (longest + SLOTS), np.int32)  # order 1's predictions, order 2's
    weights = np.tile(PRIORS, lanes)
    every = np.arange(lanes)
    one, mixed = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
    done = 0
    for last in np.unique(lengths):
        n = int(np.searchsorted(-lengths, -last, side="right"))
        row, row_2, row_c = every[:n] * longest, lanes * longest + every[:n] * SLOTS, every[:n] * CONTEXTS
        part, full = 1 / np.maximum(lengths[:n], 1), lengths[n - 1] == LONGEST
        one, mixed = one[:n], mixed[:n]
        slots, by = np.zeros(2 * n, np.int64), np.zeros((2, n), np.int32)
        slot_1, slot_2, by_1, by_2 = slots[:n], slots[n:], *by
        for step in range(done, last):
            # What the orders foretell.
            np.add(row, one, out=slot_1)
            np.add(row_2, one + mixed & SLOTS - 1, out=slot_2)
            known = kept.take(slots).reshape(2, n)
            known_1, known_2 = known
            known_2 *= known_2 >> LAST_BITS == one
            told = known & PLACE
            b, a = told
            context = row_c + ((known_2 >> LONGEST_BITS - 3 & 24) + (known_1 >> LONGEST_BITS - 1 & 6) + (a == b))
            # How they share the range.
            weight = weights.take(context)
            np.multiply(weight >> 16, WEIGHT, out=by_2)
            np.multiply(weight & LOW15, WEIGHT, out=by_1)
            each = TOTAL - by_1 - by_2
            each = each >> LONGEST_BITS if full else (each * part).astype(np.int32)
            unit = np.floor(coder.range[:n] * (1 / TOTAL))
            # An id's other shares lie before those of its count.
            if shares is not None:
                value = coder.place(n, unit)
                value = np.maximum(np.minimum(value, b * each + by_2 * (a < b)), value - by_1)
                value = np.maximum(np.minimum(value, a * each), value - by_2)
                share = shares.take(row + (value / each).astype(np.int32), mode="clip")
                x, count = share & PLACE, share >> LONGEST_BITS
                places[step, :n] = x
            else:
                x, count = places[step, :n].astype(np.int32), counts[step, :n].astype(np.int32)
            hit = (told == x).astype(np.int32)
            low_1, low_2 = by * (told < x)
            size_1, size_2 = by * hit
            coder.code(step, n, unit, x * each + low_1 + low_2, count * each + size_1 + size_2)
            # What is learnt from it.
            hit_1, hit_2 = hit
            weight -= weight >> RATE & FALL
            weight += hit_2 * HIT_2 + (hit_1 & ~hit_2) * HIT_1
            weights[context] = weight
            now = np.minimum(known & SURE, CAP) * hit
            now += (one << LAST_BITS) + x + ONCE
            kept[slots] = now.ravel()
            mixed, one = one * FACTOR, x
        done = last


#: The place of the top bit of each number.
TOP = np.frexp(np.arange(1, (1 << ID_BITS) + 1))[1].astype(np.uint8) - np.uint8(1)


def _low_bits(tops: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of all bits below the tops of numbers, the highest first; how far each has to be shifted); a number's bits begin at its start."""
    ends = np.cumsum(tops)
    left = np.repeat(ends, tops)
    left -= np.arange(1, len(left) + 1)
    return np.repeat(starts + tops - 1, tops) - left, left


def _inside(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums before each value, anew in each run of ``sizes`` values."""
    before = np.cumsum(values) - values
    return before - np.repeat(before[np.minimum(np.cumsum(sizes) - sizes, len(values) - 1)], sizes) if len(values) else before


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    whole = np.append(0, np.cumsum(values))
    ends = np.cumsum(sizes)
    return whole[ends] - whole[ends - sizes]


def _headings(distinct: np.ndarray, counts: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """For each block its number of ids and the first of them; the top bits of the gaps between them, from a gap of one on, in four bits each; those of the counts as that many zeros and a one; the bits below the tops of gaps and of counts.

    The ascending ids and their counts are those of all blocks, end to end.
    """
    gaps, first = np.diff(distinct, prepend=-1), (np.cumsum(sizes) - sizes)[sizes > 0]
    gaps[first] = 1
    begin = sizes << 16
    begin[sizes > 0] |= distinct[first]
    tops = [TOP[x - 1].astype(np.int64) for x in (gaps, counts)]
    parts = [np.full(len(sizes), 32), 4 * sizes, _sums(tops[1] + 1, sizes), *(_sums(t, sizes) for t in tops)]
    length = (sum(parts) + 7) // 8
    starts = 8 * (np.cumsum(length) - length) + np.cumsum([0 * sizes, *parts[:-1]], axis=0)
    bits = np.zeros(8 * int(length.sum()), np.uint8)
    bits[starts[0][:, None] + np.arange(32)] = begin[:, None] >> np.arange(31, -1, -1) & 1
    bits[(np.repeat(starts[1], sizes) + _inside(np.full(len(gaps), 4), sizes))[:, None] + np.arange(4)] = tops[0][:, None] >> np.arange(3, -1, -1) & 1
    bits[np.repeat(starts[2], sizes) + _inside(tops[1] + 1, sizes) + tops[1]] = 1
    for numbers, top, start in zip((gaps, counts), tops, starts[3:], strict=True):
        at, left = _low_bits(top, np.repeat(start, sizes) + _inside(top, sizes))
        bits[at] = np.repeat(numbers, top) >> left & 1
    raw = np.packbits(bits).tobytes()
    return [raw[end - size : end] for end, size in zip(np.cumsum(length).tolist(), length.tolist(), strict=True)]


def _headed(payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """(ascending ids and their counts, of all blocks end to end; how many each block has; the rests of the payloads)."""
    sizes = np.array([int.from_bytes(p[:2], "big") for p in payloads])
    heads = [p[: 4 + n // 2 + (LONGEST + 24 * n) // 8 + 2] for p, n in zip(payloads, sizes.tolist(), strict=True)]
    length = np.array([*map(len, heads)])
    first = 8 * (np.cumsum(length) - length)
    bits = np.unpackbits(np.frombuffer(b"".join(heads), np.uint8))
    begin = np.repeat(first + 32, sizes) + 4 * _inside(np.ones(sizes.sum(), np.int64), sizes)
    top_gaps = bits[begin[:, None] + np.arange(4)] @ np.array([8, 4, 2, 1])
    ones, start = np.flatnonzero(bits.view(bool)), first + 32 + 4 * sizes
    mark = ones[np.repeat(np.searchsorted(ones, start), sizes) + _inside(np.ones(len(begin), np.int64), sizes)]
    top_counts = np.diff(mark, prepend=-1) - 1
    at = (np.cumsum(sizes) - sizes)[sizes > 0]
    top_counts[at] = mark[at] - start[sizes > 0]
    start = start + _sums(top_counts + 1, sizes)
    numbers = []
    for top in (top_gaps, top_counts):
        places, left = _low_bits(top, np.repeat(start, sizes) + _inside(top, sizes))
        numbers.append((1 << top) + _sums(bits[places].astype(np.int64) << left, top))
        start = start + _sums(top, sizes)
    least = np.array([int.from_bytes(p[2:4], "big") for p in payloads])
    distinct = np.repeat(least, sizes) + _inside(numbers[0], sizes) + numbers[0] - 1
    return distinct, numbers[1], sizes, [p[end:] for p, end in zip(payloads, ((start - first + 7) // 8).tolist(), strict=True)]


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Code each block of at most ``LONGEST`` ids below 65,536 on its own; all of them in step."""
    if not blocks:
        return []
    if any(len(b) > LONGEST or (len(b) and b.max() >> ID_BITS) for b in blocks):
        raise ValueError(f"a block has at most {LONGEST} ids, all below 65,536")
    order = np.argsort([-len(b) for b in blocks], kind="stable")
    lengths = np.array([len(blocks[i]) for i in order])
    places, counts = np.zeros((2, lengths[0], len(blocks)), np.int16)
    seen = np.zeros(1 << ID_BITS, bool)
    for block in blocks:
        seen[block] = True
    ids = np.flatnonzero(seen)
    rank = np.cumsum(seen) - 1
    group, headings = min(GROUP, max(1, COUNTED // max(1, len(ids)))), []
    for start in range(0, len(order), group):
        some, size = order[start : start + group], lengths[start : start + group]
        # Every block's ids are counted in a row of their own.
        key = rank.take(np.concatenate([blocks[i] for i in some]))
        key += np.repeat(np.arange(len(some)) * len(ids), size)
        times = np.bincount(key, minlength=len(some) * len(ids)).reshape(len(some), -1)
        before = (np.cumsum(times, axis=1) - times).astype(np.int16)
        held = np.arange(lengths[0]) < size[:, None]
        for out, of in ((places, before), (counts, times.astype(np.int16))):
            rows = np.zeros(held.shape, np.int16)
            rows[held] = of.take(key)
            out[:, start : start + group] = rows.T
        lane, at = np.nonzero(times)
        headings += _headings(ids[at], times[lane, at], np.bincount(lane, minlength=len(some)))
    coder = Encoder(len(blocks), int(lengths[0]))
    run(coder, lengths, places, counts)
    out: list[bytes] = [b""] * len(blocks)
    for i, heading, body in zip(order, headings, coder.finish(), strict=True):
        out[i] = heading + body
    return out


def decode_blocks(payloads: list[bytes], lengths: list[int]) -> list[np.ndarray]:
    """The inverse of ``encode_blocks``."""
    if not payloads:
        return []
    order = np.argsort([-n for n in lengths], kind="stable")
    sizes = np.array([lengths[i] for i in order])
    names, shares, bodies = np.zeros((len(payloads), sizes[0]), np.uint16), np.zeros((len(payloads), sizes[0]), np.int32), []
    for start in range(0, len(order), GROUP):
        group = slice(start, start + GROUP)
        distinct, counts, kinds, rests = _headed([payloads[i] for i in order[group]])
        if (_sums(counts, kinds) != sizes[group]).any():
            raise ValueError("a payload is damaged")
        held = np.arange(sizes[0]) < sizes[group, None]
        names[group][held] = np.repeat(distinct.astype(np.uint16), counts)
        shares[group][held] = np.repeat((_inside(counts, kinds) | counts << LONGEST_BITS).astype(np.int32), counts)
        bodies += rests
    places = np.zeros((sizes[0], len(payloads)), np.int16)
    run(Decoder(bodies), sizes, places, shares=shares.ravel())
    out: list[np.ndarray] = [names[0]] * len(payloads)
    for start in range(0, len(order), GROUP):
        found = np.ascontiguousarray(places[:, start : start + GROUP].T)
        for row, name, i in zip(found, names[start : start + GROUP], order[start : start + GROUP], strict=True):
            out[i] = name.take(row[: lengths[i]])
    return out

"""An adaptive context-mixing range coder for token ids, for many blocks side by side.

Every block starts from the same empty models, so blocks are independent: each is one lane of the arrays, and all
lanes take the same step at once. Predictions of the next id come from its order-2 context (two ids before), its
order-1 context (one id before) and order 0 (the lane's favourite). Which of them is right, if any, is one symbol of
four, whose probabilities are mixed from two contexts; a missed id follows as four hexadecimal digits under adaptive
order-0 digit models.

A model's row holds the lower edges of its symbols, of which the first is 0, in 2 bytes each: rows travel between the
tables and a step as 8-byte words, and the edge after a row's last one, ``ONE``, is the next row's 0.
"""

from __future__ import annotations

import numpy as np

PROB_BITS = 15
ONE = 1 << PROB_BITS
DIGITS = 4
_WINDOW = (1 << 48) - 1
_TOP, _BOTTOM = 1 << 32, 1 << 16
ORDER1, ORDER2 = 1 << 10, 1 << 11
# Contexts of a digit: the digits before it, of which the third is folded.
_BASE = (0, 1, 17)
_FOLDED = 512
DIGIT_CONTEXTS = 17 + 256 + _FOLDED
WHICH_CONTEXTS = 32 + 16
WORDS_PER_ID = 5
# How a prediction's sureness changes: by how sure it was where it was right, and 4 later where it was wrong.
_SURER = np.array([1, 1, 1, 0, 0, -1, -1, -1], np.int32)
_REPLACED = 4


class _Range:
    """A carry-less range coder with 48 bits of state per lane, moving 16 bits at a time. A decoder holds how far the
    code lies above the low end."""

    def __init__(self, lanes: int, size: int, words: np.ndarray | None = None) -> None:
        self.low, self.over = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.range = np.full(lanes, _WINDOW, np.int64)
        self.decoding = words is not None
        # The nth words of all lanes stand side by side: lanes advance about alike, and what none reaches is never touched.
        self.words, self.lanes = np.zeros(size * lanes, np.uint16) if words is None else words, lanes
        self.at = np.arange(lanes)
        self.whole = self.low, self.at
        if self.decoding:
            for _ in range(3):
                self.over = self.over << 16 | self.words.take(self.at)
                self.at += lanes

    def narrow(self, n: int) -> None:
        """The first ``n`` lanes go on."""
        if n < len(self.low):
            self.low, self.range, self.at, self.over = self.low[:n], self.range[:n], self.at[:n], self.over[:n]

    def part(self, lanes: np.ndarray) -> _Range:
        """A coder of some lanes, over the same words."""
        some = object.__new__(_Range)
        some.decoding, some.words, some.lanes, some.over = self.decoding, self.words, self.lanes, self.over
        some.low, some.range, some.at = (a.take(lanes, mode="clip") for a in (self.low, self.range, self.at))
        if self.decoding:
            some.over = self.over.take(lanes, mode="clip")
        return some

    def put(self, lanes: np.ndarray, some: _Range) -> None:
        self.low[lanes], self.range[lanes], self.at[lanes] = some.low, some.range, some.at
        if self.decoding:
            self.over[lanes] = some.over

    def values(self, dtype: type) -> np.ndarray:
        """Where the code of each lane lies in its range, from 0 to ``ONE`` - 1."""
        # Both are whole and below 2^48, and the quotient, if below 2^15, is no nearer to the next whole number than 2^-33:
        # as doubles they round to none above.
        found = self.over / (self.range >> PROB_BITS)
        return np.minimum(found, ONE - 1.0, out=found).astype(dtype)

    def code(self, edges: np.ndarray, base: np.ndarray) -> None:
        """Codes one symbol per lane, that with its lower edge at ``base`` of the flat ``edges``."""
        edge, size = edges.take(base, mode="clip"), _sizes(edges, base)
        start = edge.astype(np.int64)
        size = size.astype(np.int64)
        low, width = self.low, self.range
        width >>= PROB_BITS
        start *= width
        width *= size
        low += start
        low &= _WINDOW
        if self.decoding:
            self.over -= start
        moving = (((low ^ (low + width)) < _TOP) | (width < _BOTTOM)).nonzero()[0]
        while len(moving):
            rest_low, rest_width, place = (a.take(moving, mode="clip") for a in (low, width, self.at))
            # Carry-less: a narrow range that straddles a border is cut at it.
            tight = (rest_low ^ (rest_low + rest_width)) >= _TOP
            if tight.any():
                rest_width = np.where(tight, -rest_low & (_BOTTOM - 1), rest_width)
            if self.decoding:
                over = self.over.take(moving, mode="clip")
                over &= _TOP - 1
                over <<= 16
                over |= self.words.take(place, mode="clip")
                self.over[moving] = over
            else:
                self.words[place] = rest_low >> 32
            place += self.lanes
            rest_low &= _TOP - 1
            rest_low <<= 16
            rest_width <<= 16
            low[moving], width[moving], self.at[moving] = rest_low, rest_width, place
            more = ((rest_low ^ (rest_low + rest_width)) < _TOP) | (rest_width < _BOTTOM)
            moving = moving[more] if more.any() else ()

    def finish(self) -> list[bytes]:
        """The words of each lane."""
        low, at = self.whole
        for shift in (32, 16, 0):
            self.words[at] = low >> shift & 0xFFFF
            at += self.lanes
        sizes = at // self.lanes
        rows = self.words.reshape(-1, self.lanes)[: sizes.max()].T.astype("<u2", order="C")
        return [row[:n].tobytes() for row, n in zip(rows, sizes, strict=True)]


def _sizes(edges: np.ndarray, base: np.ndarray) -> np.ndarray:
    """How wide the symbols are whose lower edges stand at ``base``."""
    ends = edges.take(base + 1, mode="clip")
    # The end of a row's last symbol, 0 here, is ``ONE``.
    ends -= 1
    ends &= ONE - 1
    ends -= edges.take(base, mode="clip")
    return np.add(ends, 1, dtype=np.int32)


def _even(rows: int, symbols: int) -> np.ndarray:
    """Rows of equally likely symbols."""
    return np.tile((np.arange(symbols) * ONE // symbols).astype(np.int16), (rows, 1))


def _targets(symbols: int, least: int) -> np.ndarray:
    """What the edges move to when a symbol came: all but ``least`` for each other one."""
    line = np.arange(symbols)
    return (np.where(line[None, :] > line[:, None], ONE - symbols * least, 0) + least * line).astype(np.int16)


class _Models:
    """The tables of all lanes, one after the other."""

    def __init__(self, lanes: int) -> None:
        # Rows as single items: of 32 bytes and of 8.
        self.digits = _even(lanes * DIGIT_CONTEXTS, 16).view("V32")[:, 0]
        self.which = _even(lanes * WHICH_CONTEXTS, 4).view(np.int64)[:, 0]
        self.digit_target = _targets(16, 1).view("V32")[:, 0]
        self.which_target = _targets(4, 16).view(np.int64)[:, 0]
        self.weight = np.full(lanes, 1 << 15, np.int32)
        # Predicted id and, in the two low bits, how sure it is: order 2, then order 1.
        self.next = np.zeros(lanes * (ORDER2 + ORDER1), np.int32)
        self.favourite, self.votes = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
        self.one, self.two = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
        self.history = np.zeros(lanes, np.int64)
        self.rows = np.arange(lanes)
        self.start()

    def start(self) -> None:
        """Places and room for the lanes that go on."""
        n, self.places = len(self.rows), np.arange(2 * len(self.rows))
        self.next_at = np.stack([self.rows * (ORDER2 + ORDER1), self.rows * (ORDER2 + ORDER1) + ORDER2])
        self.which_at = np.stack([self.rows * WHICH_CONTEXTS, self.rows * WHICH_CONTEXTS + 32])
        self.guess = np.zeros((4, n), np.int32)
        # Rows that a step works on. The row after them gives the last one's upper edge.
        self.held, self.mixed = np.zeros(2 * n + 1, np.int64), np.zeros((n + 1, 4), np.int32)
        self.digit_held = np.zeros((n + 1, 16), np.int16)

    def narrow(self, n: int) -> None:
        """The first ``n`` lanes go on."""
        if n < len(self.rows):
            for name in ("weight", "favourite", "votes", "one", "two", "history", "rows"):
                setattr(self, name, getattr(self, name)[:n])
            self.start()


def _digits(m: _Models, r: _Range, missed: np.ndarray, wanted: np.ndarray | None) -> np.ndarray:
    """Codes whole ids of some lanes, digit by digit."""
    n = len(missed)
    some, first, line = r.part(missed), missed * DIGIT_CONTEXTS, m.places[:n] * 16
    edges = m.digit_held[: n + 1]
    edges[n] = 0
    inner, flat, rows = edges[:n], edges.reshape(-1), edges.view("V32")[:n, 0]
    value = np.zeros(n, np.int64)
    for digit in range(DIGITS):
        slot = first + (_BASE[digit] + value if digit < 3 else 273 + ((value * 40503 >> 4) & (_FOLDED - 1)))
        m.digits.take(slot, out=rows, mode="clip")
        if wanted is None:
            below = (inner <= some.values(np.int16)[:, None]).view(np.int64)
            symbol = ((below[:, 0] + below[:, 1]) * 0x0101010101010101 >> 56) - 1
        else:
            symbol = wanted >> (4 * (DIGITS - 1 - digit)) & 15
        some.code(flat, line + symbol)
        target = m.digit_target.take(symbol, mode="clip").view(np.int16).reshape(n, 16)
        target -= inner
        target >>= 5
        inner += target
        m.digits[slot] = rows
        value <<= 4
        value |= symbol
    r.put(missed, some)
    return value


def _step(m: _Models, r: _Range, ids: np.ndarray | None) -> np.ndarray:
    """Codes the next id of the lanes that go on."""
    n, one = len(m.rows), m.one * 40503
    slots = m.next_at.copy()
    slots[0] += (one + m.two * 30011 >> 5) & (ORDER2 - 1)
    slots[1] += (one >> 4) & (ORDER1 - 1)
    held, guess = m.next.take(slots, mode="clip"), m.guess
    np.right_shift(held, 2, out=guess[:2])
    guess[2] = m.favourite
    sure = held & 3
    # Which prediction is right: one symbol, mixed from two contexts.
    contexts = m.which_at.copy()
    contexts[0] += (sure[0] * 4 + sure[1]) * 2 + (guess[0] == guess[1])
    contexts[1] += m.history
    m.which.take(contexts.reshape(-1), out=m.held[:-1], mode="clip")
    cdfs = m.held.view(np.int16)
    both = cdfs[:-4].reshape(2, n, 4)
    mixed = m.mixed[:n]
    np.subtract(both[0], both[1], out=mixed)
    mixed *= m.weight[:, None]
    mixed >>= 16
    mixed += both[1]
    if ids is None:
        below = (mixed <= r.values(np.int32)[:, None]).view(np.int32).reshape(-1)
        which = (below * 0x01010101 >> 24) - 1
    else:
        wrong = (guess[:3] != ids).view(np.int8)
        which = wrong[0] * (wrong[1] * (wrong[2] + np.int8(1)) + np.int8(1))
    which = which.astype(np.int64)
    r.code(m.mixed.reshape(-1), m.places[:n] * 4 + which)
    given = _sizes(cdfs, (m.places.reshape(2, n) * 4 + which).reshape(-1))
    both += (m.which_target.take(which, mode="clip").view(np.int16).reshape(n, 4) - both) >> 5
    m.which[contexts.reshape(-1)] = m.held[:-1]
    m.weight += np.sign(given[:n] - given[n:]) * 512
    np.minimum(m.weight, (1 << 16) - 2048, out=m.weight)
    np.maximum(m.weight, 2048, out=m.weight)
    m.history <<= 2
    m.history |= which
    m.history &= 15
    missed = (which == 3).nonzero()[0]
    found = guess.reshape(-1).take(which * n + m.rows, mode="clip") if ids is None else ids
    if len(missed):
        value = _digits(m, r, missed, None if ids is None else ids.take(missed, mode="clip").astype(np.int64))
        if ids is None:
            found[missed] = value
    # What came becomes the prediction, unless a surer one stands.
    missing = guess[:3] != found
    change = sure + missing[:2] * np.int32(4)
    m.next[slots] = np.where(change == _REPLACED, found << 2, held + _SURER.take(change, mode="clip"))
    m.votes += np.int32(1) - missing[2] * np.int32(2)
    np.copyto(m.favourite, found, where=m.votes < 0)
    np.abs(m.votes, out=m.votes)
    m.two[:], m.one[:] = m.one, found
    return found


def _alive(sizes: np.ndarray) -> np.ndarray:
    """How many blocks, longest first, hold an id at each place."""
    return np.searchsorted(-sizes, -np.arange(int(sizes.max(initial=0))), side="left")


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """The coded bytes of each block of ids below 65,536."""
    sizes = np.fromiter(map(len, blocks), np.int64, len(blocks))
    if not len(blocks):
        return []
    order = np.argsort(-sizes, kind="stable")
    table = np.zeros((int(sizes.max(initial=0)), len(blocks)), np.int32)
    for row, block in enumerate(order):
        table[: sizes[block], row] = blocks[block]
    models, coder = _Models(len(blocks)), _Range(len(blocks), WORDS_PER_ID * len(table) + 8)
    for row, n in zip(table, _alive(sizes[order]), strict=True):
        models.narrow(n)
        coder.narrow(n)
        _step(models, coder, row[:n])
    out: list[bytes] = [b""] * len(blocks)
    for block, found in zip(order, coder.finish(), strict=True):
        out[block] = found
    return out


def decode_blocks(coded: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    """The ids of each block, given how many it has."""
    if not coded:
        return []
    counts = np.asarray(sizes, np.int64)
    order = np.argsort(-counts, kind="stable")
    words = np.zeros((len(coded), max(map(len, coded)) // 2 + 4), np.uint16)
    for row, block in enumerate(order):
        words[row, : len(coded[block]) // 2] = np.frombuffer(coded[block], "<u2")
    words = words.T.reshape(-1)
    table = np.zeros((int(counts.max(initial=0)), len(coded)), np.int32)
    models, coder = _Models(len(coded)), _Range(len(coded), 0, words)
    for row, n in zip(table, _alive(counts[order]), strict=True):
        models.narrow(n)
        coder.narrow(n)
        row[:n] = _step(models, coder, None)
    out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(coded)
    for row, block in enumerate(order):
        out[block] = table[: counts[block], row].copy()
    return out

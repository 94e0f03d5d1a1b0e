"""A minimal acyclic transducer over byte strings: frequent words and, for each, its token ids.

States with the same future are one state, so common endings are shared. Every arc carries the number of
words that sort before those below it; the sum along a path is the word's number, and that number selects
the ids. The whole automaton is one block of bytes that a task maps into memory.
"""

from __future__ import annotations

import io
import mmap
import tempfile
from collections.abc import Iterable

import numpy as np


def compile_words(words: dict[bytes, list[int]]) -> bytes:
    """The automaton as bytes. ``words`` maps every (non-empty) word to its ids."""
    known: dict[tuple, int] = {}
    arcs_of: list[tuple] = []
    finals: list[bool] = []
    sizes: list[int] = []

    def settle(node: list) -> int:
        """The number of the state equal to this node, made if it is new."""
        key = (node[0], tuple(node[1]))
        state = known.get(key)
        if state is None:
            state = known[key] = len(arcs_of)
            arcs_of.append(key[1])
            finals.append(node[0])
            sizes.append(int(node[0]) + sum(sizes[to] for _, to in key[1]))
        return state

    # Words in order: only the path of the last word is open, and what leaves it is settled.
    ordered = sorted(words)
    path: list[list] = [[False, []]]
    last = b""
    for word in ordered:
        same = 0
        while same < min(len(last), len(word)) and last[same] == word[same]:
            same += 1
        for depth in range(len(last), same, -1):
            path[depth - 1][1].append((last[depth - 1], settle(path.pop())))
        path += [[False, []] for _ in word[same:]]
        path[-1][0] = True
        last = word
    for depth in range(len(last), 0, -1):
        path[depth - 1][1].append((last[depth - 1], settle(path.pop())))
    root = settle(path[0])

    keys, targets, skips = [], [], []
    for state, arcs in enumerate(arcs_of):
        before = int(finals[state])
        for byte, to in arcs:
            keys.append(state << 8 | byte)
            targets.append(to)
            skips.append(before)
            before += sizes[to]
    ids = [words[w] for w in ordered]
    out = io.BytesIO()
    for part in (
        np.array([root, max(map(len, ordered), default=0)], np.int64),
        np.array(keys, np.int64),
        np.array(targets, np.int32),
        np.array(skips, np.int32),
        np.array(finals, np.bool_),
        np.cumsum([0, *map(len, ids)], dtype=np.int64),
        np.array([i for one in ids for i in one], np.uint32),
    ):
        np.save(out, part)
    return out.getvalue()


class Lexicon:
    """The compiled automaton, mapped from an unnamed file of the task's own."""

    def __init__(self, block: bytes) -> None:
        with tempfile.TemporaryFile() as file:
            file.write(block)
            file.flush()
            self._map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        at, parts = 0, []
        while at < len(block):
            reader = io.BytesIO(block[at : at + 512])
            np.lib.format.read_magic(reader)
            shape, _, kind = np.lib.format.read_array_header_1_0(reader)
            start = at + reader.tell()
            parts.append(np.frombuffer(self._map, kind, count=int(np.prod(shape)), offset=start))
            at = start + parts[-1].nbytes
        head, self.keys, self.targets, self.skips, self.finals, self.offsets, self.ids = parts
        self.root, self.longest = int(head[0]), int(head[1])

    def numbers(self, words: Iterable[bytes]) -> np.ndarray:
        """The number of each word, -1 where the automaton does not accept it."""
        words = list(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(sizes) - sizes
        found = np.full(len(words), -1, np.int64)
        alive = np.flatnonzero((sizes > 0) & (sizes <= self.longest))
        state = np.full(len(alive), self.root, np.int64)
        number = np.zeros(len(alive), np.int64)
        for depth in range(self.longest):
            if not len(alive):
                break
            key = state << 8 | flat[starts[alive] + depth]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[arc] == key
            alive, arc = alive[ok], arc[ok]
            state = self.targets[arc].astype(np.int64)
            number = number[ok] + self.skips[arc]
            ended = sizes[alive] == depth + 1
            good = ended & self.finals[state]
            found[alive[good]] = number[good]
            alive, state, number = alive[~ended], state[~ended], number[~ended]
        return found

"""A lexicon of words as a minimal acyclic transducer, in one block of bytes that can be mapped.

States that accept the same endings are one state, so words share suffixes as well as prefixes. Each
arc carries how many words come before those that go through it; along a word's path these add up to
the word's number in byte order, and the number leads to the word's ids.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_PARTS = ("keys", "targets", "skips", "finals", "ends", "ids")
_TYPES = (np.int64, np.int32, np.int32, np.int32, np.int32, np.int32)


def compile_lexicon(entries: dict[bytes, Sequence[int]]) -> bytes:
    """The transducer of the words in `entries` with their ids."""
    words = sorted(entries)
    states = _states(words)
    below = np.zeros(len(states), np.int64)  # words that end in or after a state; targets come first
    keys, targets, skips, finals = [], [], [], []
    for state, (final, arcs) in enumerate(states):
        finals.append(int(final))
        count = int(final)
        for byte, target in arcs:
            keys.append(state << 8 | byte)
            targets.append(target)
            skips.append(count)
            count += int(below[target])
        below[state] = count
    ids = [i for word in words for i in entries[word]]
    ends = np.cumsum([0, *(len(entries[word]) for word in words)])
    arrays = [np.asarray(a, t) for a, t in zip((keys, targets, skips, finals, ends, ids), _TYPES, strict=True)]
    longest = max(map(len, words), default=0)
    head = np.array([longest, *map(len, arrays)], np.int64)
    return b"".join(a.tobytes() for a in (head, *arrays))


def _states(words: list[bytes]) -> list[tuple[bool, tuple]]:
    """`(final, arcs)` of each state, targets before sources and the root last; arcs in byte order.

    Words come in order, so what lies beyond the prefix that a word shares with the last one is
    done, and is replaced by an equal state if there is one.
    """
    known: dict[tuple, int] = {}
    path: list[list] = [[False, []]]
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, arcs = path.pop()
            state = known.setdefault((final, tuple(arcs)), len(known))
            path[-1][1].append((last[len(path) - 1], state))

    for word in words:
        shared = next((i for i, (a, b) in enumerate(zip(word, last)) if a != b), min(len(word), len(last)))
        close(shared)
        path.extend([False, []] for _ in word[shared:])
        path[-1][0] = True
        last = word
    close(0)
    # The root may equal no other state, as it comes last.
    return [*known, (path[0][0], tuple(path[0][1]))]


class Lexicon:
    """Looks words up in the bytes of `compile_lexicon`, such as a mapped file of them."""

    def __init__(self, data):
        head = np.frombuffer(data, np.int64, 1 + len(_PARTS))
        self.longest = int(head[0])
        at = head.nbytes
        for name, kind, n in zip(_PARTS, _TYPES, head[1:].tolist(), strict=True):
            setattr(self, name, np.frombuffer(data, kind, n, at))
            at += n * np.dtype(kind).itemsize
        self.root = len(self.finals) - 1

    @classmethod
    def open(cls, path: str) -> Lexicon:
        """The lexicon in a file, mapped: the workers of one machine share its pages."""
        return cls(np.memmap(path, np.uint8, "r"))

    def find(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 for those that the lexicon does not hold.

        All words go through the states side by side, a byte at a time.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(lengths) - lengths
        data = np.frombuffer(b"".join(words), np.uint8)
        state = np.full(len(words), self.root, np.int64)
        number = np.zeros(len(words), np.int64)
        state[lengths > self.longest] = -1
        for depth in range(self.longest):
            at = np.flatnonzero((lengths > depth) & (state >= 0))
            if not len(at):
                break
            key = state[at] << 8 | data[starts[at] + depth]
            arc = np.searchsorted(self.keys, key)
            arc[arc == len(self.keys)] = 0
            there = self.keys[arc] == key
            state[at] = np.where(there, self.targets[arc], -1)
            number[at] += np.where(there, self.skips[arc], 0)
        held = state >= 0
        held[held] = self.finals[state[held]] == 1
        return np.where(held, number, -1)

    def ids_of(self, number: int) -> list[int]:
        return self.ids[self.ends[number] : self.ends[number + 1]].tolist()

"""A minimal acyclic transducer from words to numbers, built from sorted words, kept in one file.

Equal suffixes share their states; the outputs along a word's path add up to its place in the
sorted word list, under which the file has the word's token ids. The file is memory-mapped, and
many words are looked up at once, one step per byte position.
"""

from __future__ import annotations

import numpy as np

MAGIC = 20_240


class Builder:
    """Adds words in byte order; states that can no longer change are shared with equal ones."""

    def __init__(self):
        self.edges: list[dict[int, int]] = [{}]
        self.final: list[bool] = [False]
        self.known: dict[tuple, int] = {}
        # The last word's path: (state, byte, next state) not yet shared.
        self.open: list[tuple[int, int, int]] = []
        self.last = b""

    def _new(self) -> int:
        self.edges.append({})
        self.final.append(False)
        return len(self.edges) - 1

    def _close(self, depth: int) -> None:
        while len(self.open) > depth:
            state, byte, target = self.open.pop()
            form = (self.final[target], tuple(self.edges[target].items()))
            self.edges[state][byte] = self.known.setdefault(form, target)

    def add(self, word: bytes) -> None:
        common = 0
        while common < min(len(word), len(self.last)) and word[common] == self.last[common]:
            common += 1
        self._close(common)
        state = self.open[-1][2] if self.open else 0
        for byte in word[common:]:
            target = self._new()
            self.edges[state][byte] = target
            self.open.append((state, byte, target))
            state = target
        self.final[state] = True
        self.last = word

    def finish(self) -> tuple[np.ndarray, ...]:
        """Edges sorted by (state, byte) with targets and outputs, and the final states."""
        self._close(0)
        below: dict[int, int] = {}

        def words(state: int) -> int:
            """Words from a state on, children before parents without recursion."""
            stack = [state]
            while stack:
                at = stack[-1]
                missing = [t for t in self.edges[at].values() if t not in below]
                if missing:
                    stack += missing
                else:
                    below[at] = self.final[at] + sum(below[t] for t in self.edges[at].values())
                    stack.pop()
            return below[state]

        words(0)
        number = {state: i for i, state in enumerate(sorted(below))}
        rows = []
        for state in sorted(below):
            passed = int(self.final[state])
            for byte, target in sorted(self.edges[state].items()):
                rows.append((number[state] * 256 + byte, number[target], passed))
                passed += below[target]
        table = np.array(rows, np.int64).reshape(-1, 3)
        final = np.array([self.final[s] for s in sorted(below)], np.int64)
        return table[:, 0], table[:, 1], table[:, 2], final


def write(path: str, words: list[bytes], ids: list[list[int]]) -> None:
    """Compile ``words`` (sorted, distinct) with their ids into a file of 64-bit integers."""
    builder = Builder()
    for word in words:
        builder.add(word)
    keys, targets, outputs, final = builder.finish()
    ends = np.cumsum([0, *map(len, ids)])
    flat = np.array([i for own in ids for i in own], np.int64)
    parts = [keys, targets, outputs, final, ends, flat]
    head = np.array([MAGIC, *map(len, parts)], np.int64)
    with open(path, "wb") as f:
        for part in (head, *parts):
            f.write(np.ascontiguousarray(part, np.int64).tobytes())


class Lexicon:
    """A compiled file, memory-mapped."""

    def __init__(self, path: str):
        whole = np.asarray(np.memmap(path, np.int64, "r"))
        if whole[0] != MAGIC:
            raise ValueError(f"{path} is no lexicon")
        sizes, parts, at = whole[1:7], [], 7
        for size in sizes:
            parts.append(whole[at : at + int(size)])
            at += int(size)
        self.keys, self.targets, self.outputs, self.final, self.ends, self.ids = parts

    def places(self, words: list[bytes]) -> np.ndarray:
        """The place of each word in the sorted list, -1 for a word that is not there."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths) - lengths
        state, number = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        alive = np.arange(len(words)) if len(self.keys) else np.zeros(0, np.int64)
        step = 0
        result = np.full(len(words), -1, np.int64)
        while len(alive):
            ended = lengths[alive] == step
            done = alive[ended]
            result[done] = np.where(self.final[state[done]] == 1, number[done], -1)
            alive = alive[~ended]
            wanted = state[alive] * 256 + flat[starts[alive] + step]
            edge = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            alive, edge = alive[hit := self.keys[edge] == wanted], edge[hit]
            state[alive] = self.targets[edge]
            number[alive] += self.outputs[edge]
            step += 1
        return result

    def ids_of(self, place: int) -> list[int]:
        return self.ids[self.ends[place] : self.ends[place + 1]].tolist()

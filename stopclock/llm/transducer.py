"""A minimal acyclic transducer: sorted byte strings to their places in the order.

States with the same continuations are one state, so common endings are stored once,
as common beginnings are. Each arc carries the number of strings that lie before it among those of
its state; summed along a path that ends in a final state these give the ordinal.

The automaton is three arrays, arcs sorted by (state, byte). ``ordinals`` walks any number of
stretches of a byte array at once, one byte of each at a time; up to ``MAX_CELLS`` states times
bytes it looks arcs up in a table of all of them, else among the sorted arcs.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import cached_property
from typing import ClassVar

import numpy as np

MAX_CELLS = 1 << 23


@dataclass(frozen=True)
class Transducer:
    arcs: np.ndarray  # 256 * state + byte, ascending
    target: np.ndarray  # state at the end of each arc
    before: np.ndarray  # strings of the arc's state that come before it
    final: np.ndarray  # of each state; the last state is the first to be in

    DTYPES: ClassVar = {"arcs": np.int64, "target": np.int32, "before": np.int32, "final": np.bool_}

    def packed(self) -> dict[str, bytes]:
        return {name: getattr(self, name).tobytes() for name in self.DTYPES}

    @classmethod
    def unpacked(cls, data: Mapping[str, bytes]) -> Transducer:
        return cls(**{name: np.frombuffer(data[name], kind) for name, kind in cls.DTYPES.items()})

    @cached_property
    def _cells(self) -> tuple[np.ndarray, np.ndarray] | None:
        """The column of each byte, and the arc (or -1) of each state and column."""
        used = np.unique(self.arcs & 255)
        width = len(used) + 1  # the last column has no arcs
        if len(self.final) * width > MAX_CELLS:
            return None
        column = np.full(256, width - 1)
        column[used] = np.arange(width - 1)
        cells = np.full(len(self.final) * width, -1, np.int32)
        cells[(self.arcs >> 8) * width + column[self.arcs & 255]] = np.arange(len(self.arcs))
        return column, cells

    def _arc(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The arc from each state with each byte, or -1."""
        if self._cells:
            column, cells = self._cells
            return cells[state * (len(cells) // len(self.final)) + column[byte]]
        wanted = 256 * state + byte
        arc = np.minimum(np.searchsorted(self.arcs, wanted), len(self.arcs) - 1)
        return np.where(self.arcs[arc] == wanted, arc, -1)

    def ordinals(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The ordinal of each stretch ``data[start : start + length]``, or -1."""
        out = np.full(len(start), -1, np.int64)
        at = np.arange(len(start))
        state = np.full(len(start), len(self.final) - 1, np.int64)
        total = np.zeros(len(start), np.int64)
        depth = 0
        while len(at):
            ended = length[at] == depth
            done = ended & self.final[state]
            out[at[done]] = total[done]
            at, state, total = at[~ended], state[~ended], total[~ended]
            if not len(at) or not len(self.arcs):
                break
            arc = self._arc(state, data[start[at] + depth])
            there = arc >= 0
            at, arc = at[there], arc[there]
            state, total = self.target[arc].astype(np.int64), total[there] + self.before[arc]
            depth += 1
        return out


def build(strings: Iterable[bytes]) -> Transducer:
    """From strictly ascending strings, adding one after the other.

    Only the path of the last string is open. What a new string leaves of it can't change
    any more; each such state is looked up among the states known and added if it is new.
    """
    known: dict[tuple, int] = {}
    finals: list[bool] = []
    counts: list[int] = []
    outgoing: list[tuple] = []

    def settle(final: bool, arcs: list) -> int:
        key = (final, *arcs)
        state = known.get(key)
        if state is None:
            state = known[key] = len(finals)
            finals.append(final)
            counts.append(final + sum(counts[child] for _, child in arcs))
            outgoing.append(tuple(arcs))
        return state

    path: list[list] = [[False, []]]  # of each open state: is it final, and its arcs
    last = None
    for string in strings:
        if last is not None and string <= last:
            raise ValueError("the strings must ascend")
        last, shared = last or b"", 0
        while shared < min(len(last), len(string)) and last[shared] == string[shared]:
            shared += 1
        while len(path) > shared + 1:
            state = settle(*path.pop())
            path[-1][1].append((last[len(path) - 1], state))
        path.extend([False, []] for _ in range(len(string) - shared))
        path[-1][0] = True
        last = string
    while len(path) > 1:
        state = settle(*path.pop())
        path[-1][1].append((last[len(path) - 1], state))
    # The first state is written down last, also where an equal one is known.
    finals.append(path[0][0])
    outgoing.append(tuple(path[0][1]))
    arcs, target, before = [], [], []
    for state, children in enumerate(outgoing):
        passed = int(finals[state])
        for byte, child in children:
            arcs.append(256 * state + byte)
            target.append(child)
            before.append(passed)
            passed += counts[child]
    return Transducer(np.array(arcs, np.int64), np.array(target, np.int32), np.array(before, np.int32), np.array(finals, bool))

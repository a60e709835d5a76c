"""Byte-pair merging as a deterministic machine that reads its input once.

For merge vocabularies the encoding of every prefix ends in exactly one token, namely the one
that may follow the last token of the shorter prefix before it. A pair of tokens may follow
each other if merging their joined text gives the same pair. So a position needs only the last
token of the positions a token can still reach back to: a bounded window.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Callable, Sequence

START = -1
NEVER = float("inf")


class Merger:
    """Merge rules over units (bytes or characters) and the follow-up test built on them."""

    def __init__(self, ids: dict, rank: Callable):
        self.ids = ids
        self.rank = rank
        self.text = {i: piece for piece, i in ids.items()}
        self.longest = max(map(len, ids), default=1)
        #: By left token: which tokens may stand behind it, as far as tried; ``held`` pairs in all.
        self.known: defaultdict[int, dict[int, bool]] = defaultdict(dict)
        self.held = 0
        self._alone: dict[int, list[tuple] | None] = {}

    def merge(self, units: Sequence, steps: list | None = None) -> list:
        """The tokens' texts by plain merging, best rank first, leftmost among equals.

        ``steps`` gets (rank of the merge, first part, last part) per merge, the parts as they are before it.
        """
        end = len(units) - 1
        parts, after = list(units), list(range(1, len(units) + 1))
        before = list(range(-1, len(units) - 1))
        heap: list[tuple] = []

        def offer(at: int) -> None:
            if at >= 0 and after[at] < len(parts):
                rank = self.rank(parts[at], parts[after[at]])
                if rank is not None:
                    heapq.heappush(heap, (rank, at, parts[at], parts[after[at]]))

        for at in range(len(parts)):
            offer(at)
        while heap:
            rank, at, left, right = heapq.heappop(heap)
            if parts[at] != left or after[at] >= len(parts) or parts[after[at]] != right:
                continue
            if steps is not None:
                steps.append((rank, parts[0], parts[end]))
            gone = after[at]
            if gone == end:
                end = at
            parts[at], parts[gone] = left + right, None
            after[at] = after[gone]
            if after[at] < len(parts):
                before[after[at]] = at
            offer(before[at])
            offer(at)
        return [part for part in parts if part is not None]

    def follows(self, left: int, right: int) -> bool:
        """May token ``right`` stand directly behind token ``left``?"""
        behind = self.known[left]
        known = behind.get(right)
        if known is None:
            known = left == START or self._apart(left, right)
            if self.held >= 1 << 18:
                for pairs in self.known.values():
                    pairs.clear()
                self.held = 0
            self.held += 1
            behind[right] = known
        return known

    def _apart(self, left: int, right: int) -> bool:
        """Does merging the joined text of two tokens give the two?

        Until something merges across the border both sides merge as they would alone, so only the
        last part of the left and the first of the right can meet, at the time when their rank is the best.
        """
        first, second = self._steps(left), self._steps(right)
        if first is None or second is None:
            return False
        i = j = 0
        met = None
        while True:
            (mine, _, end), (other, start, _) = first[i], second[j]
            if met != (end, start):
                met, across = (end, start), self.rank(end, start)
            if across is not None and across < mine and across <= other:
                return False
            if mine <= other:
                if mine == NEVER:
                    return True
                i += 1
            else:
                j += 1

    def _steps(self, token: int) -> list[tuple] | None:
        """The merges that make a token of its units, as ``merge`` gives them; None if they make something else."""
        if token not in self._alone:
            text, steps = self.text[token], []
            made = self.merge(self.units(text), steps) == [text]
            self._alone[token] = [*steps, (NEVER, text, text)] if made else None
        return self._alone[token]

    @staticmethod
    def units(text) -> list:
        return [text[i:i + 1] for i in range(len(text))]


class Transducer:
    """A deterministic transducer: each transition gives the last token and the change in count.

    A state is the longest suffix read that a token can still extend, with the last token of
    each of its positions and their counts relative to the newest one; there are finitely many.
    Transitions are compiled when first taken and kept in a table of bounded size. A unit that
    no token holds gives no token (None), counts one and leads back to the start.
    """

    LIMIT = 1 << 18
    JUMP = 5  # the state behind the first units is looked up at once

    def __init__(self, merger: Merger, empty: bytes | str = b"", limit: int = LIMIT):
        self.merger, self.empty, self.limit = merger, empty, limit
        self.starts = {token[:i] for token in merger.ids for i in range(len(token))}
        self.reset()

    def reset(self) -> None:
        first = (self.empty, (START,), (0,))
        self.numbers, self.states, self.table = {first: 0}, [first], [{}]
        self.jumps: dict[bytes, tuple[int, int]] = {}

    def full(self) -> bool:
        return len(self.states) > self.limit

    def compile(self, state: int, unit: int | str) -> tuple[int, int | None, int]:
        suffix, last, counts = self.states[state]
        text = suffix + (bytes([unit]) if isinstance(unit, int) else unit)
        for at in range(len(text)):
            token = self.merger.ids.get(text[at:])
            if token is not None and self.merger.follows(last[at], token):
                delta = counts[at] + 1
                break
        else:
            self.table[state][unit] = (0, None, 1)
            return 0, None, 1
        drop = 0
        while text[drop:] not in self.starts:
            drop += 1
        key = (text[drop:], (*last, token)[drop:], tuple(c - delta for c in (*counts, delta)[drop:]))
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.states)
            self.states.append(key)
            self.table.append({})
        self.table[state][unit] = (number, token, delta)
        return number, token, delta

    def count(self, text: bytes | str) -> int:
        """Tokens of a whole text."""
        if self.full():
            self.reset()
        head = text[:self.JUMP]
        state, total = self.jumps.get(head) or self._run(0, 0, head)
        if len(head) == self.JUMP:
            if len(self.jumps) < 1 << 17:
                self.jumps[head] = state, total
            total = self._run(state, total, text[self.JUMP:])[1]
        return total

    def _run(self, state: int, total: int, text: bytes | str) -> tuple[int, int]:
        table = self.table
        for unit in text:
            step = table[state].get(unit) or self.compile(state, unit)
            state = step[0]
            total += step[2]
        return state, total

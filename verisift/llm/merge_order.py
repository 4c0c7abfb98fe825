"""Which two tokens may stand next to each other in a byte-pair encoding.

Two neighbours are final exactly when no merge across their border would have come
before the merges that formed them: along the border, the pieces that the left token
ends with over time meet the pieces that the right token starts with. Encoding then
needs no simulation of merges over a text, only a look at neighbouring pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

NEVER = 1 << 60
#: Pairs remembered before the memory is emptied.
MOST_PAIRS = 1 << 19


class MergeOrder:
    """``merge(a, b)`` gives (rank, token) or None; ``symbols(token)`` its single symbols."""

    def __init__(self, merge: Callable, symbols: Callable[[int], Sequence[int]], most: int = MOST_PAIRS):
        self._merge, self._symbols, self._most = merge, symbols, most
        self._edges: dict[int, tuple[tuple, tuple] | None] = {}
        #: by both tokens packed in one number
        self._pairs: dict[int, bool] = {}

    def edges(self, token: int) -> tuple[tuple, tuple] | None:
        """The pieces at the left and right end with the rank that ends each, or None if
        merging the symbols does not give the token itself."""
        if token not in self._edges:
            parts = list(self._symbols(token))
            left, right = [], []
            while len(parts) > 1:
                best = None
                for i in range(len(parts) - 1):
                    found = self._merge(parts[i], parts[i + 1])
                    if found and (best is None or found[0] < best[0]):
                        best = (*found, i)
                if best is None:
                    break
                rank, merged, i = best
                if i == 0:
                    left.append((parts[0], rank))
                if i == len(parts) - 2:
                    right.append((parts[-1], rank))
                parts[i : i + 2] = [merged]
            whole = parts == [token]
            self._edges[token] = ((*left, (token, NEVER)), (*right, (token, NEVER))) if whole else None
        return self._edges[token]

    def adjacent(self, a: int, b: int) -> bool:
        """Whether ``a`` followed by ``b`` can be part of an encoding; ``a`` < 0 is the start."""
        pair = (a + 1) << 20 | b
        known = self._pairs.get(pair)
        if known is not None:
            return known
        own = self.edges(b)
        fine = own is not None
        if fine and a >= 0:
            for x, x_ends in self.edges(a)[1]:
                for y, y_ends in own[0]:
                    found = self._merge(x, y)
                    # at equal ranks the pair further left goes first
                    if found and found[0] < x_ends and found[0] <= y_ends:
                        fine = False
                        break
                if not fine:
                    break
        if len(self._pairs) >= self._most:
            self._pairs.clear()
        self._pairs[pair] = fine
        return fine


class PrefixAutomaton:
    """Reads bytes and tells the last token of the encoding of each prefix.

    A state is the set of open readings: each start of a token that the bytes since then
    may still complete, with the token before it. It is a deterministic machine over sets
    of readings, made transition by transition when first needed. ``closed`` holds tokens
    that only end a word.
    """

    def __init__(self, tokens: dict[bytes, int], order: MergeOrder, closed: dict[bytes, int] | None = None, most: int = 350_000):
        self._order, self._most = order, most
        self._child: dict[int, int] = {}
        self._depth, self._open, self._close = [0], [-1], [-1]
        self._inner = set()
        for table, marks in ((tokens, self._open), (closed or {}, self._close)):
            for token, number in table.items():
                marks[self._node(token)] = number
        self.reset()

    def _node(self, token: bytes) -> int:
        node = 0
        for byte in token:
            self._inner.add(node)
            step = node << 8 | byte
            after = self._child.get(step)
            if after is None:
                after = self._child[step] = len(self._depth)
                self._depth.append(self._depth[node] + 1)
                self._open.append(-1)
                self._close.append(-1)
            node = after
        return node

    def reset(self) -> None:
        #: a state's readings, node and previous token packed in one number, oldest first
        self._readings: list[tuple[int, ...]] = []
        self._number: dict[tuple[int, ...], int] = {}
        #: state and byte -> next state and token
        self.steps: dict[int, int] = {}
        self.last_steps: dict[int, int] = {}
        self.start = self._state((0,))

    def full(self) -> bool:
        return len(self.steps) > self._most

    def _state(self, key: tuple[int, ...]) -> int:
        found = self._number.get(key)
        if found is None:
            found = self._number[key] = len(self._readings)
            self._readings.append(key)
        return found

    def make_step(self, state: int, byte: int) -> int:
        still, token = [], -1
        child, marks, inner, adjacent = self._child, self._open, self._inner, self._order.adjacent
        for reading in self._readings[state]:
            node, before = reading >> 20, (reading & 0xFFFFF) - 1
            after = child.get(node << 8 | byte)
            if after is None:
                continue
            mark = marks[after]
            if token < 0 <= mark and adjacent(before, mark):
                token = mark
            if after in inner:
                still.append(after << 20 | before + 1)
        if token < 0:
            raise ValueError("the vocabulary does not hold every single byte")
        still.append(token + 1)
        made = self.steps[state << 8 | byte] = self._state(tuple(still)) << 20 | token
        return made

    def make_last(self, state: int, byte: int) -> int:
        """The closing token if ``byte`` ends the word."""
        for reading in self._readings[state]:
            after = self._child.get(reading >> 20 << 8 | byte)
            if after is not None:
                mark = self._close[after]
                if mark >= 0 and self._order.adjacent((reading & 0xFFFFF) - 1, mark):
                    self.last_steps[state << 8 | byte] = mark
                    return mark
        raise ValueError("the vocabulary does not hold every single byte")

    def open_starts(self, state: int, at: int) -> list[int]:
        """Where the open readings begin, if ``at`` bytes have been read."""
        return [at - self._depth[reading >> 20] for reading in self._readings[state]]

    def rebuilt(self, state: int) -> int:
        """Forget everything but this state; gives its new number."""
        key = self._readings[state]
        self.reset()
        return self._state(key)

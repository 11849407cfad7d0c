"""Suffix sorting by recursive induction, with queues that go to disk.

Symbols are whole numbers.  A suffix is L if greater than the one after it, S
if smaller; the leftmost S of a run is a star.  Sorted star suffixes induce the
order of the L suffixes in one ascending pass over the first symbols, and those
the order of the S suffixes in one descending pass.  In a pass each suffix
sends the one before it, with the length of the prefix that it has in common
with its neighbour, to the queue of that suffix's first symbol; as suffixes
come in order, a queue is in order too.  Star suffixes are sorted by naming the
pieces between stars and sorting the string of names in the same way.

A pass handles the elements of one symbol at a time, as arrays.
"""

from __future__ import annotations

import tempfile

import numpy as np

#: A string of names over a larger alphabet is sorted by doubling, as it would need a queue a name.
MOST_QUEUES = 2048
FAR = np.iinfo(np.int64).max


class Queues:
    """A first-in first-out queue of (place, common prefix) for each symbol.
    Beyond ``most_held`` elements in memory all go to a temporary file, which
    lasts as long as the task's own object."""

    def __init__(self, most_held: int):
        self.most_held, self.held = most_held, 0
        self.memory: dict[int, list[np.ndarray]] = {}
        self.on_disk: dict[int, list[tuple[int, int]]] = {}
        self.file = None

    def push(self, symbol: int, rows: np.ndarray) -> None:
        self.memory.setdefault(symbol, []).append(rows)
        self.held += len(rows)
        if self.held > self.most_held:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.seek(0, 2)
            for s, chunks in self.memory.items():
                block = np.concatenate(chunks)
                self.on_disk.setdefault(s, []).append((self.file.tell(), len(block)))
                self.file.write(block.tobytes())
            self.memory, self.held = {}, 0

    def pop(self, symbol: int) -> np.ndarray:
        out = [np.zeros((0, 2), np.int64)]
        for at, n in self.on_disk.pop(symbol, ()):
            self.file.seek(at)
            out.append(np.frombuffer(self.file.read(16 * n), np.int64).reshape(-1, 2))
        for rows in self.memory.pop(symbol, ()):
            self.held -= len(rows)
            out.append(rows)
        return np.concatenate(out)

    def close(self) -> None:
        if self.file:
            self.file.close()


def _types(s: np.ndarray) -> np.ndarray:
    """True: S.  The last symbol must be smaller than its neighbour, or alone."""
    n = len(s)
    smaller = np.ones(n, bool)
    change = np.flatnonzero(s[1:] != s[:-1])  # s[i] differs from s[i + 1]
    if len(change):
        nxt = np.searchsorted(change, np.arange(n - 1))
        tail = nxt == len(change)
        at = change[np.minimum(nxt, len(change) - 1)]
        smaller[:-1] = np.where(tail, False, s[at] < s[at + 1])
    elif n > 1:
        smaller[:-1] = False
    return smaller


def common_prefix(s: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``a`` and ``b``, pairwise."""
    if len(a) > 1 << 16:
        return np.concatenate([common_prefix(s, a[k:k + (1 << 16)], b[k:k + (1 << 16)]) for k in range(0, len(a), 1 << 16)])
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    width, n = 16, len(s)
    padded = np.concatenate([s, np.full(width, -1)])
    views = np.lib.stride_tricks.sliding_window_view(padded, width)
    while len(live):
        x, y = a[live] + out[live], b[live] + out[live]
        # Two suffixes differ before the end of the longer one.
        inside = (x < n) & (y < n)
        differ = views[np.minimum(x, n)] != views[np.minimum(y, n)]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        first = np.where(inside, np.minimum(first, n - np.maximum(x, y)), 0)
        out[live] += first
        live = live[inside & (first == width)]
    return out


def _doubled(s: np.ndarray) -> np.ndarray:
    """Order of the suffixes by doubling the sorted prefix length."""
    rank = np.unique(s, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        after = np.zeros(len(s), np.int64)
        after[:-width] = rank[width:] + 1 if width < len(s) else 0
        pair = rank * (len(s) + 2) + after
        found, rank = np.unique(pair, return_inverse=True)
        if len(found) == len(s) or width >= len(s):
            return np.argsort(rank, kind="stable")
        width *= 2


def _star_order(s: np.ndarray, stars: np.ndarray, most_held: int) -> np.ndarray:
    """The star suffixes in order."""
    if len(stars) < 2:
        return stars
    # Name the pieces from star to star, both included, by doubling inside them.
    ends = np.append(stars[1:], len(s) - 1)
    lengths = ends - stars + 1
    covered = np.zeros(len(s), np.int64)
    # remaining length of the piece at each place, from the first star on
    place = np.arange(stars[0], len(s))
    of = np.searchsorted(stars, place, "right") - 1
    covered[place] = ends[of] - place + 1
    rank = np.unique(s, return_inverse=True)[1].astype(np.int64) + 1
    width = 1
    while width < lengths.max():
        after = np.zeros(len(s), np.int64)
        after[:-width] = rank[width:]
        after[covered <= width] = len(s) + 1  # a piece that begins another is greater: it ends in S where the other has L
        rank = np.unique(rank * (len(s) + 2) + after, return_inverse=True)[1].astype(np.int64) + 1
        width *= 2
    names = np.unique(rank[stars], return_inverse=True)[1]
    if names.max() + 1 == len(stars):
        return stars[np.argsort(names)]
    order = suffix_order(names, most_held)[0] if names.max() < MOST_QUEUES and names[-1] < names[:-1].min() else _doubled(names)
    return stars[order]


def _send(queues: Queues, seen: dict[int, int], rows: np.ndarray, to: np.ndarray, place: np.ndarray, pending: np.ndarray) -> None:
    """Push predecessors to their symbols' queues with their common prefixes.

    ``rows``: the block's (place, common prefix with the element before it);
    ``to``: symbol or -1; ``pending``: least common prefix since each symbol's
    last push.
    """
    h = rows[:, 1]
    carried = np.minimum(pending, h.min())
    for symbol in np.unique(to[to >= 0]).tolist():
        at = np.flatnonzero(to == symbol)
        least = np.minimum.reduceat(h[:at[-1] + 1], np.append(0, at[:-1] + 1))
        least[0] = min(least[0], pending[symbol])
        common = least + 1
        if symbol not in seen:
            common[0] = 0
            seen[symbol] = 1
        queues.push(symbol, np.stack([place[at], common], axis=1))
        carried[symbol] = h[at[-1] + 1:].min() if at[-1] + 1 < len(h) else FAR - 1
    pending[:] = carried


def suffix_order(s: np.ndarray, most_held: int = 4_000_000) -> tuple[np.ndarray, np.ndarray]:
    """(places of the suffixes in order, common prefix of each with the one
    before).  The last symbol must be unique and the smallest."""
    s = np.asarray(s, np.int64)
    n = len(s)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    symbols, s = np.unique(s, return_inverse=True)
    kinds = len(symbols)
    smaller = _types(s)
    stars = np.flatnonzero(smaller & np.append(False, ~smaller[:-1]))
    if not len(stars):
        stars = np.array([n - 1])
    ordered = _star_order(s, stars, most_held)
    common = np.append(0, common_prefix(s, ordered[:-1], ordered[1:]))
    star_from = np.searchsorted(s[ordered], np.arange(kinds + 1))

    def joined(blocks: list[np.ndarray]) -> np.ndarray:
        return np.concatenate(blocks) if blocks else np.zeros((0, 2), np.int64)

    # Ascending: stars send L suffixes, and these those before them.
    larger: list[np.ndarray] = []
    queues, seen, pending = Queues(most_held), {}, np.full(kinds, FAR - 1)

    def ascend(rows: np.ndarray) -> None:
        before = rows[:, 0] - 1
        to = np.where((before >= 0) & ~smaller[before], s[before], -1)
        _send(queues, seen, rows, to, before, pending)

    for c in range(kinds):
        mine = []
        while len(rows := queues.pop(c)):
            mine.append(rows)
            ascend(rows)
        larger.append(joined(mine))
        a, b = star_from[c], star_from[c + 1]
        if b > a:
            rows = np.stack([ordered[a:b], common[a:b]], axis=1)
            rows[0, 1] = common_prefix(s, larger[c][-1:, 0], rows[:1, 0])[0] if len(larger[c]) else 0
            ascend(rows)
    queues.close()

    # Descending: L suffixes, and S ones, send the S suffixes before them.
    smalls: list[np.ndarray] = [np.zeros((0, 2), np.int64)] * kinds
    queues, seen, pending = Queues(most_held), {}, np.full(kinds, FAR - 1)

    def descend(rows: np.ndarray) -> None:
        before = rows[:, 0] - 1
        to = np.where((before >= 0) & smaller[before], s[before], -1)
        _send(queues, seen, rows, to, before, pending)

    for c in range(kinds - 1, -1, -1):
        mine = []
        if c == s[n - 1]:
            rows = np.array([[n - 1, 0]])  # the end has no suffix after it that could send it
            mine.append(rows)
            descend(rows)
        while len(rows := queues.pop(c)):
            mine.append(rows)
            descend(rows)
        smalls[c] = joined(mine)
        rows = larger[c][::-1].copy()  # its common prefixes belong to the element that came before, in ascending order
        if len(rows):
            rows[1:, 1] = larger[c][::-1][:-1, 1]
            rows[0, 1] = common_prefix(s, smalls[c][-1:, 0], rows[:1, 0])[0] if len(smalls[c]) else 0
            descend(rows)
    queues.close()

    places, prefixes = [], []
    for c in range(kinds):
        up, down = larger[c], smalls[c][::-1]
        places += [up[:, 0], down[:, 0]]
        shared = np.zeros(len(down[:1]), np.int64)
        if len(down):
            shared = np.append(shared[:1], smalls[c][1:, 1][::-1])
            shared[0] = common_prefix(s, up[-1:, 0], down[:1, 0])[0] if len(up) else 0
        prefixes += [up[:, 1], shared]
    return np.concatenate(places), np.concatenate(prefixes)

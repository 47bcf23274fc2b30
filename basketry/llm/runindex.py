"""Run-length index of a repetitive text: a run-compressed Burrows-Wheeler transform with
sampled run ends, and matching statistics streamed through it.

The text is a list of byte strings, each closed by an end mark of its own.  The index keeps one
record per run of equal symbols in the transform: first row, symbol, the shift that maps rows of
the run to the rows of the suffixes one symbol longer, and the text places of its first and last
row (and, to find the run of a row at once, its number beside each row).  A query is read from its end to its start.  While the row's symbol is the query's, the
match grows; else it moves to the nearest run end with that symbol above or below, whichever
agrees with more of the query, which the sampled places tell.  All queries advance together.
"""

from __future__ import annotations

import numpy as np

_PACK = 7  # symbols of 9 bits in one 63-bit number


def suffix_ranks(symbols: np.ndarray, depths: tuple[int, ...] = ()):
    """Suffix array of ``symbols`` (0: end marks, which differ from each other by place).

    Also gives the ranks after a power-of-two multiple of 7 symbols for each asked depth.
    """
    n = len(symbols)
    key = np.zeros(n, dtype=np.int64)
    open_ = np.ones(n, dtype=bool)  # no end mark among the symbols packed so far
    padded = np.concatenate([symbols, np.zeros(_PACK, symbols.dtype)]).astype(np.int64)
    for i in range(_PACK):
        at = padded[i:i + n]
        key = (key << 9) | np.where(open_, at, 0)
        open_ &= at > 0
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    new = np.empty(n + 1, dtype=bool)  # rows that begin a group of equal suffixes
    new[0] = new[n] = True
    new[1:n] = (sorted_key[1:] != sorted_key[:-1]) | ~open_[order[1:]]
    del key, open_, padded, sorted_key
    rank = np.empty(n, dtype=np.int64)  # first row of the group
    rank[order] = np.maximum.accumulate(np.where(new[:n], np.arange(n), 0))
    kept, depth = {}, _PACK
    while True:
        if depth in depths:
            kept[depth] = rank.copy()
        rows = np.flatnonzero(~(new[:n] & new[1:]))  # rows of groups not yet told apart
        if not len(rows):
            break
        tied = order[rows]
        key = rank[tied] * n + rank[np.minimum(tied + depth, n - 1)]
        by = np.argsort(key)
        tied, key = tied[by], key[by]
        order[rows] = tied
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        new[rows] = fresh
        rank[tied] = np.maximum.accumulate(np.where(fresh, rows, 0))
        depth *= 2
    for d in depths:
        kept.setdefault(d, rank)
    return order, kept


class RunIndex:
    """Index of byte strings; ``window`` is the match length that is asked for later."""

    def __init__(self, texts: list[bytes], window: int):
        self.window = window
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.symbols = np.frombuffer(b"\0".join([*texts, b""]), dtype=np.uint8).astype(np.int16) + 1
        marks = np.cumsum(lengths + 1) - 1
        self.symbols[marks] = 0
        n = len(self.symbols)
        depth = _PACK
        while 2 * depth <= window:
            depth *= 2
        order, kept = suffix_ranks(self.symbols, (depth,))
        self.text_of = np.repeat(np.arange(len(texts), dtype=np.int32), lengths + 1)
        self._build_runs(order, n)
        self._build_classes(order, kept[depth], depth, n, marks)

    def _build_runs(self, order: np.ndarray, n: int) -> None:
        before = self.symbols[order - 1]  # row of place 0 wraps to the last end mark
        # End marks differ from each other, so no run is longer than one of them.
        change = np.ones(n, dtype=bool)
        change[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)
        self.starts = np.flatnonzero(change)
        self.run_of_row = (np.cumsum(change) - 1).astype(np.int32)
        self.run_symbol = before[self.starts].astype(np.int64)
        ends = np.append(self.starts[1:], n) - 1
        self.ends = ends
        self.start_place, self.end_place = order[self.starts], order[ends]
        # Rows of the longer suffixes: by symbol, then in the order of the runs.
        by_symbol = np.argsort(self.run_symbol, kind="stable")
        sizes = ends - self.starts + 1
        first = np.empty(len(sizes), dtype=np.int64)
        first[by_symbol] = np.cumsum(sizes[by_symbol]) - sizes[by_symbol]
        self.shift = first - self.starts
        self.n_runs = len(self.starts)
        self.of_symbol = self.run_symbol[by_symbol] * self.n_runs + by_symbol

    def _build_classes(self, order, rank, depth, n, marks) -> None:
        """Neighbouring rows whose suffixes share ``window`` symbols form a class."""
        rest = marks[self.text_of[order]] - order  # symbols before the end mark
        skip = self.window - depth
        late = np.minimum(order + skip, n - 1)
        same = np.zeros(n, dtype=bool)
        same[1:] = ((rank[order[1:]] == rank[order[:-1]])
                    & (rank[late[1:]] == rank[late[:-1]])
                    & (rest[1:] >= self.window) & (rest[:-1] >= self.window))
        self.class_of_row = (np.cumsum(~same) - 1).astype(np.int32)
        self.class_starts = np.flatnonzero(~same)
        self.row_text = self.text_of[order]

    def least(self, values: np.ndarray) -> np.ndarray:
        """Per class, the least of ``values`` (one per text) over the texts that hold it."""
        return np.minimum.reduceat(values[self.row_text], self.class_starts)

    def _agreement(self, query: np.ndarray, column: int, place: np.ndarray,
                   most: np.ndarray) -> np.ndarray:
        """Symbols that query rows from ``column`` on and the text from ``place`` share."""
        width = int(most.max(initial=0))
        if not width:
            return np.zeros(len(place), dtype=np.int64)
        at = np.minimum(place[:, None] + np.arange(width), len(self.symbols) - 1)
        text = self.symbols[at]
        equal = (text == query[:, column:column + width]) & (text > 0)
        run = np.where(equal.all(axis=1), width, np.argmin(equal, axis=1))
        return np.minimum(run, most)

    def matching_statistics(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``(length, row)`` per text and place, padded to the right with zeros.

        ``length`` is the longest match with the index that starts at the place, and ``row`` a
        row whose suffix begins with that match.
        """
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        widest = int(sizes.max(initial=0))
        query = np.zeros((len(texts), widest + 1), dtype=np.int16)
        inside = np.arange(widest + 1) < sizes[:, None]
        query[inside] = np.frombuffer(b"".join(texts), dtype=np.uint8).astype(np.int16) + 1
        lengths = np.zeros((len(texts), widest), dtype=np.int16)
        rows = np.zeros((len(texts), widest), dtype=np.int64)
        row = np.zeros(len(texts), dtype=np.int64)
        length = np.zeros(len(texts), dtype=np.int64)
        for t in range(widest - 1, -1, -1):
            q = np.flatnonzero(sizes > t)
            symbol = query[q, t].astype(np.int64)
            run = self.run_of_row[row[q]].astype(np.int64)
            miss = np.flatnonzero(self.run_symbol[run] != symbol)
            length[q] += 1
            if len(miss):
                self._jump(query, q[miss], t, symbol[miss], run, miss, row, length)
            row[q] += self.shift[run]
            rows[q, t] = row[q]
            lengths[q, t] = length[q]
        return lengths, rows

    def _jump(self, query, q, t, symbol, run, miss, row, length) -> None:
        """Move queries ``q`` to the better of the nearest run ends with their symbol."""
        at = np.searchsorted(self.of_symbol, symbol * self.n_runs + run[miss])
        below = self.of_symbol[np.minimum(at, self.n_runs - 1)]
        above = self.of_symbol[np.maximum(at - 1, 0)]
        has_below = (at < self.n_runs) & (below // self.n_runs == symbol)
        has_above = (at > 0) & (above // self.n_runs == symbol)
        below, above = below % self.n_runs, above % self.n_runs
        most = length[q] - 1
        ahead = query[q]
        down = np.where(has_below, self._agreement(ahead, t + 1, self.start_place[below], most), -1)
        up = np.where(has_above, self._agreement(ahead, t + 1, self.end_place[above], most), -1)
        take_up = up >= down
        best = np.where(take_up, up, down)
        found = best >= 0
        target = np.where(take_up, above, below)
        run[miss] = np.where(found, target, run[miss])
        row[q] = np.where(found, np.where(take_up, self.ends[above], self.starts[below]), row[q])
        # A symbol that the index lacks ends the match; the row stays where its run maps it.
        length[q] = np.where(found, best + 1, 0)

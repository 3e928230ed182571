"""The agenda of adjacent pairs, worked off for many runs at a time.

Runs of equal length stand in a matrix of symbols. Each round takes every run's first entry of its agenda, the
adjacent pair of best score (the leftmost of equal ones), merges it and looks up the two pairs that this makes;
runs whose agenda is empty leave. After a round all runs left are one symbol shorter, so no row is padded.
"""

from __future__ import annotations

import numpy as np

_NONE = np.iinfo(np.int32).max
LONGEST = 48  # characters; longer runs are left to the caller
_POINTS = 0x30000


class Agenda:
    """Scores of all pairs of symbols whose concatenation is a piece; ``order`` is lower for a better piece."""

    def __init__(self, ids: dict[str, int], order: dict[str, float]):
        names = sorted(set(ids) | set(order) | {c for piece in order for c in piece})
        at = {name: i for i, name in enumerate(names)}
        self.n = len(names)
        self.id_of = np.array([ids.get(name, -1) for name in names], np.int64)
        ranks = {score: i for i, score in enumerate(sorted(set(order.values())))}
        pairs = [
            (at[piece[:i]] * self.n + at[piece[i:]], ranks[score], at[piece])
            for piece, score in order.items() for i in range(1, len(piece)) if piece[:i] in at and piece[i:] in at
        ]
        pairs.sort()
        self.keys, self.ranks, self.merged = (
            np.array(c, kind) for c, kind in zip(zip(*pairs, strict=True), (np.int64, np.int32, np.int32), strict=True)
        )
        self.symbol_of = np.full(_POINTS, -1, np.int32)
        for name, i in at.items():
            if len(name) == 1 and ord(name) < _POINTS:
                self.symbol_of[ord(name)] = i

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged symbol) of pairs."""
        key = left.astype(np.int64) * self.n + right
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = self.keys[place] == key
        return np.where(known, self.ranks[place], _NONE), self.merged[place]

    def _worked_off(self, symbols: np.ndarray):
        """(rows, their symbols) of a matrix of runs, whenever some are done."""
        rows = np.arange(len(symbols))
        rank, merged = self._look_up(symbols[:, :-1], symbols[:, 1:])
        while symbols.shape[1] > 1:
            best = rank.argmin(axis=1)
            every = np.arange(len(rows))
            open_ = rank[every, best] < _NONE
            if not open_.all():
                yield rows[~open_], symbols[~open_]
                rows, symbols, rank, merged, best = rows[open_], symbols[open_], rank[open_], merged[open_], best[open_]
                every = every[:len(rows)]
            if not len(rows):
                return
            symbols[every, best] = merged[every, best]
            # without the column behind the merged one
            kept = np.arange(symbols.shape[1] - 1)
            symbols = np.take_along_axis(symbols, kept + (kept > best[:, None]), axis=1)
            kept = kept[:-1]
            past = kept + (kept >= best[:, None])
            rank, merged = np.take_along_axis(rank, past, axis=1), np.take_along_axis(merged, past, axis=1)
            for pair, there in ((best - 1, best > 0), (best, best < len(kept))):
                row = every[there]
                at = pair[there]
                rank[row, at], merged[row, at] = self._look_up(symbols[row, at], symbols[row, at + 1])
        yield rows, symbols

    def ids(self, runs: list[bytes], blank: str) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        """(groups of runs with the matrix of their ids, runs not done); blanks count as ``blank``.

        Runs that are long or hold characters of no piece are not done.
        """
        raw = b"".join(runs)
        points = np.frombuffer(raw.decode().encode("utf-32-le"), "<u4")
        points = np.where(points == 0x20, ord(blank), points)
        symbols = np.where(points < _POINTS, self.symbol_of[np.minimum(points, _POINTS - 1)], -1)
        starts_char = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
        byte_edges = np.cumsum([0, *map(len, runs)])
        edges = np.concatenate(([0], np.cumsum(starts_char)))[byte_edges]
        sizes = np.diff(edges)
        unknown = np.add.reduceat((symbols < 0).astype(np.int64), edges[:-1]) > 0
        left = [np.flatnonzero(unknown | (sizes > LONGEST))]
        groups = []
        for size in np.unique(sizes[~unknown & (sizes <= LONGEST)]).tolist():
            mine = np.flatnonzero((sizes == size) & ~unknown)
            for at in range(0, len(mine), 20_000):
                some = mine[at:at + 20_000]
                for rows, found in self._worked_off(symbols[edges[some][:, None] + np.arange(size)]):
                    ids = self.id_of[found]
                    whole = (ids >= 0).all(axis=1)
                    groups.append((some[rows[whole]], ids[whole]))
                    left.append(some[rows[~whole]])  # ends in a character that is no piece itself
        return groups, np.concatenate(left)

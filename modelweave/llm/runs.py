"""Byte runs and the token ids each of them has, kept per Python worker."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from modelweave.llm.common import span_hashes

PLACES = 1 << 20  # 12 MB
MOST_RUNS = 500_000
MOST_IDS = 4_000_000  # of the runs kept, 8 or 16 MB


class RunTable:
    """Ids of the runs met so far, looked up by a 64-bit hash in a table with one place per value of its lowest bits.

    A run whose place is taken is encoded again whenever it comes, so the first ones, most of the frequent runs
    among them, stay. Once ``most`` runs or ``MOST_IDS`` ids are kept no more are added; when four times as many other
    runs have come, the table starts anew. ``encode`` gives (ids of all runs, number of ids of each) of a list of runs.
    """

    def __init__(self, kind: np.dtype, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]):
        self.kind, self.encode, self.most = np.dtype(kind), encode, MOST_RUNS
        self._clear()

    def _clear(self) -> None:
        self.hash_at, self.run_at = np.zeros(PLACES, np.uint64), np.full(PLACES, -1, np.int32)
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.passed = np.zeros(0, self.kind), 0

    def ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the runs data[start:end], one after the other; their number before each run, and in all)."""
        known, known_ids = len(self.first), len(self.pool)
        full = known >= self.most or known_ids >= MOST_IDS
        run = self._numbers(data, starts, ends, not full)
        counts = self.count[run]
        before = np.concatenate(([0], np.cumsum(counts)))
        out = self.pool[np.repeat(self.first[run] - before[:-1], counts) + np.arange(before[-1])]
        if full:  # what was added is not kept
            self.passed += len(self.first) - known
            self.first, self.count, self.pool = self.first[:known], self.count[:known], self.pool[:known_ids]
            if self.passed > 4 * self.most:
                self._clear()
        return out, before

    def _numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keep: bool) -> np.ndarray:
        """The number of every run; unknown ones are encoded and added."""
        hashes = span_hashes(data, starts, ends)
        place = (hashes & np.uint64(PLACES - 1)).astype(np.int64)
        found = np.where(self.hash_at[place] == hashes, self.run_at[place], -1)
        unknown = np.flatnonzero(found < 0)
        if not len(unknown):
            return found
        new, first, back = np.unique(hashes[unknown], return_index=True, return_inverse=True)
        at = unknown[first]
        raw = data.tobytes()
        ids, counts = self.encode([raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
        known = len(self.first)
        self.first = np.concatenate((self.first, len(self.pool) + np.cumsum(counts) - counts))
        self.count = np.concatenate((self.count, counts))
        self.pool = np.concatenate((self.pool, ids))
        found[unknown] = known + back
        if keep:
            free = self.run_at[place[at]] < 0
            self.hash_at[place[at][free]], self.run_at[place[at][free]] = new[free], known + np.flatnonzero(free)
        return found

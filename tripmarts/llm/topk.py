"""The best few of many scores, row by row, merged as further scores come in."""

from __future__ import annotations

import numpy as np

# Scores lie strictly between these; the lower one marks what is no candidate or not there.
LOWEST = -(1 << 62)
HIGHEST = 1 << 62
# Stands for a missing id, which comes last among equal scores.
NO_ID = np.iinfo(np.int64).max


class Best:
    """For each of `rows` rows, the `k` entries (score, id) that come first: by score downwards, then id."""

    def __init__(self, rows: int, k: int):
        self.scores = np.full((rows, k), LOWEST)
        self.ids = np.full((rows, k), NO_ID)

    def add(self, at: int, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores (a row for each of the rows from `at`, a column for each id; ids ascending)."""
        k, columns = self.scores.shape[1], scores.shape[1]
        last = self.scores[at : at + len(scores), -1]
        most = scores.max(axis=1, initial=LOWEST)
        live = np.flatnonzero((most > LOWEST) & (most >= last))
        if not len(live):
            return
        part = scores[live]
        least = np.maximum(last[live], LOWEST + 1)
        if columns > k:
            least = np.maximum(least, np.partition(part, columns - k, axis=1)[:, columns - k])
        row, column = np.nonzero(part >= least[:, None])
        found = part[row, column]
        # Equal scores stay in the order of their ids.
        order = np.lexsort((column, -found, row))
        row, column, found = row[order], column[order], found[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        near = place < k
        new_scores, new_ids = np.full((len(live), k), LOWEST), np.full((len(live), k), NO_ID)
        new_scores[row[near], place[near]] = found[near]
        new_ids[row[near], place[near]] = ids[column[near]]
        both_scores = np.concatenate([self.scores[at + live], new_scores], axis=1)
        both_ids = np.concatenate([self.ids[at + live], new_ids], axis=1)
        first = np.lexsort((both_ids, -both_scores), axis=1)[:, :k]
        self.scores[at + live] = np.take_along_axis(both_scores, first, axis=1)
        self.ids[at + live] = np.take_along_axis(both_ids, first, axis=1)

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, score, id) of all entries."""
        row, place = np.nonzero(self.scores > LOWEST)
        return row, self.scores[row, place], self.ids[row, place]

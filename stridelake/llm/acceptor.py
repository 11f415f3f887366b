"""Minimal acceptors of sorted word lists, and their composition with a one-edit transducer.

An acceptor here holds many word lists at once, one initial state for each. Its
arcs carry how many accepted words come before those behind the arc, so a path
numbers its word. States with the same words behind them are one. The composed
machine reads one word and writes another: both copies of the acceptor walk
together up to the edit, which may differ in one symbol or leave one out, and
then on over the same symbols. Copies that meet in one state after the edit accept
all that lies behind it together.
"""

from __future__ import annotations

import numpy as np


class Acceptor:
    """The minimal acceptor of sorted distinct words in groups; words are rows of bytes, padded with zeros."""

    def __init__(self, letters: np.ndarray, lengths: np.ndarray, group: np.ndarray):
        n, width = letters.shape
        first = np.concatenate(([True], group[1:] != group[:-1]))
        differ = letters[1:] != letters[:-1]
        shared = np.concatenate(([-1], np.where(differ.any(1), differ.argmax(1), width))) if width else np.full(n, 0)
        shared[first] = -1
        depth = np.arange(width + 1)
        made = (depth > shared[:, None]) & (depth <= lengths[:, None])
        node = np.where(made, np.cumsum(made.ravel()).reshape(made.shape) - 1, -1)
        node = np.maximum.accumulate(node, axis=0)
        row, at = np.nonzero(made)
        count = np.bincount(node[depth <= lengths[:, None]], minlength=len(row))
        final = np.zeros(len(row), bool)
        final[node[np.arange(n), lengths]] = True
        child = np.flatnonzero(at > 0)
        parent = node[row[child], at[child] - 1]
        symbol = letters[row[child], at[child] - 1].astype(np.int64)
        offset = row[child] - row[parent]
        order = np.lexsort((symbol, parent))
        child, parent, symbol, offset = child[order], parent[order], symbol[order], offset[order]
        start = np.searchsorted(parent, np.arange(len(row) + 1))
        kind = self._merge(at, parent, child, symbol, final, start, width)
        # One node stands for all of its kind.
        speaker = np.zeros(kind.max() + 1, np.int64)
        speaker[kind] = np.arange(len(row))
        degree = start[speaker + 1] - start[speaker]
        self.start = np.concatenate(([0], np.cumsum(degree)))
        arcs = np.repeat(start[speaker] - self.start[:-1], degree) + np.arange(self.start[-1])
        self.symbol, self.to, self.offset = symbol[arcs], kind[child[arcs]], offset[arcs]
        self.final, self.count = final[speaker], count[speaker]
        self.key = np.repeat(np.arange(len(speaker)), degree) * 256 + self.symbol
        self.initial, self.base, self.group = kind[node[first, 0]], np.flatnonzero(first), group[first]

    @staticmethod
    def _merge(depth: np.ndarray, parent: np.ndarray, child: np.ndarray, symbol: np.ndarray, final: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
        """The number of each trie node's state, height after height: equal marks and arcs are one state."""
        height = np.zeros(len(depth), np.int64)
        by_depth = np.argsort(depth[child], kind="stable")
        cuts = np.searchsorted(depth[child][by_depth], np.arange(1, width + 2))
        for d in range(width, 0, -1):
            some = by_depth[cuts[d - 1] : cuts[d]]
            np.maximum.at(height, parent[some], height[child[some]] + 1)
        degree = np.diff(start)
        kind, made = np.zeros(len(depth), np.int64), 0
        order = np.lexsort((degree, height))
        change = (np.diff(height[order]) != 0) | (np.diff(degree[order]) != 0)
        for nodes in np.split(order, np.flatnonzero(change) + 1):
            k = int(degree[nodes[0]])
            arcs = start[nodes][:, None] + np.arange(k)
            words = np.column_stack((final[nodes].astype(np.int64), symbol[arcs] << 48 | kind[child[arcs]]))
            if k < 2:
                flat = words[:, 0] << 60 | (words[:, 1] if k else 0)
                unique, inverse = np.unique(flat, return_inverse=True)
            else:
                unique, inverse = np.unique(words, axis=0, return_inverse=True)
            kind[nodes] = made + inverse.ravel()
            made += len(unique)
        return kind

    def _arcs(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Arcs that leave the states, and the place in ``states`` of each."""
        degree = self.start[states + 1] - self.start[states]
        place = np.repeat(np.arange(len(states)), degree)
        return np.arange(len(place)) + np.repeat(self.start[states] - (np.cumsum(degree) - degree), degree), place

    def one_edit_pairs(self, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pairs of words of a group that are one edit apart, each pair once.

        Words first differ at a place before ``last`` of their group. Of words of
        unequal length the longer comes first.
        """
        found: list[tuple[np.ndarray, np.ndarray]] = []
        states, base, limit, depth = self.initial, self.base, last, 0
        while len(states):
            inside = limit > depth
            states, base, limit = states[inside], base[inside], limit[inside]
            arcs, place = self._arcs(states)
            to, at = self.to[arcs], base[place] + self.offset[arcs]
            # One symbol more on the left side: the next common symbol is another one.
            self._walk(to, at, states[place], base[place], self.symbol[arcs], found)
            # Two unequal symbols: each arc with those after it.
            degree = self.start[states + 1] - self.start[states]
            after = np.repeat(self.start[states] + degree, degree) - arcs - 1
            left = np.repeat(np.arange(len(arcs)), after)
            right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(after) - after, after)
            self._walk(to[left], at[left], to[right], at[right], None, found)
            states, base, limit, depth = to, at, limit[place], depth + 1
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])

    def _walk(self, left: np.ndarray, at_left: np.ndarray, right: np.ndarray, at_right: np.ndarray, banned: np.ndarray | None, found: list) -> None:
        """Both copies on over the same symbols after the edit."""
        while len(left):
            same = left == right
            if same.any():
                behind = self.count[left[same]]
                step = np.arange(behind.sum()) - np.repeat(np.cumsum(behind) - behind, behind)
                found.append((np.repeat(at_left[same], behind) + step, np.repeat(at_right[same], behind) + step))
            both = self.final[left] & self.final[right] & ~same
            found.append((at_left[both], at_right[both]))
            left, right, at_left, at_right = left[~same], right[~same], at_left[~same], at_right[~same]
            arcs, place = self._arcs(left)
            if banned is not None:
                fits = self.symbol[arcs] != banned[~same][place]
                arcs, place, banned = arcs[fits], place[fits], None
            want = right[place] * 256 + self.symbol[arcs]
            there = np.searchsorted(self.key, want)
            fits = self.key[np.minimum(there, len(self.key) - 1)] == want if len(self.key) else np.zeros(len(want), bool)
            arcs, place, there = arcs[fits], place[fits], there[fits]
            left, right = self.to[arcs], self.to[there]
            at_left, at_right = at_left[place] + self.offset[arcs], at_right[place] + self.offset[there]

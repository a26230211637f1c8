"""Sorted runs of byte strings, front-coded, merged by a loser tree that knows common prefixes."""

from __future__ import annotations

import numpy as np


def common_prefixes(rows: np.ndarray) -> np.ndarray:
    """For each row of a matrix of bytes how many it shares with the row before; 0 for the first."""
    out = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        unlike = rows[1:] != rows[:-1]
        out[1:] = np.where(unlike.any(1), unlike.argmax(1), rows.shape[1])
    return out


def front_code(rows: np.ndarray, shared: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes that follow each row's shared prefix, up to the row's size."""
    column = np.arange(rows.shape[1])
    return rows[(column >= shared[:, None]) & (column < sizes[:, None])]


def front_decode(tails: np.ndarray, shared: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """The matrix back: what is shared comes from the last row that has its own byte there."""
    column = np.arange(width)
    own = column >= shared[:, None]
    rows = np.zeros((len(shared), width), np.uint8)
    rows[own & (column < sizes[:, None])] = tails
    source = np.maximum.accumulate(np.where(own, np.arange(len(shared))[:, None], 0), axis=0)
    return rows[source, column]


def merge_runs(runs: list[list[int]], shared: list[list[int]], width: int) -> tuple[list[int], list[int]]:
    """(run of each row, prefix shared with the row before) of the merged order.

    A run is a sorted list of strings of `width` bytes, as big-endian numbers, with the prefix
    each shares with the one before. In the tree each loser keeps the prefix it shares with the
    winner that beat it; of two that were last beaten by the same winner, the one that shares
    more with it is smaller, and nothing is read. Only if both share as much are they compared,
    from there on.
    """
    k = 1
    while k < max(len(runs), 1):
        k *= 2
    end = 1 << (8 * width)
    head = [run[0] if run else end for run in runs] + [end] * (k - len(runs))
    at = [0] * k
    loser, loser_shares = [0] * k, [0] * k

    def play(node: int) -> int:
        """The winner of the first round below a node; its losers are left in the tree."""
        if node >= k:
            return node - k
        a, b = play(2 * node), play(2 * node + 1)
        if head[b] < head[a]:
            a, b = b, a
        loser[node] = b
        unlike = head[a] ^ head[b]
        loser_shares[node] = width - (unlike.bit_length() + 7) // 8 if unlike < end else -1
        return a

    from_run: list[int] = []
    prefixes: list[int] = []
    winner, shares = play(1), 0
    while head[winner] < end:
        from_run.append(winner)
        prefixes.append(shares)
        at[winner] += 1
        i, run = at[winner], runs[winner]
        if i < len(run):
            head[winner], shares = run[i], shared[winner][i]
        else:
            head[winner], shares = end, -1
        node = (winner + k) >> 1
        while node:
            other = loser_shares[node]
            if other > shares:
                winner, loser[node] = loser[node], winner
                shares, loser_shares[node] = other, shares
            elif other == shares and shares >= 0:
                rival = loser[node]
                unlike = head[winner] ^ head[rival]
                known = width - (unlike.bit_length() + 7) // 8
                if head[rival] < head[winner]:
                    winner, loser[node] = rival, winner
                loser_shares[node] = known
            node >>= 1
    return from_run, prefixes

"""Rank-synchronous merging of many symbol sequences held in flat arrays."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: The rank of a pair that does not merge.
NO_MERGE = np.int64(1 << 40)

Ranked = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def merge_all(symbols: np.ndarray, owner: np.ndarray, ranked: Ranked) -> tuple[np.ndarray, np.ndarray]:
    """Merged symbols and their owners, in order of the owners.

    ``owner`` is the rising number of the sequence of each symbol; ``ranked(left, right)``
    gives the rank of each pair and the symbol it makes. In each round every sequence
    merges its best-ranked pair, leftmost among equals; a sequence without one is done.
    """
    sym, own = symbols, owner
    rank, made = np.full(len(sym), NO_MERGE), np.zeros(len(sym), np.int64)
    inside = np.flatnonzero(own[1:] == own[:-1])
    rank[inside], made[inside] = ranked(sym[inside], sym[inside + 1])
    done_sym, done_own = [], []
    while len(sym):
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        size = np.diff(np.r_[first, len(sym)])
        best = np.minimum.reduceat(rank, first)
        going = best < NO_MERGE
        if not going.all():
            stays = np.repeat(going, size)
            done_sym.append(sym[~stays])
            done_own.append(own[~stays])
            sym, own, rank, made = sym[stays], own[stays], rank[stays], made[stays]
            if not len(sym):
                break
            size, best = size[going], best[going]
        hits = np.flatnonzero(rank == np.repeat(best, size))
        at = hits[np.r_[True, own[hits[1:]] != own[hits[:-1]]]]
        sym[at] = made[at]
        rank[at] = rank[at + 1]  # none if the pair was the last
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        at = at - np.arange(len(at))
        sym, own, rank, made = sym[keep], own[keep], rank[keep], made[keep]
        near = np.concatenate([at[at > 0] - 1, at[at + 1 < len(sym)]])
        near = near[own[near] == own[near + 1]]
        rank[near], made[near] = ranked(sym[near], sym[near + 1])
    if not done_sym:
        return symbols[:0], owner[:0]
    sym, own = np.concatenate(done_sym), np.concatenate(done_own)
    order = np.argsort(own, kind="stable")
    return sym[order], own[order]

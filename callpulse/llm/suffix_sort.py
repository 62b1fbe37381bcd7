"""Deep-shallow ordering of suffixes, vectorised over all suffixes of a block.

The shallow phase is a multikey quicksort over 8-byte characters: suffixes are
ordered by their first character, and only those still tied are ordered by the
next one, down to ``SHALLOW`` characters. The groups that are left share a long
prefix. The deep phase orders them with blind tries. A blind trie keeps, for
each leaf, only the depth at which it leaves a path and its byte there. The
tries of all groups are built together, one path (the group's first suffix) per
round: every other suffix of the group is compared with the path, which gives
its branching depth and byte; those that leave at the same place by the same
byte form the subtrees of the next round, and the others are ordered at once.
Each round deepens the common prefix of every subtree, so ``depth`` bounds the
number of rounds.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 3


def _character(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place as one big-endian number."""
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, 8)[at]).view(">u8")[:, 0].astype(np.uint64)


def _branch(text: np.ndarray, path: np.ndarray, other: np.ndarray, depth: np.ndarray, limit: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at path and other, at most limit; depth is known to be common."""
    out = np.minimum(depth, limit)
    live = np.flatnonzero(out < limit)
    while len(live):
        x = _character(text, path[live] + out[live]) ^ _character(text, other[live] + out[live])
        # whole equal bytes from the high end
        same = np.zeros(len(live), np.int64)
        rest = x.copy()
        for bits in (32, 16, 8):
            high = rest >> np.uint64(64 - bits) == 0
            same += np.where(high, bits // 8, 0)
            rest = np.where(high, rest << np.uint64(bits), rest)
        step = np.where(x == 0, 8, same)
        out[live] = np.minimum(out[live] + step, limit)
        live = live[(x == 0) & (out[live] < limit)]
    return out


def _deep(text: np.ndarray, at: np.ndarray, group: np.ndarray, depth: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of places within their groups, and a class number for equal limit-byte prefixes.

    ``group`` is ascending; returns (order, cls): at[order] is sorted within each group
    and cls is the class of at[order], ascending and starting anew at every distinct prefix.
    """
    n = len(at)
    # keys[k] orders entries by what the k-th path of their trie says; built round by round
    keys: list[np.ndarray] = []
    live = np.arange(n)
    sub = group.copy()
    known = np.full(n, depth, np.int64)
    while len(live):
        g = sub[live]
        head = np.ones(len(live), bool)
        head[1:] = g[1:] != g[:-1]
        lead = np.flatnonzero(head)
        size = np.diff(np.append(lead, len(live)))
        path = np.repeat(at[live[lead]], size)
        lcp = _branch(text, path, at[live], known[live], limit)
        equal = lcp >= limit
        edge = np.where(equal, 0, lcp)
        mine = text[at[live] + edge].astype(np.int64)
        less = ~equal & (mine < text[path + edge])
        # below the path: the earlier it leaves the smaller; above it: the other way round
        key = np.full(n, -1, np.int64)
        key[live] = np.where(equal, limit << 8, np.where(less, lcp << 8, ((2 * limit - lcp) << 8)) + mine)
        keys.append(key)
        go = np.flatnonzero(~equal)
        # subtrees: same trie, same side and depth, same byte
        o = go[np.lexsort((key[live[go]], g[go]))]
        if not len(o):
            break
        kk, gg = key[live[o]], g[o]
        new = np.ones(len(o), bool)
        new[1:] = (kk[1:] != kk[:-1]) | (gg[1:] != gg[:-1])
        num = np.cumsum(new)
        count = np.bincount(num)
        more = count[num] > 1
        nxt = live[o][more]
        sub[nxt] = num[more]
        known[nxt] = lcp[o][more] + 1
        live = nxt
    order = np.lexsort((*reversed(keys), group)) if keys else np.arange(n)
    fresh = np.zeros(n, bool)
    if n:
        fresh[0] = True
        go = group[order]
        fresh[1:] = go[1:] != go[:-1]
        for k in keys:
            ko = k[order]
            fresh[1:] |= ko[1:] != ko[:-1]
    return order, np.cumsum(fresh)


def classes(text: np.ndarray, at: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort the limit-byte prefixes of the suffixes at ``at``.

    Returns (order, cls): at[order] is sorted, cls[i] numbers the distinct prefixes in that order.
    ``text`` needs limit + 8 bytes after every place (pad it).
    """
    n = len(at)
    order = np.arange(n)
    group = np.zeros(n, np.int64)  # ascending along order
    tied = np.arange(n)  # places in order that are still tied
    shallow = min(SHALLOW, limit // 8)
    for k in range(shallow):
        if not len(tied):
            break
        c = _character(text, at[order[tied]] + 8 * k)
        o = np.argsort(c, kind="stable") if k == 0 else np.lexsort((c, group[tied]))
        order[tied] = order[tied][o]
        c, g = c[o], group[tied]
        new = np.ones(len(tied), bool)
        new[1:] = (c[1:] != c[:-1]) | (g[1:] != g[:-1])
        # the rank of a group's first place stays unique among all places
        lead = np.maximum.accumulate(np.where(new, tied, 0))
        group[tied] = lead
        last = np.append(new[1:], True)
        tied = tied[~(new & last)]
    if len(tied):
        o, cls = _deep(text, at[order[tied]], group[tied], 8 * shallow, limit)
        order[tied] = order[tied][o]
        number = group.copy()
        # a class is named by the place of its first member
        head = np.ones(len(tied), bool)
        head[1:] = cls[1:] != cls[:-1]
        number[tied] = np.maximum.accumulate(np.where(head, tied, 0))
        group = number
    return order, group

"""Suffix arrays by induced sorting, and permuted common prefixes, in NumPy.

A string is an array of bytes in which 0 is a separator; separators are distinct from each other,
in the order of their places, and the last symbol is one.  Positions are classified as rising (their suffix
is smaller than the next one) or falling; a rising position after a falling one starts a leftmost-smaller
substring.  These substrings are sorted and named, the string of their names is sorted by recursion unless
all names differ, and all other suffixes are induced from them: falling ones from their successors in rising
order, then rising ones in falling order.

Over bytes the induction goes bucket by bucket (each bucket as one vector); over the names of a recursion,
whose buckets are many and small, it follows each chain of falling (then rising) positions to its known end
by doubling.  Nothing here knows about Spark.
"""

from __future__ import annotations

import numpy as np


def rising(s: np.ndarray, last: bool) -> np.ndarray:
    """True where a suffix is smaller than the next one; ``last`` is the last position's type."""
    up = np.append(s[:-1] < s[1:], last)
    level = np.flatnonzero((s[:-1] == s[1:]) & (s[:-1] > 0))
    up[:-1] |= (s[:-1] == 0) & (s[1:] == 0)  # separators rise with their places
    if len(level):  # as the next position that differs from its successor
        end = np.append(np.diff(level) > 1, True)
        after = np.flatnonzero(end)[np.cumsum(np.append(0, end[:-1]))]
        up[level] = up[level[after] + 1]
    return up


def leftmost(up: np.ndarray) -> np.ndarray:
    """The rising positions that follow a falling one."""
    return np.flatnonzero(up[1:] & ~up[:-1]) + 1


def _deal(queues: list, s: np.ndarray, positions: np.ndarray, wanted) -> None:
    """Appends each position's predecessor to its bucket's queue, in order, if ``wanted(bucket)``."""
    before = positions[positions > 0] - 1
    char = s[before]
    ok = wanted(char)
    before, char = before[ok], char[ok]
    if not len(before):
        return
    order = np.argsort(char, kind="stable")
    before, char = before[order], char[order]
    cut = np.flatnonzero(char[1:] != char[:-1]) + 1
    for c, part in zip(char[np.append(0, cut)].tolist(), np.split(before, cut)):
        queues[c].append(part)


def _bucket(queue: list, s: np.ndarray, c: int) -> np.ndarray:
    """A bucket's part: what was induced into it, then the runs of its symbol before that."""
    parts = list(queue)
    now = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    while len(now):
        now = now[now > 0] - 1
        now = now[s[now] == c]
        parts.append(now)
    return np.concatenate(parts) if parts else now


def induce(s: np.ndarray, up: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """All suffixes in order, from the leftmost-smaller ones in order (``starts``), of a string of bytes."""
    symbols = int(s.max(initial=0)) + 1
    limits = np.searchsorted(s[starts], np.arange(symbols + 1))
    falling_queue: list[list] = [[] for _ in range(symbols)]
    rising_queue: list[list] = [[] for _ in range(symbols)]
    falling, out = [], []
    for c in range(symbols):
        part = _bucket(falling_queue[c], s, c)
        falling.append(part)
        _deal(falling_queue, s, np.concatenate([part, starts[limits[c]:limits[c + 1]]]), lambda char: char > c)
    for c in range(symbols - 1, 0, -1):
        part = _bucket(rising_queue[c], s, c)
        _deal(rising_queue, s, np.concatenate([part, falling[c][::-1]]), lambda char: (char < c) & (char > 0))
        out.append(part)
        out.append(falling[c][::-1])
    return np.concatenate([np.flatnonzero(s == 0), *(part[::-1] for part in out[::-1])])


def _dense(key: np.ndarray) -> tuple[np.ndarray, int]:
    order = np.argsort(key)
    new = np.zeros(len(key), np.int64)
    new[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(new)
    return rank, int(rank.max(initial=0)) + 1


def _chained(code: np.ndarray, jump: np.ndarray) -> np.ndarray:
    """Ranks of the sequences of codes met by following ``jump`` to a place that jumps to itself.

    A code tells whether its place ends a chain, so equal beginnings end together.  A rank is the number of smaller
    sequences; each round doubles the compared length and sorts only what is still tied.
    """
    n = len(code)
    order = np.argsort(code)
    new = np.append(True, code[order[1:]] != code[order[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    tied = order[~(new & np.append(new[1:], True))]
    while True:
        tied = tied[jump[tied] != tied]
        if not len(tied):
            return rank
        after = jump[tied]
        old, key = rank[tied], rank[after]
        by = np.argsort(old * n + key)
        tied, old, key, after = tied[by], old[by], key[by], after[by]
        group = np.append(True, old[1:] != old[:-1])
        new = group | np.append(True, key[1:] != key[:-1])
        at = np.arange(len(tied))
        rank[tied] = old + np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        tied = tied[~(new & np.append(new[1:], True)) & (jump[after] != after)]
        jump = jump[jump]


def _ranks(s: np.ndarray, up: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Ranks of all positions, induced from ``known`` values of the leftmost-smaller ones (0 elsewhere).

    With equal known values the ranks compare leftmost-smaller substrings, with true ones suffixes.
    """
    n = len(s)
    here = np.arange(n)
    start = np.zeros(n, bool)
    start[leftmost(up)] = True
    # falling positions and the starts that end their chains
    some = np.flatnonzero(~up | start)
    place = np.zeros(n, np.int64)
    place[some] = np.arange(len(some))
    jump = np.where(start | (here == n - 1), here, here + 1)
    code = (2 * s + start) * (int(known.max(initial=0)) + 1) + known
    falls = np.zeros(n, np.int64)
    falls[some] = _chained(code[some], place[jump[some]])
    # rising positions, each chain ending at a falling one
    jump = np.where(~up, here, here + 1)
    return _chained((2 * s + up) * (n + 1) + np.where(up, 0, falls), jump)


def _names_order(s: np.ndarray) -> np.ndarray:
    """Suffixes in order of a string whose last symbol occurs once (the recursion's form)."""
    if len(s) < 2:
        return np.arange(len(s))
    up = rising(s, False)
    starts = leftmost(up)
    known = np.zeros(len(s), np.int64)
    if len(starts):
        names, size = _dense(_ranks(s, up, known)[starts])
        if size < len(starts):
            order = _names_order(names)
            names[order] = np.arange(len(names))
        known[starts] = names
    return np.argsort(_ranks(s, up, known))


def _same(s: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether s[a:a+size] and s[b:b+other] hold the same symbols and no separator."""
    out = size == other
    left = np.flatnonzero(out)
    k = 0
    while len(left):
        x = s[a[left] + k]
        ok = (x == s[b[left] + k]) & (x > 0)
        out[left[~ok]] = False
        k += 1
        left = left[ok]
        left = left[size[left] > k]
    return out


def suffix_array(s: np.ndarray) -> np.ndarray:
    """All suffixes of ``s`` in order (bytes, 0 as separator, the last symbol 0)."""
    if len(s) < 2:
        return np.arange(len(s))
    up = rising(s, True)
    starts = leftmost(up)
    if not len(starts):
        return induce(s, up, starts)
    order = induce(s, up, starts[np.argsort(s[starts], kind="stable")])
    is_start = np.zeros(len(s), bool)
    is_start[starts] = True
    ordered = order[is_start[order]]
    size = np.zeros(len(s), np.int64)
    size[starts] = np.append(starts[1:], len(s) - 1) - starts + 1  # the next start's symbol belongs to it
    a, b = ordered[:-1], ordered[1:]
    new = np.append(1, ~_same(s, a, b, size[a], size[b])).astype(np.int64)
    name = np.zeros(len(s), np.int64)
    name[ordered] = np.cumsum(new) - 1
    if new.sum() < len(starts):
        ordered = starts[_names_order(name[starts])]
    return induce(s, up, ordered)


def permuted_prefixes(s: np.ndarray, order: np.ndarray, places: np.ndarray, most: int) -> np.ndarray:
    """For each of ``places``, the length, up to ``most``, that its suffix shares with the one before it in order.

    ``s`` holds bytes.  The values stand in text order, where neighbouring ones fall by one at most; they are found
    eight bytes at a time.
    """
    before = np.empty(len(s), np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = len(s)  # nothing: the padding
    ends = np.flatnonzero(s == 0)
    cap = np.minimum(most, ends[np.searchsorted(ends, places)] - places)
    raw = np.append(s, np.zeros(most + 16, np.uint8)).tobytes()
    words = np.ndarray((len(raw) - 7,), "<u8", raw, 0, (1,))
    out = np.zeros(len(places), np.int64)
    left, other = np.arange(len(places)), before[places]
    for k in range(0, most, 8):
        differ = words[places[left] + k] ^ words[other[left] + k]
        low = differ & (~differ + np.uint64(1))  # the lowest bit that differs tells the byte
        same = differ == 0
        out[left] = k + np.where(same, 8, np.log2(np.where(same, 1, low).astype(np.float64)).astype(np.int64) // 8)
        left = left[same & (cap[left] > k + 8)]
    return np.minimum(out, cap)

"""Suffix arrays and permuted prefixes against sorting all suffixes."""

import random

import numpy as np

from fairsketch.llm.suffixes import leftmost, permuted_prefixes, rising, suffix_array


def brute(s):
    key = [(0, i) if c == 0 else (int(c), 0) for i, c in enumerate(s)]
    return sorted(range(len(s)), key=lambda i: key[i:])


def strings():
    rng = random.Random(7)
    for _ in range(400):
        symbols = rng.choice([2, 3, 4, 9])
        yield [rng.randrange(rng.randrange(2), symbols) for _ in range(rng.randrange(60))] + [0]
    yield [1] * 300 + [0]
    yield [1, 2] * 150 + [0]
    yield list(range(1, 200)) + [0] + list(range(199, 0, -1)) + [0]
    a, b = [1], [1, 2]
    for _ in range(10):  # a Fibonacci string: deep recursion
        a, b = b, b + a
    yield b + [0] + a + [0]


def test_order_and_prefixes():
    for s in strings():
        s = np.array(s, np.uint8)
        order = suffix_array(s)
        assert order.tolist() == brute(s)
        rank = {p: i for i, p in enumerate(order.tolist())}
        places = np.arange(len(s))
        got = permuted_prefixes(s, order, places, 20)
        for p in places.tolist():
            q, n = (order[rank[p] - 1] if rank[p] else len(s)), 0
            while n < 20 and p + n < len(s) and q + n < len(s) and s[p + n] == s[q + n] and s[p + n] > 0:
                n += 1
            assert got[p] == n


def test_classes():
    s = np.array([2, 1, 1, 3, 3, 1, 0], np.uint8)
    up = rising(s, True)
    assert up.tolist() == [False, True, True, False, False, False, True]
    assert leftmost(up).tolist() == [1, 6]

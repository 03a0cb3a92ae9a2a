"""Rounds of the interleave refinement."""

import random
from collections import Counter

from wagerlens.llm import bwt


def places_of(strings, length):
    grams = Counter(s[i : i + length] for s in strings for i in range(len(s) - length + 1))
    return {(k, i): s[i : i + length] for k, s in enumerate(strings) for i in range(len(s) - length + 1) if grams[s[i : i + length]] > 1}


def test_a_round_takes_as_many_symbols_as_a_number_holds(monkeypatch):
    rounds = []
    order = bwt._order
    monkeypatch.setattr(bwt, "_order", lambda symbol: rounds.append(symbol.dtype.itemsize) or order(symbol))
    r = random.Random(5)
    strings = [bytes(r.choices(b"abcdefghijklmnopqrstuvwxyz  ,.", k=130)) for _ in range(900)]
    strings = [*strings, *(s[10:] for s in strings[:300]), strings[0][20:], strings[0]]
    string, at, block = bwt.repeated(strings, 100, 40_000)
    want = places_of(strings, 100)
    assert {(x, y) for x, y in zip(string.tolist(), at.tolist())} == set(want)
    of = {}
    for x, y, b in zip(string.tolist(), at.tolist(), block.tolist()):
        assert of.setdefault(b, want[x, y]) == want[x, y]
    assert len(of) == len(set(want.values()))
    assert len(rounds) <= 10  # 25 with four symbols a round
    assert max(rounds) == 4  # more names of grams than 16 bits hold


def test_all_bytes_and_every_step():
    r = random.Random(6)
    strings = [bytes(r.randrange(256) for _ in range(40)) for _ in range(60)]
    strings = [*strings, *(s[3:] for s in strings[:20]), bytes(range(256)), bytes(range(255, -1, -1)), b"", b"\0" * 30, b"\xff" * 30]
    for length in (1, 2, 9, 17):
        want = places_of(strings, length)
        for step in (None, 1, 3, 7):
            string, at, _ = bwt.repeated(strings, length, 700, step)
            assert {(x, y) for x, y in zip(string.tolist(), at.tolist())} == set(want), (length, step)


def test_strings_without_bytes_repeat_nothing():
    assert all(len(x) == 0 for x in bwt.repeated([b"", b"", b""], 2, 1))

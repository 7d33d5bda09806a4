"""How many guesses a password takes, in powers of ten.

The cheapest way to cut a value into dictionary words, dates, repeats, keyboard
walks and brute-force characters, found by dynamic programming from left to right.  Every
piece that there is, is tried: words and dates at every place, repeats of any unit any number
of times from three on, walks from every start.
"""

from __future__ import annotations

import re
from functools import lru_cache
from math import log10

import numpy as np

#: Common passwords and words that sample credentials are made of, commonest first.
WORDS = (
    "password", "admin", "welcome", "letmein", "monkey", "dragon", "master", "login", "princess",
    "sunshine", "football", "baseball", "shadow", "superman", "batman", "secret", "trustno", "hello",
    "freedom", "whatever", "iloveyou", "starwars", "computer", "michelle", "jordan", "hunter",
    "killer", "pepper", "summer", "winter", "spring", "autumn", "soccer", "hockey", "ranger",
    "thomas", "charlie", "andrew", "daniel", "jessica", "ashley", "nicole", "cheese", "internet",
    "changeme", "default", "example", "sample", "test", "demo", "dummy", "placeholder", "redacted",
    "your", "user", "root", "guest", "token", "secretkey", "key", "api", "pass", "passwd", "none",
    "null", "true", "false", "value", "string", "here", "insert", "enter", "replace", "this", "that",
    "with", "from", "the", "and", "for", "not", "love", "good", "home", "work", "data", "server",
    "system", "service", "public", "private", "access", "account", "client", "database", "config",
)
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
RANK = {w: i + 1 for i, w in enumerate(WORDS)}
LONGEST = max(map(len, WORDS))
DATE = re.compile(r"(?:19|20)\d\d(?:[-./]?[01]\d[-./]?[0-3]\d)?|[0-3]?\d[-./][0-3]?\d[-./](?:\d\d){1,2}")
HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
LONGEST_DATE = 10
#: Guesses for one date, and for one start and turn of a walk.
DATE_GUESSES, WALK_START, WALK_STEP = 365 * 120, 47 * 2, 4
#: Two pieces more make the order of pieces one more thing to guess.
JOIN = log10(2)


def _cell(c: str) -> tuple[int, int] | None:
    c = c.lower()
    return next(((r, row.index(c)) for r, row in enumerate(ROWS) if c in row), None)


@lru_cache(maxsize=20_000)
def _beside(a: str, b: str) -> bool:
    x, y = _cell(a), _cell(b)
    return x is not None and y is not None and x != y and abs(x[0] - y[0]) <= 1 and abs(x[1] - y[1]) <= 1


def _brute(c: str) -> float:
    if c.isdigit():
        return 1.0
    if c.isalpha():
        return log10(26)
    return log10(33)


def _repeats(value: str) -> dict[int, list[tuple[int, int]]]:
    """By end: (period, most repeats) of every unit, itself no repeat, that stands three times or more before it."""
    n = len(value)
    codes = np.frombuffer(value.encode("utf-32-le", "surrogatepass"), np.uint32)
    found: dict[int, list[tuple[int, int]]] = {}
    for p in range(1, n // 3 + 1):
        same = codes[p:] == codes[:-p]
        if np.count_nonzero(same) < 2 * p:
            continue
        # Length of the run of equal characters, p apart, that ends at each place.
        breaks = np.where(same, 0, np.arange(1, len(same) + 1))
        run = np.arange(1, len(same) + 1) - np.maximum.accumulate(breaks)
        places = np.flatnonzero(run >= 2 * p)
        for stretch in np.split(places, np.flatnonzero(np.diff(places) > 1) + 1) if len(places) else ():
            unit = value[stretch[0] + 1:stretch[0] + 1 + p]  # all units of a stretch are turns of one
            if p == 1 or (unit + unit).find(unit, 1) == p:
                for at, length in zip(stretch.tolist(), run[stretch].tolist()):
                    found.setdefault(at + p + 1, []).append((p, length // p + 1))
    return found


def _walks(value: str) -> tuple[list[int], np.ndarray]:
    """By end (from 0): where the run of neighbouring keys that ends there begins; and turns counted up to each place."""
    n = len(value)
    begins, run = [0] * (n + 1), 0
    for j in range(1, n + 1):
        if j > 1 and not _beside(value[j - 2], value[j - 1]):
            run = j - 1
        begins[j] = run
    steps = np.diff([ord(c) for c in value]) if n > 1 else np.zeros(0, int)
    bends = np.r_[0, 0, np.cumsum(steps[1:] != steps[:-1])] if n > 2 else np.zeros(n, int)
    return begins, bends  # bends[k]: changes of step at the places 1 to k - 1


def segments(value: str) -> tuple[float, list[tuple[str, int, int]]]:
    """The least cost (log10 of guesses) and the pieces (kind, start, end) that reach it, over all cuts."""
    n = len(value)
    ends: dict[int, list[tuple[int, str, float]]] = {}
    low = value.lower()
    if len(low) != n:  # lowering changed the length: letters stay as they are
        low = value
    for i in range(n):
        for j in range(i + 3, min(n, i + LONGEST) + 1):
            if rank := RANK.get(low[i:j]):
                word = value[i:j]
                cases = 1 if word.islower() else 2 if word.isupper() or word.istitle() else 2 ** min(j - i, 8)
                ends.setdefault(j, []).append((i, "word", log10(rank * cases)))
        if value[i].isdigit():
            for j in range(i + 4, min(n, i + LONGEST_DATE) + 1):
                if DATE.fullmatch(value, i, j):
                    ends.setdefault(j, []).append((i, "date", log10(DATE_GUESSES)))
    repeats = _repeats(value)
    begins, bends = _walks(value)
    single = [_brute(c) for c in value]
    brute = np.r_[0.0, np.cumsum(single)]
    for m in HEX.finditer(value):
        if m.end() - m.start() >= 8 and not m[0].isdigit():
            single[m.start():m.end()] = [log10(16)] * (m.end() - m.start())
    best = [0.0] + [float("inf")] * n
    joined = np.zeros(n + 1)  # the same with what another piece behind it costs; nothing before the first
    logs = np.log10(np.maximum(np.arange(n + 1), 1))
    back: list[tuple[int, str]] = [(0, "")] * (n + 1)
    for j in range(1, n + 1):
        least, how = best[j - 1] + single[j - 1], (j - 1, "brute")
        for i, kind, cost in ends.get(j, ()):
            total = best[i] + cost + (JOIN if i else 0.0)
            if total < least:
                least, how = total, (i, kind)
        for p, most in repeats.get(j, ()):
            first = j - p * most  # starts from j - 3 p down to this one
            totals = joined[first:j - 3 * p + 1:p][::-1] + logs[3:most + 1]
            at = int(totals.argmin())
            total = float(totals[at]) + brute[j] - brute[j - p]
            if total < least:
                least, how = total, (j - p * (at + 3), "repeat")
        if j - begins[j] >= 4:  # all walks of four keys or more that end here
            first = begins[j]
            turns = 1 + (bends[j - 1] - bends[first + 1:j - 2]) // 3
            totals = joined[first:j - 3] + logs[4:j - first + 1][::-1] + turns * log10(WALK_STEP)
            at = int(totals.argmin())
            total = float(totals[at]) + log10(WALK_START)
            if total < least:
                least, how = total, (first + at, "walk")
        best[j], back[j] = least, how
        joined[j] = least + JOIN
    pieces: list[tuple[str, int, int]] = []
    j = n
    while j:
        i, kind = back[j]
        if pieces and kind == pieces[-1][0] == "brute":
            pieces[-1] = (kind, i, pieces[-1][2])
        else:
            pieces.append((kind, i, j))
        j = i
    return float(best[n]), pieces[::-1]

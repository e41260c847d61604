"""String scorers as Arrow UDFs; each scores a pair of string columns. Scores of ratios are 0 to 100, others 0 to 1."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Characters from which on NumPy finds equal ones faster.
LONG = 400


def _codes(*texts: str) -> list[np.ndarray]:
    """Code points of texts, numbered from 0 in all of them."""
    points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    number = np.unique(np.concatenate(points), return_inverse=True)[1].astype(np.int32)
    return np.split(number, np.cumsum([len(x) for x in points])[:-1])


def _trimmed(a: str, b: str) -> tuple[str, str, int]:
    """Both without what they begin and end with alike, and its length."""
    start, stop, least = 0, 0, min(len(a), len(b))
    if least >= LONG and (a[:4] == b[:4] or a[-4:] == b[-4:]):
        x, y = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in (a, b))
        differ = np.flatnonzero(x[:least] != y[:least])
        start = int(differ[0]) if len(differ) else least
        differ = np.flatnonzero(x[::-1][: least - start] != y[::-1][: least - start])
        stop = int(differ[0]) if len(differ) else least - start
    else:
        while start < least and a[start] == b[start]:
            start += 1
        while stop < least - start and a[-1 - stop] == b[-1 - stop]:
            stop += 1
    return a[start : len(a) - stop], b[start : len(b) - stop], start + stop


def _masks(text: str, other: str) -> dict[str, int]:
    """Of each character that other has too the places that it stands at in text, as bits."""
    masks: dict[str, int] = {}
    if len(text) < LONG:
        for i, ch in enumerate(text):
            masks[ch] = masks.get(ch, 0) | 1 << i
        return masks
    points = np.frombuffer(text.encode(), np.uint8) if text.isascii() else np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    for ch in set(text) & set(other):
        masks[ch] = int.from_bytes(np.packbits(points == ord(ch), bitorder="little").tobytes(), "little")
    return masks


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of the longer text at once (bit-parallel). A step's carry beyond the row is cut off after some steps."""
    if a == b:
        return len(a)
    a, b, same = _trimmed(a, b)
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return same
    masks = _masks(a, b)
    row = full = (1 << len(a)) - 1
    for k in range(0, len(b), 128):
        for mask in [masks[ch] for ch in b[k : k + 128] if ch in masks]:
            hit = row & mask
            row = (row + hit) | (row ^ hit)
        row &= full
    return same + len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """Indel similarity; two empty texts are equal."""
    total = len(a) + len(b)
    return 100.0 * 2 * lcs_length(a, b) / total if total else 100.0


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    """The best ratio between the common tokens and each side's; 0 if a side is empty."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    common, left, right = sorted(x & y), sorted(x - y), sorted(y - x)
    if common and (not left or not right):
        return 100.0
    base, one, two = " ".join(common), " ".join([*common, *left]), " ".join([*common, *right])
    best = 0.0
    if common:  # base begins both
        best = max(100.0 * 2 * len(base) / (len(base) + len(t)) for t in (one, two))
    rest, other = one[len(base) :], two[len(base) :]
    most = len(base) + (Counter(rest) & Counter(other)).total()
    if 100.0 * 2 * most / (len(one) + len(two)) <= best:
        return best
    return max(best, 100.0 * 2 * (len(base) + lcs_length(rest, other)) / (len(one) + len(two)))


def _strands(short: str, long: str) -> np.ndarray:
    """Of each place of long, the place where the strand that ends there begins, negative if it begins beside short.

    Semi-local alignment: two strands cross at most once, and never where characters are equal. Short shares with long[i:j] as
    many characters as strands that don't begin at i or behind it end before j. A row of the braid, a character of short, is
    passed at once: the strand along it is the least since the last equal character.
    """
    x, y = _codes(short, long)
    n, m = len(x), len(y)
    wide = n + m + 1
    kind = np.int32 if wide * (m + 2) < 1 << 31 else np.int64
    v, w, along = np.arange(m, dtype=kind), np.empty(m + 1, kind), np.empty(m + 1, kind)
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for i, ch in enumerate(x.tolist()):
        if ch not in known:
            equal = y == ch
            known[ch] = (np.concatenate(([0], np.cumsum(equal) * wide)).astype(kind), np.flatnonzero(equal))
        drop, places = known[ch]
        w[0] = -1 - i
        np.subtract(v, drop[1:], out=w[1:])
        np.minimum.accumulate(w, out=along)
        along += drop
        np.maximum(v, along[:-1], out=v)
        v[places] = along[places]
    return v


def partial_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter text to a part of the longer one, as long as the shorter one; parts at the ends may be shorter. Of texts of one length, parts of the second."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if not short:
        return 100.0 if not long else 0.0
    if short in long:
        return 100.0
    begins, n, m = _strands(short, long), len(short), len(long)
    low, high = np.maximum(0, np.arange(1 - n, m)), np.minimum(m, np.arange(1, m + n))
    # strands that begin at low or behind it and end before high: a part gains the strand ending at its new end, and loses the one that begins at its old start
    ends = np.full(m, m + n, np.int64)
    ends[begins[begins >= 0]] = np.flatnonzero(begins >= 0)
    step = np.zeros(m + n - 1, np.int64)
    step[:m] += begins >= np.maximum(0, np.arange(m) - n + 1)
    lost = np.arange(m - 1)
    step[n : n + m - 1] -= ends[: m - 1] < np.minimum(m, lost + n)
    size = high - low
    common = size - np.cumsum(step)
    return float(np.max(100.0 * 2 * common / (n + size)))


def jaro_winkler(a: str, b: str) -> float:
    """Characters match with the first free equal one in reach; places of a character are passed once, as reach only moves on."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    places: dict[str, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        places.setdefault(b[j], []).append(j)  # the first place last
    taken, matched = [], []
    for i, ch in enumerate(a):
        free = places.get(ch)
        while free and free[-1] < i - reach:
            free.pop()
        if free and free[-1] <= i + reach:
            taken.append(free.pop())
            matched.append(ch)
    m = len(matched)
    if not m:
        return 0.0
    turned = sum(x != b[j] for x, j in zip(matched, sorted(taken), strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - turned) / m) / 3
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + 0.1 * prefix * (1 - jaro) if jaro > 0.7 else jaro


def damerau_levenshtein(a: str, b: str) -> int:
    """Unrestricted: transposed characters may have others between them, in one of the texts; in both, replacing costs no more.

    A row of the longer text at once (bit-parallel): neighbours differ by one at most, and a place is as far as the one before it in
    both texts, or one farther. A transposition with others between keeps a distance where all steps past those others cost one.
    """
    if a == b:
        return 0
    a, b, _ = _trimmed(a, b)
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return len(b)
    masks = _masks(b, a)
    full = (1 << len(b)) - 1
    up, down, flat, before, open_ = full, 0, full, 0, 0  # one more or less than the place before; as far as the place before in both texts
    for ch in a:
        at = masks.get(ch, 0)
        first = at & ~flat  # this character, before others in b, then the last one of a
        inside = (first << 1) & up
        past = first | ((((inside + up) ^ up) | inside) & up)
        equal = at | ((past << 1) & before) | ((open_ & at) << 1)
        flat = ((((equal & up) + up) ^ up) | equal | down) & full
        more, less = down | (full ^ (flat | up)), up & flat  # than in the row before
        open_ = (open_ & more) | ((at >> 1) & ~flat)  # others of a, between a character of b and the one before it
        more = ((more << 1) | 1) & full
        up, down = ((less << 1) & full) | (full ^ (flat | more)), more & flat
        before = at
    return len(a) + up.bit_count() - down.bit_count()


def dl_similarity(a: str, b: str) -> float:
    longest = max(len(a), len(b))
    return 1.0 - damerau_levenshtein(a, b) / longest if longest else 1.0


def scorer(fn: Callable[[str, str], float]) -> Callable[[Column, Column], Column]:
    """A column function from a scorer of two strings; a null on either side gives null. Equal pairs of a batch are scored once."""

    @F.pandas_udf(DoubleType())
    def scored(a: pd.Series, b: pd.Series) -> pd.Series:
        memo: dict[tuple[str, str], float] = {}
        out = []
        for pair in zip(a, b, strict=True):
            if pair[0] is None or pair[1] is None:
                out.append(None)
                continue
            if pair not in memo:
                memo[pair] = float(fn(*pair))
            out.append(memo[pair])
        return pd.Series(out, dtype="float64")

    return scored


ratio_col, token_sort_col, token_set_col, partial_col = map(scorer, (ratio, token_sort_ratio, token_set_ratio, partial_ratio))
jaro_winkler_col, dl_col = scorer(jaro_winkler), scorer(dl_similarity)
SCORERS = {"ratio": ratio_col, "token_sort_ratio": token_sort_col, "token_set_ratio": token_set_col, "partial_ratio": partial_col, "jaro_winkler": jaro_winkler_col, "damerau_levenshtein": dl_col}

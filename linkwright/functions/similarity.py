"""Similarities of pairs: set overlaps as Column expressions, edit ratios as Arrow UDFs over whole batches.

Edit ratios rest on the longest common subsequence (LCS), whose length is computed bit-parallel for all pairs of a batch at once in
64-bit words, for the partial ratio for all windows of a pair too, or in Python's long integers where the shorter string has
more than 64 characters.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD = 64
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)
_CELLS = 1 << 22


# --- set overlaps ---


def jaccard(a: Column, b: Column) -> Column:
    """1 for two empty sets, 0 if one is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both / (F.size(a) + F.size(b) - both))


def containment(a: Column, b: Column) -> Column:
    """The share of a that lies in b; 1 for two empty sets, 0 if only a is empty."""
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when(F.size(a) == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def length_ratio(a: Column, b: Column) -> Column:
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, 1.0).otherwise(F.least(F.length(a), F.length(b)) / longer)


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The different 3-grams of T.char_ngrams as numbers, text by text; the offset and the number of those of each text; an upper bound of
    the numbers. Few different characters make small numbers without a search."""
    size = np.array([len(x) for x in texts], np.int64)
    char = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    seen = np.zeros(0x110000, bool)
    seen[char] = True
    known = np.flatnonzero(seen)
    place, c = np.zeros(0x110000, np.int64), len(known) + 1
    place[known] = np.arange(1, c)
    char = place[char]
    first, owner = np.cumsum(size) - size, np.repeat(np.arange(len(texts)), size)
    begin = np.flatnonzero(np.arange(len(char)) + 3 <= (first + size)[owner])
    short = np.flatnonzero((size > 0) & (size < 3))
    key = char[first[short]]
    two = size[short] == 2
    key[two] = key[two] * c + char[first[short[two]] + 1]
    key = np.concatenate([(char[begin] * c + char[begin + 1]) * c + char[begin + 2], key])
    n = c**3
    if n > _CELLS:
        found, key = np.unique(key, return_inverse=True)
        n = max(1, len(found))
    key = np.sort(np.concatenate([owner[begin], short]) * n + key)  # far faster than np.unique, which hashes
    text, gram = np.divmod(key[np.diff(key, prepend=-1) > 0], n)
    size = np.bincount(text, minlength=len(texts))
    return gram, np.cumsum(size) - size, size, n


def gram_jaccards(a: list[str], b: list[str]) -> np.ndarray:
    """jaccard of the 3-grams of pairs of texts; the grams of a text that comes several times are made once. The grams of the side with
    fewer different texts are marked in a table of them all, a few texts at a time, where those of the other are looked up."""
    texts: dict[str, int] = {}
    x, y = (np.array([texts.setdefault(t, len(texts)) for t in side], np.int64) for side in (a, b))
    gram, first, size, n = _grams(list(texts))
    total = size[x] + size[y]
    own, x = np.unique(x, return_inverse=True)
    other, z = np.unique(y, return_inverse=True)
    if len(other) < len(own):
        own, x, y = other, z, own[x]
    order, both, step = np.argsort(x, kind="stable"), np.zeros(len(x), np.int64), max(1, _CELLS // n)
    for lo in range(0, len(own), step):
        part, pairs = own[lo : lo + step], order[slice(*np.searchsorted(x[order], [lo, lo + step]))]
        marked = np.zeros(len(part) * n, bool)
        m = size[part]
        marked[np.repeat(np.arange(len(part)) * n, m) + gram[ranges(first[part], m)]] = True
        m = size[y[pairs]]
        hit = marked[np.repeat((x[pairs] - lo) * n, m) + gram[ranges(first[y[pairs]], m)]]
        upto = np.concatenate([[0], np.cumsum(hit)])
        end = np.cumsum(m)
        both[pairs] = upto[end] - upto[end - m]
    return np.where(total == 0, 1.0, both / np.maximum(1, total - both))


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... of every range, one range after the other."""
    return np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)


def gram_jaccard(a: Column, b: Column) -> Column:
    """jaccard of the sets of T.char_ngrams, from the texts."""

    @F.pandas_udf("double")
    def overlap(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(gram_jaccards(a.fillna("").tolist(), b.fillna("").tolist()))

    return overlap(a, b)


# --- edit ratios ---


def _codes(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points, one row a string, padded with 0; lengths. A NUL becomes a code that no text has."""
    size = np.array([len(s) for s in strings], np.int64)
    flat = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    flat = np.where(flat == 0, 0x110000, flat)
    out = np.zeros((len(strings), int(size.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = flat
    return out, size


def _masks(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For every character of the rows of long the set of its places in the row of short (at most 64 wide) as bits."""
    same = np.zeros((*long.shape, _WORD), bool)
    same[:, :, : short.shape[1]] = (long[:, :, None] == short[:, None, :]) & (long[:, :, None] != 0)
    return np.packbits(same, axis=2, bitorder="little").view("<u8")[:, :, 0]


def _step(s: np.ndarray, masks: np.ndarray) -> np.ndarray:
    u = s & masks
    return (s + u) | (s - u)


def _matched(s: np.ndarray, size: np.ndarray) -> np.ndarray:
    """LCS lengths from final states, of strings of these sizes."""
    width = np.where(size >= _WORD, _ONES, (np.uint64(1) << np.minimum(size, _WORD - 1).astype(np.uint64)) - np.uint64(1))
    return np.bitwise_count(~s & width).astype(np.int64)


def _batches(order: np.ndarray, cells: np.ndarray):
    """Runs of order whose cells together are at most _CELLS, or a single one."""
    lo = 0
    while lo < len(order):
        hi = lo + max(1, int(np.searchsorted(np.cumsum(cells[order[lo : lo + 4096]]), _CELLS, "right")))
        yield order[lo:hi]
        lo = hi


def _lcs_long(a: str, b: str) -> int:
    masks: dict[str, int] = {}
    for j, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << j
    full = (1 << len(a)) - 1
    s = full
    for c in b:
        u = s & masks.get(c, 0)
        s = ((s + u) | (s - u)) & full
    return len(a) - s.bit_count()


def lcs(a: list[str], b: list[str]) -> np.ndarray:
    out = np.zeros(len(a), np.int64)
    short, long = zip(*((y, x) if len(x) > len(y) else (x, y) for x, y in zip(a, b))) if len(a) else ((), ())
    n, m = np.array([len(x) for x in long], np.int64), np.array([len(x) for x in short], np.int64)
    fits = np.flatnonzero((m > 0) & (m <= _WORD))
    for part in _batches(fits[np.argsort(n[fits], kind="stable")], n * _WORD):
        codes, size = _codes([short[i] for i in part])
        masks = _masks(codes, _codes([long[i] for i in part])[0])
        s = np.full(len(part), _ONES)
        for j in range(masks.shape[1]):
            s = _step(s, masks[:, j])
        out[part] = _matched(s, size)
    for i in np.flatnonzero(m > _WORD):
        out[i] = _lcs_long(short[i], long[i])
    return out


def indel_ratios(a: list[str], b: list[str]) -> np.ndarray:
    """2 LCS / (both lengths); 1 for two empty strings."""
    total = np.array([len(x) + len(y) for x, y in zip(a, b)], np.float64)
    return np.where(total > 0, 2 * lcs(a, b) / np.maximum(total, 1), 1.0)


def token_sort_ratios(a: list[str], b: list[str]) -> np.ndarray:
    return indel_ratios([" ".join(sorted(x.split())) for x in a], [" ".join(sorted(x.split())) for x in b])


def token_set_ratios(a: list[str], b: list[str]) -> np.ndarray:
    """The best of three comparisons: the words that differ, and the common words against each side. 1 if one side's words
    contain the other's, 0 if a side has none."""
    sides, sect = [], []
    for x, y in zip(a, b):
        p, q = set(x.split()), set(y.split())
        sides.append((" ".join(sorted(p - q)), " ".join(sorted(q - p)), bool(p), bool(q)))
        sect.append(len(" ".join(sorted(p & q))))
    common = lcs([s[0] for s in sides], [s[1] for s in sides])
    out = np.zeros(len(a))
    for i, ((ab, ba, some_a, some_b), k) in enumerate(zip(sides, sect)):
        if not (some_a and some_b):
            continue
        if k and (not ab or not ba):
            out[i] = 1.0
            continue
        gap = 1 if k else 0
        la, lb = k + gap + len(ab), k + gap + len(ba)
        best = 1 - (len(ab) + len(ba) - 2 * int(common[i])) / (la + lb)
        if k:
            best = max(best, 1 - (gap + len(ab)) / (k + la), 1 - (gap + len(ba)) / (k + lb))
        out[i] = best
    return out


def _best_window(s: list[str], t: list[str]) -> np.ndarray:
    """For strings s of one length, at most 64, and strings t that are no shorter: the best ratio of s with a window of t of that
    length, or with a shorter prefix or suffix. All windows of all pairs go through the characters of s's length side by side."""
    m, k = len(s[0]), len(s)
    codes, n = _codes(t)
    wide = codes.shape[1]
    masks = np.zeros((k, wide + 2 * m - 2), np.uint64)  # a window may begin before t and end after it
    masks[:, m - 1 : m - 1 + wide] = _masks(_codes(s)[0], codes)
    windows = wide + m - 1
    state = np.full((k, windows), _ONES)
    for j in range(m):
        state = _step(state, masks[:, j : j + windows])
    begin = np.arange(windows) - (m - 1)
    size = np.minimum(begin[None, :] + m, n[:, None]) - np.maximum(begin, 0)[None, :]
    found = _matched(state, np.full((1, 1), m))
    return np.where(size > 0, 2.0 * found / (m + np.maximum(size, 1)), 0.0).max(axis=1)


def _best_window_long(s: str, t: str) -> float:
    m = len(s)
    parts = {t[max(0, k) : k + m] for k in range(1 - m, len(t))}
    return max(2.0 * _lcs_long(s, p) / (m + len(p)) for p in parts)


def partial_ratios(a: list[str], b: list[str]) -> np.ndarray:
    """The best ratio of the shorter string with any part of the longer one of its length, or a shorter prefix or suffix; for
    equal lengths both ways round. 1 for two empty strings, 0 if one is empty."""
    out = np.array([1.0 if x == y else 0.0 for x, y in zip(a, b)])
    jobs = []  # shorter, longer, owner
    for i, (x, y) in enumerate(zip(a, b)):
        if x and y and x != y:
            jobs += [(x, y, i), (y, x, i)] if len(x) == len(y) else [(x, y, i) if len(x) < len(y) else (y, x, i)]
    m, n = (np.array([len(j[k]) for j in jobs], np.int64) for k in range(2))
    for length in np.unique(m):
        mine = np.flatnonzero(m == length)
        mine = mine[np.argsort(n[mine], kind="stable")]
        if length > _WORD:
            for i in mine:
                out[jobs[i][2]] = max(out[jobs[i][2]], _best_window_long(*jobs[i][:2]))
            continue
        for part in _batches(mine, n * _WORD):
            best = _best_window([jobs[i][0] for i in part], [jobs[i][1] for i in part])
            np.maximum.at(out, np.array([jobs[i][2] for i in part]), best)
    return out


RATIOS = {"levenshtein": indel_ratios, "token_sort": token_sort_ratios, "token_set": token_set_ratios, "partial": partial_ratios}


def _ratios(names: tuple[str, ...], a: list[str], b: list[str]) -> dict[str, np.ndarray]:
    """1 for two empty strings, 0 if one is empty, else the ratio. A pair that comes several times is measured once, and equal strings
    of words not at all."""
    pairs: dict[tuple[str, str], int] = {}
    at = np.array([pairs.setdefault(p, len(pairs)) for p in zip(a, b)], np.int64)
    known = np.array([1.0 if x == y and (not x or x.strip()) else 0.0 if not x or not y else -1.0 for x, y in pairs])
    rest = np.flatnonzero(known < 0)
    every = list(pairs)
    x, y = [every[i][0] for i in rest], [every[i][1] for i in rest]
    out = {}
    for name in names:
        value = known.copy()
        if len(rest):
            value[rest] = RATIOS[name](x, y)
        out[name] = value[at] if len(at) else np.zeros(0)
    return out


def _udf(names: tuple[str, ...]):
    schema = ", ".join(f"{n} double" for n in names)

    @F.pandas_udf(schema)
    def ratios(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        x, y = a.fillna("").tolist(), b.fillna("").tolist()
        return pd.DataFrame(_ratios(names, x, y))

    return ratios


def edit_ratios(a: Column, b: Column, *names: str) -> Column:
    """A struct of the named ratios (all by default) of two strings."""
    return _udf(names or tuple(RATIOS))(a, b)

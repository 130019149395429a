"""Suffix arrays by induced sorting, and permuted longest common prefixes.

Suffixes are classified as smaller or larger than their successor; the
leftmost-smaller substrings are sorted by inducing, named, and their string of names
is sorted by the same method; its order then induces that of all suffixes. Where the
alphabet is small, inducing handles a bucket's suffixes together as arrays; strings of
very many names are short, and are induced one by one.
"""

from __future__ import annotations

import numpy as np

# Mean suffixes a symbol must have for inducing by whole buckets.
_ARRAYS_FROM = 24


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Places of the suffixes of an integer array in ascending order; a prefix comes before what it begins."""
    n = len(text)
    if n < 2:
        return np.arange(n, dtype=np.int64)
    _, symbols = np.unique(text, return_inverse=True)
    return _sorted(symbols.astype(np.int64), int(symbols.max()) + 1)


def smaller_than_next(symbols: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the next one. The last is not: what follows it is the empty suffix."""
    n = len(symbols)
    step = np.sign(np.diff(symbols))
    # A run of equal symbols goes the way of its end.
    place = np.where(step != 0, np.arange(n - 1), n - 1)
    following = np.minimum.accumulate(place[::-1])[::-1]
    small = np.zeros(n, dtype=bool)
    inside = following < n - 1
    small[: n - 1][inside] = step[following[inside]] > 0
    return small


def _sorted(symbols: np.ndarray, alphabet: int) -> np.ndarray:
    n = len(symbols)
    small = smaller_than_next(symbols)
    leftmost = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    induce = _induced_by_arrays if alphabet * _ARRAYS_FROM <= n else _induced_one_by_one
    if len(leftmost) < 2:
        return induce(symbols, alphabet, small, leftmost)
    is_leftmost = np.zeros(n + 1, dtype=bool)
    is_leftmost[leftmost] = True
    first = induce(symbols, alphabet, small, leftmost)
    in_order = first[is_leftmost[first]]
    names = _names(symbols, in_order, leftmost, n)
    reduced = names[leftmost]
    count = int(reduced.max()) + 1
    if count == len(leftmost):
        order = np.empty(count, dtype=np.int64)
        order[reduced] = np.arange(count)
    else:
        order = _sorted(reduced, count)
    return induce(symbols, alphabet, small, leftmost[order])


def _names(symbols: np.ndarray, in_order: np.ndarray, leftmost: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the leftmost-smaller substrings; equal substrings have equal numbers, in ascending order."""
    length = np.zeros(n, dtype=np.int64)
    length[leftmost] = np.append(leftmost[1:], n) - leftmost + 1
    length[leftmost[-1]] = n - leftmost[-1] + 1  # reaches the empty suffix, which no other does
    one, other = in_order[:-1], in_order[1:]
    same = length[one] == length[other]
    same &= (one != leftmost[-1]) & (other != leftmost[-1])
    open_pairs = np.flatnonzero(same)
    step = 0
    while len(open_pairs):
        a, b = one[open_pairs] + step, other[open_pairs] + step
        differs = symbols[a] != symbols[b]
        same[open_pairs[differs]] = False
        step += 1
        open_pairs = open_pairs[~differs & (step < length[one[open_pairs]])]
    names = np.zeros(n, dtype=np.int64)
    names[in_order] = np.append(0, np.cumsum(~same))
    return names


def _induced_by_arrays(symbols: np.ndarray, alphabet: int, small: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    n = len(symbols)
    sizes = np.bincount(symbols, minlength=alphabet)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    found = np.full(n, -1, dtype=np.int64)

    def dealt(places: np.ndarray, heads: np.ndarray, forwards: bool) -> None:
        """Put suffixes at the open ends of their buckets, in the order given."""
        if not len(places):
            return
        own = symbols[places]
        # Numbers of 16 bits are sorted by their digits.
        order = np.argsort(own.astype(np.uint16) if alphabet <= 1 << 16 else own, kind="stable")
        own, places = own[order], places[order]
        new = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        counts = np.diff(np.append(new, len(own)))
        within = np.arange(len(own)) - np.repeat(new, counts)
        if forwards:
            found[heads[own] + within] = places
            heads[own[new]] += counts
        else:
            found[heads[own] - 1 - within] = places
            heads[own[new]] -= counts

    # Leftmost-smaller suffixes at the ends of their buckets, in the order given.
    tails = ends.copy()
    dealt(leftmost[::-1], tails, False)
    heads = starts.copy()
    dealt(np.array([n - 1]), heads, True)
    for bucket in range(alphabet):
        at = starts[bucket]
        while at < heads[bucket]:
            part, at = found[at : heads[bucket]], heads[bucket]
            part = part[part > 0] - 1
            part = part[~small[part]]
            if len(part):
                dealt(part, heads, True)
        part = found[max(tails[bucket], at) : ends[bucket]]
        part = part[part > 0] - 1
        if len(part):
            dealt(part[~small[part]], heads, True)
    # Smaller suffixes from the right; they take the places of the leftmost ones.
    tails = ends.copy()
    for bucket in range(alphabet - 1, -1, -1):
        at = ends[bucket]
        while at > tails[bucket]:
            part, at = found[tails[bucket] : at][::-1], tails[bucket]
            part = part[part > 0] - 1
            part = part[small[part]]
            if len(part):
                dealt(part, tails, False)
        part = found[starts[bucket] : heads[bucket]][::-1]
        part = part[part > 0] - 1
        part = part[small[part]]
        if len(part):
            dealt(part, tails, False)
    return found


def _induced_one_by_one(symbols: np.ndarray, alphabet: int, small: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    n = len(symbols)
    sizes = np.bincount(symbols, minlength=alphabet)
    ends = np.cumsum(sizes)
    text, found = symbols.tolist(), [-1] * n
    tails = ends.tolist()
    for place in reversed(leftmost.tolist()):
        at = tails[text[place]] - 1
        tails[text[place]] = at
        found[at] = place
    heads = (ends - sizes).tolist()
    found[heads[text[n - 1]]] = n - 1
    heads[text[n - 1]] += 1
    # For each place the symbol before it if the suffix there is of the kind that is induced; the last stands for none.
    before = np.concatenate([[-1], symbols[:-1], [-1]])
    larger, smaller = before.copy(), before
    larger[1:n][small[: n - 1]] = -1
    smaller[1:n][~small[: n - 1]] = -1
    induced = larger.tolist()
    # What is put further on comes up in the same pass.
    for place in found:
        symbol = induced[place]
        if symbol >= 0:
            at = heads[symbol]
            heads[symbol] = at + 1
            found[at] = place - 1
    tails, induced = ends.tolist(), smaller.tolist()
    for place in reversed(found):
        symbol = induced[place]
        if symbol >= 0:
            at = tails[symbol] - 1
            tails[symbol] = at
            found[at] = place - 1
    return np.array(found, dtype=np.int64)


def permuted_common_prefixes(text: np.ndarray, suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix, in text order, its predecessor in the array (-1 for the first) and their common prefix's length.

    A suffix whose left neighbour equals its predecessor's has one less than that
    neighbour; so only the others are compared, and the rest follows from them.
    """
    n = len(text)
    before = np.full(n, -1, dtype=np.int64)
    before[suffixes[1:]] = suffixes[:-1]
    place = np.arange(n)
    follows = np.zeros(n, dtype=bool)
    inner = (place > 0) & (before > 0)
    follows[inner] = text[place[inner] - 1] == text[before[inner] - 1]
    # One less than the neighbour's holds where the neighbour's predecessor is the predecessor's neighbour.
    follows[inner] &= before[place[inner] - 1] == before[inner] - 1
    common = np.zeros(n, dtype=np.int64)
    waiting = np.flatnonzero(~follows & (before >= 0))
    length = 0
    while len(waiting):
        ahead = np.maximum(waiting, before[waiting]) + length < n
        waiting = waiting[ahead]
        waiting = waiting[text[waiting + length] == text[before[waiting] + length]]
        length += 1
        common[waiting] = length
    reach = np.where(follows, -1, place + common)
    return before, np.maximum.accumulate(reach) - place

"""Burrows-Wheeler transform and common prefixes of a collection of strings, built column by column.

Strings are aligned at their ends. Each round puts one more suffix of every string that is long enough into the
sorted order: its place follows from the symbol before the suffix of the round before, and how often that symbol
stands above there in the transform. Both sequences, the places of each symbol in the transform and the lengths of
common prefixes of neighbours, are read and rewritten from front to back once a round; nothing else is held of the
suffixes. The transform itself is written from the places at the end.
"""

from __future__ import annotations

import numpy as np

STEP = 64


def _range_minima(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Minimum of values[start:end] for each pair; no range is empty, and the last value is in none."""
    if not len(starts):
        return np.empty(0, values.dtype)
    # A long range is whole blocks and the two pieces beside them; so it costs its length over STEP.
    out = np.full(len(starts), np.iinfo(values.dtype).max, values.dtype)
    low, high = -(-starts // STEP), ends // STEP
    wide = low + 1 < high
    jobs = [(~wide, values, starts, ends)]
    if wide.any():
        blocks = np.minimum.reduceat(values, np.arange(0, len(values), STEP))
        jobs += [(wide, values, starts, low * STEP), (wide, np.append(blocks, blocks[-1]), low, high),
                 (wide, values, high * STEP, ends)]
    for mask, source, first, last in jobs:
        chosen = np.flatnonzero(mask & (first < last))
        if len(chosen):
            chosen = chosen[np.argsort(-first[chosen], kind="stable")]  # so that reduceat does nothing in between
            pairs = np.stack([first[chosen], last[chosen]], 1).ravel()
            out[chosen] = np.minimum(out[chosen], np.minimum.reduceat(source, pairs)[::2])
    return out


def _widened(old: np.ndarray, free: np.ndarray, places: np.ndarray, new: np.ndarray) -> np.ndarray:
    """`old` with the values `new` put in at `places`; `free` marks the places of the old values."""
    out = np.empty(len(free), old.dtype)
    out[free] = old
    out[places] = new
    return out


def build(strings: list[bytes], most: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """(transform, common prefixes) of the strings, each with an end mark of its own below all symbols.

    Symbols are byte + 1 and must be below 255, which bytes of UTF-8 are; 0 is the end mark. Common prefixes are
    those of a suffix and the one before it, at most `most`. Equal suffixes are in the order of their strings.
    """
    count = len(strings)
    lengths = np.fromiter(map(len, strings), np.int64, count)
    longest = int(lengths.max(initial=0))
    columns = np.zeros((longest + 1, count), np.uint8)  # columns[t] is the symbol t places before the end
    for k, string in enumerate(strings):
        columns[:len(string), k] = np.frombuffer(string, np.uint8)[::-1]
    columns[:-1] += (np.arange(longest)[:, None] < lengths).astype(np.uint8)
    held = count  # suffixes so far
    prefixes = np.zeros(count + 1, np.uint16)  # one more at the end, which is in no range
    # For the suffixes with a symbol, in order: where the symbol that they begin with stands in the transform.
    source = np.empty(0, np.int32)
    totals = np.zeros(256, np.int64)  # suffixes by their first symbol
    place = np.arange(count)
    for t in range(1, longest + 1):
        active = np.flatnonzero(lengths >= t)
        active = active[np.argsort(place[active], kind="stable")]
        active = active[np.argsort(columns[t - 1, active], kind="stable")]
        symbol, here = columns[t - 1, active].astype(np.int64), place[active]
        size = len(active)
        tops = np.cumsum(totals) - totals
        cuts = [0, *(np.flatnonzero(np.diff(symbol)) + 1).tolist(), size]
        smaller = np.empty(size, np.int64)
        for first, last in zip(cuts, cuts[1:]):
            low = int(tops[symbol[first]])
            smaller[first:last] = low + np.searchsorted(source[low:low + int(totals[symbol[first]])], here[first:last])
        # The symbol's places in the transform next above and below: of an older suffix, or of one of this round.
        above, below = np.full(size, -1), np.full(size, held)
        older = smaller > tops[symbol]
        above[older] = source[smaller[older] - 1]
        older = smaller < tops[symbol] + totals[symbol]
        below[older] = source[smaller[older]]
        same = np.flatnonzero(symbol[1:] == symbol[:-1])
        above[same + 1] = np.maximum(above[same + 1], here[same])
        below[same] = np.minimum(below[same], here[same + 1])
        before, after = np.zeros(size, np.uint16), np.zeros(size, np.uint16)
        some, other = above >= 0, below < held
        before[some] = _range_minima(prefixes, above[some] + 1, here[some] + 1) + 1
        after[other] = _range_minima(prefixes, here[other] + 1, below[other] + 1) + 1
        np.minimum(before, most, out=before)
        np.minimum(after, most, out=after)
        target = count + smaller + np.arange(size)  # ascending
        free = np.ones(held + size + 1, bool)
        free[target] = False
        moved = np.flatnonzero(free).astype(np.int32)  # where each place of the transform is now
        source = _widened(moved[source], free[count:-1], target - count, moved[here])
        prefixes = _widened(prefixes, free, target, before)
        prefixes[target[other] + 1] = after[other]
        np.add.at(totals, symbol, 1)
        place[active] = target
        held += size
    # The symbols are in the order of the suffixes that they begin; no symbol stands before a whole string.
    transform = np.zeros(held, np.uint8)
    transform[source] = np.repeat(np.arange(256, dtype=np.uint8), totals)
    return transform, prefixes[:-1]


def repeated_starts(strings: list[bytes], width: int) -> list[np.ndarray]:
    """For each string the sorted starts of its substrings of `width` bytes that stand anywhere else, too.

    Elsewhere is another place of the collection, the same string included.
    """
    count = len(strings)
    transform, prefixes = build(strings, width)
    order = np.argsort(transform, kind="stable")
    marks = int((transform == 0).sum())
    step = np.empty(len(transform), np.int64)
    step[order[marks:]] = count + np.arange(len(order) - marks)
    prefixes = np.append(prefixes, 0)
    hit = np.maximum(prefixes[:-1], prefixes[1:]) >= width
    lengths = np.fromiter(map(len, strings), np.int64, count)
    place, found = np.arange(count), [[] for _ in strings]
    # From each end mark backwards: the place of a string's suffix that is one longer is one step away.
    for t in range(1, int(lengths.max(initial=0)) + 1):
        active = np.flatnonzero(lengths >= t)
        place[active] = step[place[active]]
        if t >= width:
            for k in active[hit[place[active]]].tolist():
                found[k].append(int(lengths[k]) - t)
    return [np.array(starts[::-1], np.int64) for starts in found]

"""Equal windows of a collection of short strings, from its Burrows-Wheeler
transform, which is built column by column.

Round j inserts the suffix of length j of every string at once, beginning
with the empty ones.  Where a suffix goes follows from the transform alone:
it stands as many rows below the first with its first symbol as there are
equal symbols above the row of the suffix that it extends.

The transform is kept inverted: symbol after symbol, the rows in which it
stands.  This list is sorted and has one entry a row (that of the suffix which
begins with the symbol), so a search in it counts the equal symbols above a
row.  Rows of the last ``COLUMNS`` rounds wait in a list of their own, which
is short, so that the whole transform isn't rewritten in every round.
"""

from __future__ import annotations

import numpy as np

#: Rounds after which the transform takes in the rows that wait.
COLUMNS = 8
#: Windows that are compared at a time.
COMPARED = 1 << 16


def _inverted(symbols: np.ndarray, sizes: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """The inverted transform of texts at the right edge of ``symbols``, an
    entry being symbol << shift | row, and the row of each whole text."""
    m, most = symbols.shape
    bits = (COLUMNS * m).bit_length()
    columns = np.ascontiguousarray(symbols.T)[::-1]
    entries = np.arange(m)  # the empty suffixes; they begin with the end, symbol 0
    row = entries.copy()  # where the longest suffix of each string stands
    # of the rows that wait: the symbol, the suffix without it, the rows above, those that wait among them
    symbol, tail, gap, rank = np.empty((4, COLUMNS * m), np.int64)
    count = np.arange(COLUMNS * m)
    place = np.empty(m + COLUMNS * m, np.int64)
    for begin in range(0, most, COLUMNS):
        # a place is a row of the transform and what orders the waiting rows above it
        place[:m] = row << bits | (1 << bits) - 1
        longest = count[:m].copy()  # in ``place``
        n = 0
        for j in range(begin, min(begin + COLUMNS, most)):
            active = np.flatnonzero(sizes > j)
            new, n = slice(n, n + len(active)), n + len(active)
            symbol[new] = columns[j][active] << shift
            tail[new] = longest[active]
            longest[active] = m + count[new]
            gap[new] = np.searchsorted(entries, symbol[new] | place[tail[new]] >> bits)
            rank[np.argsort(symbol[:n] << bits | place[tail[:n]])] = count[:n]
            place[m : m + n] = gap[:n] << bits | rank[:n]
        # what is inserted above a row moves it down
        down = np.cumsum(np.bincount(gap[:n], minlength=len(entries) + 1)[:-1])
        full = np.concatenate([row + down[row], gap[:n] + rank[:n]])
        grown = np.empty(len(entries) + n, np.int64)
        grown[np.arange(len(entries)) + down] = entries + down[entries & (1 << shift) - 1]
        grown[full[m:]] = symbol[:n] | full[tail[:n]]
        entries, row = grown, full[longest]
    return entries, row


def equal_windows(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all windows of ``width`` bytes: string, offset and group, a number
    that equal windows share.  The rows are in the order of the windows."""
    sizes = np.array([len(s) for s in strings], np.int64)
    most = int(sizes.max(initial=0))
    none = np.zeros(0, np.int64)
    if most < width:
        return none, none, none
    # texts at the right edge; symbol 0 stands for the end, others for the bytes that occur
    inside = np.arange(most) >= most - sizes[:, None]
    cells = np.zeros((len(strings), most), np.uint8)
    cells[inside] = np.frombuffer(b"".join(strings), np.uint8)
    symbols = np.cumsum(np.bincount(cells[inside], minlength=256) > 0)[cells]
    symbols[~inside] = 0
    shift = int(sizes.sum() + len(strings)).bit_length()
    entries, row = _inverted(symbols, sizes, shift)
    # from each whole text on, the rows of the suffixes that hold a window
    whole = np.full(len(entries), -1)
    offset = np.zeros(len(entries), np.int64)
    for o in range(most - width + 1):
        who = np.flatnonzero(sizes >= o + width)
        at = row[who]
        whole[at], offset[at] = who, o
        row[who] = entries[at] & (1 << shift) - 1
    held = np.flatnonzero(whole >= 0)
    who, offset = whole[held], offset[held]
    # neighbours with a prefix of that length in common
    windows = np.lib.stride_tricks.sliding_window_view(cells, width, axis=1)
    new = np.ones(len(who), bool)
    for i in range(1, len(who), COMPARED):
        some = slice(i - 1, i + COMPARED)
        x = windows[who[some], (most - sizes[who] + offset)[some]]
        new[i : i + COMPARED] = (x[1:] != x[:-1]).any(axis=1)
    return who, offset, np.cumsum(new)

"""Column-wise construction of a collection's Burrows-Wheeler transform and LCP array.

The texts of a collection are cut into symbols of ``BLOCK`` bytes, once for every
phase 0 .. BLOCK-1, so that a suffix exists for every byte position. Each round
inserts one symbol per document, from the documents' ends to their starts: the new
suffix ``cS`` goes where the rank of ``c`` at ``S``'s place in the transform says
(LF step), and its common prefix with its neighbours is one more than the smallest
common prefix between the places of the two rests. The sorted collection lives in
sequential files; a round reads the old ones from front to back, merges the new
suffixes in, and writes the next ones. A block that stands at one position of the
collection lies in no repeated string, so columns and documents that no string of
shared blocks needs are not inserted.
"""

from __future__ import annotations

import tempfile
from pathlib import Path

import numpy as np

BLOCK = 80
_COLUMNS = (("key", np.int64), ("lcp", np.uint8), ("suffix", np.int32))
_REST = np.int64((1 << 32) - 1)


class _Files:
    """The sorted suffixes, one sequential file per column.

    key: first symbol, and in the low 32 bits one more than the place of the suffix
    without it (0 for a document's last symbol); lcp: symbols in common with the suffix
    before, at most 255; suffix: document * width + column.
    """

    def __init__(self, folder: str):
        self.folder, self.turn = Path(folder), 0

    def _path(self, name: str, turn: int) -> Path:
        return self.folder / f"{name}.{turn}"

    def read(self) -> dict[str, np.ndarray]:
        if not self.turn:
            return {n: np.zeros(0, t) for n, t in _COLUMNS}
        return {n: np.fromfile(self._path(n, self.turn), t) for n, t in _COLUMNS}

    def write(self, columns: dict[str, np.ndarray]) -> None:
        self.turn += 1
        for n, t in _COLUMNS:
            columns[n].astype(t, copy=False).tofile(self._path(n, self.turn))
            self._path(n, self.turn - 1).unlink(missing_ok=True)


class _RangeMin:
    """Smallest value of any range, from a table of power-of-two windows."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Over lo..hi, both included, lo <= hi."""
        power = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
        out = np.empty(len(lo), np.uint8)
        for p in np.unique(power):
            at = np.flatnonzero(power == p)
            level = self.levels[p]
            out[at] = np.minimum(level[lo[at]], level[hi[at] - (1 << int(p)) + 1])
        return out


def _dense(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense ranks, and for every rank one position that has it."""
    order = np.argsort(codes)
    ordered = codes[order]
    new = np.concatenate((np.ones(1, bool), ordered[1:] != ordered[:-1]))
    rank = np.empty(len(codes), np.int64)
    rank[order] = np.cumsum(new) - 1
    return rank, order[new]


def _words(flat: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on, as one number."""
    padded = np.concatenate((flat, np.zeros(BLOCK, np.uint8)))
    word = np.zeros(len(flat) + BLOCK - 8, np.uint64)
    for i in range(8):
        word |= padded[i:i + len(word)].astype(np.uint64) << np.uint64(8 * i)
    return word


def _block_hash(word: np.ndarray, n: int) -> np.ndarray:
    """Hash of the block at each of the first n positions."""
    code = np.zeros(n, np.uint64)
    for i in range(0, BLOCK, 8):
        code ^= word[i:i + n]
        code *= np.uint64(0x9E3779B97F4A7C15)
        code ^= code >> np.uint64(29)
    return code


def _bucket_bits(n: int) -> int:
    """Buckets for n hashes: about one to two each."""
    return max(10, n.bit_length())


def _maybe_shared(code: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """False where the block is for sure the only one of its kind among those ``inside``."""
    bits = _bucket_bits(len(code))
    bucket = (code >> np.uint64(64 - bits)).astype(np.int32)
    return inside & (np.bincount(bucket[inside], minlength=1 << bits) > 1)[bucket]


def _symbols(word: np.ndarray, code: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Dense symbol of the block at each position of ``at``. Blocks are ranked by their hash,
    and every block is compared with its symbol's first one; should two blocks collide,
    all are ranked again, eight bytes at a time."""
    steps = range(0, BLOCK, 8)
    if not len(at):
        return np.zeros(0, np.int64)
    symbol, one = _dense(code[at])
    first = at[one][symbol]
    other = np.flatnonzero(first != at)
    here, there = at[other], first[other]
    if all(np.array_equal(word[here + i], word[there + i]) for i in steps):
        return symbol
    symbol = np.zeros(len(at), np.int64)
    for i in steps:
        part = _dense(word[at + i])[0]
        symbol = _dense((symbol << 32) | part)[0]
    return symbol


def _insert(files: _Files, symbol: np.ndarray, place: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """One round: inserts ``symbol`` before the suffixes at ``place`` (-1: the empty
    suffix). Returns the places of the new suffixes."""
    old = files.read()
    key, m = old["key"], len(old["key"])
    new_key = (symbol << 32) | (place + 1)
    order = np.argsort(new_key)
    new_key = new_key[order]
    # equal keys are equal suffixes only for last symbols: new ones go behind old ones
    at = np.searchsorted(key, new_key, side="right") + np.arange(len(order))
    fresh = np.zeros(m + len(order), bool)
    fresh[at] = True
    kept = np.flatnonzero(~fresh)                  # new places of the old suffixes
    merged = np.empty(m + len(order), np.int64)
    merged[kept], merged[at] = key, new_key

    # common prefixes of new suffixes with what is before, and of old ones behind new ones
    lcp = np.zeros(m + len(order), np.uint8)
    lcp[kept] = old["lcp"]
    after = at + 1
    after = after[after < len(merged)]
    todo = np.concatenate((at, after[~fresh[after]]))
    todo = todo[todo > 0]
    before, here = merged[todo - 1], merged[todo]
    same = (before >> 32) == (here >> 32)
    lcp[todo[~same]] = 0
    todo, lo, hi = todo[same], before[same] & _REST, here[same] & _REST
    ends = lo == 0                                 # a rest is empty: one symbol in common
    lcp[todo[ends]] = 1
    if m and not ends.all():
        # from behind the one rest up to the other
        least = _RangeMin(old["lcp"])(lo[~ends], hi[~ends] - 1)
        lcp[todo[~ends]] = np.minimum(least, 254) + 1

    # places move by what is inserted before them
    to = np.concatenate((np.zeros(1, np.int64), kept + 1))
    place_of = to[merged & _REST]
    merged &= ~_REST
    merged |= place_of
    ids = np.empty(m + len(order), np.int32)
    ids[kept], ids[at] = old["suffix"], suffix[order]
    files.write({"key": merged, "lcp": lcp, "suffix": ids})
    out = np.empty(len(order), np.int64)
    out[order] = at
    return out


def repeated_starts(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For every text the positions whose next ``length`` bytes start anywhere else in
    the collection too. ``length`` is a multiple of ``BLOCK``."""
    depth = length // BLOCK
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes)))[:-1]
    flat = np.frombuffer(b"".join(texts), np.uint8)
    left = np.repeat(starts + sizes, sizes) - np.arange(len(flat))      # bytes to the text's end
    word = _words(flat)
    code = _block_hash(word, len(flat))
    shared = _maybe_shared(code, left >= BLOCK)
    whole = left >= length
    for i in range(0, min(length, len(flat)), BLOCK):
        whole[:len(flat) - i] &= shared[i:]
    string = np.flatnonzero(whole)                 # starts of strings that may be repeated
    # documents: the symbols of one text and phase, from the first of these strings to the last
    text = np.repeat(np.arange(len(texts)), sizes)[string]
    column = (string - starts[text]) // BLOCK
    doc = text * BLOCK + (string - starts[text]) % BLOCK
    order = np.argsort(doc, kind="stable")
    new = np.flatnonzero(np.diff(doc[order], prepend=-1))
    first_at = string[order[new]]
    last = order[np.append(new[1:], len(order)) - 1] if len(order) else order
    width = column[last] + depth - column[order[new]]
    columns = int(width.max(initial=0))
    if len(width) * max(columns, 1) >= 1 << 31:
        raise ValueError("the collection is too large for one shard")
    used = np.zeros(len(flat), bool)
    for c in range(columns):
        used[first_at[width > c] + c * BLOCK] = True
    at = np.flatnonzero(used)
    symbol_at = np.cumsum(used) - 1
    symbols = _symbols(word, code, at)
    place = np.full(len(width), -1, np.int64)
    # rounds of all documents end together at column 0; a shorter one joins later
    with tempfile.TemporaryDirectory() as folder:
        files = _Files(folder)
        for column in range(columns - 1, -1, -1):
            active = np.flatnonzero(width > column)
            symbol = symbols[symbol_at[first_at[active] + column * BLOCK]]
            suffix = (active * columns + column).astype(np.int32)
            moved = np.full(len(place), -1, np.int64)
            moved[active] = _insert(files, symbol, place[active], suffix)
            place = moved
        done = files.read()
    deep = done["lcp"] >= depth
    deep[:-1] |= deep[1:].copy()
    hit = done["suffix"][deep].astype(np.int64)
    doc, column = hit // max(columns, 1), hit % max(columns, 1)
    flags = np.zeros(len(flat), bool)
    flags[first_at[doc] + column * BLOCK] = True
    return [np.flatnonzero(flags[a:a + n]) for a, n in zip(starts.tolist(), sizes.tolist())]

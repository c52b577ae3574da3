"""64-bit hashes of all words of many texts at once, in numpy.

The bytes of a word are looked up in a table of random numbers and added up with powers of a random odd number, modulo
2^64. Running sums over the whole buffer give every word's sum as a difference, so the cost is that of some passes over
the bytes, whatever the words are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

# Bytes that are hashed together, few enough for the sums over them to stay in a processor's cache; longer texts are cut
# at a space, texts without one as they are.
BUFFER = 1 << 17

_U = np.uint64
_rng = np.random.default_rng(20_240_607)
_BYTES = _rng.integers(1, 1 << 63, 256, dtype=_U) * _U(2) + _U(1)
_BASE = int(_rng.integers(1 << 61, 1 << 62)) * 4 + 3
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_powers: list[np.ndarray] = []


def _tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``size`` of each."""
    if not _powers or len(_powers[0]) < size:
        count = max(size, BUFFER + 2)
        _powers.clear()
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(count, base & ((1 << 64) - 1), _U)
            steps[0] = 1
            _powers.append(np.multiply.accumulate(steps))
    return _powers[0], _powers[1]


def _hashed(buffer: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first bytes) of the words of a buffer."""
    a = np.frombuffer(buffer, np.uint8)
    outside = np.ones(len(a) + 2, bool)
    # bytes 9 to 13: smaller ones wrap around
    np.less(a - np.uint8(9), 5, out=outside[1:-1])
    outside[1:-1] |= a == 32
    edges = np.flatnonzero(outside[1:] != outside[:-1])
    first, past = edges[::2], edges[1::2]
    up, down = _tables(len(a) + 1)
    values = np.take(_BYTES, a)
    values *= up[: len(a)]
    sums = np.zeros(len(a) + 1, _U)
    np.cumsum(values, out=sums[1:])
    h = sums[past]
    h -= sums[first]
    h *= down[first]
    h ^= h >> _U(31)
    h *= _U(0x9E3779B97F4A7C15)
    h ^= h >> _U(29)
    return h, first


def _cut(text: bytes) -> Iterator[bytes]:
    """A long text in pieces that begin and end with whole words."""
    at = 0
    while len(text) - at > BUFFER:
        end = at + BUFFER
        # whole words only: back to a space, or on to the next one
        window = np.flatnonzero(_SPACE[np.frombuffer(text, np.uint8, end - at, at)])
        if len(window):
            end = at + int(window[-1]) + 1
        else:
            later = np.flatnonzero(_SPACE[np.frombuffer(text, np.uint8, offset=end)])
            end = end + int(later[0]) + 1 if len(later) else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def hashes_in_rows(texts: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For some texts at a time, the hashes (uint64) of all their words in order, and every text's number of words."""
    held: list[bytes] = []
    size = 0

    def flush() -> tuple[np.ndarray, np.ndarray]:
        h, first = _hashed(b"\n".join(held))
        past = np.cumsum([len(t) + 1 for t in held])
        return h, np.diff(np.searchsorted(first, past), prepend=0)

    for text in texts:
        if len(text) > BUFFER:
            if held:
                yield flush()
                held, size = [], 0
            h = np.concatenate([_hashed(piece)[0] for piece in _cut(text)])
            yield h, np.array([len(h)])
            continue
        if size + len(text) > BUFFER:
            yield flush()
            held, size = [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield flush()


def split_rows(row: np.ndarray, lengths: np.ndarray) -> Iterator[np.ndarray]:
    """The parts of a row that have these lengths."""
    begin = 0
    for end in np.cumsum(lengths).tolist():
        yield row[begin:end]
        begin = end


def word_hashes(texts: Iterable[bytes]) -> Iterator[np.ndarray]:
    """Per text, the hashes (uint64) of its words in order; words stand between the six ASCII spaces."""
    for h, lengths in hashes_in_rows(texts):
        yield from split_rows(h, lengths)


class Places:
    """Sorted hashes (uint64) that others are looked up in.

    A table by the leading bits tells where to begin, at most a few entries before the place, so a look-up touches two
    places of memory and not one for every halving.
    """

    def __init__(self, hashes: np.ndarray) -> None:
        # one entry more, so that every search ends at an entry
        self.hashes = np.append(hashes, _U((1 << 64) - 1))
        bits = max(len(hashes), 1).bit_length() + 2
        self.shift = _U(64 - bits)
        found = np.bincount((hashes >> self.shift).view(np.int64), minlength=1 << bits)
        self.begins = (np.cumsum(found) - found).astype(np.int32)

    def of(self, h: np.ndarray) -> np.ndarray:
        """The first places whose entries are not smaller, as ``searchsorted`` finds them."""
        at = np.take(self.begins, (h >> self.shift).view(np.int64))
        late = np.flatnonzero(np.take(self.hashes, at) < h)
        while len(late):
            at[late] += 1
            late = late[self.hashes[at[late]] < h[late]]
        return at

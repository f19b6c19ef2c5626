"""Words of Arrow text columns, as NumPy arrays over the UTF-8 bytes.

A column is handled in slices of half a MB, whatever the size of the batch, so the
memory of a task follows the longest text and not the number of rows. All hashes
are 64 bits wide and the same on every machine.
"""

import numpy as np
import pyarrow as pa

SLICE_BYTES = 500_000  # hashing takes about fifty in memory for each
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_SEED = np.random.default_rng(20240611).integers(1, 1 << 63, 256, dtype=np.uint64) * 2 + 1

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def texts_of(column):
    """An Arrow column as a plain string array; null becomes the empty string."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_string()).fill_null("")


def slices(column, limit=SLICE_BYTES):
    """(first row, end row, bytes, offsets) of runs of rows of about ``limit`` bytes."""
    column = texts_of(column)
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        part = offsets[at : end + 1]
        yield at, end, data[part[0] : part[-1]], part - part[0]
        at = end


def spans(data, offsets, inside):
    """Starts and ends of the runs of bytes for which ``inside``, and each row's first run.

    ``first`` has one entry more than there are rows, as ``offsets`` has.
    """
    here = np.zeros(len(data) + 2, bool)
    here[1:-1] = inside[data]
    begins, ends = here[1:-1] & ~here[:-2], here[1:-1] & ~here[2:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edges] = here[edges + 1]
    ends[edges - 1] = here[edges]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def _power_tables(n):
    global _powers
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        both = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        if n > 2 * SLICE_BYTES:  # for one long text only, not kept
            return both
        _powers = tuple(both)
    return _powers


def mix(x):
    """Spread the bits of hashes."""
    x = (x ^ (x >> np.uint64(33))) * _MIX
    return x ^ (x >> np.uint64(29))


def span_hashes(data, starts, ends):
    """A hash of each span of bytes; equal spans have equal hashes."""
    up, down = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_SEED[data] * up[: len(data)], out=total[1:])
    lengths = (ends - starts).astype(np.uint64)
    return mix((total[ends] - total[starts]) * down[starts] + lengths * _MIX)


def windows(hashes, size):
    """A hash of each run of ``size`` consecutive words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * np.uint64(_BASE) + hashes[i : i + n]
    return mix(out)

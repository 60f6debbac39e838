"""Vectorised byte and word hashing, and minimizer stretches (numpy, in tasks).

A *window* is W consecutive symbols (bytes or words) of one text.  Its anchor
is the K-gram with the smallest hash inside it (the leftmost of equal ones), a
rule that looks at the window's own symbols only, so equal windows have equal
anchors at equal offsets.  A *stretch* is a maximal run of neighbouring windows
with one and the same anchor occurrence; every window lies in exactly one
stretch.  There are about 2 / (W - K + 2) stretches a symbol.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_POS_BITS = U(18)
SEGMENT = 1 << 18  # symbols hashed at a time; longer texts are cut with overlap
_TABLE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i in [0, n)."""
    if len(_powers.get("up", ())) < n:
        size = max(n, SEGMENT + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            p = np.full(size, U(base))
            p[0] = U(1)
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> U(31))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(29))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """S with hash(i, j) = (S[j] - S[i]) * base**i, see ``span_hash``."""
    _, down = _power(len(values) + 1)
    s = np.zeros(len(values) + 1, U)
    np.cumsum(values * down[: len(values)], out=s[1:])
    return s


def span_hash(s: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed polynomial hashes of values[start:end]; the length takes part."""
    up, _ = _power(len(s))
    return mix((s[end] - s[start]) * up[start] + (end - start).astype(U) * U(0x2545F4914F6CDD1D))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of an Arrow string or binary column, and offsets
    (one more than rows).  Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string()).fill_null("").cast(pa.large_binary())
    else:
        column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def byte_values(data: np.ndarray) -> np.ndarray:
    return _TABLE[data]


def blocks(offsets: np.ndarray, limit: int = SEGMENT):
    """Row ranges [a, b) of at most ``limit`` bytes together, or one row."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = b


def words(data: np.ndarray, offsets: np.ndarray):
    """Words (runs without ASCII white space) of the texts data[offsets[i]:offsets[i+1]].

    Returns (hash, start, end, first): 64-bit hash and byte range of each word,
    and for each text the index of its first word (one more entry than texts)."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    buf = data[lo:hi]
    solid = ~_SPACE[buf]
    before = np.empty(len(buf), bool)
    after = np.empty(len(buf), bool)
    if len(buf):
        before[0], before[1:] = True, ~solid[:-1]
        after[-1], after[:-1] = True, ~solid[1:]
        inner = (offsets[1:-1] - lo).astype(np.int64)
        before[inner[inner < len(buf)]] = True
        after[inner[inner > 0] - 1] = True
    start = np.flatnonzero(solid & before)
    end = np.flatnonzero(solid & after) + 1
    h = span_hash(prefix_sums(_TABLE[buf]), start, end) if len(start) else np.zeros(0, U)
    first = np.searchsorted(start, offsets - lo)
    return h, start + lo, end + lo, first


def stretches(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, k: int, w: int, hot: np.ndarray | None = None):
    """Stretches of the texts values[starts[i]:ends[i]] (ascending, disjoint or
    overlapping by w-1 at most; at most SEGMENT symbols altogether).

    Returns (anchor hash, content hash, text index, first window's start in
    ``values``, number of windows).  The content hash covers all symbols of the
    stretch's windows.  Stretches whose anchor is in ``hot`` are cut up into
    single windows, each with its own hash as anchor."""
    n = len(values)
    empty = np.zeros(0, np.int64)
    if n < w or not (ends - starts >= w).any():
        return empty.astype(U), empty.astype(U), empty, empty, empty
    s = prefix_sums(values)
    at = np.arange(n - k + 1)
    grams = span_hash(s, at, at + k)
    key = (grams >> _POS_BITS << _POS_BITS) | at.astype(U)
    size, width = 1, w - k + 1
    while size * 2 <= width:
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    if width > size:
        key = np.minimum(key[: len(key) - (width - size)], key[width - size :])
    anchor = (key & U(SEGMENT - 1)).astype(np.int64)
    # windows inside one text
    delta = np.zeros(n + 1, np.int64)
    long = ends - starts >= w
    np.add.at(delta, starts[long], 1)
    np.add.at(delta, ends[long] - w + 1, -1)
    valid = np.flatnonzero(np.cumsum(delta[: len(anchor)]) > 0)
    text = np.searchsorted(starts[long], valid, "right") - 1
    text = np.flatnonzero(long)[text]
    a = anchor[valid]
    new = np.ones(len(valid), bool)
    new[1:] = (a[1:] != a[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(valid)))
    start = valid[first]
    h, which = grams[a[first]], text[first]
    if hot is not None and len(hot):
        split = np.isin(h, hot)
        if split.any():
            rep = np.where(split, count, 1)
            begin = np.repeat(start, rep) + np.where(
                np.repeat(split, rep), np.arange(rep.sum()) - np.repeat(np.cumsum(rep) - rep, rep), 0
            )
            one = np.repeat(split, rep)
            start, count = begin, np.where(one, 1, np.repeat(count, rep))
            h, which = np.repeat(h, rep), np.repeat(which, rep)
            content = span_hash(s, start, start + count - 1 + w)
            return np.where(one, content, h), content, which, start, count
    return h, span_hash(s, start, start + count - 1 + w), which, start, count

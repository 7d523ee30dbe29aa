"""Sets of word shingles as 64-bit hashes, and their parity sketches, in numpy."""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from wattfold.llm.common import mix64

# Bits of the dense sketch that is compared before sets are, at least. A larger set has ``MARGIN`` times as
# many as shingles may differ, rounded up to a power of two, so that unlike sets of any size differ in too many.
SKETCH_BITS, MARGIN = 512, 8
# Ways of dealing shingles to blocks that are tried for sets that leave too many blocks weak.
SEEDS = 4

_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _STEP)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_BASE = 0xD1342543DE82EF95


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64, at least ``n`` of each."""
    if len(_POWERS[0]) < n:
        size = 1 << max(20, (n - 1).bit_length())
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text: owners in order, hashes in order for each owner.

    Words are runs of anything but space and U+0009 to U+000D, with A-Z lower-cased. A text of fewer
    words than a shingle has has its whole sequence as one; one without words has none.
    """
    texts = pc.binary_join_element_wise("", pc.fill_null(texts, "").cast(pa.string()), "", " ")
    data = np.frombuffer(b"".join([x.as_buffer() for x in texts]), np.uint8) if len(texts) else np.zeros(0, np.uint8)
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    blank = _BLANK[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank]).astype(np.int8)))
    starts, stops = edge[::2], edge[1::2]
    power, inverse = _powers(len(data) + 1)[0], _POWERS[1]
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[_LOWER[data]] * power[: len(data)], dtype=np.uint64)])
    word = mix64((sums[stops] - sums[starts]) * inverse[starts] + (stops - starts).astype(np.uint64) * _STEP)
    owner = np.searchsorted(ends, starts, side="right")
    counts = np.bincount(owner, minlength=len(ends))
    first = np.cumsum(counts) - counts
    factors = mix64(np.arange(1, words + 1, dtype=np.uint64) * _STEP) | np.uint64(1)
    n = max(0, len(word) - words + 1)
    value = np.full(n, words, np.uint64)
    for k in range(words):
        value += word[k : k + n] * factors[k]
    whole = owner[:n] == owner[words - 1 : words - 1 + n]
    owners, hashes = [owner[:n][whole]], [mix64(value[whole])]
    for size in range(1, words):
        short = np.flatnonzero(counts == size)
        value = np.full(len(short), size, np.uint64)
        for k in range(size):
            value += word[first[short] + k] * factors[k]
        owners.append(short)
        hashes.append(mix64(value))
    owners, hashes = np.concatenate(owners), np.concatenate(hashes)
    order = np.lexsort((hashes, owners))
    owners, hashes = owners[order], hashes[order]
    new = np.ones(len(owners), bool)
    new[1:] = (owners[1:] != owners[:-1]) | (hashes[1:] != hashes[:-1])
    return owners[new], hashes[new]


def signatures(
    owners: np.ndarray, hashes: np.ndarray, n: int, percent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """For each of ``n`` sets: its size, two 64-bit signatures, and its sketch as bytes.

    A shingle flips the bit of the sketch that its hash names, so two sketches differ in at most as
    many bits as the sets have shingles that are not common.
    """
    sizes = np.bincount(owners, minlength=n)
    first, second = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    some = np.flatnonzero(sizes)
    heads = (np.cumsum(sizes) - sizes)[some]
    if len(some):
        first[some] = np.add.reduceat(mix64(hashes ^ _STEP), heads)
        second[some] = np.bitwise_xor.reduceat(mix64(hashes + _STEP), heads)
    widths = sketch_bits(sizes, percent)
    ends = np.cumsum(widths)
    bit = (hashes >> np.uint64(20)).astype(np.int64) & (widths[owners] - 1)
    flips = np.bincount((ends - widths)[owners] + bit, minlength=int(ends[-1]) if n else 0)
    offsets = np.concatenate([[0], ends // 8])
    data = np.packbits((flips & 1).astype(np.uint8), bitorder="little")
    sketch = pa.Array.from_buffers(
        pa.large_binary(), n, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data.tobytes())]
    )
    return sizes, first.view(np.int64), second.view(np.int64), sketch.cast(pa.binary())


def sketch_bits(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Bits of the sketch of sets of so many shingles, a power of two."""
    sizes = sizes.astype(np.int64)
    most = most_apart(sizes + sizes * 100 // percent, percent)
    return 1 << np.ceil(np.log2(np.maximum(MARGIN * most, SKETCH_BITS))).astype(np.int64)


def folded(sketches: pa.Array, size: int) -> np.ndarray:
    """Sketches as rows of ``size`` bytes: a wider one's pieces of that size are XORed.

    Widths are powers of two and a shingle's bit is its hash modulo the width, so a folded sketch is
    the one that the set would have at that width.
    """
    out = np.zeros((len(sketches), size // 8), np.uint64)
    sizes = pc.binary_length(sketches).to_numpy(zero_copy_only=False)
    for width in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == width)
        part = sketches.take(pa.array(rows))
        data = np.frombuffer(b"".join([x.as_buffer() for x in part]), np.uint64)
        out[rows] = np.bitwise_xor.reduce(data.reshape(len(rows), width // size, size // 8), axis=1)
    return out


def bits_apart(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Bits in which row ``i`` of ``a`` and row ``j`` of ``b`` differ, a few megabytes of pairs at a time."""
    step = max(1, (1 << 19) // max(1, a.shape[1]))
    parts = [
        np.bitwise_count(a[i[k : k + step]] ^ b[j[k : k + step]]).sum(axis=1, dtype=np.int64)
        for k in range(0, len(i), step)
    ]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def most_apart(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that are not common to two sets, at most, where similarity is ``percent`` or more.

    ``sizes`` is the sum of both sizes.
    """
    return (100 - percent) * sizes // (100 + percent)


@cache
def bands(percent: int, largest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Least size of each band, and for each pair of a band and the next one: D, K and the least count.

    A set and one that is similar to it are in the same band or in neighbouring ones. D bounds the
    shingles that are not common to two such sets. K blocks, of which at least K - D must be equal,
    are enough for the smallest set of the pair to leave fewer than K - D of them weak, that is, with
    fewer shingles than the least count.
    """
    bounds = [1, 2]
    while bounds[-2] <= largest or len(bounds) < 4:
        bounds.append(max(bounds[-1] + 1, (bounds[-1] - 1) * 100 // percent + 1))
    apart, blocks, least = [], [], []
    for low, next_low, end in zip(bounds, bounds[1:], bounds[2:], strict=False):
        small = next_low - 1
        large = max(small, min(end - 1, small * 100 // percent))
        d = (100 - percent) * (small + large) // (100 + percent)
        k, count = _blocks(low, d)
        apart.append(d)
        blocks.append(k)
        least.append(count)
    return np.array(bounds), np.array(apart), np.array(blocks), np.array(least)


def _blocks(size: int, d: int) -> tuple[int, int]:
    """K and the least count of a strong block: two shingles if blocks can have that many, else one."""
    for count in (2, 1):
        for k in range(d + 1, d + d // 2 + 8):
            mean = size / k
            weak = k * np.exp(-mean) * (1 + mean if count == 2 else 1)
            if k - d - 1 >= weak + 1.5 * np.sqrt(weak):
                return k, count
    return d + 2, 1


def block_keys(owners: np.ndarray, hashes: np.ndarray, n: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Owners and keys under which a set meets every set that is similar to it and not equal.

    Shingles are dealt to the K blocks of the set's band and the next, and of the band before and its
    own. In the wide sketch that has 2 ** 64 bits for each block, a shingle flips one bit; a block's
    key is a hash of its bits. At most D blocks of two similar sets differ, so K - D have equal keys.
    Weak blocks are left out, as they say little and empty ones would meet at random, unless K - D or
    more are weak: such a set is dealt anew, under other hashes, and so is any that might meet it in
    weak blocks only. The last time, weak blocks count.
    """
    sizes = np.bincount(owners, minlength=n)
    bounds, apart, blocks, least = bands(percent, 1 << int(max(4, sizes.max(initial=1))).bit_length())
    band = np.searchsorted(bounds, sizes, side="right") - 1
    found_owners, found_keys = [], []
    for role in (0, -1):
        pair = band + role
        active = (sizes > 0) & (pair >= 0)
        active[active] = apart[pair[active]] > 0
        for seed in range(SEEDS):
            if not active.any():
                break
            use = active[owners]
            owner, shingle = owners[use], hashes[use]
            k = np.where(active, blocks[np.maximum(pair, 0)], 0)
            offset = np.cumsum(k) - k
            dealt = mix64(shingle + np.uint64((seed + 1) * int(_STEP) & (1 << 64) - 1))
            place = offset[owner] + ((dealt >> np.uint64(32)) * k[owner].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
            total = int(k.sum())
            count = np.bincount(place, minlength=total)
            order = np.argsort(place, kind="stable")
            some = np.flatnonzero(count)
            bits = np.zeros(total, np.uint64)
            if len(some):
                bits[some] = np.bitwise_xor.reduceat(mix64(dealt)[order], (np.cumsum(count) - count)[some])
            of = np.repeat(np.arange(n), k)
            strong = count >= least[np.maximum(pair, 0)][of]
            weak = np.bincount(of[~strong], minlength=n)
            doubtful = active & (weak >= k - apart[np.maximum(pair, 0)])
            if seed == SEEDS - 1:
                strong |= doubtful[of]
            number = np.arange(total) - offset[of]
            name = ((np.maximum(pair, 0)[of] * SEEDS + seed) << 40 | number << 8 | np.minimum(count, 255)).astype(np.uint64)
            found_owners.append(of[strong])
            found_keys.append(mix64(mix64(name * _STEP) ^ bits)[strong])
            active = doubtful
    if not found_owners:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(found_owners), np.concatenate(found_keys)

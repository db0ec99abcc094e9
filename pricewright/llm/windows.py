"""Array kernels of suffix-array dedup: windows, their sampled suffixes and runs.

A document is an array of tokens (bytes or word hashes), each mapped to a 64-bit value. A *window*
is ``width`` consecutive tokens: a suffix, as far as it is ordered. Every window is represented by one
string in it: the one at its *anchor*, the leftmost of its ``digit``-token strings with the least hash.
The anchor depends on nothing but the window's own tokens, so equal windows have equal anchors at
equal offsets, and the first digit is looked at for anchors only: about ``2 / (width - digit)`` of all
places. Consecutive windows of one anchor are a *run*.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SEGMENT = 1 << 19
_LOW = U((1 << 20) - 1)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        seq = np.full(size, base, U)
        seq[0] = 1
        _powers[name] = have = np.multiply.accumulate(seq)
    return have[:n]


BYTE_VALUES = mix(np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """``out[i]``: sum over j < i of ``values[j] * base**j`` modulo 2**64."""
    out = np.empty(len(values) + 1, U)
    out[0] = 0
    np.cumsum(values * _power("up", _BASE, len(values)), out=out[1:])
    return out


def hashes(sums: np.ndarray, lo: int, hi: int, length: int) -> np.ndarray:
    """Hashes of the ``length``-token strings that start at lo .. hi - 1."""
    return mix((sums[lo + length : hi + length] - sums[lo:hi]) * _power("down", _INVERSE, hi)[lo:])


def sliding_min(x: np.ndarray, m: int) -> np.ndarray:
    """Minimum of every ``m`` consecutive values."""
    n = len(x)
    if m == 1:
        return x
    blocks = -(-n // m)
    padded = np.full(blocks * m, ~U(0), U)
    padded[:n] = x
    grid = padded.reshape(blocks, m)
    before = np.minimum.accumulate(grid, axis=1).ravel()
    after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - m + 1], before[m - 1 : n])


def runs(values: np.ndarray, width: int, digit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of windows with one anchor: first window, number of windows, anchor's hash, its offset in the first window."""
    n = len(values) - width + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, U), np.empty(0, np.int64))
    sums, span, anchors = prefix_sums(values), width - digit + 1, []
    for lo in range(0, n, _SEGMENT):
        hi = min(n, lo + _SEGMENT)
        keyed = hashes(sums, lo, hi + span - 1, digit)
        keyed = (keyed & ~_LOW) | np.arange(len(keyed), dtype=U)
        anchors.append((sliding_min(keyed, span) & _LOW).astype(np.int64) + lo)
    anchor = np.concatenate(anchors)
    first = np.concatenate(([0], np.flatnonzero(np.diff(anchor)) + 1))
    at = anchor[first]
    digits = mix((sums[at + digit] - sums[at]) * _power("down", _INVERSE, int(at[-1]) + 1)[at])
    return first, np.diff(np.append(first, n)), digits, at - first


def byte_digits(raw: np.ndarray, size: int) -> np.ndarray:
    """The digit of ``size`` (at most 8) bytes that begins at each place, most significant byte first."""
    out = np.zeros(max(0, len(raw) - size + 1), U)
    for k in range(size):
        out = out << U(8) | raw[k : len(raw) - size + 1 + k]
    return out


def equal_windows(digits: np.ndarray, at: np.ndarray, group: np.ndarray, places: list[int]) -> np.ndarray:
    """For each window the least-placed of those equal to it, by most-significant-digit passes.

    Window i has the digits that begin at ``at[i] + o`` for o in ``places``; ``group`` is what the digits
    before them left together. A pass orders the groups in which its digit differs; only groups of two
    or more go on to the next one, and those that are left after the last are the equal windows.
    """
    leader = np.arange(len(at))
    live = np.argsort(group, kind="stable")
    new = np.concatenate(([True], np.diff(group[live]) != 0)) if len(live) else np.zeros(0, bool)
    for o in [None, *places]:
        if o is not None:
            number = np.cumsum(new) - 1
            head = np.flatnonzero(new)[number]
            value = digits[at[live] + o]
            differs = value != value[head]
            if not differs.any():
                continue
            among = np.zeros(int(number[-1]) + 1, bool)
            among[number[differs]] = True
            spot = np.flatnonzero(among[number])
            order = spot[np.lexsort((live[spot], value[spot], number[spot]))]
            live[spot], value[spot] = live[order], value[order]
            new[1:] |= among[number[1:]] & (value[1:] != value[:-1])
        number = np.cumsum(new) - 1
        many = (np.bincount(number, minlength=1) > 1)[number] if len(live) else np.zeros(0, bool)
        live, new = live[many], new[many]
        if not len(live):
            return leader
    leader[live] = live[np.flatnonzero(new)[np.cumsum(new) - 1]]
    return leader


def merge(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open intervals as sorted disjoint ones; touching intervals join."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], starts[1:] > reach[:-1]))
    at = np.flatnonzero(new)
    return starts[at], reach[np.append(at[1:], len(starts)) - 1]

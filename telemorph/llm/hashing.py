"""Token hashes of many texts at once, for code that runs inside tasks.

A text's tokens are the maximal runs of bytes other than space and tab to
carriage return, after lower-casing A to Z. Every token gets a 64-bit hash: a
polynomial over its bytes modulo 2**64, taken from prefix sums over the whole
buffer, then mixed. Hashes depend on the token alone.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bytes hashed in one go; longer texts are cut at white space.
PIECE = 1 << 18
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word (a bijection)."""
    x = np.asarray(x, U)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of an ordered pair of hashes."""
    with np.errstate(over="ignore"):
        return mix(np.asarray(a, U) * U(0xD6E8FEB86659FD93) + np.asarray(b, U) + U(0x632BE59BD9B4E019))


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    known = _powers.get(name)
    if known is None or len(known) < n:
        size = max(n, PIECE + 4096)
        known = np.ones(size, U)
        with np.errstate(over="ignore"):
            known[1:] = base
            np.multiply.accumulate(known, out=known)
        if size <= 4 * PIECE:
            _powers[name] = known
    return known


def _hash_buffer(buffer: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a buffer's tokens and where they start."""
    data = np.frombuffer(buffer, np.uint8)
    solid = np.empty(len(data) + 2, np.int8)
    solid[0] = solid[-1] = 0
    solid[1:-1] = ~BLANK[data]
    edge = np.diff(solid)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, U)
        np.cumsum((data.astype(U) + U(1)) * _power("up", BASE, len(data))[: len(data)], out=sums[1:])
        value = (sums[ends] - sums[starts]) * _power("down", INVERSE, len(data) + 1)[starts]
        return mix(value + (ends - starts).astype(U) * U(0xA0761D6478BD642F)), starts


def _pieces(raw: bytes) -> Iterator[bytes]:
    """Cut a long text at white space."""
    at = 0
    while len(raw) - at > PIECE:
        cut = at + PIECE
        while cut < len(raw) and not BLANK[raw[cut]]:
            cut += 1
        yield raw[at:cut]
        at = cut
    yield raw[at:]


def token_hashes(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of all texts, and the offsets of each text's own
    (one more than there are texts). A null text has no tokens."""
    hashes: list[np.ndarray] = []
    counts: list[int] = []
    held: list[bytes] = []
    size = 0

    def flush() -> None:
        nonlocal held, size
        if held:
            bounds = np.cumsum([0, *(len(x) + 1 for x in held)])
            found, starts = _hash_buffer(b"\n".join(held))
            hashes.append(found)
            counts.extend(np.diff(np.searchsorted(starts, bounds)).tolist())
            held, size = [], 0

    for text in texts:
        raw = (text or "").encode("utf-8", "surrogatepass").lower()
        if size + len(raw) > PIECE:
            flush()
        if len(raw) > PIECE:
            parts = [_hash_buffer(piece)[0] for piece in _pieces(raw)]
            hashes.extend(parts)
            counts.append(sum(map(len, parts)))
        else:
            held.append(raw)
            size += len(raw) + 1
    flush()
    return (np.concatenate(hashes) if hashes else np.zeros(0, U)), np.cumsum([0, *counts])

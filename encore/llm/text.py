"""Vectorised word and shingle hashing of UTF-8 texts, used inside tasks.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D.  Its hash joins
two polynomials modulo primes of 31 bits and its length; words of more than
LONG bytes take a BLAKE2b digest instead.  (A polynomial modulo 2**64 will not
do: the Thue-Morse sequence and its complement collide under any multiplier.)
Hashes depend on the bytes alone, so equal texts hash alike in every task.  Texts are worked through in pieces of about ``PIECE`` bytes cut at
white space, so a batch of small texts and one very long text need the same
memory (beyond 8 bytes per word).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

#: Bytes hashed at once.
PIECE = 1 << 18

_WHITE_BYTES = bytes([0x20, *range(0x09, 0x0E)])
#: Byte table for bytes.translate: 1 for white space, else 0.
_IS_WHITE = bytes(b in _WHITE_BYTES for b in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of the splitmix64 generator: a bijection of 64-bit words."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64 (kept for the next piece)."""
    got = _powers.get(base)
    if got is None or len(got) < n:
        got = np.full(max(n, PIECE + (1 << 16)), base, dtype=np.uint64)
        got[0] = 1
        np.multiply.accumulate(got, out=got)
        if n <= 4 * PIECE:
            _powers[base] = got
    return got[:n]


_PRIMES = (2147483647, 2147483629)
_BASES = (1103515245, 1664525069)
#: Bytes from which on a word is hashed by itself.
LONG = 4096
_tables: list[tuple[np.ndarray, np.ndarray]] = []


def _powers_modulo(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(1, dtype=np.uint64)
    step = base % prime
    while len(out) < n:
        out = np.concatenate((out, out * np.uint64(step) % np.uint64(prime)))
        step = step * step % prime
    return out[:n]


def _prime_tables(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per prime the powers of its base and of the inverse (kept for the next
    piece)."""
    if _tables and len(_tables[0][0]) >= n:
        return _tables
    size = max(n, PIECE + (1 << 16))
    made = [(_powers_modulo(b, p, size), _powers_modulo(pow(b, -1, p), p, size)) for b, p in zip(_BASES, _PRIMES, strict=True)]
    if size <= 4 * PIECE:
        _tables[:] = made
    return made


def _hash_piece(data: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(first byte of each word, hash of each word) of one piece."""
    white = np.frombuffer(data.translate(_IS_WHITE), dtype=bool)
    if lower:
        data = data.lower()  # bytes.lower: A-Z only
    raw = np.frombuffer(data, dtype=np.uint8)
    edge = np.flatnonzero(white[1:] != white[:-1]) + 1
    if not white[0]:
        edge = np.concatenate(([0], edge))
    if not white[-1]:
        edge = np.concatenate((edge, [len(raw)]))
    start, end = edge[0::2], edge[1::2]
    value = np.zeros(len(start), dtype=np.uint64)
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    for (up, down), prime in zip(_prime_tables(len(raw)), _PRIMES, strict=True):
        np.multiply(raw, up[:len(raw)], out=total[1:])
        np.cumsum(total, out=total)  # a word of LONG bytes stays below 2**52; differences survive overflow
        own = (total[end] - total[start]) % np.uint64(prime) * down[start] % np.uint64(prime)
        value = (value << np.uint64(32)) | own
    value = mix(value ^ mix((end - start).astype(np.uint64)))
    for i in np.flatnonzero(end - start > LONG):
        value[i] = int.from_bytes(hashlib.blake2b(data[start[i]:end[i]], digest_size=8).digest(), "little")
    return start, value


def cut_at_white(text: bytes) -> Iterator[bytes]:
    """Pieces of about PIECE bytes that end at white space (or the end)."""
    at = 0
    while len(text) - at > 2 * PIECE:
        to = at + PIECE
        while to < len(text) and text[to] not in _WHITE_BYTES:
            to += 1
        yield text[at:to]
        at = to
    yield text[at:]


def word_hashes(texts: list[bytes], lower: bool = True) -> list[np.ndarray]:
    """The word hashes of every text, in order of the words."""
    out: list[np.ndarray] = [np.empty(0, np.uint64)] * len(texts)
    group: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal group, size
        if not group:
            return
        data = b" ".join(texts[i] for i in group)
        if data:
            begin = np.cumsum([0] + [len(texts[i]) + 1 for i in group])
            start, value = _hash_piece(data, lower)
            cuts = np.searchsorted(start, begin)
            for k, i in enumerate(group):
                out[i] = value[cuts[k]:cuts[k + 1]]
        group, size = [], 0

    for i, text in enumerate(texts):
        if len(text) > PIECE:
            out[i] = np.concatenate([_hash_piece(p, lower)[1] for p in cut_at_white(text) if p])
            continue
        if size + len(text) > PIECE:
            flush()
        group.append(i)
        size += len(text) + 1
    flush()
    return out


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k-word shingle, in order; a shorter sequence is one
    shingle of its own; no words, no shingles."""
    if len(words) == 0:
        return words
    m = min(k, len(words))
    total = np.full(len(words) - m + 1, m, dtype=np.uint64)
    for j in range(m):
        total *= np.uint64(0xD6E8FEB86659FD93)
        total += words[j:len(words) - m + 1 + j]
        total ^= total >> np.uint64(32)
    return mix(total)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles."""
    total = np.sort(shingle_hashes(words, k))
    return total[np.concatenate(([True], total[1:] != total[:-1]))] if len(total) else total


def utf8(value) -> bytes:
    """A text cell as bytes; null is empty."""
    return value.encode("utf-8", "surrogatepass") if isinstance(value, str) else (value or b"")

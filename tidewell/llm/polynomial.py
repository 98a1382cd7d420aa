"""Polynomial fingerprints of byte strings that compose: the hash of a whole follows from hashes and lengths of its parts.

The empty string has fingerprint (0, 0, 0); strings of any length are hashed in chunks of CHUNK bytes, side by side.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# Two primes below 2^31 and a base for each.
MODULI = (2147483647, 2147483629)
BASES = (1103515245, 1812433253)
CHUNK = 512  # bytes; a chunk's products with powers below 2^31 sum to less than 2^53, exactly held by a double

State = tuple[int, int, int]  # both residues and the length
EMPTY: State = (0, 0, 0)


@lru_cache(maxsize=4096)
def _shift(n: int, moduli: tuple[int, int]) -> tuple[int, int]:
    return tuple(pow(b, n, m) for b, m in zip(BASES, moduli, strict=True))


def combine(a: State, b: State, moduli: tuple[int, int] = MODULI) -> State:
    """The state of the concatenation: the left hash is shifted by the right part's length."""
    s = _shift(b[2], moduli)
    return (a[0] * s[0] + b[0]) % moduli[0], (a[1] * s[1] + b[1]) % moduli[1], a[2] + b[2]


@lru_cache(maxsize=8)
def _powers(moduli: tuple[int, int]) -> np.ndarray:
    return np.array([[pow(b, CHUNK - 1 - i, m) for b, m in zip(BASES, moduli, strict=True)] for i in range(CHUNK)], np.float64)


def fingerprints(texts: list[bytes], moduli: tuple[int, int] = MODULI, block: int = 4096) -> list[State]:
    """States of all texts. Chunks of all texts are hashed side by side; each text's chunks then combine in order.

    A text's first chunk is padded on its left: leading zero bytes add nothing, and the length is part of the state.
    """
    heads = [-len(t) % CHUNK for t in texts]
    counts = [(len(t) + h) // CHUNK for t, h in zip(texts, heads, strict=True)]
    raw = np.frombuffer(b"".join(x for t, h in zip(texts, heads, strict=True) for x in (bytes(h), t)), np.uint8).reshape(-1, CHUNK)
    hashed = np.concatenate(
        [
            np.zeros((0, 2), np.int64),
            *(
                (
                    raw[i : i + block].astype(np.float64) @ _powers(moduli)
                ).astype(np.int64) % np.array(moduli) for i in range(0, len(raw), block)
            ),
        ]
    ).tolist()
    (p, q), (s, t), out, at = moduli, _shift(CHUNK, moduli), [], 0
    for text, n in zip(texts, counts, strict=True):
        x = y = 0
        for a, b in hashed[at : at + n]:
            x, y = (x * s + a) % p, (y * t + b) % q
        out.append((x, y, len(text)))
        at += n
    return out

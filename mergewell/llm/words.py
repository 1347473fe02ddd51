"""Words of a text and hashes of word windows, the same on every machine.

A word is a run of characters other than blank, tab, newline, vertical tab, form feed and
carriage return: exactly what bytes.split() without arguments separates.
"""

from __future__ import annotations

import numpy as np
import xxhash

KNOWN_WORDS = 200_000  # words whose hash a task remembers before it starts afresh
MULTIPLIER = 0x9E3779B97F4A7C15 | 3  # odd, and 3 modulo 4
_MASK = (1 << 64) - 1
_INVERSE = pow(MULTIPLIER, -1, 1 << 64)


def words_of(text: str | None) -> list[bytes]:
    """UTF-8 words; none for a missing text."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


class WordHashes(dict):
    """64-bit hash (8 bytes) of each word asked for; forgets all when it is full."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        digest = self[word] = xxhash.xxh3_64_digest(word)
        return digest

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, words)), dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class Windows:
    """Hashes of all windows of k consecutive words of one text, for any k.

    Prefix sums of hash * MULTIPLIER**place make each window's hash a difference that is
    shifted back to place 0, so the cost does not depend on k.
    """

    _up = np.ones(1, np.uint64)
    _down = np.ones(1, np.uint64)

    def __init__(self, hashes: np.ndarray):
        n = len(hashes) + 1
        if len(Windows._up) < n:
            Windows._up, Windows._down = _powers(MULTIPLIER, 2 * n), _powers(_INVERSE, 2 * n)
        self.size = len(hashes)
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(hashes * Windows._up[:n - 1], out=self.sums[1:])

    def of(self, k: int) -> np.ndarray:
        """One hash per window start; none if the text has fewer than k words."""
        count = self.size - k + 1
        if count <= 0:
            return np.zeros(0, np.uint64)
        return mixed((self.sums[k:] - self.sums[:-k]) * Windows._down[:count])

    def spans(self, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Hashes of word spans, each with its own length."""
        return mixed((self.sums[starts + lengths] - self.sums[starts]) * Windows._down[starts]
                     + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:  # doubling: powers of the second half are those of the first times base**done
        more = min(done, n - done)
        out[done:done + more] = out[:more] * np.uint64(pow(base, done, 1 << 64))
        done += more
    return out

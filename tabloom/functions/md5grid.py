"""md5 of many texts at once: every row's prefix followed by every replicate's number.

The rows of a resampling differ from replicate to replicate only by a number in the text that is
hashed (see `hashing.digest`), so whole arrays go through the 64 steps together. The words equal
those of Spark's own md5.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

CELLS = 1 << 14  # digests worked on together, so that the arrays stay in the processor's cache
COLUMNS = 1 << 11
SINES = np.floor(np.abs(np.sin(np.arange(1, 65))) * 2.0**32).astype(np.uint64).astype(np.uint32)
TURNS = [[(np.uint32(s), np.uint32(32 - s)) for s in row] for row in ([7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21])]
START = np.array([0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476], np.uint32)


def _by_length(texts: Sequence[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, bytes) of texts of equal length."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    for n in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == n)
        yield n, at, np.frombuffer(b"".join(texts[i] for i in at.tolist()), np.uint8).reshape(len(at), n)


def _words(parts: np.ndarray, at: int, size: int) -> np.ndarray:
    whole = np.zeros((len(parts), size), np.uint8)
    whole[:, at : at + parts.shape[1]] = parts
    return whole.view("<u4").astype(np.uint32)


def _steps(state: list[np.ndarray], words: list, spare: list[np.ndarray]) -> list[np.ndarray]:
    """One block of 16 words, in place in `state`."""
    a, b, c, d = state
    t, u = spare
    for i in range(64):
        turn, k = divmod(i, 16)
        if turn == 0:
            g = k
            np.bitwise_xor(c, d, out=t)
            np.bitwise_and(t, b, out=t)
            np.bitwise_xor(t, d, out=t)
        elif turn == 1:
            g = (5 * k + 1) % 16
            np.bitwise_xor(b, c, out=t)
            np.bitwise_and(t, d, out=t)
            np.bitwise_xor(t, c, out=t)
        elif turn == 2:
            g = (3 * k + 5) % 16
            np.bitwise_xor(b, c, out=t)
            np.bitwise_xor(t, d, out=t)
        else:
            g = (7 * k) % 16
            np.invert(d, out=t)
            np.bitwise_or(t, b, out=t)
            np.bitwise_xor(t, c, out=t)
        np.add(t, a, out=t)
        np.add(t, words[g] + SINES[i], out=t)
        left, right = TURNS[turn][k % 4]
        np.left_shift(t, left, out=u)
        np.right_shift(t, right, out=t)
        np.bitwise_or(t, u, out=t)
        np.add(t, b, out=a)
        a, b, c, d = d, a, b, c
    return [a, b, c, d]


def digests(prefixes: Sequence[bytes], numbers: np.ndarray, suffix: bytes = b"") -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """(rows, columns, four words): md5 of prefix + decimal number + suffix, a part of the grid at a time.

    A word is an array of rows by columns; its order as a number is the order of its eight hex digits.
    Each cell comes once.
    """
    middles = list(_by_length([b"%d" % k for k in numbers.tolist()]))
    with np.errstate(over="ignore"):
        for n, rows, heads in _by_length(prefixes):
            for m, columns, texts in middles:
                length = n + m + len(suffix)
                size = (length + 9 + 63) // 64 * 64
                tail = suffix + b"\x80" + bytes(size - length - 9) + (8 * length).to_bytes(8, "little")
                fixed = _words(np.frombuffer(tail, np.uint8)[None, :], n + m, size)[0]
                step = max(1, CELLS // min(COLUMNS, len(columns)))  # few numbers go with many rows
                for j in range(0, len(columns), COLUMNS):
                    middle = _words(texts[j : j + COLUMNS], n, size)
                    for i in range(0, len(rows), step):
                        yield rows[i : i + step], columns[j : j + COLUMNS], _hashed(_words(heads[i : i + step], 0, size), middle, fixed, n, m)


def _hashed(head: np.ndarray, middle: np.ndarray, fixed: np.ndarray, n: int, m: int) -> list[np.ndarray]:
    shape = (len(head), len(middle))
    state = [np.full(shape, x) for x in START]
    spare = [np.empty(shape, np.uint32) for _ in range(2)]
    for block in range(0, len(fixed), 16):
        words = []
        for w in range(block, block + 16):
            in_head, in_middle = 4 * w < n, 4 * w < n + m and 4 * w + 4 > n
            word = fixed[w] | head[:, w][:, None] if in_head else fixed[w]
            words.append(word | middle[:, w][None, :] if in_middle else word)
        before = [x.copy() for x in state] if len(fixed) > 16 else START
        state = _steps(state, words, spare)
        for x, y in zip(state, before, strict=True):
            x += y
    return [x.byteswap() for x in state]

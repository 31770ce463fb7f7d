"""Words of a batch of texts as numpy arrays over its UTF-8 bytes.

Words are runs of bytes other than space and 0x09-0x0D, with A-Z lower-cased; each becomes a
64-bit hash. A batch is handled in windows, so memory follows the window, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WINDOW = 1 << 18  # bytes handled at a time; a longer word makes its window longer
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
BASE = 0x9E3779B97F4A7C15  # an odd number, so that its powers can be inverted
U64 = np.uint64


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of the input over the output (a bijection of 64-bit numbers)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without nulls; text i is bytes[offsets[i]:offsets[i+1]]."""
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    _, ends, data = texts.buffers()
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Words of a batch: start and end byte, number of the text, and hash of each."""

    def __init__(self, texts: pa.Array):
        self.bytes, self.offsets = text_buffer(texts)
        self.texts = len(texts)
        starts, ends, hashes = [], [], []
        for a, b in self._windows():
            s, e, h = self._window(a, b)
            starts.append(s)
            ends.append(e)
            hashes.append(h)
        self.starts = np.concatenate([np.zeros(0, np.int64), *starts])
        self.ends = np.concatenate([np.zeros(0, np.int64), *ends])
        self.hashes = np.concatenate([np.zeros(0, np.uint64), *hashes])
        self.text = np.searchsorted(self.offsets, self.starts, "right") - 1
        self.counts = np.bincount(self.text, minlength=self.texts)

    def _windows(self) -> Iterator[tuple[int, int]]:
        """Cut where a text ends or at white space, so that no word is cut."""
        a, n = 0, len(self.bytes)
        while a < n:
            b = a + WINDOW
            if b >= n:
                yield a, n
                return
            text_end = int(self.offsets[np.searchsorted(self.offsets, b)])
            step = 4096
            while b < text_end:
                gap = np.flatnonzero(IS_SPACE[self.bytes[b : min(b + step, text_end)]])
                if len(gap):
                    b += int(gap[0])
                    break
                b = min(b + step, text_end)
            yield a, b
            a = b

    def _window(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        low = LOWER[self.bytes[a:b]]
        space = IS_SPACE[low]
        edge = np.zeros(b - a + 1, bool)  # a text starts here
        inside = self.offsets[np.searchsorted(self.offsets, a) : np.searchsorted(self.offsets, b, "right")]
        edge[inside - a] = True
        edge[0] = edge[-1] = True
        before = np.concatenate([[True], space[:-1]]) | edge[:-1]
        after = np.concatenate([space[1:], [True]]) | edge[1:]
        starts, ends = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
        power = POWERS if b - a < len(POWERS) else _powers(BASE, b - a + 1)
        inverse = INVERSES if b - a < len(INVERSES) else _powers(pow(BASE, -1, 1 << 64), b - a + 1)
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum((low.astype(np.uint64) + U64(1)) * power[: b - a], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
        return starts + a, ends + a, hashes


POWERS, INVERSES = _powers(BASE, WINDOW + 8193), _powers(pow(BASE, -1, 1 << 64), WINDOW + 8193)


def shingle_sets(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, shingle) of the distinct runs of `width` words, sorted by both.

    A text with fewer words has all of them as its one shingle; one without words has none.
    """
    n = len(words.hashes)
    first = np.concatenate([[0], np.cumsum(words.counts)])[:-1]
    texts, hashes = [], []
    for size in range(1, width + 1):
        if size == width:
            at = np.flatnonzero(words.text[: n - width + 1] == words.text[width - 1 :]) if n >= width else np.zeros(0, int)
        else:
            at = first[words.counts == size]
        value = np.full(len(at), size, np.uint64)
        for j in range(size):
            value = mix(value * U64(3) + words.hashes[at + j])
        texts.append(words.text[at])
        hashes.append(value)
    text, shingle = np.concatenate(texts), np.concatenate(hashes)
    order = np.lexsort((shingle, text))
    text, shingle = text[order], shingle[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (shingle[1:] != shingle[:-1])
    return text[new], shingle[new]


def slices(batch: pa.RecordBatch, column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the column's values take about `most` bytes in each part."""
    values = batch.column(batch.schema.get_field_index(column))
    sizes = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
    parts = np.cumsum(sizes) // most
    edges = [0, *(np.flatnonzero(np.diff(parts)) + 1), len(batch)] if len(batch) else []
    for a, b in zip(edges, edges[1:], strict=False):
        yield batch.slice(int(a), int(b - a))

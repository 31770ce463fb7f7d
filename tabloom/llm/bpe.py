"""BPE encoding and decoding by speculation and verification.

Greedy longest match proposes the tokens of a word. The proposal is the word's encoding exactly if
each token is its own encoding and no merge crosses the border of two neighbours; numpy tests all
borders of a batch at once. Only words that fail are merged exactly, one merge of each word at a
time over whole arrays. Texts are cut at white space, which no token spans; a Python worker
remembers the ids of pieces, and of the lower-cased words that different pieces share.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType
from tokenizers import Tokenizer

from ..session import ship_package
from .textbytes import BASE, U64, _powers, mix, slices

END = "</w>"
# white space that str.split() doesn't agree on: it also cuts at these four
ODD = regex.compile("[\x1c-\x1f]")
SPACE = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
LATIN = "\u012f"  # up to here letters and their lower case are the same in all Unicode versions


def _latin_words() -> re.Pattern:
    """The words that the tokenizer file's pattern finds, for text up to LATIN: its classes written out."""
    every = [chr(i) for i in range(ord(LATIN) + 1)]
    letters, numbers = (re.escape("".join(c for c in every if unicodedata.category(c)[0] == k)) for k in "LN")
    space = re.escape("".join(c for c in every if SPACE.match(c)))
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{letters}{numbers}{space}]+")


LATIN_WORDS = _latin_words()
PIECE = 1 << 17  # characters of a text that are cut at a time, and pieces that are held
MOST_CACHED = 200_000  # pieces, and as many words, that a worker keeps
LONG = 64  # characters; longer words are merged with a queue
BATCH = 1 << 16  # words that are encoded beside one another
NONE = np.iinfo(np.int64).max


class Memory:
    """What was met lately, in two generations: when the younger is full, it takes the place of the older."""

    def __init__(self, most: int, always: dict[str, bytes]):
        self.half, self.always = most // 2, always
        self.young: dict[str, bytes] = dict(always)
        self.old: dict[str, bytes] = {}

    def unknown(self, wanted: set[str]) -> set[str]:
        """Of the wanted keys those to be worked out; the others are in `young` afterwards."""
        if len(self.young) > self.half:
            self.young, self.old = dict(self.always), self.young
        rest = wanted - self.young.keys()
        again = rest & self.old.keys()
        self.young.update((k, self.old[k]) for k in again)
        return rest - again


class Table:
    """Open-addressed table from numbers >= 0 to numbers."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(4 * max(len(keys), 1)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1), np.full(1 << bits, NONE)
        go, at = np.arange(len(keys)), self._home(keys)
        while len(go):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[go[free]]  # of several the last one stays
            held = self.keys[at] == keys[go]
            self.values[at[held]] = values[go[held]]
            go, at = go[~held], (at[~held] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """What the keys stand for; NONE for those that aren't there."""
        at = self._home(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.values[at], NONE)
        go = np.flatnonzero((held != keys) & (held >= 0))
        at = at[go]
        while len(go):
            at = (at + 1) & self.mask
            held = self.keys[at]
            hit = held == keys[go]
            out[go[hit]] = self.values[at[hit]]
            rest = ~hit & (held >= 0)
            go, at = go[rest], at[rest]
        return out


def byte_chars() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    own = set(shown)
    return [chr(b) if b in own else chr(next(free)) for b in range(256)]


def token_list(file: dict) -> list[str]:
    """The token of each id of a tokenizer file."""
    ids = file["model"]["vocab"] | {t["content"]: t["id"] for t in file["added_tokens"]}
    tokens = [""] * (max(ids.values()) + 1)
    for token, i in ids.items():
        tokens[i] = token
    return tokens


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


class Hashed:
    """Words beside one another, with the hash of any part of a word."""

    def __init__(self, words: list[str]):
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.codes = _codes("".join(words))
        n = len(self.codes) + 1
        self.sums = np.zeros(n, np.uint64)
        np.cumsum((self.codes + U64(1)) * _powers(BASE, n)[:-1], out=self.sums[1:])
        self.inverse = _powers(pow(BASE, -1, 1 << 64), n)

    def keys(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        hashed = mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))
        return (hashed >> U64(1)).astype(np.int64)

    def whole(self) -> np.ndarray:
        return self.keys(self.starts, self.ends)


class Vocabulary:
    """Tokens, merges and special tokens of a tokenizer file, indexed for the encoder."""

    def __init__(self, content: str):
        file = json.loads(content)
        model = file["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != END:
            raise ValueError("a BPE tokenizer with word ends is needed")
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.tokens = token_list(file)
        self.spellings = pa.array(self.tokens, pa.string())
        size = len(self.tokens)
        self._index_tokens()
        self.always = {t: np.array([i], np.int32).tobytes() for t, i in self.special.items()}
        chars = byte_chars()
        self.byte_ids, self.final_ids = (np.zeros(max(map(ord, chars)) + 1, np.int64) for _ in range(2))
        for c in chars:
            self.byte_ids[ord(c)], self.final_ids[ord(c)] = self.inner[c], self.final[c]
        self.latin = {c: "".join(chars[b] for b in chr(c).encode()) for c in range(ord(LATIN) + 1)}
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in self.special) + ")") if self.special else None
        self._index_merges([tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]], size)
        self.rules = Tokenizer.from_str(content)
        self.pieces, self.words = Memory(MOST_CACHED, self.always), Memory(MOST_CACHED, {})
        self.failed = 0

    def _index_tokens(self) -> None:
        """Tokens that end a word and others, and how long the others get after their first three characters."""
        self.final = {t[: -len(END)]: i for t, i in self.ids.items() if t.endswith(END)}
        self.inner = {t: i for t, i in self.ids.items() if not t.endswith(END)}
        reach: dict[str, int] = {}
        for t in self.inner:
            reach[t[:3]] = max(reach.get(t[:3], 0), len(t))
        plain = [t.removesuffix(END) if t in self.ids else "" for t in self.tokens]
        self.sizes = np.array([len(t) for t in plain])
        self.spelling, self.spelling_at = _codes("".join(plain)), np.cumsum(self.sizes) - self.sizes
        self.final_table, self.inner_table, self.reach_table = (
            Table(Hashed(list(t)).whole(), np.array(list(t.values()), np.int64)) for t in (self.final, self.inner, reach)
        )

    def _index_merges(self, merges: list[tuple[str, str]], size: int) -> None:
        self.size = size
        self.rank = np.full(size, -1, np.int64)  # of the merge that makes a token; -1: none, a single byte
        self.made = np.zeros(len(merges), np.int64)  # the token that the merge of a rank makes
        self.left, self.right = np.arange(size), np.arange(size)
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for r, (a, b) in enumerate(merges):
            i, j, made = self.ids[a], self.ids[b], self.ids[a + b]
            if self.rank[made] >= 0:
                raise ValueError(f"two merges make {a + b!r}")
            self.rank[made], self.left[made], self.right[made] = r, i, j
            self.merge[i, j] = (r, made)
            self.made[r] = made
        made = np.flatnonzero(self.rank >= 0)
        self.pairs = Table(self.left[made] * size + self.right[made], self.rank[made])
        whole = np.ones(size, bool)
        whole[made] = self.borders_hold(self.left[made], self.right[made], self.rank[made])
        for t in made[np.argsort(self.rank[made])]:
            whole[t] &= whole[self.left[t]] and whole[self.right[t]]
        self.whole = whole  # tokens that are the encoding of their own text

    def merge_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; NONE where there is none."""
        return self.pairs.find(a * self.size + b)

    def borders_hold(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """For each pair of neighbours: does no merge cross their border (before a given rank)?

        Time runs backwards: of the two tokens at the border, the one made last is opened. A merge
        of the two then crosses if it comes before the one that made it; among equal ranks the
        left one comes first.
        """
        a, b = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(a), NONE) if before is None else before.copy()
        good, at = np.ones(len(a), bool), np.arange(len(a))
        while len(at):
            crossed = self.merge_ranks(a, b) < limit
            good[at[crossed]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~crossed & ((ra >= 0) | (rb >= 0))
            at, a, b, ra, rb = at[go], a[go], b[go], ra[go], rb[go]
            open_left = ra > rb
            limit = np.where(open_left, ra, rb + 1)
            a, b = np.where(open_left, self.right[a], a), np.where(open_left, b, self.left[b])
        return good

    def propose(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Greedy longest match from the left: (number of the word, token) in order, and the words to distrust.

        Tokens are found by the hash of their characters, all words beside one another; then the
        characters are compared, and a word in which a token isn't what its hash says is distrusted.
        """
        text = Hashed(words)
        at, end, word = text.starts.copy(), text.ends, np.arange(len(words))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # word, token, where
        while len(word):
            last = self.final_table.find(text.keys(at, end))
            done = last != NONE
            found.append((word[done], last[done], at[done]))
            at, end, word = at[~done], end[~done], word[~done]
            size = self.reach_table.find(text.keys(at, np.minimum(at + 3, end)))
            size = np.minimum(end - at - 1, np.where(size == NONE, 2, size))
            if (size < 1).any():
                raise ValueError("no token for a character")
            go = np.arange(len(word))
            token = np.zeros(len(word), np.int64)
            while len(go):
                token[go] = self.inner_table.find(text.keys(at[go], at[go] + size[go]))
                go = go[token[go] == NONE]
                size[go] -= 1
            found.append((word, token, at))
            at = at + size
        word, token, at = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(word, kind="stable")
        word, token, at = word[order], token[order], at[order]
        return word, token, np.unique(word[~self._spells(token, text.codes, at)])

    def _spells(self, token: np.ndarray, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Do the tokens' characters stand at these places?"""
        size = self.sizes[token]
        step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        same = self.spelling[np.repeat(self.spelling_at[token], size) + step] == codes[np.repeat(at, size) + step]
        return np.logical_and.reduceat(same, np.cumsum(size) - size) if len(token) else np.zeros(0, bool)

    def merged(self, words: list[str]) -> list[list[int]]:
        """The encodings of words merge by merge: the lowest rank first, and the left one among equals.

        All words are merged beside one another; in a step each makes its next merge.
        """
        out: list = [None] * len(words)
        short = [k for k, w in enumerate(words) if len(w) <= LONG]
        for k, w in enumerate(words):
            if len(w) > LONG:
                out[k] = self._merged_long([*(self.inner[c] for c in w[:-1]), self.final[w[-1]]])
        number = np.array(short, np.int64)  # of each word that isn't finished
        size = np.fromiter((len(words[k]) for k in short), np.int64, len(short))
        token = self.byte_ids[_codes("".join(words[k] for k in short))]
        last = np.cumsum(size) - 1
        token[last] = self.final_ids[_codes("".join(words[k][-1] for k in short))]
        rank = np.full(len(token), NONE)
        rank[:-1] = self.merge_ranks(token[:-1], token[1:])
        rank[last] = NONE
        while len(number):
            start = np.cumsum(size) - size
            best = np.minimum.reduceat(rank, start)
            if (done := best == NONE).any():
                for k in np.flatnonzero(done).tolist():
                    out[number[k]] = token[start[k] : start[k] + size[k]].tolist()
                stay = np.repeat(~done, size)
                token, rank, number, size, best = token[stay], rank[stay], number[~done], size[~done], best[~done]
                if not len(number):
                    break
                start = np.cumsum(size) - size
            at = np.flatnonzero(rank == np.repeat(best, size))
            word = np.searchsorted(start, at, "right") - 1
            at = at[np.concatenate([[True], word[1:] != word[:-1]])]  # the left one in each word
            token[at] = self.made[best]
            stay = np.ones(len(token), bool)
            stay[at + 1] = False
            token, rank = token[stay], rank[stay]
            at -= np.arange(len(at))  # one token went from each word before
            size = size - 1
            start, end = np.cumsum(size) - size, np.cumsum(size) - 1
            rank[at] = NONE
            for left in (at[at < end], at[at > start] - 1):
                rank[left] = self.merge_ranks(token[left], token[left + 1])
        return out

    def _merged_long(self, tokens: list[int]) -> list[int]:
        """The same with a queue of merges, so that time grows little faster than the word."""
        n, merge = len(tokens), self.merge
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = [(*merge[p], i) for i, p in enumerate(zip(tokens, tokens[1:], strict=False)) if p in merge]
        queue = [(rank, i, made) for rank, made, i in queue]
        heapq.heapify(queue)
        while queue:
            _, i, made = heapq.heappop(queue)
            j = after[i]
            if tokens[i] < 0 or j < 0 or merge.get((tokens[i], tokens[j]), (0, -1))[1] != made:
                continue  # one of the two is gone
            tokens[i], tokens[j], after[i] = made, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (m := merge.get((tokens[x], tokens[y]))):
                    heapq.heappush(queue, (m[0], x, m[1]))
        return [t for t in tokens if t >= 0]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Encode words of byte characters: propose, test all borders at once, merge where one fails."""
        if len(words) > BATCH:
            return [ids for k in range(0, len(words), BATCH) for ids in self.encode_words(words[k : k + BATCH])]
        if not words:
            return []
        word, flat, distrusted = self.propose(words)
        bad = np.zeros(len(words), bool)
        bad[distrusted] = True
        bad[word[~self.whole[flat]]] = True
        inner = word[1:] == word[:-1]
        held = self.borders_hold(flat[:-1][inner], flat[1:][inner])
        bad[word[1:][inner][~held]] = True
        edges = np.searchsorted(word, np.arange(len(words) + 1)).tolist()
        tokens = flat.tolist()
        proposed = [tokens[a:b] for a, b in zip(edges, edges[1:], strict=False)]
        failing = np.flatnonzero(bad).tolist()
        for k, ids in zip(failing, self.merged([words[k] for k in failing]), strict=True):
            proposed[k] = ids
        self.failed += len(failing)
        return proposed

    def words_of(self, piece: str) -> list[str]:
        """The words of a piece, by the file's own normaliser and pre-tokenizer, in byte characters.

        They are asked beyond the Latin letters, because which characters are letters, and how they
        are lower-cased, differs between Unicode versions.
        """
        return [w for w, _ in self.rules.pre_tokenizer.pre_tokenize_str(self.rules.normalizer.normalize_str(piece))]

    def _encoded(self, words: list[str]) -> list[bytes]:
        encoded = self.encode_words(words)
        ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, encoded), np.int64, len(encoded)))]) * 4
        ids = np.fromiter(chain.from_iterable(encoded), np.int32).tobytes()
        return [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def learn_words(self, words: set[str]) -> None:
        """Encode lower-cased Latin words and remember their ids."""
        order = list(self.words.unknown(words))
        as_bytes = [w if w.isascii() and w.isprintable() else w.translate(self.latin) for w in order]
        self.words.young.update(zip(order, self._encoded(as_bytes), strict=True))

    def learn_pieces(self, pieces: set[str]) -> None:
        """Encode pieces of other text, without white space, and remember their ids."""
        table = {piece: self.words_of(piece) for piece in self.pieces.unknown(pieces)}
        order = list(set(chain.from_iterable(table.values())))
        known = dict(zip(order, self._encoded(order), strict=True))
        self.pieces.young.update((piece, b"".join(map(known.__getitem__, found))) for piece, found in table.items())

    def encode_texts(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of whole texts; the words and pieces that are new to this worker are encoded together."""
        out: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[int, bool, list[str]]] = []  # text, Latin words or else pieces, which
        size = 0

        def flush() -> None:
            self.learn_words(set(chain.from_iterable(found for _, latin, found in held if latin)))
            self.learn_pieces(set(chain.from_iterable(found for _, latin, found in held if not latin)))
            for k, latin, found in held:
                memory = self.words if latin else self.pieces
                out[k].append(b"".join(map(memory.young.__getitem__, found)))
            held.clear()

        for k, text in enumerate(texts):
            special = self.cut.split(text) if self.cut is not None else [text]
            for n, part in enumerate(special):
                if n % 2:
                    held.append((k, False, [part]))
                    continue
                for chunk in chunks_of(part):
                    # up to LATIN there are no combining marks, so the text is as the normaliser leaves it
                    latin = chunk.isascii() or max(chunk) <= LATIN
                    found = LATIN_WORDS.findall(chunk.lower()) if latin else pieces_of(chunk)
                    held.append((k, latin, found))
                    size += len(found)
                    if size > PIECE:
                        flush()
                        size = 0
        flush()
        return [np.frombuffer(b"".join(ids), np.int32) for ids in out]


def chunks_of(text: str) -> Iterator[str]:
    """The text in parts of about PIECE characters, cut at white space."""
    start = 0
    while start < len(text):
        stop = len(text)
        if stop - start > PIECE and (gap := SPACE.search(text, start + PIECE)):
            stop = gap.start()
        yield text[start:stop]
        start = max(stop, start + 1)


def pieces_of(text: str) -> list[str]:
    """What stands between white space."""
    return [p for p in SPACE.split(text) if p] if ODD.search(text) else text.split()


_LOADED: dict[int, Vocabulary] = {}


def _vocabulary(shared) -> Vocabulary:
    """This worker's vocabulary: built once, from the broadcast file."""
    if shared.id not in _LOADED:
        _LOADED.clear()
        _LOADED[shared.id] = Vocabulary(shared.value)
    return _LOADED[shared.id]


class _Shared:
    def __init__(self, spark, path: str):
        ship_package(spark)
        with open(path, encoding="utf-8") as f:
            content = f.read()
        self.id, self.broadcast = hash(content), spark.sparkContext.broadcast(content)

    @property
    def value(self) -> str:
        return self.broadcast.value


def encode(docs: DataFrame, vocabulary_path: str, decoded: bool = False) -> DataFrame:
    """All columns but `text`, and `ids`: the token ids of each whole text, as array<int>.

    With `decoded`, also the column decoded: what `decode` makes of the ids, by the same task.

    A missing or empty text, or one of white space only, has no ids. Each row is encoded on its
    own, so repeated rows and ties give equal ids; a column called ids is replaced. The file is
    read on the driver and broadcast: it is the vocabulary, so its size doesn't follow the data.
    Texts are taken about a million characters at a time.
    """
    docs = docs.drop("ids", *(["decoded"] if decoded else []))
    keep = [c for c in docs.columns if c != "text"]
    shared = _Shared(docs.sparkSession, vocabulary_path)
    schema = StructType([*[docs.schema[c] for c in keep]]).add("ids", ArrayType(IntegerType(), False))
    if decoded:
        schema = schema.add("decoded", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared)
        for whole in batches:
            for batch in slices(whole, "text", 2 << 20):
                texts = batch.column(batch.schema.get_field_index("text"))
                ids = vocabulary.encode_texts([t or "" for t in texts.to_pylist()])
                ends = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
                values = pa.array(np.concatenate([np.zeros(0, np.int32), *ids]), pa.int32())
                kind = pa.list_(pa.field("element", pa.int32(), nullable=False))
                made = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values).cast(kind)
                columns = [*[batch.column(c) for c in keep], made]
                if decoded:
                    columns.append(spelled(made, vocabulary.spellings))
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select(*keep, "text").mapInArrow(run, schema)


def spelled(ids: pa.ListArray, table: pa.Array) -> pa.Array:
    """The tokens of each list joined by one space; a missing list gives none."""
    ends = pa.array(ids.offsets.to_numpy() - ids.offsets[0].as_py())
    words = pa.ListArray.from_arrays(ends, table.take(ids.flatten()))
    return pc.if_else(ids.is_valid(), pc.binary_join(words, " "), None)


def decode(encoded: DataFrame, vocabulary_path: str) -> DataFrame:
    """All columns but `ids`, and `decoded`: the tokens joined by one space; missing ids give none.

    A look-up of each batch's ids in an array of the tokens.
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        tokens = token_list(json.load(f))
    shared = encoded.sparkSession.sparkContext.broadcast(tokens)
    keep = [c for c in encoded.columns if c not in ("ids", "decoded")]
    schema = StructType([*[encoded.schema[c] for c in keep]]).add("decoded", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(shared.value, pa.string())
        for whole in batches:
            for batch in _by_tokens(whole, len(keep)):
                made = spelled(batch.column(len(keep)), table)
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], made], schema.names)

    return encoded.select(*keep, "ids").mapInArrow(run, schema)


def _by_tokens(batch: pa.RecordBatch, column: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part has about `most` ids."""
    parts = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_numpy()) // most
    edges = [0, *(np.flatnonzero(np.diff(parts)) + 1), len(batch)] if len(batch) else []
    for a, b in zip(edges, edges[1:], strict=False):
        yield batch.slice(int(a), int(b - a))

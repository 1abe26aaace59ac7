"""Byte-pair encoding by speculation and verification, and decoding.

A merge-based encoding of a word is the only cut of the word into tokens in which
every token encodes to itself and every two neighbours, encoded together, stay
apart: the first merge to cross a cut in the whole word would cross it in the pair
as well.  So:

* propose: cut each distinct word greedily, always taking the longest token: all words
  walk down one trie of tokens together;
* verify: test all neighbouring pairs of all proposed words at once, by undoing
  merges along the cut (arrays of left and right halves, and a table of merges), and
  never running one;
* merge exactly: only the words that fail are encoded by applying merges, words of one
  length in step.

Words of any length are proposed and verified.  Those of more than ``STEPS`` tokens or
letters leave the common step and go on one by one, with equal results.

Words are encoded once per task and kept for the next batches (the store is emptied
at a fixed size, so memory is bounded); texts then become look-ups.  The vocabulary
is a file that every worker reads; its path is a parameter.

Edge cases: NULL and empty texts have no tokens and decode to an empty text; the
strings of special tokens become those tokens; repeated rows are encoded alike;
other columns pass through, and columns named like a result are replaced.  A text
is looked at whole, whatever its length.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

TOKENIZER = "word_bpe_49k.json"
#: Distinct words a worker keeps; some 100 MB.
KEPT_WORDS = 400_000
#: Characters of text whose new words are learned together.
CHUNK = 1_000_000
#: Rows whose tokens are Python objects at one time.
SLICE = 500
END = "</w>"
#: The end of a word among bytes; and no number.
LAST = 256
NONE = np.iinfo(np.int64).max
#: Tokens that words walk, and letters up to which they are merged, in step.
STEPS = 64
#: Words that are merged in step.
ROWS = 1 << 14


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: printable Latin-1
    characters stand for themselves, the others for code points from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in shown}
    hidden = (b for b in range(256) if b not in letters)
    letters |= {b: chr(256 + k) for k, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


def token_strings(spec: dict) -> list[str]:
    """The string of each token by its id."""
    known = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
    text = [""] * (1 + max(known.values()))
    for token, i in known.items():
        text[i] = token
    return text


class Lookup:
    """Numbers by keys, for many keys at once: open addressing in two arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.values = np.full(1 << bits, NONE, dtype=np.int64)
        left, at = np.arange(len(keys)), self._place(keys)
        while len(left):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[left[free]]  # of several, the last one stays
            mine = self.keys[at] == keys[left]
            self.values[at[mine]] = values[left[mine]]
            left, at = left[~mine], (at[~mine] + 1) & self.mask

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; ``NONE`` for a key that has none."""
        at = self._place(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], NONE)
        left = np.flatnonzero((found != keys) & (found >= 0))
        at = at[left]
        while len(left):
            at = (at + 1) & self.mask
            found = self.keys[at]
            hit = found == keys[left]
            out[left[hit]] = self.values[at[hit]]
            on = ~hit & (found >= 0)
            left, at = left[on], at[on]
        return out


class Splitter:
    """Normalised words of a text.

    Normal form and lower case follow this Python's Unicode tables, kinds of letters those
    of a module; the library has tables of its own, of other versions.  They agree on what
    this Python knows.  A text with any other code point is normalised and cut by the
    library itself.
    """

    def __init__(self, path: str):
        self.path = path
        self.pattern = regex.compile(r"\p{L}+|\p{N}|'s|'t|'re|'ve|'m|'ll|'d|[^\p{White_Space}\p{L}\p{N}]+")
        self.simple = re.compile(r"[a-z]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^\x09-\x0d\x20a-z0-9]+")
        #: Characters seen so far that are assigned.
        self.known: set[str] = set()
        #: Nothing below it is composed.
        self.composed = re.compile("[\u0300-\U0010ffff]")
        self._library: tuple | None = None

    def words(self, text: str) -> list[str]:
        if text.isascii():
            return self.simple.findall(text.lower())
        if fresh := set(text) - self.known:
            self.known |= {c for c in fresh if unicodedata.category(c) != "Cn"}
            if fresh - self.known:
                return self.by_library(text)
        if self.composed.search(text):
            text = unicodedata.normalize("NFC", text)
        # Letter by letter: a capital sigma is lowered alike wherever it stands.
        return self.pattern.findall(text.replace("Σ", "σ").lower())

    def by_library(self, text: str) -> list[str]:
        if self._library is None:
            from tokenizers import Tokenizer

            whole = Tokenizer.from_file(self.path)
            self._library = whole.normalizer, whole.pre_tokenizer[0]
        normalizer, cut = self._library
        return [word for word, _ in cut.pre_tokenize_str(normalizer.normalize_str(text))]


class Words(dict):
    """Numbers of words, in the order in which they are first seen."""

    def __missing__(self, word: str | int) -> int:
        number = self[word] = len(self)
        return number


class Codec:
    """The tables of one tokenizer file, and the words that were encoded so far."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text = token_strings(spec)
        self.size = len(self.text)
        letters = byte_letters()
        self.splitter = Splitter(path)
        self.cut = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        # Tokens of single bytes, within a word and at its end.
        self.inner = np.array([self.vocab[c] for c in letters])
        self.final = np.array([self.vocab[c + END] for c in letters])
        self._merges(model["merges"])
        self._trie({letter: byte for byte, letter in enumerate(letters)})
        self.forget()

    def _merges(self, merges: list) -> None:
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        vocab = self.vocab
        made = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        self.rank = {(a, b): k for k, (a, b, _) in reversed(list(enumerate(made)))}
        left, right, new = (np.array(x, dtype=np.int64) for x in zip(*made, strict=True))
        self.made = new
        ranks = np.arange(len(made))
        self.ranks = Lookup((left * self.size + right)[::-1], ranks[::-1])
        # Half tokens of each token and the rank that makes it; letters have none (-1).
        self.left = np.full(self.size, -1, dtype=np.int64)
        self.right = np.full(self.size, -1, dtype=np.int64)
        self.born = np.full(self.size, -1, dtype=np.int64)
        self.left[new[::-1]], self.right[new[::-1]] = left[::-1], right[::-1]
        self.born[new[::-1]] = ranks[::-1]
        # A token is used in proposals only if its own text encodes to it: both halves
        # do, and nothing crosses the cut between them before its own merge.
        apart = self.stay_apart(left, right, ranks)
        self.whole = np.ones(self.size, dtype=bool)
        for k in ranks:  # a half is made before the whole
            if self.born[new[k]] == k:
                self.whole[new[k]] = apart[k] and self.whole[left[k]] and self.whole[right[k]]

    def _trie(self, value: dict[str, int]) -> None:
        """Tokens as paths of bytes, with ``LAST`` for the end of a word."""
        steps: dict[int, int] = {}
        token_at = [NONE]
        for token, i in self.vocab.items():
            if not self.whole[i]:
                continue
            ends = token.endswith(END) and token != END
            path = [value[c] for c in (token[: -len(END)] if ends else token)] + [LAST] * ends
            node = 0
            for step in path:
                key = node * 257 + step
                node = steps.get(key, 0)
                if not node:
                    node = steps[key] = len(token_at)
                    token_at.append(NONE)
            token_at[node] = i
        self.steps = Lookup(np.array(list(steps), dtype=np.int64), np.array(list(steps.values()), dtype=np.int64))
        self.token_at = np.array(token_at, dtype=np.int64)

    def forget(self) -> None:
        """Empty the store; special tokens stand in the lists of words as their ids."""
        self.numbers = Words()
        self.tokens = np.array(list(self.special.values()), dtype=np.int32)
        self.ends = np.arange(len(self.tokens) + 1)
        for i in self.special.values():
            self.numbers[i]

    def stay_apart(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge crosses the cut between tokens ``a`` and ``b``, or, with
        ``before``, none of a lower rank than that.

        Goes back in time: the state at the cut is the last part of ``a`` and the
        first part of ``b``.  The part that was made later is split first.  A pair of
        parts that merges at a rank at which both still stand as they are would have
        been merged.  ``until`` is the rank from which on the pair no longer stood.
        """
        a, b = a.copy(), b.copy()
        until = np.full(len(a), NONE) if before is None else before.copy()
        # Merges of the same rank are done from the left, so one that makes part of the
        # left token comes before the crossing one; one on the right comes after it.
        good, live = np.ones(len(a), dtype=bool), np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            crosses = self.ranks.of(x * self.size + y) < until[live]
            good[live[crosses]] = False
            born_x, born_y = self.born[x], self.born[y]
            done = crosses | ((born_x < 0) & (born_y < 0))
            split_x = ~done & (born_x > born_y)
            split_y = ~done & ~split_x
            a[live[split_x]] = self.right[x[split_x]]
            until[live[split_x]] = born_x[split_x]
            b[live[split_y]] = self.left[y[split_y]]
            until[live[split_y]] = born_y[split_y] + 1
            live = live[~done]
        return good

    def propose(self, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Longest token first, for all words at once: tokens and how many each word has.

        ``symbols`` has the bytes of all words, each with ``LAST`` behind it.
        """
        # The longest token from every place; one that leaves nothing but LAST is none.
        token = np.full(len(symbols), NONE)
        reach = np.zeros(len(symbols), dtype=np.int64)
        inside = symbols != LAST
        live, node, depth = np.flatnonzero(inside), 0, 0
        while len(live):
            node = self.steps.of(node * 257 + symbols[live + depth])
            on = node != NONE
            live, node = live[on], node[on]
            depth += 1
            found = self.token_at[node]
            stop = live + depth
            fits = found != NONE
            fits[fits] = (symbols[stop[fits] - 1] == LAST) | (symbols[np.minimum(stop[fits], len(symbols) - 1)] != LAST)
            token[live[fits]], reach[live[fits]] = found[fits], depth
            on = symbols[stop - 1] != LAST
            live, node = live[on], node[on]
        # All words walk in step; those that are longer go on by themselves.
        mark = np.zeros(len(symbols), dtype=bool)
        at = starts
        for _ in range(STEPS):
            mark[at] = True
            at = at + reach[at]
            at = at[symbols[at - 1] != LAST]
            if not len(at):
                break
        for place in at.tolist():
            while not place or symbols[place - 1] != LAST:
                mark[place] = True
                place += int(reach[place])
        chosen = np.flatnonzero(mark)
        counts = np.diff(np.append(np.searchsorted(chosen, starts), len(chosen)))
        return token[chosen], counts

    def merge(self, letters: np.ndarray) -> np.ndarray:
        """The exact encoding of words of one length, one in a row, in step: in each the
        lowest merge, from the left.  The rest of a row is -1."""
        ids = letters.copy()
        out = np.full(ids.shape, -1, dtype=np.int64)
        rows = np.arange(len(ids))
        ranks = self.ranks.of((ids[:, :-1] * self.size + ids[:, 1:]).ravel()).reshape(len(ids), -1)
        while len(rows):
            if not ranks.shape[1]:
                out[rows, :1] = ids
                break
            at = ranks.argmin(axis=1)
            lowest = ranks[np.arange(len(rows)), at]
            done = lowest == NONE
            if done.any():
                out[rows[done], : ids.shape[1]] = ids[done]
                rows, ids, ranks, at, lowest = (x[~done] for x in (rows, ids, ranks, at, lowest))
            n = np.arange(len(rows))
            ids[n, at] = self.made[lowest]
            # What stands behind the right part moves up.
            column = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, column + (column > at[:, None]), axis=1)
            if len(column) > 1:
                column = column[:-1]
                ranks = np.take_along_axis(ranks, column + (column >= at[:, None]), axis=1)
                for side in (at - 1, at):
                    k = np.flatnonzero((side >= 0) & (side < len(column)))
                    there = ids[k, side[k]]
                    known = there >= 0
                    k, there = k[known], there[known]
                    ranks[k, side[k]] = self.ranks.of(there * self.size + ids[k, side[k] + 1])
            else:
                ranks = ranks[:, :0]
        return out

    def merge_long(self, letters: list[int]) -> list[int]:
        """The same for one word with a heap of pairs: n log n for any length."""
        ids, n = list(letters), len(letters)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            if (j := after[i]) < n and (found := self.rank.get((ids[i], ids[j]))) is not None:
                heapq.heappush(heap, (found, i, ids[i], ids[j]))

        for i in range(n):
            offer(i)
        while heap:
            rank, i, x, y = heapq.heappop(heap)
            j = after[i]
            if ids[i] != x or j >= n or ids[j] != y:  # one of them has merged since
                continue
            ids[i], ids[j], after[i] = int(self.made[rank]), -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [i for i in ids if i >= 0]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of words one after another, and how many each has."""
        # 0xFF is in no text of UTF-8.
        symbols = np.frombuffer(b"\xff".join([*(w.encode() for w in words), b""]), dtype=np.uint8).astype(np.int64)
        symbols[symbols == 0xFF] = LAST
        ends = np.flatnonzero(symbols == LAST)
        starts = np.append(0, ends[:-1] + 1)
        flat, counts = self.propose(symbols, starts)
        stop = np.cumsum(counts)
        inner = np.ones(len(flat), dtype=bool)
        inner[stop - 1] = False  # the last token of a word has no pair
        at = np.flatnonzero(inner)
        code, back = np.unique(flat[at] * self.size + flat[at + 1], return_inverse=True)
        apart = self.stay_apart(code // self.size, code % self.size)[back]
        owner = np.repeat(np.arange(len(words)), counts)
        failed = np.zeros(len(words), dtype=bool)
        failed[owner[at[~apart]]] = True
        again = np.flatnonzero(failed)
        if not len(again):
            return flat, counts
        # Only the words that failed are merged: words of one length in step.
        length = (ends - starts)[again]
        order = np.argsort(length, kind="stable")
        again, length = again[order], length[order]
        parts, owners, sizes = [flat[~failed[owner]]], [np.flatnonzero(~failed)], [counts[~failed]]
        first = np.flatnonzero(np.append(True, length[1:] != length[:-1]))
        for a, b in zip(first, np.append(first[1:], len(length)), strict=True):
            n = int(length[a])
            for some in np.split(again[a:b], range(ROWS, b - a, ROWS)):
                letters = self.inner[symbols[starts[some][:, None] + np.arange(n)]]
                letters[:, -1] = self.final[symbols[starts[some] + n - 1]]
                if n > STEPS:
                    merged = [self.merge_long(row) for row in letters.tolist()]
                    parts.append(np.array(list(chain.from_iterable(merged)), dtype=np.int64))
                    sizes.append(np.array(list(map(len, merged))))
                else:
                    table = self.merge(letters)
                    parts.append(table[table >= 0])
                    sizes.append((table >= 0).sum(axis=1))
                owners.append(some)
        flat, counts, owner = (np.concatenate(x) for x in (parts, sizes, owners))
        back = np.argsort(owner, kind="stable")
        return gathered(flat, np.append(0, np.cumsum(counts)), back), counts[back]

    def words(self, text: str) -> list[str | int]:
        """Words in order; special tokens as their ids."""
        if self.cut is None or not self.cut.search(text):
            return self.splitter.words(text)
        out, at = [], 0
        for found in self.cut.finditer(text):
            out += self.splitter.words(text[at : found.start()])
            out.append(self.special[found[0]])
            at = found.end()
        return out + self.splitter.words(text[at:])

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of texts one after another, and how many each has.  A chunk's new words
        are learned together."""
        parts, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        start, held = 0, 0
        for k, text in enumerate(texts):
            held += len(text or "")
            if held > CHUNK or k == len(texts) - 1:
                flat, counts = self._encode([t or "" for t in texts[start : k + 1]])
                parts.append(flat)
                sizes.append(counts)
                start, held = k + 1, 0
        return np.concatenate(parts), np.concatenate(sizes)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.numbers) > KEPT_WORDS:
            self.forget()
        known = len(self.numbers)
        number, n_words = [], []
        for text in texts:
            words = self.words(text)
            number.append(np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words)))
            n_words.append(len(words))
        if len(self.numbers) > known:
            fresh = list(islice(self.numbers, known, None))
            flat, counts = self.encode_words(fresh)
            self.tokens = np.concatenate([self.tokens, flat.astype(np.int32)])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])
        numbers = np.concatenate(number)
        size = np.diff(self.ends)[numbers]
        of_word = np.append(0, np.cumsum(size))
        stop = np.cumsum(n_words)
        counts = of_word[stop] - of_word[stop - n_words]
        return gathered(self.tokens, self.ends, numbers), counts


def gathered(flat: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The stretches ``ends[r]:ends[r + 1]`` of ``flat`` for each of ``rows``."""
    size = ends[rows + 1] - ends[rows]
    shift = np.repeat(ends[rows] - (np.cumsum(size) - size), size)
    return flat[np.arange(len(shift)) + shift]


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One per worker process and file."""
    return Codec(path)


@functools.lru_cache(maxsize=2)
def strings(path: str) -> pa.Array:
    """All that decoding needs; a worker that only decodes builds no merges."""
    with open(path, encoding="utf-8") as file:
        return pa.array(token_strings(json.load(file)))


def _mapped(df: DataFrame, name: str, kind: T.DataType, make) -> DataFrame:
    """``df`` with a column that ``make`` computes from each Arrow batch."""
    kept = [c for c in df.columns if c != name]
    schema = T.StructType([*[df.schema[c] for c in kept], T.StructField(name, kind)])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):  # Python objects of a few texts at a time
                part = batch.slice(at, SLICE)
                rows = part.select(kept)
                yield pa.RecordBatch.from_arrays([*rows.columns, make(part)], names=[*kept, name])

    return df.mapInArrow(over, schema)


def encode_documents(docs: DataFrame, path: str | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids``, the tokens of each whole text."""
    path = path or tokenizer_path()

    def make(batch: pa.RecordBatch) -> pa.Array:
        ids, counts = codec(path).encode_batch(batch.column(text_col).to_pylist())
        ends = np.append(0, np.cumsum(counts)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))

    return _mapped(docs, "ids", T.ArrayType(T.IntegerType(), False), make)


def decode_documents(rows: DataFrame, path: str | None = None, ids_col: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``: the strings of the tokens, joined by blanks, as a
    tokenizer without a decoder gives them back.  NULL ids decode to an empty text."""
    path = path or tokenizer_path()

    def make(batch: pa.RecordBatch) -> pa.Array:
        ids = batch.column(ids_col)
        # Lists lie end to end; those of NULL have no length.
        ends = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)))
        words = strings(path).take(ids.flatten())
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), words), " ")

    return _mapped(rows, "decoded", T.StringType(), make)

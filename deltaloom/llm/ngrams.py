"""LM scoring with an Elias-Fano n-gram trie over all training tokens, of any order from 2 (3 by default).

Tokens are words, A-Z lowered, and an end after each document. The model interpolates: with a context h that training has
seen c(h) times, P(w|h) = (1 - s) c(hw) / c(h) + s P(w|h'), where h' is h without its first word and s, the share of the
shorter context, is a c(h)^-b, a and b for each order; below is the base P(w) = (c(w) + 1) / (N + V + 1). As s only
depends on c(h), every context's probabilities sum to 1. Nothing is pruned: every training n-gram is in the trie.

Documents become blocks, one row each, of bounded text: a sorted vocabulary of word hashes and the tokens as places in
it. Word parts, ranges of the hash, count all blocks' words and number them. A block deals its distinct n-grams to parts by
their first word, so a part holds all that follows a context; only behind words of over ``hot`` occurrences the second word
deals too, and so on, up to the whole n-gram where its context is of such words only, whose totals are then counted apart
beforehand. What is dealt is folded: a node for each prefix, with frequent words under small numbers. A part merges the
blocks' counts into a trie and answers the blocks' own n-grams, held out ones too, from it.
A trie has Elias-Fano levels in one memory-mapped file in its task's own folder: the words of the first level, and for
each further one pointers from a node to its first child and the children, made monotone by what stands before their
node; probabilities, (1 - s) c(hw) / c(h), are 16-bit codes of log10. An n-gram is found word by word, in the range of
successors of the node before. Blocks then interpolate what came back; how often a context occurs follows from its own
probability and its first word's total.

Words and contexts are known by 64-bit hashes: two of a million share one with a chance of about 3e-8.

Defined results: a null or empty text is one end; a null doc_id is learned from; rows that repeat count each; an empty
table gives an empty one; other columns play no part.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deltaloom.llm.common import WORD_BYTES, by_parts, chunks, learned_from, lower_ascii, release, ship, starts_of, table, utf8, written

#: The hash that stands for the end of a document.
END = np.uint64(0)
#: Steps of the codes of log10 probabilities, from 0 down; code 0 is kept for "not in the trie".
STEP = 12 / 65534


def squeezed(values: np.ndarray) -> bytes:
    """Bytes of an integer array: its width, then its bytes by place, compressed."""
    wide = 8 if len(values) and int(values.max()) >= 1 << 32 else 4
    raw = values.astype(f"<u{wide}").view(np.uint8).reshape(-1, wide).T.tobytes()
    return bytes([wide]) + zstandard.ZstdCompressor(level=1).compress(raw)


def restored(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), np.uint8)
    return np.ascontiguousarray(raw.reshape(blob[0], -1).T).view(f"<u{blob[0]}").ravel().astype(np.uint64)


def unpacked(blob: bytes) -> np.ndarray:
    """Hashes in order, of which the differences are squeezed."""
    return np.cumsum(restored(blob), dtype=np.uint64)


class EliasFano:
    """A monotone sequence: low bits packed, high bits in unary. Arrays may be memory-mapped; opening one makes a
    directory of its unary part."""

    def __init__(self, arrays: dict[str, np.ndarray], name: str) -> None:
        head, self.low, high = (arrays[f"{name}.{x}"] for x in ("head", "low", "high"))
        self.n, self.bits = int(head[0]), int(head[1])
        self.highs = np.flatnonzero(np.unpackbits(high.view(np.uint8), bitorder="little")) - np.arange(self.n)
        counts = np.bincount(self.highs) if self.n else np.empty(0, np.int64)
        self.begin = starts_of(counts)  # of each bucket of high bits

    @staticmethod
    def arrays(name: str, values: np.ndarray) -> dict[str, np.ndarray]:
        values, n = values.astype(np.uint64), len(values)
        bits = max(0, int(values[-1] // np.uint64(n)).bit_length() - 1) if n else 0
        low = values & np.uint64((1 << bits) - 1)
        places = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(64 * (int(places[-1]) // 64 + 1) if n else 64, bool)
        high[places] = True
        packed = np.zeros(n * bits // 64 + 2, np.uint64)
        if bits:
            at = np.arange(n, dtype=np.int64) * bits
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            np.bitwise_or.at(packed, word, low << shift)
            over = np.flatnonzero(shift + np.uint64(bits) > 64)
            np.bitwise_or.at(packed, word[over] + 1, low[over] >> (np.uint64(64) - shift[over]))
        return {f"{name}.head": np.array([n, bits], np.int64), f"{name}.low": packed, f"{name}.high": np.packbits(high, bitorder="little").view(np.uint64)}

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.int64) * self.bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        both = self.low[word] >> shift
        over = np.flatnonzero(shift + np.uint64(self.bits) > 64)
        both[over] |= self.low[word[over] + 1] << (np.uint64(64) - shift[over])
        return both & np.uint64((1 << self.bits) - 1)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        return self.highs[i].astype(np.uint64) << np.uint64(self.bits) | self.lows(i)

    def find(self, values: np.ndarray) -> np.ndarray:
        """The index of each value, -1 where it isn't there: only values of its bucket of high bits are looked at."""
        found = np.full(len(values), -1)
        inside = np.flatnonzero(values >> np.uint64(self.bits) < np.uint64(len(self.begin) - 1))
        high, low = (values[inside] >> np.uint64(self.bits)).astype(np.int64), values[inside] & np.uint64((1 << self.bits) - 1)
        at, end = self.begin[high], self.begin[high + 1]
        stop = end.copy()
        live = np.flatnonzero(at < stop)
        while len(live):  # the first of the bucket that is not less
            middle = (at[live] + stop[live]) >> 1
            less = self.lows(middle) < low[live]
            at[live[less]] = middle[less] + 1
            stop[live[~less]] = middle[~less]
            live = live[at[live] < stop[live]]
        some = np.flatnonzero(at < end)
        some = some[self.lows(at[some]) == low[some]]
        found[inside[some]] = at[some]
        return found


def new_nodes(columns: list[np.ndarray], runs: np.ndarray | None = None) -> list[np.ndarray]:
    """For each level whether a row of the n-grams in order begins a new prefix of that length; runs says where to begin anew."""
    fresh, out = np.zeros(len(columns[0]), bool), []
    fresh[:1] = True
    if runs is not None:
        fresh[runs] = True
    for c in columns:
        fresh = fresh.copy()
        fresh[1:] |= c[1:] != c[:-1]
        out.append(fresh)
    return out


class Trie:
    """n-grams in levels, a node for each prefix: words, pointers to the first children, and the 16-bit code of a node's
    chance after its context."""

    def __init__(self, arrays: dict[str, np.ndarray], order: int) -> None:
        self.words = [EliasFano(arrays, f"words{k}") for k in range(order)]
        self.pointers = [EliasFano(arrays, f"pointers{k}") for k in range(order - 1)]
        self.chances = [arrays[f"chances{k}"] for k in range(order)]

    @staticmethod
    def arrays(columns: list[np.ndarray], chances: list[np.ndarray]) -> dict[str, np.ndarray]:
        """Of distinct n-grams in order, and for each level the codes of its nodes."""
        out, fresh, above = {}, new_nodes(columns), None
        for k, c in enumerate(columns):
            rows = np.flatnonzero(fresh[k])
            level = c[rows].astype(np.uint64)
            if above is not None and len(rows):
                first = np.searchsorted(rows, above)
                last = c[rows[np.append(first[1:], len(rows)) - 1]].astype(np.uint64)
                base = np.zeros(len(above), np.uint64)
                np.cumsum(last[:-1] + np.uint64(1), out=base[1:])
                level += np.repeat(base, np.diff(np.append(first, len(rows))))
                out |= EliasFano.arrays(f"pointers{k - 1}", first)
            elif above is not None:
                out |= EliasFano.arrays(f"pointers{k - 1}", rows)
            out |= EliasFano.arrays(f"words{k}", level) | {f"chances{k}": chances[k].astype(np.uint16)}
            above = rows
        return out

    def nodes(self, columns: list[np.ndarray]) -> list[np.ndarray]:
        """For n-grams in order, at each level the node of each distinct prefix, -1 where the trie has none."""
        fresh, out, rows = new_nodes(columns), [], None
        for k, c in enumerate(columns):
            own = np.flatnonzero(fresh[k])
            if k == 0:
                found = self.words[0].find(c[own].astype(np.uint64))
            else:
                words, found = self.words[k], np.full(len(own), -1)
                parent = out[-1][np.searchsorted(rows, own, "right") - 1]
                known = np.flatnonzero(parent >= 0)
                start = self.pointers[k - 1][parent[known]].astype(np.int64)
                after = np.full(len(known), words.n)
                inner = np.flatnonzero(parent[known] + 1 < self.pointers[k - 1].n)
                after[inner] = self.pointers[k - 1][parent[known][inner] + 1].astype(np.int64)
                base = np.zeros(len(known), np.uint64)
                late = np.flatnonzero(start > 0)
                base[late] = words[start[late] - 1] + np.uint64(1)
                asked = c[own[known]].astype(np.uint64) + base
                inside = np.flatnonzero(asked <= words[after - 1]) if len(known) else known  # else it would fall among the next node's children
                found[known[inside]] = words.find(asked[inside])
            out.append(found)
            rows = own
        return out


def mapped(arrays: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], object]:
    """The arrays in one memory-mapped file in the task's own folder; the file goes when the second result does."""
    file, parts, at = tempfile.NamedTemporaryFile(prefix="deltaloom-trie-"), {}, 0
    for name, values in arrays.items():
        values.tofile(file)
        parts[name], at = (at, values), at + values.nbytes
        file.write(b"\0" * (-at % 8))
        at += -at % 8
    file.flush()
    whole = np.memmap(file.name, np.uint8, "r").view(np.ndarray) if at else np.empty(0, np.uint8)
    return {k: whole[a : a + v.nbytes].view(v.dtype) for k, (a, v) in parts.items()}, file


BLOCKS = "block bigint, docs array<bigint>, lengths array<int>, held array<boolean>, vocabulary binary, counts binary, tokens binary"


def blocks(docs: DataFrame, most_bytes: int) -> DataFrame:
    """docs (doc_id, text, held) as blocks of so many bytes of text at most, or one document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        keys, held, hashes, size = [], [], [], 0

        def block() -> pa.RecordBatch:
            nonlocal keys, held, hashes, size, count
            lengths, flat = np.array([len(h) for h in hashes]), np.concatenate(hashes)
            vocabulary, tokens = np.unique(flat, return_inverse=True)
            trained = np.repeat(~np.array(held), lengths)
            counts = np.bincount(tokens[trained], minlength=len(vocabulary))
            row = {"block": [(part << 32) + count], "docs": [keys], "lengths": [lengths.astype(np.int32)], "held": [held], "vocabulary": [squeezed(np.diff(vocabulary, prepend=np.uint64(0)))], "counts": [squeezed(counts)], "tokens": [squeezed(tokens)]}
            keys, held, hashes, size, count = [], [], [], 0, count + 1
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.bool_()), *[pa.binary()] * 3]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row.values(), kinds, strict=True)], list(row))

        for batch in chunks(batches, 64):
            for key, text, out in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "held")), strict=True):
                raw = lower_ascii(utf8(text))
                words = WORD_BYTES.findall(raw)
                if keys and size + len(raw) > most_bytes:
                    yield block()
                own = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
                keys.append(key)
                held.append(out)
                hashes.append(np.append(own, END))
                size += len(raw)
        if keys:
            yield block()

    ship(docs.sparkSession)
    return docs.mapInArrow(run, BLOCKS)


def distinct(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of columns of numbers, in order, and the place of each row among them."""
    bits = max(int(c.max(initial=0)).bit_length() for c in columns)
    if bits * len(columns) <= 64:
        key = np.zeros(len(columns[0]), np.uint64)
        for c in columns:
            key = key << np.uint64(bits) | c.astype(np.uint64)
        key, place = np.unique(key, return_inverse=True)
        mask = np.uint64((1 << bits) - 1)
        return [(key >> np.uint64(bits * i) & mask).astype(columns[0].dtype) for i in reversed(range(len(columns)))], place
    order = np.lexsort(columns[::-1])
    fresh = new_nodes([c[order] for c in columns])[-1]
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(fresh) - 1
    return [c[order[fresh]] for c in columns], place


def ranked(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """columns with their numbers replaced by ranks among all that occur, and these in order."""
    most = max(int(c.max(initial=0)) for c in columns)
    if most < 1 << 23:  # a map of all numbers is small
        seen = np.zeros(most + 1, bool)
        for c in columns:
            seen[c] = True
        rank = np.cumsum(seen, dtype=np.int32) - 1
        return [rank[c] for c in columns], np.flatnonzero(seen)
    words, rank = np.unique(np.concatenate(columns), return_inverse=True)
    return np.split(rank, len(columns)), words


#: Symbols before a document's first word and after its end; words follow.
BEGIN, PAD, WORDS = 0, 1, 2


class Grams:
    """A block's distinct n-grams in order (columns of symbols, those of words in the order of its vocabulary), their
    training counts, and where its tokens are among them. The n-grams start at every symbol that some context of a token starts at."""

    def __init__(self, row: pd.Series, n: int) -> None:
        self.n, self.tokens = n, restored(row["tokens"]).astype(np.int64)
        self.lengths = np.asarray(row["lengths"], np.int64)
        self.held, self.begins = np.asarray(row["held"], bool), np.cumsum(self.lengths) - self.lengths
        self.many = self.lengths + n - 2  # n-grams of a document
        self.first = np.cumsum(self.many) - self.many
        columns = [self._column(i) for i in range(n)]
        self.columns, self.place = distinct(columns)
        self.counts = np.bincount(self.place[np.repeat(~self.held, self.many)], minlength=len(self.columns[0]))

    def _column(self, i: int) -> np.ndarray:
        """The symbols that stand i after the starts of n-grams: the n-gram k of a document starts at its token k - (n - 1)."""
        at = np.arange(int(self.many.sum())) - np.repeat(self.first, self.many) + i - (self.n - 1)
        end = np.repeat(self.lengths, self.many)
        inside = (at >= 0) & (at < end)
        out = np.where(at < 0, BEGIN, PAD).astype(np.int32)
        out[inside] = self.tokens[(at + np.repeat(self.begins, self.many))[inside]] + WORDS
        return out

    def of_tokens(self, k: int) -> np.ndarray:
        """For each token the n-gram whose first k symbols are the token and the k - 1 before it."""
        at = np.arange(len(self.tokens)) - np.repeat(self.begins - self.first, self.lengths)
        return self.place[at + self.n - k]


def hot_symbols(totals: np.ndarray, hot: int) -> np.ndarray:
    """Which symbols of a block occur over hot times; before and after a document is as often as its end, its first word."""
    end = totals[:1] > hot
    return np.concatenate([end, end, totals > hot])


def context_keys(columns: list[np.ndarray], hashes: np.ndarray) -> np.ndarray:
    """64 bits of each context, a row of symbols whose hashes are given."""
    h = np.full(len(columns[0]), len(columns), np.uint64)
    for c in columns:
        h = (h ^ hashes[c]) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(32)


def symbol_hashes(words: np.ndarray) -> np.ndarray:
    return np.concatenate([np.array([1, 2], np.uint64), words])


def hot_contexts(row: pd.Series, hot: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys, in order, of a block's contexts of up to n - 1 symbols that are all hot, and how often they occur in
    training, of those that end in BEGIN only where a token follows."""
    tokens = restored(row["tokens"]).astype(np.int64) + WORDS
    lengths, held = np.asarray(row["lengths"], np.int64), np.asarray(row["held"], bool)
    begins = np.cumsum(lengths + 2 * (n - 1)) - lengths - (n - 1)
    flat = np.full(len(tokens) + 2 * (n - 1) * len(lengths), PAD)
    for i in range(1, n):
        flat[begins - i] = BEGIN
    flat[np.repeat(begins - (np.cumsum(lengths) - lengths), lengths) + np.arange(len(tokens))] = tokens
    trained = np.repeat(~held, lengths + 2 * (n - 1))
    keys, counts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    at = np.flatnonzero(hot[flat] & (flat != PAD))
    for k in range(1, n):
        at = at[hot[flat[at + k - 1]]]
        keys.append(context_keys([flat[at + i] for i in range(k)], hashes))
        counts.append(trained[at] & ((flat[at + k - 1] >= WORDS) | (flat[at + k] >= WORDS)))
    keys, place = np.unique(np.concatenate(keys), return_inverse=True)
    return keys, np.bincount(place, np.concatenate(counts), len(keys)).astype(np.int64)


def log_code(chance: np.ndarray) -> np.ndarray:
    """16-bit codes of probabilities, 0 for none."""
    out, some = np.zeros(len(chance), np.int64), np.flatnonzero(chance > 0)
    out[some] = 1 + np.clip(np.round(-np.log10(chance[some]) / STEP), 0, 65534)
    return out


def chance_of(codes: np.ndarray) -> np.ndarray:
    return np.where(codes > 0, 10 ** ((1 - codes.astype(np.float64)) * STEP), 0.0)


def dealt(columns: list[np.ndarray], hot: np.ndarray, parts: int) -> np.ndarray:
    """The part of each n-gram (columns of numbers): by its symbols up to the first that isn't hot (rows of flags)."""
    h, on = np.zeros(len(columns[0]), np.uint64), np.ones(len(columns[0]), bool)
    for c, is_hot in zip(columns, hot, strict=True):
        mixed = (h ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h = np.where(on, (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xD6E8FEB86659FD93), h)
        on = on & is_hot
    return ((h >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)


def share_of(total: np.ndarray, backoff: tuple, k: int) -> np.ndarray:
    """The share that contexts of k + 1 words leave to shorter ones, by how often they occur; all, if never."""
    a, b = backoff[min(k, len(backoff) - 1)]
    return np.where(total > 0, a * np.maximum(total, 1.0) ** -b, 1.0)


def merged_trie(columns: list[np.ndarray], counts: np.ndarray, given: list[np.ndarray], backoff: tuple) -> dict[str, np.ndarray]:
    """The trie's arrays for distinct n-grams in order and their training counts. given has for each level the totals of
    contexts that are counted apart, plus one, and 0 for all others."""
    fresh = new_nodes(columns)
    given = [g[np.cumsum(f) - 1] for g, f in zip(given, fresh, strict=False)]
    some = np.flatnonzero((counts > 0) | np.logical_or.reduce([g > 1 for g in given]))
    given = [g[some] for g in given]
    columns, counts = [c[some] for c in columns], counts[some]
    fresh, order = new_nodes(columns), len(columns)
    rows = [np.flatnonzero(f) for f in fresh]
    node = [np.cumsum(f) - 1 for f in fresh]
    seen = [np.bincount(x, counts, len(r)) if len(r) else np.empty(0) for x, r in zip(node, rows, strict=True)]
    apart = [g[r] for g, r in zip(given, rows, strict=False)]
    seen = [*(np.where(own > 0, own - 1, c) for own, c in zip(apart, seen, strict=False)), seen[-1]]
    chances = [np.zeros(len(rows[0]), np.int64)]
    for k in range(order - 1):
        below = rows[k + 1]
        real = columns[k + 1][below] >= WORDS
        up = node[k][below]
        total = np.bincount(up[real], seen[k + 1][real], len(rows[k])) if len(below) else np.empty(0)
        total = np.where(apart[k] > 0, apart[k] - 1, total)
        share = share_of(total, backoff, k)
        chances.append(log_code(np.where(real & (total[up] > 0), (1 - share[up]) * seen[k + 1] / np.maximum(total[up], 1), 0.0)))
    return Trie.arrays(columns, chances)


def vocabulary_parts(made: DataFrame, parts: int, hot: int | None = None) -> DataFrame:
    """(block, part, numbers, totals) for each block (block, vocabulary, counts) and part of its words, and with block -1
    how many of a part's words are in training texts and how often, and, as numbers, the hashes and then the numbers of
    those of over hot totals. A word's number in its part is its rank by totals; without hot there are no numbers."""

    def ask(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(frames, 1):
            vocabulary, counts = unpacked(batch["vocabulary"][0].as_py()), restored(batch["counts"][0].as_py())
            where = _word_part(vocabulary, parts)
            for part, (a, b) in _runs(where):
                yield pa.RecordBatch.from_arrays([pa.array([part]), batch["block"], pa.array([squeezed(np.diff(vocabulary[a:b], prepend=np.uint64(0)))]), pa.array([squeezed(counts[a:b])])], ["part", "block", "words", "counts"])

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block")
        own = [unpacked(x) for x in frame["words"]]
        words, place = np.unique(np.concatenate(own), return_inverse=True)
        totals = np.zeros(len(words), np.uint64)
        np.add.at(totals, place, np.concatenate([restored(x) for x in frame["counts"]]))
        part, at, out = int(frame["part"].iloc[0]), 0, []
        rank = np.empty(len(words), np.uint64)
        rank[np.argsort(-totals.astype(np.int64), kind="stable")] = np.arange(len(words))
        for block, x in zip(frame["block"], own, strict=True):
            here = place[at : at + len(x)]
            at += len(x)
            out.append((block, part, b"" if hot is None else squeezed(rank[here]), squeezed(totals[here]), 0, 0))
        often = np.flatnonzero(totals > hot) if hot is not None else np.empty(0, np.int64)
        out.append((-1, part, squeezed(np.concatenate([words[often], rank[often]])), squeezed(totals[often]), int((totals > 0).sum()), int(totals.sum())))
        return pd.DataFrame(out, columns=["block", "part", "numbers", "totals", "distinct", "tokens"])

    asked = made.select("block", "vocabulary", "counts").mapInArrow(ask, "part bigint, block bigint, words binary, counts binary")
    return by_parts(asked, parts).applyInPandas(count, "block bigint, part bigint, numbers binary, totals binary, distinct bigint, tokens bigint")


def _word_part(words: np.ndarray, parts: int) -> np.ndarray:
    return ((words >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _runs(where: np.ndarray) -> list[tuple[int, tuple[int, int]]]:
    edge = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1], [True]])) if len(where) else np.zeros(1, np.int64)
    return [(int(where[a]), (int(a), int(b))) for a, b in zip(edge[:-1], edge[1:], strict=True)]


def hot_words(words: DataFrame, hot: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes, in order, and the numbers of the words of over hot occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for part, w, t in zip(*(batch[c].to_pylist() for c in ("part", "numbers", "totals")), strict=True):
                some, (hashes, rank) = restored(t) > hot, np.split(restored(w), 2)
                kept.append(np.concatenate([hashes[some], rank[some] * np.uint64(parts) + np.uint64(part)]).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.binary())], ["words"])

    found = words.where("block = -1").select("part", "numbers", "totals").mapInArrow(run, "words binary").where("length(words) > 0").collect()
    pieces = [np.split(np.frombuffer(bytes(r[0]), np.uint64), 2) for r in found]
    hashes, numbers = (np.concatenate([np.empty(0, np.uint64), *(p[i] for p in pieces)]) for i in (0, 1))
    order = np.argsort(hashes)
    return hashes[order], numbers[order].astype(np.int64)


def numbered(words: pd.DataFrame, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers and training counts of a block's vocabulary, in its order. Frequent words have small numbers."""
    words = words.sort_values("part")
    numbers = [restored(x) * np.uint64(parts) + np.uint64(p) for p, x in zip(words["part"], words["numbers"], strict=True)]
    return np.concatenate(numbers).astype(np.int64), np.concatenate([restored(x) for x in words["totals"]]).astype(np.int64)


class Deal:
    """How a block's n-grams go to parts: their order by part, the runs of parts, and where prefixes begin in each run."""

    def __init__(self, grams: Grams, numbers: np.ndarray, flags: np.ndarray, parts: int) -> None:
        symbol = np.concatenate([np.array([BEGIN, PAD]), numbers + WORDS])
        columns = [symbol[c] for c in grams.columns]
        to = dealt(columns, [flags[c] for c in grams.columns], parts)
        self.order = np.argsort(to.astype(np.uint16) if parts <= 1 << 16 else to, kind="stable")
        self.runs = _runs(to[self.order])
        edge = np.array([*(a for _, (a, _) in self.runs), len(to)])
        columns = [c[self.order] for c in columns]
        self.fresh = [np.flatnonzero(f) for f in new_nodes(columns, edge[:-1])]
        #: For each level its nodes' symbols and numbers of children, and where the runs' nodes begin.
        self.symbols = [c[f] for c, f in zip(columns, self.fresh, strict=True)]
        self.children = [np.diff(np.searchsorted(below, np.append(own, len(to)))) for own, below in zip(self.fresh, self.fresh[1:], strict=False)]
        self.cuts = [np.searchsorted(f, edge) for f in self.fresh]


def unfolded(symbols: list[np.ndarray], children: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The columns of n-grams given by nodes and their numbers of children, and for each level where its nodes begin."""
    columns, fresh = [], [np.arange(len(symbols[-1]))]
    for many in reversed(children):
        fresh.append(fresh[-1][starts_of(many)[:-1]])
    for k, own in enumerate(symbols):
        for many in children[k:]:
            own = np.repeat(own, many)
        columns.append(own)
    return columns, fresh[::-1]


def score(docs: DataFrame, held: object = None, order: int = 3, backoff: tuple = ((0.9, 0.1), (0.75, 0.15)), block_bytes: int = 8 << 20, part_blocks: int = 4, hot: int = 200_000) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each of docs (doc_id, text).

    held: a boolean column, true where a row isn't learned from. backoff: (a, b) for orders 2, 3 and so on, the last for
    all higher ones. There is a word part for each part_blocks blocks, and two parts of n-grams for each block, so a
    part's work doesn't grow with the input. A word is hot beyond hot occurrences, or a 2^23rd of all tokens if that is
    more, which bounds the list of hot words that tasks get to 64 MB."""
    n = order
    if n < 2:
        raise ValueError("the order must be 2 or more")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), (F.lit(False) if held is None else held).alias("held"))
    made = written(blocks(rows, block_bytes))
    many = made.count()
    parts, word_parts = max(12, 2 * many), max(6, -(-many // part_blocks))
    words = written(vocabulary_parts(made, word_parts, hot))
    known = words.where("block = -1").agg(F.sum("distinct"), F.sum("tokens")).first()
    distinct_words, tokens = int(known[0] or 0), int(known[1] or 0)
    limit = max(hot, tokens >> 23)
    often, often_numbers = hot_words(words, limit, word_parts)
    by_number = np.argsort(often_numbers)

    def hot_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 1):
            row = {c: batch[c][0].as_py() for c in batch.schema.names}
            vocabulary = unpacked(row["vocabulary"])
            flags = np.isin(vocabulary, often)
            keys, counts = hot_contexts(row, np.concatenate([flags[:1], flags[:1], flags]), symbol_hashes(vocabulary), n)
            if len(keys):
                yield pa.RecordBatch.from_arrays([batch["block"], pa.array([squeezed(np.diff(keys, prepend=np.uint64(0)))]), pa.array([squeezed(counts)])], ["block", "vocabulary", "counts"])

    base = made.select("block", "lengths", "held", "tokens")
    contexts = vocabulary_parts(made.select(*base.columns, "vocabulary").mapInArrow(hot_blocks, "block bigint, vocabulary binary, counts binary"), word_parts)
    told = words.where("block >= 0").select("block", "part", "numbers", "totals")
    both = told.withColumn("kind", F.lit(0)).union(contexts.where("block >= 0").select("block", "part", "numbers", "totals", F.lit(1)))

    def ask(key: tuple, own: pd.DataFrame, rest: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, row in own.iterrows():
            numbers, totals = numbered(rest[rest["kind"] == 0], word_parts)
            found = rest[rest["kind"] == 1].sort_values("part")
            context_totals = np.concatenate([np.empty(0, np.uint64), *(restored(x) for x in found["totals"])]).astype(np.int64)
            flags = hot_symbols(totals, limit)
            hashes, some = np.zeros(len(numbers), np.uint64), np.flatnonzero(totals > limit)
            hashes[some] = often[by_number[np.searchsorted(often_numbers[by_number], numbers[some])]] if len(some) else 0
            hashes = symbol_hashes(hashes)  # only those of hot words are needed
            grams, keys = Grams(row, n), hot_contexts(row, flags, hashes, n)[0]
            deal = Deal(grams, numbers, flags, parts)
            counts, given = grams.counts[deal.order], []
            for k in range(n - 1):
                at = deal.order[deal.fresh[k]]
                some = np.flatnonzero(np.logical_and.reduce([flags[c[at]] for c in grams.columns[: k + 1]]))
                value = np.zeros(len(at), np.int64)
                if len(some):
                    value[some] = 1 + context_totals[np.searchsorted(keys, context_keys([c[at[some]] for c in grams.columns[: k + 1]], hashes))]
                given.append(value)
            for i, (part, (a, b)) in enumerate(deal.runs):
                own = lambda levels, i=i: [squeezed(x[cut[i] : cut[i + 1]]) for x, cut in zip(levels, deal.cuts, strict=False)]
                out.append((part, row["block"], own(deal.symbols), own(deal.children), squeezed(counts[a:b]), own(given)))
        release()
        return pd.DataFrame(out, columns=["part", "block", "symbols", "children", "counts", "given"])

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block")
        level = lambda name, k: np.concatenate([restored(x[k]) for x in frame[name]]).astype(np.int64)
        columns, fresh = unfolded([level("symbols", k) for k in range(n)], [level("children", k) for k in range(n - 1)])
        counts = [restored(x) for x in frame["counts"]]
        edge = starts_of(np.array([len(x) for x in counts]))
        ranks, symbols = ranked(columns)
        grams, place = distinct(ranks)
        del ranks, columns
        grams = [symbols[c] for c in grams]
        total = np.bincount(place, np.concatenate(counts), len(grams[0])).astype(np.int64)
        node = [np.cumsum(f) - 1 for f in new_nodes(grams)]
        given = []
        for k in range(n - 1):
            value = np.zeros(int(node[k][-1]) + 1, np.int64)
            value[node[k][place[fresh[k]]]] = level("given", k)
            given.append(value)
        arrays, file = mapped(merged_trie(grams, total, given, backoff))
        with file:
            trie = Trie(arrays, n)
            found = trie.nodes(grams)
            code = lambda codes, at: np.where(at >= 0, codes[np.maximum(at, 0)] if len(codes) else 0, 0).astype(np.uint64)
            chances = [code(trie.chances[k], found[k])[node[k][place[fresh[k]]]] for k in range(n)]
            del trie
        cuts = [np.searchsorted(f, edge) for f in fresh]
        out = []
        for i, block in enumerate(frame["block"]):
            own = squeezed(np.concatenate([chances[k][cuts[k][i] : cuts[k][i + 1]] for k in range(1, n)]))
            out.append((block, int(frame["part"].iloc[0]), own))
        release()
        return pd.DataFrame(out, columns=["block", "part", "chances"])

    def levels_of(answers: list, deal: Deal) -> list[np.ndarray]:
        """For each level but the first the probability that came back for each n-gram, in the block's order."""
        levels = range(1, n)
        pieces = [[] for _ in levels]
        for i, blob in enumerate(answers):
            codes, at = restored(blob), 0
            for own, k in zip(pieces, levels, strict=True):
                many = int(deal.cuts[k][i + 1] - deal.cuts[k][i])
                own.append(codes[at : at + many])
                at += many
        out = []
        for own, k in zip(pieces, levels, strict=True):
            value = np.empty(len(deal.order), np.float64)
            value[deal.order] = np.repeat(chance_of(np.concatenate(own)), np.diff(np.append(deal.fresh[k], len(deal.order))))
            out.append(value)
        return out

    def total(key: tuple, own: pd.DataFrame, rest: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, row in own.iterrows():
            numbers, totals = numbered(pd.DataFrame([x for x in rest["word"] if x is not None]), word_parts)
            answers = pd.DataFrame([x for x in rest["reply"] if x is not None]).sort_values("part")
            grams = Grams(row, n)
            deal = Deal(grams, numbers, hot_symbols(totals, limit), parts)
            chances = levels_of(answers["chances"], deal)
            shares, begun = [], np.ones(len(deal.order), bool)
            for k in range(n - 1):  # of contexts of k + 1 words
                if k:
                    count = np.rint(chances[k - 1] * count / np.maximum(1 - shares[-1], 1e-12))
                else:
                    count = np.concatenate([totals[:1], [0], totals])[grams.columns[0]].astype(np.float64)
                begun &= grams.columns[k] == BEGIN
                count = np.where(begun, totals[0], count)  # before a document: as often as its end
                shares.append(share_of(count, backoff, k))
            base = ((totals + 1) / (tokens + distinct_words + 1))[grams.tokens]
            chance = base
            for k in range(2, n + 1):
                at = grams.of_tokens(k)
                chance = chances[k - 2][at] + shares[k - 2][at] * chance
            known_tokens, begin = (totals > 0)[grams.tokens].astype(np.int64), grams.begins
            out.append(
                pd.DataFrame({
                    "doc_id": pd.array(list(row["docs"]), "Int64"), "held_out": list(row["held"]), "n_tokens": grams.lengths, "n_known": np.add.reduceat(known_tokens, begin),
                    "train_tokens": tokens, "base_score": np.add.reduceat(np.log10(base), begin), "score": np.add.reduceat(np.log10(chance), begin),
                })
            )
        release()
        return pd.concat(out)

    asked = base.groupBy("block").cogroup(both.groupBy("block")).applyInPandas(ask, "part bigint, block bigint, symbols array<binary>, children array<binary>, counts binary, given array<binary>")
    answers = written(by_parts(asked, parts).applyInPandas(answer, "block bigint, part bigint, chances binary"))
    replies = told.select("block", F.struct("part", "numbers", "totals").alias("word"), F.lit(None).cast("struct<part:bigint,chances:binary>").alias("reply")).unionByName(
        answers.select("block", F.lit(None).cast("struct<part:bigint,numbers:binary,totals:binary>").alias("word"), F.struct("part", "chances").alias("reply"))
    )
    scored = made.select("block", "docs", "lengths", "held", "tokens").groupBy("block").cogroup(replies.groupBy("block"))
    return scored.applyInPandas(total, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), ~learned_from(F.col("doc_id"), 7, 2))

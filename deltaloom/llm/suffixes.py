"""Repeated passages by a distributed merge sort of suffixes that never compares a known prefix again.

A byte goes if a string of ``length`` bytes that covers it also starts earlier: at a smaller doc_id, or earlier in the
same document. Whether such a window repeats is settled exactly, but only suffixes that can matter are sorted:

1. Documents become blocks of bounded text. Of the grams of ``GRAM`` bytes in a window, the one of least hash is its
   anchor, a choice that depends on the window alone, so equal windows have anchors at equal places. Anchors are about
   1 in 27 bytes, and each block says which hashes it has; parts of the hash range say which occur at least twice.
2. A window can only repeat if its anchor does. Each block sorts what is left: for each such anchor the suffix from it
   and the bytes before it, as far as its windows reach; equal ones are kept once, at their first place. Where an
   anchor is too frequent for one task, its windows are sorted as suffixes of their own, so that unequal ones part.
3. The sorted runs are exchanged front-coded (shared prefix lengths and tails), cut at sampled splitters, and each part
   merges its runs by a loser tree that keeps, for each run, the prefix shared with the last output, and compares bytes
   only from there. The shared prefixes cut the merged order into groups of one anchor gram, in which windows at one
   distance from the anchor are classed by digests whose neighbours are compared byte by byte, and all but the first of
   a class repeat. At most ``ranges`` splitters are chosen, from a sample in proportion to the runs; beyond that a range
   is dealt on by the hash of the anchor gram, so a part's size does not grow with the input.
4. The blocks learn which windows repeat and remove what they cover.

A window sorted on its own may stand in every block. So blocks are dealt to groups of about ``group_blocks``, a part merges
such windows of one group only, and of the groups' first ones an aggregate, combined in the tasks that read them, tells the
first of all.

Defined results: a null or empty text has 0 bytes and nothing removed; rows with one doc_id stand in the order of the
64-bit digests of their texts, equal rows included, as if later ones were later documents, however the rows lie in the
input; rows without one come last, in the same order; an empty table gives an empty one; other columns play no part.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom.llm.common import by_parts, chunks, release, ship, table, utf8, written
from deltaloom.llm.ngrams import _runs, _word_part, restored, squeezed

GRAM = 48
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
NO_ID = (1 << 63) - 1
#: Bits of an anchor's hash that are exchanged; two grams that share them only cost a comparison later.
HASH_BITS = 48
#: What tells which of two equal windows comes first.
PLACE = ("keys", "marks", "own", "offset")


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """The hash of each gram of data, by doubling: 16, 32 and 48 bytes."""
    h, width = data.astype(np.uint64) + np.uint64(1), 1
    while width < 16:
        h = h[:-width] * np.uint64(pow(BASE, width, 1 << 64)) + h[width:]
        width *= 2
    two = h[:-16] * np.uint64(pow(BASE, 16, 1 << 64)) + h[16:]
    return _mixed(two[:-16] * np.uint64(pow(BASE, 16, 1 << 64)) + h[32:])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return h ^ (h >> np.uint64(29))


def hashes_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The hashes of the grams that start at the places given."""
    h = np.zeros(len(at), np.uint64)
    for i in range(GRAM):
        h = h * np.uint64(BASE) + data[at + i] + np.uint64(1)
    return _mixed(h)


def exchanged_hashes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """What is exchanged of these hashes, mixed again: anchors have small ones, which would crowd into few parts."""
    return _mixed(hashes_at(data, at) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1)) >> np.uint64(64 - HASH_BITS)


def anchors(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The anchors of documents that lie end to end in data, each with its least and most distance from the start of
    its windows. Chunks overlap by a window, so each window is seen in one; an anchor with windows in two comes twice."""
    wide, size, found = length - GRAM + 1, 1 << 17, []
    for at in range(0, max(0, len(data) - length + 1), size):
        part = data[at : at + size + length - 1]
        key = gram_hashes(part) >> np.uint64(20) << np.uint64(20) | np.arange(len(part) - GRAM + 1, dtype=np.uint64)
        width = 1
        while 2 * width <= wide:
            key, width = np.minimum(key[:-width], key[width:]), 2 * width
        least = np.minimum(key[: len(key) - (wide - width)], key[wide - width :]) if wide > width else key
        start = np.arange(at, at + len(least), dtype=np.int64)
        good = start + length <= ends[np.searchsorted(ends, start, "right")]
        start, anchor = start[good], (least[good] & np.uint64((1 << 20) - 1)).astype(np.int64) + at
        begin = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]])) if len(anchor) else start
        last = np.append(begin[1:], len(anchor)) - 1 if len(anchor) else start
        found.append(np.stack([anchor[begin], anchor[begin] - start[last], anchor[begin] - start[begin]]))
    return tuple(np.concatenate([np.empty((3, 0), np.int64), *found], 1))


def merged(runs: list[list[bytes]], shared: list[list[int]]) -> tuple[list[int], list[int]]:
    """The run of each output in order, and the prefix it shares with the output before. Strings are of one length.

    shared holds what each string shares with its predecessor in the run. A node of the loser tree keeps its loser and
    the prefix that it shares with the string that beat it: of two that share different lengths with the last output
    the one that shares more is smaller, and bytes are compared, from there on, only if they share the same."""
    size = 1 << max(0, len(runs) - 1).bit_length()
    head, place = [r[0] if r else b"" for r in runs], [0] * len(runs)
    loser, prefix = [-1] * size, [-1] * size

    def play(node: int) -> tuple[int, int]:
        if node >= size:
            return (node - size, 0) if node - size < len(runs) and runs[node - size] else (-1, -1)
        (a, x), (b, y) = play(2 * node), play(2 * node + 1)
        if x < y:
            a, x, b, y = b, y, a, x
        if x == y >= 0:
            y = _differ(head[a], head[b], 0)
            if head[b] < head[a]:
                a, b = b, a
        loser[node], prefix[node] = b, y
        return a, x

    now, same = play(1) if size > 1 else (0, 0 if runs and runs[0] else -1)
    order, lcps = [], []
    while same >= 0:
        order.append(now)
        lcps.append(same)
        i = place[now] = place[now] + 1
        run = runs[now]
        node = (now + size) >> 1
        if i < len(run):
            text, same = run[i], shared[now][i]
            head[now] = text
        else:
            text, same = b"", -1
        while node:
            other = prefix[node]
            if other > same:
                loser[node], now, prefix[node], same = now, loser[node], same, other
                text = head[now]
            elif other == same >= 0:
                rival = head[loser[node]]
                prefix[node] = _differ(text, rival, same)
                if rival < text:
                    loser[node], now, text = now, loser[node], rival
            node >>= 1
    return order, lcps


def _differ(a: bytes, b: bytes, known: int) -> int:
    """How many bytes a and b share, of which known are known."""
    left = len(a) - known
    return known + left - ((int.from_bytes(a[known:], "big") ^ int.from_bytes(b[known:], "big")).bit_length() + 7) // 8


BLOCKS = "block bigint, docs array<bigint>, rest binary, lengths array<bigint>, bytes binary, places binary, near binary, far binary, hashes binary, times binary"


def blocks(docs: DataFrame, length: int, most_bytes: int) -> DataFrame:
    """docs (doc_id, text, row) as blocks of so many bytes at most, or one document, with their anchors. row is a struct
    that is carried along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count, held, size = TaskContext.get().partitionId(), 0, [], 0

        def block() -> pa.RecordBatch:
            nonlocal held, size, count
            held.sort(key=lambda x: (x[0] is None, x[0] or 0, xxhash.xxh64_intdigest(x[2]), x[2]))
            rows = pa.Table.from_batches([x[1] for x in held])
            raw = b"".join(x[2] for x in held)
            data, lengths = np.frombuffer(raw, np.uint8), [len(x[2]) for x in held]
            at, near, far = anchors(data, np.cumsum(lengths), length)
            hashes, times = np.unique(exchanged_hashes(data, at), return_counts=True)
            row = [(part << 32) + count, [x[0] for x in held], packed_rows(rows), lengths, zstandard.ZstdCompressor(level=4).compress(raw)]
            row += [squeezed(np.diff(at, prepend=0)), squeezed(near), squeezed(far), squeezed(np.diff(hashes, prepend=np.uint64(0))), squeezed(times)]
            held, size, count = [], 0, count + 1
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64()), *[pa.binary()] * 6]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], [c.split()[0] for c in BLOCKS.split(", ")])

        for batch in chunks(batches, 64):
            rows = batch.select(["row"])
            for i, (key, text) in enumerate(zip(*(batch[c].to_pylist() for c in ("doc_id", "text")), strict=True)):
                raw = utf8(text)
                if held and size + len(raw) > most_bytes:
                    yield block()
                held.append((key, rows.slice(i, 1), raw))
                size += len(raw)
        if held:
            yield block()

    ship(docs.sparkSession)
    return docs.mapInArrow(run, BLOCKS)


def repeated_hashes(made: DataFrame, parts: int, hot: int) -> DataFrame:
    """(block, part, flags): for each of a block's hashes in a part whether it occurs once (0), more often (1), or at
    least hot times (2) in all blocks."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 1):
            hashes, times = np.cumsum(restored(batch["hashes"][0].as_py()), dtype=np.uint64), restored(batch["times"][0].as_py())
            for part, (a, b) in _runs(_word_part(hashes << np.uint64(64 - HASH_BITS), parts)):
                yield pa.RecordBatch.from_arrays([pa.array([part]), batch["block"], pa.array([squeezed(np.diff(hashes[a:b], prepend=np.uint64(0)))]), pa.array([squeezed(times[a:b])])], ["part", "block", "hashes", "times"])

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        own = [np.cumsum(restored(x), dtype=np.uint64) for x in frame["hashes"]]
        each, place = np.unique(np.concatenate(own), return_inverse=True)
        total = np.bincount(place, np.concatenate([restored(x) for x in frame["times"]]).astype(np.float64), len(each))
        flags = np.where(total >= hot, 2, np.where(total > 1, 1, 0))[place].astype(np.uint64)
        cuts = np.cumsum([len(x) for x in own])[:-1]
        return pd.DataFrame({"block": frame["block"], "part": frame["part"], "flags": [squeezed(x) for x in np.split(flags, cuts)]})

    asked = made.select("block", "hashes", "times").mapInArrow(ask, "part bigint, block bigint, hashes binary, times binary")
    return by_parts(asked, parts).applyInPandas(count, "block bigint, part bigint, flags binary")


def packed_rows(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    rows = rows.combine_chunks()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


class Text:
    """A block read back: its bytes and the documents in them."""

    def __init__(self, row: pd.Series) -> None:
        self.raw = zstandard.ZstdDecompressor().decompress(row["bytes"])
        self.data = np.frombuffer(self.raw, np.uint8)
        self.lengths = np.asarray(row["lengths"], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.keys = np.array([NO_ID if k is None or k != k else int(k) for k in row["docs"]], np.int64)

    def place(self, at: np.ndarray) -> dict[str, np.ndarray]:
        """The document's id, its text's digest, its place in the block, and the offset in it."""
        view, each = memoryview(self.raw), zip(self.begins.tolist(), self.lengths.tolist(), strict=True)
        marks = np.fromiter((xxhash.xxh64_intdigest(view[a : a + n]) for a, n in each), np.uint64, len(self.keys))
        own = np.searchsorted(self.begins + self.lengths, at, "right")
        return {"keys": self.keys[own], "marks": marks[own], "own": own, "offset": at - self.begins[own]}


def sorted_entries(row: pd.Series, flags: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """What a block has to sort: rows of the sort key, left bytes and reach, once each, and for each anchor that is left
    (seen) the entry it is or is part of.

    A row is 1 byte of kind (0: an anchor, 1: a window on its own), the suffix of length bytes, and the bytes before."""
    text, far_most = Text(row), length - GRAM
    at = np.cumsum(restored(row["places"]), dtype=np.uint64).astype(np.int64)
    near, far = restored(row["near"]).astype(np.int64), restored(row["far"]).astype(np.int64)
    flag = flags[np.unique(exchanged_hashes(text.data, at), return_inverse=True)[1]] if len(at) else np.empty(0, np.int64)
    live = flag > 0
    at, near, far, flag = at[live], near[live], far[live], flag[live]
    # rows: suffix (zeros beyond what the nearest window reaches), reach, bytes before
    rows = np.zeros((len(at), length + 2 + far_most), np.uint8)
    step = 1 << 13
    padded = np.concatenate([np.zeros(far_most, np.uint8), text.data, np.zeros(length, np.uint8)])
    for a in range(0, len(at), step):
        b = slice(a, a + step)
        own = padded[at[b, None] + np.arange(far_most + length)]
        column = np.arange(length)
        rows[b, :length] = np.where(column < (length - near[b, None]), own[:, far_most:], 0)
        rows[b, length], rows[b, length + 1] = near[b], far[b]
        column = np.arange(far_most)
        rows[b, length + 2 :] = np.where(column >= far_most - far[b, None], own[:, :far_most], 0)
    entry, first = _distinct(rows)
    rows, seen_at = rows[first], at[first]
    hot = flag[first] == 2
    windows, of, off = [], [], []
    spread = np.flatnonzero(hot)
    if len(spread):
        many = (rows[spread, length + 1].astype(np.int64) - rows[spread, length]) + 1
        of = np.repeat(spread, many)
        off = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many) + rows[of, length]
        start = seen_at[of] - off
        windows = np.zeros((len(of), length + 2 + far_most), np.uint8)
        for a in range(0, len(of), step):
            windows[a : a + step, :length] = text.data[start[a : a + step, None] + np.arange(length)]
        order = np.argsort(start, kind="stable")
        entry_w, first_w = _distinct(windows[order])
        window_entry = np.empty(len(of), np.int64)
        window_entry[order] = entry_w
        first_w = order[first_w]
        windows, window_at = windows[first_w], start[first_w]
    else:
        of = off = window_entry = first_w = window_at = np.empty(0, np.int64)
        windows = np.empty((0, length + 2 + far_most), np.uint8)
    keep = np.flatnonzero(~hot)
    kind = np.concatenate([np.zeros(len(keep), np.uint8), np.ones(len(windows), np.uint8)])
    both = np.concatenate([kind[:, None], np.concatenate([rows[keep], windows])], 1)
    place = np.concatenate([seen_at[keep], window_at])
    order = np.argsort(np.ascontiguousarray(both).view(np.dtype((np.void, both.shape[1]))).ravel(), kind="stable") if len(both) else np.empty(0, np.int64)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    number = np.full(len(rows), -1)
    number[keep] = rank[: len(keep)]
    return {
        "rows": both[order], **text.place(place[order]),
        "at": at, "near": near, "far": far, "entry": entry, "first": (np.arange(len(at)) == first[entry]) if len(at) else np.empty(0, bool),
        "number": number, "of": of, "off": off, "window": rank[len(keep) :][window_entry] if len(of) else of,
        "window_first": (np.arange(len(of)) == first_w[window_entry]) if len(of) else np.empty(0, bool),
    }


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the number of its like, and the first row of each number."""
    if not len(rows):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    whole = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.shape[1]))).ravel()
    _, first, entry = np.unique(whole, return_index=True, return_inverse=True)
    return entry, first


def shared_prefixes(rows: np.ndarray) -> np.ndarray:
    """What each row shares with the one before."""
    out = np.zeros(len(rows), np.int64)
    for a in range(1, len(rows), 1 << 16):
        b = min(len(rows), a + (1 << 16))
        differ = rows[a:b] != rows[a - 1 : b - 1]
        out[a:b] = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return out


def _same_windows(left: np.ndarray, right: np.ndarray, *columns: np.ndarray) -> bool:
    """Whether rows left and right of each column are equal throughout."""
    step = 1 << 14
    return all(np.array_equal(c[left[a : a + step]], c[right[a : a + step]]) for a in range(0, len(left), step) for c in columns)


FIRSTS = "array<struct<window:binary,key:bigint,mark:bigint,own:bigint,offset:bigint,at:bigint>>"


def settle(frame: pd.DataFrame, length: int, firsts: bool = False) -> pd.DataFrame:
    """The merge of a part's runs: for each entry of each run a mask, bit o set if the window o bytes before the entry
    also starts earlier; and, if asked for, the windows sorted on their own that don't."""
    wide, far_most = length + 1, length - GRAM
    runs, shared, rows = [], [], []
    for record in frame.itertuples():
        lcp = restored(record.shared).astype(np.int64)
        own = np.zeros((len(lcp), wide), np.uint8)
        tail = np.arange(wide) >= lcp[:, None]
        own[tail] = np.frombuffer(zstandard.ZstdDecompressor().decompress(record.tails), np.uint8)
        for i in np.flatnonzero(lcp).tolist():
            own[i, : lcp[i]] = own[i - 1, : lcp[i]]
        rest = np.frombuffer(zstandard.ZstdDecompressor().decompress(record.rest), np.uint8).reshape(len(lcp), 2 + far_most)
        flat = own.tobytes()
        runs.append([flat[i : i + wide] for i in range(0, len(flat), wide)])
        shared.append(lcp.tolist())
        rows.append(np.concatenate([own, rest], 1))
    order, lcps = merged(runs, shared)
    order, lcps = np.array(order, np.int64), np.array(lcps, np.int64)
    begins = np.cumsum([0, *map(len, runs)])
    rank = np.empty(len(order), np.int64)  # of the merged order's k-th, its place among all runs' entries end to end
    for r in range(len(runs)):
        rank[order == r] = np.arange(begins[r], begins[r + 1])
    rows = np.concatenate(rows)
    need = np.where(rows[rank, 0] == 1, wide, 1 + GRAM)
    group = np.empty(len(order), np.uint64)
    group[rank] = np.cumsum(lcps < need).astype(np.uint64)
    column = lambda c: np.concatenate([restored(x) for x in frame[c]]).astype(np.int64)
    marks = np.concatenate([restored(x) for x in frame["marks"]])
    who = np.repeat(frame["block"].to_numpy(), np.diff(begins))
    ids, offsets = column("keys"), column("offset")
    first = np.lexsort((offsets, column("own"), who, marks, ids))
    near, far = rows[first, 1 + length], rows[first, 2 + length]
    suffix, before, group = rows[first, 1 : 1 + length], rows[first, 3 + length :], group[first] * np.uint64(0xD6E8FEB86659FD93)
    h = np.zeros(len(first), np.uint64)
    for i in range(length):
        h = h * np.uint64(BASE) + suffix[:, i] + np.uint64(1)
    top, masks = np.uint64(pow(BASE, length - 1, 1 << 64)), np.zeros(len(first), np.uint64)
    for o in range(far_most + 1):
        if o:
            h = (h - suffix[:, length - o] - np.uint64(1)) * np.uint64(INVERSE) + (before[:, far_most - o] + np.uint64(1)) * top
        some = np.flatnonzero((near <= o) & (o <= far))
        if len(some):
            digest = _mixed(h[some] ^ group[some])
            by = np.argsort(digest, kind="stable")
            same = digest[by][1:] == digest[by][:-1]
            left, right = some[by[:-1][same]], some[by[1:][same]]
            if not _same_windows(left, right, suffix[:, : length - o], before[:, far_most - o :], group):  # two windows share a digest
                windows = np.concatenate([suffix[some, : length - o], before[some, far_most - o :], group[some, None].view(np.uint8)], 1)
                digest = _distinct(windows)[0]
                by = np.argsort(digest, kind="stable")
                same = digest[by][1:] == digest[by][:-1]
            masks[some[by[1:][same]]] |= np.uint64(1 << o)
    out = np.empty(len(first), np.uint64)
    out[first] = masks
    found: list[list[dict]] = [[] for _ in runs]
    if firsts:
        places = np.concatenate([np.cumsum(restored(x)) for x in frame["at"]]).astype(np.int64)
        signed = (marks ^ np.uint64(1 << 63)).view(np.int64)  # in the order of the unsigned ones
        run_of, own = np.repeat(np.arange(len(runs)), np.diff(begins)), column("own")
        for i in np.flatnonzero((rows[:, 0] == 1) & (out == 0)).tolist():
            values = (rows[i, 1 : 1 + length].tobytes(), int(ids[i]), int(signed[i]), int(own[i]), int(offsets[i]), int(places[i]))
            found[run_of[i]].append(dict(zip(("window", "key", "mark", "own", "offset", "at"), values, strict=True)))
    masks = [squeezed(out[a:b]) for a, b in zip(begins[:-1], begins[1:], strict=True)]
    return pd.DataFrame({"block": frame["block"], "part": frame["part"], "at": frame["at"], "masks": masks, "firsts": found})


def deduplicated(docs: DataFrame, length: int = 100, block_bytes: int = 4 << 20, part_blocks: int = 8, hot: int = 20_000, part_entries: int = 50_000, ranges: int = 4096, group_blocks: int = 4096, texts: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if texts is bytes or text, kept (a text loses broken characters) for each of docs
    (doc_id, text), and row, a struct of docs that is carried along, if there is one.

    Anchors that occur hot times or more are sorted window by window. A part merges about part_entries entries; the driver
    sees one entry in part_entries / 32 until these are 64 for each of the most ranges, then fewer of each run."""
    if not GRAM < length <= GRAM + 63:
        raise ValueError(f"length must be {GRAM + 1} to {GRAM + 63}")
    carried = "row" in docs.columns
    row = F.col("row") if carried else F.struct(F.lit(0).alias("none"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), row.alias("row"))
    made = written(blocks(rows, length, block_bytes))
    many = made.count()
    flags = repeated_hashes(made, max(6, -(-many // part_blocks)), hot)
    # a block has an anchor in about 27 bytes
    spacing = max(1, part_entries // 32, many * block_bytes // (27 * 64 * ranges))

    def sort(key: tuple, own: pd.DataFrame, flags: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, row in own.iterrows():
            told = [restored(x) for x in flags.sort_values("part")["flags"]]
            e = sorted_entries(row, np.concatenate([np.empty(0, np.uint64), *told]).astype(np.int64), length)
            string = np.ascontiguousarray(e["rows"][:, : length + 1])
            pack = zstandard.ZstdCompressor(level=4).compress
            lcp = shared_prefixes(string)
            tails = string[np.arange(length + 1) >= lcp[:, None]]
            picked = string[zlib.crc32(str(row["block"]).encode()) % spacing :: spacing]
            out.append({
                "block": row["block"], "entries": len(string), "shared": squeezed(lcp), "tails": pack(tails.tobytes()), "rest": pack(e["rows"][:, length + 1 :].tobytes()),
                **{c: squeezed(e[c]) for c in ("keys", "marks", "own", "offset", "at", "near", "far", "entry", "first", "of", "off", "window", "window_first")},
                "number": squeezed(e["number"] + 1), "sample": [x.tobytes() for x in picked],
            })
        release()
        return pd.DataFrame(out)

    kept = ["at", "near", "far", "entry", "first", "number", "of", "off", "window", "window_first"]
    schema = "block bigint, entries bigint, sample array<binary>, " + ", ".join(f"{c} binary" for c in ("shared", "tails", "rest", *PLACE, *kept))
    runs = written(made.select("block", "docs", "lengths", "bytes", "places", "near", "far").groupBy("block").cogroup(flags.groupBy("block")).applyInPandas(sort, schema))
    entries = runs.agg(F.sum("entries")).first()[0] or 0
    parts = max(12, -(-entries // part_entries))
    picked = [bytes(r[0]) for r in runs.select(F.explode("sample").alias("key")).collect()]
    picked = sorted({x[: 1 + GRAM] if x[0] == 0 else x for x in picked})
    many_ranges = min(parts, ranges)
    splitters = sorted({picked[len(picked) * i // many_ranges] for i in range(1, many_ranges)}) if picked else []
    deal, groups = -(-parts // many_ranges), -(-many // group_blocks)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ["part", "block", "at", "shared", "tails", "rest", *PLACE]
        pack, unpack = zstandard.ZstdCompressor(level=4).compress, zstandard.ZstdDecompressor().decompress
        for batch in chunks(batches, 1):
            row = {c: batch[c][0].as_py() for c in ("block", "shared", "tails", "rest", *PLACE)}
            lcp = restored(row["shared"]).astype(np.int64)
            if not len(lcp):
                continue
            rest, numbers = np.frombuffer(unpack(row["rest"]), np.uint8).reshape(len(lcp), -1), {c: restored(row[c]) for c in PLACE}
            own = np.zeros((len(lcp), length + 1), np.uint8)
            own[np.arange(length + 1) >= lcp[:, None]] = np.frombuffer(unpack(row["tails"]), np.uint8)
            for i in np.flatnonzero(lcp).tolist():
                own[i, : lcp[i]] = own[i - 1, : lcp[i]]
            flat, wide = own.tobytes(), length + 1
            strings = [flat[i : i + wide] for i in range(0, len(flat), wide)]
            edge = [0, *(bisect_left(strings, s) for s in splitters), len(strings)]
            part = np.repeat(np.arange(len(edge) - 1), np.diff(edge)) * deal
            if deal > 1:  # what shares an anchor gram, or a window of its own, stays together
                part += np.array([zlib.crc32(s[: 1 + GRAM] if s[0] == 0 else s) % deal for s in strings])
            part += (own[:, 0] == 1) * (zlib.crc32(str(row["block"]).encode()) % groups) * (len(edge) - 1) * deal
            order = np.argsort(part, kind="stable")
            for where, (a, b) in _runs(part[order]):
                at = order[a:b]
                own_lcp = lcp[at] if at[-1] - at[0] == len(at) - 1 else shared_prefixes(own[at])
                own_lcp[0] = 0
                tails = own[at][np.arange(length + 1) >= own_lcp[:, None]]
                values = [where, row["block"], squeezed(np.diff(at, prepend=0)), squeezed(own_lcp), pack(tails.tobytes()), pack(rest[at].tobytes()), *(squeezed(numbers[c][at]) for c in PLACE)]
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in values], columns)

    exchanged = runs.select("block", "shared", "tails", "rest", *PLACE).mapInArrow(cut, "part bigint, block bigint, " + ", ".join(f"{c} binary" for c in ("at", "shared", "tails", "rest", *PLACE)))
    settled = by_parts(exchanged, many_ranges * deal * groups).applyInPandas(lambda frame: settle(frame.sort_values("block"), length, groups > 1), f"block bigint, part bigint, at binary, masks binary, firsts {FIRSTS}")
    settled = written(settled) if groups > 1 else settled
    answers = settled.groupBy("block").agg(F.collect_list(F.struct("at", "masks")).alias("answers"))
    told = runs.select("block", *kept).join(answers, "block", "left").withColumn("late", F.expr("cast(array() as array<bigint>)"))
    if groups > 1:
        each = settled.select("block", F.explode("firsts").alias("f")).select("block", "f.window", "f.at", F.struct("f.key", "f.mark", "block", "f.own", "f.offset").alias("place"))
        best = each.groupBy("window").agg(F.min("place").alias("best"))
        late = each.join(best, "window").where("place <> best").groupBy("block").agg(F.collect_list("at").alias("again"))
        told = told.join(late, "block", "left").withColumn("late", F.coalesce("again", "late")).drop("again")
    whole = T.StructType([T.StructField(n, k) for n, k in (("doc_id", T.LongType()), ("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()), ("kept_sha256", T.StringType()))])
    if texts:
        whole = whole.add("kept", T.StringType() if texts == "text" else T.BinaryType())
    if carried:
        whole = whole.add(docs.schema["row"])

    def remove(own: pa.Table, told: pa.Table) -> pa.Table:
        out = []
        for row, e in zip(own.to_pylist(), told.to_pylist(), strict=True):
            text = Text(row)
            answers = [(np.cumsum(restored(x["at"])).astype(np.int64), restored(x["masks"])) for x in e["answers"] or []]
            masks = np.zeros(sum(len(at) for at, _ in answers), np.uint64)
            for at, own_masks in answers:
                masks[at] = own_masks
            masks[np.asarray(e["late"], np.int64)] |= np.uint64(1)
            e = {c: restored(e[c]).astype(np.int64) for c in kept}
            gone = np.zeros(len(text.data) + 1, bool)
            number = e["number"][e["entry"]] - 1 if len(e["entry"]) else e["entry"]
            first, spread = e["first"] == 1, (number < 0) if len(number) else np.empty(0, bool)
            full = np.uint64(0xFFFFFFFFFFFFFFFF)
            mask = np.where(first & ~spread, masks[np.maximum(number, 0)] if len(masks) else np.uint64(0), np.where(first, np.uint64(0), full))
            for o in range(length - GRAM + 1):
                hit = (mask >> np.uint64(o) & np.uint64(1) == 1) & (e["near"] <= o) & (o <= e["far"])
                gone[e["at"][hit] - o] = True
            if len(e["of"]):
                source = np.full(int(e["entry"].max()) + 1, -1)
                source[e["entry"][first]] = e["at"][first]
                again = (e["window_first"] == 0) | (masks[e["window"]] & np.uint64(1) == 1)
                gone[(source[e["of"]] - e["off"])[again]] = True
            seen = np.concatenate([[0], np.cumsum(gone[:-1], dtype=np.int32)])
            covered = seen[1:] > seen[np.maximum(np.arange(1, len(seen)) - length, 0)]
            columns = {f.name: [] for f in whole}
            for key, a, n in zip(row["docs"], text.begins.tolist(), text.lengths.tolist(), strict=True):
                here = covered[a : a + n]
                removed = int(here.sum())
                left = text.raw[a : a + n] if not removed else text.data[a : a + n][~here].tobytes()
                spans = int(here[:1].sum()) + int((here[1:] & ~here[:-1]).sum()) if removed else 0
                for name, value in zip(columns, (key, n, removed, spans, hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore") if texts == "text" else left), strict=False):
                    if name != "row":
                        columns[name].append(value)
            types = {"kept_sha256": pa.string(), "kept": pa.string() if texts == "text" else pa.binary()}
            made = {n: pa.array(v, types.get(n, pa.int64())) for n, v in columns.items() if n != "row"}
            if carried:
                made["row"] = pa.ipc.open_stream(row["rest"]).read_all()["row"]
            out.append(pa.table(made))
        release()
        return pa.concat_tables(out)

    base = made.select("block", "docs", "lengths", "bytes", *["rest"] * carried).groupBy("block")
    return base.cogroup(told.groupBy("block")).applyInArrow(remove, whole)


def without_repeats(docs: DataFrame, **options: object) -> DataFrame:
    """docs with texts that lack what repeats; n_chars follows the text; all columns and rows stay. A null text that lacks
    nothing becomes an empty one.

    Characters that lose some of their bytes go altogether."""
    rest = [c for c in docs.columns if c != "text"]
    given = docs.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in rest]).alias("row"))
    out = deduplicated(given, texts="text", **options).select("row", F.col("kept").alias("now"), "n_removed")
    count = F.when(F.col("n_removed") == 0, F.col("row.n_chars")).otherwise(F.length("now")) if "n_chars" in rest else None
    made = {"text": F.col("now"), "n_chars": count}
    return out.select(*[made.get(c, F.col(f"row.`{c}`") if c not in made else None).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")

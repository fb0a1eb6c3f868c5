"""Best-fit packing of token sequences: partitions pack best-fit, and underfull bins are packed again as items.

A document is its token ids and id 0. One longer than a sequence is cut into full pieces, the first of which may be
shorter. Each task packs its pieces by best fit in decreasing order and keeps nearly full bins as sequences. What is
left over goes through a tree of rounds in which bins are items, in tasks of bounded size, until one task has seen all
or a round gains less than a hundredth. A bin's items stay together, so a later round only moves the bin as a whole.

Defined results: a null or empty text is one piece of length 1; rows that repeat are packed one by one; a null doc_id
stays null; an empty table gives an empty one; other columns play no part.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deltaloom.llm.common import chunks, ship, table, written

END = 0
#: Below this code point both tokenizer libraries class characters alike; texts with others, or with the special
#: token's string, go to the slower one, whose ids are the definition.
PLAIN = re.compile("[^\x00-ɏ]|<\\|endoftext\\|>")


@lru_cache(maxsize=2)
def tokenizer(json_path: str | None = None, ranks_path: str | None = None):
    """A function from text to ids: those of the tokenizers library for the file, computed by the rank file of the same
    vocabulary where the two can't differ."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(json_path or public_tokenizers.path("byte_bpe_50k.json"))
    with open(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if PLAIN.search(text):
            return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.asarray(fast.encode_to_numpy(text, disallowed_special=()), np.uint32)

    return encode


def cut(length: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: the first takes what full pieces leave."""
    first = length % most or most
    return [(0, min(first, length)), *((at, most) for at in range(first, length, most))]


class Bins:
    """Best fit over residuals: a bit for each residual that some open bin has gives the tightest bin in a few steps."""

    def __init__(self, most: int) -> None:
        self.open: list[list[int]] = [[] for _ in range(most + 1)]
        self.bits, self.most, self.fill = 0, most, []

    def put(self, size: int) -> tuple[int, int]:
        """The bin and the offset for an item."""
        fit = self.bits >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            own = self.open[room].pop()
            if not self.open[room]:
                self.bits ^= 1 << room
        else:
            own, room = len(self.fill), self.most
            self.fill.append(0)
        left = room - size
        if left:
            self.open[left].append(own)
            self.bits |= 1 << left
        self.fill[own] = self.most - left
        return own, self.most - room


def best_fit(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bin and the offset of each item, and the bins' fills, by best fit in decreasing order."""
    bins, own, at = Bins(most), np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    for i in np.argsort(-sizes, kind="stable").tolist():
        own[i], at[i] = bins.put(int(sizes[i]))
    return own, at, np.array(bins.fill, np.int64)


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, bin bigint, at bigint, fill bigint"


def pieces(docs: DataFrame, most: int, flush: int = 200_000, json_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """The pieces of docs (doc_id, text), packed within each task; at most flush pieces are held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = tokenizer(json_path, ranks_path), TaskContext.get().partitionId()
        held: list[tuple] = []
        count = 0

        def packed() -> pa.RecordBatch:
            nonlocal held, count
            columns = list(zip(*held, strict=True)) or [()] * 5
            own, at, fill = best_fit(np.array(columns[3], np.int64), most)
            data = [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[2:])]
            data += [pa.array((part << 32) + count + own), pa.array(at), pa.array(fill[own])]
            held, count = [], count + len(fill)
            return pa.RecordBatch.from_arrays(data, [c.split()[0] for c in PIECES.split(", ")])

        for batch in chunks(batches):
            for key, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                ids = np.append(encode(text or ""), np.uint32(END)).astype("<u4")
                held += [(key, k, at, n, zlib.crc32(ids[at : at + n].tobytes())) for k, (at, n) in enumerate(cut(len(ids), most))]
            if len(held) >= flush:
                yield packed()
        if held:
            yield packed()

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)


def pack(docs: DataFrame, most: int = 2048, nearly: int = 2040, per_task: int = 200_000, **tokens: object) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece of docs.

    Bins filled to nearly or more are sequences as they are. per_task bounds the bins that one task of a round packs."""
    placed = written(pieces(docs, most, **tokens))
    moves = written(placed.where(F.col("fill") < nearly).groupBy("bin").agg(F.first("fill").alias("fill")).select("bin", F.col("bin").alias("to"), F.lit(0).cast("long").alias("shift"), "fill"))

    def again(salt: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, count, held = TaskContext.get().partitionId(), 0, []
            for batch in _then_end(batches):
                if batch is not None:
                    held.append(pa.Table.from_batches([batch]))
                if held and (batch is None or sum(x.num_rows for x in held) >= per_task):
                    items = pa.concat_tables(held)
                    own, at, fill = best_fit(np.asarray(items["fill"]), most)
                    to = (salt << 56) + (part << 32) + count + own
                    held, count = [], count + len(fill)
                    yield from pa.table({"item": items["to"], "to": to, "shift": at, "fill": fill[own]}).to_batches()

        return run

    left, salt = moves.count(), 0
    while left > 1 and salt < 126:
        salt, parts = salt + 1, -(-left // per_task)
        items = moves.where(F.col("fill") < nearly).groupBy("to").agg(F.first("fill").alias("fill"))
        items = items.coalesce(1) if parts == 1 else items.repartition(parts)
        step = written(items.mapInArrow(again(salt), "item bigint, to bigint, shift bigint, fill bigint"))
        moved = moves.withColumnRenamed("to", "item").alias("m").join(step.alias("s"), "item", "left")
        moves = written(
            moved.select(
                "bin", F.coalesce("s.to", "item").alias("to"), (F.col("m.shift") + F.coalesce("s.shift", F.lit(0))).alias("shift"), F.coalesce("s.fill", "m.fill").alias("fill")
            )
        )
        now = moves.where(F.col("fill") < nearly).select("to").distinct().count()
        if parts == 1 or now > 0.99 * left:
            break
        left = now
    return placed.join(moves.select("bin", "to", "shift"), "bin", "left").select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("to", "bin").alias("sequence_id"), (F.col("at") + F.coalesce("shift", F.lit(0))).alias("offset")
    )


def _then_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))

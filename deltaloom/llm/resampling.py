"""Importance resampling towards a target: documents drawn by how much likelier the target's hashed n-grams are in them.

Each task keeps a trie of words. A node stands for a run of consecutive words; it holds how often the run came and the
CRC-32 state of its bytes, from which its children's states go on without reading the parent's bytes again. Counts of
nodes fall into buckets by their state, and only bucket totals leave a task. Documents are then scored by tries of the
same kind whose nodes carry the gains of their buckets: a document walks its paths and adds up what it meets.

The draw is Gumbel top-k: a score has the document's own seeded noise added, and a histogram of integer scores, which are
few whatever the number of documents, gives the last score drawn and the first rank of each score.

Defined results: null and empty texts have no words, no features and weight 0; documents without an id are drawn like
others, with the noise of an empty id, and come last in ties; rows that repeat an id are scored and drawn each, and where
id and score tie, the one of fewer features, then of lower weight, comes first; without documents or a target gains are those of the counts that are
there (0 and all 0s give a uniform target); an empty table gives an empty one; other columns play no part.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deltaloom.llm.common import chunks, release, ship, starts_of, table, written

#: Bytes as they are split into words: A-Z lower-cased, digits, letters and what isn't ASCII kept, the rest spaces.
FOLDED = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Bytes of text that are split at once, and nodes of a trie before its counts are handed over.
SLICE, NODES = 1 << 20, 1_000_000
#: Edges of at most so many bytes carry states over by table, longer ones byte by byte.
TABLED = 64


class Edges(dict):
    """Numbers of words, in the order of their first coming; edges are the words after a space."""

    def __init__(self) -> None:
        super().__init__()
        self.edges: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.edges)
        self.edges.append(b" " + word)
        return number


@functools.cache
def carry_table(length: int) -> np.ndarray:
    """For each byte of a CRC-32 state what it becomes over so many bytes, to be met with the CRC of those bytes by
    exclusive or: the register is linear, so zero bytes tell."""
    blank = bytes(length)
    none = zlib.crc32(blank)
    return np.array([[zlib.crc32(blank, b << 8 * k) ^ none for b in range(256)] for k in range(4)], np.uint32)


def carried_on(states: np.ndarray, crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The states after bytes of these CRCs and lengths (TABLED at most) have followed."""
    known, place = np.unique(lengths, return_inverse=True)
    tables = np.stack([carry_table(n) for n in known.tolist()]).reshape(-1)
    out, base = crcs.copy(), place * 1024
    for k in range(4):
        out ^= tables[base + 256 * k + ((states >> np.uint32(8 * k)) & np.uint32(255))]
    return out


class Trie:
    """Runs of up to depth words. Level d has its nodes sorted by key, which is the parent's number (by age, in level d-1)
    and the last word's; level 1's keys are words. number, count and state are arrays along the keys, by_age the states
    along the numbers."""

    def __init__(self, depth: int) -> None:
        self.depth = depth
        self.clear()

    def clear(self) -> None:
        self.words = Edges()
        self.crc, self.length = np.empty(0, np.uint32), np.empty(0, np.int64)
        self.keys, self.number, self.count, self.state, self.by_age = (
            [np.empty(0, kind) for _ in range(self.depth)] for kind in (np.int64, np.int64, np.int64, np.uint32, np.uint32)
        )

    def __len__(self) -> int:
        return sum(map(len, self.keys))

    def _states(self, d: int, keys: np.ndarray) -> np.ndarray:
        """The states of new nodes at level d: a node's goes on from its parent's over the edge's bytes."""
        if d == 0:
            fresh = self.words.edges[len(self.crc) :]
            self.crc = np.concatenate([self.crc, np.fromiter(map(zlib.crc32, fresh), np.uint32, len(fresh))])
            self.length = np.concatenate([self.length, np.fromiter(map(len, fresh), np.int64, len(fresh))])
            return np.fromiter((zlib.crc32(e[1:]) for e in fresh), np.uint32, len(fresh))
        word, parent = keys & 0xFFFFFFFF, self.by_age[d - 1][keys >> 32]
        short = self.length[word] <= TABLED
        out = np.empty(len(keys), np.uint32)
        if short.any():
            out[short] = carried_on(parent[short], self.crc[word[short]], self.length[word[short]])
        for i in np.flatnonzero(~short).tolist():
            out[i] = zlib.crc32(self.words.edges[word[i]], int(parent[i]))
        return out

    def _grow(self, d: int, keys: np.ndarray) -> None:
        states, place = self._states(d, keys), np.searchsorted(self.keys[d], keys)
        numbers = np.arange(len(self.by_age[d]), len(self.by_age[d]) + len(keys))
        for every, own in ((self.keys, keys), (self.number, numbers), (self.count, np.zeros(len(keys), np.int64)), (self.state, states)):
            every[d] = np.insert(every[d], place, own)
        self.by_age[d] = np.concatenate([self.by_age[d], states])

    def walk(self, words: np.ndarray, begins: np.ndarray, ends: np.ndarray, carried: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Walks from each word of some segments (begins, ends; the first carried words of one were walked before), and
        counts. For each level: the places of words where runs begin that end in new words, the index of each run's
        node among those met, and these nodes' states."""
        segment = np.repeat(np.arange(len(begins)), ends - begins)
        end, fresh = ends[segment], (begins + carried)[segment]
        at, node = np.arange(len(words)), None
        for d in range(self.depth):
            inside = at + d < end[at]
            at = at[inside]
            keys = words[at] if d == 0 else (node[inside] << 32) | words[at + d]
            met, which = np.unique(keys, return_inverse=True)
            spot = np.searchsorted(self.keys[d], met)
            new = np.ones(len(met), bool) if not len(self.keys[d]) else self.keys[d][np.minimum(spot, len(self.keys[d]) - 1)] != met
            if new.any():
                self._grow(d, met[new])
                spot = np.searchsorted(self.keys[d], met)
            ending = at + d >= fresh[at]
            if not ending.all():
                self.count[d][spot] += np.bincount(which[ending], minlength=len(met))
                yield at[ending], which[ending], self.state[d][spot]
            else:
                self.count[d][spot] += np.bincount(which, minlength=len(met))
                yield at, which, self.state[d][spot]
            node = self.number[d][spot][which]

    def totals(self, buckets: int) -> np.ndarray:
        """How often runs of each bucket came."""
        out = np.zeros(buckets, np.int64)
        for state, count in zip(self.state, self.count, strict=True):
            np.add.at(out, state % np.uint32(buckets), count)
        return out


def segments(texts: list[bytes | None], depth: int) -> Iterator[tuple[list[int], list[bytes], list[int], list[int]]]:
    """Lots of about SLICE bytes: segments' texts, words of all, segments' words, and how many of these were in the lot
    before. A long text is cut between words, and its next segment begins with the last words of the one before, which
    runs still need."""
    places, words, lengths, carried, size = [], [], [], [], 0
    for i, text in enumerate(texts):
        text = (text or b"").translate(FOLDED)
        at, tail = 0, []
        while at < len(text):
            to = len(text)
            if to - at > SLICE:
                cut = text.rfind(b" ", at, at + SLICE)
                cut = text.find(b" ", at + SLICE) if cut <= at else cut
                to = to if cut < 0 else cut
            own = tail + text[at:to].split()
            places.append(i)
            words += own
            lengths.append(len(own))
            carried.append(len(tail))
            tail, size, at = own[-(depth - 1) :] if depth > 1 else [], size + to - at, max(to, at + 1)
            if size >= SLICE:
                yield places, words, lengths, carried
                places, words, lengths, carried, size = [], [], [], [], 0
    if places:
        yield places, words, lengths, carried


def steps(trie: Trie, texts: list[bytes | None], full: Callable[[Trie], object] = lambda trie: None) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Walks texts: (level, texts' places of the runs, index of each run's node, nodes' states). A trie of more than NODES
    nodes is handed to full and begun anew."""
    for places, words, lengths, carried in segments(texts, trie.depth):
        bounds = starts_of(np.array(lengths))
        numbers = np.array(list(map(trie.words.__getitem__, words)), np.int64)
        owner = np.repeat(np.array(places), lengths)
        for d, (at, which, states) in enumerate(trie.walk(numbers, bounds[:-1], bounds[1:], np.array(carried))):
            yield d, owner[at], which, states
        if len(trie) > NODES:
            full(trie)
            trie.clear()


def bucket_totals(texts: DataFrame, depth: int, buckets: int) -> DataFrame:
    """(bucket, n): how many features of the column text fall into each bucket. A task hands over at most one row for each
    bucket whenever its trie is full."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, total = Trie(depth), np.zeros(buckets, np.int64)
        for batch in chunks(batches):
            for _ in steps(trie, batch["text"].cast(pa.binary()).to_pylist(), lambda t: np.add(total, t.totals(buckets), out=total)):
                pass
        total += trie.totals(buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    ship(texts.sparkSession)
    return texts.select("text").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains_of(texts: DataFrame, target: DataFrame, depth: int, buckets: int) -> np.ndarray:
    """For each bucket floor(1000 * ln of how much likelier it is in the target), counts smoothed by one."""
    counts = []
    for rows in (texts, target):
        one = np.zeros(buckets, np.int64)
        for bucket, n in bucket_totals(rows, depth, buckets).collect():  # buckets rows at most
            one[bucket] = n
        counts.append(one)
    (raw, aim), (s, t) = counts, (float(c.sum() + buckets) for c in counts)
    return np.array([math.floor(1000 * math.log((b + 1.0) * s / ((a + 1.0) * t))) for a, b in zip(raw.tolist(), aim.tolist(), strict=True)], np.int64)


def weighed(docs: DataFrame, gains: np.ndarray, depth: int) -> DataFrame:
    """doc_id, n_words, n_features and weight, the floored mean gain of a document's features (0 without any)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(depth)
        for batch in chunks(batches):
            words, features, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for d, owner, which, states in steps(trie, batch["text"].cast(pa.binary()).to_pylist()):
                own = gains[states % np.uint32(len(gains))]  # the gains at the nodes that are walked
                n = np.bincount(owner, minlength=batch.num_rows)
                features += n
                words += n if d == 0 else 0
                total += np.bincount(owner, own[which], batch.num_rows).astype(np.int64)  # sums far below 2^53: exact
            weight = np.where(features > 0, total // np.maximum(features, 1), 0)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *map(pa.array, (words, features, weight))], ["doc_id", "n_words", "n_features", "weight"])
        release()

    ship(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def gumbel(seed: int, key: Column) -> Column:
    """floor(1000 * Gumbel noise) by 32 bits of a hash of seed and key."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def ranked(rows: DataFrame, good: Column, share: tuple[int, int]) -> DataFrame:
    """rows (doc_id, score and others) and rank: of the rows that are good the share of highest scores, 1, 2 and so on.

    Scores are integers of a bounded range, so their histogram is small. It tells which scores are drawn and how many rows
    come before each; a score's own rows are ordered in one task, of which noise leaves few to a score."""
    counts = rows.where(good).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    most = rows.where(good).count() * share[0] // share[1]
    highest = Window.orderBy(F.desc("score"))  # one row for each distinct score
    before = counts.select("score", (F.sum("n").over(highest) - F.col("n")).alias("before_")).where(F.col("before_") < most)
    least = before.agg(F.min("score")).first()[0]
    out = good & (F.col("score") >= least) if least is not None else F.lit(False)
    place = F.col("before_") + F.row_number().over(Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features", "weight"))
    drawn = rows.where(out).join(before, "score").withColumn("rank", F.when(place <= most, place)).drop("before_")
    # what lies below the last score drawn isn't shuffled at all
    return drawn.unionByName(rows.where(~out).withColumn("rank", F.lit(None).cast("bigint")))


def resampled(docs: DataFrame, target: DataFrame, depth: int = 2, buckets: int = 10_000, seed: int = 7, least_words: int = 20, share: tuple[int, int] = (25, 100)) -> DataFrame:
    """doc_id, n_features, weight, score and rank for docs (doc_id, text), drawn towards the texts of target (text)."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    gains = gains_of(docs, target.select(F.col("text").cast("string").alias("text")), depth, buckets)
    rows = written(weighed(docs, gains, depth)).withColumn("score", F.col("weight") + gumbel(seed, F.col("doc_id")))
    return ranked(rows, F.col("n_words") >= least_words, share).select("doc_id", "n_features", "weight", "score", "rank")


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

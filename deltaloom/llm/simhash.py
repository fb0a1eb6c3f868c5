"""SimHash near-duplicates, linked within a Hamming distance that a pigeonring filter checks candidates for.

The 64 bits are cut into segments on a ring. If two fingerprints differ in at most t bits, there is a segment from which
each chain of l consecutive segments differs in at most floor(l t / m) bits. Fingerprints meet only in buckets that
fix what the first budgets allow: if the first budget is 0 and the second 1, a whole segment and the next with one bit
masked; if the first budget is 1, a segment with one bit masked. Pairs in a bucket must keep the budget of each longer
chain, and the last chain, the whole ring, is the full Hamming check.

Fingerprints are compared once each, however many documents carry one. A bucket yields links that connect exactly what
its pairs connect, not its pairs: a leader takes all it links to, and only what the largest such group lacks is
compared with everything. So a large ball of near copies costs a bucket no more than its size times its outliers.

The pipeline's stage links texts whose sets of distinct shingles have a similarity (common over all) of 4/5 or more,
decided on the sets themselves. Sets of n and m shingles are that similar if and only if they differ in at most t = (n + m) / 9
shingles, a Hamming distance of sets, and the pigeonring filter finds them: its segments are classes of shingles by hash, cut
by size so that a ring has over t of them. Then there is a segment, among the first t + 1, from which each chain of l segments
differs in at most l - 1 shingles. Sets meet in buckets that fix what a chain has in common, each set with all it may lack there
(nothing in the first segment, one shingle in the first two, ...): a chain is a segment if that holds a shingle which is rare in
a sample, and otherwise goes on until a segment after the first leaves something in common. The sample only moves work, as both
sets decide by what they share. No pair of 4/5 or more misses its bucket.

In a bucket pairs must have sizes that allow 4/5 and, unless they are small (TELLING), 128-bit SimHash fingerprints of the sets
within HEAD_BITS (about 19 at 4/5, so 6 standard deviations: of larger sets a share of 6e-8 at 4/5 is lost here), of the first 64
bits within FIRST_BITS. What is left must have parities within t: 512 bits, each
the parity of the shingles that fall on it, differ in no more places than the sets do. Last come the sets. Pairs of short buckets
are listed. Rows of a crowded one, most of which are near none of some leaders (unrelated texts that share a shingle), go on to
the buckets of longer chains: their segment and the next, which may differ in one shingle. Of other long ones the rows stay that are near another by their fingerprints, and pairs of rows and a few leaders are listed:
what these link has one label before the rows get their parities, and labels keep a large group from yielding its pairs. What is
near with different labels then is listed where a bucket has few such pairs; the rows of other buckets go through more rounds of
leaders, after which every pair of different labels is checked, so nothing rests on the leaders.

Defined results: a null or empty text has fingerprint zero and is linked like any other (in the stage to its like only); rows with equal ids each have
their own fingerprint, and ids don't link; a null id is never the smallest unless its component has no other; an empty
table gives an empty one; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom.llm.common import WORD_BYTES, chunks, lower_ascii, release, ship, starts_of, table, utf8, written
from deltaloom.llm.graph import components

SEED = 42
#: The most bits that two sets of similarity 4/5 are taken to differ in, of the first 64 and of all 128, where the sets have
#: together at least so many shingles that these bits tell; smaller ones are told by their parities and themselves.
FIRST_BITS, HEAD_BITS, TELLING = 27, 44, 64
#: Bits of a set's parities, and the columns of a set that pairs are compared by.
PARITY_BITS = 512
SIGNS = ("h0", "h1", *(f"o{i}" for i in range(PARITY_BITS // 64)))
#: Rows of longer buckets are linked to leaders before all pairs are compared, in so many rounds at most.
LONG_BUCKET, ROUNDS = 32, 3
#: Long buckets that have up to so many pairs a row yield them; a pair that meets in many of these is then one row.
LISTED = 4
#: Rows of buckets that a task sorts, about.
SORTED = 400_000
#: A bucket of which over CROWD rows are near none of LEADERS leaders is crowded: its rows meet in longer chains instead.
CROWD, LEADERS = 2048, 64
#: Kinds of what meets: pairs, rows of long buckets, rows of crowded ones.
PAIR, LONG, CROWDED = 0, 1, 2
#: Distinct sets that are looked at for common shingles, and in how many of them a shingle is common.
SAMPLE, COMMON = 16_384, 3
#: Bits of the map that tells which sets may be candidates, and of a slot that hold the set's size.
MAP_BITS, SIZE_BITS = 22, 24
#: Runs up to this length are compared by shifting columns, longer ones by leaders.
SHORT_RUN = 64


def shingle_hashes(text: object, words: int) -> np.ndarray:
    """XXH64 of each shingle of so many words, of the whole text if it has fewer."""
    found = WORD_BYTES.findall(lower_ascii(utf8(text)))
    if len(found) <= words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(found), SEED)] if found else [], np.uint64)
    joined, at = b" ".join(found), starts_of(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(at[:-words].tolist(), (at[words:] - 1).tolist(), strict=True)], np.uint64)


def majority(values: np.ndarray) -> np.ndarray:
    """The bits set in over half the rows of values (n, words), as words."""
    ones, rows = np.zeros(64 * values.shape[1], np.int64), values.view(np.uint8).reshape(len(values), 8 * values.shape[1])
    for at in range(0, len(rows), 255):  # so many bits fit a byte
        ones += np.add.reduce(np.unpackbits(rows[at : at + 255], axis=1, bitorder="little"), axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > len(values), bitorder="little").view("<u8")


def fingerprint(text: object, words: int) -> int:
    """The fingerprint of a text over its shingles of so many words, as an unsigned integer."""
    return int(majority(shingle_hashes(text, words)[:, None])[0])


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """docs (text and others) with fp, the fingerprint in a signed long, and without text."""
    ship(docs.sparkSession)
    at = docs.columns.index("text")
    schema = T.StructType([*(f for f in docs.schema if f.name != "text"), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            texts = batch.column(at).to_pylist()
            found = pa.array(np.fromiter((fingerprint(t, words) for t in texts), np.uint64, batch.num_rows).view(np.int64))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns) if i != at), found], schema.names)

    return docs.mapInArrow(run, schema)


class Ring:
    """How 64 bits are cut, and the budgets of chains, for pairs that differ in at most bits."""

    def __init__(self, bits: int, segments: int) -> None:
        self.bits, self.segments = bits, segments
        self.widths = [64 // segments + (i < 64 % segments) for i in range(segments)]
        self.offsets = np.cumsum([0, *self.widths]).tolist()
        self.budgets = [(k + 1) * bits // segments for k in range(segments)]
        if not (self.budgets[0] == 1 or self.budgets[0] == 0 and self.budgets[1] == 1):
            raise ValueError(f"{segments} segments don't suit {bits} bits: the first budgets are {self.budgets[:2]}")

    def part(self, values: np.ndarray, i: int) -> np.ndarray:
        return (values >> np.uint64(self.offsets[i])) & np.uint64((1 << self.widths[i]) - 1)

    def keys(self, values: np.ndarray) -> np.ndarray:
        """The buckets of each value, a row each; a bucket's start is in its highest bits."""
        out = []
        for i in range(self.segments):
            first, j = self.part(values, i), (i + 1) % self.segments
            if self.budgets[0]:
                fixed, masked, width = np.uint64(0), first, self.widths[i]
            else:
                fixed, masked, width = first << np.uint64(24), self.part(values, j), self.widths[j]
            out += [np.uint64(i << 56 | p << 50) | fixed | masked & ~np.uint64(1 << p) for p in range(width)]
        return np.stack(out, 1)

    def linked(self, x: np.ndarray, y: np.ndarray | np.uint64, start: np.ndarray | int) -> np.ndarray:
        """Whether each pair keeps the budget of each chain from its start; the last one is the Hamming check."""
        differ = x ^ y
        good, masks = np.ones(differ.shape, bool), self.masks[start]
        for k, budget in enumerate(self.budgets):
            good &= np.bitwise_count(differ & masks[..., k]) <= budget
        return good

    @property
    def masks(self) -> np.ndarray:
        if not hasattr(self, "_masks"):
            own = [((1 << w) - 1) << o for w, o in zip(self.widths, self.offsets, strict=False)]
            chain = [[sum(own[(i + k) % self.segments] for k in range(n + 1)) for n in range(self.segments)] for i in range(self.segments)]
            self._masks = np.array(chain, np.uint64)
        return self._masks


def joined(values: np.ndarray, ring: Ring, start: int) -> list[tuple[int, int]]:
    """Pairs of indices that connect the distinct values of a bucket exactly as all its linked pairs do."""
    rest, groups, links = np.arange(len(values)), [], []
    while len(rest):
        hit = ring.linked(values[rest], values[rest[0]], start)
        links += [(int(rest[0]), int(i)) for i in rest[hit][1:]]
        groups.append(rest[hit])
        rest = rest[~hit]
    largest = max(range(len(groups)), key=lambda k: len(groups[k]))
    group = np.empty(len(values), np.int64)
    for k, members in enumerate(groups):
        group[members] = k
    root = list(range(len(groups)))

    def top(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for k, members in enumerate(groups):
        if k != largest:
            for i in members.tolist():
                near = np.flatnonzero(ring.linked(values, values[i], start))
                for other, j in zip(*(x.tolist() for x in np.unique(group[near], return_index=True)), strict=True):
                    if top(other) != top(k):
                        root[top(other)] = top(k)
                        links.append((i, int(near[j])))
    return links


def bucket_links(keys: np.ndarray, values: np.ndarray, ring: Ring) -> tuple[np.ndarray, np.ndarray]:
    """Links of whole buckets: keys are sorted, and values distinct within a key."""
    edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    size = np.diff(edge)
    a, b = [], []
    short = np.repeat(size <= SHORT_RUN, size)
    for shift in range(1, min(int(size.max(initial=1)), SHORT_RUN)):
        at = np.flatnonzero((keys[shift:] == keys[:-shift]) & short[shift:])
        if len(at):
            at = at[ring.linked(values[at], values[at + shift], (keys[at] >> np.uint64(56)).astype(np.int64))]
            a.append(values[at])
            b.append(values[at + shift])
    for k in np.flatnonzero(size > SHORT_RUN).tolist():
        own = values[edge[k] : edge[k + 1]]
        pairs = np.array(joined(own, ring, int(keys[edge[k]] >> np.uint64(56))), np.int64).reshape(-1, 2)
        a.append(own[pairs[:, 0]])
        b.append(own[pairs[:, 1]])
    none = np.empty(0, np.uint64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def forest(pairs: np.ndarray) -> np.ndarray:
    """Of pairs of values those that join what the ones before don't."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = root[x]
        return x

    keep = np.zeros(len(pairs), bool)
    for i, (a, b) in enumerate(pairs.tolist()):
        x, y = top(a), top(b)
        if x != y:
            root[y] = x
            keep[i] = True
    return pairs[keep]


def links(distinct: DataFrame, bits: int, segments: int) -> DataFrame:
    """Links (a, b) among distinct fingerprints (fp) that connect all pairs at most bits apart, and no others."""
    ring = Ring(bits, segments)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 4096):
            own = np.asarray(batch["fp"]).view(np.uint64)
            keys = ring.keys(own)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(own, keys.shape[1]).view(np.int64))], ["key", "fp"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = np.empty(0, np.uint64), np.empty(0, np.uint64)
        for batch in _with_end(batches):
            if batch is not None:
                keys = np.concatenate([keys, np.asarray(batch["key"]).view(np.uint64)])
                values = np.concatenate([values, np.asarray(batch["fp"]).view(np.uint64)])
            cut = len(keys) if batch is None else int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            if cut:
                a, b = bucket_links(keys[:cut], values[:cut], ring)
                keys, values = keys[cut:], values[cut:]
                if len(a):
                    pairs = forest(np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0))
                    yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy().view(np.int64)), pa.array(pairs[:, 1].copy().view(np.int64))], ["a", "b"])

    ship(distinct.sparkSession)
    spread_out = distinct.select("fp").mapInArrow(spread, "key bigint, fp bigint")
    return spread_out.repartition("key").sortWithinPartitions("key").mapInArrow(meet, "a bigint, b bigint")


def _with_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def near_duplicates(docs: DataFrame, words: int = 3, bits: int = 2, segments: int = 3) -> DataFrame:
    """docs (key, text and others) with fp and component, the smallest key reachable, and without text. key is any type
    with an order."""
    marked = written(fingerprints(docs, words))
    distinct = written(marked.groupBy("fp").agg(F.min("key").alias("key")))
    labels = components(links(distinct, bits, segments))
    rooted = distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("label", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("key").alias("component"))
    owned = rooted.join(smallest, "root").select("fp", "component")
    return marked.join(owned, "fp")


def shingle_set(text: object, words: int) -> np.ndarray:
    """The distinct shingle hashes of a text, sorted."""
    return np.unique(shingle_hashes(text, words))


def set_id(own: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(own.tobytes(), SEED)


def mixed(values: np.ndarray) -> np.ndarray:
    m = (values ^ np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    m = (m ^ m >> np.uint64(29)) * np.uint64(0x94D049BB133111EB)
    return m ^ m >> np.uint64(32)


def head_of(own: np.ndarray) -> np.ndarray:
    """128 bits of a set, from its hashes and a mix of them."""
    return majority(np.stack([own, mixed(own)], 1))


def parities(own: np.ndarray) -> np.ndarray:
    """PARITY_BITS bits of a set: a shingle that only one of two sets has flips one of them."""
    ones = np.bincount((mixed(~own) % np.uint64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS)
    return np.packbits((ones & 1).astype(np.uint8), bitorder="little").view("<u8")


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets have a similarity of 4/5 or more."""
    if not len(x) or not len(y):
        return len(x) == len(y)
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    return 9 * int((y[at] == x).sum()) >= 4 * (len(x) + len(y))


def rare_ones(own: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Which shingles of a set aren't among the common ones (sorted)."""
    if not len(common):
        return np.ones(len(own), bool)
    return common[np.minimum(np.searchsorted(common, own), len(common) - 1)] != own


def rings(size: int) -> list[tuple[int, int]]:
    """For each ring that a set of this size is on, its segments and from how many of them chains start.

    A pair is on the ring of the larger set: tops are 1, 3, 7, 15, ..., and a set of n can be the smaller one up to 5n/4.
    A ring has over 2 * top / 9 segments, and a set of n differs from others there in at most n / 4 and (n + top) / 9."""
    top, out = (1 << size.bit_length()) - 1, []
    while True:
        out.append((top // 4 + 1, min(size // 4, (size + top) // 9) + 1))
        if 5 * size // 4 <= top:
            return out
        top = 2 * top + 1


def chain_keys(own: np.ndarray, rare: np.ndarray) -> np.ndarray:
    """The buckets of a set (sorted hashes, and which of them are rare): what chains may have in common with another's.

    A sum of mixed hashes stands for what is in common, so that shingles can be left out of it."""
    size, out = len(own), [np.empty(0, np.uint64)]
    mix = mixed(own)
    sums, rares = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix, dtype=np.uint64)]), starts_of(rare)
    for segments, starts in rings(size) if size else []:
        edge = np.searchsorted((own >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32), np.arange(segments + 1, dtype=np.uint64))
        total, settled = sums[edge[1:]] - sums[edge[:-1]], (rares[edge[1:]] > rares[edge[:-1]])[:starts]
        salt = mixed(np.uint64(segments << 32) | np.arange(starts, dtype=np.uint64))
        out.append(mixed(total[settled.nonzero()[0]] ^ salt[settled]))
        at, found = longer_chains(np.flatnonzero(~settled).tolist(), edge.tolist(), total.tolist(), mix.tolist(), size // 5)
        out.append(mixed(np.array(found, np.uint64) ^ salt[np.array(at, np.int64)]))
    return np.unique(np.concatenate(out))


def settled_chains(own: np.ndarray, rare: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each ring of a set (key, start, edge, sums, mixes): the buckets of chains that are one segment, where each starts, and
    where the segments begin, their sums, and the mixed hashes."""
    mix = mixed(own)
    sums, rares = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix, dtype=np.uint64)]), starts_of(rare)
    for segments, starts in rings(len(own)) if len(own) else []:
        edge = np.searchsorted((own >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32), np.arange(segments + 1, dtype=np.uint64))
        total, at = sums[edge[1:]] - sums[edge[:-1]], np.flatnonzero((rares[edge[1:]] > rares[edge[:-1]])[:starts])
        salt = mixed(np.uint64(segments << 32) | np.arange(starts, dtype=np.uint64))
        yield mixed(total[at] ^ salt[at]), at, edge, total, mix


def lengthened_keys(own: np.ndarray, rare: np.ndarray, crowded: np.ndarray) -> np.ndarray:
    """The buckets that a set goes to instead of crowded ones (keys without their low SIZE_BITS, sorted).

    A chain of one segment, in which nothing may differ, goes on until a later segment leaves something in common, as one whose
    segment has no rare shingle does. Other chains stay where they are."""
    out, known = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    for keys, at, edge, total, mix in settled_chains(own, rare):
        some = np.isin(keys >> np.uint64(SIZE_BITS), crowded)
        known.append(keys[some] >> np.uint64(SIZE_BITS))
        start, found = longer_chains(at[some].tolist(), edge.tolist(), total.tolist(), mix.tolist(), len(own) // 5, False)
        salt = mixed(~mixed(np.uint64(len(total) << 32) | np.array(start, np.uint64)))
        out.append(mixed(np.array(found, np.uint64) ^ salt))
    stay = np.setdiff1d(crowded, np.concatenate(known))
    return np.unique(np.concatenate([*out, stay << np.uint64(SIZE_BITS)]))


def crowd(h: np.ndarray, size: np.ndarray, seed: np.ndarray, leaders: int) -> int:
    """How many rows of a bucket are near none of some leaders."""
    rest = np.argsort(seed.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15), kind="stable")
    for _ in range(leaders):
        if len(rest) < 2:
            break
        rest = rest[1:][~near(h[rest[1:]], h[rest[0]], size[rest[1:]], size[rest[0]])]
    return len(rest)


def longer_chains(starts: list[int], edge: list[int], total: list[int], mix: list[int], most: int, first: bool = True) -> tuple[list[int], list[int]]:
    """Starts and sums of what chains of two or more segments may have in common, each the shortest that leaves something;
    a set of n shingles lacks at most most = n / 5 of its own in another. first: whether the first segment counts as something."""
    segments, at, found = len(total), [], []
    for start in starts:
        now = [(total[start], 0, first and edge[start + 1] > edge[start])]  # the sum, how many are left out, whether something stays
        for length in range(2, segments + 1):
            j = (start + length - 1) % segments
            own, ahead = mix[edge[j] : edge[j + 1]], []
            for kept, gone, some in now:
                for out in range(min(length - 1, most, gone + len(own)) - gone + 1):
                    for lacking in combinations(own, out):
                        left = kept + total[j] - sum(lacking)
                        if some or out < len(own):
                            at.append(start)
                            found.append(left & (1 << 64) - 1)
                        else:
                            ahead.append((left, gone + out, False))
            now = ahead
            if not now:
                break
        at += [start] * len(now)  # a ring of one segment
        found += [kept & (1 << 64) - 1 for kept, _, _ in now]
    return at, found


def set_heads(docs: DataFrame, words: int) -> DataFrame:
    """docs (key, row with text) with id, the set's digest, its size and SIGNS, its head and parities."""
    ship(docs.sparkSession)
    schema = T.StructType([*docs.schema, *(T.StructField(c, T.LongType()) for c in ("id", "size", *SIGNS))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            found = np.zeros((batch.num_rows, 2 + len(SIGNS)), np.uint64)
            for i, text in enumerate(batch["row"].field("text").to_pylist()):
                own = shingle_set(text, words)
                found[i] = set_id(own), len(own), *head_of(own), *parities(own)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(found[:, j].copy().view(np.int64)) for j in range(found.shape[1]))], schema.names)

    return docs.mapInArrow(run, schema)


def sets_of(marked: DataFrame, words: int, ids: DataFrame | None = None) -> DataFrame:
    """(id, shingles as a binary) for rows (id, text), an id once in a task; with ids, for these and some others."""
    bits = None if ids is None else id_map(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in chunks(batches):
            rows, batch = [], batch if bits is None else batch.filter(in_map(bits, batch["id"]))
            for i, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                if i not in seen:
                    seen.add(i)
                    rows.append((i, shingle_set(text, words).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["id", "shingles"])

    return marked.select("id", "text").mapInArrow(run, "id bigint, shingles binary")


def common_shingles(texts: DataFrame, ids: DataFrame, words: int) -> np.ndarray:
    """Hashes, sorted, of the shingles in COMMON or more of SAMPLE distinct sets (those of the smallest ids)."""
    last = ids.orderBy("id").limit(SAMPLE).agg(F.max("id")).first()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(batch["shingles"].to_pylist()), np.int64))], ["shingle"])

    few = sets_of(texts.where(F.col("id") <= F.lit(last).cast("bigint")), words).dropDuplicates(["id"])
    found = few.mapInArrow(run, "shingle bigint").groupBy("shingle").count().where(F.col("count") >= COMMON)
    packs = found.select("shingle").mapInArrow(packed_columns, "shingle binary").collect()
    return np.sort(np.frombuffer(b"".join(bytes(r[0]) for r in packs), np.uint64))


def packed_columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch as one row of its columns' bytes."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([np.asarray(c).tobytes()]) for c in batch.columns], batch.schema.names)


def near(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray | np.int64) -> np.ndarray:
    """Which pairs of SIGNS (the head at least) and sizes may be of similarity 4/5 or more."""
    differ = np.bitwise_count(x ^ y)
    close = (n + m < TELLING) | (differ[:, 0] <= FIRST_BITS) & (differ[:, :2].sum(1) <= HEAD_BITS)
    return (5 * np.minimum(n, m) >= 4 * np.maximum(n, m)) & close & (9 * differ[:, 2:].sum(1, dtype=np.int64) <= n + m)


def near_rows(h: np.ndarray, size: np.ndarray, label: np.ndarray, x: np.ndarray, y: np.ndarray | np.int64) -> np.ndarray:
    """Which pairs of rows have different labels and are near."""
    return (label[x] != label[y]) & near(h[x], h[y], size[x], size[y])


def bucket_pairs(key: np.ndarray, h: np.ndarray, size: np.ndarray, label: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of different labels in whole buckets (sorted by key) that near_rows lets pass."""
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
    length = np.diff(edge)
    short = np.repeat(length <= LONG_BUCKET, length)
    for shift in range(1, LONG_BUCKET):
        at = np.flatnonzero((key[shift:] == key[:-shift]) & short[shift:])
        if not len(at):
            break
        at = at[near_rows(h, size, label, at, at + shift)]
        yield at, at + shift
    for k in np.flatnonzero(length > LONG_BUCKET).tolist():
        _, kind, times = np.unique(label[edge[k] : edge[k + 1]], return_inverse=True, return_counts=True)
        outlier = kind != times.argmax()
        rows = edge[k] + np.concatenate([np.flatnonzero(outlier), np.flatnonzero(~outlier)])  # the largest group has no pairs of its own
        for i in range(int(outlier.sum())):
            hit = rows[i + 1 :][near_rows(h, size, label, rows[i + 1 :], rows[i])]
            yield np.full(len(hit), rows[i]), hit


def bucket_leaders(key: np.ndarray, own: np.ndarray, h: np.ndarray, size: np.ndarray, label: np.ndarray, seed: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For rows of whole buckets (sorted by key) a leader of another label that near_rows lets pass: fewer pairs than rows.

    Leaders come by how many rows have their label, so that a large group yields no more than its outliers, then at random
    by the seed."""
    rank = own.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15 * (2 * seed + 1) % (1 << 64))
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
    for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        _, kind, times = np.unique(label[lo:hi], return_inverse=True, return_counts=True)
        rest = lo + np.lexsort((rank[lo:hi], -times[kind])) if len(times) > 1 else rank[:0]
        while len(rest) > 1:
            hit = near_rows(h, size, label, rest[1:], rest[0])
            yield rest[1:][hit], np.full(int(hit.sum()), rest[0])
            rest = rest[1:][~hit]


def met_with(x: np.ndarray, y: np.ndarray, rows: np.ndarray, key: np.ndarray, h: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which rows of whole buckets (sorted by key; rows is 0, 1, ...) are near another of theirs, given pairs (x, y) of them and
    their leaders: of all rows, those in no pair have met all others in none but those that a leader took before them."""
    keep, taken = np.zeros(len(key), bool), np.zeros(len(key), bool)
    keep[x] = keep[y] = taken[x] = True
    for i in np.flatnonzero(~keep).tolist():
        lo, hi = np.searchsorted(key, key[i]), np.searchsorted(key, key[i], "right")
        others = rows[lo:hi][taken[lo:hi]]
        keep[i] = len(others) > 0 and near_rows(h, size, rows, others, rows[i]).any()
    return keep


def whole_buckets(batches: Iterator[pa.RecordBatch], columns: list[str], key: str) -> Iterator[list[np.ndarray]]:
    """The columns of batches sorted by key, cut where no key goes on."""
    held: list[np.ndarray] = [np.empty(0, np.int64)] * len(columns)
    at = columns.index(key)
    for batch in _with_end(batches):
        if batch is not None:
            held = [np.concatenate([h, np.asarray(batch[c])]) for h, c in zip(held, columns, strict=True)]
        cut = len(held[at]) if batch is None else int(np.searchsorted(held[at], held[at][-1])) if len(held[at]) else 0
        if cut:
            yield [h[:cut] for h in held]
            held = [h[cut:] for h in held]
    release()


def met_rows(texts: DataFrame, words: int, common: np.ndarray, shingles: int) -> DataFrame:
    """What meets in buckets, of the rows (id, h0, h1, text), by kind: PAIR (a, b) for the near pairs of short buckets and for near
    pairs of rows and leaders of long ones, and LONG (key, a) for all rows of long ones that are near another there. shingles of
    all the sets tell how many rows the buckets have. Rows of crowded buckets meet once more, in those of longer chains."""
    parts = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), shingles // 2 // SORTED)
    most, leaders = CROWD, LEADERS
    schema = "slot bigint, id bigint, h0 bigint, h1 bigint"

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in chunks(batches):
            columns: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in range(4)]
            crowded = batch["crowded"].to_pylist() if "crowded" in batch.schema.names else [None] * batch.num_rows
            for i, h0, h1, text, full in zip(*(batch[c].to_pylist() for c in ("id", "h0", "h1", "text")), crowded, strict=True):
                if i not in seen:
                    seen.add(i)
                    own = shingle_set(text, words)
                    rare = rare_ones(own, common)
                    keys = chain_keys(own, rare) if full is None else lengthened_keys(own, rare, np.sort(np.array(full, np.int64).view(np.uint64) & np.uint64((1 << 64 - SIZE_BITS) - 1)))
                    slots = (keys & ~np.uint64((1 << SIZE_BITS) - 1)) | np.uint64(min(len(own), (1 << SIZE_BITS) - 1))
                    for column, values in zip(columns, (slots.view(np.int64), *(np.full(len(keys), v, np.int64) for v in (i, h0, h1))), strict=True):
                        column.append(values)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], ["slot", "id", "h0", "h1"])

    def meet(last: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(kind: int, key: np.ndarray | None, a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
            columns = [pa.nulls(len(a), pa.int64()) if c is None else pa.array(c.copy()) for c in (key, a, b)]
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), *columns], ["kind", "key", "a", "b"])

        def pairs(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            own = np.unique(np.sort(np.stack([np.concatenate([f[j] for f in found]) for j in (0, 1)], 1), 1), axis=0)
            return out(PAIR, None, own[:, 0], own[:, 1])

        keyed = (pa.RecordBatch.from_arrays([pa.array(np.asarray(b["slot"]) >> SIZE_BITS), *b.columns], ["key", "slot", "id", "h0", "h1"]) for b in batches)
        found, held = [], 0
        for key, slot, own, h0, h1 in whole_buckets(keyed, ["key", "slot", "id", "h0", "h1"], "key"):
            once = np.ones(len(key), bool)
            once[1:] = (slot[1:] != slot[:-1]) | (own[1:] != own[:-1])
            key, size, own, h = key[once], slot[once] & (1 << SIZE_BITS) - 1, own[once], np.stack([h0[once], h1[once]], 1).view(np.uint64)
            edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
            length = np.diff(edge)
            many = np.repeat(length > LONG_BUCKET, length)
            for shift in range(1, LONG_BUCKET):
                at = np.flatnonzero((key[shift:] == key[:-shift]) & ~many[shift:] & (5 * size[:-shift] >= 4 * size[shift:]))
                if not len(at):
                    break
                at = at[near(h[at], h[at + shift], size[at], size[at + shift]) & (own[at] != own[at + shift])]
                found.append((own[at], own[at + shift]))
                held += len(at)
            for k in [] if last else np.flatnonzero(length > most).tolist():
                lo, hi = edge[k], edge[k + 1]
                if crowd(h[lo:hi], size[lo:hi], own[lo:hi], leaders) > most:
                    many[lo:hi] = False
                    yield out(CROWDED, key[lo:hi], own[lo:hi], None)
            if many.any():
                key, own, h, size, rows = key[many], own[many], h[many], size[many], np.arange(int(many.sum()))
                led = [np.concatenate([np.empty(0, np.int64), *side]) for side in zip(*bucket_leaders(key, own, h, size, rows, 0), strict=True)] or [rows[:0]] * 2
                found.append((own[led[0]], own[led[1]]))
                held += len(led[0])
                stay = met_with(*led, rows, key, h, size)
                yield out(LONG, key[stay], own[stay], None)
            if held > 100_000:
                yield pairs(found)
                found, held = [], 0
        if held:
            yield pairs(found)

    def met(rows: DataFrame, last: bool) -> DataFrame:
        dealt = rows.mapInArrow(spread, schema).repartition(parts, F.shiftright("slot", SIZE_BITS)).sortWithinPartitions("slot", "id")
        return written(dealt.mapInArrow(partial(meet, last), "kind int, key bigint, a bigint, b bigint"))

    first = met(texts.select("id", "h0", "h1", "text"), False)
    crowded = first.where(F.col("kind") == CROWDED).groupBy(F.col("a").alias("id")).agg(F.collect_set("key").alias("crowded"))  # a set has half as many keys as shingles
    if crowded.isEmpty():
        return first
    again = among(texts.select("id", "h0", "h1", "text"), crowded.select("id")).join(crowded, "id")
    return first.where(F.col("kind") != CROWDED).unionByName(met(written(again), True))


def near_pairs(pairs: DataFrame, heads: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and SIGNS (of heads by id) are near."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 4096):
            x, y = (np.stack([np.asarray(batch[f"{v}_{c}"]) for c in SIGNS], 1).view(np.uint64) for v in "ab")
            yield batch.select(["a", "b"]).filter(pa.array(near(x, y, np.asarray(batch["a_size"]), np.asarray(batch["b_size"]))))

    sided = lambda v: heads.select(F.col("id").alias(v), *(F.col(c).alias(f"{v}_{c}") for c in ("size", *SIGNS)))
    return pairs.join(sided("a"), "a").join(sided("b"), "b").mapInArrow(run, "a bigint, b bigint")


def near_met(met: DataFrame) -> DataFrame:
    """Of rows (key, id, size, label, SIGNS) what is in a near pair of a bucket and of different labels: rows (id, other) for the
    pairs of buckets that have few, and of the others all columns."""
    columns, most = ["key", "id", "size", "label", *SIGNS], LISTED

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in whole_buckets(batches, columns, "key"):
            key, own, size, label, *signs = found
            h, keep, listed = np.stack(signs, 1).view(np.uint64), np.zeros(len(key), bool), [np.empty((0, 2), np.int64)]
            edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])).tolist()
            for lo, hi in zip(edge[:-1], edge[1:], strict=True):
                stay, pairs, held = np.zeros(hi - lo, bool), [], 0
                for x, y in bucket_pairs(key[lo:hi], h[lo:hi], size[lo:hi], label[lo:hi]):
                    stay[x] = stay[y] = True
                    held += len(x)
                    if held <= most * (hi - lo):
                        pairs.append(np.sort(np.stack([own[lo:hi][x], own[lo:hi][y]], 1), 1))
                if held <= most * (hi - lo):
                    listed += pairs
                else:
                    keep[lo:hi] = stay
            pairs = np.unique(np.concatenate(listed), axis=0)
            nulls, none = pa.nulls(len(pairs), pa.int64()), pa.nulls(int(keep.sum()), pa.int64())
            yield pa.RecordBatch.from_arrays([*(pa.array(c[keep]) for c in found), none], [*columns, "other"])
            yield pa.RecordBatch.from_arrays([nulls, pa.array(pairs[:, 0].copy()), *[nulls] * (len(columns) - 2), pa.array(pairs[:, 1].copy())], [*columns, "other"])

    return met.select(columns).repartition("key").sortWithinPartitions("key").mapInArrow(run, ", ".join(f"{c} bigint" for c in [*columns, "other"]))


def candidate_pairs(met: DataFrame, seed: int | None = None) -> DataFrame:
    """Pairs (a, b) of different labels that meet in rows (key, id, size, SIGNS, label): all, or with a seed those of rows and
    their leaders."""
    columns = ["key", "id", "size", "label", *SIGNS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: list) -> pa.RecordBatch:
            pairs = np.stack([np.concatenate([f[j] for f in found]) for j in (0, 1)], 1)
            pairs = np.unique(np.sort(pairs, 1) if seed is None else pairs, axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, j].copy()) for j in (0, 1)], ["a", "b"])

        found, held = [], 0
        for key, own, size, label, *signs in whole_buckets(batches, columns, "key"):
            h = np.stack(signs, 1).view(np.uint64)
            for x, y in bucket_pairs(key, h, size, label) if seed is None else bucket_leaders(key, own, h, size, label, seed):
                if len(x):
                    found.append((own[x], own[y]))
                    held += len(x)
                if held > 100_000:
                    yield out(found)
                    found, held = [], 0
        if found:
            yield out(found)

    return met.select(columns).repartition("key").sortWithinPartitions("key").mapInArrow(run, "a bigint, b bigint").distinct()


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets (id, shingles) are similar."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            sides = ([np.frombuffer(v, np.uint64) for v in batch[c].to_pylist()] for c in ("x", "y"))
            yield batch.select(["a", "b"]).filter(pa.array([similar(x, y) for x, y in zip(*sides, strict=True)], pa.bool_()))

    sided = lambda i, v: sets.select(F.col("id").alias(i), F.col("shingles").alias(v))
    both = pairs.join(sided("a", "x"), "a").join(sided("b", "y"), "b")
    return both.select("a", "b", "x", "y").mapInArrow(check, "a bigint, b bigint")


def id_map(ids: DataFrame) -> np.ndarray:
    """A map of bits of the ids."""
    slot = F.col("id").bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    bit = F.expr("shiftleft(1L, cast(id & 63 as int))")
    found = ids.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    bits = np.zeros(1 << MAP_BITS - 6, np.int64)
    for pack in found.mapInArrow(packed_columns, "word binary, bits binary").collect():
        bits[np.frombuffer(bytes(pack["word"]), np.int64)] = np.frombuffer(bytes(pack["bits"]), np.int64)
    return bits


def in_map(bits: np.ndarray, ids: pa.Array) -> pa.Array:
    """Which ids the map lets pass: those it is made of, and some others."""
    i = np.asarray(ids)
    return pa.array((bits[(i & (1 << MAP_BITS) - 1) >> 6] >> (i & 63) & 1).astype(bool))


def among(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose id is among ids, and some others."""
    bits = id_map(ids)

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            yield batch.filter(in_map(bits, batch["id"]))

    return rows.mapInArrow(passing, rows.schema)


def checked(pairs: DataFrame, sets: DataFrame, few: bool) -> DataFrame:
    """verified pairs, written; if they are few, only the sets of their ids are dealt out. No task runs two Python functions,
    whose workers would all stay in the executor's memory."""
    pairs = written(pairs)
    own = written(among(sets, pairs.select(F.explode(F.array("a", "b")).alias("id")))) if few else sets
    return written(verified(pairs, own))


def similar_links(texts: DataFrame, heads: DataFrame, words: int) -> DataFrame:
    """(node, label) of the ids that have others of similarity 4/5 or more: rows (id, h0, h1, text), and heads (id, size,
    SIGNS), each id once."""
    spark = texts.sparkSession
    met = met_rows(texts, words, common_shingles(texts, heads, words), heads.agg(F.sum("size")).first()[0] or 0)
    long = met.where(F.col("kind") == LONG).select("key", F.col("a").alias("id"))
    pairs = written(near_pairs(met.where(F.col("kind") == PAIR).select("a", "b").distinct(), heads))
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).union(long.select("id"))
    sets = written(sets_of(texts, words, wanted).dropDuplicates(["id"]))
    edges, rows = spark.createDataFrame([], "a bigint, b bigint"), None
    for seed in range(ROUNDS + 1):
        last = seed == ROUNDS or seed > 0 and rows is None
        more = checked(pairs if rows is None else pairs.union(candidate_pairs(rows, None if last else seed)).distinct(), sets, seed > 0)
        labels = components(edges.union(more))
        if last:
            break
        labelled = lambda x: x.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("label", F.coalesce("label", "id"))  # noqa: B023, E731
        left = written(near_met(labelled(rows.drop("label")) if seed else long.join(labelled(heads), "id")))
        if left.isEmpty():
            break
        rows, pairs = left.where("key is not null").drop("other"), left.where("key is null").selectExpr("id as a", "other as b").distinct()
        rows = None if rows.isEmpty() else rows
        edges = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
    return labels


def without_near_duplicates(docs: DataFrame, words: int = 5) -> DataFrame:
    """docs with one row of each group of near duplicates, the one of the smallest doc_id; all columns stay.

    Texts are linked whose sets of distinct shingles have a similarity of 4/5 or more."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.monotonically_increasing_id().alias("n")).alias("key")
    marked = written(set_heads(docs.select(key, row), words))
    distinct = written(marked.groupBy("id").agg(F.min("key").alias("key"), *(F.min(c).alias(c) for c in ("size", *SIGNS))))
    joined = similar_links(marked.select("id", "h0", "h1", F.col("row.text").alias("text")), distinct.select("id", "size", *SIGNS), words)
    rooted = distinct.join(joined.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("label", "id"))
    kept = rooted.groupBy("root").agg(F.min("key").alias("first")).select("first")
    return marked.join(kept, marked["key"] == kept["first"], "left_semi").select("row.*")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), "text")
    return near_duplicates(docs).select(
        F.col("key").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )

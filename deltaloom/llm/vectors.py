"""Vector search: inverted file with product quantisation (approximate), and ball trees (exact inner products).

Both read queries and candidates from one table. Queries travel in blocks, candidates in shards of bounded size; a
block meets the shards it has to see through an equi-join on the shard's number, and a shard yields only its best few
for each query. Nothing about all rows is gathered on the driver.

Defined results: vectors that are null or hold null or non-finite components take no part, nor, for cosines, zero
vectors; nor do rows without a vec_id. Where vectors differ in length, which no measure compares, those of the commonest
length take part and no others (the contract of the queries names one length only). Rows that repeat a vec_id are candidates each, but a query's own id is never its answer, and the queries of one id have
their best answers in common; an empty table gives an empty one.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deltaloom.llm.common import chunks, ship, table, written


def usable(rows: DataFrame, zero: bool) -> DataFrame:
    """rows (vec_id, embedding) that take part, as vec_id bigint and v array<double>; zero: whether zero vectors do."""
    ship(rows.sparkSession)
    v = F.col("embedding").cast("array<double>")
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & good)
    if not zero:
        rows = rows.where(F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").limit(1)
    width = sizes.first()
    return rows.where(F.size("v") == (width["size"] if width else 0))


def matrix(column: pa.Array | pd.Series) -> np.ndarray:
    rows = column.to_pylist() if isinstance(column, pa.Array) else list(column)
    return np.array(rows, np.float64).reshape(len(rows), -1)


# Inverted file with product-quantised residuals


def k_means(x: np.ndarray, k: int, rounds: int, random: np.random.Generator) -> np.ndarray:
    """Centres of rows x; an empty one takes the row that lies farthest from its own."""
    centres = x[random.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        gap = (centres**2).sum(1) - 2 * x @ centres.T
        own = gap.argmin(1)
        count = np.bincount(own, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, own, x)
        some = count > 0
        centres[some] = total[some] / count[some, None]
        far = np.argsort(-(gap[np.arange(len(x)), own] + (x**2).sum(1)), kind="stable")
        for place, k_ in enumerate(np.flatnonzero(~some).tolist()):
            centres[k_] = x[far[place % len(far)]]
    return centres


class Quantiser:
    """Coarse centroids of unit vectors, and codebooks of the residuals' parts."""

    def __init__(self, sample: np.ndarray, lists: int, parts: int, rounds: int = 12, seed: int = 7) -> None:
        random = np.random.default_rng(seed)
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True) if len(sample) else sample
        self.centres = k_means(unit, lists, rounds, random) if len(unit) else unit
        self.cuts = np.linspace(0, sample.shape[1], min(parts, sample.shape[1]) + 1).astype(int)
        own = self.nearest(unit)
        rest = unit - self.centres[own] if len(unit) else unit
        self.books = [k_means(rest[:, a:b], 256, rounds, random) if len(rest) else rest[:, a:b] for a, b in zip(self.cuts[:-1], self.cuts[1:], strict=True)]

    def nearest(self, unit: np.ndarray) -> np.ndarray:
        return ((self.centres**2).sum(1) - 2 * unit @ self.centres.T).argmin(1) if len(unit) else np.empty(0, np.int64)

    def codes(self, unit: np.ndarray, own: np.ndarray) -> np.ndarray:
        rest, out = unit - self.centres[own], []
        for a, b, book in zip(self.cuts[:-1], self.cuts[1:], self.books, strict=True):
            out.append(((book**2).sum(1) - 2 * rest[:, a:b] @ book.T).argmin(1))
        return np.stack(out, 1).astype(np.uint8)

    def gaps(self, unit: np.ndarray, own: int, codes: np.ndarray) -> np.ndarray:
        """By how much each code's row of a list lies from each query, squared, up to a term of the query's own."""
        rest, gap = unit - self.centres[own], np.zeros((len(unit), len(codes)))
        for j, (a, b, book) in enumerate(zip(self.cuts[:-1], self.cuts[1:], self.books, strict=True)):
            gap += ((book**2).sum(1) - 2 * rest[:, a:b] @ book.T)[:, codes[:, j]]
        return gap


def measured(q: Quantiser, index: DataFrame, queries: DataFrame, k: int, goal: float, most: int = 256) -> tuple[int, int]:
    """How many lists a query must probe, and how many of a list's rows by code be reranked, for a share goal of the k nearest
    rows: of most queries of least hash, against all rows. Of rows alone nothing follows for queries that lie elsewhere.

    Two passes over the index: the first yields these queries' k nearest rows by brute force, the second how many rows
    come before each of them by code in its list."""
    asked = queries.orderBy(F.xxhash64(F.lit(34), "vec_id"), "vec_id").limit(most).toPandas()
    if not len(asked):
        return 1, 1
    who, y = asked["vec_id"].to_numpy(np.int64), matrix(asked["v"])
    y /= np.linalg.norm(y, axis=1, keepdims=True)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lists = np.empty((len(who), 0), np.int64), np.empty((len(who), 0), np.int64)
        score, codes = np.empty((len(who), 0)), np.empty((len(who), 0), object)
        for batch in chunks(batches, 4096):
            x, own = matrix(batch["v"]), batch["vec_id"].to_numpy()
            cosine = y @ (x / np.linalg.norm(x, axis=1, keepdims=True)).T
            cosine[who[:, None] == own] = -np.inf
            wide = np.broadcast_to
            ids = np.concatenate([ids, wide(own, cosine.shape)], 1)
            lists = np.concatenate([lists, wide(batch["list"].to_numpy(), cosine.shape)], 1)
            codes = np.concatenate([codes, wide(np.array([*batch["code"].to_pylist(), None], object)[:-1], cosine.shape)], 1)
            score = np.concatenate([score, cosine], 1)
            top = np.lexsort((ids, -score), axis=1)[:, :k]
            ids, lists, codes, score = (np.take_along_axis(v, top, 1) for v in (ids, lists, codes, score))
        at, place = np.nonzero(score > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(ids[at, place]), pa.array(lists[at, place]), pa.array(list(codes[at, place]), pa.binary()), pa.array(score[at, place])], ["at", "vec_id", "list", "code", "score"])

    found = index.mapInArrow(near, "at bigint, vec_id bigint, list bigint, code binary, score double")
    turn = F.row_number().over(Window.partitionBy("at").orderBy(F.desc("score"), "vec_id"))
    found = found.withColumn("turn", turn).where(F.col("turn") <= k).toPandas()  # k rows for each of these queries
    if not len(found):
        return 1, 1
    at, ids, lists = (found[c].to_numpy(np.int64) for c in ("at", "vec_id", "list"))
    order = np.argsort(np.argsort((q.centres**2).sum(1) - 2 * y @ q.centres.T, axis=1, kind="stable"), axis=1)
    probes = int(np.quantile(order[at, lists], goal, method="higher")) + 1
    own_gap = np.array([q.gaps(y[[a]], int(c), np.frombuffer(code, np.uint8)[None])[0, 0] for a, c, code in zip(at, lists, found["code"], strict=True)])

    def before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(at), np.int64)
        for batch in chunks(batches, 4096):
            of, own = batch["list"].to_numpy(), batch["vec_id"].to_numpy()
            codes = np.frombuffer(b"".join(batch["code"].to_pylist()), np.uint8).reshape(len(of), -1)
            for one in np.intersect1d(of, lists).tolist():
                rows, asks = np.flatnonzero(of == one), np.flatnonzero(lists == one)
                gap = q.gaps(y[at[asks]], one, codes[rows])
                slack = 1e-9 * (1 + np.abs(own_gap[asks, None]))  # rows of the same code tie whatever the rounding
                count[asks] += ((gap < own_gap[asks, None] - slack) | (np.abs(gap - own_gap[asks, None]) <= slack) & (own[rows] < ids[asks, None])).sum(1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(at))), pa.array(count)], ["place", "n"])

    counts = index.mapInArrow(before, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    return probes, int(np.quantile(counts["n"].to_numpy(np.int64), max(goal, 0.99), method="higher")) + 1


def nearest_neighbours(
    rows: DataFrame, queries: DataFrame, k: int = 5, lists: int | None = None, probes: int | None = None, parts: int = 16, sample: int = 16_000, most_sample: int = 65_536, goal: float = 0.97,
    shard_rows: int = 4096, rerank: int | None = None, block: int = 4096,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each query by cosine, from usable vectors.

    There are about as many lists as the square root of the rows, 4096 at most. The index is fitted on sample rows, or 16
    for each list if that is more, of least hash; all rows are indexed. probes and rerank (64 at least) are what finds a share
    goal of the nearest rows of 256 queries, measured by brute force over all rows. A list is cut into shards of about shard_rows rows, so a hot one has many, and what asks it into
    blocks of about block queries; a task has one block's queries and one shard, and a shard goes to its own list's blocks
    only. A shard ranks its codes by the query's distance table and reranks the best by cosines of the vectors themselves."""
    count = rows.count()
    lists = lists or int(min(4096, max(1, 1 << round(float(np.log2(max(1, count)) / 2)))))
    sample = min(most_sample, max(sample, 16 * lists))
    fitted = rows.orderBy(F.xxhash64(F.lit(31), "vec_id"), "vec_id").limit(sample).select("v").toPandas()
    if not len(fitted):
        return rows.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    fitted = matrix(fitted["v"])
    q = Quantiser(fitted, lists, parts)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 4096):
            x = matrix(batch["v"])
            unit = x / np.linalg.norm(x, axis=1, keepdims=True)
            own = q.nearest(unit)
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["v"], pa.array(own), pa.array([c.tobytes() for c in q.codes(unit, own)], pa.binary())], ["vec_id", "v", "list", "code"])

    index = written(rows.mapInArrow(place, "vec_id bigint, v array<double>, list bigint, code binary"))

    if probes is None or rerank is None:
        lists_needed, rows_needed = measured(q, index, queries, k, goal)
        probes, rerank = probes or lists_needed, rerank or max(64, rows_needed)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 1024):
            x = matrix(batch["v"])
            unit = x / np.linalg.norm(x, axis=1, keepdims=True)
            near = np.argsort((q.centres**2).sum(1) - 2 * unit @ q.centres.T, axis=1, kind="stable")[:, :probes]
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["v"], pa.array(list(near), pa.list_(pa.int64()))], ["query_id", "v", "lists"])

    probed = written(queries.mapInArrow(probe, "query_id bigint, v array<double>, lists array<bigint>"))
    asked, index = dealt(probed, index, shard_rows, block)

    def search(asked: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})
        if not len(asked) or not len(own):
            return empty
        own = own.sort_values("vec_id")
        ids, x = own["vec_id"].to_numpy(), matrix(own["v"])
        length = np.sqrt((x * x).sum(1))
        codes = np.frombuffer(b"".join(own["code"]), np.uint8).reshape(len(ids), -1)
        out, of = [empty], int(own["list"].iloc[0])
        query_ids, all_queries = asked["query_id"].to_numpy(), matrix(asked["v"])
        keep = min(rerank + 1, len(ids))
        step = max(1, min(256, (1 << 23) // (keep * x.shape[1])))  # of the rows that are reranked 64 MB at a time
        for at in range(0, len(query_ids), step):
            who, y = query_ids[at : at + step], all_queries[at : at + step]
            size = np.sqrt((y * y).sum(1))
            gap = q.gaps(y / size[:, None], of, codes)
            gap[who[:, None] == ids] = np.inf
            best = np.argsort(gap, axis=1, kind="stable")[:, :keep]
            cosine = (x[best] * y[:, None]).sum(2) / (length[best] * size[:, None])
            cosine[who[:, None] == ids[best]] = -np.inf
            top = np.lexsort((ids[best], -cosine), axis=1)[:, :k]
            cosine, found_ids = np.take_along_axis(cosine, top, 1), np.take_along_axis(ids[best], top, 1)
            good = cosine > -np.inf
            out.append(pd.DataFrame({"query_id": np.repeat(who, good.sum(1)), "vec_id": found_ids[good], "score": cosine[good]}))
        return pd.concat(out)

    found = asked.groupBy("list", "shard", "block").cogroup(index.groupBy("list", "shard", "block")).applyInPandas(search, "query_id bigint, vec_id bigint, score double")
    return _best(found, k, F.desc("score"))


def dealt(probed: DataFrame, index: DataFrame, shard_rows: int, block: int) -> tuple[DataFrame, DataFrame]:
    """What is asked of each (list, shard, block), from queries and the lists they probe, and the rows that each holds: a list's
    rows in shards of about shard_rows, once for each of the blocks of about block queries that probe the list."""
    own = index.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("shards"))
    asking = probed.select(F.explode("lists").alias("list")).groupBy("list").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    sizes = F.broadcast(own.join(asking, "list"))  # a row for each list
    # by the row's place in the written table: rows that repeat an id spread like all others
    shard = F.pmod(F.xxhash64(F.lit(32), F.monotonically_increasing_id()), F.col("shards")).cast("int").alias("shard")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rows = index.join(sizes, "list").select("vec_id", "v", "list", "code", shard, each("blocks").alias("block"))
    own_block = F.pmod(F.xxhash64(F.lit(33), "query_id", "v"), F.col("blocks")).cast("int").alias("block")
    return probed.select("query_id", "v", F.explode("lists").alias("list")).join(sizes, "list").select("query_id", "v", "list", own_block, each("shards").alias("shard")), rows


def _best(found: DataFrame, k: int, *order: object) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order, "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


# Ball trees


class BallTree:
    """Rows halved at the middle of their widest direction down to leaves; each node has a centre and a radius.

    A row of nodes is (begin, end, left, right) in the tree's order of rows; a leaf has no children (-1)."""

    def __init__(self, nodes: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> None:
        self.nodes, self.centres, self.radii = nodes, centres, radii
        self.size = np.sqrt((centres * centres).sum(1))

    @staticmethod
    def grown(x: np.ndarray, leaf: int = 128) -> tuple[BallTree, np.ndarray]:
        """The tree of rows x, and their order in it."""
        order = np.arange(len(x))
        nodes: list[list[int]] = []
        centres, radii = [], []
        stack = [(0, len(x), -1, 0)]
        while stack:
            a, b, parent, side = stack.pop()
            own = len(nodes)
            if parent >= 0:
                nodes[parent][2 + side] = own
            rows = x[order[a:b]]
            centre = rows.mean(0)
            centres.append(centre)
            radii.append(np.sqrt(((rows - centre) ** 2).sum(1).max()))
            nodes.append([a, b, -1, -1])
            if b - a > leaf and radii[-1] > 0:
                spread = int((rows.max(0) - rows.min(0)).argmax())
                middle = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(rows[:, spread], middle)]
                stack += [(a, a + middle, own, 0), (a + middle, b, own, 1)]
        return BallTree(np.array(nodes, np.int64), np.array(centres), np.array(radii)), order

    def bounds(self, node: int, queries: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The most that each query's inner product with a row of the node can be; widened for rounding."""
        bound = queries @ self.centres[node] + length * self.radii[node]
        return bound + 1e-9 * (np.abs(bound) + length * (self.radii[node] + self.size[node]) + 1)


def search_tree(tree: BallTree, x: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """(query's place, id, score) of the best k rows for each query among rows that reach its floor, and the leaves seen.

    Branch and bound for all queries at once: a node waits in a queue with the queries whose bound there reached their
    floor, by the largest bound for a query of length 1. The first is taken, queries whose floor has passed their bound
    since leave it, and the others go to those children whose bounds reach their floors, or meet the rows of a leaf. A
    query's floor rises to its kth score, so whole subtrees are never opened. x and ids are in the tree's order."""
    length = np.sqrt((queries * queries).sum(1))
    unit = np.where(length > 0, length, 1)
    floor, leaves = floor.astype(np.float64).copy(), []
    best_score = np.full((len(queries), k), -np.inf)
    best_id = np.full((len(queries), k), np.iinfo(np.int64).max)
    queue: list[tuple] = []

    def wait(node: int, who: np.ndarray) -> None:
        bound = tree.bounds(node, queries[who], length[who])
        some = bound >= floor[who]
        if some.any():
            heapq.heappush(queue, (-float((bound[some] / unit[who[some]]).max()), node, who[some], bound[some]))

    if len(tree.nodes) and len(queries):
        wait(0, np.arange(len(queries)))
    while queue:
        _, node, who, bound = heapq.heappop(queue)
        who = who[bound >= floor[who]]
        if not len(who):
            continue
        begin, end, left, right = tree.nodes[node].tolist()
        if left >= 0:
            wait(left, who)
            wait(right, who)
            continue
        leaves.append(node)
        product = queries[who] @ x[begin:end].T
        hit = product >= floor[who, None]
        hit &= ids[begin:end] != query_ids[who, None]
        some = np.flatnonzero(hit.any(1))
        if len(some):
            product[~hit] = -np.inf
            own = who[some]
            score = np.concatenate([best_score[own], product[some]], 1)
            found = np.concatenate([best_id[own], np.where(hit[some], ids[begin:end], np.iinfo(np.int64).max)], 1)
            if score.shape[1] > 3 * k:  # of many the k largest and what ties with the last of them go on
                kth = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k]
                wide = max(k, int((score >= kth[:, None]).sum(1).max())) if np.isfinite(kth).all() else score.shape[1]
                if wide < score.shape[1]:
                    near = np.argpartition(-score, wide - 1, axis=1)[:, :wide]
                    score, found = np.take_along_axis(score, near, 1), np.take_along_axis(found, near, 1)
            top = np.lexsort((found, -score), axis=1)[:, :k]
            best_score[own], best_id[own] = np.take_along_axis(score, top, 1), np.take_along_axis(found, top, 1)
            floor[own] = np.maximum(floor[own], best_score[own, k - 1])
    q, at = np.nonzero(best_score > -np.inf)
    return q, best_id[q, at], best_score[q, at], leaves


def top_products(rows: DataFrame, queries: DataFrame, k: int = 20, shard_rows: int = 8192, block: int = 512, scale: float = 64.0) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of largest inner product for each query, of floor(scale * component).

    Products are exact while they stay under 2^53 in size. Rows are dealt to shards at random, whose trees are grown once
    and kept in a table, queries to blocks. Blocks meet the shards in waves of 1, 1, 2, 4 and so on; after each wave a
    block's kth scores so far, with the ids that hold them, are the floors of the next. A wave sees as many rows as all
    before it, so only about k rows for a query pass its floors, however many shards there are."""
    empty = "query_id bigint, rank int, vec_id bigint, score bigint"
    whole = written(rows.select("vec_id", F.transform("v", lambda x: F.floor(x * F.lit(scale)).cast("double")).alias("v")))
    count = whole.count()
    if not count:
        return rows.sparkSession.createDataFrame([], empty)
    shards = -(-count // shard_rows)

    def planted(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("vec_id")
        ids, x = frame["vec_id"].to_numpy(np.int64), matrix(frame["v"])
        tree, order = BallTree.grown(x)
        parts = {"ids": ids[order], "x": x[order], "nodes": tree.nodes, "centres": tree.centres, "radii": tree.radii}
        return pd.DataFrame({"shard": [int(frame["shard"].iloc[0])]} | {c: [v.tobytes()] for c, v in parts.items()})

    def packed(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("vec_id")
        return pd.DataFrame({"block": [int(frame["block"].iloc[0])], "query_ids": [frame["vec_id"].to_numpy(np.int64).tobytes()], "q": [matrix(frame["v"]).tobytes()]})

    # by the row's place in the written table: rows that repeat an id spread like all others
    own = whole.withColumn("shard", F.pmod(F.xxhash64(F.lit(41), F.monotonically_increasing_id()), F.lit(shards)).cast("int"))
    trees = written(own.groupBy("shard").applyInPandas(planted, "shard int, ids binary, x binary, nodes binary, centres binary, radii binary"))
    asked = written(queries.select("vec_id", F.transform("v", lambda x: F.floor(x * F.lit(scale)).cast("double")).alias("v")))
    blocks_ = max(1, -(-asked.count() // block))
    asked = asked.withColumn("block", F.pmod(F.xxhash64(F.lit(42), F.monotonically_increasing_id()), F.lit(blocks_)).cast("int"))
    asked = written(asked.groupBy("block").applyInPandas(packed, "block int, query_ids binary, q binary"))
    numbers = lambda cell, kind: np.frombuffer(cell.as_py() or b"", kind)
    result = ["block", "place", "vec_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 1):
            ids, query_ids = numbers(batch["ids"][0], np.int64), numbers(batch["query_ids"][0], np.int64)
            x, q = numbers(batch["x"][0], np.float64).reshape(len(ids), -1), numbers(batch["q"][0], np.float64).reshape(len(query_ids), -1)
            tree = BallTree(numbers(batch["nodes"][0], np.int64).reshape(-1, 4), numbers(batch["centres"][0], np.float64).reshape(-1, x.shape[1]), numbers(batch["radii"][0], np.float64))
            floor, last = numbers(batch["floor"][0], np.float64), numbers(batch["last"][0], np.int64)
            known = len(floor) > 0
            at, found, score, _ = search_tree(tree, x, ids, q, query_ids, floor if known else np.full(len(query_ids), -np.inf), k)
            if known:  # what ties with the floor and comes after its holder is not among the best
                good = (score > floor[at]) | (found < last[at])
                at, found, score = at[good], found[good], score[good]
            yield pa.RecordBatch.from_arrays([pa.array([batch["block"][0].as_py()], pa.int32()), *(pa.array([v.tobytes()]) for v in (at.astype(np.int32), found, score))], result)

    def best(frame: pd.DataFrame) -> pd.DataFrame:
        """A block's best k for each query of what is found so far, and floors where there are k."""
        at, found, score = (np.concatenate([np.frombuffer(v, kind) for v in frame[c]]) for c, kind in (("place", np.int32), ("vec_id", np.int64), ("score", np.float64)))
        order = np.lexsort((found, -score, at))
        at, found, score = at[order], found[order], score[order]
        n = int(frame["queries"].iloc[0])
        first = np.searchsorted(at, np.arange(n))
        keep = np.arange(len(at)) - first[at] < k
        kth = np.minimum(first + k - 1, max(0, len(at) - 1))
        full = (first + k - 1 < len(at)) & (at[kth] == np.arange(n)) if len(at) else np.zeros(n, bool)
        floor = np.where(full, score[kth], -np.inf) if len(at) else np.full(n, -np.inf)
        last = np.where(full, found[kth], np.iinfo(np.int64).max) if len(at) else np.full(n, np.iinfo(np.int64).max)
        values = (at[keep].astype(np.int32), found[keep], score[keep], floor, last)
        return pd.DataFrame({"block": [int(frame["block"].iloc[0])]} | {c: [v.tobytes()] for c, v in zip(("place", "vec_id", "score", "floor", "last"), values, strict=True)})

    sizes = asked.select("block", (F.length("query_ids") / 8).cast("int").alias("queries"))
    state = asked.select("block", *[F.lit(None).cast("binary").alias(c) for c in ("place", "vec_id", "score", "floor", "last")])
    done = 0
    while done < shards:
        more = min(max(1, done), shards - done)
        # a block's order of shards starts at its own number
        turn = F.pmod(F.col("block") + F.col("turn"), F.lit(shards)).cast("int")
        # all sides shuffled: Spark expects one copy of what is asked, not one for each shard, and would broadcast them by way of the driver
        met = asked.join(state.select("block", "floor", "last").hint("merge"), "block").withColumn("turn", F.explode(F.sequence(F.lit(done), F.lit(done + more - 1)))).withColumn("shard", turn)
        found = met.repartition(2 * min(shards, blocks_ * more), "shard").join(trees.hint("merge"), "shard").select("ids", "x", "nodes", "centres", "radii", "block", "query_ids", "q", "floor", "last")
        found = found.mapInArrow(run, "block int, place binary, vec_id binary, score binary")
        every = found.union(state.select(*result).where("place is not null")).join(sizes, "block")
        state = written(every.groupBy("block").applyInPandas(best, "block int, place binary, vec_id binary, score binary, floor binary, last binary"))
        done += more

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 1):
            who = numbers(batch["query_ids"][0], np.int64)[numbers(batch["place"][0], np.int32)]
            score = numbers(batch["score"][0], np.float64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(numbers(batch["vec_id"][0], np.int64)), pa.array(score)], ["query_id", "vec_id", "score"])

    found = state.join(asked.hint("merge"), "block").select("query_ids", "place", "vec_id", "score").mapInArrow(unpack, "query_id bigint, vec_id bigint, score bigint")
    return _best(found, k, F.desc("score"))


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(table(spark, sf_dir, "embeddings"), zero=False)
    return nearest_neighbours(rows, rows.where("vec_id % 50 = 0"))


def op9_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(table(spark, sf_dir, "embeddings"), zero=True)
    return top_products(rows, rows.where("vec_id % 20 = 0"))

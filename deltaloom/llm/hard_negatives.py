"""Hard negatives by distributed radix selection: rows of other labels whose scores lie in a window below a positive's.

Anchors and what they ask go in blocks, rows in shards; a block meets each shard through an equi-join on its number, so a
task holds one block and one shard. Scores are integers, far too many to be kept, and are worked out anew in each round:

* a window (an anchor's range of scores) begins as a range of so many bits. A counting round yields, for each window and
  shard, a histogram of the scores' next digit from the top, which Spark adds up. The digit in which the count reaches k
  becomes the window's range, until so few rows are left at or above it that they can be taken, or no digit is left;
* a gathering round then yields only the rows that qualify, and their order decides.

The digits after the one in which a shard's own count reaches k can't hold the kth score, so a shard doesn't send them, and
of rows that tie at the last digit a shard sends no more than k, those of the smallest ids. Positives are found in the same
way, by a window over all scores that rows of the anchor's label can have.

Defined results: rows without an id, a label or a vector, or with null or non-finite components, take no part, nor do
vectors of another length than the commonest. Rows that repeat are candidates each, and anchors each; a row's own id is
never its positive. A positive whose score is negative has an empty window. An empty table gives an empty one; other
columns play no part. Scores must stay below 2^53 in size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deltaloom.llm.common import chunks, ship, table, written

#: Bits of a digit.
DIGIT = 8
#: A state has, for each block, its anchors and these arrays, an entry for each window: the anchor's place, the least and
#: largest score, what the digits known so far begin at (counted down from the largest score), the bits that are open, how
#: many rows lie above, and the positive's id and score. open tells how many windows have bits to refine. A shard has the
#: arrays of SHARDS.
ANCHORS = {"ids": np.int64, "labels": np.int64, "x": np.float64}
SHARDS = {"ids": np.int64, "labels": np.int64, "x": np.float64}
WINDOWS = {"place": np.int32, "low": np.int64, "high": np.int64, "base": np.int64, "bits": np.int32, "above": np.int64, "todo": np.bool_, "positive": np.int64, "score": np.int64}
STATE = "block int, " + ", ".join(f"{c} binary" for c in [*ANCHORS, *WINDOWS]) + ", open bigint"
RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def usable(rows: DataFrame, label: Column, scale: float) -> DataFrame:
    """vec_id, label and v (floor(scale * component), doubles) of the rows (vec_id, embedding, ...) that take part."""
    ship(rows.sparkSession)
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & good)
    width = rows.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").limit(1).first()
    return rows.where(F.size("v") == (width["size"] if width else 0)).withColumn("v", F.transform("v", lambda x: F.floor(x * F.lit(scale)).cast("double")))


def packed(state: dict[str, np.ndarray], block: int) -> pd.DataFrame:
    """One row of STATE."""
    kinds = ANCHORS | WINDOWS
    return pd.DataFrame({"block": [block]} | {c: [np.ascontiguousarray(state[c], kind).tobytes()] for c, kind in kinds.items()} | {"open": [int(state["todo"].sum())]})


def unpacked(row: dict, kinds: dict) -> dict[str, np.ndarray]:
    return {c: np.frombuffer(row[c] or b"", kind) for c, kind in kinds.items()}


def fresh(place: np.ndarray, low: np.ndarray, high: np.ndarray, positive: np.ndarray, score: np.ndarray) -> dict[str, np.ndarray]:
    """Windows with all bits open; empty ones are left out."""
    some = low <= high
    place, low, high, positive, score = (v[some] for v in (place, low, high, positive, score))
    bits = np.array([int(n).bit_length() for n in high - low], np.int32)
    zero = np.zeros(len(place), np.int64)
    return {"place": place, "low": low, "high": high, "base": zero, "bits": bits, "above": zero, "todo": bits > 0, "positive": positive, "score": score}


def eligible(state: dict[str, np.ndarray], shard: dict[str, np.ndarray], same: bool, only: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(window, scores, ids) for each window of only: the shard's rows with the anchor's label and another id (same), or with
    another label, within the window's scores."""
    n = len(state["ids"])
    x, anchors = shard["x"].reshape(len(shard["ids"]), -1), state["x"].reshape(n, -1)
    windows = np.flatnonzero(only)
    windows = windows[np.argsort(state["place"][windows], kind="stable")]
    places = state["place"][windows]
    for at in range(0, len(windows), 512):
        own = np.unique(places[at : at + 512])
        product = anchors[own] @ x.T
        for row, place in enumerate(own.tolist()):
            label = shard["labels"] == state["labels"][place]
            good = np.flatnonzero(label & (shard["ids"] != state["ids"][place]) if same else ~label)
            scores, ids = product[row, good].astype(np.int64), shard["ids"][good]
            for w in windows[at : at + 512][places[at : at + 512] == place].tolist():
                inside = (scores >= state["low"][w]) & (scores <= state["high"][w])
                yield w, scores[inside], ids[inside]


def meetings(state: DataFrame, shards: DataFrame, count: int) -> DataFrame:
    """Each block of a state beside each of count shards (columns shard_...), a row for each two.

    The rows of both sides are shuffled: what Spark expects of the blocks' size is that of one copy, so it would broadcast
    the copies for all shards, whose size grows with the square of the input, by way of the driver."""
    every = state.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    own = shards.select("shard", *[F.col(c).alias(f"shard_{c}") for c in SHARDS])
    return every.repartition(2 * count, "shard").join(own.hint("merge"), "shard").drop("shard", "open")


def select(state: DataFrame, shards: DataFrame, count: int, k: int, same: bool, most: int) -> DataFrame:
    """block, w, vec_id, score: the first k rows of each window, by the largest score, then the smallest id.

    state: rows of STATE. A window is refined until at most most rows lie in or above its digit."""
    kinds = ANCHORS | WINDOWS

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict, dict]]:
        for batch in chunks(batches, 1):
            row = {c: batch[c][0].as_py() for c in batch.schema.names}
            yield row["block"], unpacked(row, kinds), unpacked({c: row[f"shard_{c}"] for c in SHARDS}, SHARDS)

    def count_digits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, windows, shard in parts(batches):
            which, digits, times = [], [], []
            for w, scores, _ in eligible(windows, shard, same, windows["todo"]):
                bits = int(windows["bits"][w])
                place = windows["high"][w] - scores - windows["base"][w]
                n = np.bincount(place[(place >= 0) & (place < 1 << bits)] >> max(0, bits - DIGIT))
                some = np.flatnonzero(n)
                some = some[: np.searchsorted(np.cumsum(n[some]), k - windows["above"][w]) + 1]
                which.append(np.full(len(some), w, np.int32))
                digits.append(some.astype(np.int32))
                times.append(n[some])
            if which:
                which = np.concatenate(which)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(which), block, np.int32)), pa.array(which), pa.array(np.concatenate(digits)), pa.array(np.concatenate(times))], ["block", "w", "digit", "n"])

    def refine(before: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        """A block's state after a round: each window's digit in which the kth score lies becomes its range."""
        if not len(before):
            return pd.DataFrame({c.split()[0]: [] for c in STATE.split(", ")})
        row = before.iloc[0].to_dict()
        now = {c: v.copy() for c, v in unpacked(row, kinds).items()}
        w, digit, n = (counts.sort_values(["w", "digit"])[c].to_numpy(np.int64) for c in ("w", "digit", "n"))
        first = np.searchsorted(w, np.arange(len(now["place"]) + 1))
        for at in np.flatnonzero(now["todo"]).tolist():
            a, b = first[at], first[at + 1]
            total = np.cumsum(n[a:b])
            hit = int(np.searchsorted(total, k - now["above"][at]))
            if hit == len(total):  # fewer than k in all: the window's whole range qualifies
                now["todo"][at] = False
                continue
            shift = max(0, int(now["bits"][at]) - DIGIT)
            now["above"][at] += total[hit] - n[a + hit]
            now["base"][at] += int(digit[a + hit]) << shift
            now["bits"][at] = shift
            now["todo"][at] = shift > 0 and now["above"][at] + n[a + hit] > most
        return packed(now, int(row["block"]))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, windows, shard in parts(batches):
            every = np.ones(len(windows["place"]), bool)
            which, ids, found = [], [], []
            for w, scores, own_ids in eligible(windows, shard, same, every):
                good = windows["high"][w] - scores < windows["base"][w] + (1 << int(windows["bits"][w]))
                scores, own_ids = scores[good], own_ids[good]
                top = np.lexsort((own_ids, -scores))[:k]
                which.append(np.full(len(top), w, np.int32))
                ids.append(own_ids[top])
                found.append(scores[top])
            if which:
                which = np.concatenate(which)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(which), block, np.int32)), pa.array(which), pa.array(np.concatenate(ids)), pa.array(np.concatenate(found))], ["block", "w", "vec_id", "score"])

    while state.agg(F.sum("open")).first()[0]:
        digits = meetings(state.where("open > 0"), shards, count).mapInArrow(count_digits, "block int, w int, digit int, n bigint").groupBy("block", "w", "digit").agg(F.sum("n").alias("n"))
        refined = state.where("open > 0").groupBy("block").cogroup(digits.groupBy("block")).applyInPandas(refine, STATE)
        state = written(refined.unionByName(state.where("open = 0")))
    found = meetings(state, shards, count).mapInArrow(gather, "block int, w int, vec_id bigint, score bigint")
    turn = F.row_number().over(Window.partitionBy("block", "w").orderBy(F.desc("score"), "vec_id"))
    return written(found.withColumn("turn", turn).where(F.col("turn") <= k))


def mined(rows: DataFrame, anchors: DataFrame, positives: int = 5, k: int = 10, percent: tuple[int, int] = (30, 90), shard_rows: int = 8192, block: int = 512, most: int | None = None) -> DataFrame:
    """RESULT: for each anchor and each of its first positives the first k rows of other labels whose scores lie between
    these percentages of the positive's. rows and anchors: usable rows (vec_id, label, v)."""
    spark = rows.sparkSession
    whole = written(rows.select("vec_id", "label", "v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    total, longest = whole.agg(F.count(F.lit(1)), F.max(norm)).first()
    if not total:
        return spark.createDataFrame([], RESULT)
    shards = -(-total // shard_rows)
    numbers = {"ids": ("vec_id", np.int64), "labels": ("label", np.int64)}

    def arrays(frame: pd.DataFrame) -> dict[str, np.ndarray]:
        frame = frame.sort_values(["vec_id", "label"])
        return {c: frame[name].to_numpy(kind) for c, (name, kind) in numbers.items()} | {"x": np.array(frame["v"].tolist(), np.float64).reshape(len(frame), -1)}

    def shard_of(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": [int(frame["shard"].iloc[0])]} | {c: [v.tobytes()] for c, v in arrays(frame).items()})

    def ask_positives(frame: pd.DataFrame) -> pd.DataFrame:
        own = arrays(frame)
        bound = np.ceil(np.sqrt((own["x"] ** 2).sum(1)) * longest * (1 + 1e-9) + 1).astype(np.int64)
        none = np.zeros(len(bound), np.int64)
        return packed(own | fresh(np.arange(len(bound)), -bound, bound, none, none), int(frame["block"].iloc[0]))

    def ask_negatives(before: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        row = before.iloc[0].to_dict()
        own = unpacked(row, ANCHORS | WINDOWS)
        found = found.sort_values(["w", "turn"])
        score = found["score"].to_numpy(np.int64)
        low, high = -((-percent[0] * score) // 100), percent[1] * score // 100
        return packed({c: own[c] for c in ANCHORS} | fresh(own["place"][found["w"].to_numpy(np.int64)], low, high, found["vec_id"].to_numpy(np.int64), score), int(row["block"]))

    def told(before: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        own = unpacked(before.iloc[0].to_dict(), ANCHORS | WINDOWS) if len(before) else None
        w = found["w"].to_numpy(np.int64)
        if own is None or not len(w):
            return pd.DataFrame({c.split()[0]: [] for c in RESULT.split(", ")})
        return pd.DataFrame({
            "anchor_id": own["ids"][own["place"][w]], "positive_id": own["positive"][w], "rank": found["turn"].to_numpy(np.int32), "negative_id": found["vec_id"].to_numpy(np.int64),
            "positive_score": own["score"][w], "negative_score": found["score"].to_numpy(np.int64),
        })

    # by the row's place in the written table: rows that repeat an id spread like all others
    dealt = whole.withColumn("shard", F.pmod(F.xxhash64(F.lit(51), F.monotonically_increasing_id()), F.lit(shards)).cast("int"))
    shards_ = written(dealt.groupBy("shard").applyInPandas(shard_of, "shard int, ids binary, labels binary, x binary"))
    asked = written(anchors.select("vec_id", "label", "v"))
    blocks = max(1, -(-asked.count() // block))
    asked = asked.withColumn("block", F.pmod(F.xxhash64(F.lit(52), F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))
    state = written(asked.groupBy("block").applyInPandas(ask_positives, STATE))
    found = select(state, shards_, shards, positives, True, most or 8 * positives)
    state = written(state.groupBy("block").cogroup(found.groupBy("block")).applyInPandas(ask_negatives, STATE))
    found = select(state, shards_, shards, k, False, most or 8 * k)
    return state.groupBy("block").cogroup(found.groupBy("block")).applyInPandas(told, RESULT)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = usable(table(spark, sf_dir, "embeddings"), label, 256.0)
    return mined(rows, rows.where("vec_id % 100 = 0"))

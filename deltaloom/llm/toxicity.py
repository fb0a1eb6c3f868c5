"""Toxicity by gradient-boosted trees over dense features of whole texts, with isotonic calibration.

Learning takes a bounded sample of labelled documents, those of least hash, one row of each, in three folds: the first gives the lexicon,
words and word beginnings that toxic documents surely have far more often than others, in two tiers; the second the trees, so that they see lexicon words as
often as new texts hold them; the third the calibration. Features are counts and rates of lexicon words, plain and in
disguise (digits, symbols or dots in place of letters), near second-person words, of capitals, punctuation and mixed
words. Features are computed on the executors; the driver only sees numbers.

Defined results: null and empty texts are scored as texts without words; documents without a label or a key are scored,
not learned from; of rows with one key the one whose text has the least hash is learned from, and of its labels the
greatest; without labels of both kinds every score is the share of toxic labels (0 without any); rows that
repeat are scored one by one; an empty table gives an empty one; other columns play no part.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deltaloom.llm.common import chunks, learned_from, ship, table, written

TOKEN = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
#: Words with a digit, symbol or dot between or before letters, which may hide a lexicon word, of any length.
DISGUISED = re.compile(r"(?<!\S)(?=\S*[A-Za-z])(?=\S*[0-9@$!*.\-_|+])[\w@$!*.\-|+]{3,}")
#: What these stand for in disguised words; 1 and the bar are read both ways.
READINGS = tuple(str.maketrans("013457@$!|+", f"o{i}eastasi{i}t") for i in "li")
#: Second-person words of the corpus's languages.
SECOND_PERSON = frozenset("you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine sie ihr ihnen usted ustedes ti tus vosotros".split())
NEAR = 5
UPPER = bytes(range(65, 91))
PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
STEMS = range(3, 8)
FEATURES = ("hits", "density", "kinds", "weak_hits", "weak_density", "disguised", "near_second", "second_rate", "capital_rate", "punctuation_rate", "exclamation_rate", "mixed_rate", "log_words", "mean_word")


class Lexicon:
    """Grams, whole words (after a =) and word beginnings, each in tier 2 (strong) or 1."""

    def __init__(self, tiers: dict[str, int]) -> None:
        self.tiers, self.cache = tiers, {}

    def __getstate__(self) -> dict:
        return {"tiers": self.tiers, "cache": {}}

    def tier(self, word: str) -> int:
        found = self.cache.get(word)
        if found is None:
            if len(self.cache) > 200_000:
                self.cache = {}
            found = self.cache[word] = max(self.tiers.get(g, 0) for g in grams(word))
        return found


def grams(word: str) -> list[str]:
    return ["=" + word, *(word[:n] for n in STEMS if len(word) >= n)]


def features(text: object, lexicon: Lexicon) -> list[float]:
    text = text if isinstance(text, str) else ""
    words = TOKEN.findall(text.lower())
    raw, n = text.encode("utf-8", "replace"), max(1, len(words))
    tiers = list(map(lexicon.tier, words))
    strong, weak, near = tiers.count(2), tiers.count(1), 0
    second = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    kinds = len({w for w, t in zip(words, tiers, strict=True) if t == 2}) if strong else 0
    if strong and second:
        second, at = np.array(second), np.flatnonzero(np.array(tiers) == 2)
        gap = np.searchsorted(second, at)
        left, right = at - second[np.maximum(gap - 1, 0)], second[np.minimum(gap, len(second) - 1)] - at
        near = int(((np.abs(left) <= NEAR) | (np.abs(right) <= NEAR)).sum())
    mixed, hidden = DISGUISED.findall(text), 0
    for w in mixed:
        plain = w.lower().strip(".!-_*")
        if lexicon.tier(plain) < 2:
            hidden += any(lexicon.tier(w) == 2 or lexicon.tier(re.sub(r"[^a-z]", "", w)) == 2 for w in {plain.translate(r) for r in READINGS})
    size = max(1, len(raw))
    capitals = len(raw) - len(raw.translate(None, UPPER))
    marks = len(raw) - len(raw.translate(None, PUNCTUATION))
    return [
        strong, strong / n, kinds, weak, weak / n, hidden, near, len(second) / n, capitals / size, marks / size, raw.count(b"!") / size,
        len(mixed) / n, float(np.log1p(len(words))), len(raw) / n,
    ]


@dataclass
class Trees:
    """Boosted regression trees on the log odds: histogram splits by gradients and second derivatives."""

    rounds: int = 60
    depth: int = 3
    rate: float = 0.2
    bins: int = 64
    least: float = 5.0
    ridge: float = 1.0
    base: float = 0.0
    trees: list = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
        self.base = float(np.log(share / (1 - share)))
        cuts = [np.unique(np.quantile(c[c > c.min()] if (c > c.min()).any() else c, np.linspace(0, 1, self.bins - 1))) for c in x.T]
        cuts = [np.unique(np.append(np.nextafter(c.min(), np.inf), own)) for c, own in zip(x.T, cuts, strict=True)]
        binned = np.stack([np.searchsorted(own, c, "right") for c, own in zip(x.T, cuts, strict=True)], 1)
        width, score = max(len(c) for c in cuts) + 1, np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            g, h = p - y, np.maximum(p * (1 - p), 1e-6)
            nodes, leaf = [], np.zeros(len(y))

            def grow(rows: np.ndarray, level: int) -> int:
                own = len(nodes)
                nodes.append(None)
                total_g, total_h = g[rows].sum(), h[rows].sum()
                best = (1e-6, -1, -1)
                if level < self.depth and total_h > 2 * self.least * 0.01:
                    for j in range(x.shape[1]):
                        left_g = np.cumsum(np.bincount(binned[rows, j], g[rows], width))[:-1]
                        left_h = np.cumsum(np.bincount(binned[rows, j], h[rows], width))[:-1]
                        count = np.cumsum(np.bincount(binned[rows, j], minlength=width))[:-1]
                        gain = left_g**2 / (left_h + self.ridge) + (total_g - left_g) ** 2 / (total_h - left_h + self.ridge) - total_g**2 / (total_h + self.ridge)
                        gain[(count < self.least) | (len(rows) - count < self.least)] = -1
                        k = int(gain.argmax())
                        if gain[k] > best[0] and k < len(cuts[j]):
                            best = (float(gain[k]), j, k)
                if best[1] < 0:
                    value = float(-self.rate * total_g / (total_h + self.ridge))
                    nodes[own] = (-1, 0.0, 0, 0, value)
                    leaf[rows] = value
                else:
                    _, j, k = best
                    goes = binned[rows, j] <= k
                    nodes[own] = (j, float(cuts[j][k]), grow(rows[goes], level + 1), grow(rows[~goes], level + 1), 0.0)
                return own

            grow(np.arange(len(y)), 0)
            self.trees.append(nodes)
            score += leaf
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for nodes in self.trees:
            feature, cut, left, right, value = (np.array(c) for c in zip(*nodes, strict=True))
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                inner = feature[at] >= 0
                goes = x[np.arange(len(x)), np.maximum(feature[at], 0)] < cut[at]
                at = np.where(inner, np.where(goes, left[at], right[at]), at)
            out += value[at]
        return out


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the monotone fit of y on score, by pooling adjacent violators; each pool is held back towards one half
    by a half count of either label, so that no calibrated score is certain."""
    order = np.argsort(score, kind="stable")
    pools: list[list[float]] = []
    for s, v in zip(score[order].tolist(), y[order].tolist(), strict=True):
        pools.append([v, 1.0, s, s])
        while len(pools) > 1 and (pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1] or pools[-2][3] == pools[-1][2]):
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2], last[3]]
    xs, ys = [], []
    for total, n, a, b in pools:
        xs += [a, b]
        ys += [(total + 0.5) / (n + 1)] * 2
    return np.array(xs), np.maximum.accumulate(np.array(ys))


@dataclass
class Model:
    lexicon: Lexicon
    trees: Trees | None
    knots: tuple[np.ndarray, np.ndarray] | None
    share: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.share)
        margin = self.trees.margin(x)
        if self.knots is None:
            return 1 / (1 + np.exp(-margin))
        return np.interp(margin, *self.knots)


def feature_rows(docs: DataFrame, keep: str, lexicon: Lexicon) -> DataFrame:
    """docs (text and the columns of keep, a schema) with features x."""
    names = [c.split()[0] for c in keep.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            rows = [features(t, lexicon) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), pa.array(rows, pa.list_(pa.float64()))], [*names, "x"])

    ship(docs.sparkSession)
    return docs.select(*names, "text").mapInArrow(run, f"{keep}, x array<double>")


def gram_counts(docs: DataFrame) -> DataFrame:
    """(gram, n0, n1, n2, n3) with at least 3 toxic documents in all: how many documents of docs (text, y, half) have a
    gram, clean and toxic ones of half 0, then of half 1."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = [Counter() for _ in range(4)]
        for frame in frames:
            for text, y, half in zip(frame["text"], frame["y"], frame["half"], strict=True):
                counts[2 * half + (y > 0)].update({g for w in set(TOKEN.findall(text.lower() if isinstance(text, str) else "")) for g in grams(w)})
                if sum(map(len, counts)) > 500_000:
                    yield out(counts)
                    counts = [Counter() for _ in range(4)]
        yield out(counts)

    def out(counts: list[Counter]) -> pd.DataFrame:
        seen = list(set().union(*counts))
        return pd.DataFrame({"gram": pd.Series(seen, dtype=object)} | {f"n{i}": np.array([c[g] for g in seen], np.int64) for i, c in enumerate(counts)})

    ship(docs.sparkSession)
    each = docs.select("text", "y", "half").mapInPandas(run, "gram string, n0 bigint, n1 bigint, n2 bigint, n3 bigint")
    return each.groupBy("gram").agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in range(4)]).where("n1 + n3 >= 3")


def lexicons(counts: DataFrame, n: list[list[int]], most: int) -> list[Lexicon]:
    """The lexicons of half 0, of half 1 and of both: at most so many grams each, by the lower bound of their log odds,
    two standard errors below the estimate."""

    def sure(clean: str, toxic: str, totals: tuple[int, int]) -> Column:
        c, t = F.expr(clean), F.expr(toxic)
        bound = F.log((t + 0.5) / (totals[1] + 1)) - F.log((c + 0.5) / (totals[0] + 1)) - 2 * F.sqrt(1 / (t + 0.5) + 1 / (c + 0.5))
        return F.when((t >= 3) & (bound > 1), bound)

    both = (n[0][0] + n[1][0], n[0][1] + n[1][1])
    rated = counts.select("gram", sure("n0", "n1", tuple(n[0])).alias("s0"), sure("n2", "n3", tuple(n[1])).alias("s1"), sure("n0 + n2", "n1 + n3", both).alias("s2"))
    found = rated.where("coalesce(s0, s1, s2) is not null").orderBy(F.desc(F.greatest("s0", "s1", "s2")), "gram").limit(3 * most).collect()
    out = []
    for column in ("s0", "s1", "s2"):
        own = sorted(((-r[column], r["gram"]) for r in found if r[column] is not None))[:most]
        out.append(Lexicon({g: 2 if s < -2.5 else 1 for s, g in own}))
    return out


def fit(docs: DataFrame, labels: DataFrame, sample: int = 12_000, lexicon_grams: int = 3000) -> Model:
    """From docs (doc_id, text) and labels (doc_id, toxic): at most sample labelled documents, those of least hash, and
    one row of each, so the driver sees no more than sample rows of numbers."""
    chosen = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("y"))
    chosen = chosen.withColumn("h", F.xxhash64(F.lit(11), "doc_id")).orderBy("h", "doc_id").limit(sample)
    folds = F.pmod(F.xxhash64(F.lit(12), "doc_id"), F.lit(10)).cast("int")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = written(rows.select("text", F.col("y").cast("int").alias("y"), (folds % 2).alias("half"), (folds >= 8).alias("kept")))
    n = [[0, 0], [0, 0]]
    for r in rows.groupBy("half", "y").agg(F.count(F.lit(1)).alias("n")).collect():
        n[r["half"]][int(r["y"] > 0)] += r["n"]
    clean, toxic = n[0][0] + n[1][0], n[0][1] + n[1][1]
    share = toxic / max(1, clean + toxic)
    if not (clean and toxic):
        return Model(Lexicon({}), None, None, share)
    *halves, lexicon = lexicons(gram_counts(rows), n, lexicon_grams)
    seen = [feature_rows(rows.where(F.col("half") == half), "y int, kept boolean", halves[1 - half]).toPandas() for half in (0, 1)]
    seen = pd.concat(seen)
    x, y, kept = np.array(seen["x"].tolist(), float).reshape(-1, len(FEATURES)), seen["y"].to_numpy(float), seen["kept"].to_numpy(bool)
    order = np.lexsort((*x.T, y, kept))
    x, y, kept = x[order], y[order], kept[order]
    if len(set(y[~kept])) < 2:
        return Model(lexicon, None, None, share)
    trees = Trees().fit(x[~kept], y[~kept])
    return Model(lexicon, trees, isotonic(trees.margin(x[kept]), y[kept]) if len(set(y[kept])) == 2 else None, share)


def score(docs: DataFrame, model: Model, keep: str = "doc_id bigint, held_out boolean") -> DataFrame:
    """The columns of keep and score, from docs with those columns and text."""
    names = [c.split()[0] for c in keep.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            x = np.array([features(t, model.lexicon) for t in batch["text"].to_pylist()], float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), pa.array(model.score(x))], [*names, "score"])

    ship(docs.sparkSession)
    return docs.select(*names, "text").mapInArrow(run, f"{keep}, score double")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("held_out", ~learned_from(F.col("doc_id"), 5, 0))
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(learned_from(F.col("doc_id"), 5, 0))
    return score(docs, fit(docs, labels)).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

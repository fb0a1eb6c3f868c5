"""Language ID: averaged hashed subword embeddings, a linear softmax learned by stochastic gradient descent, and a
calibrated rejection.

A text is its letters, lowered, with one blank for each stretch of others, and its subwords are all runs of 2, 3 and 4
of these, hashed to rows of an embedding table. The text's vector is the mean of its subwords' embeddings; a linear
layer and a softmax give the languages. For prediction both are one table of a row of logits for each hash. Learning
takes a bounded sample of stretches of documents, those of least hash. A tenth of its documents is kept back to calibrate:
their stretches, whole and cut short, are texts in a language, and the same with their letters shuffled texts in none.
The temperature is what makes the likelihood of the former greatest. A text is rejected below a confidence that all but
``rejects`` of the former pass, or midway between the two where they lie apart.

Defined results: null texts and texts without a letter are ``und`` with score 0; documents without a lang or a key are
predicted, not learned from; rows that repeat an id are learned from once; with no language to learn all are ``und``; rows that repeat are predicted one by one; an
empty table gives an empty one; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deltaloom.llm.common import chunks, learned_from, ship, table, written

UNKNOWN = "und"
BUCKETS = 1 << 15
BLANK = 32


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def symbols(text: object, most: int) -> Iterator[np.ndarray]:
    """A text's letters, lowered, with one blank before, after and for each stretch of others, in pieces."""
    points = np.frombuffer((text if isinstance(text, str) else "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    blank, any_letter = np.array([BLANK], np.uint32), False
    for at in range(0, len(points), most):
        part = points[at : at + most]
        is_letter = letters()[part]
        if not any_letter and not is_letter.any():
            continue
        before = np.concatenate([[after_letter if any_letter else False], is_letter[:-1]])
        kept = np.where(is_letter, part, np.uint32(BLANK))[is_letter | before]
        yield kept if any_letter else np.concatenate([blank, kept])
        any_letter, after_letter = True, bool(is_letter[-1])
    if any_letter and after_letter:
        yield blank


def subwords(text: object, most: int = 1 << 20) -> Iterator[np.ndarray]:
    """The bucket of each subword of a text, worked out for so many characters at a time; where they are cut is no matter."""
    last = np.empty(0, np.uint32)
    for piece in symbols(text, most):
        kept, out = np.concatenate([last, piece]), []
        h = kept
        for n in (2, 3, 4):
            h = h[:-1] * np.uint32(0x01000193) ^ kept[n - 1 :] * np.uint32(0x9E3779B1)
            out.append((h ^ h >> np.uint32(15))[max(0, len(last) - n + 1) :] & np.uint32(BUCKETS - 1))
            if len(h) < 2:
                break
        last = kept[-3:]
        yield np.concatenate(out)


@dataclass
class Model:
    languages: list[str]
    logits: np.ndarray  # a row for each bucket
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, text: object) -> np.ndarray | None:
        """Of the languages, None without a letter."""
        total, count = np.zeros(len(self.languages)), 0
        for buckets in subwords(text):
            weight = np.bincount(buckets, minlength=BUCKETS) if len(buckets) > BUCKETS // 4 else None
            total += weight @ self.logits if weight is not None else self.logits[buckets].sum(0, dtype=np.float64)
            count += len(buckets)
        return _softmax((total / count + self.bias) / self.temperature) if count and self.languages else None


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def stretches(docs: DataFrame, size: int, each: int) -> DataFrame:
    """(lang, part, h, back: whether it is kept back) from docs (doc_id, lang, text): at most each stretches of so many characters of a document, from
    anywhere in it."""
    whole = F.greatest(F.lit(1), F.ceil(F.length("text") / size)).cast("int")
    place = F.pmod(F.xxhash64(F.lit(21), "doc_id", "_n"), F.col("_whole")).cast("int")
    return (
        docs.where("text is not null and lang is not null and doc_id is not null")
        .withColumns({"_whole": whole})
        .withColumn("_n", F.explode(F.sequence(F.lit(1), F.least(F.lit(each), F.col("_whole")))))
        .select("lang", F.substring("text", place * size + 1, F.lit(size)).alias("part"), F.xxhash64(F.lit(22), "doc_id", "_n").alias("h"), (F.pmod(F.xxhash64(F.lit(23), "doc_id"), F.lit(10)) == 9).alias("back"))
    )


def fit(docs: DataFrame, sample: int = 16_000, size: int = 300, width: int = 16, passes: int = 5, rate: float = 2.0, rejects: float = 0.001, seed: int = 5) -> Model:
    """From docs (doc_id, lang, text): at most sample stretches of size characters, of the sample / 2 documents of least hash, each
    id once: of rows that repeat an id the one whose text and lang have the least hash."""
    good = docs.where("lang is not null and doc_id is not null and text is not null")
    ids = good.select("doc_id").distinct().withColumn("h", F.xxhash64(F.lit(20), "doc_id")).orderBy("h", "doc_id").limit(sample // 2)
    chosen = good.join(F.broadcast(ids.select("doc_id")), "doc_id", "left_semi")
    chosen = chosen.groupBy("doc_id").agg(F.min_by(F.struct("lang", "text"), F.struct(F.xxhash64("text", "lang"), "lang", "text")).alias("row")).select("doc_id", "row.*")
    rows = stretches(chosen, size, 4).orderBy("h", "lang", "part").limit(sample).select("lang", "part", "back").collect()
    rows = [(r["lang"], r["part"], r["back"], np.concatenate(own)) for r in rows if (own := [*subwords(r["part"])])]
    languages = sorted({r[0] for r in rows})
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, 0.0)
    y = np.array([languages.index(r[0]) for r in rows])
    back = np.array([r[2] for r in rows]) if len(rows) >= 100 else np.zeros(len(rows), bool)
    table_, top, bias = _learn([r[3] for r, b in zip(rows, back, strict=True) if not b], y[~back], len(languages), width, passes, rate, seed)
    model = Model(languages, (table_ @ top).astype(np.float32), bias, 1.0, 0.0)
    if back.any() and len(languages) > 1:
        _calibrate(model, [r[1] for r, b in zip(rows, back, strict=True) if b], y[back], rejects, seed)
    return model


def cuts(texts: list[str], y: np.ndarray, lengths: tuple[int, ...] = (24, 48, 96)) -> tuple[list[str], np.ndarray]:
    """Each text whole, and its beginning at each length that it has."""
    found = [(t[:n], k) for t, k in zip(texts, y.tolist(), strict=True) for n in (*lengths, len(t)) if n <= len(t)]
    return [t for t, _ in found], np.array([k for _, k in found], np.int64)


def _calibrate(model: Model, texts: list[str], y: np.ndarray, rejects: float, seed: int) -> None:
    """Sets the temperature and the threshold by texts that the model hasn't seen, and by the same without their order."""
    random = np.random.default_rng(seed)
    texts, y = cuts(texts, y)
    junk = ["".join(random.permutation(list(t))) for t in texts]

    def logits(of: list[str]) -> tuple[np.ndarray, np.ndarray]:
        bags = [[*subwords(t)] for t in of]
        some = np.array([bool(b) for b in bags], bool)
        return np.array([model.logits[np.concatenate(b)].mean(0) + model.bias for b in bags if b]).reshape(-1, len(model.languages)), some

    z, some = logits(texts)
    none, _ = logits(junk)
    y = y[some]

    loss = lambda t: -np.log(_softmax(z / t)[np.arange(len(z)), y] + 1e-12).mean()
    model.temperature = float(min(np.geomspace(0.005, 50, 120), key=loss))
    sure, unsure = (_softmax(x / model.temperature).max(1) for x in (z, none))
    low, high = float(np.quantile(sure, rejects)), float(np.quantile(unsure, 1 - rejects))
    model.threshold = min(low, (low + high) / 2)


def _learn(bags: list[np.ndarray], y: np.ndarray, classes: int, width: int, passes: int, rate: float, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embeddings, linear layer and bias by minibatch gradient descent on the cross entropy, with a falling rate."""
    random = np.random.default_rng(seed)
    table_, top, bias = random.normal(0, 0.1, (BUCKETS, width)), random.normal(0, 0.1, (width, classes)), np.zeros(classes)
    size, steps = 32, 0
    every = passes * -(-len(y) // size)
    counted = [np.unique(b, return_counts=True) for b in bags]
    for _ in range(passes):
        order = random.permutation(len(y))
        for at in range(0, len(y), size):
            now, steps = rate * (1 - steps / every), steps + 1
            own = order[at : at + size]
            hit, place = np.unique(np.concatenate([counted[i][0] for i in own]), return_inverse=True)
            rows = np.repeat(np.arange(len(own)), [len(counted[i][0]) for i in own])
            share = np.zeros((len(own), len(hit)))  # of each subword in each text
            share[rows, place] = np.concatenate([counted[i][1] / len(bags[i]) for i in own])
            mean = share @ table_[hit]
            error = _softmax(mean @ top + bias)
            error[np.arange(len(own)), y[own]] -= 1
            error /= len(own)
            back = error @ top.T
            top -= now * mean.T @ error
            bias -= now * error.sum(0)
            # the mean spreads a text's gradient thinly over its subwords, so their rate is larger
            table_[hit] -= 50 * now * share.T @ back
    return table_, top, bias


def predict(docs: DataFrame, model: Model, keep: str = "doc_id bigint, held_out boolean", threshold: float = 0.0) -> DataFrame:
    """The columns of keep, lang_pred and score from docs with those columns and text; below threshold it is ``und``."""
    names = [c.split()[0] for c in keep.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            found, sure = [], []
            for text in batch["text"].to_pylist():
                p = model.probabilities(text)
                best = None if p is None else int(p.argmax())
                sure.append(0.0 if p is None else float(p[best]))
                found.append(UNKNOWN if p is None or p[best] < threshold else model.languages[best])
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), pa.array(found, pa.string()), pa.array(sure, pa.float64())], [*names, "lang_pred", "score"])

    ship(docs.sparkSession)
    return docs.select(*names, "text").mapInArrow(run, f"{keep}, lang_pred string, score double")


def identified(docs: DataFrame) -> DataFrame:
    """docs without those that language ID rejects: texts without letters, and texts less sure than the calibrated
    threshold. All columns stay; one pass."""
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    model, at = fit(named), docs.columns.index("text")
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            sure = [model.probabilities(text) for text in batch.column(at).to_pylist()]
            yield batch.filter(pa.array([p is not None and float(p.max()) >= model.threshold for p in sure], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    learned = learned_from(F.col("doc_id"), 3, 1)
    return predict(docs.withColumn("held_out", ~learned), fit(docs.where(learned)))

"""Toxicity, language ID and the n-gram model."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from deltaloom.llm import language, ngrams, toxicity
from deltaloom.llm.common import learned_from

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def counted(rows, out, n, backoff):
    """(doc_id, held out, tokens, known, N) to base and score of rows (doc_id, words), from plain counts of all k-grams."""
    grams = [collections.Counter() for _ in range(n + 1)]
    follow = [collections.Counter() for _ in range(n + 1)]
    events = lambda w: [(*["begin"] * (n - 1), *w, "end")[i : i + n] for i in range(len(w) + 1)]
    for key, w in rows:
        for e in events(w) if not out(key) else []:
            for k in range(1, n + 1):
                grams[k][e[n - k :]] += 1
                follow[k][e[n - k : -1]] += 1
    total, kinds, found = sum(grams[1].values()), len(grams[1]), []
    for key, w in rows:
        base = score = known = 0
        for e in events(w):
            p = (grams[1][e[-1:]] + 1) / (total + kinds + 1)
            base, known = base + math.log10(p), known + (grams[1][e[-1:]] > 0)
            for k in range(2, n + 1):
                if c := follow[k][e[n - k : -1]]:
                    a, b = backoff[min(k - 2, len(backoff) - 1)]
                    p = (1 - a * c**-b) * grams[k][e[n - k :]] / c + a * c**-b * p
            score += math.log10(p)
        found.append(((str(key), out(key), len(w) + 1, known, total), round(base, 6), score))
    return sorted(found)


@pytest.mark.parametrize(("order", "hot"), [(2, 200_000), (2, 3), (3, 200_000), (3, 4), (4, 6)])
def test_ngrams_against_counts(awkward, nothing, order, hot):
    held, backoff = ~learned_from(F.col("doc_id"), 7, 2), ((0.9, 0.1), (0.75, 0.15))
    got = ngrams.score(awkward.repartition(3), held, order=order, hot=hot, backoff=backoff, block_bytes=4000).collect()
    got = sorted(((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]), round(r["base_score"], 6), r["score"]) for r in got)
    rows = [(r["doc_id"], WORD.findall((r["text"] or "").encode().lower())) for r in awkward.collect()]
    want = counted(rows, lambda k: k is not None and zlib.crc32(str(k).encode()) % 7 == 2, order, backoff)
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert all(abs(x[2] - y[2]) <= 0.001 + 0.0002 * order * x[0][2] for x, y in zip(got, want, strict=True))
    assert ngrams.score(nothing, held, order=order).count() == 0


def test_scores_of_held_out_texts_rise_with_the_order(spark):
    rng = random.Random(4)
    after = {(a, b): [f"w{rng.randrange(40)}" for _ in range(3)] for a in range(40) for b in range(40)}
    rows = []
    for i in range(400):
        words = ["w1", "w2"]
        while len(words) < 60:
            words.append(rng.choice(after[int(words[-2][1:]), int(words[-1][1:])]))
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    sums = []
    for order in (2, 3):
        r = ngrams.score(docs, ~learned_from(F.col("doc_id"), 7, 2), order=order).where("held_out").agg(F.sum("base_score"), F.sum("score")).first()
        sums += list(r)
    assert sums[0] == pytest.approx(sums[2]) and sums[0] < sums[1] < sums[3]


@pytest.mark.parametrize("size", [0, 1, 2, 500])
def test_elias_fano(size):
    rng = np.random.default_rng(size)
    values = np.unique(np.concatenate([rng.integers(0, 1 << 40, size), rng.integers(0, 1000, size)]).astype(np.uint64))
    ef = ngrams.EliasFano(ngrams.EliasFano.arrays("x", values), "x")
    if len(values):
        assert (ef[np.arange(len(values))] == values).all()
    ask = np.concatenate([values, values + np.uint64(1), np.array([0, 1 << 50], np.uint64)])
    place = {int(v): i for i, v in enumerate(values)}
    assert ef.find(ask).tolist() == [place.get(int(a), -1) for a in ask]


def test_trie():
    rng = random.Random(1)
    grams = sorted({(rng.randrange(9), rng.randrange(30), rng.randrange(50)) for _ in range(400)})
    prefixes = [sorted({g[: k + 1] for g in grams}) for k in range(3)]
    codes = [np.arange(1, len(p) + 1) for p in prefixes]
    arrays, file = ngrams.mapped(ngrams.Trie.arrays([np.array(c) for c in zip(*grams, strict=True)], codes))
    with file:
        trie = ngrams.Trie(arrays, 3)
        ask = [(a, b, c) for a in range(11) for b in range(33) for c in range(0, 60, 3)]
        found = trie.nodes([np.array(c) for c in zip(*ask, strict=True)])
        for k in range(3):
            place = {p: i for i, p in enumerate(prefixes[k])}
            assert found[k].tolist() == [place.get(p, -1) for p in sorted({g[: k + 1] for g in ask})]
            assert trie.chances[k].tolist() == codes[k].tolist()


def toxic_corpus(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(900):
        bad = i % 5 == 0
        words = [rng.choice(["house", "tree", "walk", "you", "green", "loud", "paper"]) + rng.choice(["", "s", "er"]) for _ in range(rng.randint(8, 60))]
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["blorkish", "zugfart", "vexnoid"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_toxicity(spark, awkward, nothing):
    docs, labels = toxic_corpus(spark)
    held = ~learned_from(F.col("doc_id"), 5, 0)
    model = toxicity.fit(docs, labels.where(~held))
    got = toxicity.score(docs.withColumn("held_out", held), model).join(labels, "doc_id").where("held_out").collect()
    right = sum((r["score"] >= 0.5) == bool(r["toxic"]) for r in got)
    assert len(got) > 100 and right / len(got) > 0.95 and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.features("b.l.o.r.k.i.s.h you ZUGF4RT!", model.lexicon)[5] >= 1
    rows = awkward.select("doc_id", "text").withColumn("held_out", F.lit(False))
    assert toxicity.score(rows, model).where("score between 0 and 1").count() == awkward.count()
    unlabelled = toxicity.fit(docs, labels.limit(0))
    assert toxicity.score(rows, unlabelled).where("score = 0").count() == awkward.count()
    assert toxicity.score(nothing.select("doc_id", "text").withColumn("held_out", F.lit(False)), model).count() == 0


def test_isotonic_is_monotone():
    rng = np.random.default_rng(0)
    score = rng.normal(size=400)
    y = (rng.random(400) < 1 / (1 + np.exp(-2 * score))).astype(float)
    x, v = toxicity.isotonic(score, y)
    assert (np.diff(v) >= 0).all() and (np.diff(x) >= 0).all() and 0 < v[0] < v[-1] < 1


def test_language(spark, awkward, nothing):
    rng = random.Random(4)
    syllables = {"aa": ["ka", "lo", "mi", "ta"], "bb": ["sch", "ung", "ein", "ver"], "cc": ["ção", "os", "nh", "ei"]}
    rows = [(i, lang, " ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(3, 60)))) for i in range(600) for lang in [rng.choice([*syllables])]]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string").withColumn("held_out", ~learned_from(F.col("doc_id"), 3, 1))
    model = language.fit(docs.where("not held_out"))
    got = language.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 100 and sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.98
    odd = {r["doc_id"]: r for r in language.predict(awkward.withColumn("held_out", F.lit(False)), model).collect()}
    assert {odd[i]["lang_pred"] for i in (201, 202, 203, 312)} == {"und"} and odd[201]["score"] == 0 and odd[311]["lang_pred"] in syllables
    kept = language.identified(awkward)
    assert kept.columns == awkward.columns and not {201, 202, 203, 312} & {r["doc_id"] for r in kept.collect()}
    assert kept.count() > 60 and language.identified(nothing).count() == 0
    assert language.predict(awkward.withColumn("held_out", F.lit(False)), language.fit(nothing)).where("lang_pred = 'und'").count() == awkward.count()


def test_a_repeated_id_is_one_row_of_the_sample(spark):
    docs, labels = toxic_corpus(spark)
    hot = docs.unionByName(spark.range(3000).select(F.lit(0).cast("bigint").alias("doc_id"), F.concat(F.lit("blorkish tree "), "id").alias("text")))
    seen = []
    rows = toxicity.feature_rows
    toxicity.feature_rows = lambda frame, *rest: seen.append(frame.count()) or rows(frame, *rest)
    try:
        model = toxicity.fit(hot, labels, sample=200)
    finally:
        toxicity.feature_rows = rows
    assert sum(seen) == 200 and model.trees is not None


def test_features_against_plain_counts():
    lexicon = toxicity.Lexicon({"=zugfart": 2, "vex": 2, "=meh": 1})
    rng = random.Random(7)
    words = ["zugfart", "vexing", "meh", "you", "your", "Tree", "z-u-g-f-a-r-t", "v3xing", "x1", "HI!", "...", "we're", "v" * 60 + "1"]
    for _ in range(200):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 25)))
        tokens = toxicity.TOKEN.findall(text.lower())
        strong, weak = [i for i, w in enumerate(tokens) if w == "zugfart" or w.startswith("vex")], [i for i, w in enumerate(tokens) if w == "meh"]
        second = [i for i, w in enumerate(tokens) if w in toxicity.SECOND_PERSON]
        raw, n = text.encode(), max(1, len(tokens))
        got = dict(zip(toxicity.FEATURES, toxicity.features(text, lexicon), strict=True))
        assert got["hits"] == len(strong) and got["weak_hits"] == len(weak) and got["kinds"] == len({tokens[i] for i in strong})
        assert got["near_second"] == sum(any(abs(i - j) <= toxicity.NEAR for j in second) for i in strong)
        assert got["density"] == len(strong) / n and got["second_rate"] == len(second) / n
        assert got["disguised"] == sum(w in ("z-u-g-f-a-r-t", "v3xing") for w in text.split())
        assert got["capital_rate"] == sum(65 <= b <= 90 for b in raw) / max(1, len(raw))
        assert got["punctuation_rate"] == sum(33 <= b < 127 and not chr(b).isalnum() for b in raw) / max(1, len(raw))


def test_the_first_tree_against_all_splits():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 6, size=(300, 3)).astype(float)
    y = ((x[:, 1] > 2) ^ (rng.random(300) < 0.1)).astype(float)
    model = toxicity.Trees(rounds=1, depth=1).fit(x, y)
    p = y.mean()
    g, h = p - y, np.full(len(y), p * (1 - p))
    gain = lambda m: g[m].sum() ** 2 / (h[m].sum() + model.ridge)
    best = max(((gain(x[:, j] < c) + gain(x[:, j] >= c), j, c) for j in range(3) for c in range(1, 6) if 5 <= (x[:, j] < c).sum() <= 295), key=lambda t: t[0])
    left = x[:, best[1]] < best[2]
    value = lambda m: -model.rate * g[m].sum() / (h[m].sum() + model.ridge)
    want = model.base + np.where(left, value(left), value(~left))
    assert model.trees[0][0][0] == best[1] == 1 and np.allclose(model.margin(x), want)


def test_a_step_of_the_embeddings_against_differences(monkeypatch):
    monkeypatch.setattr(language, "BUCKETS", 12)
    rng = np.random.default_rng(3)
    bags, y = [rng.integers(0, 12, n) for n in (4, 7, 1)], np.array([0, 2, 1])
    table, top, bias = language._learn(bags, y, 3, 5, 1, 0.5, 9)
    first = np.random.default_rng(9)
    table0, top0, bias0 = first.normal(0, 0.1, (12, 5)), first.normal(0, 0.1, (5, 3)), np.zeros(3)

    def loss(a, b, c):
        return -np.mean([np.log(language._softmax(a[bag].mean(0) @ b + c)[k]) for bag, k in zip(bags, y, strict=True)])

    def slopes(i):
        out, given = np.zeros_like((table0, top0, bias0)[i]), [table0, top0, bias0]
        for at in np.ndindex(out.shape):
            pair = []
            for step in (1e-6, -1e-6):
                moved = given[i].copy()
                moved[at] += step
                pair.append(loss(*[moved if j == i else x for j, x in enumerate(given)]))
            out[at] = (pair[0] - pair[1]) / 2e-6
        return out

    assert np.allclose(top, top0 - 0.5 * slopes(1), atol=1e-7) and np.allclose(bias, bias0 - 0.5 * slopes(2), atol=1e-7)
    assert np.allclose(table, table0 - 25 * slopes(0), atol=1e-5)


def test_where_a_long_text_is_cut_is_no_matter():
    rng = random.Random(2)
    for _ in range(100):
        text = "".join(rng.choice("abcé 1.\n") for _ in range(rng.randint(0, 60)))
        whole = np.sort(np.concatenate([np.empty(0, np.uint32), *language.subwords(text)]))
        for most in (1, 2, 5, 16):
            assert np.sort(np.concatenate([np.empty(0, np.uint32), *language.subwords(text, most)])).tolist() == whole.tolist()


def test_calibrated_confidence_and_junk(spark):
    rng = random.Random(11)
    parts = {"xx": ["ka", "lo", "mi", "tu", "re"], "yy": ["sch", "ung", "ver", "ein", "zu"], "zz": ["qui", "ox", "et", "um", "ae"]}
    rows = []
    for i in range(900):
        lang = rng.choice([*parts])
        words = ["".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(3, 40))]
        rows.append((i, lang, " ".join(words)))
    docs = spark.createDataFrame(rows[:700], "doc_id bigint, lang string, text string")
    model = language.fit(docs)
    found = [model.probabilities(t) for _, _, t in rows[700:]]
    right = np.array([model.languages[int(p.argmax())] == k for p, (_, k, _) in zip(found, rows[700:], strict=True)])
    sure = np.array([p.max() for p in found])
    bins = np.minimum((sure * 10).astype(int), 9)
    assert sum(abs(sure[bins == b].mean() - right[bins == b].mean()) * (bins == b).mean() for b in set(bins.tolist())) < 0.05
    assert 0.005 < model.temperature < 50 and (sure >= model.threshold).mean() >= 0.99
    junk = ["".join(rng.choice("bcdfghjknpqvwxyß") for _ in range(80)) for _ in range(50)]
    assert np.mean([model.probabilities(t).max() < model.threshold for t in junk]) >= 0.5


def test_a_repeated_id_is_learned_from_once(spark):
    """Four languages and many copies of one id: the copies don't crowd the others out."""
    rng = random.Random(6)
    words = {"en": "the and of with house water", "de": "der und von mit haus wasser", "fr": "le et de avec maison eau", "es": "el y con casa agua los"}
    rows = [(i, lang, " ".join(rng.choice(own.split()) for _ in range(60))) for i, (lang, own) in enumerate(list(words.items()) * 50)]
    least = 0
    copies = [(least, "en", "the and of " + "x" * (i % 7)) for i in range(4000)]
    docs = spark.createDataFrame(rows + copies, "doc_id bigint, lang string, text string")
    model = language.fit(docs, sample=400)
    assert model.languages == ["de", "en", "es", "fr"]
    again = language.fit(docs.repartition(7), sample=400)
    assert (again.logits == model.logits).all()


def test_each_reading_of_a_digit_in_disguised_words():
    lexicon = toxicity.Lexicon({"=twit": 2, "=idiot": 2, "=liar": 2})
    assert [toxicity.features(t, lexicon)[5] for t in ("7w17 said so", "1d10t said so", "l1ar said so", "|iar said so", "7777 said so")] == [1, 1, 1, 1, 0]

"""SimHash: fingerprints, and components against all pairs."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from deltaloom.llm import graph, simhash


def plain_fingerprint(text, words):
    found = [w for w in (text or "").encode().lower().replace(b"\n", b" ").replace(b"\t", b" ").split(b" ") if w]
    if not found:
        return 0
    parts = [b" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("words", [3, 5])
def test_fingerprints(awkward, words):
    for r in awkward.select("text").distinct().collect():
        assert simhash.fingerprint(r["text"], words) == plain_fingerprint(r["text"], words)


def test_a_shingle_is_spark_xxhash64(spark):
    text = "the quick fox"
    native = spark.createDataFrame([(text,)], "t string").select(F.xxhash64("t")).first()[0]
    assert xxhash.xxh64_intdigest(text.encode(), 42) == native % (1 << 64)


def groups_of(values, bits):
    root = list(range(len(values)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= bits:
                root[top(i)] = top(j)
    return [top(i) for i in range(len(values))]


@pytest.mark.parametrize(("bits", "segments"), [(2, 3), (3, 4), (7, 4), (5, 3)])
def test_components_against_all_pairs(spark, bits, segments):
    rng = random.Random(bits)
    values = {rng.getrandbits(64) for _ in range(60)}
    for seed in [*values][:6]:  # balls and long chains of near ones
        now = seed
        for _ in range(30):
            now ^= 1 << rng.randrange(64)
            values.add(now)
            values.add(seed ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64))
    values = sorted(values)
    frame = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp bigint").repartition(3)
    labels = {r["node"] % (1 << 64): r["label"] for r in graph.components(simhash.links(frame, bits, segments)).collect()}
    mine = [labels.get(v, ("own", v)) for v in values]
    want = groups_of(values, bits)
    assert len(set(zip(mine, want, strict=True))) == len(set(mine)) == len(set(want))


def test_long_runs_match_short_ones(monkeypatch):
    rng = np.random.default_rng(1)
    ring = simhash.Ring(2, 3)
    seed = np.uint64(12345)
    values = np.unique(seed ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)))
    keys = ring.keys(values)
    flat, own = keys.ravel(), np.repeat(values, keys.shape[1])
    order = np.argsort(flat, kind="stable")

    def joined(limit):
        monkeypatch.setattr(simhash, "SHORT_RUN", limit)
        a, b = simhash.bucket_links(flat[order], own[order], ring)
        root = {int(v): int(v) for v in values}

        def top(x):
            while root[x] != x:
                x = root[x]
            return x

        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            root[max(top(x), top(y))] = min(top(x), top(y))
        return [top(int(v)) for v in values]

    assert joined(64) == joined(2)


def test_awkward_rows(awkward, nothing):
    docs = awkward.select(F.col("doc_id").alias("key"), "text")
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == awkward.count()
    by = {(r["key"], r["fp"]): r["component"] for r in got}
    assert by[(201, 0)] == by[(202, 0)] == by[(203, 0)] == 201
    assert by[(301, [r["fp"] for r in got if r["key"] == 301][0])] == 300
    assert simhash.near_duplicates(nothing.select(F.col("doc_id").alias("key"), "text")).count() == 0
    kept = simhash.without_near_duplicates(awkward)
    assert kept.columns == awkward.columns and kept.where("doc_id in (200)").count() == 1 and kept.where("doc_id in (300, 301, 302)").count() == 1
    assert simhash.without_near_duplicates(nothing).count() == 0


def test_components_of_paths_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100), (200, 150), (150, 200), (150, 160)]
    got = {r["node"]: r["label"] for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert {got[i] for i in range(41)} == {0} and got[200] == got[160] == 150 and 100 not in got
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def roots_of(sets):
    """Of each set the smallest index that links of similarity 4/5 reach, from all pairs."""
    root = list(range(len(sets)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    return [top(i) for i in range(len(sets))]


def kept_ids(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    return sorted(r["doc_id"] for r in simhash.without_near_duplicates(frame).collect())


def wanted_ids(texts):
    words = [t.split() for t in texts]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in words]
    return [i for i, r in enumerate(roots_of(sets)) if r == i]


def test_stage_on_a_family_of_over_256(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    texts = []
    for i in range(420):  # at 0.65 to 0.95 to each other: many fail against a leader and link among themselves
        own, n = list(base), rng.randint(2, 13)
        for at in rng.sample(range(300), n):
            own[at] = f"x{i}.{at}"
        texts.append(" ".join(own))
    assert 1 < len(wanted_ids(texts)) < 420 and kept_ids(spark, texts) == wanted_ids(texts)


def test_stage_counts_a_repeated_line_once(spark):
    rng = random.Random(6)
    line = " ".join(f"l{i}" for i in range(24)) + " "
    make = lambda n: " ".join(f"w{rng.randrange(10**7)}" for _ in range(n)) + " "
    texts = [make(200) + line * 40 for _ in range(12)]
    own = make(200)
    texts += [own + line * 2, own + line * 60]
    assert wanted_ids(texts) == [*range(13)] and kept_ids(spark, texts) == [*range(13)]


def test_stage_against_all_pairs_from_70_to_90(spark):
    rng = random.Random(7)
    texts = []
    for i in range(400):
        words = [f"w{rng.randrange(10**7)}" for _ in range(rng.choice([8, 9, 12, 40, 104, 304]))]
        goal = 0.7 + 0.2 * i / 400  # of shingle sets, by replacing a tail
        n = len(words) - 4
        cut = round(n - 2 * goal / (1 + goal) * n)
        texts += [" ".join(words), " ".join(words[: len(words) - cut] + [f"y{i}.{j}" for j in range(cut)])]
    want = wanted_ids(texts)
    assert 500 < len(want) < 750 and kept_ids(spark, texts) == want


def test_sets_of_four_fifths_share_a_chain():
    rng = np.random.default_rng(8)
    draw = lambda k: np.unique(rng.integers(0, 1 << 64, k, dtype=np.uint64))
    for turn in range(1500):
        n = int(rng.choice([1, 2, 4, 5, 6, 7, 9, 13, 16, 26, 31, 32, 60, 64, 120, 127, 129, 250]))
        both = draw(n)
        allowed = len(both) // 4  # both of 4/5 of all: the most that the two may have besides
        left = int(rng.integers(0, allowed + 1)) if turn % 3 else 0
        x, y = np.union1d(both, draw(left)), np.union1d(both, draw(allowed - left))
        assert simhash.similar(x, y)
        for common in (np.empty(0, np.uint64), both, np.union1d(x, y), np.sort(rng.permutation(both)[: len(both) // 2])):
            keys = [simhash.chain_keys(s, simhash.rare_ones(s, common)) for s in (x, y)]
            assert len(np.intersect1d(*keys)), (len(both), left, allowed, len(common))
        assert 9 * int(np.bitwise_count(simhash.parities(x) ^ simhash.parities(y)).sum()) <= len(x) + len(y)


def test_stage_meets_small_sets_and_common_shingles(spark):
    rng = random.Random(9)
    lines = [" ".join(f"l{i}.{j}" for j in range(14)) for i in range(30)]
    texts = []
    for _ in range(120):  # texts of lines that many have, so that a shingle of their own is the exception
        words = " ".join(rng.sample(lines, rng.randint(1, 12))).split()
        texts += [" ".join(words), " ".join(words[: len(words) - rng.randint(0, 3)] + [f"z{rng.randrange(10**6)}"] * rng.randint(0, 2))]
    texts += [" ".join(f"s{i}.{j}" for j in range(n)) for i, n in enumerate([1, 3, 5, 8, 9, 10, 12] * 4)]
    texts += [t + " tail" for t in texts[-28:]]
    want = wanted_ids(texts)
    assert len(texts) // 4 < len(want) < len(texts) - 20 and kept_ids(spark, texts) == want


def family(seed, rows, most=9):
    """Texts of which many are a little below 4/5 to each other, and all share most of their shingles."""
    rng = random.Random(seed)
    base, texts = [f"w{rng.randrange(10**6)}" for _ in range(300)], []
    for i in range(rows):
        own = list(base)
        for at in rng.sample(range(300), rng.randint(2, most)):
            own[at] = f"x{i}.{at}"
        texts.append(" ".join(own))
    return texts


def test_stage_joins_rows_of_long_buckets_once(spark, monkeypatch):
    given, real = [], simhash.near_met

    def counted(met):
        given.append(met.count())
        return real(met)

    monkeypatch.setattr(simhash, "near_met", counted)
    texts = family(10, 60) + family(11, 60) + family(12, 60)
    assert kept_ids(spark, texts) == wanted_ids(texts)
    assert given[0] > 1000 and sum(given[1:]) <= given[0] // 10


def test_stage_with_rounds_of_leaders(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LISTED", 0)  # no bucket yields its pairs before the last round
    texts = family(13, 120, 13)
    want = wanted_ids(texts)
    assert 1 < len(want) < 120 and kept_ids(spark, texts) == want


def test_pairs_of_buckets_are_all_of_different_labels():
    rng = np.random.default_rng(14)
    key = np.sort(rng.integers(0, 4, 300))
    h = rng.integers(0, 1 << 64, 10, dtype=np.uint64) ^ (np.uint64(1) << rng.integers(0, 64, (300, 10)).astype(np.uint64))
    size, label = rng.integers(90, 130, 300), np.minimum(rng.integers(0, 12, 300), 6)
    found = [np.stack(p, 1) for p in simhash.bucket_pairs(key, h, size, label)]
    got = [tuple(sorted(p)) for p in np.concatenate(found).tolist()]
    x, y = np.triu_indices(300, 1)
    at = (key[x] == key[y]) & simhash.near_rows(h, size, label, x, y)
    assert len(got) == len(set(got)) and set(got) == set(zip(x[at].tolist(), y[at].tolist(), strict=True))


def test_no_pair_of_small_sets_at_four_fifths_is_lost():
    """Whatever its bits are, such a pair passes; parities differ in no more places than the sets do."""
    rng = np.random.default_rng(9)
    for n, m in ((4, 5), (8, 9), (8, 10), (12, 15)):
        for _ in range(5000):
            whole = rng.integers(0, 1 << 64, m, dtype=np.uint64)
            lacks = (n + m) // 9 - (m - n)  # further shingles that only one of the two has, in pairs
            x, y = np.sort(whole[: n]), np.sort(np.concatenate([whole[lacks // 2 :], rng.integers(0, 1 << 64, lacks // 2, dtype=np.uint64)]))
            signs = [np.concatenate([simhash.head_of(s), simhash.parities(s)])[None] for s in (x, y)]
            if simhash.similar(x, y):
                assert simhash.near(*signs, np.array([len(x)]), np.array([len(y)]))[0]


def test_crowded_buckets_lose_no_pair_to_longer_chains():
    """As test_sets_of_four_fifths_share_a_chain, where every bucket of both is crowded."""
    rng = np.random.default_rng(18)
    draw = lambda k: np.unique(rng.integers(0, 1 << 64, k, dtype=np.uint64))
    for turn in range(1500):
        n = int(rng.choice([1, 2, 4, 5, 6, 7, 9, 13, 16, 26, 31, 32, 60, 64, 120, 127, 129, 250]))
        both = draw(n)
        allowed = len(both) // 4
        left = int(rng.integers(0, allowed + 1)) if turn % 3 else 0
        x, y = np.union1d(both, draw(left)), np.union1d(both, draw(allowed - left))
        for common in (np.empty(0, np.uint64), both, np.sort(rng.permutation(both)[: len(both) // 2])):
            keys = []
            for s in (x, y):
                rare = simhash.rare_ones(s, common)
                keys.append(simhash.lengthened_keys(s, rare, np.unique(simhash.chain_keys(s, rare) >> np.uint64(simhash.SIZE_BITS))) >> np.uint64(simhash.SIZE_BITS))
            assert len(np.intersect1d(*keys)), (len(both), left, allowed, len(common))


def test_unrelated_sets_that_share_a_shingle_part_in_longer_chains():
    """Their one bucket has all of them; the buckets after it have few, so few pairs are compared."""
    rng = np.random.default_rng(19)
    shared, sets = np.array([1 << 40], np.uint64), []
    for _ in range(2000):
        sets.append(np.union1d(shared, rng.integers(1 << 59, 1 << 64, 80, dtype=np.uint64)))  # the first of 32 segments has no other
    own = [simhash.chain_keys(s, np.ones(len(s), bool)) >> np.uint64(simhash.SIZE_BITS) for s in sets]
    keys, times = np.unique(np.concatenate(own), return_counts=True)
    crowded = keys[times > 200]
    assert len(crowded)
    pairs = lambda n: int((n * (n - 1) // 2).sum())
    longer = [simhash.lengthened_keys(s, np.ones(len(s), bool), np.intersect1d(k, crowded)) for s, k in zip(sets, own, strict=True)]
    _, after = np.unique(np.concatenate(longer), return_counts=True)
    assert pairs(after) < pairs(times[times > 200]) // 20


def test_stage_with_crowded_buckets(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CROWD", 40)
    monkeypatch.setattr(simhash, "LEADERS", 8)
    rng = random.Random(20)
    line = " ".join(f"c{i}" for i in range(6))
    texts = [line + " " + " ".join(f"u{rng.randrange(10**7)}" for _ in range(rng.randint(3, 40))) for _ in range(300)]
    texts += [t + f" z{i}" for i, t in enumerate(texts[:60])] + family(21, 60)
    want = wanted_ids(texts)
    assert len(want) < 400 and kept_ids(spark, texts) == want

"""Packing, mixing, chat formatting, vector search, and the pipeline."""

import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from deltaloom.llm import chat, mixing, packing, vectors


def test_packing(awkward, nothing):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = packing.pack(awkward, most=256, nearly=250, flush=7, per_task=5).toPandas()
    want = {}
    for r in awkward.collect():
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % 256 or 256
        cuts = [0, *range(first, len(ids), 256)]
        for k, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(ids)], strict=True)):
            want.setdefault((r["doc_id"], k, a, b - a, zlib.crc32(ids[a:b].tobytes())), []).append(1)
    got = {}
    for r in rows.itertuples():
        got.setdefault((None if math.isnan(r.doc_id) else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32), []).append(1)
    assert got == want
    for _, own in rows.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]] and own.length.sum() <= 256
    assert rows.sequence_id.nunique() <= math.ceil(rows.length.sum() / 256) * 1.2 + 1
    assert packing.pack(nothing).count() == 0


def test_both_tokenizers_agree_on_every_plain_character():
    encode, slow = packing.tokenizer(), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i in range(0x250):
        for text in (chr(i), f"a{chr(i)}b", f"1{chr(i)}  {chr(i)}", f" {chr(i)}\n{chr(i)}'s"):
            assert not packing.PLAIN.search(text)
            assert encode(text).tolist() == slow.encode(text, add_special_tokens=False).ids, (i, text)


def test_best_fit_takes_the_tightest_bin():
    own, at, fill = packing.best_fit(np.array([6, 5, 4, 3, 2]), 10)
    assert own.tolist() == [0, 1, 0, 1, 1] and at.tolist() == [0, 0, 6, 5, 8] and fill.tolist() == [10, 10]


def sainte_lague(votes, seats):
    won = dict.fromkeys(votes, 0)
    for _ in range(seats):
        best = max(sorted(votes), key=lambda p: votes[p] / (2 * won[p] + 1))
        won[best] += 1
    return won


@pytest.mark.parametrize("seats", [0, 1, 7, 100, 1000])
def test_sainte_lague_against_one_seat_at_a_time(spark, seats):
    rng = random.Random(seats)
    votes = {f"p{i:02d}": rng.choice([0, rng.randint(1, 1000), rng.randint(1, 10)]) for i in range(17)} | {"big": 5000}
    frame = spark.createDataFrame([Row(p=p, v=v) for p, v in votes.items()])
    got = {r["p"]: r["won"] for r in mixing.sainte_lague(frame, [], ["p"], F.col("v"), F.lit(seats)).collect()}
    assert got == sainte_lague(votes, seats)


def plain_targets(sizes, weights, cap):
    total, target, free = sum(sizes.values()), {}, dict(zip(sorted(sizes, key=lambda s: (s is None, s or "")), weights, strict=True))
    while free:
        level = (total - sum(target.values())) / sum(free.values())
        full = [s for s in free if cap * sizes[s] < level * free[s] - 1e-12]
        if not full:
            return target | {s: level * w for s, w in free.items()}
        for s in full:
            target[s] = cap * sizes[s]
            del free[s]
    return target


def test_mixing(awkward, nothing):
    rows = mixing.mix(awkward, block_words=4, shard_words=300).collect()
    sizes = {}
    for r in awkward.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len((r["text"] or "").split())
    want = plain_targets(sizes, [1 + i % 3 for i in range(len(sizes))], 3)
    assert len(rows) == awkward.count() and all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    for s in sizes:
        own = [r for r in rows if r["source"] == s]
        assert {r["source_size"] for r in own} == {sizes[s]} and abs(own[0]["target"] - want[s]) < 1e-6
        assert abs(sum(r["taken"] for r in own) - want[s]) <= 4 * 40
    again = mixing.mix(awkward.repartition(5), block_words=4, shard_words=300).collect()
    key = lambda r: (str(r["doc_id"]), str(r["source"]), r["size"], r["taken"])
    assert sorted(map(key, rows)) == sorted(map(key, again))
    assert mixing.mix(nothing).count() == 0
    mixed = mixing.mixed_documents(awkward)
    assert mixed.columns == awkward.columns and mixed.count() > 0 and mixing.mixed_documents(nothing).count() == 0


def test_taken_words_against_a_plain_mix(spark, awkward):
    """taken of each row, from Spark's hashes alone."""
    options = {"block_words": 4, "shard_words": 60, "shard_rows": 9, "group_shards": 3}
    seed, cap = mixing.SEED, 3
    rows = awkward.select("doc_id", "source", "text", F.xxhash64(F.lit(seed), "doc_id", "text").alias("h"), F.coalesce(F.regexp_count("text", F.lit(mixing.WORD)), F.lit(0)).alias("size")).collect()
    hashes = {(a, b): h for a, b, h in spark.createDataFrame([(r["h"],) for r in rows], "h bigint").distinct().select("h", F.lit(0), F.xxhash64(F.lit(seed + 1), "h")).collect()}
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    named = lambda s: "-" if s is None else "=" + s
    want_targets = plain_targets(sizes, [1 + i % 3 for i in range(len(sizes))], cap)
    blocks = sainte_lague({named(s): want_targets[s] for s in sizes}, round(sum(sizes.values()) / 4))
    want = []
    for source, size in sizes.items():
        own = [r for r in rows if r["source"] == source]
        many = max(1, math.ceil(size / 60), math.ceil(len(own) / 9))
        shards = {}
        for r in own:
            shards.setdefault(hashes[r["h"], 0] % many, []).append(r)
        words = {k: sum(r["size"] for r in v) for k, v in shards.items()}
        seats = sainte_lague({g: sum(w for k, w in words.items() if k // 3 == g) for g in {k // 3 for k in words}}, blocks[named(source)])
        for g, n in seats.items():
            for k, won in sainte_lague({k: w for k, w in words.items() if k // 3 == g}, n).items():
                take = min(won * 4, cap * words[k])
                start = spark.createDataFrame([(named(source), k)], "a string, b bigint").select(F.xxhash64(F.lit(seed + 2), "a", "b")).first()[0] % max(1, math.ceil(words[k] / 4)) * 4
                chosen = [take // words[k] if words[k] else 0] * words[k]
                for i in range(take % words[k] if words[k] else 0):
                    chosen[(start + i) % words[k]] += 1
                at = 0
                for r in sorted(shards[k], key=lambda r: (r["h"], r["doc_id"] if r["doc_id"] is not None else -1, r["size"])):
                    want.append((str(r["doc_id"]), str(source), r["size"], sum(chosen[at : at + r["size"]])))
                    at += r["size"]
    got = [(str(r["doc_id"]), str(r["source"]), r["size"], r["taken"]) for r in mixing.mix(awkward, **options).collect()]
    assert sorted(got) == sorted(want)


def test_chat_ties_and_null_turns(spark):
    rows = [(1, 2, "user", "<b"), (1, 2, "user", "=a"), (1, None, "user", "first"), (1, 2, "user", "<b")]
    out = chat.parsed(chat.format_turns(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))).first()
    assert [t["text"] for t in out["turns"]] == ["first", "<b", "<b", "=a"]


def test_chat_round_trip(spark):
    texts = ["plain", "", None, "\\### Assistant: </turn> ok", "<turn>user<says>x</turn>", "\\l \\\\l < \\< l", "日本 🙂 \n", "<image:1>"]
    rows = [(c, t, role, x) for c, part in enumerate([texts, texts[::-1], ["one"]]) for t, x in enumerate(part) for role in [["user", "assistant", "sys<tem\\", None][t % 4]]]
    rows += [(None, 0, "assistant", "a"), (None, 0, "assistant", "a"), (9, None, "user", "late"), (9, None, "assistant", "tie")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 as _start", "'x' as formatted")
    out = {r["conv_id"]: r for r in chat.parsed(chat.format_turns(frame)).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        if conv != 9:
            assert [(t["role"], t["text"]) for t in out[conv]["turns"]] == [(r, x) for _, _, r, x in own]
        assert out[conv]["loss"] == "".join(x for _, _, r, x in own if r == "assistant")
        f = out[conv]["formatted"]
        assert all(f[s["turn_start"] : s["start"]].startswith("<turn>") and f[s["end"] : s["end"] + 7] == "</turn>" for s in out[conv]["spans"])
    assert chat.parsed(chat.format_turns(frame.limit(0))).count() == 0


def test_chat_parts(spark):
    parts = [Row(type="text", text="see <this>", ref=None, width=None, height=None, seconds=None, pages=None), Row(type="image", text=None, ref="a.png", width=28, height=15, seconds=None, pages=None), Row(type="audio", text=None, ref="b.wav", width=None, height=None, seconds=2.0, pages=None), Row(type="document", text=None, ref="c.pdf", width=None, height=None, seconds=None, pages=3)]
    kind = "conv_id bigint, turn bigint, role string, parts array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
    r = chat.format_turns(spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", []), (1, 2, "assistant", [None])], kind)).first()
    assert r["formatted"] == "<turn>user<says>see \\lthis><image:1><audio:2><document:3></turn><turn>assistant<says></turn><turn>assistant<says><document:1></turn>"
    assert [(a["turn"], a["n"], a["type"], a["ref"], a["tokens"]) for a in r["attachments"]][:3] == [(1, 1, "image", "a.png", 4), (1, 2, "audio", "b.wav", 50), (1, 3, "document", "c.pdf", 768)]


def vector_rows():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 12)).round(2)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + i, x[7].tolist()) for i in range(50)]
    odd = [(2000, None), (2001, [0.0] * 12), (2002, [float("nan")] * 12), (2003, [1.0, None] + [0.0] * 10), (2004, [float("inf")] + [1.0] * 11), (2005, [1.0]), (None, x[1].tolist()), (2006, [])]
    return rows, odd


def test_top_products(spark):
    rows, odd = vector_rows()
    frame = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>").selectExpr("*", "1 as shard", "2 as v", "3 as score")
    good = vectors.usable(frame, True)
    got = {}
    for r in vectors.top_products(good, good.where("vec_id % 20 = 0"), k=6, shard_rows=200, block=10).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    kept = rows + [(2001, [0.0] * 12)]
    ids, x = np.array([i for i, _ in kept]), np.floor(64 * np.array([v for _, v in kept]))
    for q in ids[ids % 20 == 0].tolist():
        s = x @ x[ids == q][0]
        best = [j for j in np.lexsort((ids, -s)).tolist() if ids[j] != q][:6]
        assert sorted(got[q]) == [(k + 1, int(ids[j]), int(s[j])) for k, j in enumerate(best)]
    none = vectors.usable(frame.limit(0), True)
    assert vectors.top_products(none, none).count() == 0
    two = vectors.usable(frame.where("vec_id in (0, 1)"), True)
    assert vectors.top_products(two, two.where("vec_id = 0")).count() == 1


def test_nearest_neighbours(spark):
    rows, odd = vector_rows()
    frame = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>")
    good = vectors.usable(frame, False)
    assert good.count() == len(rows)
    got = {}
    for r in vectors.nearest_neighbours(good, good.where("vec_id % 50 = 0"), lists=16, probes=12, shard_rows=60).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    u, hit = x / np.linalg.norm(x, axis=1, keepdims=True), 0
    for q in ids[ids % 50 == 0].tolist():
        s = u @ u[ids == q][0]
        best = [int(ids[j]) for j in np.lexsort((ids, -s)).tolist() if ids[j] != q][:5]
        own = sorted(got[q])
        assert [k for k, _, _ in own] == [1, 2, 3, 4, 5] and q not in [v for _, v, _ in own]
        assert all(abs(c - s[ids == v][0]) < 1e-12 for _, v, c in own)
        hit += len({v for _, v, _ in own} & set(best))
    assert hit / (5 * len(got)) >= 0.9
    none = vectors.usable(frame.limit(0), False)
    assert vectors.nearest_neighbours(none, none).count() == 0


def test_ball_trees_leave_far_nodes_closed():
    rng = np.random.default_rng(4)
    x = np.round(rng.random((3000, 3)) * 1000) - 500
    tree, order = vectors.BallTree.grown(x, leaf=32)
    queries = np.round(rng.normal(size=(8, 3)) * 64)
    at, found, score, leaves = vectors.search_tree(tree, x[order], order, queries, np.full(8, -1), np.full(8, -np.inf), 5)
    for q in range(8):
        s = x @ queries[q]
        assert found[at == q].tolist() == np.lexsort((np.arange(len(x)), -s))[:5].tolist() and score[at == q].tolist() == sorted(s)[::-1][:5]
        _, _, _, leaves = vectors.search_tree(tree, x[order], order, queries[[q]], np.array([-1]), np.array([-np.inf]), 5)
        assert len(leaves) < 0.3 * (tree.nodes[:, 2] < 0).sum()
    none = vectors.search_tree(tree, x[order], order, queries, np.full(8, -1), np.full(8, np.inf), 5)
    assert not len(none[0]) and not none[3]


def test_nearest_neighbours_of_queries_unlike_the_rows(spark):
    """Rows lie in tight groups, queries anywhere: their neighbours are in other lists than the rows' own, and far down by code."""
    rng = np.random.default_rng(4)
    groups = rng.normal(size=(40, 32))
    x = groups[rng.integers(0, 40, 3000)] + 0.02 * rng.normal(size=(3000, 32))
    asked = np.arange(0, 3000, 50)
    x[asked] = rng.normal(size=(len(asked), 32))
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id bigint, embedding array<double>")
    good = vectors.usable(rows, zero=False)
    found = vectors.nearest_neighbours(good, good.where("vec_id % 50 = 0")).toPandas()
    cosine = (x / np.linalg.norm(x, axis=1, keepdims=True))[asked] @ (x / np.linalg.norm(x, axis=1, keepdims=True)).T
    cosine[np.arange(len(asked)), asked] = -np.inf
    best = {(q, i) for q, ids in zip(asked.tolist(), np.argsort(-cosine, 1)[:, :5].tolist(), strict=True) for i in ids}
    assert len(best & set(zip(found["query_id"], found["vec_id"], strict=True))) >= 0.93 * len(best)


def test_nearest_neighbours_in_ties_and_many_blocks(spark):
    rng = np.random.default_rng(6)
    x = rng.integers(-2, 3, size=(40, 6)).astype(float) + 0.25
    rows = [(i, x[i % 40].tolist()) for i in range(400)] + [(7, x[3].tolist())] * 30
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    good = vectors.usable(frame, False)
    got = {}
    for r in vectors.nearest_neighbours(good, good.where("vec_id % 4 = 0"), lists=8, probes=8, shard_rows=50, block=10).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert len(got) == 100
    for q in got:
        same = [i for i in range(q % 40, 400, 40) if i != q] if q % 40 != 3 else None
        if same is not None and not (np.abs(x[q % 40]).sum() == 0):
            cosine = x @ x[q % 40] / np.linalg.norm(x, axis=1) / np.linalg.norm(x[q % 40])
            if (cosine > 1 - 1e-9).sum() == 1:
                assert sorted(got[q]) == [(k + 1, i) for k, i in enumerate(same[:5])]


def test_recall_on_the_embeddings_table(spark):
    import os

    path = "/root/testdata/sf0.01/embeddings.parquet"
    if not os.path.exists(path):
        pytest.skip("no table")
    good = vectors.usable(spark.read.parquet(path), False)
    found = vectors.nearest_neighbours(good, good.where("vec_id % 5 = 0")).toPandas()
    own = good.toPandas().sort_values("vec_id")
    ids, x = own["vec_id"].to_numpy(), np.array(own["v"].tolist())
    u, hit = x / np.linalg.norm(x, axis=1, keepdims=True), 0
    asked = np.unique(found["query_id"])
    for q, rows in found.groupby("query_id"):
        s = u @ u[ids == q][0]
        s[ids == q] = -2
        hit += len(set(rows["vec_id"]) & set(ids[np.lexsort((ids, -s))[:5]]))
    assert len(asked) == (ids % 5 == 0).sum() and hit >= 0.9 * 5 * len(asked)


OUT = {
    "op1_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op2_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op4_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op5_ann": "query_id bigint, rank int, vec_id bigint, score double",
    "op6_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op7_suffix_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op8_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op10_lm_scoring": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
}


@pytest.fixture(scope="module")
def small_tables(spark, awkward, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    awkward.select("doc_id", "text", "lang", "source", "n_chars").coalesce(2).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(60)], "doc_id bigint, quality int, toxic int").coalesce(1).write.parquet(f"{path}/labels.parquet")
    rows, odd = vector_rows()
    spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>").coalesce(1).write.parquet(f"{path}/embeddings.parquet")
    return str(path)


@pytest.mark.parametrize("name", OUT)
def test_entries(spark, small_tables, awkward, name):
    from deltaloom.llm import registry

    out = registry.queries()[name](spark, small_tables)
    assert ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out.schema) == OUT[name]
    rows = out.collect()
    if name != "op5_ann" and name != "op6_packing":
        assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in awkward.select("doc_id").collect())
    mod, held = {"op1_toxicity": (5, 0), "op2_language_id": (3, 1), "op10_lm_scoring": (7, 2)}.get(name, (None, None))
    if mod:
        assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % mod == held) for r in rows)
    if name in ("op1_toxicity", "op2_language_id"):
        assert all(0 <= r["score"] <= 1 for r in rows)


def test_pipeline(spark, awkward, tmp_path):
    import corpus_pipeline

    docs = awkward.select("doc_id", "text", "lang", "source", "n_chars")
    docs.coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 20
    frame = docs
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, frame, str(tmp_path)).write.parquet(f"{tmp_path}/{i}")
        frame = spark.read.parquet(f"{tmp_path}/{i}")
        assert frame.columns == docs.columns
    kept = {r["doc_id"] for r in spark.read.parquet(f"{tmp_path}/1").collect()}
    assert 300 in kept and not {301, 302, 201, 202} & kept and set(range(60)) <= kept


@pytest.mark.parametrize("name", ["op3_chat_formatting", "op9_ball_tree"])
def test_sql_gives_the_same_rows(spark, tmp_path, name):
    import duckdb

    from deltaloom.llm import registry

    rows, odd = vector_rows()
    odd = [r for r in odd if r[1] is None or len(r[1]) == 12]  # the SQL takes one length only
    spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    said = [(1, None, "user", "no turn"), (1, 2, "assistant", "<tie"), (1, 2, "assistant", "=tie")]
    said += [(c, t, ["user", "assistant", None][t % 3], [f"text {c}", "a\\b<c", None, "", "é"][(c + t) % 5]) for c in range(9) for t in range(5)]
    spark.createDataFrame(said, "conv_id bigint, turn bigint, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    db = duckdb.connect()
    for t in ("embeddings", "conversations"):
        db.sql(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    want, got = db.sql(registry.oracle_sql()[name]), registry.queries()[name](spark, str(tmp_path))
    assert sorted(want.columns) == sorted(got.columns)
    assert sorted(want.fetchall(), key=str) == sorted((tuple(r[c] for c in want.columns) for r in got.collect()), key=str)


def test_a_list_goes_only_to_the_blocks_that_ask_it(spark):
    """Copies of indexed rows: a list's rows times its own blocks, none of a list that nobody asks."""
    index = spark.createDataFrame([(i, [1.0], i % 5, b"c") for i in range(1000)], "vec_id bigint, v array<double>, list bigint, code binary")
    probed = spark.createDataFrame([(i, [1.0], [0] if i % 2 else [0, 1]) for i in range(100)] + [(200, [1.0], [3])], "query_id bigint, v array<double>, lists array<bigint>")
    asked, rows = vectors.dealt(probed, index, 50, 30)
    assert {r["list"]: r["n"] for r in rows.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()} == {0: 200 * 4, 1: 200 * 2, 3: 200}
    assert asked.select("query_id", "list", "shard").distinct().count() == asked.count() == 4 * (100 + 50 + 1)
    pairs = lambda df: {tuple(r) for r in df.select("list", "shard", "block").distinct().collect()}
    assert pairs(asked) - pairs(rows) == set() and len(pairs(rows)) <= 4 * (4 + 2 + 1)


def test_a_column_of_the_callers_named_tag_is_no_matter(spark):
    docs = spark.createDataFrame([(i, f"s{i % 2}", "a b c " * (i + 1)) for i in range(20)], "doc_id bigint, source string, text string")
    plain, tagged = (mixing.mix(d).orderBy("doc_id") for d in (docs, docs.selectExpr("*", "'q' as tag")))
    assert plain.columns == tagged.columns and plain.collect() == tagged.collect()

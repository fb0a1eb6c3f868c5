"""Repeated passages against a set of all windows."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from deltaloom.llm import suffixes


def plain(rows, length):
    """(doc_id, n_bytes, n_removed, n_spans, sha256) of each row, sorted as the operator sorts."""
    seen, out = set(), []
    for key, raw in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, xxhash.xxh64_intdigest(r[1]))):
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            window = raw[i : i + length]
            if window in seen:
                gone[i : i + length] = True
            seen.add(window)
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        edges = np.diff(np.concatenate([[0], gone.astype(int)]))
        out.append((key, len(raw), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(frame, **options):
    rows = suffixes.deduplicated(frame, **options).collect()
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows), key=str)


@pytest.mark.parametrize("options", [{}, {"block_bytes": 3000}, {"block_bytes": 3000, "hot": 2}, {"hot": 2, "length": 60}])
def test_against_all_windows(spark, options):
    rng = random.Random(5)
    alphabet = "abcdefgh éü"
    make = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    shared = [make(150), make(100), make(99), make(400)]
    rows = []
    for i in range(60):
        parts = [make(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            cut = rng.randint(0, 30)
            parts += [s[cut:] if rng.random() < 0.5 else s, make(rng.randint(0, 60))]
        rows.append((i * 7 % 60, "".join(parts)))
    rows += [(70, "z" * 350), (71, "z" * 120 + "yx" * 100), (72, "yx" * 200), (73, None), (74, "")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    want = plain([(k, (t or "").encode()) for k, t in rows], options.get("length", 100))
    assert found(frame, **options) == want


def test_repeated_ids_in_any_order_of_rows(spark):
    rng = random.Random(8)
    make = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = [make(180) for _ in range(4)]
    rows = [(rng.choice([1, 1, 2, 3, None]), make(rng.randint(0, 90)) + rng.choice(shared) + make(rng.randint(0, 90))) for _ in range(60)]
    rows += rows[:5]
    want = plain([(k, t.encode()) for k, t in rows], 100)
    for seed in range(2):
        random.Random(seed).shuffle(rows)
        frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
        assert found(frame, block_bytes=2000, part_entries=40, ranges=3) == want
        assert found(frame, block_bytes=2000, part_entries=40, ranges=2, hot=3) == want
        assert found(frame, block_bytes=1000, hot=2, group_blocks=3) == want


def test_windows_that_share_a_digest(spark, monkeypatch):
    rng = random.Random(3)
    shared = "".join(rng.choice("abcdef") for _ in range(140))
    texts = [f"{i}" * 30 + shared[i % 7 :] + f"{i % 3}" * 20 for i in range(12)]
    frame = __import__("pandas").DataFrame
    row = {"docs": list(range(12)), "lengths": [len(t) for t in texts], "bytes": __import__("zstandard").ZstdCompressor().compress("".join(texts).encode())}
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    at, near, far = suffixes.anchors(data, np.cumsum(row["lengths"]), 100)
    pack = suffixes.squeezed
    row |= {"places": pack(np.diff(at, prepend=0)), "near": pack(near), "far": pack(far)}
    e = suffixes.sorted_entries(row, np.ones(len(np.unique(suffixes.exchanged_hashes(data, at))), np.int64), 100)
    string = np.ascontiguousarray(e["rows"][:, :101])
    lcp, zip_ = suffixes.shared_prefixes(string), __import__("zstandard").ZstdCompressor().compress
    run = {"block": 0, "part": 0, "at": b"", "shared": pack(lcp), "tails": zip_(string[np.arange(101) >= lcp[:, None]].tobytes()), "rest": zip_(e["rows"][:, 101:].tobytes())}
    monkeypatch.setattr(suffixes, "_mixed", lambda h: h & np.uint64(7))
    masks = suffixes.restored(suffixes.settle(frame([run | {c: pack(e[c]) for c in suffixes.PLACE}]), 100)["masks"][0])
    seen, raw = set(), data.tobytes()
    want = np.zeros(len(masks), np.uint64)
    order = np.lexsort((e["offset"], e["own"]))
    for i in order.tolist():
        start = sum(row["lengths"][: e["own"][i]]) + int(e["offset"][i])
        for o in range(int(e["rows"][i, 101]), int(e["rows"][i, 102]) + 1):
            window = raw[start - o : start - o + 100]
            want[i] |= np.uint64((window in seen) << o)
            seen.add(window)
    assert masks.tolist() == want.tolist() and masks.any()


def test_awkward_rows(awkward, nothing):
    got = found(awkward)
    assert got == plain([(r["doc_id"], (r["text"] or "").encode()) for r in awkward.collect()], 100)
    assert suffixes.deduplicated(nothing).count() == 0
    left = suffixes.without_repeats(awkward)
    assert left.columns == awkward.columns and left.count() == awkward.count()
    assert left.where("doc_id = 301").first()["text"] == "" and left.where("doc_id = 301").first()["n_chars"] == 0
    assert suffixes.without_repeats(nothing).count() == 0


def test_loser_tree():
    rng = random.Random(9)
    for count in (1, 2, 3, 7, 16):
        runs = [sorted(bytes(rng.choice(b"ab") for _ in range(12)) for _ in range(rng.randint(0, 30))) for _ in range(count)]
        shared = [[0, *(next((i for i in range(12) if a[i] != b[i]), 12) for a, b in zip(r, r[1:], strict=False))][: len(r)] for r in runs]
        order, lcps = suffixes.merged(runs, shared)
        places, out = [0] * count, []
        for r in order:
            out.append(runs[r][places[r]])
            places[r] += 1
        assert out == sorted(x for r in runs for x in r)
        assert lcps == [0, *(next((i for i in range(12) if a[i] != b[i]), 12) for a, b in zip(out, out[1:], strict=False))][: len(out)]

"""Small documents with every awkward kind of row."""

import random

import pytest


@pytest.fixture(scope="session")
def awkward(spark):
    """doc_id, text, lang, source, n_chars and columns whose names clash with the operators' own."""
    rng = random.Random(3)
    words = ["the", "and", "von", "der", "les", "une", "para", "casa", "über", "été", "niño", "x1", "A-B", "Zug"]
    make = lambda n: " ".join(rng.choice(words) + rng.choice(["", "s", "en", "."]) for _ in range(n))
    passage = make(60)
    rows = [(i, make(rng.randint(1, 80)), rng.choice(["en", "de", "fr", None]), f"s{i % 4}", 5) for i in range(60)]
    rows += [(100 + i, make(10) + " " + passage + " " + make(10), "en", "s0", 5) for i in range(8)]
    rows += [(200, make(30), "de", None, 1)] * 2 + [(201, None, "en", "s1", None), (202, "", None, "s1", 0), (203, " \n\t ", "fr", None, 3), (None, "no id here at all", "en", "s2", 4), (None, None, None, None, None)]
    rows += [(300 + i, "a" * 500, "en", "s9", 500) for i in range(3)] + [(310, "ab " * 4000, "en", "s9", 12000), (311, "漢字かな交じり文 <|endoftext|> end", "ja", "s9", 9), (312, "0 1 2 !!", "en", "s9", 8)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    extra = "doc_id as key, doc_id as fp, 1 as component, 'x' as row, 2 as tag, 3 as size, 'q' as label, 0 as _order, 7 as h, 8 as y"
    return frame.selectExpr("*", *extra.split(", "))


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)

"""Ranked lexical search against its SQL and brute force."""

import math
import random
import re
from collections import Counter

import duckdb
import pytest
from conftest import SMALL

from fieldtally.llm import lexical
from fieldtally.llm.catalog import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, item_id string, score string, n long"


def split(text):
    return re.findall(lexical.TERM, re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))


def brute(docs, items, k=10):
    bags = [(i, Counter(split(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(b) for _, b in bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    wanted = {}
    for name, text in items:
        wanted.setdefault(name, set()).update(split(text))
    out = []
    for name, terms in wanted.items():
        scores = []
        for i, b in bags:
            if b:
                m = 10 + 90 * b.total() * n_docs // n_terms
                score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t in terms if t in b)
                scores += [(-score, i is None, i or 0, i)] if score > 0 else []
        out += [(name, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=lambda r: (str(r[0]), r[1]))


def rows(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=lambda r: (str(r[0]), r[1]))


def test_query(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    got = rows(QUERIES["op13_lexical"](spark, SMALL))
    assert got == sorted(con.execute(ORACLES["op13_lexical"]).fetchall(), key=lambda r: (str(r[0]), r[1]))
    docs, items = (con.sql(f"SELECT * FROM {n}").df() for n in ("documents", "benchmark"))
    assert got == brute(list(zip(docs.doc_id, docs.text)), list(zip(items.item_id, items.text)))


@pytest.mark.parametrize("block", [10**6, 25])
def test_copies_ties_and_blocks(spark, block):
    """More copies of a class than results, equal scores over classes, ids repeated and missing; blocks change nothing."""
    rng = random.Random(7)
    words = ["Alpha", "beta", "GAMMA", "délta", "x2", "ÉTÉ", "漢字", "omega"]
    bodies = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 9))) for _ in range(25)]
    docs = [(rng.randrange(120), rng.choice(bodies) + rng.choice(["", " nobody asks", "! other words"])) for _ in range(300)]
    docs += [(None, bodies[0]), (None, bodies[0]), (5, None), (6, ""), (7, " .,;\x00 "), (8, "beta " * 100_000)]
    items = [(f"q{i}", " ".join(rng.sample(words, rng.randrange(1, 5)))) for i in range(30)] + [("none", None), ("empty", ""), ("absent", "nowhere"), ("two", "alpha"), ("two", "beta beta"), (None, "omega")]
    df = spark.createDataFrame([(*d, "a", "b", 1) for d in docs], SCHEMA).repartition(7)
    asked = spark.createDataFrame([(*i, "x") for i in items], "item_id string, text string, doc_id string")
    assert rows(lexical.lexical_top(df, asked, block_terms=block)) == brute(docs, items)
    assert rows(lexical.lexical_top(df, asked, k=3, block_terms=block)) == brute(docs, items, 3)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, "beta")], "item_id long, text string")
    assert lexical.lexical_top(docs, items).collect() == []
    assert lexical.lexical_top(spark.createDataFrame([(1, "beta", None, None, 1)], SCHEMA), items.limit(0)).collect() == []
    assert lexical.lexical_top(docs, items).columns == ["item_id", "rank", "doc_id", "score"]

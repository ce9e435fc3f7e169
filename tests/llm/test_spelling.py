"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pandas as pd
import pytest
from conftest import SMALL

from fieldtally.llm import spelling
from fieldtally.llm.catalog import QUERIES


def apart(a, b):
    """Whether exactly one insertion, deletion or replacement lies between two different words."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_words(docs):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run if h % 31 else "".join(c for k, c in enumerate(run) if k != h % len(run))] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def brute(n):
    near = {w: [] for w in n}
    gaps = {}
    for w in n:
        for i in range(len(w)):
            gaps.setdefault(w[:i] + "\0" + w[i + 1 :], []).append(w)
            if (short := w[:i] + w[i + 1 :]) in n and short not in near[w]:
                near[w].append(short)
                near[short].append(w)
    for group in gaps.values():
        for a in group:
            near[a] += [b for b in group if b != a and b not in near[a]]
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        yield w, form[w], root, n[w], len(near[w]), n.get(form[w])


def as_rows(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def ordered(rows):
    return sorted(rows, key=lambda r: r[0])


def test_query(spark):
    docs = pd.read_parquet(f"{SMALL}/documents.parquet")
    want = ordered(brute(brute_words(zip(docs.doc_id, docs.text))))
    got = QUERIES["op11_spelling"](spark, SMALL)
    assert len(want) > 500 and any(r[1] for r in want)
    assert ordered(tuple(r) for r in got.select("word", "form", "root", "n", "n_near", "form_n").collect()) == want


@pytest.mark.parametrize("letters,seed", [("ab", 1), ("abé", 2), ("abcdefghij", 3)])
def test_near_words(spark, letters, seed):
    """Few letters repeat bigrams within a word as often as can be."""
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.choice([7, 8, 9, 12]))) for _ in range(700)}
    for w in list(words)[:200]:
        k = rng.randrange(len(w))
        words |= {w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1 :]}
    n = {w: rng.randrange(1, 10**6) for w in words}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    got = {(r.word, r.near) for r in spelling.near_words(df).collect()}
    assert got == {(a, b) for a in words for b in words if apart(a, b)}
    assert ordered(tuple(r) for r in spelling.variant_groups(df).collect()) == ordered(brute(n))
    # A bounded list of frequencies changes speed alone.
    assert got == {(r.word, r.near) for r in spelling.near_words(df, known_grams=2).collect()}


def test_pivots_are_disjoint_and_cheapest():
    rng = random.Random(5)
    for _ in range(300):
        places = [(p, rng.randrange(9)) for p in sorted(rng.sample(range(12), 5))]
        cost = dict(places)
        pairs = [(cost[a] + cost[b], a, b) for a in cost for b in cost if b - a >= 2]
        a, b = spelling.pivots(places)
        assert b - a >= 2 and cost[a] + cost[b] == min(pairs)[0]


def test_chain_ties_and_odd_rows(spark):
    schema = "doc_id long, text string, word string, n long, form string"
    words = {"aaaaaaaa": 1, "aaaaaaab": 10, "aaaaaabb": 100, "aaaaabbb": 1000, "zzzzzzzx": 50, "zzzzzzzy": 50, "zzzzzzzz": 5}
    got = {r.word: r for r in spelling.variant_groups(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    assert got["aaaaaaaa"].root == "aaaaabbb" and got["aaaaaaaa"].form == "aaaaaaab" and got["aaaaabbb"].form is None
    assert got["zzzzzzzz"].form == "zzzzzzzx" and got["zzzzzzzz"].n_near == 2 and got["zzzzzzzz"].form_n == 50
    rows = [(None, "Überall überall GARTENBANK gartenbank", "x", 1, "y"), (None, "gartenbanks gartenbanks", "x", 1, "y"), (1, None, None, None, None),
            (2, "", "x", 1, "y"), (3, "gartenbank " * 50_000, "x", 1, "y"), (3, "gartenbank " * 3, "x", 1, "y"), (4, "××××××××÷ ××××××××÷ kurz kurz", "x", 1, "y")]
    docs = spark.createDataFrame(rows, schema)
    want = ordered(brute(brute_words([r[:2] for r in rows])))
    assert as_rows(spelling.spelling_variants(docs)) == want and len(want) == 3
    assert spelling.spelling_variants(spark.createDataFrame([], schema)).collect() == []

"""Token counts against the tokenizer library itself."""

import random

import public_tokenizers
import pytest
from conftest import SMALL
from tokenizers import Tokenizer

from fieldtally.llm import bpecount
from fieldtally.llm.catalog import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_query(spark, library):
    got = {r.doc_id: r for r in QUERIES["op12_token_counts"](spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        n = len(library.encode(d.text or "", add_special_tokens=False).ids)
        assert tuple(got[d.doc_id]) == (d.doc_id, len((d.text or "").encode()), n, n > 2048)


def test_odd_texts(library):
    rng = random.Random(4)
    letters = "aeb'stTÉéßΣ̧́ \t\n\x1c\x85\xa0  1²漢<|>endoftxsar👩‍"
    texts = ["", "<|endoftext|>", "a<|endoftext|>b <|startoftext|><|endoftext|>́", "ΣΑΣ İstanbul ß 'S 'll don't", "x\x00y\x1fz", "한글 각"]
    texts += ["a" * 5000, "ab" * 3000, "thonre" * 900]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(2000)]
    counter = bpecount.MergeCounter(PATH)
    assert [counter.count(t.encode()) for t in texts] == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_merges_equal_plain_merging():
    """The heap against merging the lowest-ranked, leftmost pair over and over."""
    counter, rng = bpecount.MergeCounter(PATH), random.Random(8)
    for _ in range(300):
        piece = "".join(rng.choice("thenaoir") for _ in range(rng.randrange(1, 30)))
        ids = counter.symbols(piece)
        while True:
            found = min(((counter.rank[k], counter.made[counter.rank[k]], i) for i in range(len(ids) - 1) if (k := ids[i] * counter.width + ids[i + 1]) in counter.rank), key=lambda f: (f[0], f[2]), default=None)
            if not found:
                break
            ids[found[2] : found[2] + 2] = [found[1]]
        assert counter.merged(piece) == len(ids)


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpecount, "KNOWN_BYTES", 1)
    counter = bpecount.MergeCounter(PATH)
    assert [counter.count(b"the quick brown fox") for _ in range(3)] == [len(library.encode("the quick brown fox").ids)] * 3


def test_odd_rows(spark, library):
    schema = "doc_id long, text string, n_bytes string, named string"
    rows = [(1, None, "x", "y"), (2, "", None, None), (2, "the the", "x", "y"), (2, "the the", "x", "y"), (None, "é", "x", "y"), (None, None, None, None), (3, "ab " * 200_000, "x", "y")]
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in bpecount.token_counts(spark.createDataFrame(rows, schema), PATH).collect()))
    count = lambda t: len(library.encode(t or "", add_special_tokens=False).ids)
    assert got == sorted((i is None, i or 0, len((t or "").encode()), count(t), count(t) > 2048) for i, t, *_ in rows)
    assert bpecount.token_counts(spark.createDataFrame([], schema), PATH).collect() == []

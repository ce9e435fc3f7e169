"""Every operator against brute force on the smallest tables, and on rows that are odd in every way."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from fieldtally.llm import decontaminate, licenses, mixing, neardup, passages, quality, sharding, templates, topk, wavelet
from fieldtally.llm.catalog import QUERIES
from fieldtally.llm.common import count_words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, shard string, at string, bucket string"


@pytest.fixture(scope="module")
def documents():
    return pd.read_parquet(f"{SMALL}/documents.parquet").sort_values("doc_id")


@pytest.fixture(scope="module")
def odd(spark):
    """NULLs in every column, empty and very long texts, repeated rows, ties, clashing extra columns."""
    rng = random.Random(3)
    long = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(rng.randrange(999)) for _ in range(60_000))
    same = " ".join(f"w{i}" for i in range(40))
    extra = ("x", "y", None, "z")
    rows = [(1, same, "en", "a", 1), (2, same, "en", "a", 1), (2, same, "en", "a", 1), (3, same + " tail", None, None, None),
            (4, None, "en", "a", 0), (5, "", "en", "b", 0), (6, "   \n\t ", "de", "b", 5), (7, long, "en", "b", 1), (8, long + " end", "en", "b", 1),
            (None, same, "en", "a", 1), (None, None, None, None, None), (9, "one", "en", "c", 3), (10, "é ß 漢字  x", "fr", "c", 9)]
    return spark.createDataFrame([r + extra for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def removed(docs):
    """Brute force of the substring contract."""
    first = {}
    for i, t in docs:
        w = (t or "").encode().split()
        for j in range(len(w) - 12):
            first[tuple(w[j : j + 13])] = min(i, first.get(tuple(w[j : j + 13]), i))
    for i, t in docs:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for j in range(len(w) - 12):
            if first[tuple(w[j : j + 13])] < i:
                gone[j : j + 13] = [True] * 13
        kept = [x for x, g in zip(w, gone) if not g]
        yield i, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def test_passages(spark, documents):
    got = sorted(map(tuple, QUERIES["op1_passages"](spark, SMALL).collect()))
    assert got == sorted(removed(list(zip(documents.doc_id, documents.text))))


def test_phrases_are_located_over_texts_laid_end_to_end():
    import ahocorasick
    from fieldtally.llm import wordhash

    automaton = ahocorasick.Automaton()
    for pattern in (" a b ", " b a "):
        automaton.add_word(pattern, len(pattern))
    automaton.make_automaton()
    tokens = wordhash.Tokens([b"x a  b", b"", b"a\tb\n", b"\xc3\xa9 a b"])
    assert sorted(passages.locate(automaton, tokens).tolist()) == [1, 2, 3, 6]


def test_passages_odd(odd, empty):
    got = passages.repeated_passages(odd).collect()
    named = [(r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in got if r.doc_id is not None]
    assert sorted(named) == sorted(removed([(r.doc_id, r.text) for r in odd.collect() if r.doc_id is not None]))
    assert sorted((r.n_words, r.n_removed) for r in got if r.doc_id is None) == [(0, 0), (40, 0)]
    assert passages.repeated_passages(empty).count() == 0


def test_passages_repeated_ids(spark):
    """Rows without id and an id repeated with other texts: spread over the shards, in any row order, as brute force has it."""
    rng = random.Random(9)
    shared = [" ".join(rng.choice("abcdefghij") * 3 + str(rng.randrange(40)) for _ in range(20)) for _ in range(6)]
    text = lambda: " ".join([f"u{rng.randrange(999)}", rng.choice(shared), f"v{rng.randrange(999)}"])
    rows = [(None, text()) for _ in range(3000)] + [(5, text()) for _ in range(300)] + [(i, text()) for i in range(2, 40)]
    want = sorted(removed([r for r in rows if r[0] is not None]))
    for _ in range(2):
        rng.shuffle(rows)
        got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), shard_bytes=20_000).collect()
        named = [(r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in got if r.doc_id is not None]
        assert sorted(named) == want
        assert [r.n_removed for r in got if r.doc_id is None] == [0] * 3000


def test_templates(spark):
    rows = [(i, f"Page {i} of 90 printed by the office\n{'abcdefgh'[i] * 3} begins the words that nobody else has\nshort") for i in range(5)]
    rows += [(5, "logged in from the main office: anna as user"), (6, "logged in from the main office: otto as user"),
             (7, "logged in from the main office: ines as user"), (8, None), (None, "Page 7 of 90 printed by the office")]
    got = {r.doc_id: r for r in templates.drop_template_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].n_dropped for i in (0, 4, 5, 6, 7, 8, None)] == [2, 2, 1, 1, 1, 0, 1]
    assert got[0].kept.endswith("nobody else has") and got[5].kept == ""


def templates_by_hand(rows, min_docs=3, fixed=0.7, common=0.2):
    """(doc_id, n_lines, n_dropped, kept) of every row, line by line."""

    def words(line):
        plain = [t for t in re.split("[ \t\x0b-\r]+", line) if t]
        blank = [templates.FIELD if re.search("[0-9]", t) else t for t in plain]
        return tuple(blank if any(t != templates.FIELD for t in blank) else plain)

    leaf = lambda w: (len(w), w[: templates.DEPTH])
    seen = [(i, w) for i, t in rows for w in map(words, (t or "").split("\n")) if w]
    holders, different = {}, {}
    for i, w in seen:
        holders.setdefault(leaf(w), set()).add(i)
    for i, w in seen:
        if len(holders[leaf(w)]) > 1:
            different.setdefault(leaf(w), set()).add(w)
    template = {}
    for forms in different.values():
        at = Counter((k, t) for w in forms for k, t in enumerate(w))
        for w in forms:
            holds = [at[k, t] >= 2 and at[k, t] >= len(forms) * common for k, t in enumerate(w)]
            general = len(forms) > 1 and sum(holds) >= len(w) * fixed
            template[w] = (leaf(w), tuple(t if h else templates.FIELD for t, h in zip(w, holds))) if general else (leaf(w), w, "itself")
    docs = {}
    for i, w in seen:
        if w in template:
            docs.setdefault(template[w], set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(docs.get(template.get(words(x)), ())) < min_docs]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_templates_by_brute_force(spark, documents):
    rng = random.Random(11)
    say = lambda: " ".join(rng.choice(["red", "blue", "17", "x9", "green", "go", "\t"]) for _ in range(rng.randrange(6)))
    rows = [(rng.choice([None, *range(25)]), "\n".join(say() for _ in range(rng.randrange(1, 9)))) for _ in range(120)]
    rows += rows[:9] + [(7, None), (8, ""), (None, "Read more\nShare\n12"), (30, "Read more\n\n12"), (31, " Read  more\n13")]
    for case in (rows, list(zip(documents.doc_id.tolist(), documents.text.tolist()))):
        got = templates.drop_template_lines(spark.createDataFrame(case, "doc_id long, text string")).collect()
        order = lambda found: sorted(map(tuple, found), key=str)
        assert order(got) == order(templates_by_hand(case))
    assert {r.kept for r in templates.drop_template_lines(spark.createDataFrame([(i, f"Share\nRead more\n{i}") for i in range(6)], "doc_id long, text string")).collect()} == set("012345")


def test_templates_odd(odd, empty):
    got = templates.drop_template_lines(odd).collect()
    assert len(got) == odd.count() and all(r.n_dropped <= r.n_lines for r in got)
    assert templates.drop_template_lines(empty).count() == 0


def bag(text):
    w = (text or "").encode().split()
    return Counter(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else Counter()


def test_signature_estimates_weighted_jaccard():
    rng = random.Random(5)
    a = [" ".join(rng.choice("abc") for _ in range(400)) for _ in range(2)]
    a[1] = (a[0][:500] + a[1][500:])
    texts = [x.encode() for x in a]
    times = neardup.bag_minhash(*neardup.counted(*neardup.shingles(texts)[:2]), 2, 20_000)
    true = sum((bag(a[0]) & bag(a[1])).values()) / sum((bag(a[0]) | bag(a[1])).values())
    assert abs(neardup.weighted_jaccard(*texts) - true) < 1e-12 and abs((times[0] == times[1]).mean() - true) < 0.02


def classes(docs):
    bags, top = {i: bag(t) for i, t in docs}, {i: i for i, _ in docs}

    def root(i):
        return i if top[i] == i else root(top[i])

    ids = sorted(bags)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            both, either = sum((bags[i] & bags[j]).values()), sum((bags[i] | bags[j]).values())
            if either and both >= 0.8 * either:
                a, b = root(i), root(j)
                top[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_neardup(spark, documents):
    got = {r.doc_id: r.class_id for r in QUERIES["op3_neardup"](spark, SMALL).collect()}
    assert got == classes(list(zip(documents.doc_id, documents.text)))


def variants(seed, n=60, edits=(0, 3, 6, 9, 14), group=300):
    rng = random.Random(seed)
    base = [f"t{i}" for i in range(group)]
    docs = []
    for i in range(n):
        w = list(base)
        for k in rng.sample(range(group), rng.choice(edits)):
            w[k] = f"x{i % 7}_{k}"
        docs.append((i, " ".join(w)))
    return docs


@pytest.mark.parametrize("seed,edits", [(1, (0, 3, 6, 9, 14)), (2, (5, 7, 9, 11, 13)), (3, (1, 2, 8, 15))])
def test_neardup_large_open_bucket(spark, seed, edits):
    docs = variants(seed, edits=edits)
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == classes(docs)


def test_difference_bounds_never_rule_out_a_similar_pair():
    """The condition is exact with exact sets, and bitmaps only make it weaker."""
    docs = [t.encode() for _, t in variants(4, 40, (0, 2, 5, 9, 15))] + [("t0 t1 t2 t3 t4 " * 30 + f"u{k}").encode() for k in range(8)]
    all_bags, p = neardup.bags(docs), 0.8 / 1.8
    hub = all_bags[0]
    size = int(hub[1].sum())
    parts = [neardup.difference(hub, b) for b in all_bags]
    count = lambda bits: int(np.bitwise_count(bits.view(np.uint64)).sum())
    for i in range(len(docs)):
        for j in range(i):
            (lx, ax, bx), (ly, ay, by) = parts[i], parts[j]
            needed = (1 - p) * (lx + ly) + p * (ax + ay) + (2 * p - 1) * size - 1e-6
            may = lx + ax - count(bx & ~by) >= needed and ly + ay - count(by & ~bx) >= needed
            assert may or neardup.similarity(all_bags[i], all_bags[j]) < 0.8
            wx, wy, wh = (dict(zip(*b)) for b in (all_bags[i], all_bags[j], hub))
            alike = sum(min(max(0, s * (wx.get(h, 0) - wh.get(h, 0))), max(0, s * (wy.get(h, 0) - wh.get(h, 0)))) for h in {*wx, *wy, *wh} for s in (1, -1))
            assert (alike >= needed) == (neardup.similarity(all_bags[i], all_bags[j]) >= 0.8)


def test_neardup_repeated_and_missing_ids(spark):
    """Two texts under one id link both ways whatever the row order; rows without id are in the class of their text."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (4, c), (None, c), (None, "nobody else says this at all"), (None, None), (5, c + " end")]
    want = Counter({(1, 1): 2, (2, 1): 1, (3, 1): 1, (4, 4): 1, (None, 4): 1, (None, None): 2, (5, 4): 1})
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id long, text string")
        assert Counter((r.doc_id, r.class_id) for r in neardup.near_duplicates(df).collect()) == want
        kept = sorted((str(r.doc_id), str(r.text)[:3]) for r in neardup.one_of_each(df).collect())
        assert kept == sorted([("1", "a0 "), ("1", "b0 "), ("4", "c0 "), ("None", "nob"), ("None", "Non")])


def test_neardup_odd(odd, empty):
    got = Counter((r.doc_id, r.class_id) for r in neardup.near_duplicates(odd).collect())
    assert got == Counter({(1, 1): 1, (2, 1): 2, (3, 1): 1, (4, 4): 1, (5, 5): 1, (6, 6): 1, (7, 7): 1, (8, 7): 1, (9, 9): 1, (10, 10): 1, (None, None): 1, (None, 1): 1})
    kept = [r.doc_id for r in neardup.one_of_each(odd).collect()]
    assert sorted(map(str, kept)) == sorted(map(str, [1, 4, 5, 6, 7, 9, 10, None]))
    assert neardup.near_duplicates(empty).count() == 0


def test_mixing_odd(odd, empty):
    rows = mixing.weighted_mix(odd, count_words(F.col("text"))).collect()
    assert len(rows) == odd.count() and all(0 <= r.taken <= 3 * r.size for r in rows)
    by = {}
    for r in rows:
        by.setdefault((r.source, r.source_size, r.target), []).append(r.taken)
    assert all(abs(sum(v) - k[2]) <= 1 and k[2] <= 3 * k[1] for k, v in by.items())
    assert abs(sum(k[2] for k in by) - sum(r.size for r in rows)) < 1e-6
    stream = mixing.mixed_documents(odd, count_words(F.col("text")))
    assert stream.columns == odd.columns and stream.count() > 0
    assert mixing.weighted_mix(empty, count_words(F.col("text"))).count() == 0


def test_wavelet_operations():
    x = np.random.default_rng(1).integers(0, 300, 3000).astype(np.uint32)
    w = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.of(x).to_bytes())
    assert (w.ids() == x).all() and all(w.access(i) == x[i] for i in range(0, 3000, 7))
    for s in (0, 5, 299, 4000):
        at = np.flatnonzero(x == s)
        assert w.count(s) == len(at) and all(w.select(s, k) == at[k] for k in range(len(at)))
        assert all(w.rank(s, i) == (x[:i] == s).sum() for i in range(0, 3001, 100))
    with pytest.raises(IndexError):
        w.select(5, w.count(5))


def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    return public.path("byte_bpe_50k.json"), Tokenizer.from_file(public.path("byte_bpe_50k.json"))


def test_encoder_equals_whole_texts():
    path, plain = tokenizer()
    texts = ["", "  a b", " a", "a ", "a  b", "x\n y z", "x  y", "\n\n a", "<|endoftext|> a b<|endoftext|>", "it's   don't 12 3!!", "a\tb \tc", "a\x1c b", "　 k", "a  b"]
    assert [list(g) for g in wavelet.Encoder(path).encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_encoder_of_odd_neighbours():
    """Every two characters at which texts may be cut, beside each other in random order."""
    path, plain = tokenizer()
    parts = [*"aZé×÷1_.,'日\u0301\u00bd", " ", "  ", "\n", "\r\n", "\t", "\x1c", "\x85", "\xa0", "\u3000", "'s", "!?", "<|endoftext|>"]
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(5000)]
    assert [list(g) for g in wavelet.Encoder(path).encode(texts)] == [e.ids for e in plain.encode_batch_fast(texts, add_special_tokens=False)]


def test_encoder_meets_a_word_once(monkeypatch):
    """Words beside marks and line breaks, and in later calls, are not encoded again; a full table starts anew."""
    path, plain = tokenizer()
    encoder, want = wavelet.Encoder(path), lambda texts: [plain.encode(t, add_special_tokens=False).ids for t in texts]
    first, later = ["Alpha beta gamma.\nAlpha beta, gamma beta"], ["Alpha gamma, beta.\nAlpha", "Alpha beta beta gamma."]
    assert [list(g) for g in encoder.encode(first)] == want(first)
    known = len(encoder.known)
    assert [list(g) for g in encoder.encode(later)] == want(later) and len(encoder.known) == known
    monkeypatch.setattr(wavelet, "KNOWN_BYTES", 1)
    monkeypatch.setattr(wavelet, "CHARS", 10)
    assert [list(g) for g in encoder.encode(first + later)] == want(first + later) and len(encoder.known) < known


def coded(docs, plain):
    at = 0
    for i, t in docs:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [0]
        yield i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_wavelet(spark, documents):
    _, plain = tokenizer()
    got = sorted(map(tuple, QUERIES["op5_wavelet"](spark, SMALL).collect()))
    assert got == sorted(coded(list(zip(documents.doc_id, documents.text)), plain))


def test_wavelet_odd(odd, empty):
    path, plain = tokenizer()
    got = wavelet.read_documents(wavelet.encoded_shards(odd, path, shard_ids=50)).orderBy("start").collect()
    lengths = Counter((r.doc_id, len(plain.encode(r.text or "", add_special_tokens=False).ids) + 1) for r in odd.collect())
    assert Counter((r.doc_id, r.n_tokens) for r in got) == lengths
    assert [r.start for r in got] == list(np.cumsum([0] + [r.n_tokens for r in got])[:-1])
    assert wavelet.read_documents(wavelet.encoded_shards(empty, path)).count() == 0


def best_of(rows, queries, k=5):
    """Brute force: (query_id, rank, vec_id, score) of every query row, vectors of its own length only."""
    sound = lambda x: x is not None and len(x) and None not in x and np.isfinite(x).all()
    whole = [(i, np.floor(256 * np.array(x, np.float32).astype(float)).astype(int)) for i, x in rows if i is not None and sound(x)]
    out = []
    for q, x in [(i, np.floor(256 * np.array(x, np.float32).astype(float)).astype(int)) for i, x in queries if i is not None and sound(x)]:
        scores = sorted((-int(x @ y), i) for i, y in whole if i != q and len(y) == len(x))[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [16, 2048])
def test_topk_odd(spark, block):
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(v) for v in rng.normal(0, 0.3, 8)]) for i in range(120)]
    rows += [(3, rows[3][1]), (200, None), (201, [None] * 8), (202, [float("nan")] * 8), (203, [float("inf")] * 8), (204, [1.0]), (None, rows[0][1]), (205, rows[7][1]),
             (0, rows[9][1]), (300, [0.5, 0.25]), (301, [0.5, -0.25]), (350, [0.1, 0.1]), (250, []), (400, [0.0] * 8), (402, rows[5][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("x", F.lit(1)).withColumn("score", F.lit("s"))
    queries = df.where("vec_id % 50 = 0 OR vec_id = 3")
    got = sorted(tuple(r) for r in topk.top_k(df, queries, block=block).collect())
    # Ids 0 and 3 ask twice, each row for itself; the short vectors meet only each other.
    assert got == best_of(rows, [r for r in rows if r[0] is not None and (r[0] % 50 == 0 or r[0] == 3)])
    assert Counter(q for q, *_ in got)[0] == 10 and sorted(v for q, _, v, _ in got if q == 300) == [301, 350]
    assert topk.top_k(df.where("false"), df.where("false")).count() == topk.top_k(df, df.where("false")).count() == 0


@pytest.mark.parametrize("kind", ["dense", "sparse", "copies", "hubs"])
def test_topk_over_many_blocks(spark, monkeypatch, kind):
    """Thresholds carry over from block to block, and ties across blocks go to the smaller id."""
    monkeypatch.setattr(topk, "QUERIES", 20)
    rng = np.random.default_rng(5)
    x = rng.normal(0, 0.3, (900, 12))
    if kind == "sparse":
        x[rng.random(x.shape) < 0.8] = 0
    if kind == "copies":
        x[rng.random(900) < 0.4] = x[0]
    if kind == "hubs":
        x[::90] *= 20
    rows = [(int(i), [float(v) for v in np.float32(r)]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in topk.top_k(df, df.where("vec_id % 10 = 0"), block=64).collect())
    assert got == best_of(rows, rows[::10])


def test_topk_stops_early():
    """Most queries are done before the last range of postings, and few vectors are rescored."""
    rng = np.random.default_rng(6)
    x = np.floor(256 * rng.normal(0, 0.3, (2048, 64))).astype(np.int64)
    index = topk.ImpactIndex(np.arange(2048), x, topk.impact_order(x))
    q = x[:100]
    got = index.top(q, np.arange(100), 5, np.full(100, -np.inf))
    plain = q @ x.T
    for i, (rows, score) in enumerate(got):
        plain[i, i] = -(2**62)
        best = np.lexsort((np.arange(2048), -plain[i]))[:5]
        assert rows.tolist() == best.tolist() and score.tolist() == plain[i][best].tolist()
    index.ranges = index.ranges[:-1] + [(np.zeros((1, 1), np.float32), np.zeros(1))]
    done = 0
    for i in range(100):
        try:
            index.top(q[i : i + 1], np.array([i]), 5, np.full(1, -np.inf))
            done += 1
        except ValueError:
            pass
    assert done > 90


def test_masks_hit_every_two_substitutions():
    from itertools import combinations

    for pair in combinations(range(13), 2):
        assert any(not ({off + k for k in m} & set(pair)) for m in decontaminate.MASKS for off in range(13 - decontaminate.SPAN + 1))


@pytest.mark.parametrize("limit", [500_000, 0])
def test_leaks(spark, odd, limit):
    item = [f"b{i}" for i in range(30)]
    changed = [w if k % 11 else "other" for k, w in enumerate(item)]
    docs = [(1, "pre " + " ".join(item) + " post"), (2, "some text before. " + " ".join(changed).upper()), (3, " ".join(item[:9])), (4, " ".join(f"c{i}" for i in range(500))),
            (5, None), (6, ""), (None, " ".join(item[4:20])), (7, "short item of eight words it is ok"), (8, "short item of eight words it is not"), (1, "pre " + " ".join(item) + " post")]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, "short item of eight words it is ok"), (4, "too short"), (1, " ".join(item))], "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(0))
    got = decontaminate.leaks(frame, bench, broadcast_rows=limit).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in got) == sorted([("1", 1), ("2", 1), ("None", 1), ("7", 3)])
    assert sorted(str(r.doc_id) for r in decontaminate.without_leaks(frame, bench, broadcast_rows=limit).collect()) == sorted(map(str, [3, 4, 5, 6, 8]))
    assert decontaminate.leaks(odd, bench).count() == 0 and decontaminate.leaks(odd.where("false"), bench.where("false")).count() == 0


def leaks_by_hand(docs, bench):
    """(doc_id, item_id) of every two that share a run along any alignment."""
    say = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = set()
    for i, text in docs:
        w = say(text)
        for item, passage in bench:
            p = say(passage)
            span = min(len(p), 13)
            spare = 2 if len(p) >= 13 else 1 if len(p) >= 10 else 0
            for start in range(-len(p), len(w) if p else 0):
                same = [0 <= start + k < len(w) and w[start + k] == x for k, x in enumerate(p)]
                inside = [0 <= start + k < len(w) for k in range(len(p))]
                runs = (k for k in range(len(p) - span + 1) if all(inside[k : k + span]))
                if any(sum(same[k : k + span]) >= span - spare for k in runs) and (len(p) >= decontaminate.PASSAGE or w == p):
                    out.add((i, item))
    return out


@pytest.mark.parametrize("limit", [500_000, 0])
def test_leaks_by_brute_force(spark, limit):
    rng = random.Random(5)
    bench = [(n, " ".join(f"b{rng.randrange(400)}" for _ in range(n))) for n in (1, 3, 4, 5, 7, 8, 9, 10, 11, 12, 13, 14, 20, 40)]
    bench += [(50, "yes yes yes yes yes yes"), (51, None), (52, "")]
    docs = []
    for n, text in bench[:14]:
        docs += [(rng.choice([None, 7, n]), text), (n, "so " + text + " it ends")]
        for edits in (1, 2, 3):
            words = text.split()
            for k in rng.sample(range(n), min(n, edits)):
                words[k] = "other"
            docs.append((rng.choice([None, 7, 100 + n]), f"before {' '.join(words)} after"))
    docs += [(60, "yes " * 9), (61, "yes yes yes"), (62, None), (63, ""), *docs[:6]]
    got = decontaminate.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"), broadcast_rows=limit
    ).collect()
    assert len(got) == len({(r.doc_id, r.item_id) for r in got})
    assert {(r.doc_id, r.item_id) for r in got} == leaks_by_hand(docs, bench)


def test_quality(spark):
    labels = pd.read_parquet("/root/testdata/sf0.01/labels.parquet")
    got = QUERIES["op8_quality"](spark, "/root/testdata/sf0.01").toPandas()
    again = QUERIES["op8_quality"](spark, "/root/testdata/sf0.01").toPandas()
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    assert got.sort_values("doc_id").score.tolist() == again.sort_values("doc_id").score.tolist()
    held = got.merge(labels)[lambda x: x.held_out]
    assert (held.predicted == held.quality).mean() > 0.95


def test_quality_odd(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 0), (3, None, None), (99, 1, 1), (7, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.scored(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert {r.score for r in got if r.doc_id in (4, 5, 6)} == {0.0}
    assert quality.scored(odd, labels.where("false")).count() == odd.count() and quality.scored(empty, labels).count() == 0


def test_licenses(spark, odd, empty):
    bsd = """/* Redistribution and use in source and binary
 * forms, with or without modification, are
 * permitted provided that the following
 * conditions are met: */"""
    gpl = """# This program is free software: you can
# redistribute it and/or modify it under the
# terms of the GNU General Public License
# as published by the Free Software Foundation"""
    mit = """Permission is hereby granted, free
of charge, to any person obtaining
a copy of this software and
associated documentation files"""
    plain = "words that run on and on with no end in sight "
    docs = [(1, "Some text.\n\nReleased under the MIT License.\n\nmore"), (2, "This work is licensed under the GNU General Public License, version 2."),
            (3, "the fishing licence is sold at the shop by the lake"), (4, None), (None, "Licensed under CC BY-NC 4.0."), (5, ""), (6, bsd), (7, gpl), (8, mit),
            (9, plain * 40 + "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. " + plain * 40)]
    docs += [(i, f"plain words number {i} go on and on here") for i in range(10, 60)]
    got = licenses.license_scan(spark.createDataFrame(docs, "doc_id long, text string").withColumn("words", F.lit("w")).withColumn("family", F.lit("f"))).collect()
    named = {(str(r.doc_id), r.paragraph, r.family) for r in got if r.family != "unknown"}
    assert named == {("1", 1, "MIT"), ("2", 0, "GPL"), ("None", 0, "CC-BY-NC"), ("6", 0, "BSD"), ("7", 0, "GPL"), ("8", 0, "MIT"), ("9", 0, "MPL")}
    assert licenses.license_scan(odd).count() == 0 and licenses.license_scan(empty).count() == 0


def test_licenses_brute_force(spark):
    """Every section of the smallest table, cut, scored and compared by hand with the fitted weights; notices planted and hard-wrapped."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    base = {r.doc_id: r.text or "" for r in docs.collect()}
    planted = dict(base)
    for n, texts in enumerate(licenses.TEMPLATES.values()):
        for i, template in enumerate(texts):
            host = base[sorted(base)[(7 * n + i) % len(base)]].split()
            at = len(host) // 2
            planted[10_000 + 100 * n + i] = " ".join(host[:at]) + "\n" + template.replace(" ", "\n", 3) + "\n" + " ".join(host[at:])
    frame = spark.createDataFrame(sorted(planted.items()), "doc_id long, text string")
    model = licenses.LicenseModel.fit(spark, frame)
    weights, bias = model.model.coefficientMatrix.toArray(), model.model.interceptVector.toArray()
    place = {pair: i for i, pair in enumerate(model.vocabulary.vocabulary)}
    names = [*licenses.TEMPLATES, licenses.UNKNOWN]
    stride = licenses.SECTION - max(len(w) for f in licenses.TEMPLATES for w in licenses._template_words(f))
    want = []
    for i, text in planted.items():
        for k, block in enumerate(re.split(r"\n[ \t\r]*\n", text)):
            words = ["#" if re.search("[0-9]", w) else w for w in re.findall(r"[^\W_]+", block.lower())]
            start = 0
            while words:
                part = words[start : start + licenses.SECTION]
                pairs = {f"{x} {y}" for x, y in zip(part, part[1:])}
                slots = [place[p] for p in pairs if p in place]
                z = (weights[:, slots].sum(1) + bias) / model.temperature
                p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
                if p[-1] < model.sure:
                    guess, held = (names[p.argmax()] if p.max() >= model.least else "unknown"), 0.0
                    for w in licenses._template_words(guess) if guess in licenses.TEMPLATES else []:
                        own = {f"{x} {y}" for x, y in zip(w, w[1:])}
                        held = max(held, len(own & pairs) / len(own))
                    want.append((i, k, start, guess if held >= licenses.CONFIRMED else "unknown", round(p.max(), 6), round(held, 9)))
                if start + licenses.SECTION >= len(words):
                    break
                start += stride
    rows = licenses.license_scan(frame).collect()
    assert sorted(want) == sorted((r.doc_id, r.paragraph, r.start, r.family, round(r.probability, 6), round(r.overlap, 9)) for r in rows)
    caught = {(r.doc_id, r.family) for r in rows}
    for n, family in enumerate(licenses.TEMPLATES):
        assert np.mean([(10_000 + 100 * n + i, family) in caught for i in range(len(licenses.TEMPLATES[family]))]) >= 0.75, family
    clean = {i for i, t in base.items() if not re.search("(?i)licen[sc]|copyright|public domain|rights", t)}
    assert not [r for r in rows if r.doc_id in clean and r.family != "unknown"]


def test_hilbert_visits_neighbours(spark):
    cells = spark.range(16**3).select(*[(F.floor(F.col("id") / 16**k) % 16).cast("int").alias("xyz"[k]) for k in range(3)])
    rows = sorted((r.h, r.x, r.y, r.z) for r in cells.select("*", sharding.hilbert_index([F.col(c) for c in "xyz"], 4).alias("h")).collect())
    assert [r[0] for r in rows] == list(range(4096))
    assert all(sum(abs(a - b) for a, b in zip(p[1:], q[1:])) == 1 for p, q in zip(rows, rows[1:]))


def test_sharding_odd(spark, odd, empty):
    for rows in (sharding.hilbert_shards(odd, 4).collect(), QUERIES["op10_sharding"](spark, SMALL).collect()):
        counts = Counter(r.shard for r in rows)
        assert max(counts.values()) - min(counts.values()) <= 1
        assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(n)) for s, n in counts.items())
    rows = sharding.hilbert_shards(odd, 4).collect()
    want = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in odd.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    assert sharding.hilbert_shards(empty).count() == 0


def test_pipeline(spark, odd, empty):
    import corpus_pipeline

    for docs in (odd, empty):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SMALL)
            assert out.columns[: len(docs.columns)] == docs.columns or k == len(corpus_pipeline.STAGES) - 1
            docs = out
        docs.count()
    raw = spark.read.parquet(f"{SMALL}/documents.parquet")
    bench = {r.item_id: r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    final = corpus_pipeline.run(spark, SMALL).toPandas()
    texts = {r.doc_id: r.text for r in raw.collect()}
    scores = {r.doc_id: r.predicted for r in QUERIES["op8_quality"](spark, SMALL).collect()}
    good = sorted((i, t) for i, t in texts.items() if scores[i])
    kept = {i for i, c in classes(good).items() if i == c}
    clean = {i for i in kept if not any(" ".join(b.split()) in " ".join(texts[i].split()) for b in bench.values())}
    assert set(final.doc_id) <= clean and set(final.shard) <= set(range(40))
    assert max(Counter(final.doc_id).values()) <= 3

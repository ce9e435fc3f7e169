"""Spelling variants: words one edit apart, found by pivotal grams.

A word's bigram places are ordered by how rare the bigram is among all words.
The first three places (and all further places of the third one's bigram) are
its prefix, and dynamic programming picks two places of the prefix that share
no character and are rarest together: its pivots. One edit changes at most one
of two disjoint places. So of two words one edit apart, the one whose prefix
ends first has a pivot that the other one's prefix holds too, at most one place
further left or right (Deng, Li and Feng, 2014).

One edit also leaves the first or the last half of a word as it is, and one
half of what remains. These unchanged parts belong to the key under which
pivots meet prefixes, so frequent bigrams of a small alphabet don't bring
together what differs everywhere. What meets is verified by edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.common import query, table
from fieldtally.llm.wordhash import sliced
from fieldtally.session import settle

#: Frequencies of so many bigrams at most travel to the tasks; all others count as rarest, which changes speed alone.
KNOWN_GRAMS = 65_536
#: Distinct words a task counts before it passes them on.
HELD_WORDS = 300_000
GRAM, PREFIX, PIVOTS = 2, 3, 2


def _letters(chars: str) -> re.Pattern:
    return re.compile(f"[{chars}]+")


def noisy_word(doc_id: str, run: str, every: int = 31) -> str:
    """``run`` with one of its letters deleted where the checksum of id and run says so."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    return run if h % every else run[: h % len(run)] + run[h % len(run) + 1 :]


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", letters: str = r"A-Za-zÀ-ÿ", shortest: int = 7, least: int = 2, every: int = 31) -> DataFrame:
    """word and n of the words of all texts (see ``noisy_word``) with ``shortest`` letters and ``least`` occurrences or more."""

    def part(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs, seen = _letters(letters), Counter()
        for frame, texts in sliced(frames):
            for name, raw in zip(frame["name"], texts):
                # bytes.lower() touches A to Z only.
                for run, n in Counter(runs.findall(raw.lower().decode("utf-8", "replace"))).items():
                    if len(run) >= shortest:
                        word = noisy_word(name, run, every)
                        if len(word) >= shortest:
                            seen[word] += n
            if len(seen) > HELD_WORDS:
                yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})
                seen.clear()
        if seen:
            yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})

    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("name"), F.col(text).alias("text"))
    counted = rows.mapInPandas(part, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least)


def pivots(places: list[tuple[int, int]], wanted: int = PIVOTS, width: int = GRAM) -> list[int]:
    """Of (position, weight) places, the positions of ``wanted`` that don't overlap and weigh least together."""
    places = sorted(places)
    # best[k]: the cheapest choice of k places among those seen, with its weight, for each place as the last one.
    best: list[list[tuple[int, list[int]] | None]] = []
    for i, (at, weight) in enumerate(places):
        row: list[tuple[int, list[int]] | None] = [(weight, [at])]
        for k in range(1, wanted):
            earlier = [best[j][k - 1] for j in range(i) if places[j][0] + width <= at and best[j][k - 1]]
            row.append(min(((w + weight, [*chosen, at]) for w, chosen in earlier), default=None))
        best.append(row)
    return min((row[-1] for row in best if row[-1]), default=(0, []))[1]


def prefix_places(word: str, frequency: dict[str, int]) -> list[tuple[int, int]]:
    """(position, weight) of the places in a word's prefix."""
    grams = [(frequency.get(word[p : p + GRAM], 0), word[p : p + GRAM], p) for p in range(len(word) - GRAM + 1)]
    grams.sort()
    last = grams[min(PREFIX, len(grams)) - 1][:2]
    return [(p, w) for w, g, p in grams if (w, g) <= last]


def unchanged(word: str) -> set[str]:
    """What one edit may leave: words one edit apart share one of these, whichever of them is shorter."""
    size, out = len(word), set()
    for half in {size // 2, (size - 1) // 2}:
        quarter = half // 2
        out |= {f"{word[: half + quarter]}<", f"{word[:half]}<{word[size - quarter :]}",
                f">{word[size - half - quarter :]}", f"{word[:quarter]}>{word[size - half :]}"}
    return out


def _keys(words: DataFrame, frequency: dict[str, int]) -> DataFrame:
    """One row for each place in a word's prefix and each part that may be unchanged."""

    def part(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for word, n in zip(frame["word"], frame["n"]):
                places = prefix_places(word, frequency)
                chosen = pivots(places)
                for kept in unchanged(word):
                    rows += [(f"{word[p : p + GRAM]} {kept}", word, n, p, p in chosen) for p, _ in places]
            yield pd.DataFrame(rows, columns=["key", "word", "n", "at", "pivot"])

    keyed = words.mapInPandas(part, "key string, word string, n long, at int, pivot boolean")
    return keyed.select(F.xxhash64("key").alias("key"), "word", "n", "at", "pivot")


def near_words(words: DataFrame, known_grams: int = KNOWN_GRAMS) -> DataFrame:
    """word, n, near and near_n: every two words of (word, n) exactly one insertion, deletion or replacement apart, both ways.

    Words are distinct and have 7 characters or more (the prefix needs two
    disjoint bigrams, the halves some length).
    """
    # As many pieces as bigrams start in the word: its length less one.
    places = F.sequence(F.lit(1), F.char_length("word") - 1)
    grams = words.select(F.explode(F.transform(places, lambda p: F.substr("word", p, F.lit(GRAM)))).alias("gram")).groupBy("gram").count()
    # A gram outside this bounded list counts as rarest; any order that all words share is right.
    common = grams.orderBy(F.desc("count"), "gram").limit(known_grams)
    frequency = {r["gram"]: r["count"] for r in common.collect()}
    keys = settle(_keys(words, frequency), "grams")
    side = lambda tag: [F.col(c).alias(f"{tag}_{c}") for c in ("word", "n", "at")]
    left = keys.where("pivot").select("key", *side("a"))
    right = keys.select("key", *side("b"))
    apart = (
        (F.abs(F.col("a_at") - F.col("b_at")) <= 1)
        & (F.abs(F.char_length("a_word") - F.char_length("b_word")) <= 1)
        & (F.levenshtein(F.col("a_word"), F.col("b_word"), 1) == 1)
    )
    met = left.join(right, (left["key"] == right["key"]) & apart)
    turned = F.col("a_word") > F.col("b_word")
    pick = lambda p, q, c: F.when(turned, F.col(f"{q}_{c}")).otherwise(F.col(f"{p}_{c}"))
    once = met.select(pick("a", "b", "word").alias("a"), pick("a", "b", "n").alias("n_a"), pick("b", "a", "word").alias("b"), pick("b", "a", "n").alias("n_b")).distinct()
    both = F.array(F.struct(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
                   F.struct(F.col("b").alias("word"), F.col("n_b").alias("n"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))
    return once.select(F.inline(both))


def roots(forms: DataFrame) -> DataFrame:
    """word and root of (word, form): the end of the chain of forms. Chains must not close.

    Each step doubles the reach and is written, so a lost executor costs one.
    """
    reach = settle(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = reach.select(F.col("word").alias("root"), F.col("root").alias("then"))
        step = settle(reach.join(further, "root", "left").select("word", F.coalesce("then", "root").alias("root"), F.col("then").isNotNull().alias("moved")), "roots")
        reach = step.select("word", "root")
        if step.where("moved").isEmpty():
            return reach


def variant_groups(words: DataFrame, ratio: int = 10) -> DataFrame:
    """word, form, root, n, n_near and form_n of every row of (word, n).

    A word's form is its near word of largest n (ties: the smallest in
    code-point order), if that has ``ratio`` times its own n or more; its root
    is where the chain of forms ends. A word without near words has n_near 0,
    form NULL and itself as root. An empty table gives an empty result.
    """
    best = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.first("n").alias("own"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("top"))
    usual = -F.col("top.less")
    enough = usual >= F.col("own") * ratio
    found = settle(best.select("word", "n_near", F.when(enough, F.col("top.near")).alias("form"), F.when(enough, usual).alias("form_n")), "near-words")
    ends = roots(found.where(F.col("form").isNotNull()))
    return words.join(found, "word", "left").join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ratio: int = 10, **counting) -> DataFrame:
    """``variant_groups`` of the words of all texts.

    NULL and empty texts have no words; a row without an id counts under the
    empty name; rows that repeat an id or a text count each time; further
    columns play no part.
    """
    return variant_groups(settle(word_counts(docs, doc_id, text, **counting), "words"), ratio)


@query("op11_spelling")
def op11_spelling(spark, sf_dir):
    """Every word of the whole table with its usual form."""
    return spelling_variants(table(spark, sf_dir, "documents"))

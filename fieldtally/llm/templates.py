"""Line dedup by a tree of log templates: lines whose template recurs across documents are dropped.

The tree has fixed depth: a line goes down by its number of tokens and its
first three tokens, where a token with a digit counts as a variable field. In
the leaf it reaches, a token that few of the leaf's different lines have at
its place is a variable field too. If enough of a line's tokens stay fixed, its
template is the line with its fields blanked, else the line itself. All of
this is counting, so the result depends on no order of lines, and a leaf with
any number of lines is spread over places and tokens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.common import query, table
from fieldtally.session import settle

DEPTH, FIELD = 3, "<*>"


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _tokens(line: Column) -> Column:
    # Splitting at one plain character needs no pattern, which would be compiled for each line.
    return F.filter(F.split(line, " "), lambda t: t != "")


def _masked(text: Column) -> Column:
    """The tokens of every line, fields blanked; a line of nothing but fields keeps its tokens."""
    spaced = lambda part: F.regexp_replace(part, r"[\x09\x0B-\x0D]", " ")
    # Cut at its first digit, which becomes a 0: then the tokens that end in 0 are those with a digit.
    cut = F.regexp_replace(spaced(F.coalesce(text, F.lit(""))), r"[0-9][^ \n]*+", "0")
    field = lambda t: F.endswith(t, F.lit("0"))
    bare = lambda line: F.forall(F.split(line, " "), lambda t: (t == "") | field(t))
    blank = lambda t: F.when(field(t), F.lit(FIELD)).otherwise(t)
    lines = F.arrays_zip(_split(text).alias("plain"), F.split(cut, "\n").alias("cut"))
    return F.transform(lines, lambda x: F.when(bare(x["cut"]), _tokens(spaced(x["plain"]))).otherwise(F.transform(_tokens(x["cut"]), blank)))


def _key(masked: Column) -> Column:
    return F.xxhash64(masked)


def _leaf(masked: Column) -> Column:
    return F.xxhash64(F.size(masked), F.slice(masked, 1, DEPTH))


def _row(doc_id: Column, text: Column) -> Column:
    return F.unhex(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")))))


def drop_template_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_docs: int = 3, fixed: float = 0.7, common: float = 0.2,
) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept (the other lines) of every row.

    A template recurs if lines of ``min_docs`` documents or more have it; all
    of them are dropped. A token is fixed if at least two and a share
    ``common`` of the leaf's different lines have it at its place, or the leaf
    has one line only; a line is generalised if a share ``fixed`` of its
    tokens is. A line of one or two tokens has a leaf to itself, so it is
    dropped where it recurs as it is, digits aside. A line of nothing but
    fields, such as a number, recurs only unchanged. Lines without a token are
    layout and stay.

    NULL and empty texts are one empty line; a line may have any length; rows
    that share an id, and rows without one, count as one document, but each
    is worked on by itself, under a digest of id and text; further columns
    play no part.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), _row(F.col(doc_id), F.col(text)).alias("row"))
    # As the generator's output, a line's tokens are worked out once, whatever is read of them later.
    masked = base.select("doc_id", "row", F.posexplode(_masked(F.col("text"))).alias("at", "masked"))
    lines = settle(
        masked.where(F.size("masked") > 0).select("doc_id", "row", "at", _leaf(F.col("masked")).alias("leaf"), _key(F.col("masked")).alias("line")),
        "lines",
    )
    # A leaf that one document has alone holds nothing that recurs.
    leaves = lines.groupBy("leaf").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.max(F.col("doc_id").isNull()).alias("none"))
    lively = leaves.where("lo < hi OR (none AND lo IS NOT NULL)").select("leaf")
    candidates = settle(lines.join(lively, "leaf"), "candidates")
    # A leaf with one line keeps it as it is; of the others, the words of each different line are read at one place.
    forms = candidates.groupBy("leaf", "line").agg(F.min(F.struct("row", "at")).alias("place"))
    sizes = forms.groupBy("leaf").agg(F.count(F.lit(1)).alias("forms"))
    wanted = forms.join(sizes.where("forms > 1"), "leaf").groupBy(F.col("place.row").alias("row")).agg(
        F.collect_list(F.struct("place.at", "leaf", "line", "forms")).alias("wanted")
    )
    texts = base.join(wanted, "row").select("wanted", _masked(F.col("text")).alias("masked"))
    found = texts.select(F.inline(F.transform("wanted", lambda w: F.struct(
        w["leaf"].alias("leaf"), w["line"].alias("line"), w["forms"].alias("forms"), F.get(F.col("masked"), w["at"]).alias("masked")
    ))))
    distinct = settle(found.dropDuplicates(["leaf", "line"]), "forms")
    placed = distinct.select("leaf", "line", "forms", F.posexplode("masked").alias("place", "token"))
    support = placed.groupBy("leaf", "place", "token").agg(F.count(F.lit(1)).alias("support"))
    judged = placed.join(support, ["leaf", "place", "token"]).withColumn(
        "kept", (F.col("support") >= 2) & (F.col("support") >= F.col("forms") * common)
    )
    blank = F.when(F.col("kept"), F.col("token")).otherwise(F.lit(FIELD))
    general = judged.groupBy("leaf", "line").agg(
        F.sort_array(F.collect_list(F.struct("place", blank.alias("token")))).alias("slots"),
        F.sum(F.col("kept").cast("int")).alias("n_kept"), F.count(F.lit(1)).alias("n"),
    ).where(F.col("n_kept") >= F.col("n") * fixed)
    template = general.select("leaf", "line", F.xxhash64("leaf", F.col("slots.token")).alias("general"))
    shaped = settle(
        candidates.join(template, ["leaf", "line"], "left").select(
            "doc_id", "row", "at", F.coalesce("general", F.xxhash64("leaf", "line")).alias("template")
        ),
        "templates",
    )
    in_docs = shaped.select("template", "doc_id").distinct().groupBy("template").agg(F.count(F.lit(1)).alias("docs"))
    gone = shaped.join(in_docs.where(F.col("docs") >= min_docs), "template").groupBy("row").agg(F.sort_array(F.collect_set("at")).alias("gone"))
    split = base.join(gone, "row", "left").select("doc_id", F.col("gone"), _split(F.col("text")).alias("lines"))
    # The stretches between dropped lines, one slice each: linear however many lines there are and go.
    after = lambda i: F.when(i > 0, F.get("gone", i - 1) + 1).otherwise(F.lit(0))
    until = lambda i: F.coalesce(F.get("gone", i), F.size("lines"))
    stretches = F.transform(F.sequence(F.lit(0), F.size("gone")), lambda i: F.slice("lines", after(i) + 1, until(i) - after(i)))
    kept = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(F.flatten(stretches))
    return split.withColumn("kept", kept).select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
        F.array_join("kept", "\n").alias("kept"),
    )


@query("op2_templates")
def op2_templates(spark, sf_dir):
    """What is left of every document's lines, as a digest."""
    return drop_template_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )

"""Exact dedup by content-defined chunk recipes (DataFrame functions only).

Every text is normalised (each whitespace run becomes one space) and cut
where its own content says so, so equal texts are cut alike. The distinct
chunks get verified identifiers; a text's recipe is its ordered list of
identifiers, and texts are equal when their recipes are. Only distinct chunks
travel whole (once, after map-side combine); from then on a document is
represented by one identifier per one to four thousand characters.

Defined results: null text counts as empty; the empty text has the empty
recipe; the smallest id of a group stays and null ids are never smallest (in
a group of null ids only, all rows stay, with a null ``keep_id``); repeated
rows of the id that stays are all kept; an empty table gives an empty result;
columns that clash with the output names are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from indicata.llm.common import attach, materialize

#: A chunk ends after one of these word ends (set by content, about one in
#: forty characters of prose) once it has LEAST characters, or else at MOST.
BOUNDARY = "[aeiou][dglmrstxz][.,;:!?]? "
LEAST, MOST = 1000, 4000


def normalised(text: Column) -> Column:
    """The text with every run of space, tab .. return as one space."""
    one = F.coalesce(text, F.lit(""))
    for ch in "\t\n\x0b\x0c\r":
        one = F.replace(one, F.lit(ch), F.lit(" "))
    return F.when(F.contains(one, F.lit("  ")), F.regexp_replace(one, "  +", " ")).otherwise(one)


def chunks_of(norm: Column, least: int = LEAST, most: int = MOST) -> Column:
    """Chunks of a normalised text, in order; they concatenate to it."""
    return F.regexp_extract_all(
        norm, F.lit(f"(?s).{{{least}}}.{{0,{most - least}}}?(?:{BOUNDARY})|.{{1,{most}}}"), 0)


def recipes(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
            hash_of: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """(id_col, text_sha256, recipe) of every row, materialized.

    A chunk's identifier is its 64-bit hash and its rank among the distinct
    chunks with that hash. The dictionary groups chunks by their whole bytes,
    so different chunks never share an identifier; ranks above zero
    (collisions) are all that is joined back to the documents.
    """
    norm = docs.select(F.col(id_col), normalised(F.col(text)).alias("norm"))
    cut = norm.select(
        id_col, F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
        chunks_of(F.col("norm")).alias("chunks"))
    dictionary = cut.select(F.explode("chunks").alias("chunk")) \
        .select(hash_of(F.col("chunk")).alias("h"), "chunk").distinct()
    shared = materialize(dictionary.groupBy("h").agg(F.count("*").alias("n"))
                         .filter("n > 1").select("h"), "shared-hashes")
    plain = cut.withColumn("recipe", F.transform(
        "chunks", lambda c: F.struct(hash_of(c).alias("h"), F.lit(0).alias("rank"))))
    if shared.isEmpty():
        return materialize(plain.drop("chunks"), "recipes")
    ranks = dictionary.join(shared, "h").select("h", "chunk", (F.row_number().over(
        Window.partitionBy("h").orderBy("chunk")) - 1).cast("int").alias("rank"))
    at = cut.select("text_sha256", F.posexplode("chunks").alias("pos", "chunk")).distinct() \
        .withColumn("h", hash_of(F.col("chunk")))
    exact = at.join(materialize(ranks, "ranks"), ["h", "chunk"], "left") \
        .groupBy("text_sha256").agg(F.sort_array(F.collect_list(F.struct(
            "pos", "h", F.coalesce("rank", F.lit(0)).alias("rank")))).alias("list")) \
        .select("text_sha256", F.expr("transform(list, x -> struct(x.h, x.rank))").alias("recipe"))
    return materialize(cut.select(id_col, "text_sha256").join(exact, "text_sha256", "left")
                       .withColumn("recipe", F.coalesce(
                           "recipe", F.expr("cast(array() as array<struct<h:bigint,rank:int>>)")))
                       .select(id_col, "text_sha256", "recipe"), "recipes")


def dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
          hash_of: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per row of ``docs``: id_col, keep_id, group_size, kept, text_sha256."""
    rows = recipes(docs, id_col, text, hash_of)
    groups = materialize(
        rows.groupBy("recipe").agg(F.min(id_col).alias("keep_id"),
                                   F.count("*").alias("group_size"))
        .filter("group_size > 1"), "recipe-groups")
    out = attach(rows, groups, ["recipe"], "group_size", F.col("text_sha256"))
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col(id_col)).otherwise(F.col("keep_id"))
    return out.select(
        id_col, keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col(id_col).eqNullSafe(keep).alias("kept"), "text_sha256")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each text: the smallest id's (any of its rows,
    where it is repeated; of a text with null ids only, one of those)."""
    judged = dedup(docs, id_col, text)
    gone = materialize(judged.filter("not kept").select(
        F.col(id_col).alias("_id"), F.col("text_sha256").alias("_sha")).distinct(), "recipes-gone")
    again = judged.filter("kept").groupBy(id_col, "text_sha256").count().filter("count > 1")
    left = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_i"),
                       F.sha2(normalised(F.col(text)).cast("binary"), 256).alias("_of")).join(
        gone, F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_of") == F.col("_sha")), "left_anti")
    if not again.isEmpty():
        left = left.dropDuplicates(["_i", "_of"])
    return left.select("_row.*")

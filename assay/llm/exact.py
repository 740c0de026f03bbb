"""Exact dedup by content-defined chunk recipes, in DataFrame functions only.

The normalised text is cut where its own content says so (after a word with a
given ending once a least length is reached, at a greatest length otherwise),
so that a passage that many documents share is cut alike in each.  The chunks
of all documents are deduplicated in a catalogue by a short hash, and verified:
a short hash that stands for a single SHA-256 digest is the identifier, the
chunks of any other get their digest beside it.  A document is then its recipe,
the ordered list of identifiers, and documents with equal recipes are equal:
groups are made, and joined back, by a digest of the recipe.  No text leaves the
task that has read it, only 40 bytes for each chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.llm.staging import stage

SPACES = r"[\x20\x09-\x0D]+"
MIN_CHARS, MAX_CHARS = 256, 4096
#: What ends a chunk: a space after a word with one of these endings, as there is one in some hundred characters.
CUT = r"(?<=[dlst][aeiou][nrst])\x20"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def chunks(norm: Column, least: int = MIN_CHARS, most: int = MAX_CHARS) -> Column:
    """Content-defined chunks of a text, in order; together they are the text."""
    return F.regexp_extract_all(norm, F.lit(f"(?s).{{{least},{most - 1}}}?{CUT}|.{{1,{most}}}"), F.lit(0))


def _hashed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    norm = docs.select(F.col(doc_id).alias("doc_id"), normalised(F.col(text)).alias("norm"))
    return norm.select("doc_id", F.sha2("norm", 256).alias("text_sha256"), F.transform(
        chunks(F.col("norm")),
        lambda c: F.struct(F.xxhash64(c).alias("short"), F.unhex(F.sha2(c, 256)).alias("strong"))).alias("chunks"))


def ambiguous_hashes(hashed: DataFrame) -> DataFrame:
    """Short hashes that stand for more than one chunk."""
    catalogue = hashed.select(F.explode("chunks").alias("c")).select("c.short", "c.strong").distinct()
    return catalogue.groupBy("short").agg(F.count("*").alias("n")).where("n > 1").select("short")


def recipes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_sha256, recipe, copies``: one row for each id and text,
    ``copies`` the number of its rows; ``recipe`` is a digest of the identifiers
    in order, none for an empty text."""
    hashed = stage(_hashed(docs, doc_id, text), "chunks")
    ambiguous = stage(ambiguous_hashes(hashed), "ambiguous")
    bare = F.transform("chunks", lambda c: F.struct(c["short"].alias("short"), F.lit(None).cast("binary").alias("strong")))
    if ambiguous.isEmpty():       # else the digests of the documents concerned come in
        named = hashed.withColumn("recipe", bare)
    else:
        whole = (hashed.select("text_sha256", F.explode("chunks.short").alias("short"))
                 .join(ambiguous, "short", "left_semi").select("text_sha256").distinct().withColumn("whole", F.lit(True)))
        named = hashed.join(whole, "text_sha256", "left").withColumn(
            "recipe", F.when(F.col("whole"), F.col("chunks")).otherwise(bare))
    name = lambda c: F.concat(F.hex(c["short"]), F.lit(":"), F.coalesce(F.hex(c["strong"]), F.lit("")))
    named = named.withColumn("recipe", F.unhex(F.sha2(F.array_join(F.transform("recipe", name), ","), 256)))
    return named.groupBy("doc_id", "text_sha256", "recipe").agg(F.count("*").alias("copies"))


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, copies, text_sha256``: one row for each id
    and text; ``group_size`` counts rows."""
    rec = stage(recipes(docs, doc_id, text), "recipes")
    groups = rec.groupBy("recipe").agg(F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    return rec.join(groups, "recipe").select("doc_id", "keep_id", "group_size", "copies", "text_sha256")


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, keep_id, group_size, kept,
    text_sha256``.

    Null counts as the empty text, and empty texts are equal.  Of equal texts
    the smallest id stays; rows without an id come last, and have a null
    ``keep_id`` only if the whole group has no id.  Of rows that share id and
    text exactly one is kept.  Other columns play no part.
    """
    rows = exact_groups(docs, doc_id, text).select("*", F.explode(F.expr("sequence(1L, copies)")).alias("nth"))
    return rows.select("doc_id", "keep_id", "group_size",
                       (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"), "text_sha256")


def drop_exact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, unchanged, their columns in their order.
    Groups are those of :func:`exact_groups`; a row is found again by its id and
    text.  Of repeated rows one stays, null ids and texts as there."""
    stay = stage(exact_groups(docs, doc_id, text).where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
                 .select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_digest"), "copies"), "stay")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(doc_id).alias("of_id"),
                        F.sha2(normalised(F.col(text)), 256).alias("of_digest"))
    on = [F.col("of_id").eqNullSafe(F.col("_id")), F.col("of_digest") == F.col("_digest")]
    kept = keyed.join(stay.where("copies = 1"), on, "left_semi")
    if not stay.where("copies > 1").isEmpty():
        several = keyed.join(stay.where("copies > 1"), on, "left_semi").groupBy("of_id", "of_digest").agg(F.any_value("row").alias("row"))
        kept = kept.unionByName(several)
    return kept.select("row.*")

"""License scans by diagonal voting, in DataFrame functions only.

Texts and templates are sequences of words.  The rolling word 2-grams of all
texts are hashed and joined to the positions at which templates have the same
2-gram.  A match votes for a diagonal, the text position less the template
position: words that stand as in the template vote for the same one.  A short
phrase is found where its diagonal has a vote from each of its 2-grams.  For
longer passages neighbouring diagonals, between which words were put in or left
out, are merged into a band, and the span of a band is verified: a band counts
if enough of the template's 2-grams are in it, over a span not much longer than
the template.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: What separates words, after A-Z are lower-cased.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: The base phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Passages of the licenses' own texts or notices.
PASSAGES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", "mit"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance "
     "with the license", "apache"),
    ("unless required by applicable law or agreed to in writing software distributed under the license is distributed "
     "on an as is basis without warranties or conditions of any kind either express or implied", "apache"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("this work is licensed under a creative commons attribution", "cc"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
)


#: Whole texts of short licenses, without their copyright lines.
TEXTS = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction including without limitation the "
     "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
     "persons to whom the software is furnished to do so subject to the following conditions the above copyright notice "
     "and this permission notice shall be included in all copies or substantial portions of the software the software is "
     "provided as is without warranty of any kind express or implied including but not limited to the warranties of "
     "merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright "
     "holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise "
     "arising from out of or in connection with the software or the use or other dealings in the software", "mit"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
     "provided that the above copyright notice and this permission notice appear in all copies the software is provided "
     "as is and the author disclaims all warranties with regard to this software including all implied warranties of "
     "merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential "
     "damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract "
     "negligence or other tortious action arising out of or in connection with the use or performance of this software", "isc"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met 1 redistributions of source code must retain the above copyright notice this list of "
     "conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice "
     "this list of conditions and the following disclaimer in the documentation and or other materials provided with the "
     "distribution this software is provided by the copyright holders and contributors as is and any express or implied "
     "warranties including but not limited to the implied warranties of merchantability and fitness for a particular "
     "purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect "
     "incidental special exemplary or consequential damages including but not limited to procurement of substitute goods "
     "or services loss of use data or profits or business interruption however caused and on any theory of liability "
     "whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of "
     "this software even if advised of the possibility of such damage", "bsd"),
    ("this software is provided as is without any express or implied warranty in no event will the authors be held liable "
     "for any damages arising from the use of this software permission is granted to anyone to use this software for any "
     "purpose including commercial applications and to alter it and redistribute it freely subject to the following "
     "restrictions 1 the origin of this software must not be misrepresented you must not claim that you wrote the original "
     "software if you use this software in a product an acknowledgment in the product documentation would be appreciated "
     "but is not required 2 altered source versions must be plainly marked as such and must not be misrepresented as being "
     "the original software 3 this notice may not be removed or altered from any source distribution", "zlib"),
)


@dataclass(frozen=True)
class Params:
    phrases: tuple[tuple[str, str], ...] = PHRASES
    passages: tuple[tuple[str, str], ...] = PASSAGES + TEXTS
    neighbours: int = 3          # diagonals at most so far apart are merged
    covered: float = 0.6         # of a passage's 2-grams
    stretched: float = 1.5       # longest span, in lengths of the passage


PRODUCTION = Params()


def word_list(text: Column) -> Column:
    lower = F.lower(F.coalesce(text, F.lit("")))
    return F.array_remove(F.split(lower, BETWEEN_WORDS), "")


def template_grams(spark: SparkSession, p: Params, own: DataFrame | None = None) -> DataFrame:
    """``template, label, exact, grams, place, first, second, gram``: a row for
    each 2-gram of each template.  ``own``: further texts of licenses of any
    length, ``label, text``; those of fewer than two words are left out."""
    listed = [(t, label, True) for t, label in p.phrases] + [(t, label, False) for t, label in p.passages]
    fixed = F.array(*[F.struct(F.lit(i).cast("string").alias("template"), F.lit(label).alias("label"), F.lit(exact).alias("exact"),
                               F.split(F.lit(t), " ").alias("w")) for i, (t, label, exact) in enumerate(listed)])
    words = spark.range(1).select(F.inline(fixed))
    if own is not None:
        words = words.unionByName(own.select(F.sha2(F.col("text"), 256).alias("template"), "label", F.lit(False).alias("exact"),
                                             word_list(F.col("text")).alias("w")).where(F.size("w") > 1).distinct())
    grams = words.select("template", "label", "exact", (F.size("w") - 1).alias("grams"),
                         F.posexplode(F.arrays_zip(F.col("w").alias("a"), F.slice("w", 2, F.size("w")).alias("b"))).alias("place", "pair"))
    return grams.where("pair.b is not null").select(
        "template", "label", "exact", "grams", "place", F.col("pair.a").alias("first"), F.col("pair.b").alias("second"),
        F.xxhash64("pair.a", "pair.b").alias("gram"))


def votes(texts: DataFrame, p: Params, own: DataFrame | None = None) -> DataFrame:
    """``id, digest, template, label, exact, grams, diagonal, places``: the
    template places that vote for each diagonal.

    ``texts``: ``id, digest, words``; rows that share id and digest vote as one.
    """
    pairs = texts.select("id", "digest", F.posexplode(F.arrays_zip(
        F.col("words").alias("a"), F.slice("words", 2, F.greatest(F.size("words"), F.lit(1))).alias("b"))).alias("at", "pair"))
    pairs = pairs.select("id", "digest", "at", F.col("pair.a").alias("a"), F.col("pair.b").alias("b")).withColumn("gram", F.xxhash64("a", "b"))
    met = pairs.join(template_grams(texts.sparkSession, p, own), "gram").where("a = first and b = second")
    return (met.withColumn("diagonal", F.col("at") - F.col("place"))
            .groupBy("id", "digest", "template", "label", "exact", "grams", "diagonal").agg(F.collect_set("place").alias("places")))


def bands(voted: DataFrame, p: Params) -> DataFrame:
    """``id, digest, label, start, end, share``: verified spans of passages, in words."""
    key = ["id", "digest", "template"]
    order = W.partitionBy(*key).orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(order) > p.neighbours
    banded = (voted.where("not exact").withColumn("band", F.sum(F.coalesce(gap, F.lit(True)).cast("int")).over(order))
              .withColumn("start", F.col("diagonal") + F.array_min("places"))
              .withColumn("end", F.col("diagonal") + F.array_max("places") + 2))
    whole = W.partitionBy(*key, "band")
    banded = banded.withColumn("span", F.max("end").over(whole) - F.min("start").over(whole))
    long = F.col("span") > p.stretched * (F.col("grams") + 1)
    merged = (banded.where(~long).groupBy(*key, "label", "grams", "band")
              .agg(F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("found"),
                   F.min("start").alias("start"), F.max("end").alias("end")))
    good = F.col("share") >= p.covered
    fits = (merged.withColumn("share", F.col("found") / F.col("grams")).where(good)
            .select("id", "digest", "label", "start", "end", "share"))
    # Longer bands by cells of diagonals, and by cells half a cell further on: a
    # passage whose diagonals are near each other is whole in one of them.
    step = F.greatest(F.lit(1), F.floor((p.stretched - 1) * (F.col("grams") + 1)))
    half = F.floor(step / 2)
    cells = F.explode(F.array(F.struct(F.lit(0).alias("phase"), F.floor(F.col("diagonal") / step).alias("cell")),
                              F.struct(F.lit(1).alias("phase"), F.floor((F.col("diagonal") + half) / step).alias("cell")))).alias("c")
    parts = (banded.where(long).select(*key, "label", "grams", "places", "start", "end", cells)
             .groupBy(*key, "label", "grams", "c.phase", "c.cell")
             .agg(F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("found"), F.min("start").alias("start"), F.max("end").alias("end"))
             .withColumn("share", F.col("found") / F.col("grams")).where(good))
    first, second = parts.where("phase = 0"), parts.where("phase = 1")
    taken = first.select(*[F.col(k).alias(f"_{k}") for k in key], F.explode(F.array("cell", F.col("cell") + 1)).alias("_cell"))
    met = (F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")) & (F.col("template") == F.col("_template"))
           & (F.col("cell") == F.col("_cell")))
    apart = first.unionByName(second.join(taken, met, "left_anti"))
    return fits.unionByName(apart.select("id", "digest", "label", "start", "end", "share"))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", p: Params = PRODUCTION, templates: DataFrame | None = None) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels, score`` and ``spans`` (label, start, end in
    words, share; of passages only).  ``templates``: further texts of licenses, ``label,
    text``, beside those of ``p``.

    ``n_base``: places of phrases; ``score``: 1 with a phrase, else the largest
    share of a passage that was found, 0 without any.  A null text is empty and
    has no words.  Rows are judged one by one; those that share id and text get
    the same answer, also with a null id.  Other columns play no part.
    """
    texts = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("digest"), word_list(F.col(text)).alias("words"))
    voted = votes(texts, p, templates)
    exact = voted.where(F.col("exact") & (F.size("places") == F.col("grams"))).select(
        "id", "digest", "label", F.col("diagonal").alias("place"), F.lit(None).cast("int").alias("end"), F.lit(1.0).alias("share"))
    spans = bands(voted, p).select("id", "digest", "label", F.col("start").alias("place"), "end", "share")
    phrase = F.col("end").isNull()
    found = exact.unionByName(spans).groupBy("id", "digest").agg(
        F.count_if(phrase).alias("n_base"),
        F.min(F.when(phrase, F.col("place"))).cast("long").alias("first_word"),
        F.max(F.when(phrase, F.col("place"))).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(phrase, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"), F.max("share").alias("score"),
        F.sort_array(F.collect_list(F.when(~phrase, F.struct("label", F.col("place").alias("start"), "end", "share")))).alias("spans"))
    sizes = texts.select("id", "digest", F.size("words").cast("long").alias("n_words"))
    f = found.withColumnsRenamed({"id": "f_id", "digest": "f_digest"})
    return (sizes.join(f, sizes.id.eqNullSafe(f.f_id) & (sizes.digest == f.f_digest), "left")
            .select(F.col("id").alias("doc_id"), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
                    "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
                    F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"), "spans"))

"""Information-theoretic sanitisation of personal data.

Protected entities are the values that the base patterns find: addresses, card
and phone numbers.  A term near such a value may reveal it although the value
itself is removed.  How much is estimated from the whole corpus: of the
information log(N / n(entity)) that the entity holds, a term near it reveals
the share of the pointwise mutual information
log(N * n(entity, term) / (n(entity) * n(term))).  Terms from ``disclosure``
on, seen with the entity in at least ``support`` different texts, are spans of
their own in the texts that hold the entity: words within ``near`` of it, where
they stand there, and words of the whole text, wherever they stand in it.

Copies that differ a little share all their rare words, whatever these say of an
entity that the copies hold.  So an entity is weighed against words of whole texts
only if its texts share less than ``alike`` of the words that are rare enough to
disclose it, and a word only if it stands behind and before different words in
them; else only what is near the entity is weighed.  

Spans are generalised: a value to its kind, a term to ``[term]``.

Counts cover all documents, and rows with the same text count each.  A term
that stands near entities in too many rows cannot disclose, whatever its count elsewhere, and is left out first.  The
others are counted in some thousand rows, then in the rest of four times as many,
and so on up to all; a term leaves as soon as it has too many rows.  So tasks hand
on a term no oftener than that takes, however many there are.  A pass drops words
by a bitmap of fixed size, so that only counts of terms in question (and a few
that share a bit) move.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.llm import textblocks as tb
from assay.llm.staging import ship, stage

KINDS = ("email", "ip", "card", "phone", "term")       # the order of spans that start together

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# No match begins inside a run of digits but at its first one.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


@dataclass(frozen=True)
class Params:
    near: int = 4              # words on either side of a value that are weighed whatever its texts are like
    alike: float = 0.2         # share of their rare words that texts of an entity may have in common
    support: int = 2           # texts that a term and an entity share
    disclosure: float = 0.9    # of an entity's information
    bits: int = 1 << 24
    first: int = 4096          # rows, about, in which terms are counted first


PRODUCTION = Params()


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Every match has one ``@``: its local part is what may stand before it."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and _LOCAL.match(text, start - 1):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``start, index of the kind, end`` of all base spans, sorted."""
    found = [(s, 0, e) for s, e in emails(text)]
    if _DIGIT.search(text):
        found += [(m.start(), 1, m.end()) for m in _IP.finditer(text)
                  if all(len(x) <= 3 and int(x or 0) <= 255 for x in (y.lstrip("0") for y in m.group().split(".")))]
        for m in _CARD.finditer(text):
            digits = re.sub(r"[\x20-]", "", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def free_words(text: str, found: list[tuple[int, int, int]]) -> tuple[list[tuple[int, int]], np.ndarray, list[tuple[int, int]]]:
    """The words of a text, whether each touches no span, and the first word
    that touches or follows each span with the first one behind it."""
    words = [m.span() for m in _WORD.finditer(text)]
    starts = np.array([s for s, _ in words])
    ends = np.array([e for _, e in words])
    free, place = np.ones(len(words), bool), []
    for s, _, e in found:
        a, b = int(np.searchsorted(ends, s, "right")), int(np.searchsorted(starts, e, "left"))
        free[a:b] = False
        place.append((a, b))
    return words, free, place


def contexts(text: str, found: list[tuple[int, int, int]], near: int) -> Iterator[tuple[int, int, int]]:
    """``index of the span, start, end`` of the words near each span; words
    that touch any span are none."""
    if not found:
        return
    words, free, place = free_words(text, found)
    for k, (a, b) in enumerate(place):
        for i in [*range(max(0, a - near), a), *range(b, min(len(words), b + near))]:
            if free[i]:
                yield k, words[i][0], words[i][1]


def word_terms(text: str, spans: list[tuple[int, int]]) -> np.ndarray:
    """The terms that words ``text[start:end]`` are."""
    block = tb.Block(0, np.frombuffer(" ".join(text[s:e] for s, e in spans).encode(), np.uint8), np.zeros(2, np.int64))
    block.bounds[1] = len(block.data)
    return tb.word_hashes(block, lower=True)[0].view(np.int64)


def first_places(text: str, found: list[tuple[int, int, int]]) -> list[dict[str, int]]:
    """The different terms of a text with base spans, with the words before and
    behind the first place of each (0 at the ends)."""
    if not found:
        return []
    words, free, _ = free_words(text, found)
    around = np.concatenate([[0], word_terms(text, words), [0]])
    term, at = np.unique(around[1:-1][free], return_index=True)
    at = np.flatnonzero(free)[at]
    return [{"term": t, "left": a, "right": b} for t, a, b in zip(term.tolist(), around[at].tolist(), around[at + 2].tolist())]


_SPAN = "array<struct<kind:int,start:int,end:int>>"
_CONTEXT = "array<struct<entity:bigint,term:bigint,start:int,end:int>>"


def scan(docs: DataFrame, doc_id: str, text: str, p: Params) -> DataFrame:
    """``id, digest, spans, near, entities, terms``: base spans of each row and
    the terms near them, without the text; of a text with base spans its different
    entities and terms."""
    ship(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = T._parse_datatype_string(f"id {kind}, digest bigint, spans {_SPAN}, near {_CONTEXT}, entities array<bigint>, terms array<struct<term:bigint,left:bigint,right:bigint>>")
    names = schema.names

    def signed(values: np.ndarray) -> list[int]:
        return values.view(np.int64).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, near, entities, terms = [], [], [], []
            for x in batch.column(2):
                value = x.as_py() or ""
                found = base_spans(value)
                spans.append([{"kind": k, "start": s, "end": e} for s, k, e in found])
                entity = signed(np.array([xxhash.xxh3_64_intdigest(f"{KINDS[k]} {value[s:e].lower()}") for s, k, e in found], np.uint64))
                around = list(contexts(value, found, p.near))
                near.append([{"entity": entity[k], "term": t, "start": s, "end": to} for t, (k, s, to) in zip(
                    word_terms(value, [(s, e) for _, s, e in around]).tolist(), around)])
                entities.append(sorted(set(entity)))
                terms.append(first_places(value, found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(spans, pa.list_(_SPAN_TYPE)), pa.array(near, pa.list_(_CONTEXT_TYPE)),
                 pa.array(entities, pa.list_(pa.int64())), pa.array(terms, pa.list_(_TERM_TYPE))], names=names)

    return docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("digest"), F.col(text).alias("text")).mapInArrow(run, schema)


_SPAN_TYPE = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
_TERM_TYPE = pa.struct([("term", pa.int64()), ("left", pa.int64()), ("right", pa.int64())])
_CONTEXT_TYPE = pa.struct([("entity", pa.int64()), ("term", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])


def term_counts(docs: DataFrame, text: str, wanted: DataFrame, p: Params) -> DataFrame:
    """``term, n``: the number of rows that hold each of the ``wanted`` terms
    (and of some others)."""
    ship(docs.sparkSession)
    bit = F.pmod("term", F.lit(p.bits))
    marks = wanted.select(bit.cast("int").alias("bit")).distinct().toArrow()["bit"].to_numpy()      # at most p.bits numbers
    bitmap = np.zeros(p.bits, bool)
    bitmap[marks] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(bitmap))

    def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        term, inverse = np.unique(np.concatenate([t for t, _ in parts]), return_inverse=True)
        return term, np.bincount(inverse, np.concatenate([n for _, n in parts]), len(term)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.unpackbits(shared.value).astype(bool)
        parts: list[tuple[np.ndarray, np.ndarray]] = []      # added up in the task, so that a term moves once
        held_back, most = 0, 1_000_000
        for batch in batches:
            for block in tb.blocks(batch.column(0)):
                words, first = tb.word_hashes(block, lower=True)
                words = words.view(np.int64)
                keep = np.flatnonzero(held[words % p.bits])
                owner = np.searchsorted(first, keep, "right") - 1
                # each term once for each document
                pair = tb.mix(words[keep].view(np.uint64) + tb.mix(owner.astype(np.uint64) + np.uint64(1)))
                parts.append(np.unique(words[keep[np.unique(pair, return_index=True)[1]]], return_counts=True))
                held_back += len(parts[-1][0])
                if held_back > most:
                    parts = [summed(parts)]
                    held_back = len(parts[0][0])
                    most = max(most, 2 * held_back)          # so that all are added up again only when they have doubled
        if parts:
            term, n = summed(parts)
            yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(n)], names=["term", "n"])

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


def slices(total: int, p: Params) -> list[int]:
    """Ends of slices of the rows, each of four times the one before it, the last
    end being their number; the first has about ``first`` rows."""
    ends = [1]
    while ends[-1] * p.first < total:
        ends.append(4 * ends[-1])
    return ends


def counts_up_to(docs: DataFrame, text: str, wanted: DataFrame, total: int, p: Params) -> DataFrame:
    """``term, n`` of the different terms of ``wanted`` (``term, most``) that
    occur: the number of rows that hold a term, or, if it is above ``most``, any
    number above that."""
    ends, done = slices(total, p), []
    at = F.pmod(F.xxhash64(text), F.lit(ends[-1]))
    left = wanted.select("term", "most", F.lit(0).cast("long").alias("n"))
    for start, end in zip([0, *ends], ends):
        rows = docs.where((at >= start) & (at < end)) if len(ends) > 1 else docs
        more = term_counts(rows, text, left, p).withColumnRenamed("n", "more")
        counted = stage(left.join(more, "term", "left").select("term", "most", (F.col("n") + F.coalesce("more", F.lit(0))).alias("n")), "counted")
        if end == ends[-1]:
            return reduce(DataFrame.union, [*done, counted.where("n > 0").select("term", "n")])
        done.append(counted.where("n > most").select("term", "n"))
        left = counted.where("n <= most")


def _share(n: Column, total: Column) -> Column:
    information = F.log2(total / F.col("holders"))
    mutual = F.log2(total * F.col("both") / (F.col("holders") * n))
    return F.when(information > 0, mutual / information).otherwise(0.0)


def disclosing(docs: DataFrame, scanned: DataFrame, text: str, p: Params) -> DataFrame:
    """``entity, term, share``: terms near an entity that reveal too much of it."""
    # All counts are of rows, so that copies weigh the same in each; only the support is of different texts.
    texts = scanned.where("size(near) > 0").groupBy("digest").agg(F.count("*").alias("w"), F.any_value("near").alias("near"))
    near = texts.select("digest", "w", F.explode("near").alias("x")).select("digest", "w", "x.entity", "x.term")
    together = (near.distinct().groupBy("entity", "term").agg(F.sum("w").alias("both"), F.count("*").alias("texts"))
                .where(F.col("texts") >= p.support).drop("texts"))
    holders = near.select("digest", "w", "entity").distinct().groupBy("entity").agg(F.sum("w").alias("holders"))
    # A term is in no fewer rows than those that have it near any entity.
    seen = near.select("digest", "w", "term").distinct().groupBy("term").agg(F.sum("w").alias("seen"))
    rows = scanned.count()
    total = F.lit(float(rows))
    possible = stage(together.join(holders, "entity").join(seen, "term").where(_share(F.greatest("both", "seen"), total) >= p.disclosure), "possible")
    # Rows that may hold a term of so large a share, with some to spare for rounding.
    most = F.max(F.col("both") * F.pow(total / F.col("holders"), F.lit(1 - p.disclosure))) * (1 + 1e-6)
    counts = counts_up_to(docs, text, possible.groupBy("term").agg(most.alias("most")), rows, p)
    return (possible.join(counts, "term").withColumn("share", _share(F.greatest("n", "both", "seen"), total))
            .where(F.col("share") >= p.disclosure).select("entity", "term", "share"))


def disclosing_anywhere(docs: DataFrame, scanned: DataFrame, text: str, p: Params) -> DataFrame:
    """``entity, term, share``: terms of whole texts that reveal too much of an
    entity whose texts are not alike.  Words that too many rows hold are left out
    before they meet entities."""
    texts = scanned.where("size(entities) > 0").groupBy("digest").agg(
        F.count("*").alias("w"), F.any_value("entities").alias("entities"), F.any_value("terms").alias("terms"))
    rows = scanned.count()
    total = F.lit(float(rows))
    in_text = texts.select("digest", "w", F.explode("entities").alias("entity"))
    held = in_text.groupBy("entity").agg(F.sum("w").alias("holders"), F.count("*").alias("texts")).where(F.col("texts") >= p.support)
    # Rows that may hold a term of so large a share, if all rows of the entity do.
    rare = (F.col("holders") * F.pow(total / F.col("holders"), F.lit(1 - p.disclosure))).alias("rare")
    known = stage(in_text.join(held, "entity").select("digest", "w", "entity", "holders", rare), "entities")
    limit = known.groupBy("digest").agg(F.max("rare").alias("limit"))
    of_text = texts.join(limit, "digest").select("digest", "w", "limit", F.explode("terms").alias("x")).select("digest", "w", "limit", "x.*")
    several = of_text.groupBy("term").agg(F.count("*").alias("texts"), F.sum("w").alias("seen"), F.max("limit").alias("limit"))
    several = stage(several.where(F.col("texts") >= p.support).select("term", "seen", "limit", (F.col("seen") <= F.col("limit")).alias("may_be_rare")), "several")
    # A term that texts with entities alone hold too often needs no count over all rows.
    open_ = several.where("may_be_rare").select("term", F.col("limit").alias("most"))
    counts = stage(counts_up_to(docs, text, open_, rows, p)
                   .unionByName(several.where("not may_be_rare").select("term", F.col("seen").alias("n"))), "counts")
    few = of_text.join(counts, "term").where("n <= limit").select("digest", "term", "left", "right", "n")
    pairs = known.join(few, "digest").where("n <= rare")
    together = stage(pairs.groupBy("entity", "term").agg(F.sum("w").alias("both"), F.count("*").alias("texts"), F.max("n").alias("n"),
                                                         F.max("holders").alias("holders"),
                                                         ((F.min("left") != F.max("left")) & (F.min("right") != F.max("right"))).alias("unlike")), "together")
    # Rare words of the texts of an entity, those in one of them only, too.
    all_rare = of_text.join(counts, "term", "left").where("n is null or n <= limit").groupBy("digest").agg(F.count("*").alias("rare_words"))
    average = known.join(all_rare, "digest").groupBy("entity").agg(F.avg("rare_words").alias("average"))
    shared = together.where(F.col("texts") >= p.support).groupBy("entity").agg(F.count("*").alias("shared"))
    apart = shared.join(average, "entity").where(F.col("shared") < p.alike * F.col("average")).select("entity")
    return (together.where((F.col("texts") >= p.support) & F.col("unlike")).join(apart, "entity").withColumn("share", _share(F.col("n"), total))
            .where(F.col("share") >= p.disclosure).select("entity", "term", "share"))


def places(docs: DataFrame, doc_id: str, text: str, wanted: DataFrame, p: Params) -> DataFrame:
    """``id, digest, term, start, end``: where words of texts with base spans
    may be ``wanted`` terms (a bitmap of fixed size lets some others through)."""
    ship(docs.sparkSession)
    marks = wanted.select(F.pmod("term", F.lit(p.bits)).cast("int").alias("bit")).distinct().toArrow()["bit"].to_numpy()      # at most p.bits numbers
    bitmap = np.zeros(p.bits, bool)
    bitmap[marks] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(bitmap))
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = T._parse_datatype_string(f"id {kind}, digest bigint, term bigint, start int, end int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            row, term, start, end = [], [], [], []
            for k, x in enumerate(batch.column(2)):
                value = x.as_py() or ""
                if found := base_spans(value):
                    words, free, _ = free_words(value, found)
                    words = [words[i] for i in np.flatnonzero(free).tolist()]
                    terms = word_terms(value, words)
                    for i in np.flatnonzero(held[terms % p.bits]).tolist():
                        row.append(k)
                        term.append(int(terms[i]))
                        start.append(words[i][0])
                        end.append(words[i][1])
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(term, pa.int64()),
                                              pa.array(start, pa.int32()), pa.array(end, pa.int32())], names=schema.names)

    return docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("digest"), F.col(text).alias("text")).mapInArrow(run, schema)


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", p: Params = PRODUCTION) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, digest, base, spans``.

    ``base`` and ``spans``: arrays of (start, kind as index of ``KINDS``, end),
    in that order, in code points; ``spans`` adds the disclosing terms.  A null
    text is empty and has none.  Rows that share id and text get the same
    spans, also with a null id.  Other columns play no part.
    """
    scanned = stage(scan(docs, doc_id, text, p), "pii")
    told = disclosing(docs, scanned, text, p)
    terms = (scanned.select("id", "digest", F.explode("near").alias("x")).select("id", "digest", "x.*")
             .join(told, ["entity", "term"]).select("id", "digest", "start", "end"))
    anywhere = stage(disclosing_anywhere(docs, scanned, text, p), "anywhere")
    if not anywhere.isEmpty():
        mine = (scanned.select("id", "digest", F.explode("entities").alias("entity")).join(anywhere, "entity")
                .select(F.col("id").alias("_id"), F.col("digest").alias("_digest"), F.col("term").alias("_term")).distinct())
        met = F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")) & (F.col("term") == F.col("_term"))
        terms = terms.union(places(docs, doc_id, text, anywhere, p).join(mine, met, "left_semi").select("id", "digest", "start", "end"))
    terms = (terms.groupBy("id", "digest")
             .agg(F.collect_set(F.struct("start", F.lit(KINDS.index("term")).alias("kind"), "end")).alias("t_spans"))
             .withColumnsRenamed({"id": "t_id", "digest": "t_digest"}))
    base = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return (scanned.join(terms, F.col("id").eqNullSafe(F.col("t_id")) & (F.col("digest") == F.col("t_digest")), "left")
            .select(F.col("id").alias("doc_id"), "digest", base.alias("base"),
                    F.sort_array(F.when(F.col("t_spans").isNull(), base).otherwise(F.concat(base, "t_spans"))).alias("spans")))


def as_text(spans: Column | str) -> Column:
    """``kind:start:end``, joined by commas."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"], s["end"])), ",")


def sanitise(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", p: Params = PRODUCTION) -> DataFrame:
    """``docs`` with every span of its text generalised to ``[kind]``; where
    spans overlap, the one that starts first stands for both."""
    ship(docs.sparkSession)
    found = find(docs, doc_id, text, p).where("size(spans) > 0").select(
        F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "spans").dropDuplicates(["_id", "_digest"])
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(doc_id).alias("of_id"), F.xxhash64(text).alias("of_digest"))
    keyed = rows.join(found, F.col("of_id").eqNullSafe(F.col("_id")) & (F.col("of_digest") == F.col("_digest")), "left").select("row.*", "spans")
    k, schema = docs.columns.index(text), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for value, spans in zip(batch.column(k).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                parts, at = [], 0
                for s in spans or ():
                    if s["start"] >= at:
                        parts += [value[at:s["start"]], f"[{KINDS[s['kind']]}]"]
                    at = max(at, s["end"])
                made.append("".join([*parts, value[at:]]) if parts else value)
            columns = batch.columns[:-1]
            columns[k] = pa.array(made, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return keyed.mapInArrow(run, schema)

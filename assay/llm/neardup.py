"""MinHash near-dedup by a chosen-path set similarity join.

A document is the set of its distinct word shingles; documents with equal sets
are one class, and only classes are compared.  Candidates come from random
trees over the classes' minhash values: a tree node picks two positions of the
minhash signature, and its documents go to the two children named by their
values there.  Two documents above the threshold are thus expected to meet in
more nodes with each level, so that a pair is as good as never lost on the way
down, however deep; those below one half thin out.  A small node is compared
exhaustively; independent trees repeat that up to the wanted recall, which is
that of the deepest level.

Comparing a node takes two steps.  The classes' sketches (a byte of each minhash
value) tell which classes look alike, well below the threshold, and belong to
different components; only the texts of those move, once for each node.  Their
full sets are then compared, all at once as a product of the matrix of sets with
itself, and what comes out is which components the confirmed links connect: never
more rows than went in.

The first tree links up what it finds, larger nodes in random parts.  In these,
the classes with most links of the largest component then meet all classes
beside it, so that copies near one base text only are linked up, too.  After
that only nodes of more than one component are of interest.  Those of up to
``whole`` times a leaf are compared completely, as blocks of classes beside the
largest component against blocks of it and each other; larger ones branch on,
level by level, and are compared as blocks after ``deepest`` levels.

A leaf is bounded by its classes and by their shingles.  Rows reach a task sorted
by node and are worked off node by node, so that a task holds one leaf at a time.
"""

from __future__ import annotations

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
from assay.llm.components import components
from assay.llm.staging import hold, ship, stage


@dataclass(frozen=True)
class Params:
    shingle: int = 5
    percent: int = 75           # least similarity
    positions: int = 128        # of the signature
    trees: int = 4
    leaf: int = 2048            # classes compared at once
    load: int = 1 << 21         # shingles of the classes compared at once
    whole: int = 8              # leaves of a node that is compared without branching on
    deepest: int = 12           # levels
    slack: float = 0.16         # below the threshold, for sketches: four standard deviations


PRODUCTION = Params()
_seeds = np.random.default_rng(75)
_XOR = _seeds.integers(0, 2**63, 1024, dtype=np.uint64)
_ODD = _seeds.integers(0, 2**63, 1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Cells of the matrix of sets that are multiplied at once; rows of an Arrow batch that are turned into sets at once.
CELLS, SOME = 1 << 22, 256


def shingle_sets(block: tb.Block, k: int) -> Iterator[np.ndarray]:
    """Of each document of a block, the sorted distinct hashes of its shingles;
    a document of fewer than ``k`` words has all of them as one."""
    words, first = tb.word_hashes(block, lower=True)
    runs = tb.sequences(words, k)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            yield np.unique(runs[a:b - k + 1])
        else:
            yield tb.sequences(words[a:b], b - a) if b > a else runs[:0]


def signature(shingles: np.ndarray, positions: int) -> np.ndarray:
    """Minwise values of a set, 32 bits each."""
    best = np.full(positions, 2**64 - 1, np.uint64)
    for i in range(0, len(shingles), 2048):
        part = (shingles[i:i + 2048, None] ^ _XOR[None, :positions]) * _ODD[None, :positions]
        best = np.minimum(best, part.min(axis=0))
    return (best >> np.uint64(32)).astype(np.uint32)


def set_digest(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def _positions(path: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """The two positions of the signature that each node picks."""
    r = tb.mix(path ^ np.uint64(0x5851F42D4C957F2D))
    first = (r % np.uint64(p.positions)).astype(np.int64)
    step = 1 + ((r >> np.uint64(16)) % np.uint64(p.positions - 1)).astype(np.int64)
    return first, (first + step) % p.positions


def descend(sig: np.ndarray, row: np.ndarray, path: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Two children of each ``path`` of the classes ``row`` of ``sig``."""
    at = np.concatenate(_positions(path, p))
    row, path = np.tile(row, 2), np.tile(path, 2)
    value = sig[row, at].astype(np.uint64) | (at.astype(np.uint64) << np.uint64(32))
    return row, tb.mix(path * np.uint64(0x9E3779B97F4A7C15) + tb.mix(value))


def sketches(docs: DataFrame, doc_id: str, text: str, p: Params) -> DataFrame:
    """``doc_id, mark, n_shingles, node, sketch, paths``: a hash of the text, the
    digest of the set, a byte of each minwise value, and the node's first-level
    paths, two of each tree in turn; null for an empty set."""
    ship(docs.sparkSession)
    kind = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("mark", T.LongType()), T.StructField("n_shingles", T.LongType()),
                           T.StructField("node", T.BinaryType()), T.StructField("sketch", T.BinaryType()),
                           T.StructField("paths", T.ArrayType(T.LongType(), False))])
    trees = tb.mix(np.arange(1, p.trees + 1, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold()
        for batch in batches:
            for block in tb.blocks(batch.column(2)):
                sets = list(shingle_sets(block, p.shingle))
                some = [i for i, s in enumerate(sets) if len(s)]
                sig = np.array([signature(sets[i], p.positions) for i in some], np.uint32).reshape(len(some), p.positions)
                row, path = descend(sig, np.repeat(np.arange(len(some)), p.trees), np.tile(trees, len(some)), p)
                each = path.view(np.int64).reshape(2, len(some), p.trees).transpose(1, 2, 0).reshape(len(some), 2 * p.trees)
                known = {i: k for k, i in enumerate(some)}
                of = lambda make: [make(known[i]) if i in known else None for i in range(len(sets))]  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.first, len(sets)), batch.column(1).slice(block.first, len(sets)),
                     pa.array([len(s) for s in sets], pa.int64()), pa.array([set_digest(s) for s in sets], pa.binary()),
                     pa.array(of(lambda k: sig[k].astype(np.uint8).tobytes()), pa.binary()),  # noqa: B023
                     pa.array(of(lambda k: each[k]), pa.list_(pa.int64()))], names=schema.names)  # noqa: B023

    return docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text")).mapInArrow(run, schema)


_LINK = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType()), T.StructField("links", T.LongType())])
_ROWS = T.StructType([T.StructField("path", T.LongType()), T.StructField("node", T.BinaryType()), T.StructField("root", T.BinaryType())])


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by their first column, as tables of whole groups with the
    first row of each group (and the number of rows); at most a group is kept back."""
    rest = None
    for batch in batches:
        if batch.num_rows:
            t = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
            key = t.column(0).to_numpy()
            cut = int(np.searchsorted(key == key[-1], True))
            rest = t.slice(cut)
            if cut:
                yield t.slice(0, cut), np.concatenate([[0], np.flatnonzero(np.diff(key[:cut])) + 1, [cut]])
    if rest is not None:
        yield rest, np.array([0, rest.num_rows])


def _fixed(column: pa.ChunkedArray, width: int, kind=np.uint8) -> np.ndarray:
    """Binary values of one length as rows of an array."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1) if len(column) else np.zeros((0, width), kind)


def look_alikes(rows: DataFrame, classes: DataFrame, p: Params) -> DataFrame:
    """Those of ``path, node, root`` whose class looks like one of another
    ``root`` under the same path, by their sketches."""
    ship(rows.sparkSession)
    members = (rows.join(classes.select("node", "n", "sketch"), "node").select("path", "node", "root", "n", "sketch")
               .repartition("path").sortWithinPartitions("path"))
    least = int((p.percent / 100 - p.slack) * p.positions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold()
        for table, first in whole_groups(batches):
            s, n = _fixed(table.column("sketch"), p.positions), table.column("n").to_numpy()
            root = np.unique(_fixed(table.column("root"), 16), axis=0, return_inverse=True)[1].ravel()
            alike = np.zeros(len(n), bool)
            for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
                for i in range(a, b - 1):
                    same = np.count_nonzero(s[i + 1:b] == s[i], axis=1) > least
                    same &= (root[i + 1:b] != root[i]) & (100 * np.minimum(n[i + 1:b], n[i]) >= p.percent * np.maximum(n[i + 1:b], n[i]))
                    alike[i] |= same.any()
                    alike[i + 1:b] |= same
            yield from table.select(["path", "node", "root"]).filter(pa.array(alike)).to_batches()

    return members.mapInArrow(run, _ROWS)


def common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets."""
    flat = np.concatenate(sets)
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    owner, shared = np.repeat(np.arange(len(sets)), [len(s) for s in sets]), count > 1
    number = np.cumsum(shared) - 1
    owner, column = owner[shared[column]], number[column[shared[column]]]
    exact = np.float32 if max(len(s) for s in sets) < 1 << 24 else np.float64       # counts stay exact
    both, width = np.zeros((len(sets), len(sets)), exact), max(1, CELLS // len(sets))
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for start in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [start, start + width])
        m = np.zeros((len(sets), min(width, int(shared.sum()) - start)), np.float32)
        m[owner[a:b], column[a:b] - start] = 1
        both += m @ m.T
    return both


def joined(sets: list[np.ndarray], root: np.ndarray, percent: int) -> tuple[list[list[int]], np.ndarray]:
    """Groups of roots (numbers from 0) that links between sets of different
    roots connect, and the most links that a set of each root has."""
    size = np.array([len(s) for s in sets])
    both = common(sets)
    linked = np.zeros((len(sets), len(sets)), bool)
    for i in range(0, len(sets), SOME):                      # some rows at a time
        part = slice(i, i + SOME)
        shared = both[part].astype(np.int64)
        linked[part] = (100 * shared >= percent * (size[part, None] + size - shared)) & (root[part, None] != root)
    degree = linked.sum(axis=1)
    most = np.zeros(root.max() + 1, np.int64)
    np.maximum.at(most, root, degree)
    seen, groups = most == 0, []
    for start in range(len(most)):
        if seen[start]:
            continue
        group, seen[start] = [start], True
        for r in group:                                      # grows as it is read
            new = np.unique(root[linked[root == r].any(axis=0)])
            new = new[~seen[new]]
            seen[new] = True
            group += new.tolist()
        groups.append(group)
    return groups, most


class Wanted:
    """A Bloom filter of ids, of one size whatever their number."""

    BITS, SET = 1 << 26, 5

    def __init__(self) -> None:
        self.data = np.zeros(self.BITS // 64, np.uint64)

    @classmethod
    def places(cls, keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for i in range(cls.SET):
            bit = tb.mix(keys + np.uint64(0x9E3779B97F4A7C15) * np.uint64(i + 1)) & np.uint64(cls.BITS - 1)
            yield (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63))

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        good = np.ones(len(keys), bool)
        for word, bit in self.places(keys):
            good &= (self.data[word] & bit) != 0
        return good


def texts_of(ids: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows ``id, text`` of ``docs`` whose id is among ``ids`` (column ``id``),
    joined with the columns of ``ids``.  A filter of fixed size, broadcast, leaves
    out nearly all other rows before their texts are shuffled."""
    spark = ids.sparkSession
    ship(spark)
    schema = T.StructType([T.StructField("word", T.LongType()), T.StructField("bits", T.LongType())])

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word, bit in Wanted.places(batch.column(0).to_numpy().view(np.uint64)):
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bit.view(np.int64))], names=schema.names)

    keys = ids.select(F.xxhash64("id").alias("k"))
    filter_ = Wanted()
    # At most as many rows as the filter has words, all at once: an iterator would run a job for each partition.
    found = keys.mapInArrow(bits, schema).groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    filter_.data[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    sent = spark.sparkContext.broadcast(filter_)

    kinds = {f.name: f.dataType for f in docs.schema.fields}
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where("text is not null and id is not null")
    schema = T.StructType([T.StructField("id", kinds[doc_id]), T.StructField("text", kinds[text])])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = sent.value.may_hold(batch.column(2).to_numpy().view(np.uint64))
            if good.any():
                yield batch.select(["id", "text"]).filter(pa.array(good))

    return ids.join(rows.withColumn("k", F.xxhash64("id")).mapInArrow(keep, schema), "id")


def confirmed(rows: DataFrame, docs: DataFrame, classes: DataFrame, doc_id: str, text: str, p: Params) -> DataFrame:
    """``a, b, links``: of the classes under each path (``path, node, root``),
    the components that links on full sets connect: each with the smallest of its
    group, and the most links of a class of it.  A class's text is that of its
    smallest id; where rows share that id the digest tells which it is."""
    ship(rows.sparkSession)
    wanted = rows.join(classes.select("node", "id"), "node").select("path", "node", "root", "id")
    members = texts_of(wanted, docs, doc_id, text).select("path", "node", "root", "text").repartition("path").sortWithinPartitions("path", "node")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes, bytes, np.ndarray]]:
        for batch in batches:
            for at in range(0, batch.num_rows, SOME):
                part = batch.slice(at, SOME)
                sets = (s for block in tb.blocks(part.column(3)) for s in shingle_sets(block, p.shingle))
                for path, node, root, s in zip(*(part.column(i).to_pylist() for i in range(3)), sets):
                    if set_digest(s) == node:
                        yield path, node, root, s

    def links(group: dict[bytes, tuple[bytes, np.ndarray]]) -> list[tuple[bytes, bytes, int]]:
        if len(group) < 2:
            return []
        roots: dict[bytes, int] = {}
        root = np.array([roots.setdefault(r, len(roots)) for r, _ in group.values()])
        groups, most = joined([s for _, s in group.values()], root, p.percent)
        names = list(roots)
        return [(names[r], least, int(most[r])) for g in groups for least in [min(names[r] for r in g)] for r in g]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold()
        def batch_of(found: list[tuple[bytes, bytes, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], kind) for k, kind in enumerate((pa.binary(), pa.binary(), pa.int64()))],
                                              names=_LINK.names)

        at, group, found = None, {}, []
        for path, node, root, s in sets_of(batches):
            if path != at:
                found += links(group)
                at, group = path, {}
                if len(found) > 10_000:
                    yield batch_of(found)
                    found = []
            group[node] = root, s
        yield batch_of(found + links(group))

    return members.mapInArrow(run, _LINK)


def _labels(linked: DataFrame) -> DataFrame:
    """``node, root`` after a few steps along the smallest links: nodes of one
    root are connected, though not all that are connected have one root yet."""
    at = linked.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    for _ in range(2):
        at = at.join(at.select(F.col("node").alias("root"), F.col("root").alias("beyond")), "root", "left").select("node", F.coalesce("beyond", "root").alias("root"))
    return at


def _cost(size: Column, load: Column, p: Params) -> Column:
    """Leaves that classes fill: 1 for what is compared at once."""
    return F.ceil(F.greatest(size / p.leaf, load / p.load))


def _among(n: Column) -> Column:
    return F.pmod(F.xxhash64("node"), n)


def _parts(rows: DataFrame) -> DataFrame:
    """Large nodes (``path, node, root, cost``) cut into random parts."""
    part = F.pmod(F.xxhash64("node", "path"), F.col("cost") * 2)
    return rows.select(F.xxhash64("path", part, F.lit("part")).alias("path"), "node", "root")


def _shares(rows: DataFrame, p: Params) -> DataFrame:
    """Of each path, the largest component and the half leaves that it and the others fill."""
    each = rows.groupBy("path", "root").agg(F.count("*").alias("c"), F.sum("n").alias("l"))
    top = each.groupBy("path").agg(F.max(F.struct("c", "l", "root")).alias("t"), F.sum("c").alias("c"), F.sum("l").alias("l"))
    half = lambda c, x: F.greatest(F.lit(1), F.ceil(F.greatest(c * 2 / p.leaf, x * 2 / p.load))).cast("long")
    return top.select("path", F.col("t.root").alias("of"), half(F.col("t.c"), F.col("t.l")).alias("ins"),
                      half(F.col("c") - F.col("t.c"), F.col("l") - F.col("t.l")).alias("outs"))


def _blocks(rows: DataFrame, p: Params) -> DataFrame:
    """Large nodes (``path, node, root, n``) as pairs of blocks, so that classes
    of two components meet: blocks of the largest component of a node with blocks
    of the others, and those among themselves."""
    sized = rows.join(_shares(rows, p), "path")
    zero = F.lit(0).cast("long")
    meet = lambda kind, x, y: F.struct(F.lit(kind).alias("kind"), x.alias("x"), y.alias("y"))
    inside = F.transform(F.sequence(zero, F.col("outs") - 1), lambda o: meet("across", _among(F.col("ins")), o))
    outside = F.concat(F.transform(F.sequence(zero, F.col("ins") - 1), lambda k: meet("across", k, _among(F.col("outs")))),
                       F.transform(F.sequence(zero, F.col("outs") - 1), lambda o: meet("others", F.least(o, _among(F.col("outs"))), F.greatest(o, _among(F.col("outs"))))))
    met = sized.select("path", "node", "root", F.explode(F.when(F.col("root") == F.col("of"), inside).otherwise(outside)).alias("m"))
    return met.select(F.xxhash64("path", "m.kind", "m.x", "m.y").alias("path"), "node", "root")


def _centres(rows: DataFrame, linked: DataFrame, p: Params) -> DataFrame:
    """Large nodes (``path, node, root, n``) as parts of the classes beside the
    largest component, each with up to eight classes of it that have the most links."""
    known = rows.join(_shares(rows, p), "path")
    links = linked.groupBy(F.col("a").alias("node")).agg(F.max("links").alias("links"))
    centre = (known.where("root = of").join(links, "node").groupBy("path", "root", "outs", _among(F.lit(8)).alias("k"))
              .agg(F.max(F.struct("links", "node")).alias("x"))
              .select("path", F.col("x.node").alias("node"), "root", F.explode(F.sequence(F.lit(0).cast("long"), F.col("outs") - 1)).alias("part")))
    others = known.where("root <> of").select("path", "node", "root", _among(F.col("outs")).alias("part"))
    return centre.union(others).select(F.xxhash64("path", "part", F.lit("centre")).alias("path"), "node", "root")


def _mixed(rows: DataFrame, label: DataFrame, p: Params) -> DataFrame:
    """``path, node, n, root, cost``: rows ``path, node, n`` whose path holds
    more than one component, with the component of each and what they fill."""
    known = rows.select("path", "node", "n").join(label, "node", "left").select("path", "node", "n", F.coalesce("root", "node").alias("root"))
    several = known.groupBy("path").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("c"), F.sum("n").alias("l")).where("x <> y")
    return known.join(several.select("path", _cost(F.col("c"), F.col("l"), p).alias("cost")), "path")


def _children(rows: DataFrame, docs: DataFrame, classes: DataFrame, doc_id: str, text: str, p: Params) -> DataFrame:
    """``path, node, n``, one level below ``path, node``; signatures are worked out anew from the texts."""
    ship(rows.sparkSession)
    at = rows.join(classes.select("node", "id", "n"), "node").groupBy("node", "id", "n").agg(F.collect_list("path").alias("paths"))
    members = texts_of(at, docs, doc_id, text).select("node", "n", "paths", "text")
    schema = T.StructType([T.StructField("path", T.LongType()), T.StructField("node", T.BinaryType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold()
        for batch in batches:
            for at in range(0, batch.num_rows, SOME):
                part = batch.slice(at, SOME)
                sets = [s for block in tb.blocks(part.column(3)) for s in shingle_sets(block, p.shingle)]
                good = [i for i, (s, node) in enumerate(zip(sets, part.column(0).to_pylist())) if set_digest(s) == node]
                if good:
                    sig = np.array([signature(sets[i], p.positions) for i in good], np.uint32)
                    paths = [part.column(2)[i].as_py() for i in good]
                    row, path = descend(sig, np.repeat(np.arange(len(good)), [len(x) for x in paths]), np.array(sum(paths, []), np.int64).view(np.uint64), p)
                    of = pa.array(np.array(good)[row])
                    yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), part.column(0).take(of), part.column(1).take(of)], names=schema.names)

    return members.mapInArrow(run, schema).distinct()


def connected(docs: DataFrame, classes: DataFrame, doc_id: str, text: str, p: Params) -> DataFrame:
    """``node, root`` of all classes that have a confirmed link."""
    def links_of(rows: DataFrame) -> DataFrame:
        return stage(confirmed(stage(look_alikes(rows, classes, p), "alike"), docs, classes, doc_id, text, p), "links")

    def leaves(rows: DataFrame) -> DataFrame:
        return rows.where("cost <= 1").select("path", "node", "root")

    # The first tree, larger nodes in random parts.
    bare = classes.select("node", "n", F.explode(F.slice("paths", 1, 2)).alias("path")).withColumn("root", F.col("node"))
    full = bare.groupBy("path").agg(F.count("*").alias("c"), F.sum("n").alias("l")).where("c > 1").select("path", _cost(F.col("c"), F.col("l"), p).alias("cost"))
    rows = stage(bare.join(full, "path"), "nodes")
    linked = links_of(leaves(rows).union(_parts(rows.where("cost > 1"))))
    label = stage(_labels(linked), "labels")
    # What is near the most linked classes of its large nodes.
    large = rows.where("cost > 1")
    if not large.isEmpty():
        linked = linked.union(links_of(_centres(stage(_mixed(large, label, p), "mixed"), linked, p)))
        label = stage(_labels(linked), "labels")
    # The nodes of all trees that hold more than one component, complete.
    rows = stage(_mixed(classes.select(F.explode("paths").alias("path"), "node", "n"), label, p), "mixed")
    for level in range(p.deepest):
        last = level == p.deepest - 1
        in_blocks = F.col("cost") > 1 if last else (F.col("cost") > 1) & (F.col("cost") <= p.whole)
        linked = linked.union(links_of(leaves(rows).union(_blocks(rows.where(in_blocks), p))))
        rows = rows.where(F.col("cost") > p.whole)
        if last or rows.isEmpty():
            break
        label = stage(_labels(linked), "labels")
        below = stage(_children(rows.select("path", "node"), docs, classes, doc_id, text, p), "children")
        rows = stage(_mixed(below, label, p), "mixed")
    return components(linked)


def _marked(docs: DataFrame, doc_id: str, text: str, p: Params) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, mark, n_shingles, component_id, kept``."""
    sketched = stage(sketches(docs, doc_id, text, p), "sketches")
    member = sketched.where("node is not null and doc_id is not null")
    least = member.groupBy("node").agg(F.min(F.struct("doc_id", "n_shingles", "sketch", "paths")).alias("x"))
    classes = stage(least.select("node", F.col("x.doc_id").alias("id"), F.col("x.n_shingles").alias("n"), "x.sketch", "x.paths"), "classes")
    label = connected(docs, classes, doc_id, text, p)
    rooted = stage(classes.select("node", "id").join(label, "node", "left").select("node", "id", F.coalesce("root", "node").alias("root")), "rooted")
    smallest = rooted.groupBy("root").agg(F.min("id").alias("component"))
    named = rooted.join(smallest, "root").select("node", "component")
    return (sketched.select("doc_id", "mark", "n_shingles", "node").join(named, "node", "left")
            .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")))
            .select("doc_id", "mark", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def near_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", params: Params = PRODUCTION) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    A null text, or one without words, has no shingles, is linked with nothing
    and is kept.  Rows that share an id are linked as their texts are, each on
    its own.  A row without an id has a null ``component_id``, plays no part in
    links and is kept.  Other columns play no part.
    """
    return _marked(docs, doc_id, text, params).drop("mark")


def drop_near(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", params: Params = PRODUCTION) -> DataFrame:
    """The rows of ``docs`` that stay, unchanged, their columns in their order.
    A row goes by its id and text together: of rows that share an id, one whose
    text is linked with nothing stays.  Null ids and texts stay."""
    gone = _marked(docs, doc_id, text, params).where("not kept").select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).distinct()
    gone = stage(gone, "gone")
    names = [F.col(f"`{c}`") for c in docs.columns]
    return docs.join(gone, (F.col(f"`{doc_id}`") == F.col("_id")) & (F.xxhash64(F.col(f"`{text}`")) == F.col("_mark")), "left_anti").select(*names)

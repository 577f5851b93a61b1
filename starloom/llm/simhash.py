"""Operator 8: SimHash near-duplicates with pigeonring filtering.

Fingerprints are bit majorities over the XXH64 of word shingles.  The 64 bits
form a ring of ``budget + 1`` segments.  By the pigeonring principle, two
fingerprints within ``budget`` bits have a segment from which every chain of
``l`` consecutive segments differs by at most ``l * budget / segments`` bits.
The first link of that chain must be equal, so equal segments bring candidates
together; the longer chains prune them before the full Hamming check.

Equal fingerprints are merged before anything is paired.  Inside a bucket
links are at once contracted to a spanning star, so a dense group sends a row
per member, not per pair; buckets of more than ``BLOCK`` fingerprints are cut
into blocks whose pairs are separate tasks.  Stars of all buckets are joined
to components by alternating large-star and small-star rounds.

Defined cases: null and empty texts have fingerprint zero, linked like any
other; a null id takes no part in the smallest id (a component of null ids
only has a null id); repeated rows each appear; an empty table gives an empty
result; extra columns are ignored (:func:`keep_one` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import U64, prepare, text_column, written

SHINGLE, BUDGET, SEED = 4, 4, 42
BLOCK = 2048
PIECE = 4 << 20
_SPACES = b" \t\n\v\f\r"


def _pieces(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a bounded piece of it at a time."""
    at = 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and data[end] not in _SPACES:
            end += 1
        yield data[at:end].lower().split()
        at = end


def _bit_counts(words: list[bytes], size: int) -> tuple[int, np.ndarray]:
    """How many shingles ``words`` has and how often each bit is set in their hashes."""
    text = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(text[a:b], SEED) for a, b in spans), dtype=U64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return len(hashes), bits.sum(axis=0, dtype=np.int64)


def fingerprint(data: bytes, size: int = SHINGLE) -> int:
    """The SimHash of a UTF-8 text over its ``size``-word shingles, repeats included."""
    n, counts, tail = 0, np.zeros(64, dtype=np.int64), []
    for words in _pieces(data):
        words = tail + words
        if len(words) >= size:
            k, c = _bit_counts(words, size)
            n, counts = n + k, counts + c
            tail = words[len(words) - size + 1:] if size > 1 else []
        else:
            tail = words
    if n == 0:
        if not tail:
            return 0
        return xxhash.xxh64_intdigest(b" ".join(tail), SEED)
    ones = (2 * counts > n).astype(U64)
    return int((ones << np.arange(64, dtype=U64)).sum())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """``_id, _fp``: the fingerprint of every row as a signed long."""
    prepare(docs.sparkSession)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), size) for t in b.column(1)], dtype=U64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], names=["_id", "_fp"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), text_column(text_col).cast("binary").alias("_t"))
    return rows.mapInArrow(compute, "_id long, _fp long")


def segment_bounds(segments: int) -> list[tuple[int, int]]:
    """Start bit and width of each segment of the 64-bit ring."""
    cuts = [64 * k // segments for k in range(segments + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _segment_value(fp: Column, start: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, start).bitwiseAND(F.lit((1 << width) - 1))


def chain_pairs(a: np.ndarray, b: np.ndarray, first: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of ``a`` and ``b`` within ``budget`` bits whose ring chain starts at segment ``first``."""
    ring = segment_bounds(budget + 1)
    diff = a[:, None] ^ b[None, :]
    flat = diff.reshape(-1)
    alive = np.arange(flat.size)
    spent = np.zeros(flat.size, dtype=np.uint16)
    for length in range(1, len(ring)):
        start, width = ring[(first + length - 1) % len(ring)]
        mask = U64(((1 << width) - 1) << start)
        spent = spent + np.bitwise_count(flat[alive] & mask)
        ok = spent * len(ring) <= length * budget
        alive, spent = alive[ok], spent[ok]
    alive = alive[np.bitwise_count(flat[alive]) <= budget]
    return alive // len(b), alive % len(b)


def _stars(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of ``n`` nodes over the links (i, j)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _bucket_links(fps: np.ndarray, sides: np.ndarray, first: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (smaller, larger) that span the links found in one bucket task.

    ``sides`` is 0 or 1 in a task that compares two blocks, 0 throughout in
    one that compares a block with itself.
    """
    order = np.argsort(fps, kind="stable")
    fps, sides = fps[order], sides[order]
    left, right = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
    if len(right) == 0:
        right = left
    ii, jj = [], []
    for k in range(0, len(left), 512):
        rows = left[k:k + 512]
        cols = right if right is not left else left[k:]
        i, j = chain_pairs(fps[rows], fps[cols], first, budget)
        i, j = rows[i], cols[j]
        real = i != j
        ii.append(i[real])
        jj.append(j[real])
        # contract as we go: a dense bucket keeps a spanning star, not its pairs
        i, j = np.concatenate(ii), np.concatenate(jj)
        root = _stars(len(fps), i, j)
        moved = np.flatnonzero(root != np.arange(len(fps)))
        ii, jj = [root[moved]], [moved]
    return (fps[ii[0]], fps[jj[0]]) if ii else (fps[:0], fps[:0])


def links(distinct: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Edges ``a, b`` that connect exactly what links within ``budget`` bits connect (column ``_fp``, distinct)."""
    ring = segment_bounds(budget + 1)
    seg = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), _segment_value(F.col("_fp"), s, w).alias("v"))
                              for k, (s, w) in enumerate(ring)])).alias("s")
    rows = distinct.select("_fp", seg).select("_fp", "s.k", "s.v")
    # at most budget + 1 times 2^13 rows, whatever the input
    sizes = rows.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = rows.join(F.broadcast(sizes), ["k", "v"])
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("_fp"), blocks).cast("int")
    rows = rows.withColumn("o", own).withColumn("p", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.select("_fp", "k", "v", F.least("o", "p").alias("x"), F.greatest("o", "p").alias("y"), "o")
    rows = rows.select("_fp", "k", "v", "x", "y", F.when(F.col("x") == F.col("y"), 0)
                       .when(F.col("o") == F.col("x"), 0).otherwise(1).alias("side"))
    task = ["k", "v", "x", "y"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None

        def settle(parts, key):
            fps = np.concatenate([p[0] for p in parts])
            if len(fps) < 2:
                return None
            a, b = _bucket_links(fps, np.concatenate([p[1] for p in parts]), key[0], budget)
            if not len(a):
                return None
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for b in batches:
            cols = np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in task], axis=1)
            fps = b.column("_fp").to_numpy(zero_copy_only=False).view(U64)
            sides = b.column("side").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((cols[1:] != cols[:-1]).any(axis=1)) + 1
            for s, e in zip([0, *cuts], [*cuts, len(fps)]):
                if s == e:
                    continue
                key = tuple(cols[s].tolist())
                if key != last and held:
                    found = settle(held, last)
                    held = []
                    if found is not None:
                        yield found
                held.append((fps[s:e], sides[s:e]))
                last = key
        if held:
            found = settle(held, last)
            if found is not None:
                yield found

    return rows.repartition(*[F.col(c) for c in task]).sortWithinPartitions(*task).mapInArrow(compare, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node reachable from each node that has an edge.

    Alternating large-star and small-star rounds; a round's edges are written
    to the shared folder, and rounds end when the edge set stays the same.
    """
    edges = written(edges.where("a <> b").select(F.least("a", "b").alias("root"), F.greatest("a", "b").alias("node")).distinct(), "cc")
    mark = None
    while True:
        both = edges.select(F.col("node").alias("u"), F.col("root").alias("w")) \
            .unionByName(edges.select(F.col("root").alias("u"), F.col("node").alias("w")))
        low = both.groupBy("u").agg(F.min("w").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("w > u").select(F.col("w").alias("u"), F.col("m").alias("w")) \
            .where("u <> w").distinct()
        small_low = large.groupBy("u").agg(F.min("w").alias("m"))
        small = large.join(small_low, "u")
        edges = written(small.where("w <> m").select(F.col("w").alias("node"), F.col("m").alias("root"))
                        .unionByName(small.select(F.col("u").alias("node"), F.col("m").alias("root"))).distinct(), "cc")
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)")).alias("h")).first()
        if (state.n, state.h) == mark:
            return edges
        mark = (state.n, state.h)


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       size: int = SHINGLE, budget: int = BUDGET) -> DataFrame:
    """id, fingerprint (16 hex digits), component_id per row."""
    rows = written(fingerprints(docs, id_col, text_col, size), "simhash")
    both = rows.join(_groups(rows, budget), "_fp", "left")
    return both.select(F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
                       F.col("_least").alias("component_id"))


def _groups(rows: DataFrame, budget: int) -> DataFrame:
    """``_fp, _least``: the smallest id reachable from each fingerprint."""
    distinct = written(rows.groupBy("_fp").agg(F.min("_id").alias("_lo")), "simhash-distinct")
    root = components(links(distinct.select("_fp"), budget))
    # every chain of rounds ends in stars: a node has one root, the smallest of its component
    labelled = distinct.join(root.withColumnRenamed("node", "_fp"), "_fp", "left") \
        .select("_fp", "_lo", F.coalesce("root", "_fp").alias("_root"))
    least = labelled.groupBy("_root").agg(F.min("_lo").alias("_least"))
    return labelled.join(least, "_root").select("_fp", "_least")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             size: int = SHINGLE, budget: int = BUDGET) -> DataFrame:
    """One document of each component, with all columns: the one with the smallest id.

    Rows carry a written row number, so of repeated rows exactly one stays.
    """
    marked = written(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
                     .withColumn("_row", F.monotonically_increasing_id()), "simhash-rows")
    flat = marked.select(F.col("_row").alias("_row_no"), F.col("_doc").getField(text_col).alias("_text"))
    fps = written(fingerprints(flat, "_row_no", "_text", size), "simhash")
    ids = marked.select(F.col("_row").alias("_id"), F.col("_doc").getField(id_col).cast("long").alias("_doc_id"))
    rows = fps.join(ids, "_id").select(F.col("_id").alias("_row"), "_fp", "_doc_id")
    numbered = rows.select(F.col("_row").alias("_id"), "_fp")
    group = _groups(numbered, budget)
    best = F.min(F.struct(F.col("_doc_id").isNull(), "_doc_id", "_row"))
    stays = rows.join(group, "_fp").groupBy("_least").agg(best.alias("_b")).select(F.col("_b._row").alias("_row"))
    return marked.join(stays, "_row", "left_semi").select(*[F.col("_doc").getField(c).alias(c) for c in docs.columns])

"""Operator 13: ranked lexical search over bit-sliced Bloom signatures.

Index: each document's distinct terms are hashed into a Bloom signature, and
again for every level of ``LEVELS`` that their frequency reaches.  Documents of
like size form a block; its signatures are stored bit by bit, a bitmap over the
block's documents for each bit, beside the documents' exact term counts.

Search: the bitmaps of a term's bits, and-ed, mark all documents that hold it
and a few that don't.  So the sum over an item's terms of weight times the
largest contribution that the reached level allows bounds a score from above.
A first pass scores the documents with the largest bounds of each block; the
k-th best of these scores is a floor that no result is below.  The second
pass rescores, from the exact counts, every document whose bound reaches the
floor (or the task's own k-th best score) and leaves out only those that are
provably below.  Items are taken in blocks of bounded size, each searched
against all documents.

Defined cases: a null or empty text has no terms, is in no count and in no
result; null ids come last among equal scores; repeated rows are documents
(or items) each; an item without terms, or whose terms no document holds, has
no result; an empty table gives an empty result; other columns take no part.
Texts are read in pieces, so a very long one needs memory for its distinct
terms only; a signature stops growing at ``MAX_WIDTH`` bits, beyond which its
bounds get looser but stay bounds.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import U64, batch, mix64, prepare, written
from starloom.session import settings

HASHES = 4
BITS_PER_TERM = 8
MAX_WIDTH = 1 << 24
LEVELS = (1, 2, 4, 8, 16)
BLOCK_DOCS = 512
BLOCK_BITS = 1 << 25          # width times documents of a block
BUFFER_DOCS = 2048            # documents sorted by size at a time
BUFFER_TERMS = 1 << 20
ITEM_BLOCK = 256
ITEM_TERMS = 1 << 14
TERM_CHUNK = 2048
SEEDS = 4                     # documents of a block scored for the floor, an item
SLACK = 1.0 + 1e-9            # bounds are summed in doubles
PIECE = 1 << 20
BATCH_BYTES = 1 << 22         # texts or index rows that reach a task's Python at once
READ_ROWS = 8                 # index rows decoded at once, a few MB each
SCORE_SLOTS = 64              # documents scored at once
HASHES_KEPT = 100_000

# Terms are runs of ASCII letters and digits and of all characters beyond ASCII.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))

INDEX = pa.schema([("ids", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("top", pa.list_(pa.int64())), ("width", pa.int64()),
                   ("bits", pa.binary()), ("terms", pa.list_(pa.binary())), ("tfs", pa.list_(pa.binary()))])
INDEX_DDL = "ids array<long>, n array<long>, top array<long>, width long, bits binary, terms array<binary>, tfs array<binary>"


def term_counts(text: str | None) -> Counter:
    """How often each term occurs in the whole text (terms as UTF-8 bytes)."""
    counts: Counter = Counter()
    at = 0
    while text and at < len(text):
        piece, rest = text[at:at + PIECE], 0
        if at + PIECE < len(text):  # back to a delimiter, or the piece is one long term: on to the next one
            while rest < len(piece) and (piece[-1 - rest].isascii() is False or piece[-1 - rest].isalnum()):
                rest += 1
            if rest == len(piece):
                end = at + PIECE
                while end < len(text) and (not text[end].isascii() or text[end].isalnum()):
                    end += 1
                piece, rest = text[at:end], 0
        piece = piece[:len(piece) - rest]
        counts.update(piece.encode("utf-8", "surrogatepass").translate(_TABLE).split())
        at += len(piece)
    return counts


def _small_batches(spark: SparkSession, rows: int | None = None):
    """Jobs run within hand Python ``BATCH_BYTES`` at a time; with ``rows``, Parquet is decoded by so many rows."""
    wanted = {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}
    if rows is not None:
        wanted["spark.sql.parquet.columnarReaderBatchSize"] = str(rows)
    return settings(spark, wanted)


class _Hashes(dict):
    """64-bit term hashes, remembered up to a bound."""

    def __missing__(self, term: bytes) -> int:
        if len(self) >= HASHES_KEPT:
            self.clear()
        value = self[term] = xxhash.xxh64_intdigest(term)
        return value


def positions(hashes: np.ndarray, level: int, width: int) -> np.ndarray:
    """The ``HASHES`` bit positions of each term at a level, a row a term."""
    h = mix64(hashes + U64((level * 0x9E3779B97F4A7C15) & (2 ** 64 - 1)))
    first, step = h >> U64(32), (h & U64(0xFFFFFFFF)) | U64(1)
    return ((first[:, None] + step[:, None] * np.arange(HASHES, dtype=U64)[None, :]) % U64(width)).astype(np.int64)


class Packed(NamedTuple):
    """A document's term counts in a tenth of a Counter's memory."""

    terms: bytes
    tfs: np.ndarray

    @classmethod
    def of(cls, counts: Counter) -> Packed:
        return cls(b" ".join(counts), np.fromiter(counts.values(), dtype=np.uint32, count=len(counts)))

    def entries(self) -> int:
        """Terms at each level that they reach: the bits to set, over ``HASHES``."""
        return sum(int((self.tfs >= level).sum()) for level in LEVELS)


def _block(docs: list, hashes: _Hashes) -> pa.RecordBatch:
    """An index row of documents ``(entries, id, counts)``, the largest first; counts may be packed."""
    width = min(max(docs[0][0] * BITS_PER_TERM, 64), MAX_WIDTH)
    bits = np.zeros((width, -(-len(docs) // 8)), dtype=np.uint8)
    out = {"ids": [], "n": [], "top": [], "terms": [], "tfs": []}
    for slot, (_, doc_id, counts) in enumerate(docs):
        terms, tfs = counts if isinstance(counts, Packed) else Packed.of(counts)
        h = np.fromiter((hashes[t] for t in terms.split(b" ")), dtype=U64, count=len(tfs))
        for level in LEVELS:
            held = h[tfs >= level]
            if not len(held):
                break
            bits[positions(held, level, width).reshape(-1), slot >> 3] |= np.uint8(128 >> (slot & 7))
        out["ids"].append(doc_id)
        out["n"].append(int(tfs.sum(dtype=np.int64)))
        out["top"].append(int(tfs.max()))
        out["terms"].append(terms)
        out["tfs"].append(tfs.tobytes())
    return batch(INDEX, {**{k: [v] for k, v in out.items()}, "width": [width], "bits": [bits.tobytes()]})


def _blocks(pending: list, hashes: _Hashes) -> Iterator[pa.RecordBatch]:
    pending.sort(key=lambda d: -d[0])
    while pending:
        width = min(max(pending[0][0] * BITS_PER_TERM, 64), MAX_WIDTH)
        many = max(8, min(BLOCK_DOCS, BLOCK_BITS // width // 8 * 8))
        yield _block(pending[:many], hashes)
        del pending[:many]


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per block of documents: bitmaps by bit, and ids, lengths and exact term counts by document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, size, hashes = [], 0, _Hashes()
        for b in batches:
            for doc_id, text in zip(b.column(0), b.column(1)):
                counts = term_counts(text.as_py())
                if not counts:
                    continue
                packed = Packed.of(counts)
                pending.append((packed.entries(), doc_id.as_py(), packed))
                size += len(counts)
                if len(pending) >= BUFFER_DOCS or size >= BUFFER_TERMS:
                    yield from _blocks(pending, hashes)
                    size = 0
        yield from _blocks(pending, hashes)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, INDEX_DDL)


class Items:
    """A bounded block of items: their distinct terms, and how often each item has each term."""

    def __init__(self, rows: list[tuple[int, Counter]]):
        self.ids = [i for i, _ in rows]
        self.terms = sorted({t for _, counts in rows for t in counts})
        self.place = {t: p for p, t in enumerate(self.terms)}
        self.hashes = np.array([xxhash.xxh64_intdigest(t) for t in self.terms], dtype=U64)
        self.cells = [(r, self.place[t], c) for r, (_, counts) in enumerate(rows) for t, c in counts.items()]
        self.weights = np.zeros(len(self.terms), dtype=np.int64)
        self.n_docs = self.n_terms = 0
        self.floors = np.zeros(len(rows), dtype=np.int64)

    def weigh(self, df: dict[bytes, int], n_docs: int, n_terms: int) -> None:
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in self.terms], dtype=np.int64)

    def times(self) -> np.ndarray:
        """Items by terms: how often."""
        out = np.zeros((len(self.ids), len(self.terms)))
        for r, t, c in self.cells:
            out[r, t] = c
        return out


def contribution(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class Block:
    """An index row opened for a block of items."""

    def __init__(self, b: pa.RecordBatch, row: int, items: Items):
        get = {name: b.column(i)[row] for i, name in enumerate(b.schema.names)}
        self.items, self.ids, self.width = items, get["ids"].as_py(), get["width"].as_py()
        self.n = get["n"].as_py()
        self.m = np.array([100 - 25 + (25 * n * items.n_docs) // items.n_terms for n in self.n], dtype=np.int64)
        self.top = np.array(get["top"].as_py(), dtype=np.int64)
        self.bits = np.frombuffer(get["bits"].as_buffer(), dtype=np.uint8).reshape(self.width, -1)
        self._terms, self._tfs = get["terms"], get["tfs"]

    def __len__(self) -> int:
        return len(self.ids)

    def bounds(self, times: np.ndarray) -> np.ndarray:
        """Items by documents: no score is larger."""
        gains, before = [], np.zeros(len(self), dtype=np.int64)
        for at in range(len(LEVELS)):
            most = self.top if at + 1 == len(LEVELS) else np.minimum(self.top, LEVELS[at + 1] - 1)
            now = np.where(self.top >= LEVELS[at], contribution(most, self.m), before)
            gains.append((now - before).astype(np.float64))
            before = now
        total = np.zeros((len(self.items.ids), len(self)))
        for start in range(0, len(self.items.terms), TERM_CHUNK):
            which = np.arange(start, min(start + TERM_CHUNK, len(self.items.terms)))
            marks = None
            for level, gain in zip(LEVELS, gains):
                if not len(which) or (self.top < level).all():
                    break
                cut = np.bitwise_and.reduce(self.bits[positions(self.items.hashes[which], level, self.width)], axis=1)
                marks = cut if marks is None else marks & cut
                some = marks.any(axis=1)
                which, marks = which[some], marks[some]
                held = np.unpackbits(marks, axis=1, count=len(self)).astype(np.float64)
                total += (times[:, which] * self.items.weights[which]) @ held * gain
        return total * SLACK

    def counts(self, slot: int) -> dict[bytes, int]:
        return dict(zip(self._terms[slot].as_py().split(b" "), np.frombuffer(self._tfs[slot].as_buffer(), dtype=np.uint32).tolist()))

    def scores(self, slots: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Items by the given documents: exact scores from the documents' counts."""
        out = np.zeros((times.shape[0], len(slots)), dtype=np.int64)
        for start in range(0, len(slots), SCORE_SLOTS):
            out[:, start:start + SCORE_SLOTS] = self._scores(slots[start:start + SCORE_SLOTS], times)
        return out

    def _scores(self, slots: np.ndarray, times: np.ndarray) -> np.ndarray:
        place = self.items.place
        rows, cols, tfs = [], [], []
        for at, slot in enumerate(slots):
            counts = self.counts(slot)
            for t in counts.keys() & place.keys():
                rows.append(at)
                cols.append(place[t])
                tfs.append(counts[t])
        if not cols:
            return np.zeros((times.shape[0], len(slots)), dtype=np.int64)
        used, cols = np.unique(np.array(cols), return_inverse=True)
        rows, tfs = np.array(rows), np.array(tfs, dtype=np.int64)
        parts = np.zeros((len(used), len(slots)), dtype=np.int64)
        parts[cols, rows] = self.items.weights[used[cols]] * contribution(tfs, self.m[slots][rows])
        sums = times[:, used].sum(axis=1).max(initial=0) * float(parts.max(initial=0))
        if sums < 2 ** 52:  # whole numbers below that are exact in doubles
            return (times[:, used] @ parts.astype(np.float64)).astype(np.int64)
        return times[:, used].astype(np.int64) @ parts


def _opened(batches: Iterator[pa.RecordBatch], items: Items) -> Iterator[Block]:
    for b in batches:
        for row in range(b.num_rows):
            yield Block(b, row, items)


def document_frequencies(index: DataFrame, terms: list[bytes]) -> dict[bytes, int]:
    """How many documents hold each of the given terms (the terms of a block of items)."""
    wanted = frozenset(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df: Counter = Counter()
        for b in batches:
            for held in b.column(0).flatten():
                df.update(wanted.intersection(held.as_py().split(b" ")))
        yield pa.RecordBatch.from_arrays([pa.array(list(df), pa.binary()), pa.array(list(df.values()), pa.int64())], names=["term", "df"])
    found = index.select("terms").mapInArrow(run, "term binary, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {bytes(r.term): r.df for r in found.collect()}


def floors(index: DataFrame, items: Items, k: int) -> np.ndarray:
    """For each item a score that its k-th best document reaches: the k-th best of the block leaders' scores."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = items.times()
        best = np.zeros((len(items.ids), 0), dtype=np.int64)
        for block in _opened(batches, items):
            bounds = block.bounds(times)
            lead = np.argpartition(-bounds, min(SEEDS, bounds.shape[1]) - 1, axis=1)[:, :SEEDS]
            slots, at = np.unique(lead, return_inverse=True)
            scores = np.take_along_axis(block.scores(slots, times), at.reshape(lead.shape), axis=1)
            best = -np.sort(-np.concatenate([best, scores], axis=1), axis=1)[:, :k]
        item, _ = np.nonzero(best)
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(best[best != 0], pa.int64())], names=["item", "score"])
    leaders = index.mapInArrow(run, "item int, score long")
    kth = Window.partitionBy("item").orderBy(F.desc("score"))
    out = np.zeros(len(items.ids), dtype=np.int64)
    for r in leaders.withColumn("rank", F.row_number().over(kth)).where(F.col("rank") == k).collect():
        out[r.item] = r.score
    return out


def rescored(index: DataFrame, items: Items, k: int) -> DataFrame:
    """``item, doc_id, score`` of a task's best documents, and how many pairs it had and rescored (item null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = items.times()
        best: list[list] = [[] for _ in items.ids]
        reach = np.maximum(items.floors, 1)
        pairs = scored = 0
        for block in _opened(batches, items):
            open_ = block.bounds(times) >= reach[:, None]
            slots = np.nonzero(open_.any(axis=0))[0]
            pairs, scored = pairs + open_.size, scored + int(open_.sum())
            if not len(slots):
                continue
            scores = block.scores(slots, times)
            hits = open_[:, slots] & (scores >= reach[:, None])
            for item in np.nonzero(hits.any(axis=1))[0]:
                at = np.nonzero(hits[item])[0]
                new = [(-int(scores[item, a]), block.ids[slots[a]] is None, block.ids[slots[a]] or 0) for a in at]
                best[item] = sorted(best[item] + new)[:k]
                if len(best[item]) == k:
                    reach[item] = max(reach[item], -best[item][-1][0])
        rows = [(item, None if null else doc, -score) for item, found in enumerate(best) for score, null, doc in found]
        rows.append((None, scored, pairs))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
                                          pa.array([r[2] for r in rows], pa.int64())], names=["item", "doc_id", "score"])
    return index.mapInArrow(run, "item int, doc_id long, score long")


def _item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[Items]:
    rows, size = [], 0
    for r in items.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).toLocalIterator():
        counts = term_counts(r.text)
        if not counts:
            continue
        if rows and (len(rows) >= ITEM_BLOCK or size + len(counts) > ITEM_TERMS):
            yield Items(rows)
            rows, size = [], 0
        rows.append((r.id, counts))
        size += len(counts)
    if rows:
        yield Items(rows)


def search(items: DataFrame, docs: DataFrame, k: int = 20, item_id: str = "item_id", item_text: str = "text",
           id_col: str = "doc_id", text_col: str = "text", tally: list | None = None) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of each item, equal scores by id.

    ``tally`` receives, for each block of items, how many pairs of item and
    document there were and how many of them were rescored.
    """
    spark = docs.sparkSession
    prepare(spark)
    with _small_batches(spark):
        index = written(build_index(docs, id_col, text_col), "bloom-index")
    size = index.agg(F.sum(F.size("ids").cast("long")).alias("docs"),
                     F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, b: a + b)).alias("terms")).first()
    result = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    if not size.docs:
        return result
    for block in _item_blocks(items, item_id, item_text):
        with _small_batches(spark, READ_ROWS):
            block.weigh(document_frequencies(index, block.terms), int(size.docs), int(size.terms))
            block.floors = floors(index, block, k)
            found = written(rescored(index, block, k), "bloom-found")
        if tally is not None:
            tally.append(tuple(found.where("item IS NULL").agg(F.sum("score"), F.sum("doc_id")).first()))
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.where("item IS NOT NULL").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        ids = F.array(*[F.lit(i).cast("long") for i in block.ids])
        result = result.unionByName(ranked.select(ids[F.col("item")].alias("item_id"), "rank", "doc_id", "score"))
    return result

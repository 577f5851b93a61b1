"""Operator 4: interpolated modified Kneser-Ney bigram model over the corpus.

Counting runs in Spark in three steps, each written to a model folder below
``spark.checkpoint.dir``, which driver and workers must see as one path:

1. words: per task, counts by the word's XXH64, dealt by hash range; each
   range becomes a sorted hash array with counts.  A word's id is its rank.
2. pairs: per task, counts of (previous id, id), dealt by a hash of the pair
   so that no frequent context gathers in one task; each bucket becomes a
   sorted array of pairs with counts.
3. contexts: sums by id range of what the pair buckets hold of each word, as
   context and as continuation, become dense arrays.

Workers map these arrays into memory and look words and pairs up by binary
search, so a worker holds no part of the model in its own memory.  The unigram
level counts distinct predecessors and is interpolated with the uniform
distribution over the vocabulary and one unknown word.  A text's first word
follows an end.

The order is two: see the README for what a third order would take on disk.

Defined cases: null and empty texts are one end token; null ids belong to the
training rows; repeated rows count each time; with no training rows every
score is that of the uniform distribution over the unknown word alone, zero;
an empty table gives an empty result; extra columns are ignored.  Words of
equal XXH64 count as one (below 2^32 words, by far the least likely event here);
more than 2^32 distinct words are refused with an error.
"""

from __future__ import annotations

import os
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import U64, bucket_cuts, mix64, pack, pack_sorted, prepare, text_column, unpack, unpack_sorted, written
from starloom.session import scratch_path

END = b"\n"              # never a word: words hold no white space
PORTION = 4 << 20        # bytes of text tokenised at a time
BUCKET_BYTES = 8 << 20   # text bytes per bucket of the model
FLUSH = 4_000_000        # entries a task gathers before it sends them on
_SPACES = b" \t\n\v\f\r"


def model_folder(uri: str) -> str:
    """The path of a shared folder that Python can map; other file systems are refused."""
    parsed = urlparse(uri)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped model arrays need a mounted spark.checkpoint.dir, not {parsed.scheme}://")
    return parsed.path


def save(folder: str, name: str, array: np.ndarray) -> None:
    """Write an array so that a reader, or a second attempt of the task, never meets half of it."""
    part = f"{folder}/.{name}-{uuid.uuid4().hex}.npy"
    np.save(part, array)
    os.replace(part, f"{folder}/{name}.npy")


def portions(texts: Iterator[bytes]) -> Iterator[list[tuple[int, list[bytes], bool]]]:
    """Lists of (text number, words, whether the text ends here) of about ``PORTION`` bytes; long texts in pieces."""
    out, size = [], 0
    for k, data in enumerate(texts):
        at = 0
        while True:
            end = min(len(data), at + PORTION)
            while end < len(data) and data[end] not in _SPACES:
                end += 1
            piece = data if at == 0 and end == len(data) else data[at:end]
            out.append((k, piece.lower().split(), end >= len(data)))
            size += len(piece)
            if size >= PORTION:
                yield out
                out, size = [], 0
            if end >= len(data):
                break
            at = end
    if out:
        yield out


def flat_words(portion) -> tuple[list[bytes], np.ndarray]:
    """All tokens of a portion, ends included, and their text numbers."""
    words, owner, sizes = [], [], []
    for k, ws, last in portion:
        words += ws
        n = len(ws)
        if last:
            words.append(END)
            n += 1
        owner.append(k)
        sizes.append(n)
    return words, np.repeat(np.array(owner, dtype=np.int64), sizes)


def _rows(b: pa.RecordBatch) -> Iterator[bytes]:
    return (t.as_py() for t in b.column("_t"))


def _spread(keys: np.ndarray, counts: np.ndarray, bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    keys, counts, bucket = keys[order], counts[order], bucket[order]
    cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, int)
    for a, z in zip(cut, np.append(cut[1:], len(bucket))):
        yield int(bucket[a]), keys[a:z], counts[a:z]


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return keys[head], np.add.reduceat(counts, head) if len(head) else counts[:0]


class Gather:
    """Counts by key that a task holds until they are sent on."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray):
        self.parts.append((keys, counts))
        self.size += len(keys)

    def full(self) -> bool:
        if self.size > FLUSH:
            self.merge()
        return self.size > FLUSH // 2

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, U64), np.zeros(0, np.int64)
        merged = summed(np.concatenate([k for k, _ in self.parts]), np.concatenate([c for _, c in self.parts]))
        self.parts, self.size = [merged], len(merged[0])
        return merged


def _blobs(spread, encode) -> pa.RecordBatch:
    rows = [(b, encode(k), pack(c.astype(np.uint32)) if c.max(initial=0) < 1 << 32 else pack(c.astype(np.uint64)),
             bool(c.max(initial=0) >= 1 << 32)) for b, k, c in spread]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], type=pa.int32()), pa.array([r[1] for r in rows], type=pa.binary()),
         pa.array([r[2] for r in rows], type=pa.binary()), pa.array([r[3] for r in rows], type=pa.bool_())],
        names=["bucket", "keys", "counts", "wide"])


_BLOB = "bucket int, keys binary, counts binary, wide boolean"


def _unblob(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = [], []
    for k, c, wide in zip(table.column("keys").to_pylist(), table.column("counts").to_pylist(), table.column("wide").to_pylist()):
        keys.append(unpack_sorted(k))
        counts.append(unpack(c, np.uint64 if wide else np.uint32).astype(np.int64))
    return summed(np.concatenate(keys), np.concatenate(counts))


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


@dataclass
class Model:
    """Where the arrays lie, and the few numbers that belong to all of them."""

    folder: str
    buckets: int
    offsets: list[int] = field(default_factory=list)   # id of the first word of each hash range, and V
    tokens: int = 0
    ranges: int = 1
    discounts: tuple[float, float, float] = (0.75, 0.75, 0.75)
    low_discounts: tuple[float, float, float] = (0.75, 0.75, 0.75)
    pairs: int = 0                                      # distinct pairs
    pair_sizes: list[int] = field(default_factory=list)  # distinct pairs of each bucket
    low_rest: float = 1.0                               # mass the unigram level leaves to the uniform one

    @property
    def vocabulary(self) -> int:
        return self.offsets[-1] if self.offsets else 0

    def range_edges(self) -> np.ndarray:
        return np.array([self.vocabulary * r // self.ranges for r in range(self.ranges + 1)], dtype=np.int64)


class Arrays:
    """The model's arrays, mapped when first touched.

    The model knows how long each of its arrays is.  One that is not there, or not
    whole, is an error: the shared folder is out of sight or files were lost, and
    scores without it would be wrong.
    """

    def __init__(self, model: Model):
        self.m = model
        self.open: dict[str, np.ndarray] = {}
        self.known: dict[bytes, int] = {}

    def get(self, name: str, length: int) -> np.ndarray:
        if name not in self.open:
            path = f"{self.m.folder}/{name}.npy"
            if not os.path.exists(path):
                raise FileNotFoundError(f"the model's array {path} is missing; spark.checkpoint.dir must be a folder that all machines share")
            table = np.load(path, mmap_mode="r")
            if len(table) != length:
                raise ValueError(f"the model's array {path} has {len(table)} entries, not {length}")
            self.open[name] = table
        return self.open[name]

    def ids(self, words: list[bytes]) -> np.ndarray:
        """Word ids, -1 for words the training rows do not have."""
        if len(self.known) > 400_000:
            self.known.clear()
        new = list({w for w in words if w not in self.known})
        if new:
            h = np.fromiter(map(word_hash, new), dtype=U64, count=len(new))
            order = np.argsort(h)
            found = np.full(len(new), -1, dtype=np.int64)
            cuts = bucket_cuts(h[order], self.m.buckets)
            for b in np.flatnonzero(np.diff(cuts)):
                length = self.m.offsets[b + 1] - self.m.offsets[b]
                if not length:
                    continue
                table = self.get(f"words-{b}", length)
                mine = order[cuts[b]:cuts[b + 1]]
                at = np.minimum(np.searchsorted(table, h[mine]), len(table) - 1)
                found[mine] = np.where(table[at] == h[mine], at + self.m.offsets[b], -1)
            self.known.update(zip(new, found.tolist()))
        return np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))

    def by_word(self, name: str, ids: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Values of the array family ``name`` at sorted ids; ``edges`` are the ids where its files begin."""
        out = np.zeros(len(ids), dtype=np.int64)
        cuts = np.searchsorted(ids, edges)
        for r in np.flatnonzero(np.diff(cuts)):
            table = self.get(f"{name}-{r}", int(edges[r + 1] - edges[r]))
            out[cuts[r]:cuts[r + 1]] = table[ids[cuts[r]:cuts[r + 1]] - edges[r]]
        return out

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted distinct pairs."""
        out = np.zeros(len(keys), dtype=np.int64)
        bucket = pair_bucket(keys, self.m.buckets)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(self.m.buckets + 1))
        for b in np.flatnonzero(np.diff(cuts)):
            length = self.m.pair_sizes[b]
            if not length:
                continue
            table = self.get(f"pairs-{b}", length)
            mine = order[cuts[b]:cuts[b + 1]]
            at = np.minimum(np.searchsorted(table, keys[mine]), len(table) - 1)
            out[mine] = np.where(table[at] == keys[mine], self.get(f"pair-counts-{b}", length)[at], 0)
        return out


def pair_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (((mix64(keys) >> U64(32)) * U64(buckets)) >> U64(32)).astype(np.int32)


def pair_keys(ids: np.ndarray) -> np.ndarray:
    return (ids[:-1].astype(U64) << U64(32)) | ids[1:].astype(U64)


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of keys met once, twice, three and four times."""
    if n[0] == 0 or n[1] == 0:
        return 0.75, 0.75, 0.75
    y = n[0] / (n[0] + 2 * n[1])
    d = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2] if n[2] else 3 - 4 * y]
    return tuple(min(max(x, 0.05), k + 0.95) for k, x in enumerate(d))


def discounted(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    take = np.where(counts >= 3, d[2], np.where(counts == 2, d[1], d[0]))
    return np.where(counts > 0, counts - take, 0.0)


def _count_words(train: DataFrame, model: Model) -> None:
    buckets, folder = model.buckets, model.folder

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Gather()

        def send():
            keys, counts = held.merge()
            held.__init__()
            cuts = bucket_cuts(keys, buckets)
            return _blobs(((b, keys[cuts[b]:cuts[b + 1]], counts[cuts[b]:cuts[b + 1]]) for b in np.flatnonzero(np.diff(cuts))), pack_sorted)

        for b in batches:
            for portion in portions(_rows(b)):
                words = Counter(flat_words(portion)[0])
                h = np.fromiter(map(word_hash, words), dtype=U64, count=len(words))
                held.add(*summed(h, np.fromiter(words.values(), dtype=np.int64, count=len(words))))
                if held.full():
                    yield send()
        if held.size:
            yield send()

    def store(table: pa.Table) -> pa.Table:
        b = table.column("bucket")[0].as_py()
        keys, counts = _unblob(table)
        save(folder, f"words-{b}", keys)
        save(folder, f"word-counts-{b}", counts)
        return pa.table({"bucket": pa.array([b], type=pa.int32()), "n": pa.array([len(keys)], type=pa.int64()),
                         "tokens": pa.array([int(counts.sum())], type=pa.int64())})

    sizes = train.mapInArrow(count, _BLOB).groupBy("bucket").applyInArrow(store, "bucket int, n long, tokens long").collect()
    per = np.zeros(buckets, dtype=np.int64)
    for r in sizes:  # a row per bucket
        per[r.bucket] = r.n
        model.tokens += r.tokens
    model.offsets = [0, *np.cumsum(per).tolist()]
    if model.vocabulary >= 1 << 32:
        raise ValueError("more than 2^32 distinct words")


def _count_pairs(train: DataFrame, model: Model) -> None:
    folder, buckets = model.folder, model.buckets
    model.ranges = max(1, buckets // 8)
    edges = model.range_edges()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays, held = Arrays(model), Gather()
        end = int(arrays.ids([END])[0])

        def send():
            keys, counts = held.merge()
            held.__init__()
            return _blobs(_spread(keys, counts, pair_bucket(keys, buckets)), pack_sorted)

        for b in batches:
            last = end
            for portion in portions(_rows(b)):
                words, _ = flat_words(portion)
                ids = arrays.ids(words)
                if not len(ids):
                    continue
                keys = pair_keys(np.concatenate([[last], ids]))
                last = int(ids[-1])
                keys, counts = np.unique(keys, return_counts=True)
                held.add(keys, counts.astype(np.int64))
                if held.full():
                    yield send()
        if held.size:
            yield send()

    def split(kind: int, ids: np.ndarray, values: np.ndarray):
        """Rows for the range tasks: distinct sorted ids with four sums each."""
        cuts = np.searchsorted(ids, edges)
        for r in np.flatnonzero(np.diff(cuts)):
            part = slice(cuts[r], cuts[r + 1])
            yield kind, int(r), pack_sorted(ids[part].astype(U64)), pack(values[part].astype(np.int64).reshape(-1))

    def store(table: pa.Table) -> pa.Table:
        b = table.column("bucket")[0].as_py()
        keys, counts = _unblob(table)
        save(folder, f"pairs-{b}", keys)
        save(folder, f"pair-counts-{b}", counts.astype(np.uint32) if counts.max() < 1 << 32 else counts)
        one = np.stack([counts, counts == 1, counts == 2, counts >= 3], axis=1).astype(np.int64)
        before = (keys >> U64(32)).astype(np.int64)
        head = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
        rows = list(split(0, before[head], np.add.reduceat(one, head, axis=0)))
        word, kinds = np.unique((keys & U64(0xFFFFFFFF)).astype(np.int64), return_counts=True)
        rows += split(1, word, kinds)
        small = [int((counts == n).sum()) for n in (1, 2, 3, 4)]
        rows.append((2, b, b"", pack(np.array([*small, len(keys)], dtype=np.int64))))
        return pa.table({"kind": pa.array([r[0] for r in rows], type=pa.int32()), "part": pa.array([r[1] for r in rows], type=pa.int32()),
                         "ids": pa.array([r[2] for r in rows], type=pa.binary()), "sums": pa.array([r[3] for r in rows], type=pa.binary())})

    def dense(table: pa.Table) -> pa.Table:
        r = table.column("part")[0].as_py()
        n = int(edges[r + 1] - edges[r])
        context, continuation = np.zeros((n, 4), dtype=np.int64), np.zeros(n, dtype=np.int64)
        for kind, ids, sums in zip(*[table.column(c).to_pylist() for c in ("kind", "ids", "sums")]):
            at = unpack_sorted(ids).astype(np.int64) - edges[r]
            if kind == 0:
                context[at] += unpack(sums, np.int64).reshape(-1, 4)
            else:
                continuation[at] += unpack(sums, np.int64)
        for k, name in enumerate(("context", "once", "twice", "more")):
            save(folder, f"{name}-{r}", context[:, k])
        save(folder, f"continuation-{r}", continuation)
        some = [int((continuation == k).sum()) for k in (1, 2, 3, 4)] + [int((continuation >= 3).sum())]
        return pa.table({f"n{k}": pa.array([x], type=pa.int64()) for k, x in enumerate(some)})

    stored = written(train.mapInArrow(count, _BLOB).groupBy("bucket").applyInArrow(
        store, "kind int, part int, ids binary, sums binary"), "kn-sums")
    n = np.zeros(5, dtype=np.int64)
    sizes = [0] * buckets
    for r in stored.where("kind = 2").select("part", "sums").collect():  # a row per bucket
        sums = unpack(bytes(r.sums), np.int64)
        n += sums
        sizes[r.part] = int(sums[4])
    model.pair_sizes = sizes
    model.discounts, model.pairs = discounts(n[:4].tolist()), int(n[4])
    t = stored.where("kind < 2").groupBy("part").applyInArrow(dense, ", ".join(f"n{k} long" for k in range(5))) \
        .agg(*[F.coalesce(F.sum(f"n{k}"), F.lit(0)).alias(f"n{k}") for k in range(5)]).first()
    model.low_discounts = d = discounts([t.n0, t.n1, t.n2, t.n3])
    model.low_rest = (d[0] * t.n0 + d[1] * t.n1 + d[2] * t.n4) / model.pairs if model.pairs else 1.0


def train(rows: DataFrame, text_bytes: int) -> Model:
    """Count a model over ``_t`` (binary) of ``rows``."""
    spark = rows.sparkSession
    prepare(spark)
    folder = model_folder(scratch_path(spark, "kneser-ney"))
    os.makedirs(folder)
    model = Model(folder, int(max(4, -(-text_bytes // BUCKET_BYTES))))
    _count_words(rows, model)
    if model.tokens:
        _count_pairs(rows, model)
    return model


def _score_portion(arrays: Arrays, words: list[bytes], before: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token: whether it is known, its base and its model log10 probability; ``before`` is the id before the first."""
    m = arrays.m
    ids = arrays.ids(words)
    every = np.concatenate([[before], ids])
    distinct, at = np.unique(every, return_inverse=True)
    known = distinct >= 0
    word_edges, edges = np.array(m.offsets or [0, 0], dtype=np.int64), m.range_edges()
    spread = {}
    for name, cuts in (("word-counts", word_edges), *[(k, edges) for k in ("context", "once", "twice", "more", "continuation")]):
        values = np.zeros(len(distinct), dtype=np.int64)
        values[known] = arrays.by_word(name, distinct[known], cuts)
        spread[name] = values
    v = m.vocabulary
    base = np.log10((spread["word-counts"] + 0.5) / (m.tokens + 0.5 * (v + 1)))
    low = m.low_rest / (v + 1)
    if m.pairs:
        low = low + discounted(spread["continuation"], m.low_discounts) / m.pairs
    low = np.broadcast_to(low, len(distinct))
    context = spread["context"]
    d = m.discounts
    rest = np.where(context > 0, (d[0] * spread["once"] + d[1] * spread["twice"] + d[2] * spread["more"]) / np.maximum(context, 1), 1.0)
    prev, cur = at[:-1], at[1:]
    p = rest[prev] * low[cur]
    both = np.flatnonzero(known[prev] & known[cur])
    if len(both):
        keys, where = np.unique((distinct[prev[both]].astype(U64) << U64(32)) | distinct[cur[both]].astype(U64), return_inverse=True)
        p[both] += discounted(arrays.pair_counts(keys), d)[where] / np.maximum(context[prev[both]], 1)
    return (spread["word-counts"] > 0)[cur], base[cur], np.log10(p)


def score(rows: DataFrame, model: Model) -> DataFrame:
    """``_id, n_tokens, n_known, base, score`` of every row (``_id, _t``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = Arrays(model)
        end = int(arrays.ids([END])[0])
        for b in batches:
            n = b.num_rows
            tokens, known, base, full = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
            last = end
            for portion in portions(_rows(b)):
                words, owner = flat_words(portion)
                if not words:
                    continue
                k, lo, hi = _score_portion(arrays, words, last)
                last = int(arrays.ids(words[-1:])[0])
                tokens += np.bincount(owner, minlength=n)
                known += np.bincount(owner, weights=k, minlength=n).astype(np.int64)
                base += np.bincount(owner, weights=lo, minlength=n)
                full += np.bincount(owner, weights=hi, minlength=n)
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(tokens), pa.array(known), pa.array(base), pa.array(full)],
                                             names=["_id", "n_tokens", "n_known", "base", "score"])

    return rows.mapInArrow(run, "_id long, n_tokens long, n_known long, base double, score double")


def held_out(id_col: Column) -> Column:
    """Whether the CRC-32 of the id as text leaves 1 modulo 5; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def corpus_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the rows not held out and score every row."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), text_column(text_col).cast("binary").alias("_t"))
    size = rows.agg(F.sum(F.octet_length("_t")).alias("n")).first().n or 0
    model = train(rows.where(~held_out(F.col("_id"))).select("_t"), size)
    s = score(rows, model)
    return s.select(F.col("_id").alias(id_col), held_out(F.col("_id")).alias("held_out"), "n_tokens", "n_known",
                    F.lit(model.tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")

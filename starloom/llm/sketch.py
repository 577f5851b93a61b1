"""Operator 11: document fingerprints by a threshold-scaled sketch (DataFrame functions only).

A document's words (lower-cased, split at white space) give its shingles of
five words; a text of fewer words is one shingle.  A shingle's hash is the
first 64 bits of its MD5, in hex.  The sketch keeps every distinct hash below a
fixed fraction of the hash range, sorted.  Whether a hash is kept depends on
nothing else, so sketches of parts merge by union (:func:`merge`), and the
share of kept hashes that two sketches have in common estimates containment
between documents of very unequal length, unlike a sketch of fixed size.

A sketch of a short text may be empty.  The fingerprint therefore starts with
the hash of the whole word sequence: equal sequences have likeness 1, and
where neither that nor any kept hash says more, likeness is 0.

:func:`neighbours` gives each document the beginning of the next one in
descending order of ids.  Documents are numbered in that order over narrow rows
(key, id, length); texts move once, partitioned by the key, a SHA-256 of id and
text, and the beginnings that neighbours need move once more.  Equal rows are combined
before any of this, so no id or text that many rows share gathers in a task.

Defined cases: a null text is empty; an empty text (or white space only) has
no shingle and shares its word sequence with every other such text; null ids
come last in descending order; rows of one id are ordered by their keys; of repeated rows each but the last is followed by its copy; a
single document is its own neighbour; an empty table gives an empty result;
extra columns take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import WHITE, prepare, text_column, written
from starloom.operators.keys import assign_surrogate_keys

SHINGLE = 5
FRACTION = 1 / 8
HASH_DIGITS = 16
REPEAT = 1 << 16  # copies of a row listed at a time


def threshold(fraction: float) -> str:
    """The hex digits that kept hashes are below."""
    if not 0 < fraction <= 1:
        raise ValueError(f"the fraction must be in (0, 1], not {fraction}")
    return "g" if fraction == 1 else f"{int(fraction * (1 << 64)):016x}"


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), WHITE), lambda w: w != "")


def _md5(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def sequence_hash(ws: Column) -> Column:
    return F.substring(_md5(F.array_join(ws, " ")), 1, HASH_DIGITS)


def sketch(ws: Column, size: int = SHINGLE, fraction: float = FRACTION) -> Column:
    """Sorted distinct shingle hashes below ``fraction`` of the range, from an array of words."""
    n = F.size(ws)

    def shingle(i: Column) -> Column:
        spaced = [part for j in range(size) for part in (F.lit(" "), F.get(ws, i + j))]
        return _md5(F.concat(*spaced[1:]))

    digests = F.when(n >= size, F.transform(F.sequence(F.lit(0), F.greatest(n - size, F.lit(0))), shingle)) \
        .when(n > 0, F.array(_md5(F.array_join(ws, " ")))).otherwise(F.array().cast("array<string>"))
    kept = F.filter(digests, lambda h: h < threshold(fraction))
    return F.array_sort(F.array_distinct(F.transform(kept, lambda h: F.substring(h, 1, HASH_DIGITS))))


def merge(sketches: Column) -> Column:
    """Aggregate: the sketch of documents taken together, from their sketches."""
    return F.array_sort(F.array_distinct(F.flatten(F.collect_set(sketches))))


def containment(a: Column, b: Column) -> Column:
    """The estimated share of ``a``'s shingles that ``b`` has (null if the sketch of ``a`` is empty)."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a).cast("double"))


def resemblance(a: Column, b: Column) -> Column:
    """The estimated share of common shingles among those of either; 0 if both sketches are empty."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either > 0, both.cast("double") / either).otherwise(F.lit(0.0))


def likeness(a: Column, b: Column) -> Column:
    """Of two ``(whole, kept)`` structs: 1 for equal word sequences, else their resemblance."""
    return F.when(a["whole"] == b["whole"], F.lit(1.0)).otherwise(resemblance(a["kept"], b["kept"]))


def fingerprint(text: Column, size: int = SHINGLE, fraction: float = FRACTION) -> Column:
    """``(whole, kept)`` of a text.

    The words are bound to a lambda variable: they are split once a text, not once a shingle.
    """
    return F.transform(F.array(words(text)), lambda ws: F.struct(sequence_hash(ws).alias("whole"),
                                                                 sketch(ws, size, fraction).alias("kept")))[0]


def as_text(mark: Column) -> Column:
    return F.concat(mark["whole"], F.lit(":"), F.array_join(mark["kept"], ""))


def _follow(narrow: DataFrame) -> DataFrame:
    """Distinct rows, each with the row before it: ``_key``, and of that row ``_before``, ``_need``, ``_copies``."""
    order = narrow.withColumn("_down", F.bitwise_not("_id")).withColumn("_none", F.col("_id").isNull())
    placed = written(assign_surrogate_keys(order, ["_none", "_down", "_key"], "_place").select("_key", "_chars", "_copies", "_place"),
                     "sketch-order")
    last = placed.agg(F.max("_place")).first()[0] or 1
    before = placed.select(F.col("_key").alias("_before"), F.expr("_chars div 3").cast("int").alias("_need"), "_copies",
                           (F.col("_place") % F.lit(last) + 1).alias("_place"))
    return placed.select("_key", "_place").join(before, "_place").drop("_place")


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
               fraction: float = FRACTION) -> DataFrame:
    """``id, text, mark, start, next_mark, copies``: documents beside the next one.

    ``start`` is as much of the next document as a third of the text's length, ``mark``
    and ``next_mark`` are the fingerprints of the text and of the next document.
    A row stands for ``copies`` equal ones.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), text_column(f"`{text_col}`").alias("_text"))
    key = F.concat_ws(":", F.coalesce(F.col("_id").cast("string"), F.lit("null")), F.col("_text"))
    keyed = rows.select(F.unhex(F.sha2(key.cast("binary"), 256)).alias("_key"), "_id", "_text")
    narrow = keyed.groupBy("_key").agg(F.max("_id").alias("_id"), F.count(F.lit(1)).alias("_copies"),
                                       F.max(F.char_length("_text")).alias("_chars"))
    follow = written(_follow(narrow), "sketch-follow")
    # both uses below need the same columns, so that texts are shuffled once and the exchange is read twice
    texts = keyed.groupBy("_key").agg(F.first(F.struct("_id", "_text")).alias("_row"))
    marked = texts.select("_key", F.col("_row._id").alias("id"), F.col("_row._text").alias("text")) \
        .withColumn("mark", fingerprint(F.col("text"), size, fraction))
    starts = marked.join(follow, "_key").select(F.col("_before").alias("_key"), F.expr("substring(text, 1, _need)").alias("_start"),
                                                F.col("mark").alias("_next"), "_copies")
    own = F.expr("substring(text, 1, int(char_length(text) div 3))")
    kinds = F.array(F.struct(F.col("_start").alias("start"), F.col("_next").alias("next_mark"), F.lit(1).cast("long").alias("copies")),
                    F.struct(own.alias("start"), F.col("mark").alias("next_mark"), (F.col("_copies") - 1).alias("copies")))
    return marked.join(starts, "_key").select("id", "text", "mark", F.explode(F.filter(kinds, lambda k: k["copies"] > 0)).alias("k")) \
        .select("id", "text", "mark", "k.*")


def _times(copies: str) -> Column:
    """Blocks of copies, as (first, last): a row with very many copies is listed in pieces."""
    return F.transform(F.sequence(F.lit(0).cast("long"), F.col(copies) - 1, F.lit(REPEAT).cast("long")),
                       lambda i: F.struct(i.alias("a"), F.least(i + REPEAT, F.col(copies)).alias("b")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                 fraction: float = FRACTION) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and how alike it is to that and to the next document."""
    near = neighbours(docs, id_col, text_col, size, fraction)
    n = F.char_length("text")
    edited = F.concat(F.expr("substring(text, 1, char_length(text) - int(char_length(text) div 3))"), F.col("start"))
    told = near.select("id", "copies", n.cast("long").alias("n_chars"), "mark", "next_mark", edited.alias("edited")) \
        .withColumn("edited_mark", fingerprint(F.col("edited"), size, fraction))
    out = told.select("id", "copies", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                      as_text(F.col("mark")).alias("fingerprint"), as_text(F.col("edited_mark")).alias("edited_fingerprint"),
                      likeness(F.col("mark"), F.col("edited_mark")).alias("near_edited"),
                      likeness(F.col("mark"), F.col("next_mark")).alias("near_next"),
                      containment(F.col("mark.kept"), F.col("edited_mark.kept")).alias("contained_in_edited"))
    cols = [c for c in out.columns if c != "copies"]
    pieces = out.select(*cols, F.explode(_times("copies")).alias("p"))
    return pieces.select(*cols, F.explode(F.sequence(F.col("p.a"), F.col("p.b") - 1)).alias("_c")).drop("_c")

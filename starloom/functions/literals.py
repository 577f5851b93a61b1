"""Parsing of Python-literal text cells (dicts, lists) into typed columns.

Three readings, each for the cells that the one before cannot read exactly:

1. The common shapes (``{'a': 1}``, ``[['x', 'y']]``) by a lenient ``from_json``.
2. Python's own shapes (tuples, ``None``, ``True``, trailing commas, ragged
   nesting, the usual backslash escapes) are held against the grammar of
   literals and rewritten to strict JSON, still on the JVM; plain words are
   no literal.
3. What is left (sets, unusual escapes or numbers, text prefixes, deep
   nesting) goes to a vectorised ``pandas_udf`` running ``ast.literal_eval``;
   only those rows carry a value into Python, every other row passes a null,
   so the Arrow batches stay small.  With ``defer`` nothing runs in Python:
   such rows are only marked, for a second pass over them.
"""

from __future__ import annotations

import ast
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import col_of

LENIENT = {
    "allowSingleQuotes": "true",
    "allowBackslashEscapingAnyCharacter": "true",
    "allowNonNumericNumbers": "false",
    "mode": "PERMISSIVE",
}

# Text the lenient JSON reader would accept but Python reads otherwise
# (escapes, bare words that are names in Python, not literals).
SUSPECT = r"\\|\b(true|false|null|NaN|Infinity)\b"

# A flat list of plain whole numbers, which JSON and Python read alike: no further test.
PLAIN_NUMBERS = r"^\[(?:0|[1-9][0-9]{0,8})(?:, ?(?:0|[1-9][0-9]{0,8}))*+\]\z"


def plain_numbers(c: Column) -> Column:
    """The numbers of a cell that matches :data:`PLAIN_NUMBERS`, as ``array<double>``."""
    return F.split(F.translate(c, "[ ]", ""), ",").try_cast("array<double>")


# Quoted text, and a bracket pair without brackets inside.
QUOTED, INNERMOST = r"\"[^\"]*\"|'[^']*'", r"\[[^\[\]{}]*\]|\{[^\[\]{}]*\}"
DEPTH = 4


def one_value(c: Column) -> Column:
    """Whether the text is one bracketed value and nothing after it.

    The JSON reader stops at the end of the first value, so ``[2, 3] x`` or
    ``[2, 3]]`` would pass.  Quoted text is blanked and bracket pairs are
    folded from the inside; one folded pair must be all that is left.  Deeper
    text than ``DEPTH`` fails the test and is read by Python.
    """
    text = F.regexp_replace(c, QUOTED, "q")
    for _ in range(DEPTH):
        text = F.regexp_replace(text, INNERMOST, "v")
    return F.trim(text) == "v"


# Python's texts, with the escapes that JSON has too (and ``\\xhh``); loops are
# possessive, so a long text takes no stack.
_ESCAPE = r"""\\(?:[\\'"nrtbf]|x[0-9a-fA-F]{2}|u(?![dD][89a-fA-F])[0-9a-fA-F]{4})"""
TEXT = rf"""'(?:[^'\\]++|{_ESCAPE})*+'|"(?:[^"\\]++|{_ESCAPE})*+\""""
WORD = r"\b(?:None|True|False)\b"
# Numbers that Python prints as they are written.
NUMBER = r"(?<![\w.+-])(?:0|-?[1-9]\d{0,17}|-?(?:0|[1-9]\d{0,8})\.(?:0|\d{0,3}[1-9]))(?![\w.+-])"
CONTROL = r"[\x00-\x08\x0a-\x1f\x7f]"
PLAIN = r"^[ \t]*+(?!(?:None|True|False)[ \t]*+$)(?:[A-Za-z]++(?:[ \t]++[A-Za-z]++)*+[ \t]*+)?$"
# Signs that stand for a text, an atom and a folded bracket pair: control characters, which the cell does not hold.
_Q, _A, _V = "\x01", "\x02", "\x03"
_ANY = "[\x01-\x03]"
FOLD = (rf"\[(?:{_ANY}(?:,{_ANY})*+,?)?\]|\((?:{_ANY},(?:{_ANY}(?:,{_ANY})*+,?)?)?\)"
        rf"|\{{(?:{_Q}:{_ANY}(?:,{_Q}:{_ANY})*+,?)?\}}")
BRACKETS = {"[": "list", "(": "tuple", "{": "dict"}


def literal_kind(c: Column) -> Column:
    """The Python type name of a cell that the grammar below decides, else null.

    Texts, words and numbers become signs, blanks go, and well-formed lists,
    tuples and dicts with text keys fold from the inside; one folded pair must
    be left.  Plain words are text, as Python does not read them.
    """
    shape = F.regexp_replace(c, TEXT, _Q)
    for pattern in (WORD, NUMBER):
        shape = F.regexp_replace(shape, pattern, _A)
    shape = F.regexp_replace(shape, r"[ \t]+", "")
    for _ in range(DEPTH):
        shape = F.regexp_replace(shape, FOLD, _V)
    first = F.regexp_extract(c, r"^[ \t]*([\[({])", 1)
    kind = F.create_map(*[F.lit(x) for pair in BRACKETS.items() for x in pair])[first]
    return F.when(c.rlike(CONTROL), F.lit(None)).when(shape == _V, kind).when(c.rlike(PLAIN), F.lit("str"))


def _json_text(t: Column) -> Column:
    """A Python text, quotes included, as a JSON text; an even number of backslashes before a sign escapes nothing."""
    even = r"(?<!\\)((?:\\\\)*+)"
    body = F.substring(t, F.lit(2), F.length(t) - 2)
    body = F.regexp_replace(body, even + r"\\'", "$1'")
    body = F.regexp_replace(body, even + '"', r'$1\\"')
    body = F.regexp_replace(body, even + r"\\x([0-9a-fA-F]{2})", r"$1\\u00$2")
    return F.concat(F.lit('"'), F.regexp_replace(body, "\t", r"\\t"), F.lit('"'))


def _is_text(t: Column) -> Column:
    return t.startswith("'") | t.startswith('"')


def python_json(c: Column) -> Column:
    """A literal of known :func:`literal_kind` as JSON: tuples as arrays, no trailing commas."""
    def rewrite(t: Column) -> Column:
        out = F.regexp_replace(t, r",[ \t]*([\])}])", "$1")
        for word, value in (("None", "null"), ("True", "true"), ("False", "false")):
            out = F.replace(out, F.lit(word), F.lit(value))
        return F.when(_is_text(t), _json_text(t)).otherwise(F.translate(out, "()", "[]"))

    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(rf"{TEXT}|[^'\"]+"), F.lit(0)), rewrite), "")


def python_leaves(c: Column) -> Column:
    """The atoms of a literal as a JSON array of texts, nesting aside."""
    atoms = F.regexp_extract_all(c, F.lit(rf"{TEXT}|[\w.+-]+"), F.lit(0))
    quoted = F.transform(atoms, lambda t: F.when(_is_text(t), _json_text(t)).otherwise(F.concat(F.lit('"'), t, F.lit('"'))))
    return F.concat(F.lit("["), F.array_join(quoted, ","), F.lit("]"))


FALLBACK_SCHEMA = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("json", T.StringType()),
    T.StructField("flat", T.ArrayType(T.StringType())),
])


def _unicode(s: str) -> str:
    """Surrogate escapes as the character that a pair stands for; a lone one as U+FFFD, as no column can hold it."""
    return s if s.isascii() else s.encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace")


def _to_jsonable(v):
    if isinstance(v, (list, tuple, set, frozenset)):
        return [_to_jsonable(x) for x in v]
    if isinstance(v, dict):
        return {_unicode(k if isinstance(k, str) else str(k)): _to_jsonable(x) for k, x in v.items()}
    if isinstance(v, str):
        return _unicode(v)
    if isinstance(v, (int, float, bool)) or v is None:
        return v
    return str(v)


def _flatten(items) -> list[str]:
    out: list[str] = []
    for item in items:
        if isinstance(item, list):
            out.extend(_flatten(item))
        else:
            out.append(_unicode(item if isinstance(item, str) else str(item)))
    return out


def literal_eval_one(text):
    """Python reading of one cell: (kind, json, flat list) — the fallback's row rule."""
    if text is None:
        return None, None, None
    try:
        value = ast.literal_eval(text)
    except Exception:  # ValueError, SyntaxError, and deep-nesting errors
        return "str", json.dumps(text), None
    kind = type(value).__name__ if isinstance(value, (dict, list, tuple, int, float, bool)) else "other"
    flat = _flatten(value) if isinstance(value, list) else None
    return kind, json.dumps(_to_jsonable(value)), flat


@F.pandas_udf(FALLBACK_SCHEMA)
def _python_literal(s: pd.Series) -> pd.DataFrame:
    rows = [literal_eval_one(t) if isinstance(t, str) else (None, None, None) for t in s]
    return pd.DataFrame(rows, columns=["kind", "json", "flat"])


def _last_value_wins(m: Column) -> Column:
    """A map read from JSON with repeated keys as a dict: first position, last value."""
    keys = F.map_keys(m)
    once = F.array_distinct(keys)
    last = F.transform(once, lambda k: F.element_at(
        F.filter(F.map_entries(m), lambda e: e["key"] == k), -1)["value"])
    return F.when(F.size(once) == F.size(keys), m).otherwise(F.map_from_arrays(once, last))


def _parsed(df: DataFrame, out: str, c: Column, jvm: Column, kind: str, inexact: Column, rewritten_kind: Column,
            rewritten, fallback, defer: bool) -> DataFrame:
    """Add ``out`` and its kind by the three readings in turn; the last one or (``defer``) a mark for it."""
    ix, rk, fb = f"__ix_{out}", f"__rk_{out}", f"__fb_{out}"
    # steps of their own: read by value, kind and mark, computed once a row
    df = df.withColumn(ix, inexact).withColumn(rk, F.when(F.col(ix), rewritten_kind))
    need = F.col(ix) & F.col(rk).isNull()
    value = F.when(F.col(rk).isNotNull(), rewritten(F.col(rk))).when(~need, jvm)
    name = F.coalesce(F.col(rk), F.when(~need & jvm.isNotNull(), F.lit(kind)))
    if defer:
        return df.withColumn(out, value).withColumn(f"{out}_kind", name).withColumn(f"{out}_need", need).drop(ix, rk)
    df = df.withColumn(fb, _python_literal(F.when(need, c)))
    return df.withColumn(out, F.when(need, fallback(F.col(fb))).otherwise(value)) \
        .withColumn(f"{out}_kind", F.when(need, F.col(f"{fb}.kind")).otherwise(name)).drop(fb, ix, rk)


def with_literal(df: DataFrame, src: str, out: str, ddl: str,
                 kinds: tuple[str, ...], defer: bool = False) -> DataFrame:
    """P5: add ``out`` (typed by ``ddl``) and ``out + '_kind'`` (Python type name).

    ``kinds[0]`` is the Python kind a JSON success implies ("dict" for a map,
    "list" for an array); the others are Python kinds also accepted from the
    other readings (e.g. a tuple where only indexing matters).  Rows the JVM
    could not read go through the Arrow fallback; its JSON is re-read with the
    same type.  With ``defer`` they stay null and ``out + '_need'`` is true.
    """
    c = F.col(src)
    js, pl = f"__js_{out}", f"__pl_{out}"
    shape = ddl.replace(" ", "").lower()
    is_map = shape.startswith("map<")
    # Steps of their own: read once, tested and taken.  Plain vote lists need no JSON reader.
    df = df.withColumn(pl, F.coalesce(c.rlike(PLAIN_NUMBERS), F.lit(False)))
    plain, json_read = F.col(pl), F.from_json(c, ddl, LENIENT)
    df = df.withColumn(js, F.when(plain, plain_numbers(c)).otherwise(json_read) if shape == "array<double>" else json_read)
    lenient = F.col(js)
    inexact = c.isNotNull() & (lenient.isNull() | (~plain & (c.rlike(SUSPECT) | ~one_value(c))))
    once = _last_value_wins if is_map else (lambda v: v)
    return _parsed(df, out, c, once(lenient), kinds[0], inexact, literal_kind(c),
                   lambda k: F.when(k.isin(*kinds), once(F.from_json(python_json(c), ddl))),
                   lambda fb: F.when(fb["kind"].isin(*kinds), F.from_json(fb["json"], ddl)), defer).drop(js, pl)


def with_category_list(df: DataFrame, src: str, out: str, defer: bool = False) -> DataFrame:
    """P5 + P18 for category text: nested list, flat list, or Python fallback.

    ``out`` is the flattened ``array<string>``; ``out + '_kind'`` is the Python
    type of the parsed value (only ``list`` yields categories).  ``defer`` as
    in :func:`with_literal`.
    """
    c = F.col(src)
    jn, jf = f"__jn_{out}", f"__jf_{out}"
    df = df.withColumns({jn: F.from_json(c, "array<array<string>>", LENIENT), jf: F.from_json(c, "array<string>", LENIENT)})
    nested, flat = F.col(jn), F.col(jf)
    # A flat read of ragged text stringifies inner lists; reject those.
    flat_ok = flat.isNotNull() & ~F.exists(flat, lambda x: x.startswith("[") | x.startswith("{"))
    # A nested read of deeper text stringifies the innermost lists; reject those too.
    nested_ok = nested.isNotNull() & ~F.exists(F.flatten(nested),
                                                 lambda x: x.startswith("[") | x.startswith("{"))
    jvm = F.when(nested_ok, F.flatten(nested)).when(nested.isNull() & flat_ok, flat)
    inexact = c.isNotNull() & (jvm.isNull() | c.rlike(SUSPECT) | ~one_value(c))
    # A tuple or dict within a list is one category, as Python prints it: only Python does.
    kind = literal_kind(c)
    printed = (kind == "list") & F.regexp_replace(c, TEXT, "").rlike(r"[({]")
    return _parsed(df, out, c, jvm, "list", inexact, F.when(~printed, kind),
                   lambda k: F.when(k == "list", F.from_json(python_leaves(c), "array<string>")),
                   lambda fb: F.when(fb["kind"] == "list", fb["flat"]), defer).drop(jn, jf)


def first_map_entry(m: str | Column) -> Column:
    """First (key, value) of a map in insertion order, or null for an empty map."""
    return F.try_element_at(F.map_entries(col_of(m)), F.lit(1))

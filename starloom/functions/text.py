"""String cleaning as Column expressions (defaults, sanitising, trimming).

Everything here compiles to Catalyst expressions, so it stays inside
whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's for identical output.
# Placeholder text for blank product cells, in column order.
PRODUCT_DEFAULTS = {
    "metadata_id": "*None",
    "source_key": "*None",
    "sales_rank_category": "*Unknown category",
    "sales_rank": -1,
    "image_url": "*Unknown URL",
    "title": "*Unknown title",
    "description": "*Unknown description",
    "price": -1.0,
    "brand": "*Unknown brand",
}
# Placeholder text for blank review cells, in column order.
REVIEW_DEFAULTS = {
    "reviewer_source_key": "*Unknown",
    "product_key": "*None",
    "reviewer_name": "*Unknown username",
    "review_text": "*Unknown review text",
    "review_title": "*Unknown review title",
}
# Sanitising replacements, applied one after another in this order.
SANITIZE_TOKENS = [
    ("=\\ ", "__EQ_BACKSLASH__"),
    ("\\", "__BACKSLASH__"),
    ("'", "__SINGLE_QUOTE__"),
    ('"', "__DOUBLE_QUOTE__"),
    ("\n", "__NEWLINE__"),
    ("\r", "__CARRIAGE_RETURN__"),
    ("\t", "__TAB__"),
]
# End of fixed values.
# ---------------------------------------------------------------------------


def _python_whitespace_class() -> str:
    """Regex class of exactly the characters Python's ``str.isspace`` accepts.

    Built by rule from the running interpreter, written with ``\\x{..}``
    escapes that both Java regex and RE2 understand.
    """
    ranges: list[list[int]] = []
    for cp in range(0x110000):
        if chr(cp).isspace():
            if ranges and ranges[-1][1] == cp - 1:
                ranges[-1][1] = cp
            else:
                ranges.append([cp, cp])
    parts = []
    for lo, hi in ranges:
        parts.append(f"\\x{{{lo:X}}}" if lo == hi else f"\\x{{{lo:X}}}-\\x{{{hi:X}}}")
    return "[" + "".join(parts) + "]"


PY_WS = _python_whitespace_class()

# The same characters for a quick test before the whole class: those below U+0100 one by
# one (Java looks them up in a table), and the range that holds all others.
_LATIN_WS = "[" + "".join(f"\\x{{{cp:X}}}" for cp in range(0x100) if chr(cp).isspace()) + "]"
_WIDE = [cp for cp in range(0x100, 0x110000) if chr(cp).isspace()]
_WIDE_RANGE = f"[\\x{{{_WIDE[0]:X}}}-\\x{{{_WIDE[-1]:X}}}]"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: str | Column) -> Column:
    """Python truthiness of a CSV cell: None or the empty string (not spaces)."""
    c = col_of(c)
    return c.isNull() | (c == F.lit(""))


def default_if_blank(c: str | Column, value) -> Column:
    """Replace a null/empty cell by a per-column sentinel."""
    c = col_of(c)
    return F.when(is_blank(c), F.lit(value)).otherwise(c)


# Signs that few texts hold; the line feed is the common one.
_RARE_SIGN = "[" + "".join(f"\\x{{{ord(sign):X}}}" for sign in "\\'\"\r\t") + "]"
# Whitespace that no token replaces, twice: where it is missing, no run is left to collapse.
_KEPT_WS = "[" + "".join(f"\\x{{{cp:X}}}" for cp in range(0x100) if chr(cp).isspace() and chr(cp) not in "\n\r\t") + "]"


def sanitize_string(c: str | Column, probe: str | Column | None = None) -> Column:
    """Token replacement in fixed order, then runs of 2+ whitespace → one space.

    Most texts have no sign but line feeds and no run, so quick tests on ``probe``
    (``c`` itself, or a column that ``c`` is cut from) spare them the other steps.
    Every token but the first is one character that no replacement holds, so the line
    feed may come last.
    """
    c = col_of(c)
    probe = c if probe is None else col_of(probe)
    rare = c
    for old, new in SANITIZE_TOKENS:
        if old != "\n":
            rare = F.replace(rare, F.lit(old), F.lit(new))
    signs = F.when(probe.rlike(_RARE_SIGN), rare).otherwise(c)
    clean = F.replace(signs, F.lit("\n"), F.lit(dict(SANITIZE_TOKENS)["\n"]))
    runs = probe.rlike(_KEPT_WS + _KEPT_WS) | probe.rlike(_WIDE_RANGE)
    return F.when(runs, F.regexp_replace(clean, PY_WS + "{2,}", " ")).otherwise(clean)


def restore_string(c: str | Column) -> Column:
    """Undo :func:`sanitize_string` token by token (TAB included).

    Collapsed whitespace runs cannot be restored.
    """
    c = col_of(c)
    for old, new in SANITIZE_TOKENS:
        c = F.replace(c, F.lit(new), F.lit(old))
    return c


def py_strip(c: str | Column) -> Column:
    """Python ``str.strip()`` (Unicode whitespace at both ends)."""
    c = col_of(c)
    maybe = c.rlike(f"^{_LATIN_WS}|{_LATIN_WS}$") | c.rlike(_WIDE_RANGE)
    return F.when(maybe, F.regexp_replace(c, f"^{PY_WS}+|{PY_WS}+$", "")).otherwise(c)


def clean_text(c: str | Column, default: str, strip: bool = False) -> Column:
    """Blank → default, else (optionally stripped and) sanitised.

    Mirrors ``sanitize(str(x).strip()) if x else default``: the blank test
    runs before stripping, so all-space input becomes ``''``.
    """
    c = col_of(c)
    body = py_strip(c) if strip else c
    return F.when(is_blank(c), F.lit(default)).otherwise(sanitize_string(body, c))


def pair_key(a: str | Column, b: str | Column) -> tuple[Column, Column]:
    """Canonical unordered pair (least, greatest)."""
    a, b = col_of(a), col_of(b)
    return F.least(a, b), F.greatest(a, b)


def text_hash(*cols: str | Column) -> Column:
    """md5 over one or more text columns, separated so ('ab','c') != ('a','bc')."""
    parts = [F.coalesce(col_of(c), F.lit("")) for c in cols]
    if len(parts) == 1:
        return F.md5(parts[0])
    return F.md5(F.concat_ws("\u0001", *[F.concat(F.length(p).cast("string"), F.lit(":"), p)
                                         for p in parts]))

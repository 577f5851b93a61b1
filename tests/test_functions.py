"""Column functions against plain-Python statements of the same rules."""

import ast
import datetime as dt
import random
import re

from pyspark.sql import functions as F

from starloom.functions import dates as D
from starloom.functions import literals as L
from starloom.functions import numbers as N
from starloom.functions import text as T

WS_CHARS = " \t\n\r\x0b\x0c\x1c\x85\xa0\u2003\u3000"
ALPHABET = "ab=\\'\"" + WS_CHARS


def py_sanitize(value: str) -> str:
    for old, new in T.SANITIZE_TOKENS:
        value = value.replace(old, new)
    return re.sub(r"\s{2,}", " ", value)


def random_texts(n=400, seed=7):
    rnd = random.Random(seed)
    return [("".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 12))),) for _ in range(n)]


def test_sanitize_matches_python(spark):
    data = random_texts() + [('a "b" c\n\td\\e\'',), ("x=\\ y",), ("a   b",), ("",)]
    df = spark.createDataFrame(data, "s string")
    got = {r.s: r.o for r in df.select("s", T.sanitize_string("s").alias("o")).collect()}
    for (s,) in data:
        assert got[s] == py_sanitize(s), repr(s)


def test_fixture_r10_r11_r12(spark):
    df = spark.createDataFrame([('a "b" c\n\td\\e\'',), ("x=\\ y",), ("a   b",)], "s string")
    out = [r.o for r in df.select(T.sanitize_string("s").alias("o")).collect()]
    assert out == ["a __DOUBLE_QUOTE__b__DOUBLE_QUOTE__ c__NEWLINE____TAB__d__BACKSLASH__e__SINGLE_QUOTE__",
                   "x__EQ_BACKSLASH__y", "a b"]


def test_restore_inverts_sanitize_without_runs(spark):
    rnd = random.Random(3)
    alphabet = "ab=\\'\"\n\r\t "
    data = []
    while len(data) < 200:
        s = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 10)))
        if not re.search(r"\s{2,}", py_sanitize(s).replace(" ", " ")) and "  " not in s:
            data.append((s,))
    df = spark.createDataFrame(data, "s string")
    for r in df.select("s", T.restore_string(T.sanitize_string("s")).alias("o")).collect():
        if not re.search(r"\s\s", r.s.replace("\n", "N").replace("\r", "R").replace("\t", "T")):
            assert r.o == r.s, repr(r.s)


def test_clean_text_strip_and_defaults(spark):
    df = spark.createDataFrame([("   ",), ("",), (None,), ("  hi  there ",)], "s string")
    out = [r.o for r in df.select(T.clean_text("s", "*d", strip=True).alias("o")).collect()]
    assert out == ["", "*d", "*d", "hi there"]


def test_py_float_grammar(spark):
    cases = ["1.5", " 2 ", "1_0", "5d", "0x10", "inf", "-Infinity", "nan", "", "abc", ".5", "5.", "1e3",
             "1_e3", "1__0", "+.5e-2", "\u30001.0\u3000", "1.2.3"]

    def py(x):
        try:
            return float(x)
        except ValueError:
            return None
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    got = {r.s: r.o for r in df.select("s", N.py_float("s").alias("o")).collect()}
    for c in cases:
        want = py(c)
        if want is not None and want != want:
            assert got[c] != got[c]
        else:
            assert got[c] == want, repr(c)


def test_epoch_to_timestamp(spark):
    df = spark.createDataFrame([("1381449600",), ("n/a",), ("1.5",), (" -1 ",), ("99999999999999",)], "s string")
    out = [r.o for r in df.select(N.epoch_to_timestamp("s").alias("o")).collect()]
    assert out == [dt.datetime(2013, 10, 11), None, None, dt.datetime(1969, 12, 31, 23, 59, 59), None]


def test_ratio_modes_against_python(spark):
    pairs = [(a, b) for b in range(1, 210) for a in range(0, b + 1, 3)]
    df = spark.createDataFrame(pairs, "a long, b long")
    res = df.select("a", "b", N.ratio_round("a", "b").alias("hu"),
                    N.ratio_round("a", "b", "python").alias("py")).collect()
    from decimal import ROUND_HALF_UP, Decimal
    for r in res:
        exact = (Decimal(r.a) / Decimal(r.b)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert r.hu == float(exact), (r.a, r.b)
        assert r.py == round(r.a / r.b, 2), (r.a, r.b)
    zero = spark.createDataFrame([(0, 0), (3, 0)], "a long, b long")
    assert [r.o for r in zero.select(N.ratio_round("a", "b").alias("o")).collect()] == [None, None]


def test_fixture_r13_ties(spark):
    df = spark.createDataFrame([(1, 8), (3, 8), (1, 200), (3, 200)], "a long, b long")
    out = df.select(N.ratio_round("a", "b").alias("hu"), N.ratio_round("a", "b", "python").alias("py")).collect()
    assert [r.hu for r in out] == [0.13, 0.38, 0.01, 0.02]
    assert [r.py for r in out] == [0.12, 0.38, 0.01, 0.01]


def test_literal_parsing_against_ast(spark):
    cases = ["{'Clothing': 1200}", "{}", "abc", "[1]", "{'A': 1, 'B': 2}", "{'A': 1, 'A': 3}",
             "{\"x\": 5}", "{'a': None}", "{'a\\'b': 2}", "", None]
    df = L.with_literal(spark.createDataFrame([(c,) for c in cases], "s string"), "s", "m", "map<string,int>",
                        ("dict",))
    got = {r.s: (r.m, r.m_kind) for r in df.collect()}
    for c in cases:
        if c is None:
            continue
        try:
            v = ast.literal_eval(c)
        except Exception:
            v = c
        kind = type(v).__name__
        assert got[c][1] == (kind if kind in ("dict", "list", "tuple", "int", "float") else got[c][1]), c
        if isinstance(v, dict) and all(isinstance(x, int) for x in v.values()):
            assert dict(got[c][0]) == v, c


def test_categories_fixture_g11_g13(spark):
    cases = ["[['Clothing, Shoes & Jewelry', 'Girls'], ['Clothing, Shoes & Jewelry', 'Novelty']]",
             "[['Women\\'s', \"Men's\"]]", "('a', 'b')", "[['a'], 'b']", "['a',]", "['a', 'b']", "", None,
             "[[['deep']], 'x']", "[[['a', 'b']]]"]
    df = L.with_category_list(spark.createDataFrame([(c,) for c in cases], "s string"), "s", "c")
    got = {r.s: (r.c, r.c_kind) for r in df.collect()}
    assert got[cases[0]] == (["Clothing, Shoes & Jewelry", "Girls", "Clothing, Shoes & Jewelry", "Novelty"], "list")
    assert got[cases[1]] == (["Women's", "Men's"], "list")
    assert got["('a', 'b')"] == (None, "tuple")
    assert got["[['a'], 'b']"] == (["a", "b"], "list")
    assert got["['a',]"] == (["a"], "list")
    assert got["['a', 'b']"] == (["a", "b"], "list")
    assert got[""][0] is None and got[""][1] != "list"
    assert got["[[['deep']], 'x']"] == (["deep", "x"], "list")
    assert got["[[['a', 'b']]]"] == (["a", "b"], "list")


def test_dates(spark):
    df = spark.createDataFrame([(dt.date(2018, 3, 23),)], "d date")
    parts = D.date_parts("d")
    r = df.select(D.date_key("d").alias("k"), D.date_description("d").alias("t"),
                  parts["day_of_week"].alias("dw"), parts["month_of_year"].alias("m"),
                  parts["quarter"].alias("q")).first()
    assert (r.k, r.t, r.dw, r.m, r.q) == (20180323, "Friday, 23 March 2018", "Friday", "March", 1)
    leap = spark.createDataFrame([(dt.date(2000, 2, 29),)], "d date")
    assert leap.select(D.add_years("d", 1).alias("x")).first().x == dt.date(2001, 2, 28)


def test_literal_with_anything_after_it_is_text(spark):
    """Only whole literals parse: what follows the first value makes the cell text, as in Python."""
    from starloom.functions.literals import with_literal
    cells = ["[2, 3]", "[2, 3] junk", "[2, 3]]", "[2, 3][4]", " [2, 3] ", "['a]', 'b'] x"]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    got = {r.c: r.v_kind for r in with_literal(df, "c", "v", "array<string>", ("list",)).collect()}
    assert got["[2, 3]"] == "list"
    assert all(got[c] == "str" for c in ("[2, 3] junk", "[2, 3]]", "['a]', 'b'] x"))
    assert got["[2, 3][4]"] == "str"
    maps = with_literal(spark.createDataFrame([("{'a': 1} x",), ("{'a': 1}",)], "c string"), "c", "v", "map<string,int>", ("dict",))
    assert {r.c: r.v_kind for r in maps.collect()} == {"{'a': 1} x": "str", "{'a': 1}": "dict"}


LITERAL_CASES = [
    "{'a': None}", "{'a': 1, 'a': None}", "{'a': 3,}", "{'a\\'b': 2}", "{'a\"b': 2, \"c'd\": 4}", "{'t\\\\': 1}", "{'t\\\\\\'': 1}",
    "{'\\x41\\u00e9\\n': 7}", "{'a\tb': 1}", "{'a': True}", "{'a': 'x'}", "{'a': (1, 2)}", "{1: 2}", "{'a' 'b': 1}", "{'a': 1} x",
    "(1, 2)", "(1,)", "(1)", "()", "[]", "[1, 2,]", "[1,, 2]", "[,]", "[1 2]", "[- 1, -2]", "[01, 2]", "[1.50, 2]", "[0.5, 3]", "[1e3, 2]",
    "[1_0, 2]", "{1, 2}", "[None, 2]", "[True, False]", "['a', None, True, 1, -2, 0.25]", "[['a'], ('b', 'c')]", "[{'k': 1}, 'x']",
    "('a', 'b')", "[['a', ['b', ['c']]], 'd']", "[[[[['deep']]]]]", "['a\\q']", "['a\\", "['''a''']", "['a''b']", "[u'a', 'b']", "[b'a']",
    "['it\\'s', \"a \\\"b\\\"\"]", "['x, None), (', 'y,]']", "['None', 'a,)']", "[\n'a']", "['a\nb']", "[q]", "['a', q]", "None", "True",
    "Books", "not None", "abc def", "  ", "", " [1, 2]", "\t['a',]", "[1, 2] ", "['a'] # c", "[' é']", "[\x01]", "['\\ud83d\\ude00']", "['\\ud83d',]", "{'\\ud83d': 1}",
    "{'also_bought': ['a', 'b',], 'x': None}", "{'k': [['a', 'b'], None, 2]}", "{'k': ['\\xe9\\\\', '\\'']}", "{'a': {'b': 1}}", "[1,2]]",
    "['" + "long \\' text " * 3000 + "',]", "[" + "1, " * 5000 + "]", "word " * 3000,
]


def random_literals(n=600, seed=11):
    """Texts near the grammar of literals: random ones, some with a character changed."""
    rnd = random.Random(seed)

    def value(depth, kinds="stnwlLpd"):
        kind = rnd.choice("stnw" if depth == 0 else kinds)
        if kind in "st":
            body = "".join(rnd.choice(["a", "b ", ",", "(", "]", "\\\\", "\\'", "\\\"", "\\n", "\\x41", "é", "None", "1"])
                           for _ in range(rnd.randint(0, 4)))
            return f"'{body}'" if kind == "s" else f'"{body}"'
        if kind == "n":
            return rnd.choice(["0", "1", "-7", "12", "1.5", "0.25", "-0.5", "00", "1.0", "2.50"])
        if kind == "w":
            return rnd.choice(["None", "True", "False"])
        items = [value(depth - 1) for _ in range(rnd.randint(0, 3))]
        if kind == "d":
            return "{" + ", ".join(f"'k{i % 2}': {v}" for i, v in enumerate(items)) + rnd.choice(["", "," if items else ""]) + "}"
        left, right = "()" if kind == "p" else "[]"
        return left + rnd.choice([", ", ",", " , "]).join(items) + rnd.choice(["", "," if items else ""]) + right

    out = []
    for _ in range(n):
        text = value(3, "lLpd")
        if text and rnd.random() < 0.3:
            at = rnd.randrange(len(text))
            text = text[:at] + rnd.choice(["", ",", "'", "\\", "]", " "]) + text[at + 1:]
        out.append(text)
    return out


def test_rewritten_literals_equal_python(spark):
    """Both readings give what ``ast.literal_eval`` gives; a deferred cell is marked, never guessed."""
    import json
    cases = list(dict.fromkeys([*LITERAL_CASES, *random_literals()]))
    df = spark.createDataFrame(list(enumerate(cases)), "i int, s string").repartition(4)
    decided = {r.i: (r.k, r.j, r.leaves) for r in df.select(
        "i", L.literal_kind(F.col("s")).alias("k"), L.python_json(F.col("s")).alias("j"), L.python_leaves(F.col("s")).alias("leaves")).collect()}
    read = 0
    for i, text in enumerate(cases):
        kind, as_json, flat = L.literal_eval_one(text)
        got, got_json, leaves = decided[i]
        if got is None:
            continue
        read += 1
        assert got == kind, text[:80]
        if kind != "str":
            assert json.loads(got_json) == json.loads(as_json), text[:80]
        if kind == "list" and "(" not in text and "{" not in text:
            assert json.loads(leaves) == flat, text[:80]
    assert read > len(cases) / 3
    for add, ddl, kinds in ((L.with_literal, "map<string,int>", ("dict",)), (L.with_literal, "array<double>", ("list", "tuple")),
                            (L.with_literal, "map<string,array<string>>", ("dict",)), (L.with_category_list, None, None)):
        args = [ddl, kinds] if ddl else []
        inline = {r.i: (r.v, r.v_kind) for r in add(df, "s", "v", *args).collect()}
        marked = {r.i: (r.v, r.v_kind, r.v_need) for r in add(df, "s", "v", *args, defer=True).collect()}
        for i, text in enumerate(cases):
            v, k, need = marked[i]
            assert (v, k) == ((None, None) if need else inline[i]), text[:80]
            _, as_json, flat = L.literal_eval_one(text)
            if add is L.with_category_list and inline[i][1] == "list":
                assert inline[i][0] == flat, text[:80]


def test_python_shapes_stay_on_the_jvm(spark):
    cases = ["{'a': None}", "(1, 2)", "[1, 2,]", "['a\\'s', None, True]", "[['a'], 'b',]", "Books", ""]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    assert not [r.s for r in L.with_literal(df, "s", "v", "array<string>", ("list", "tuple"), defer=True).collect() if r.v_need]
    assert not [r.s for r in L.with_category_list(df, "s", "v", defer=True).collect() if r.v_need]


def test_quick_tests_leave_the_results(spark):
    """Cells on either side of the quick tests: rare signs, runs of every kind of whitespace, numbers beyond plain digits."""
    spaces = [chr(cp) for cp in range(0x3001) if chr(cp).isspace()]
    texts = [f"a{x}{y}b{x}" for x in spaces for y in (" ", "\u3000", "\n", "\\", "=\\ ", "\u2019")] + ["\n \t", "=\\ \n", "\u2019x", "x\x85"]
    rows = spark.createDataFrame([(t,) for t in texts], "s string").select(
        "s", T.sanitize_string("s").alias("o"), T.py_strip("s").alias("t"), T.clean_text("s", "*d", strip=True).alias("c")).collect()
    for r in rows:
        assert (r.o, r.t, r.c) == (py_sanitize(r.s), r.s.strip(), py_sanitize(r.s.strip())), repr(r.s)
    numbers = ["12", "12\n", "007", "9" * 18, "9" * 19, "1_0", "12.", "12.50", "1" * 15 + ".5", "1" * 16 + ".5", "12.5\n", "1.2.3", "\u0663"]
    df = spark.createDataFrame([(n,) for n in numbers], "s string").select("s", N.py_float("s").alias("f"), N.py_int("s").alias("i"))
    for r in df.collect():
        plain = r.s.isascii()
        as_float = float(r.s) if plain and r.s.count(".") < 2 else None
        as_int = int(r.s) if plain and "." not in r.s and len(r.s) < 19 else None
        assert (r.f, r.i) == (as_float, as_int), repr(r.s)


def test_plain_cells_skip_the_costly_steps(spark):
    """Plain text, votes and numbers pass by tests on tables or ranges, without the whole whitespace class or the grammar of literals."""
    df = spark.createDataFrame([("a",)], "s string")
    plan = df.select(T.sanitize_string("s"), N.py_int("s"))._jdf.queryExecution().analyzed().toString()
    assert T._KEPT_WS in plan and N.PLAIN_INT in plan
    plan = L.with_literal(df, "s", "o", "array<double>", ("list",), True)._jdf.queryExecution().analyzed().toString()
    assert L.PLAIN_NUMBERS in plan


def test_plain_votes_are_read_without_json(spark):
    """Plain vote lists give Python's numbers by a split alone; cells beside that shape keep their reading."""
    import json
    rnd = random.Random(5)
    plain = ["[0]", "[0, 0]", "[2,3]", "[999999999, 1,20]", *(str([rnd.randint(0, 10 ** 9 - 1) for _ in range(rnd.randint(1, 4))]) for _ in range(40))]
    beside = ["[]", "[01, 2]", "[1,  2]", "[1, 2]\n", "[1 2]", "[1, 2,]", "(1, 2)", "[1000000000, 2]", "[-1, 2]", "[1.5, 2]", "[None, 2]", "1, 2", ""]
    cells = spark.createDataFrame([(c,) for c in plain + beside], "s string")
    assert [r.v for r in cells.filter(F.col("s").rlike(L.PLAIN_NUMBERS)).select(L.plain_numbers(F.col("s")).alias("v")).collect()] \
        == [[float(x) for x in ast.literal_eval(c)] for c in plain]
    votes = L.with_literal(cells, "s", "v", "array<double>", ("list", "tuple"))
    got = {r.s: (r.v, r.v_kind) for r in votes.collect()}
    for c in plain + beside:
        kind, as_json, _ = L.literal_eval_one(c)
        numbers = [None if x is None else float(x) for x in json.loads(as_json)] if kind in ("list", "tuple") else None
        assert got[c] == (numbers, kind), c
    plan = votes.select("v")._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" in plan

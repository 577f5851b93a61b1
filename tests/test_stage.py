"""Stage 1 and stage 2 on the hand-made rows of FIXTURES.md."""

import datetime as dt

from pyspark.sql import functions as F

from starloom.session import materialize
from starloom.operators import stage as St
from starloom.operators import validate as V
from starloom.operators.keys import not_null_key

REVIEW_COLS = ["_c0", "reviewerID", "asin", "reviewerName", "helpful", "reviewText", "overall", "summary",
               "unixReviewTime"]


def review(i, **kw):
    base = dict(_c0=str(i), reviewerID="A1", asin="B000000001", reviewerName="Ann", helpful="[2, 3]",
                reviewText="good", overall="5.0", summary="Nice", unixReviewTime="1381449600")
    base.update(kw)
    return tuple(base[c] for c in REVIEW_COLS)


def classify_reviews(spark, rows):
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in REVIEW_COLS))
    return {r["_c0"]: r for r in St.classify_reviews(df).withColumn(
        "_c0", F.get_json_object("_source_row", "$._c0")).collect()}


def test_review_fixtures(spark):
    rows = [
        review(1),                                              # R1
        review(2, helpful="[0, 0]"),                            # R2
        review(3, reviewerID="A" * 22),                         # R3
        review(4, asin="B" * 11, overall="abc"),                # R4
        review(5, overall="abc"), review(51, overall=""),       # R5
        review(6, helpful="x"), review(61, helpful=""), review(62, helpful="[1]"),
        review(63, helpful="['a', 'b']"),                       # R6
        review(7, unixReviewTime="n/a"),                        # R7
        review(8, reviewerName="", reviewText="", summary=""),  # R8
        review(9, summary="   "),                               # R9
    ]
    out = classify_reviews(spark, rows)
    acc = St.classify_reviews(spark.createDataFrame([review(1), review(2, helpful="[0, 0]", reviewText="zero"),
                                                     review(8, reviewerName="", reviewText="", summary=""),
                                                     review(9, summary="   ")],
                                                    ", ".join(f"{c} string" for c in REVIEW_COLS)))
    accepted = {r.r_review_text + "|" + r.r_review_title: r for r in acc.collect()}
    r1 = [r for r in acc.collect() if r.r_helpfulness_rating == 0.67][0]
    assert r1.r_review_score == 5.0 and r1.r_review_datetime == dt.datetime(2013, 10, 11)
    assert accepted["zero|Nice"].r_helpfulness_rating is None and accepted["zero|Nice"].reject_reason is None
    assert out["3"][V.REASON] == "reviewer_id too long"
    assert out["4"][V.REASON] == "product_key too long"
    assert out["5"][V.REASON] == out["51"][V.REASON] == "Invalid review score"
    for k in ("6", "61", "62", "63"):
        assert out[k][V.REASON] == "Invalid helpful rating", k
    assert out["7"][V.REASON] == "Invalid review date time rating"
    assert "*Unknown review text|*Unknown review title" in accepted
    r8 = accepted["*Unknown review text|*Unknown review title"]
    assert r8.r_reviewer_name == "*Unknown username"
    assert "good|" in accepted  # R9: blank title stripped to ''


def test_reviews_accept_plus_reject_is_input(spark):
    rows = [review(i, overall=("x" if i % 3 == 0 else "4.0")) for i in range(30)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in REVIEW_COLS))
    ok, bad = St.review_outputs(St.classify_reviews(df))
    assert ok.count() + bad.count() == 30 and bad.count() == 10


PRODUCT_COLS = ["metadataid", "asin", "salesrank", "imurl", "categories", "title", "description", "price",
                "related", "brand"]


def product(**kw):
    base = dict(metadataid="M1", asin="P1", salesrank="{'Clothing': 1200}", imurl="http://x",
                categories="[['Clothing, Shoes & Jewelry', 'Girls'], ['Clothing, Shoes & Jewelry', 'Novelty']]",
                title="T", description="D", price="9.5",
                related="{'also_bought': ['B1', 'B2'], 'bought_together': ['B1']}", brand="Br")
    base.update(kw)
    return tuple(base[c] for c in PRODUCT_COLS)


def outputs(spark, rows):
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in PRODUCT_COLS))
    return St.product_outputs(St.classify_products(df))


def test_product_fixture_g1(spark):
    po = outputs(spark, [product()])
    p = po.products.first()
    assert (p.p_sales_rank_category, p.p_sales_rank) == ("Clothing", 1200)
    assert po.categories.count() == 4 and po.categories.distinct().count() == 3
    assert po.related.count() == 3
    assert po.rejects.count() == 0


def test_product_fixtures_rejects(spark):
    rows = [
        product(asin="P2", salesrank="", imurl="", categories="", title="", description="", price="",
                related="", brand=""),                                             # G2
        product(asin="P3", metadataid="M" * 8),                                   # G3
        product(asin="P4", metadataid="M" * 8, price="abc"),                      # G4
        product(asin="P5", imurl="u" * 226, brand="b" * 151),                     # G5
        product(asin="P6", categories="[['" + "c" * 151 + "', 'ok1', 'ok2']]"),   # G6
        product(asin="P7", related="{'also_bought': ['" + "k" * 11 + "', 'B9']}"),  # G7
        product(asin="P8", related=""),                                           # G8
    ]
    po = outputs(spark, rows)
    prods = {r.p_product_source_key: r for r in po.products.collect()}
    assert prods["P2"].p_price == -1.0 and prods["P2"].p_title == "*Unknown title"
    assert prods["P2"].p_sales_rank == -1 and prods["P2"].p_image_url == "*Unknown URL"
    rej = [(r.entity, r.reason) for r in po.rejects.collect()]
    assert ("s1_product_category", "invalid categories format") in rej
    assert ("s1_product", "product_metadata_id too long") in rej
    assert ("s1_product", "invalid price") in rej
    assert ("s1_product", "image_url too long") in rej
    assert ("s1_product_category", "category too long") in rej
    assert ("s1_related_products", "related product fields too long") in rej
    assert {"P3", "P4", "P5"}.isdisjoint(prods)
    cats = po.categories.filter("pc_product_source_key = 'P6'").count()
    assert cats == 2
    assert po.related.filter("rl_product_source_key = 'P7'").count() == 1
    assert po.related.filter("rl_product_source_key = 'P8'").count() == 0
    assert po.categories.filter("pc_product_source_key = 'P8'").count() == 4
    assert po.related.filter("rl_product_source_key = 'P2'").count() == 0


def test_salesrank_forms_g9_g10(spark):
    rows = [product(asin=f"S{i}", salesrank=s) for i, s in enumerate(["{}", "", "abc", "[1]", "{'A': 1, 'B': 2}"])]
    prods = {r.p_product_source_key: (r.p_sales_rank_category, r.p_sales_rank)
             for r in outputs(spark, rows).products.collect()}
    assert prods == {"S0": ("*Unknown category", -1), "S1": ("*Unknown category", -1),
                     "S2": ("*Unknown category", -1), "S3": ("*Unknown category", -1), "S4": ("A", 1)}


def test_malformed_rows_are_first_reason(spark):
    df = spark.createDataFrame([review(1) + ("x,y",), review(2) + (None,)],
                               ", ".join(f"{c} string" for c in REVIEW_COLS) + ", _corrupt_record string")
    out = {r.reject_reason for r in St.classify_reviews(df).collect()}
    assert out == {None, "malformed record"}


def test_related_dedup_table(spark):
    edges = [("A", "B", "also_bought"), ("B", "A", "also_viewed"), ("A", "D", "x"), ("D", "A", "x"),
             ("C", "D", "x"), ("C", "D", "x"), ("E", "E", "x"), ("A", "C", "x")]
    df = spark.createDataFrame(edges, "rl_product_source_key string, rl_related_product_source_key string, "
                                      "rl_relation string")
    lit = {tuple(r) for r in St.stage2_related(df, "literal").collect()}
    assert lit == {("C", "D", "x"), ("A", "C", "x")}
    can = {tuple(r) for r in St.stage2_related(df, "canonical").collect()}
    assert can == {("A", "B", "also_bought"), ("A", "B", "also_viewed"), ("A", "D", "x"), ("C", "D", "x"),
                   ("E", "E", "x"), ("A", "C", "x")}


def test_late_arriving_and_duplicates(spark):
    pcols = ", ".join(f"{c} string" if c not in ("p_sales_rank", "p_price") else
                      (f"{c} int" if c == "p_sales_rank" else f"{c} double") for c in St.S2_PRODUCT_COLUMNS)
    products = spark.createDataFrame([("M", "A", "c", 1, "u", "t", "d", 1.0, "b"),
                                      ("M", "B", "c", 1, "u", "t", "d", 1.0, "b")], pcols)
    reviews = spark.createDataFrame(
        [("R1", "A", "n", 0.5, "t1", 5.0, "x", dt.datetime(2020, 1, 1)),
         ("R1", "A", "n", 0.5, "t2", 4.0, "x", dt.datetime(2020, 1, 2)),
         ("R2", "C", "n", 0.5, "t", 5.0, "x", dt.datetime(2020, 1, 1))],
        "r_reviewer_source_key string, r_product_key string, r_reviewer_name string, r_helpfulness_rating double, "
        "r_review_text string, r_review_score double, r_review_title string, r_review_datetime timestamp_ntz")
    cats = spark.createDataFrame([("A", "x")], "pc_product_source_key string, pc_category string")
    rel = spark.createDataFrame([("A", "D", "r")], "rl_product_source_key string, rl_related_product_source_key "
                                                   "string, rl_relation string")
    s2 = St.dedup_stage(products, reviews, cats, rel)
    ph = {r.p_product_source_key: r for r in s2.placeholders.collect()}
    assert set(ph) == {"C", "D"}
    assert ph["C"].p_product_metadata_id == "*None" and ph["C"].p_sales_rank_category == "*Unknown category"
    assert ph["C"].p_price == -1.0 and ph["C"].p_sales_rank == -1
    r = {(x.r_reviewer_source_key, x.r_product_key): x.r_review_text for x in s2.reviews.collect()}
    assert r[("R1", "A")] == "t2"   # newest wins (K1)
    assert s2.rejects.count() == 1


def test_deferred_python_fallback_equals_inline(spark):
    helpfuls = ["[2, 3]", "(2, 3)", "[None, 0]", "[1, 8]", "x", "[0, 0]", "(1,)", "[null, 2]", "[1, 2,]",
                "[1_0, 20]", "{2, 3}", "[1.50, 2]"]
    rows = [review(i, helpful=h) for i, h in enumerate(helpfuls)]
    rows += [review(100, reviewerID="A" * 22, helpful="(2, 3)"), review(101, unixReviewTime="n/a", helpful="(4, 5)")]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in REVIEW_COLS))
    cols = [*St.S1_REVIEW_COLUMNS, V.REASON, "_source_row"]
    inline = St.classify_reviews(df).select(*cols)
    deferred = St.classify_reviews(df, python_fallback="defer")
    # only cells that no JVM rule settles go to Python
    assert {r._helpful_src for r in deferred.filter("_pending").collect()} == {"[null, 2]", "[1_0, 20]", "{2, 3}"}
    finished = (deferred.filter(~F.col("_pending")).unionByName(St.resolve_pending_reviews(deferred))
                .select(*cols))
    key = lambda r: str(tuple(r))
    assert sorted(map(key, inline.collect())) == sorted(map(key, finished.collect()))


def test_deferred_products_equal_inline_ones(spark):
    """The JVM pass plus the pending rows' Python pass give the rows and rejects of the inline form."""
    cells = [product(), product(salesrank="{'a': None}"), product(categories="[('x', 'y')]"),
             product(categories="{'x': 1}"), product(related="{'also_bought': ['B1', 'B2',]}"),
             product(related="{'also_bought': ['" + "9" * 11 + "']}"), product(categories="[['" + "c" * 151 + "', \\'d\\']]"),
             product(categories="[['" + "c" * 151 + "']]"), product(price="n/a", related="('a',)"),
             product(categories="[['a', ('b', 'c')]]"), product(salesrank="{'a': 1_0}"), product(salesrank=None, related=None)]
    raw = spark.createDataFrame([(str(i), *c[1:]) for i, c in enumerate(cells)],
                                ", ".join(f"{c} string" for c in St.PRODUCT_SOURCE_COLUMNS))
    inline = St.classify_products(raw)
    jvm = St.classify_products(raw, python_fallback="defer")
    first = materialize(jvm)  # written between the passes, as the pipeline does
    both = first.filter("not _pending").unionByName(St.resolve_pending_products(first)).drop("_pending")

    def rows(df):
        return sorted(str(r) for r in df.collect())
    assert not first.filter("_pending").isEmpty() and not first.filter("not _pending").isEmpty()
    assert rows(both) == rows(inline)
    assert "ArrowEvalPython" not in jvm._jdf.queryExecution().executedPlan().toString()
    for a, b in zip(St.product_outputs(inline), St.product_outputs(both)):
        assert rows(a) == rows(b)
    # only rows that a reject cites keep their source
    rejects = {r.row for r in St.product_outputs(inline).rejects.collect()}
    assert {r[0] for r in inline.filter("_source_row is not null").select("_source_row").collect()} == rejects
    assert inline.filter("_source_row is null").count() > 0


def test_missing_keys_are_quarantined(spark):
    """A null in any key column is a reject with its own reason; the others keep their rows."""
    df = spark.createDataFrame([("a", "x", 1), (None, "x", 2), ("a", None, 3), (None, None, 4)], "k string, l string, n int")
    kept, bad = not_null_key(df, ["k", "l"])
    assert [r.n for r in kept.collect()] == [1]
    assert sorted((r.n, r.reject_reason) for r in bad.collect()) == [(n, "missing key") for n in (2, 3, 4)]

"""The whole load as one composition of the library's operators.

``build_warehouse`` goes from raw source rows to the star schema as
composed DataFrames, stored where a frame has several consumers (classified
sources, stage-2 tables, resolved facts) and inside surrogate-key assignment;
each table is computed when it is first asked for.  :mod:`starloom.plans.pipeline`
runs the same steps with every table written to storage and audited.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import bridge as B
from ..operators import dims as Dm
from ..operators import fact as Fa
from ..operators import stage as St
from ..session import compiled_methods, materialize

PRODUCT_KEY = "product_source_key"
# s2 column → product dimension column
PRODUCT_ATTRS = {
    "p_product_metadata_id": "product_metadata_id",
    "p_sales_rank_category": "sales_rank_category",
    "p_sales_rank": "sales_rank",
    "p_image_url": "product_image_url",
    "p_title": "product_title",
    "p_description": "product_description",
    "p_price": "price",
    "p_brand": "brand",
}
PRODUCT_DIM_COLUMNS = ["product_key", PRODUCT_KEY, *PRODUCT_ATTRS.values(), "effective_date",
                       "expiration_date", "is_current"]
PRODUCT_DIM_DDL = ("product_key long, product_source_key string, product_metadata_id string, sales_rank_category string, "
                   "sales_rank int, product_image_url string, product_title string, product_description string, price double, "
                   "brand string, effective_date timestamp_ntz, expiration_date timestamp_ntz, is_current boolean")


def product_snapshot(s2_products: DataFrame) -> DataFrame:
    """Stage-2 product rows renamed to the product dimension's columns."""
    return s2_products.select(F.col("p_product_source_key").alias(PRODUCT_KEY),
                              *[F.col(s).alias(t) for s, t in PRODUCT_ATTRS.items()])


def reviewer_rows(s2_reviews: DataFrame) -> DataFrame:
    return s2_reviews.select(F.col("r_reviewer_source_key").alias("reviewer_source_key"),
                             F.col("r_reviewer_name").alias("reviewer_name"),
                             F.col("r_review_datetime").alias("review_datetime"))


def _finished(classified: DataFrame, resolve) -> DataFrame:
    """A deferred classification, written once; only rows with a cell that only Python reads take a second pass."""
    with compiled_methods(classified.sparkSession):
        rows = materialize(classified)
    done = rows.filter(~F.col("_pending"))
    if not rows.filter("_pending").isEmpty():
        done = done.unionByName(materialize(resolve(rows)))
    return done.drop("_pending", "_helpful_src")


def classified_reviews(raw: DataFrame, ratio_mode: str = "half_up", rejects: bool = False) -> DataFrame:
    """Classified reviews, stored.  The accepted rows carry the review, with ``rejects`` only the others carry their source."""
    rows = St.classify_reviews(raw, ratio_mode, python_fallback="defer")
    unused = ["r_reviewer_name", "r_review_text", "r_review_title"] if rejects else ["_source_row"]
    rows = rows.withColumns({c: F.lit(None).cast("string") for c in unused})
    return _finished(rows, lambda d: St.resolve_pending_reviews(d, ratio_mode))


def classified_products(raw: DataFrame) -> DataFrame:
    """Classified products, stored.  A product's cells are costly to parse, and small files many products: rows are dealt first."""
    dealt = raw.repartition(3 * raw.sparkSession.sparkContext.defaultParallelism)
    return _finished(St.classify_products(dealt, python_fallback="defer"), St.resolve_pending_products)


class Stage1:
    """Stage-1 tables; each source is classified once (stored) when a table of it is first asked for."""

    def __init__(self, raw_reviews: DataFrame, raw_products: DataFrame, ratio_mode: str = "half_up"):
        self.raw_reviews, self.raw_products, self.ratio_mode = raw_reviews, raw_products, ratio_mode

    @cached_property
    def reviews(self) -> DataFrame:
        return St.review_outputs(classified_reviews(self.raw_reviews, self.ratio_mode))[0]

    @cached_property
    def _product_outputs(self) -> St.ProductOutputs:
        return St.product_outputs(classified_products(self.raw_products))

    @property
    def products(self) -> DataFrame:
        return self._product_outputs.products

    @property
    def categories(self) -> DataFrame:
        return self._product_outputs.categories

    @property
    def related(self) -> DataFrame:
        return self._product_outputs.related

    @cached_property
    def rejects(self) -> DataFrame:
        reviews = classified_reviews(self.raw_reviews, self.ratio_mode, rejects=True)
        return St.review_outputs(reviews)[1].unionByName(self._product_outputs.rejects)


class Stage2:
    """The tables of :func:`~starloom.operators.stage.dedup_stage`, each computed when first asked for."""

    def __init__(self, stage1: Stage1, related_mode: str = "literal"):
        self.stage1, self.related_mode = stage1, related_mode

    @cached_property
    def reviews(self) -> DataFrame:
        return St.stage2_reviews(self.stage1.reviews)[0]

    @cached_property
    def categories(self) -> DataFrame:
        return materialize(St.stage2_categories(self.stage1.categories))

    @cached_property
    def related(self) -> DataFrame:
        return materialize(St.stage2_related(self.stage1.related, self.related_mode))

    @cached_property
    def _members(self) -> tuple[DataFrame, DataFrame]:
        return St.stage2_members(St.stage2_products(self.stage1.products)[0], self.reviews, self.categories, self.related)

    @cached_property
    def products(self) -> DataFrame:
        return materialize(self._members[0])

    @property
    def placeholders(self) -> DataFrame:
        return self._members[1]


class Warehouse:
    """The star schema as composed DataFrames; a query pays for the tables it reads.

    Stored on the way are the classified sources, the product stage, the keys and the
    resolved facts.  Reviews are filtered as they are read: their texts are written
    once, in stage 1.
    """

    def __init__(self, stage1: Stage1, stage2: Stage2, as_of: str, date_dim: DataFrame | None = None):
        self.stage1, self.stage2, self.as_of, self.date_dim = stage1, stage2, as_of, date_dim

    @cached_property
    def date(self) -> DataFrame:
        return self.date_dim if self.date_dim is not None else materialize(Dm.date_dim_covering(self.stage2.reviews, "r_review_datetime"))

    @cached_property
    def reviewer(self) -> DataFrame:
        return Dm.scd1_upsert(None, reviewer_rows(self.stage2.reviews))[0]

    @cached_property
    def product(self) -> DataFrame:
        return Dm.scd2_merge(None, product_snapshot(self.stage2.products), PRODUCT_KEY, list(PRODUCT_ATTRS.values()), self.as_of)[0]

    @cached_property
    def category(self) -> DataFrame:
        return Dm.load_category(None, self.stage2.categories.select(F.col("pc_category").alias("product_category")))[0]

    @cached_property
    def _bridge(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return B.load_bridge(self.stage2.categories, self.product, self.category)

    @property
    def bridge(self) -> DataFrame:
        return self._bridge[0]

    @cached_property
    def _junk(self) -> tuple[DataFrame, DataFrame]:
        return Dm.new_descriptors(self.stage2.reviews.select(F.col("r_review_text").alias("review_text"),
                                                             F.col("r_review_title").alias("review_title")), None, 0)

    @property
    def junk(self) -> DataFrame:
        """Review descriptors with their texts."""
        return self._junk[1]

    @property
    def junk_keys(self) -> DataFrame:
        """Keys of the descriptors by hash and digest, without texts."""
        return self._junk[0]

    @cached_property
    def _related(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return B.load_related(self.stage2.related, self.product)

    @property
    def related(self) -> DataFrame:
        return self._related[0]

    @cached_property
    def _fact(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return Fa.load_fact(St.review_view(self.stage2.reviews), self.reviewer, self.product, self.junk_keys, self.date)

    @property
    def fact(self) -> DataFrame:
        return self._fact[0]

    @property
    def quarantine(self) -> DataFrame:
        fq, bq, rq = self._fact[1], self._bridge[2], self._related[2]
        return (fq.select(F.lit("review_fact").alias("entity"), F.col("reject_reason").alias("reason"),
                          F.to_json(F.struct("r_reviewer_source_key", "r_product_key",
                                             "date_reviewed_key")).alias("row"))
                .unionByName(bq.select(F.lit("product_category_bridge").alias("entity"),
                                       F.col("reject_reason").alias("reason"),
                                       F.to_json(F.struct("src", "category")).alias("row")))
                .unionByName(rq.select(F.lit("related_product").alias("entity"),
                                       F.col("reject_reason").alias("reason"),
                                       F.to_json(F.struct("src", "dst", "relation")).alias("row"))))


def build_stage1(raw_reviews: DataFrame, raw_products: DataFrame, ratio_mode: str = "half_up") -> Stage1:
    return Stage1(raw_reviews, raw_products, ratio_mode)


def build_warehouse(raw_reviews: DataFrame, raw_products: DataFrame, as_of: str,
                    date_dim: DataFrame | None = None, ratio_mode: str = "half_up",
                    related_mode: str = "literal") -> Warehouse:
    s1 = build_stage1(raw_reviews, raw_products, ratio_mode)
    return Warehouse(s1, Stage2(s1, related_mode), as_of, date_dim)

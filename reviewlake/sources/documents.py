"""Read nested product documents and stage tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from reviewlake.config import Settings
from reviewlake.operators.placement import as_list

_REVIEW = T.StructType(
    [
        T.StructField("reviewText", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("rating", T.IntegerType()),
        T.StructField(
            "contextDataValues",
            T.StructType([T.StructField("age", T.StructType([T.StructField("value", T.StringType())]))]),
        ),
    ]
)
_DETAIL = T.StructType(
    [
        T.StructField("pid", T.StringType()),
        T.StructField("brandName", T.StringType()),
        T.StructField("name", T.StringType()),
    ]
)
_PAGING = T.StructType(
    [
        T.StructField("totalItems", T.IntegerType()),
        T.StructField("byPage", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
    ]
)

# Objects keyed by id are maps. Inference would turn every id into a field of its own.
PRODUCT_DOC = T.StructType(
    [
        T.StructField(
            "products",
            T.StructType(
                [
                    T.StructField("reviewsById", T.MapType(T.StringType(), _REVIEW)),
                    T.StructField("detailsByPid", T.MapType(T.StringType(), _DETAIL)),
                    T.StructField("reviewsByPid", T.MapType(T.StringType(), T.ArrayType(_PAGING))),
                ]
            ),
        )
    ]
)


def limit_documents(docs: DataFrame, limit: int | None, order_by: str | list[str] | None = None) -> DataFrame:
    """The first ``limit`` product documents (not reviews); ordered when columns are given."""
    if limit is None:
        return docs
    return (docs.orderBy(*as_list(order_by)) if order_by else docs).limit(limit)


def read_documents(
    spark: SparkSession,
    path: str | None = None,
    format: str = "json",
    schema: T.StructType = PRODUCT_DOC,
    options: dict[str, str] | None = None,
    limit: int | None = None,
    order_by: str | list[str] | None = None,
) -> DataFrame:
    """Product documents from files, or from any connector on the classpath (``format`` plus ``options``)."""
    reader = spark.read.schema(schema).format(format).options(**(options or {}))
    return limit_documents(reader.load(path) if path else reader.load(), limit, order_by)


def read_stage(spark: SparkSession, stage: str, settings: Settings) -> DataFrame:
    return spark.table(settings.table(stage))

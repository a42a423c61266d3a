"""Landed answers of the product service."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, NumericType, StringType, StructField, StructType

from shelfmark.schemas import PRODUCT_ELEMENT, payload_of
from shelfmark.sources.files import CORRUPT


def answered_element(
    spark: SparkSession, path: str, whole_files: bool = False, known: StructType = PRODUCT_ELEMENT
) -> StructType:
    """The fields of a product as the landed answers have them.

    The ``known`` ones come first and keep their declared types; all others have
    the types found. One extra pass over the answers.
    """
    found = spark.read.json(path, multiLine=whole_files).schema
    products = found["products"].dataType if "products" in found.names else None
    if not isinstance(products, ArrayType) or not isinstance(products.elementType, StructType):
        return known
    more = [f for f in products.elementType if f.name not in known.names]
    return StructType([*known, *more])


def exploded_products(
    payloads: DataFrame, column: str = "value", element: StructType = PRODUCT_ELEMENT
) -> DataFrame:
    """One row per element of the ``products`` list in a JSON text column.

    Nested fields of ``element`` keep their types. A number that does not fit
    its type becomes NULL, and the element is kept in ``_corrupt_record`` to be
    counted. A payload that is no JSON, or has no list, fails the job: a broken
    answer must not pass as an empty one.
    """
    numbers = [f for f in element if isinstance(f.dataType, NumericType)]
    as_sent = StructType(
        [StructField(f.name, StringType()) if f in numbers else f for f in element]
    )
    answer = F.from_json(F.col(column), payload_of(as_sent))
    products = F.coalesce(
        answer["products"], F.raise_error(F.lit("payload without a products list"))
    )
    sent = payloads.select(F.inline(products))
    typed = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in numbers}
    unfit = reduce(
        or_, [F.col(f"`{n}`").isNotNull() & cast.isNull() for n, cast in typed.items()], F.lit(False)
    )
    whole = F.to_json(F.struct(*[F.col(f"`{name}`") for name in element.names]))
    return sent.select(
        *[typed.get(name, F.col(f"`{name}`")).alias(name) for name in element.names],
        F.when(unfit, whole).alias(CORRUPT),
    )


def read_payloads(
    spark: SparkSession,
    path: str,
    element: StructType | None = PRODUCT_ELEMENT,
    whole_files: bool = False,
) -> DataFrame:
    """Products of landed answers: one answer per line, or per file with ``whole_files``.

    Without an ``element`` every field that the answers have is read.
    """
    if element is None:
        element = answered_element(spark, path, whole_files)
    return exploded_products(spark.read.text(path, wholetext=whole_files), element=element)

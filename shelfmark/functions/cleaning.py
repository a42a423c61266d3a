"""Text, key and date expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The derived e-mail domain, the signup date of every customer,
# and the text patterns of the raw files.
EMAIL_DOMAIN = "@email.com"
SIGNUP_DATE = "2017-01-01"
TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"
DATE_PATTERN = "yyyy-MM-dd"
ID_PREFIX_LENGTH = 8

FULL_DATE = r"^\s*\d{4}-\d{1,2}-\d{1,2}"


def text_key(column: str) -> Column:
    """A key as text, so ids inferred or typed as numbers join with text ids."""
    return F.col(column).cast("string")


def id_prefix(column: str) -> Column:
    return F.substring(F.col(column), 1, ID_PREFIX_LENGTH)


def contact_email(column: str) -> Column:
    """NULL when the name is NULL."""
    return F.concat(F.col(column), F.lit(EMAIL_DOMAIN))


def product_label(category: str, product_id: str) -> Column:
    """``category_idprefix``; NULL when the category is NULL."""
    return F.concat(F.col(category), F.lit("_"), id_prefix(product_id))


def lenient_double(column: str) -> Column:
    """NULL where the text is no number, instead of failing the job."""
    return F.col(column).try_cast("double")


def parsed_date(df: DataFrame, column: str, pattern: str) -> Column:
    """The date of a column, NULL where a text does not parse.

    Texts are read by the pattern, else as a full date with any time Spark can
    cast, so a file with fractions of a second or another ISO form keeps its
    dates. A date is the one written, whatever zone follows.
    """
    text = F.col(column)
    if not isinstance(df.schema[column].dataType, StringType):
        return text.cast("date")
    other = F.when(text.rlike(FULL_DATE), text.try_cast("timestamp_ntz"))
    return F.coalesce(
        F.try_to_timestamp(text, F.lit(pattern)).cast("date"), other.cast("date")
    )

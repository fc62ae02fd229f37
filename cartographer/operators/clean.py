"""Cleaning and typing operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import NumericType, StringType

from .. import config as C
from ..functions import text as T
from ..functions.dates import age_exact, age_years
from ..functions.stats import scalar
from .quantiles import quantile_row


def clean_customers(customers: DataFrame) -> DataFrame:
    """Fill job type / e-mail / phone flag with constants; phone flag -> boolean."""
    return (customers
            .fillna({"job_type": C.DEFAULT_JOB_TYPE, "email_provider": C.DEFAULT_EMAIL_PROVIDER,
                     "flag_phone_provided": C.MISSING_FLOAT_DEFAULT})
            .withColumn("flag_phone_provided",
                        F.coalesce(F.col("flag_phone_provided") == 1.0, F.lit(C.MISSING_BOOL_DEFAULT))))


def fill_by_type(df: DataFrame) -> DataFrame:
    """Drop exact duplicates, then strings -> 'Unknown', numerics -> column median."""
    d = df.dropDuplicates()
    nums = [f.name for f in d.schema.fields if isinstance(f.dataType, NumericType)]
    strs = {f.name for f in d.schema.fields if isinstance(f.dataType, StringType)}
    med = quantile_row(d, nums, [0.5]).scalar() if nums else None
    cols = []
    for f in d.schema.fields:
        c = F.col(f.name)
        if f.name in strs:
            c = F.coalesce(c, F.lit(C.UNKNOWN_LABEL))
        elif f.name in nums:
            c = F.coalesce(c, med[f.name][0].cast(f.dataType))
        cols.append(c.alias(f.name))
    return d.select(*cols)


def parse_timestamp(c, strict: bool = False):
    """String -> timestamp_ntz, whatever the session's zone; unparsable -> null unless ``strict``."""
    return c.cast("timestamp_ntz") if strict else c.try_cast("timestamp_ntz")


def parse_double(c):
    return F.expr(f"try_cast({c} AS double)") if isinstance(c, str) else c.try_cast("double")


def outlier_to_median(df: DataFrame, cols: Sequence[str], z: float = C.OUTLIER_Z) -> DataFrame:
    """Replace values with |population z-score| > z by the column median.

    Moments of all columns come from one scalar subquery, medians from another;
    a constant column (std 0) has no outliers.
    """
    s = scalar(df, **{f"mu_{c}": F.avg(c) for c in cols}, **{f"sd_{c}": F.stddev_pop(c) for c in cols})
    med = quantile_row(df, list(cols), [0.5]).scalar()

    def repaired(c: str):
        zs = F.abs(F.col(c) - s[f"mu_{c}"]) / F.nullif(s[f"sd_{c}"], F.lit(0.0))
        return F.when(zs > z, med[c][0]).otherwise(F.col(c)).alias(c)

    return df.select(*[repaired(c) if c in cols else F.col(c) for c in df.columns])


def clean_reviews(reviews: DataFrame, col: str = "review_text", tags_only: bool = False) -> DataFrame:
    """Remove markup tokens anywhere in the text, or whole tags only (words that hold a token stay)."""
    return reviews.withColumn(col, T.strip_tags(F.col(col)) if tags_only else T.strip_markup(F.col(col)))


def normalize_text(df: DataFrame, col: str = "review_text") -> DataFrame:
    return df.withColumn(col, T.normalize(F.coalesce(F.col(col), F.lit(""))))


def with_age(df: DataFrame, as_of: str = C.AS_OF, exact: bool = True, keep_unknown: bool = False) -> DataFrame:
    """Add ``age``; rows without birthdate go, or keep a null age with ``keep_unknown``."""
    f = age_exact if exact else age_years
    known = df if keep_unknown else df.where(F.col("birthdate").isNotNull())
    return known.withColumn("age", f(F.col("birthdate"), as_of))

"""Feature engineering: imputation, scaling, one-hot and binary encoding.

``fit_preprocessor`` runs a few aggregates and brings back only fitted
metadata (medians, means, scales, category levels: bounded by the number of
levels of categorical columns). ``transform`` then adds plain column
expressions, so scoring a table is a single narrow projection.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..session import cut_lineage
from .quantiles import quantile_row

CATEGORICAL = ["product_class", "job_type", "region", "loyalty_type"]
BINARY = ["gender"]
#: Most levels of an encoded column.
MAX_LEVELS = 10_000
NUMERIC = ["price_reduction", "flag_phone_provided", C.LOYALTY_STATUS_COL]


def _safe(name: str) -> str:
    return re.sub(r"[^0-9A-Za-z_]", "_", name)


def top_values(df: DataFrame, col: str, n: int = 3) -> list[str]:
    """The n most frequent non-null values (ties by value); a bounded collect."""
    rows = (df.where(F.col(col).isNotNull()).groupBy(col).count()
            .orderBy(F.col("count").desc(), F.col(col)).limit(n).collect())
    return [r[0] for r in rows]


def group_rare(col: Column, keep: Sequence[str], other: str = C.OTHER_EMAIL) -> Column:
    """Values outside ``keep`` (and nulls) become ``other``."""
    return F.when(col.isin(list(keep)), col).otherwise(F.lit(other))


@dataclass
class Preprocessor:
    numeric: dict = field(default_factory=dict)      # col -> [median, mean, scale]
    categorical: dict = field(default_factory=dict)  # col -> sorted levels
    binary: dict = field(default_factory=dict)       # col -> [mode, sorted levels]
    email_top: list = field(default_factory=list)
    email_col: str | None = None

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(s: str) -> "Preprocessor":
        return Preprocessor(**json.loads(s))

    def feature_names(self, safe: bool = False) -> list[str]:
        """Output column names; ``safe`` maps characters other than letters,
        digits and '_' to '_' (for assemblers that parse dotted names)."""
        names = [f"num__{c}" for c in self.numeric]
        for c, levels in self.categorical.items():
            names += [f"cat__{c}_{v}" for v in levels]
        for c, (mode, levels) in self.binary.items():
            names += [f"bin__{c}_{v}" for v in (levels[1:] if len(levels) == 2 else levels)]
        return [_safe(n) for n in names] if safe else names

    def prepared(self, df: DataFrame) -> DataFrame:
        if self.email_col:
            df = df.withColumn(self.email_col, group_rare(F.col(self.email_col), self.email_top))
        return df

    def columns(self) -> list[Column]:
        out = []
        for c, (med, mean, scale) in self.numeric.items():
            x = F.coalesce(F.col(c).cast("double"), F.lit(med))
            out.append(((x - F.lit(mean)) / F.lit(scale)).alias(f"num__{c}"))
        for c, levels in self.categorical.items():
            x = F.coalesce(F.col(c).cast("string"), F.lit(C.MISSING_CATEGORY))
            out += [F.when(x == v, 1.0).otherwise(0.0).alias(f"cat__{c}_{v}") for v in levels]
        for c, (mode, levels) in self.binary.items():
            x = F.coalesce(F.col(c).cast("string"), F.lit(mode))
            keep = levels[1:] if len(levels) == 2 else levels
            out += [F.when(x == v, 1.0).otherwise(0.0).alias(f"bin__{c}_{v}") for v in keep]
        return out

    def cells(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Sparse long form (keys..., feature, value) with only non-zero cells:
        the numerics, the one active level of each categorical column, and the
        binary indicator when set (never the full dense row)."""
        d = self.prepared(df)
        num = {c: e for c, e in zip(self.numeric, self.columns()[:len(self.numeric)])}
        parts = [F.struct(F.lit(f"num__{c}").alias("feature"), e.alias("value")) for c, e in num.items()]
        for c, levels in self.categorical.items():
            x = F.coalesce(F.col(c).cast("string"), F.lit(C.MISSING_CATEGORY))
            parts.append(F.struct(F.when(x.isin(list(levels)), F.concat(F.lit(f"cat__{c}_"), x)).alias("feature"),
                                  F.lit(1.0).alias("value")))
        for c, (mode, levels) in self.binary.items():
            x = F.coalesce(F.col(c).cast("string"), F.lit(mode))
            keep_levels = levels[1:] if len(levels) == 2 else levels
            parts.append(F.struct(F.when(x.isin(list(keep_levels)), F.concat(F.lit(f"bin__{c}_"), x))
                                  .alias("feature"), F.lit(1.0).alias("value")))
        out = d.select(*keep, F.inline(F.array(*parts)))
        return out.where(F.col("feature").isNotNull() & (F.col("value") != 0))

    def transform(self, df: DataFrame, keep: Sequence[str] = (), safe: bool = False) -> DataFrame:
        cols = self.columns()
        if safe:
            cols = [c.alias(n) for c, n in zip(cols, self.feature_names(safe=True))]
        return self.prepared(df).select(*keep, *cols)


def fit_preprocessor(df: DataFrame, numeric: Sequence[str] = NUMERIC,
                     categorical: Sequence[str] = CATEGORICAL, binary: Sequence[str] = BINARY,
                     email_col: str | None = "email_provider", email_top_n: int = 3) -> Preprocessor:
    p = Preprocessor(email_col=email_col)
    if email_col:
        p.email_top = top_values(df, email_col, email_top_n)
        categorical = list(categorical) + [email_col]
    d = p.prepared(df)
    if numeric:
        row = quantile_row(d, list(numeric), [0.5]).first()["s"]
        med = {c: row[c][0] if row[c] else None for c in numeric}
        imp = {c: F.coalesce(F.col(c).cast("double"), F.lit(med[c])) for c in numeric}
        st = d.agg(*[F.avg(imp[c]).alias(f"m_{c}") for c in numeric],
                   *[F.stddev_pop(imp[c]).alias(f"s_{c}") for c in numeric]).first()
        for c in numeric:
            sd = st[f"s_{c}"]
            p.numeric[c] = [med[c], st[f"m_{c}"], sd if sd else 1.0]
    if not categorical and not binary:
        return p
    levels = _levels(d, categorical, binary)
    for c in categorical:
        p.categorical[c] = sorted(levels[c])
    for c in binary:
        mode = min(levels[c], key=lambda v: (-levels[c][v], v), default=None)
        p.binary[c] = [mode, sorted(levels[c])]
    return p


def _levels(df: DataFrame, categorical: Sequence[str], binary: Sequence[str]) -> dict[str, dict[str, int]]:
    """Levels of each column with their counts; nulls are ``missing`` in categorical columns and left out of binary ones.

    Raises if a column has more than ``MAX_LEVELS``: one-hot columns and what
    the driver gets are bounded by it.
    """
    cells = [F.struct(F.lit(c).alias("column_name"), F.coalesce(F.col(c).cast("string"), F.lit(C.MISSING_CATEGORY)).alias("value"))
             for c in categorical]
    cells += [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in binary]
    counts = cut_lineage(df.select(F.inline(F.array(*cells))).where("value is not null")
                         .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")))
    wide = counts.groupBy("column_name").agg(F.count(F.lit(1)).alias("levels")).where(F.col("levels") > MAX_LEVELS).collect()
    if wide:
        raise ValueError(f"more than {MAX_LEVELS} levels: {[(r.column_name, r.levels) for r in wide]}")
    out: dict[str, dict[str, int]] = {c: {} for c in [*categorical, *binary]}
    for r in counts.collect():
        out[r.column_name][r.value] = r.n
    return out


def decode_one_hot(df: DataFrame, prefixes: Sequence[str] = C.ONE_HOT_PREFIXES) -> DataFrame:
    """For each prefix, replace its one-hot columns by ``<prefix>decoded``: the
    suffix of the largest column (first column on ties, as ``idxmax``)."""
    out = df
    for pre in prefixes:
        cols = [c for c in df.columns if c.startswith(pre)]
        if not cols:
            continue
        best = F.array_max(F.array(*[
            F.struct(F.col(f"`{c}`").alias("v"), F.lit(-i).alias("neg_pos"), F.lit(c[len(pre):]).alias("name"))
            for i, c in enumerate(cols)]))
        out = out.withColumn(pre + "decoded", best["name"]).drop(*cols)
    return out


def multilabel_matrix(df: DataFrame, labels_col: str, classes: Sequence[str],
                      prefix: str = "cat_") -> DataFrame:
    """One 0/1 column per class: class in the row's label list."""
    return df.select("*", *[F.array_contains(F.col(labels_col), v).cast("int").alias(f"{prefix}{v}")
                            for v in classes])


def one_hot_long(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Sparse long form of the one-hot matrix: (keys..., feature) per active
    indicator, ``cat__<col>_<value>`` with nulls as ``missing``."""
    arr = F.array(*[F.concat(F.lit(f"cat__{c}_"), F.coalesce(F.col(c).cast("string"),
                                                              F.lit(C.MISSING_CATEGORY))) for c in cols])
    return df.select(*keys, F.explode(arr).alias("feature"))

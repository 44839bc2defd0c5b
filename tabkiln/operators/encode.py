"""Categorical encodings.

The one-hot fit collects the distinct values of the chosen columns in one
job: the (column, value) pairs are deduplicated with a shuffle and only the
small distinct set reaches the driver, guarded by ``max_values`` per column (more raise).
Columns with more values take the sparse form, whose dictionary is a table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkiln.functions import fresh_name
from tabkiln.operators.ordered import add_row_index
from tabkiln.operators.profile import column_roles
from tabkiln.session import write_shared


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def dummy_name(col: str, value) -> str:
    """``<col>_<value>`` lower-cased and stripped."""
    return f"{col.lower()}_{str(value).lower().strip()}"


@dataclass(frozen=True)
class OneHotModel:
    values: dict  # column -> sorted list of values (as strings)
    drop: bool = True

    def transform(self, df: DataFrame) -> DataFrame:
        # values that share a name (case, outer blanks) share its column
        named: dict = {}
        for c, vals in self.values.items():
            for v in vals:
                owner, members = named.setdefault(dummy_name(c, v), (c, []))
                if owner != c:
                    raise ValueError(f"columns {owner} and {c} both give a dummy column {dummy_name(c, v)}")
                members.append(v)
        out = {n: F.when(_q(c).cast("string").isin(members), 1).otherwise(0) for n, (c, members) in named.items()}
        res = df.withColumns(out)
        return res.drop(*self.values.keys()) if self.drop else res


def fit_onehot(df: DataFrame, cols: Sequence[str], drop: bool = True, max_values: int = 1000) -> OneHotModel:
    """Dummy columns for each distinct non-NULL value of ``cols``."""
    cols = list(cols)
    if not cols:
        return OneHotModel({}, drop)
    pairs = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("c"), _q(c).cast("string").alias("v")) for c in cols])).alias("p")
    ).select("p.c", "p.v")
    distinct = pairs.filter(F.col("v").isNotNull()).distinct()
    # one row more than may be there: enough to know that there are too many
    most = max_values * len(cols)
    rows = distinct.limit(most + 1).collect()
    values: dict = {c: [] for c in cols}
    for r in rows:
        values[r["c"]].append(r["v"])
    if len(rows) > most or max(map(len, values.values())) > max_values:
        raise ValueError(f"more than {max_values} distinct values for one-hot in some of {cols}")
    typed = {}
    for c in cols:
        dt = df.schema[c].dataType.typeName()
        if dt in ("integer", "long", "short", "byte"):
            typed[c] = [str(v) for v in sorted(int(x) for x in values[c])]
        elif dt in ("double", "float"):
            typed[c] = [str(v) for v in sorted(values[c], key=float)]
        else:
            typed[c] = sorted(values[c])
    return OneHotModel(typed, drop)


def fit_onehot_threshold(df: DataFrame, threshold: int, drop: bool = True, exclude: Sequence[str] = ()) -> OneHotModel:
    """One-hot of every column with fewer than ``threshold`` distinct values.

    Dummy names carry the column prefix (the raw-value names of the reference
    collide between columns).
    """
    roles = column_roles(df.drop(*exclude), None, threshold, exclude_float=False)
    return fit_onehot(df, list(roles.categorical), drop, max_values=threshold)


def _dummy_value(c: str) -> Column:
    """The part of a dummy's name that comes from the value: as a string, lower-cased and stripped of blanks."""
    return F.lower(F.trim(_q(c).cast("string")))


@dataclass(frozen=True)
class SparseOneHotModel:
    """Dummies as positions in one wide vector; the dictionary ``(column, value, index)`` is a table of any size."""

    dictionary: DataFrame
    cols: list[str]
    sizes: dict  # column -> number of its values; its indexes are consecutive, columns in order

    @property
    def size(self) -> int:
        return sum(self.sizes.values())

    def _coded(self, df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
        """``df`` beside one index column per input column, NULL for a missing or unknown value.

        One join per column on the value: AQE broadcasts a small part of the
        dictionary and splits a value that holds much of ``df`` where it is large.
        """
        names = {}
        for i, c in enumerate(self.cols):
            value, index = fresh_name(df, f"_value_{i}"), fresh_name(df, f"_index_{i}")
            part = self.dictionary.filter(F.col("column") == c).select(F.col("value").alias(value), F.col("index").alias(index))
            df = df.join(part, _dummy_value(c) == F.col(value), "left").drop(value)
            names[c] = index
        return df, names

    def transform(self, df: DataFrame, out: str = "onehot", drop: bool = True) -> DataFrame:
        """Adds ``out``: the ascending indexes (from 0) of the dummies that are 1."""
        self._refuse(df, out)
        coded, names = self._coded(df)
        kept = [c for c in df.columns if not (drop and c in self.cols)]
        return coded.select(*map(_q, kept), F.array_compact(F.array(*[F.col(n) for n in names.values()])).alias(out))

    def vectors(self, df: DataFrame, out: str = "onehot", drop: bool = True) -> DataFrame:
        """Adds ``out``: the same as an MLlib sparse vector of length ``size``, for learners."""
        self._refuse(df, out)
        kept = [c for c in df.columns if not (drop and c in self.cols)]
        filled = [c for c in self.cols if self.sizes[c]]
        if not filled:
            raise ValueError(f"no values in {self.cols}")
        coded, names = self._coded(df)
        offset, codes = 0, {}
        for c in filled:  # codes from 0 in each column; one past the last has no dummy
            codes[c] = F.coalesce(F.col(names[c]) - offset, F.lit(self.sizes[c])).cast("double")
            offset += self.sizes[c]
        coded = coded.withColumns({names[c]: code for c, code in codes.items()})
        ins = [names[c] for c in filled]
        vecs = [fresh_name(coded, f"{n}_vec") for n in ins]
        largest = df.sparkSession.createDataFrame([[float(self.sizes[c] - 1) for c in filled]], ins)
        encoder = OneHotEncoder(inputCols=ins, outputCols=vecs, handleInvalid="keep", dropLast=True).fit(largest)
        joined = VectorAssembler(inputCols=vecs, outputCol=out).transform(encoder.transform(coded))
        return joined.select(*map(_q, kept), _q(out))

    @staticmethod
    def _refuse(df: DataFrame, out: str) -> None:
        if out in df.columns:
            raise ValueError(f"column {out} is there already")


def fit_onehot_sparse(df: DataFrame, cols: Sequence[str]) -> SparseOneHotModel:
    """Dictionary of every distinct non-NULL value of ``cols``, whatever their number.

    Values that share a dummy's name (case, outer blanks) share its index.
    Indexes follow the order of ``cols``, then of the values as strings.  Pairs
    are made distinct before the shuffle; the dictionary is written to the
    shared checkpoint folder and only the number of values per column is collected.
    """
    cols = list(cols)
    if not cols or len(set(cols)) != len(cols):
        raise ValueError("need columns, each once")
    cells = [F.struct(F.lit(i).alias("pos"), F.lit(c).alias("column"), _dummy_value(c).alias("value")) for i, c in enumerate(cols)]
    pairs = df.select(F.inline(F.array(*cells))).filter("value is not null").distinct()
    numbered = add_row_index(pairs, ["pos", "value"], "index", start=0)
    dictionary = write_shared(numbered.select("column", "value", F.col("index").cast("int").alias("index")), "onehot")
    counted = {r["column"]: r["count"] for r in dictionary.groupBy("column").count().collect()}
    return SparseOneHotModel(dictionary, cols, {c: counted.get(c, 0) for c in cols})


def index_categories(df: DataFrame, cols: Sequence[str], suffix: str = "_idx"):
    """Integer codes for string categories (F9), unseen values get an extra code."""
    indexer = StringIndexer(
        inputCols=list(cols), outputCols=[c + suffix for c in cols], handleInvalid="keep", stringOrderType="alphabetAsc"
    )
    model = indexer.fit(df)
    return model, model.transform(df)

"""One-hot encoding and scaling, fitted on the training rows as an ML Estimator."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler, VectorSlicer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import as_level, name, to_number


def fit_levels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct levels (column, level) of categorical columns, from one scan."""
    types = dict(df.dtypes)
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), as_level(name(c), types[c]).alias("level")) for c in columns]
    )
    return df.select(F.explode(pairs).alias("pair")).select("pair.column", "pair.level").distinct()


def collect_levels(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Levels of each column in ascending order.

    They are part of a fitted model, and so on the driver, as the labels of an indexer are.
    """
    rows = fit_levels(df, columns).collect()
    found: dict[str, list[str]] = {c: [] for c in columns}
    for row in rows:
        found[row["column"]].append(row["level"])
    return {c: sorted(ls) for c, ls in found.items()}


def dummy_levels(
    levels: dict[str, list[str]], markers: Sequence[str] = (), *, drop_first: bool = False
) -> list[tuple[str, str]]:
    """(column, level) of each dummy kept.

    ``drop_first`` leaves out the first level of a column; a dummy whose name contains a
    marker is redundant with another column and left out too.
    """
    kept = []
    for column, values in levels.items():
        for level in values[1 if drop_first else 0 :]:
            if not any(m in f"{column}_{level}" for m in markers):
                kept.append((column, level))
    return kept


def dummy(column: Column, level: str) -> Column:
    """1.0 where the column has the level, else 0.0, also for unknown and NULL."""
    return column.eqNullSafe(level).cast("double")


def one_hot(
    df: DataFrame,
    columns: Sequence[str],
    levels: dict[str, list[str]] | None = None,
    *,
    markers: Sequence[str] = (),
    drop_first: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Columns ``keep`` and a dummy ``column_level`` per level (fitted on ``df`` if not given)."""
    types = dict(df.dtypes)
    levels = levels or collect_levels(df, columns)
    texts = {c: as_level(name(c), types[c]) for c in columns}
    dummies = [
        dummy(texts[c], level).alias(f"{c}_{level}")
        for c, level in dummy_levels(levels, markers, drop_first=drop_first)
    ]
    return df.select(*[name(c) for c in keep], *dummies)


def numeric_moments(
    df: DataFrame, columns: Sequence[str], *, sample_std: bool = False
) -> dict[str, tuple[float, float]]:
    """Mean and (population) standard deviation; a zero deviation scales by 1."""
    std = F.stddev_samp if sample_std else F.stddev_pop
    types = dict(df.dtypes)
    numbers = {c: to_number(name(c), types[c]) for c in columns}
    aggregates = [
        agg(number).alias(f"{kind}_{i}")
        for i, number in enumerate(numbers.values())
        for kind, agg in (("mean", F.avg), ("std", std))
    ]
    row = df.agg(*aggregates).first() if aggregates else None
    return {
        c: (row[f"mean_{i}"] or 0.0, row[f"std_{i}"] or 1.0) for i, c in enumerate(numbers)
    }


def scale_numeric(
    df: DataFrame, columns: Sequence[str], fitted_on: DataFrame | None = None
) -> DataFrame:
    """Standardise columns by mean and population deviation of ``fitted_on`` (default: itself)."""
    moments = numeric_moments(fitted_on if fitted_on is not None else df, columns)
    return df.withColumns(
        {c: (name(c) - F.lit(mean)) / F.lit(std) for c, (mean, std) in moments.items()}
    )


class _PrepParams(Params):
    numeric = Param(Params._dummy(), "numeric", "numeric columns", TypeConverters.toListString)
    categorical = Param(
        Params._dummy(), "categorical", "categorical columns", TypeConverters.toListString
    )
    markers = Param(
        Params._dummy(), "markers", "name parts of redundant dummies", TypeConverters.toListString
    )
    dropFirst = Param(
        Params._dummy(), "dropFirst", "leave out first levels", TypeConverters.toBoolean
    )
    scale = Param(Params._dummy(), "scale", "standardise the numerics", TypeConverters.toBoolean)
    selected = Param(
        Params._dummy(),
        "selected",
        "encoded names to keep, in this order; empty keeps all",
        TypeConverters.toListString,
    )
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(
            markers=[], dropFirst=False, scale=False, selected=[], outputCol="features"
        )


class FeaturePrep(Estimator, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns levels and moments of the training rows.

    The fitted model makes a vector of the numerics (scaled or not) and then the dummies,
    named ``num__x`` and ``cat__x_level``.
    """

    @keyword_only
    def __init__(
        self,
        *,
        numeric=None,
        categorical=None,
        markers=None,
        dropFirst=False,
        scale=False,
        selected=None,
        outputCol="features",
    ):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> FeaturePrepModel:
        numeric, categorical = self.getOrDefault("numeric"), self.getOrDefault("categorical")
        levels = collect_levels(dataset, categorical) if categorical else {}
        moments = (
            numeric_moments(dataset, numeric)
            if numeric and self.getOrDefault("scale")
            else {c: (0.0, 1.0) for c in numeric}
        )
        kept = dummy_levels(
            levels, self.getOrDefault("markers"), drop_first=self.getOrDefault("dropFirst")
        )
        model = FeaturePrepModel()
        self._copyValues(model)
        model._set(fitted=json.dumps({"moments": moments, "dummies": kept}))
        model.check_selection()
        return model


class FeaturePrepModel(Model, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted :class:`FeaturePrep`; its state is one JSON text, so it saves like any stage."""

    fitted = Param(
        Params._dummy(), "fitted", "moments and dummies as JSON", TypeConverters.toString
    )

    def _columns(self, types: dict[str, str], dummies: bool = True) -> dict[str, Column]:
        state = json.loads(self.getOrDefault("fitted"))
        columns = {}
        for c, (mean, std) in state["moments"].items():
            value = to_number(name(c), types.get(c, "double"))
            unscaled = mean == 0.0 and std == 1.0
            columns[f"num__{c}"] = value if unscaled else (value - F.lit(mean)) / F.lit(std)
        if not dummies:
            return columns
        texts = {
            c: as_level(name(c), types.get(c, "string")) for c in dict(state["dummies"])
        }
        for c, level in state["dummies"]:
            columns[f"cat__{c}_{level}"] = dummy(texts[c], level)
        return columns

    def check_selection(self) -> None:
        """An unknown encoded name among the selected ones is an error."""
        unknown = sorted(set(self.getOrDefault("selected")) - set(self._names()))
        if unknown:
            raise ValueError(f"Unknown encoded features for selection: {unknown[:5]}")

    def feature_names(self) -> list[str]:
        return self.getOrDefault("selected") or self._names()

    def _names(self) -> list[str]:
        state = json.loads(self.getOrDefault("fitted"))
        return [*(f"num__{c}" for c in state["moments"]), *(f"cat__{c}_{v}" for c, v in state["dummies"])]

    def encoded(self, dataset: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """The encoded matrix as named columns, next to the columns ``keep``."""
        columns = self._columns(dict(dataset.dtypes))
        return dataset.select(
            *[name(c) for c in keep], *[columns[n].alias(n) for n in self.feature_names()]
        )

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Sparse vectors: a level is looked up once per column, however many levels there are."""
        state = json.loads(self.getOrDefault("fitted"))
        types = dict(dataset.dtypes)
        output = self.getOrDefault("outputCol")
        levels: dict[str, list[str]] = {}
        for c, level in state["dummies"]:
            levels.setdefault(c, []).append(level)
        encoded = self._columns(types, dummies=False)
        numbers = list(encoded)
        parts = [f"_number_{i}" for i in range(len(numbers))]
        rows = dataset.withColumns({p: encoded[n] for p, n in zip(parts, numbers, strict=True)})
        if levels:
            texts, places, hot = ([f"_{k}_{i}" for i in range(len(levels))] for k in ("text", "place", "hot"))
            rows = rows.withColumns(
                {t: as_level(name(c), types.get(c, "string")) for t, c in zip(texts, levels, strict=True)}
            )
            # Levels that have no dummy share the place behind the last, which is dropped.
            for own, text, place in zip(levels.values(), texts, places, strict=True):
                rows = StringIndexerModel.from_labels(own, text, place, handleInvalid="keep").transform(rows)
            rows = OneHotEncoder(inputCols=places, outputCols=hot, dropLast=True).fit(rows).transform(rows)
            parts = [*parts, *hot]
            rows = rows.drop(*texts, *places)
        rows = VectorAssembler(inputCols=parts, outputCol="_all", handleInvalid="error").transform(rows)
        rows = rows.drop(*parts)
        order = [*numbers, *[f"cat__{c}_{level}" for c, own in levels.items() for level in own]]
        position = {n: i for i, n in enumerate(order)}
        wanted = [position[n] for n in self.feature_names()]
        if wanted != list(range(len(order))):
            rows = VectorSlicer(inputCol="_all", outputCol="_some", indices=wanted).transform(rows)
            rows = rows.drop("_all").withColumnRenamed("_some", "_all")
        # Without the attributes, which would make trees treat dummies as categories.
        return rows.withColumn(output, F.col("_all").alias("_all", metadata={})).drop("_all")


def encode_matrix(
    train: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    *,
    markers: Sequence[str] = (),
    drop_first: bool = False,
    scale: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Fit on the training rows and return them as named encoded columns."""
    prep = FeaturePrep(
        numeric=list(numeric),
        categorical=list(categorical),
        markers=list(markers),
        dropFirst=drop_first,
        scale=scale,
    )
    return prep.fit(train).encoded(train, keep)

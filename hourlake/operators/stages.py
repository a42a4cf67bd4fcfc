"""Pipeline stages fitted on places: a fill per place with a missing
indicator, and a vocabulary of places (SURVEY S20, B18).

Both are MLlib estimators: they are fitted inside a ``Pipeline`` on the training
rows alone, saved and loaded with the model, and applied as expressions.  What
they keep has a row a place (and feature): a configured list of at most
``LARGEST`` places, beyond which fitting fails rather than drop any.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlake.functions import columns as X
from hourlake.operators import quantiles as Q

LARGEST = 20_000
FILLED, MISSING = "__filled", "__missing"


def _few(rows: DataFrame, what: str) -> list:
    found = rows.limit(LARGEST + 1).collect()
    if len(found) > LARGEST:
        raise ValueError(f"more than {LARGEST} {what}")
    return found


class _PlaceParams(HasInputCols):
    place = Param(Params._dummy(), "place", "column that names the place", TypeConverters.toString)


class PlaceImputer(Estimator, _PlaceParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the median of each feature at each place, and over all places
    for those where it has no value."""

    @keyword_only
    def __init__(self, inputCols=None, place="place"):
        super().__init__()
        self._setDefault(place="place")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> PlaceImputerModel:
        cols, place = self.getInputCols(), self.getOrDefault(self.place)
        by_place = Q.quantiles(dataset, cols, {"median": 0.5}, [place]).filter(F.col(place).isNotNull())
        fills = {c: {} for c in cols}
        for row in _few(by_place, "places and features"):
            fills[row["column"]][row[place]] = row["median"]
        overall = {r["column"]: r["median"] for r in Q.quantiles(dataset, cols, {"median": 0.5}).collect()}
        return PlaceImputerModel()._set(inputCols=cols, place=place, fills=fills, overall={c: overall.get(c, 0.0) for c in cols})


class PlaceImputerModel(Model, _PlaceParams, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``<feature>__filled`` and ``<feature>__missing`` (0 or 1) for every
    feature; an unknown place takes the median over all places."""

    fills = Param(Params._dummy(), "fills", "median by feature and place")
    overall = Param(Params._dummy(), "overall", "median by feature")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        place, out = F.col(self.getOrDefault(self.place)), {}
        for c in self.getInputCols():
            known, rest = self.getOrDefault(self.fills)[c], F.lit(float(self.getOrDefault(self.overall)[c]))
            pairs = [F.lit(x) for k, v in sorted(known.items()) for x in (k, float(v))]
            fill = F.coalesce(F.try_element_at(F.create_map(*pairs), place), rest) if pairs else rest
            x = X.nan_to_null(F.col(c).cast("double"))
            out[c + FILLED] = F.coalesce(x, fill)
            out[c + MISSING] = x.isNull().cast("double")
        return dataset.withColumns(out)


class PlaceEncoder(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the sorted distinct values of a column."""

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> PlaceEncoderModel:
        column = self.getInputCol()
        values = dataset.select(F.col(column).cast("string").alias("v")).filter("v IS NOT NULL").distinct()
        words = sorted(r[0] for r in _few(values, "places"))
        return PlaceEncoderModel()._set(inputCol=column, outputCol=self.getOutputCol(), vocabulary=words)


class PlaceEncoderModel(Model, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """A vector with a 1 at the value's place in the vocabulary; a value that
    training did not see, or NULL, gives zeros."""

    vocabulary = Param(Params._dummy(), "vocabulary", "values in order", TypeConverters.toListString)

    def words(self) -> list[str]:
        return self.getOrDefault(self.vocabulary)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        value = F.col(self.getInputCol()).cast("string")
        hits = F.transform(F.array(*[F.lit(w) for w in self.words()]), lambda w: F.coalesce((w == value).cast("double"), F.lit(0.0)))
        # the vector's length goes with the column, for the assembler
        return dataset.withColumn(self.getOutputCol(), array_to_vector(hits)).withMetadata(
            self.getOutputCol(), {"ml_attr": {"num_attrs": len(self.words())}})

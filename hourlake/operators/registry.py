"""Model registry with a retrain gate.

Models are saved into folders of their own; numbered pointers (one atomic
rename each) say which one serves and how every try scored.  A retrained model
replaces the serving one only if its mean R² over the temporal folds is
better.
"""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlake.operators import model as ML
from hourlake.operators.versions import Pointers


def mean_r2(cv_result: DataFrame) -> float:
    return cv_result.agg(F.avg("r2")).first()[0]


class ModelRegistry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.pointers = Pointers(spark, f"{self.root}/serving")

    def _newest(self) -> tuple[int | None, dict]:
        number = (self.pointers.numbers() or [None])[-1]
        return number, self.pointers.read(number) if number else {"serving": None, "tries": []}

    def serving(self) -> dict | None:
        """Name, score and folder of the serving model."""
        return self._newest()[1]["serving"]

    def load(self) -> PipelineModel:
        return ML.load_model(self.serving()["path"])

    def tries(self) -> DataFrame:
        """A row for each model offered: name, mean R², accepted or not."""
        rows = [(t["name"], float(t["r2"]), bool(t["accepted"])) for t in self._newest()[1]["tries"]]
        return self.spark.createDataFrame(rows, "name string, r2 double, accepted boolean")

    def offer(self, name: str, model: PipelineModel, r2: float) -> bool:
        """Let a model serve if none does or its score beats the serving one;
        keeps a record either way."""
        number, state = self._newest()
        accepted = state["serving"] is None or r2 > state["serving"]["r2"]
        if accepted:
            path = f"{self.root}/models/{uuid.uuid4().hex}"
            ML.save_model(model, path)
            state["serving"] = {"name": name, "r2": r2, "path": path}
        state["tries"].append({"name": name, "r2": r2, "accepted": accepted})
        self.pointers.commit(state, number)
        return accepted

    def retrain(self, candidates: dict, data: DataFrame, folds: DataFrame, features) -> bool:
        """K5-K7: cross-validate every candidate (name -> pipeline), refit the
        best by mean R² on all rows, and offer it."""
        results = {n: ML.cross_validate_pipeline(self.spark, data, folds, p) for n, p in candidates.items()}
        best = ML.choose(results)
        score = mean_r2(results[best])
        state = self.serving()
        if state is not None and score <= state["r2"]:  # no need to fit what won't serve
            return self.offer(best, None, score)
        return self.offer(best, candidates[best].fit(ML.cut_lineage(ML._double_features(data, features))), score)

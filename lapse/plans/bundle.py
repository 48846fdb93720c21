"""The fitted model as one ML pipeline: saved under the shared folder, loaded
again, applied to user features.

Stages, in order: categoricals to text, category codes, clusters (assembler,
scaler, k-means), class shares of the country, feature vector, the forests of
all folds, their averaged probabilities, the class name. All fitted values lie
in the saved folder (the share table as Parquet), so a process that has fitted
nothing scores with them.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Model, PipelineModel, Transformer
from pyspark.ml.feature import IndexToString, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.operators.materialize import join_small
from lapse.plans import encode
from lapse.plans.forest import ForestModel


class _Columns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A transformer over a list of columns."""

    cols = Param(Params._dummy(), "cols", "columns", typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, cols=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})


class TextCategories(_Columns):
    """Categoricals as text, gaps as a category of their own."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return encode.clean_categoricals(dataset, tuple(self.getOrDefault(self.cols)))


class FilledNumbers(_Columns):
    """Numeric gaps as the value that the forest takes for missing."""

    value = Param(Params._dummy(), "value", "value of a gap", typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, cols=None, value=None):
        Transformer.__init__(self)
        self._setDefault(value=-1.0)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.na.fill(self.getOrDefault(self.value), subset=self.getOrDefault(self.cols))


class NumberVector(_Columns):
    """The columns as one vector, gaps as 0."""

    output = Param(Params._dummy(), "output", "vector column", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, cols=None, output=None):
        Transformer.__init__(self)
        self._setDefault(output="_raw")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        values = [F.col(c).cast("double") for c in self.getOrDefault(self.cols)]
        known = [F.when(v.isNull() | F.isnan(v), F.lit(0.0)).otherwise(v) for v in values]
        return dataset.withColumn(self.getOrDefault(self.output), array_to_vector(F.array(*known)))


class KnownCodes(_Columns):
    """Indexed categoricals in place of their text; values that the indexer
    has not seen get code 0."""

    sizes = Param(Params._dummy(), "sizes", "known values a column", typeConverter=TypeConverters.toListInt)

    @keyword_only
    def __init__(self, cols=None, sizes=None):
        Transformer.__init__(self)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols, sizes = self.getOrDefault(self.cols), self.getOrDefault(self.sizes)
        tmp = [f"_code_{c}" for c in cols]
        codes = {c: F.when(F.col(t) >= n, F.lit(0)).otherwise(F.col(t).cast("int")) for c, t, n in zip(cols, tmp, sizes)}
        return dataset.withColumns(codes).drop(*tmp)


class MeanProbability(_Columns):
    """The average of the folds' probability vectors, and the code of the
    largest class (the first of equal ones)."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols = self.getOrDefault(self.cols)
        parts = [vector_to_array(c) for c in cols]
        total = parts[0]
        for p in parts[1:]:
            total = F.zip_with(total, p, lambda a, b: a + b)
        mean = F.transform(total, lambda x: x / len(cols))
        out = dataset.withColumn("_mean", mean)
        best = (F.array_position("_mean", F.array_max("_mean")) - 1).cast("double")
        return out.withColumns({"probability": array_to_vector("_mean"), "prediction": best, "confidence": F.array_max("_mean")}).drop("_mean")


class CategoryShares(Model, MLReadable, MLWritable):
    """Class shares per category, looked up: ``<col>_te_cls<k>`` columns; a
    category without shares gets those of all train users."""

    col = Param(Params._dummy(), "col", "category column", typeConverter=TypeConverters.toString)
    overall = Param(Params._dummy(), "overall", "shares of all train users", typeConverter=TypeConverters.toListFloat)

    def __init__(self, table: DataFrame | None = None, col: str | None = None, overall: list[float] | None = None):
        super().__init__()
        self.table = table
        if col is not None:
            self._set(col=col, overall=overall)

    def names(self) -> list[str]:
        return [f"{self.getOrDefault(self.col)}_te_cls{k}" for k in range(len(self.getOrDefault(self.overall)))]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        col, fallback = self.getOrDefault(self.col), self.getOrDefault(self.overall)
        known = self.table.withColumnRenamed(col, "_category")
        out = join_small(dataset.withColumn("_own", F.col(col)), known.withColumnRenamed("_category", "_own"), "_own")
        return out.withColumns({c: F.coalesce(F.col(c), F.lit(x)) for c, x in zip(self.names(), fallback)}).drop("_own")

    def write(self) -> MLWriter:
        return _SharesWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _SharesReader(cls)


class _SharesWriter(MLWriter):
    def __init__(self, instance: CategoryShares):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        spark = self.instance.table.sparkSession
        DefaultParamsWriter.saveMetadata(self.instance, path, spark)
        self.instance.table.write.mode("overwrite").parquet(f"{path}/shares")


class _SharesReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> CategoryShares:
        spark = SparkSession.getActiveSession()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = self.cls(spark.read.parquet(f"{path}/shares"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


def bundle(data, forests: list) -> PipelineModel:
    """The pipeline of prepared model data (``model.ModelData``) and the fold
    forests fitted on it."""
    from lapse.plans.model import MISSING_NUMBER
    from lapse.operators.spine import numeric_columns

    cols = data.feature_cols
    indexer = data.category_model
    categories = indexer.getInputCols()
    return PipelineModel(
        stages=[
            TextCategories(cols=categories),
            data.shares,  # reads the country as text, before it becomes a code
            indexer,
            KnownCodes(cols=categories, sizes=[len(x) for x in indexer.labelsArray]),
            *data.cluster_model.stages,
            FilledNumbers(cols=numeric_columns(data.frame.select(*cols)), value=MISSING_NUMBER),
            VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep"),
            *forests,
            MeanProbability(cols=[m.getProbabilityCol() for m in forests]),
            IndexToString(inputCol="prediction", outputCol="predicted_class", labels=list(data.class_names)),
        ]
    )


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, features: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Scores of user features: key, predicted class, a probability a class,
    confidence."""
    labels = model.stages[-1].getLabels()
    p = vector_to_array("probability")
    # The forests land what they score: only the key and the feature vector.
    first = next(i for i, stage in enumerate(model.stages) if isinstance(stage, ForestModel))
    vectors = PipelineModel(stages=model.stages[:first]).transform(features).select(*key, "features")
    scored = PipelineModel(stages=model.stages[first:]).transform(vectors)
    return scored.select(*key, "predicted_class", *[p[i].alias(f"prob_{c}") for i, c in enumerate(labels)], "confidence")

"""A fitted scorer as an artefact: encoder, assembler and forest in one ML pipeline.

``CodeEncoder`` learns the sorted values of each feature and gives them codes 0..n-1.  Its
dictionary is a DataFrame (feature, value, code), numbered by a distributed sort and
joined when rows are encoded, so an entity axis of any size passes neither the driver nor
one task.  Fitted stages are saved and loaded like any other of the ML library; a profile
is a tuple of feature values and is scored whether or not the sample has its cell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasHandleInvalid, HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReader, MLWriter
from pyspark.ml.util import MLReadable, MLWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rank import global_row_number
from ..session import ensure_checkpoint_dir
from .trees import make_estimator


class _CodeColumns(HasInputCols, HasOutputCols, HasHandleInvalid):
    """``handleInvalid`` says what happens to a value that was not seen, or null: ``keep`` gives it the
    code after the last, ``skip`` leaves the row out, ``error`` fails."""


class CodeEncoder(Estimator, _CodeColumns, DefaultParamsReadable, DefaultParamsWritable):
    """Alphabetical codes of one or more columns."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None,
                 handleInvalid: str = "error"):
        super().__init__()
        self._setDefault(handleInvalid="error")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> CodeEncoderModel:
        ensure_checkpoint_dir(dataset.sparkSession)
        cols = self.getInputCols()
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols]))
        seen = dataset.select(pairs.alias("p")).select("p.*").where("value is not null").distinct()
        numbered = global_row_number(seen, ["feature", "value"], "n")
        first = numbered.groupBy("feature").agg(F.min("n").alias("first"))  # a row a feature
        words = (numbered.join(F.broadcast(first), "feature")
                 .select("feature", "value", (F.col("n") - F.col("first")).cast("long").alias("code")).checkpoint())
        return self._copyValues(CodeEncoderModel(words))


class CodeEncoderModel(Model, _CodeColumns, MLWritable, MLReadable):
    """The dictionary of a ``CodeEncoder``; adds the columns of codes."""

    def __init__(self, words: DataFrame | None = None):
        super().__init__()
        self._setDefault(handleInvalid="error")
        self.words = words

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out, rule = dataset, self.getHandleInvalid()
        for c, code in zip(self.getInputCols(), self.getOutputCols(), strict=True):
            own = self.words.where(F.col("feature") == c).select(F.col("value").alias("_value"), F.col("code").alias(code))
            if rule == "skip":
                out = out.join(own, F.col(c).cast("string") == F.col("_value")).drop("_value")
                continue
            unknown = own.agg(F.coalesce(F.max(code) + 1, F.lit(0).cast("long"))).scalar()
            if rule == "error":
                unknown = F.when(F.col("_value").isNull(), F.raise_error(F.concat(F.lit(f"{c}: unknown value "), F.coalesce(F.col(c).cast("string"), F.lit("null"))))).cast("long")
            out = (out.join(own, F.col(c).cast("string") == F.col("_value"), "left")
                   .withColumn(code, F.coalesce(code, unknown)).drop("_value"))
        return out

    def write(self) -> MLWriter:
        return _EncoderWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _EncoderReader(cls)


class _EncoderWriter(MLWriter):
    def __init__(self, model: CodeEncoderModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.words.write.parquet(f"{path}/dictionary")


class _EncoderReader(MLReader):
    def __init__(self, kind: type):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> CodeEncoderModel:
        about = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.kind(self.sparkSession.read.parquet(f"{path}/dictionary"))
        model._resetUid(about["uid"])
        DefaultParamsReader.getAndSetParams(model, about)
        return model


def fit_scorer(sample: DataFrame, train: DataFrame, features: Sequence[str], name: str = "random_forest",
               seed: int = 42) -> PipelineModel:
    """Codes from the whole ``sample``, the model from ``train`` (with ``label``); profiles with values that
    the sample lacks are scored under the code after the last."""
    codes = [f"{c}_code_" for c in features]
    encoder = CodeEncoder(inputCols=list(features), outputCols=codes, handleInvalid="keep").fit(sample)
    assembler = VectorAssembler(inputCols=codes, outputCol="features")
    # the copy has no summary, see trees.fit_predict
    model = make_estimator(name, seed).fit(assembler.transform(encoder.transform(train))).copy()
    return PipelineModel([encoder, assembler, model])


def score_profiles(scorer: PipelineModel, profiles: DataFrame) -> DataFrame:
    """``profiles`` with ``prediction`` (long) and ``prob_pos``, the probability of class 1; no row is lost."""
    got = scorer.transform(profiles)
    return got.select(*[F.col(c) for c in profiles.columns], F.col("prediction").cast("long").alias("prediction"),
                      vector_to_array("probability")[1].alias("prob_pos"))

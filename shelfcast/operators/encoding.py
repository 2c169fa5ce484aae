"""Feature encoders as Spark ML stages: cyclic, label mean, min-max.

The statistics are aggregates, the encoding is an expression or a join, and the
fitted stages are saved within a ``PipelineModel``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasLabelCol
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.scalars import cyclic, hash_value
from shelfcast.session import free_shuffles, written_by_value
from shelfcast.spec import PanelSpec

# The prefixes of encoded column names.
ENCODED, SCALED, SIN, COS = "TargetEncoded__", "MinMaxScaled__", "sin__", "cos__"


class CyclicEncoder(Transformer, HasInputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds sine and cosine of a repeating column."""

    period = Param(Params._dummy(), "period", "length of the cycle", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, period: int = 12) -> None:
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        c, cycle = self.getInputCol(), self.getOrDefault(self.period)
        return df.withColumns({SIN + c: cyclic(c, cycle, "sin"), COS + c: cyclic(c, cycle, "cos")})


class RangeScaler(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the smallest and largest value of each column in one aggregate."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None) -> None:
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> RangeScalerModel:
        columns = self.getInputCols()
        ends = df.agg(
            F.array(*[F.min(c).cast("double") for c in columns]).alias("lows"),
            F.array(*[F.max(c).cast("double") for c in columns]).alias("highs"),
        ).first()
        free_shuffles(df.sparkSession)
        return RangeScalerModel(inputCols=columns, lows=ends["lows"], highs=ends["highs"])


class RangeScalerModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Maps the learned range to 0..1; a column without any spread becomes 0."""

    lows = Param(Params._dummy(), "lows", "smallest value by column", TypeConverters.toListFloat)
    highs = Param(Params._dummy(), "highs", "largest value by column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(
        self,
        *,
        inputCols: Sequence[str] | None = None,
        lows: Sequence[float] | None = None,
        highs: Sequence[float] | None = None,
    ) -> None:
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        ranges = zip(self.getInputCols(), self.getOrDefault(self.lows), self.getOrDefault(self.highs))
        return df.withColumns(
            {SCALED + c: (F.col(c) - F.lit(low)) / F.lit(high - low if high > low else 1.0) for c, low, high in ranges}
        )


def _shrunk_mean(n: Column, total: Column, squares: Column, label_mean: Column, label_var: Column) -> Column:
    """Empirical-Bayes mean of a group: the less it varies and the more rows it has, the more it counts."""
    mean = total / n
    spread = F.greatest(squares / n - mean * mean, F.lit(0.0))
    weight = label_var * n / (label_var * n + spread)
    return F.when(label_var * n + spread > 0, weight * mean + (F.lit(1.0) - weight) * label_mean).otherwise(label_mean)


def _moments(label: Column) -> list[Column]:
    y = label.cast("double")
    return [F.count(y).cast("double").alias("n"), F.sum(y).alias("total"), F.sum(y * y).alias("squares")]


class LabelMeanEncoder(Estimator, HasInputCols, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """Replaces a category by the shrunk mean of the label over its training rows."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, labelCol: str = "label") -> None:
        super().__init__()
        self._set(**self._input_kwargs)

    def encodings(self, df: DataFrame) -> DataFrame:
        """``(feature, value, n, encoding)``, from one pass over the rows, combined before the shuffle."""
        label = F.col(self.getLabelCol())
        overall = df.agg(F.struct(*_moments(label)).alias("all")).scalar()
        mean = overall["total"] / overall["n"]
        variance = F.greatest(overall["squares"] / overall["n"] - mean * mean, F.lit(0.0))
        groups = _by_category(df, self.getInputCols(), label).groupBy("feature", "value").agg(*_moments(F.col("label")))
        code = _shrunk_mean(F.col("n"), F.col("total"), F.col("squares"), mean, variance)
        return groups.select("feature", "value", F.col("n").cast("bigint").alias("n"), code.alias("encoding"))

    def label_mean(self, df: DataFrame) -> DataFrame:
        n, total, _ = _moments(F.col(self.getLabelCol()))
        return df.agg(n, total).select((F.col("total") / F.col("n")).alias("mean"))

    def _fit(self, df: DataFrame) -> LabelMeanEncoderModel:
        model = LabelMeanEncoderModel(inputCols=self.getInputCols(), labelMean=self.label_mean(df).first()["mean"])
        free_shuffles(df.sparkSession)
        model.codes = written_by_value(self.encodings(df), "feature", self.getInputCols())
        free_shuffles(df.sparkSession)
        return model

    def fold_codes(self, df: DataFrame) -> DataFrame:
        """``(feature, value, codes)``: for each fold that the value occurs in, the encoding from the rows of all other folds.

        The other folds' sums are the totals less the fold's own: one pass, not one per fold. A value has at most one entry for a fold.
        """
        label, sums = F.col(self.getLabelCol()), ["n", "total", "squares"]
        whole = df.agg(F.struct(*_moments(label)).alias("whole")).scalar()
        rest = df.groupBy("fold").agg(*_moments(label)).select("fold", *[(whole[s] - F.col(s)).alias(s) for s in sums])
        mean = F.col("total") / F.col("n")
        variance = F.greatest(F.col("squares") / F.col("n") - mean * mean, F.lit(0.0))
        entry = F.struct("fold", F.struct(mean.alias("mean"), variance.alias("variance")))
        by_fold = rest.agg(F.map_from_entries(F.collect_list(entry)).alias("rest")).scalar()

        own = _by_category(df, self.getInputCols(), label, F.col("fold")).groupBy("feature", "value", "fold").agg(*_moments(F.col("label")))
        values = own.groupBy("feature", "value").agg(
            F.collect_list(F.struct("fold", *sums)).alias("parts"), *[F.sum(s).alias(s) for s in sums]
        )

        def code(part: Column) -> Column:
            n, total, squares = [F.col(s) - part[s] for s in sums]
            others = F.try_element_at("rest", part["fold"])
            shrunk = _shrunk_mean(n, total, squares, others["mean"], others["variance"])
            return F.struct(part["fold"], F.when(n > 0, shrunk).otherwise(others["mean"]))

        coded = F.map_from_entries(F.transform("parts", code)).alias("codes")
        return values.withColumn("rest", by_fold).select("feature", "value", coded)

    def crossfit(self, df: DataFrame, keys: Sequence[str], folds: int = 5, seed: int = 42) -> DataFrame:
        """Encode training rows from the rows of the other folds, so that no row sees its own label.

        The codes are written down by feature, one row per value with its codes of all folds, so that every look-up is by the
        value alone and is planned by the size of that feature's codes.
        """
        df = df.withColumn("fold", F.pmod(hash_value(list(keys), seed), F.lit(folds)).cast("int"))
        codes = written_by_value(self.fold_codes(df), "feature", self.getInputCols())
        free_shuffles(df.sparkSession)
        return _looked_up(df, codes, "codes", lambda found: F.try_element_at(found, F.col("fold"))).drop("fold")


def _looked_up(df: DataFrame, codes: Mapping[str, DataFrame], source: str, code: Callable[[Column], Column]) -> DataFrame:
    """Adds an encoded column for each feature, null for an unknown value.

    Each join is planned by the size of that feature's codes: the few shops and categories are broadcast, and only a feature with
    more codes than Spark broadcasts makes the rows move, once, to a layout by its values; rows that lie so already stay.
    """
    for c, table in codes.items():
        found = table.select(F.col("value").try_cast(df.schema[c].dataType).alias(c), F.col(source).alias("found"))
        df = df.join(found, c, "left").withColumn(ENCODED + c, code(F.col("found"))).drop("found")
    return df


def _by_category(df: DataFrame, columns: Sequence[str], label: Column, *others: Column) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("bigint").alias("value")) for c in columns]
    return df.select(F.explode(F.array(*cells)).alias("cell"), label.alias("label"), *others).select("cell.*", "label", *others)


class LabelMeanEncoderModel(Model, HasInputCols, MLWritable, MLReadable):
    """Looks up the learned encodings; an unseen category gets the mean label."""

    labelMean = Param(Params._dummy(), "labelMean", "mean label of the training rows", TypeConverters.toFloat)
    codes: dict[str, DataFrame]

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, labelMean: float | None = None) -> None:
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        coded = _looked_up(df, self.codes, "encoding", lambda found: found)
        return coded.fillna({ENCODED + c: self.getOrDefault(self.labelMean) for c in self.getInputCols()})

    def copy(self, extra=None) -> LabelMeanEncoderModel:
        other = super().copy(extra)
        other.codes = self.codes
        return other

    def write(self) -> MLWriter:
        return _EncoderWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _EncoderReader()


class _EncoderWriter(MLWriter):
    def __init__(self, model: LabelMeanEncoderModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        for feature, table in self.model.codes.items():
            table.write.parquet(f"{path}/encodings/feature={feature}")


class _EncoderReader(MLReader):
    def load(self, path: str) -> LabelMeanEncoderModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = LabelMeanEncoderModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.codes = {c: self.sparkSession.read.parquet(f"{path}/encodings/feature={c}") for c in model.getInputCols()}
        return model


def tree_stages(spec: PanelSpec = PanelSpec()) -> list:
    """Sine and cosine of the month; all other features as they are."""
    roles = spec.roles()
    waves = [w + c for c in roles.seasonal for w in (SIN, COS)]
    cycles = [CyclicEncoder(inputCol=c, period=12) for c in roles.seasonal]
    return [*cycles, VectorAssembler(inputCols=[*waves, *roles.categorical, *roles.numeric], outputCol="features")]


def scaled_stages(spec: PanelSpec = PanelSpec()) -> list:
    """Label means for the ids, sine and cosine of the month, the rest scaled to 0..1."""
    roles = spec.roles()
    waves = [w + c for c in roles.seasonal for w in (SIN, COS)]
    inputs = [*[ENCODED + c for c in roles.categorical], *waves, *[SCALED + c for c in roles.numeric]]
    return [
        *[CyclicEncoder(inputCol=c, period=12) for c in roles.seasonal],
        RangeScaler(inputCols=roles.numeric),
        LabelMeanEncoder(inputCols=roles.categorical),
        VectorAssembler(inputCols=inputs, outputCol="features"),
    ]


def feature_names(model) -> list[str]:
    """Names of the assembled features, in vector order."""
    return next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()


def fit_transform_split(train: DataFrame, val: DataFrame, stages: list, spec: PanelSpec = PanelSpec()):
    """Fit the stages on the training rows; returns the fitted pipeline and both parts transformed.

    Training rows get the label means of the other folds, validation rows those of all training rows.
    """
    fitted = Pipeline(stages=stages).fit(train)
    matrix = train
    for stage, model in zip(stages, fitted.stages):
        if isinstance(stage, LabelMeanEncoder):
            matrix = stage.crossfit(matrix, spec.key, seed=spec.seed)
        else:
            matrix = model.transform(matrix)
    return fitted, matrix, fitted.transform(val)

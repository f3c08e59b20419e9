"""Feature stages as Spark ML stages.

Each custom stage only builds Column expressions in ``_transform``, so a
fitted pipeline stays one codegen projection over the scan. Fitted state
(vocabulary, quartile ranges) is stored as params, so ``PipelineModel``
save/load round-trips through the standard ML persistence format.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler, VectorSlicer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession

from ..operators import features as FE
from ..operators import scale as SC

# The passthrough and derived feature names, in model order.
BASE_FEATURES = ["trans_hour", "trans_day_of_week", "city_pop", "gender_M"]
SCALED_SOURCES = ["amt", "distance_km"]
SCALED_SUFFIX = "_scaled"


class TransactionFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Hour, day of week, great-circle distance and the gender flag."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return FE.base_features(df)


class _OneHotParams(HasInputCol):
    prefix = Param(Params._dummy(), "prefix", "output column prefix",
                   typeConverter=TypeConverters.toString)
    maxCategories = Param(Params._dummy(), "maxCategories", "vocabulary size limit",
                          typeConverter=TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(inputCol="category", prefix=FE.CATEGORY_PREFIX,
                         maxCategories=FE.DEFAULT_MAX_CATEGORIES)


class CategoryOneHot(Estimator, _OneHotParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the sorted vocabulary; the first value is the dropped baseline."""

    def __init__(self, inputCol: str = "category", prefix: str = FE.CATEGORY_PREFIX,
                 maxCategories: int = FE.DEFAULT_MAX_CATEGORIES):
        super().__init__()
        self._set(inputCol=inputCol, prefix=prefix, maxCategories=maxCategories)

    def _fit(self, df: DataFrame) -> "CategoryOneHotModel":
        # Like the flag, the one-hot columns exist only if the source column does.
        vocab = (FE.fit_vocabulary(df, self.getInputCol(), self.getOrDefault("maxCategories"))
                 if self.getInputCol() in df.columns else [])
        m = CategoryOneHotModel()
        m._set(inputCol=self.getInputCol(), prefix=self.getOrDefault("prefix"), vocabulary=vocab)
        return m


class CategoryOneHotModel(Model, _OneHotParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted one-hot: the saved vocabulary."""
    vocabulary = Param(Params._dummy(), "vocabulary", "sorted category values",
                       typeConverter=TypeConverters.toListString)

    def __init__(self):
        super().__init__()
        self._setDefault(vocabulary=[])

    def outputCols(self) -> list[str]:
        return list(FE.one_hot_columns(self.getInputCol(), self.getOrDefault("vocabulary"),
                                       prefix=self.getOrDefault("prefix")))

    def _transform(self, df: DataFrame) -> DataFrame:
        if not self.getOrDefault("vocabulary"):
            return df
        return FE.one_hot(df, self.getInputCol(), self.getOrDefault("vocabulary"),
                          prefix=self.getOrDefault("prefix"))


class _ScalerParams(HasInputCols):
    relativeError = Param(Params._dummy(), "relativeError", "quantile error; 0 = exact",
                          typeConverter=TypeConverters.toFloat)
    suffix = Param(Params._dummy(), "suffix", "output column suffix",
                   typeConverter=TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(relativeError=SC.DEFAULT_RELATIVE_ERROR, suffix=SCALED_SUFFIX)


class IqrScaler(Estimator, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Divide by the inter-quartile range, no centring (a RobustScaler over
    named columns instead of a vector)."""

    def __init__(self, inputCols: Sequence[str] = tuple(SCALED_SOURCES),
                 relativeError: float = SC.DEFAULT_RELATIVE_ERROR, suffix: str = SCALED_SUFFIX):
        super().__init__()
        self._set(inputCols=list(inputCols), relativeError=relativeError, suffix=suffix)

    def _fit(self, df: DataFrame) -> "IqrScalerModel":
        cols = self.getInputCols()
        ranges = SC.iqr(df, cols, self.getOrDefault("relativeError"))
        m = IqrScalerModel()
        m._set(inputCols=cols, relativeError=self.getOrDefault("relativeError"),
               suffix=self.getOrDefault("suffix"), ranges=[float(ranges[c]) for c in cols])
        return m


class IqrScalerModel(Model, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted scaler: the saved quartile range per column."""
    ranges = Param(Params._dummy(), "ranges", "quartile range per input column",
                   typeConverter=TypeConverters.toListFloat)

    def __init__(self):
        super().__init__()
        self._setDefault(ranges=[])

    def outputCols(self) -> list[str]:
        return [c + self.getOrDefault("suffix") for c in self.getInputCols()]

    def rangeMap(self) -> dict[str, float]:
        return dict(zip(self.getInputCols(), self.getOrDefault("ranges")))

    def _transform(self, df: DataFrame) -> DataFrame:
        return SC.scale_columns(df, self.rangeMap(), self.getOrDefault("suffix"), drop_source=False)


def model_features(fitted: PipelineModel, available: Sequence[str] | None = None) -> list[str]:
    """The allow-list of model inputs, saved with the model (never 'all but the
    label'); base features absent from ``available`` (e.g. no gender column,
    so no flag) are left out."""
    onehot = next(s for s in fitted.stages if isinstance(s, CategoryOneHotModel))
    scaler = next(s for s in fitted.stages if isinstance(s, IqrScalerModel))
    base = [c for c in BASE_FEATURES if available is None or c in available]
    return base + onehot.outputCols() + scaler.outputCols()


# Values a sparse one-hot may have (its vocabulary is a driver-side list in the saved model).
SPARSE_MAX_CATEGORIES = 1_000_000
SPARSE_COL = "category_onehot"


def sparse_one_hot(vocabulary: Sequence[str], input_col: str = "category", output_col: str = SPARSE_COL) -> list:
    """Fitted stages from a category column to one sparse vector column of k - 1 slots
    in vocabulary order, the first value being the dropped baseline.

    The baseline gets the last index, the encoder's last slot goes to unseen and NULL
    values, and the slicer drops the baseline's: those rows are all zeros, as in the
    dense form. A row costs one entry instead of k - 1 columns."""
    if len(vocabulary) < 2:
        raise ValueError("a sparse one-hot needs at least two category values")
    index, slots = f"{output_col}_index", f"{output_col}_slots"
    indexer = StringIndexerModel.from_labels([*vocabulary[1:], vocabulary[0]], inputCol=input_col, outputCol=index, handleInvalid="keep")
    encoder = OneHotEncoder(inputCols=[index], outputCols=[slots], dropLast=True, handleInvalid="error")
    spark = SparkSession.getActiveSession()
    # the encoder only learns the number of indices, which the indexer's column states
    encoder = encoder.fit(indexer.transform(spark.createDataFrame([(vocabulary[0],)], f"{input_col} string")))
    return [indexer, encoder, VectorSlicer(inputCol=slots, outputCol=output_col, indices=list(range(len(vocabulary) - 1)))]


def fit_features(df: DataFrame, relative_error: float = SC.DEFAULT_RELATIVE_ERROR,
                 handle_invalid: str = "keep", features_col: str = "features", one_hot: str = "dense") -> PipelineModel:
    """Fit vocabulary and quartiles on ``df``; return stages ending in the assembler.

    ``one_hot``: ``dense`` (named 0/1 columns, at most 10,000 values; what feature
    tables, requests by name and compiled models need) or ``sparse`` (one vector
    column, for vocabularies of thousands of values).

    The two fits are independent passes over the same rows and run at once. The
    assembler keeps every row (NULL becomes NaN): rows that cannot be scored are
    told by ``invalid_reason``, never dropped on the way.
    """
    if one_hot not in ("dense", "sparse"):
        raise ValueError(f"one_hot must be dense or sparse, not {one_hot!r}")
    base = TransactionFeatures()
    with_base = base.transform(df)
    with ThreadPoolExecutor(max_workers=2) as pool:
        scaler = pool.submit(IqrScaler(SCALED_SOURCES, relative_error).fit, with_base)
        if one_hot == "sparse":
            stages = sparse_one_hot(FE.fit_vocabulary(with_base, "category", SPARSE_MAX_CATEGORIES))
            scaled = scaler.result()
            names = [c for c in BASE_FEATURES if c in with_base.columns] + [SPARSE_COL, *scaled.outputCols()]
            assembler = VectorAssembler(inputCols=names, outputCol=features_col, handleInvalid=handle_invalid)
            return PipelineModel(stages=[base, *stages, scaled, assembler])
        onehot = pool.submit(CategoryOneHot().fit, with_base)
        fitted = PipelineModel(stages=[base, onehot.result(), scaler.result()])
    assembler = VectorAssembler(inputCols=model_features(fitted, with_base.columns),
                                outputCol=features_col, handleInvalid=handle_invalid)
    return PipelineModel(stages=list(fitted.stages) + [assembler])


def feature_table(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The wide numeric table (no vector) in the allow-list order."""
    feats = model.stages[-1].getInputCols()
    out = df
    for s in model.stages[:-1]:
        out = s.transform(out)
    return out.select(*keep, *feats)

"""Scorer kind (b): an MLlib pipeline.

RegexTokenizer (runs of letters, lower-cased) -> HashingTF -> IDF ->
multinomial LogisticRegression over the three sentiment classes. Training is
distributed (tree aggregation of gradients); scoring is ``model.transform``,
JVM only. Emotion is not modelled (NULL, as with include_emotion off).
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NUM_FEATURES = 1 << 18
MAX_LABELLED = 50_000  # labelled rows that a scorer is trained on


def labelled_documents(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, text, label) from the driver's ``labels``: toxic -> negative (0),
    quality without toxicity -> positive (2), otherwise neutral (1). At most
    ``max_rows``, those with the smallest hashes of their ids."""
    lab = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows).select("doc_id", F.when(F.col("toxic") == 1, 0.0)
                        .when(F.col("quality") == 1, 2.0).otherwise(1.0).alias("label"))
    return documents.select("doc_id", "text").join(lab, "doc_id")


class MLlibScorer:
    kind = "mllib"

    def __init__(self, model: PipelineModel | None = None, max_iter: int = 50, reg: float = 0.01):
        self.model = model
        self.max_iter = max_iter
        self.reg = reg

    def pipeline(self, text_col: str = "text") -> Pipeline:
        return Pipeline(stages=[
            RegexTokenizer(inputCol=text_col, outputCol="_tokens", pattern=r"[^\p{L}]+",
                           toLowercase=True),
            HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=NUM_FEATURES),
            IDF(inputCol="_tf", outputCol="_features"),
            LogisticRegression(featuresCol="_features", labelCol="label", family="multinomial",
                               maxIter=self.max_iter, regParam=self.reg,
                               probabilityCol="_probability", rawPredictionCol="_raw",
                               predictionCol="_prediction"),
        ])

    def fit(self, train: DataFrame, text_col: str = "text") -> "MLlibScorer":
        self.model = self.pipeline(text_col).fit(train.filter(F.col(text_col).isNotNull()))
        return self

    def class_scores(self, df: DataFrame, text_col: str, emotion: bool = True) -> DataFrame:
        if self.model is None:
            raise ValueError("fit the scorer first")
        cols = df.columns
        # The pipeline reads "text"; rows without text are not scored.
        src = df.withColumn("_mtext", F.coalesce(F.col(text_col), F.lit("")))
        stages = [self.model.stages[0].copy({self.model.stages[0].inputCol: "_mtext"}), *self.model.stages[1:]]
        scored = PipelineModel(stages).transform(src)
        ok = F.col(text_col).isNotNull()
        return scored.select(
            *cols,
            F.when(ok, vector_to_array("_probability")).alias("_sent_scores"),
            F.lit(None).cast("array<double>").alias("_emo_scores"),
            ok.alias("_scored"),
            F.lit(None).cast("double").alias("_latency_ms"))

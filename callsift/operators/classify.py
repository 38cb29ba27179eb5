"""Baseline intent classifier: TF-IDF over unigrams and bigrams, one linear SVM per class."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LinearSVC, OneVsRest, OneVsRestModel
from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame

from callsift.operators.terms import TfidfModel, fit_tfidf
from callsift.session import written


@dataclass(frozen=True)
class IntentClassifier:
    tfidf: TfidfModel
    labels: StringIndexerModel
    svm: OneVsRestModel

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """Add the predicted intent; runs in the row."""
        scored = self.svm.transform(self.tfidf.transform(df, "_features"))
        named = IndexToString(inputCol="_predicted", outputCol=out, labels=self.labels.labels)
        extra = [c for c in scored.columns if c not in df.columns]
        return named.transform(scored).drop(*extra)


def train_intent_classifier(
    train: DataFrame,
    text: str = "utterance",
    label: str = "intent_id",
    min_df: int = 2,
    max_df: float = 0.9,
    max_iter: int = 1000,
    reg: float | None = None,
    parallelism: int = 4,
) -> IntentClassifier:
    """Fit on rows that a split has made.

    The rows are written to the shared folder, as each step of each class is one pass over them;
    every fit stops at its tolerance, which it reaches long before ``max_iter``. ``reg`` defaults to 1 / rows, the
    strength of a unit penalty on the summed loss; features are unit rows and not rescaled.
    """
    train = written(train.select(text, label))
    n = train.count()
    tfidf = fit_tfidf(train, text, min_df=min_df, max_df=max_df)
    labels = StringIndexer(
        inputCol=label, outputCol="_label", stringOrderType="alphabetAsc"
    ).fit(train)
    rows = written(labels.transform(tfidf.transform(train, "_features")).select("_features", "_label"))
    svm = OneVsRest(
        classifier=LinearSVC(
            maxIter=max_iter, regParam=1.0 / n if reg is None else reg, standardization=False
        ),
        featuresCol="_features",
        labelCol="_label",
        predictionCol="_predicted",
        parallelism=parallelism,
    ).fit(rows)
    return IntentClassifier(tfidf, labels, svm)

"""Preprocessing stages (I1-I7): one builder for the three variants.

Order: label index, category indexes (optionally one-hot), vector assembly, optional scaling. Every stage is a
``pyspark.ml`` transformer, so fitting is distributed (StringIndexer counts labels with a grouped aggregation,
scalers use a one-pass summarizer).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler


def label_indexer(label_col: str, output_col: str = "label", handle_invalid: str = "skip") -> StringIndexer:
    """Labels ordered by frequency (descending), ties alphabetical; ``skip`` drops NULL/unseen labels."""
    return StringIndexer(inputCol=label_col, outputCol=output_col, handleInvalid=handle_invalid,
                         stringOrderType="frequencyDesc")


def preprocessing_stages(base: Sequence[str], engineered: Sequence[str] = (), categorical: Sequence[str] = (),
                         target_col: str | None = "Workout_Type", scaler: str | None = "standard",
                         one_hot: bool = False, label_col: str = "label", label_invalid: str = "skip",
                         indexed_suffix: str = "_indexed") -> list:
    """The stage list.

    ``scaler``: ``"standard"`` (I4, mean and std), ``"minmax"`` (I5) or ``None``; the assembler writes
    ``raw_features`` when scaling, else ``features``. ``one_hot`` adds I2 (``handleInvalid="keep"``) after indexing.
    ``target_col=None`` leaves the label alone (regression).
    """
    stages: list = []
    if target_col is not None:
        stages.append(label_indexer(target_col, label_col, label_invalid))
    cat_inputs = []
    for c in categorical:
        stages.append(StringIndexer(inputCol=c, outputCol=f"{c}{indexed_suffix}", handleInvalid="skip"))
        if one_hot:
            stages.append(OneHotEncoder(inputCol=f"{c}{indexed_suffix}", outputCol=f"{c}_ohe", handleInvalid="keep"))
            cat_inputs.append(f"{c}_ohe")
        else:
            cat_inputs.append(f"{c}{indexed_suffix}")
    out = "raw_features" if scaler else "features"
    stages.append(VectorAssembler(inputCols=[*base, *engineered, *cat_inputs], outputCol=out, handleInvalid="skip"))
    if scaler == "standard":
        stages.append(StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True))
    elif scaler == "minmax":
        stages.append(MinMaxScaler(inputCol="raw_features", outputCol="features"))
    elif scaler is not None:
        raise ValueError(f"unknown scaler {scaler!r}")
    return stages


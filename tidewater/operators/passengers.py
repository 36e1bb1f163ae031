"""Passenger lists: fills, titles, codes and feature vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.text import map_codes, title_of
from tidewater.operators import quality
from tidewater.staging import stage

# Codes of sex, port and title; anything else is -1.
SEX_CODES = {"male": 0, "female": 1}
PORT_CODES = {"C": 0, "Q": 1, "S": 2}
TITLES = ("Mr", "Mrs", "Miss", "Master", "Don", "Rev", "Dr", "Mme", "Ms", "Major", "Lady", "Sir", "Mlle", "Col", "Capt",
          "Countess", "Jonkheer", "Dona")
# The columns of the feature vector.
FEATURES = ("Pclass", "Sex", "Age", "SibSp", "Parch", "Fare", "Embarked", "title")


def prepare(df: DataFrame, with_survived: bool = True) -> DataFrame:
    """Fill the gaps, take the title from the name, turn texts into codes and build `features`."""
    df = stage(quality.fill_stat(df, "Fare", "mean"))
    df = stage(quality.fill_nearest_group(df, "PassengerId", "Embarked", "Fare"))
    keys = ["Pclass", *(["Survived"] if with_survived else []), "SibSp", "Parch", "Embarked"]
    df = quality.fill_group_mean(df, "Age", keys, half_even_int=True, overall_after=True).fillna("unknown", ["Cabin"])
    df = df.withColumn("title", title_of(F.col("Name")))
    coded = df.select(
        *[F.col(c) for c in df.columns if c not in ("Sex", "Embarked", "title")],
        map_codes(F.col("Sex"), SEX_CODES).alias("Sex"), map_codes(F.col("Embarked"), PORT_CODES).alias("Embarked"),
        map_codes(F.col("title"), {n: i for i, n in enumerate(TITLES)}).alias("title"))
    return coded.withColumn("features", F.array(*[F.col(c).cast("double") for c in FEATURES]))

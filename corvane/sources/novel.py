"""Names to look for in the novel that the co-occurrence jobs were made for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corvane.functions.text import fold_accents

# The names, as they are written in the text.
NAMES = [
    "Pavlovna", "Vasili Kuragin", "Helene", "Pierre", "Hippolyte", "Zherkov", "Captain Timokhin", "Alpatych",
    "Weyrother", "Mortemart", "Morio", "Bolkonskaya", "Nicholas", "Joseph Alexeevich", "Peronskaya",
    "Vasili Dmitrich", "Tikhon", "Dolgorukov", "Langeron", "Mikhaylovna", "Anatole Kuragin", "Dolokhov", "Stevens",
    "Countess Rostova", "Denisov", "Likhachev", "Lavrushka", "Miloradovich", "The Emperor", "Count Ilya Rostov",
    "Count Rostov", "Natasha", "Petya", "Sonya", "Drubetskoy", "Bonaparte", "Kirsten", "Dmitri",
    "Marya Lvovna Karagina", "Karagina", "Count Cyril", "Bilibin", "Repnin", "Bourienne", "Shinshin", "Jacquot",
    "Marya Dmitrievna", "Kuzmich", "Marya Fedorovna", "Anisya Fedorovna",
]

# Second names of an entity.
SAME = {"Count Ilya Rostov": "Count Rostov"}


def dictionary(spark: SparkSession) -> DataFrame:
    """(alias, entity), folded like the text."""
    rows = [(n, SAME.get(n, n)) for n in NAMES]
    named = spark.createDataFrame(rows, "alias string, entity string")
    return named.select(*[F.lower(fold_accents(F.col(c))).alias(c) for c in named.columns])

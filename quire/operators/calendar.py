"""The calendar dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST_DAY = dt.date(2005, 1, 1)
LAST_DAY = dt.date(2030, 12, 31)


def _season(month: Column) -> Column:
    # The publishing seasons.
    return (
        F.when(month <= 3, "Hiver")
        .when(month <= 6, "Printemps")
        .when(month == 7, "Été (prix littéraires)")
        .when(month <= 9, "Rentrée littéraire")
        .otherwise("Fin d'année (Noël)")
    )


def _described(days: DataFrame) -> DataFrame:
    d = F.col("date_id")
    month, quarter = F.month(d), F.quarter(d)
    return days.select(
        d,
        F.year(d).alias("annee"),
        month.alias("mois"),
        F.dayofmonth(d).alias("jour"),
        quarter.alias("trimestre"),
        F.when(quarter <= 2, 1).otherwise(2).alias("semestre"),
        F.dayofweek(d).alias("jour_semaine"),
        F.date_format(d, "EEEE").alias("nom_jour"),
        F.date_format(d, "MMMM").alias("nom_mois"),
        F.weekofyear(d).alias("semaine_annee"),
        _season(month).alias("saison_editoriale"),
        month.isin(8, 9).alias("est_rentree_litteraire"),
        (month == 12).alias("est_noel"),
    )


def calendar(spark: SparkSession, first: dt.date = FIRST_DAY, last: dt.date = LAST_DAY) -> DataFrame:
    """Every day from `first` to `last`, both included."""
    count = (last - first).days + 1
    days = spark.range(count).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("date_id")
    )
    return _described(days)


def calendar_covering(df: DataFrame, day: str) -> DataFrame:
    """The calendar of the whole years that the dates of `df` touch."""
    span = df.agg(F.min(day).alias("a"), F.max(day).alias("b"))
    first = F.trunc("a", "year").cast("date")
    last = F.date_add(F.add_months(F.trunc("b", "year"), 12), -1)
    return _described(span.select(F.explode(F.sequence(first, last)).alias("date_id")))

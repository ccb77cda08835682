"""Country metrics: threshold lists, pairwise comparison and regional averages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.functions.grades import average

# The compared metrics and their labels, in report order.
METRICS = {
    "score": "Happiness Score",
    "gdp_per_capita": "GDP Per Capita",
    "social_support": "Social Support",
    "healthy_life_expectancy": "Life Expectancy",
    "freedom_to_make_life_choices": "Freedom",
    "generosity": "Generosity",
    "perceptions_of_corruption": "Corruption Perception",
}


def countries_at_least(country: DataFrame, min_score: str = "5.0") -> DataFrame:
    return (
        country.filter(F.col("score") >= F.lit(min_score).cast("decimal(10,2)"))
        .orderBy(F.desc("score"), "overall_rank")
        .select(
            F.col("overall_rank").alias("rank"),
            F.col("country_or_region").alias("country"),
            F.col("score").alias("happiness_score"),
            "gdp_per_capita",
            "social_support",
            F.col("healthy_life_expectancy").alias("life_expectancy"),
        )
    )


def countries_above(country: DataFrame, score: str = "6.0") -> DataFrame:
    return country.filter(F.col("score") > F.lit(score).cast("decimal(10,2)")).orderBy(F.desc("score"), "overall_rank")


def compare_countries(country: DataFrame, first: str, second: str) -> DataFrame:
    """The metrics of two countries as rows, with their difference; an unknown name raises an error."""
    name = F.lower("country_or_region")
    metrics = F.struct(*METRICS)

    def metrics_of(wanted: str):
        hit = name == wanted.lower()
        return F.min_by(F.when(hit, metrics), F.when(hit, F.col("overall_rank")))

    pair = country.filter(name.isin(first.lower(), second.lower())).agg(
        metrics_of(first).alias("a"), metrics_of(second).alias("b")
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(label).alias("metric"),
                F.col(f"a.{column}").cast("decimal(10,2)").alias("country1_value"),
                F.col(f"b.{column}").cast("decimal(10,2)").alias("country2_value"),
                (F.col(f"a.{column}") - F.col(f"b.{column}")).cast("decimal(11,2)").alias("difference"),
            )
            for column, label in METRICS.items()
        ]
    )
    missing = F.col("a").isNull() | F.col("b").isNull()
    checked = F.when(missing, F.raise_error(F.lit("One or both countries not found"))).otherwise(rows)
    return pair.select(F.inline(checked))


def regional_averages(country: DataFrame, regions: DataFrame) -> DataFrame:
    """Mean metrics per region, given a dimension (country_or_region, region)."""
    sums = country.join(regions, "country_or_region").groupBy("region").agg(
        F.count("*").alias("countries"),
        *[F.sum(c).alias(f"{c}_sum") for c in METRICS],
        *[F.count(c).alias(f"{c}_n") for c in METRICS],
    )
    means = [average(F.col(f"{c}_sum"), F.col(f"{c}_n")).cast("decimal(10,2)").alias(f"avg_{c}") for c in METRICS]
    return sums.select("region", "countries", *means).orderBy("region")

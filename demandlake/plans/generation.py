"""The generator from model frame to written series and metadata."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlake.functions.calendar import add_periods
from demandlake.operators import generator as g
from demandlake.sources.csv import write_csv


def expected_series(models: DataFrame, start: datetime | str, length: int, output: str) -> DataFrame:
    """Every series and period with its expected count."""
    return g.seasonal_series(g.base_rate(models, start, output), start, length, output)


def generate(
    models: DataFrame,
    dependencies: DataFrame | None,
    dimensions: Sequence[str],
    start: datetime | str,
    length: int,
    output: str,
    seed: int = 42,
) -> DataFrame:
    """Counts of every series and period after dependencies, one column per dimension."""
    complete = g.fill_dimensions(models, dimensions)
    drawn = g.draw_counts(expected_series(complete, start, length, output), seed)
    if dependencies is not None:
        drawn = g.apply_dependencies(
            drawn, complete, g.fill_dimensions(dependencies, dimensions), length, seed, complete.count() * length
        ).withColumn("timestamp", add_periods(F.lit(start).cast("timestamp"), output, F.col("period")))
    return g.series_rows(drawn, dimensions)


def check_models(models: DataFrame, dependencies: DataFrame | None = None) -> None:
    """Raise when the models contradict themselves; looks at one offending row of each kind."""
    checks = {
        "seasonality of wrong length": g.wrong_seasonalities(models),
        "metadata bounds not positive or not ordered": g.wrong_metadata_bounds(models),
        "conflicting metadata": g.metadata_conflicts(g.metadata_entries(models)),
    }
    if dependencies is not None:
        checks["dependency without exactly one match"] = g.unmatched_dependencies(models, dependencies)
        checks["dependency without a chance"] = g.invalid_chances(dependencies)
    checks |= {
        "rate missing or negative": g.invalid_rates(models),
        "seasonality factor missing or negative": g.invalid_factors(models),
        "series given twice": g.duplicate_series(models),
    }
    for problem, offenders in checks.items():
        example = offenders.first()
        if example is not None:
            raise ValueError(f"{problem}: {example.asDict()}")


def write_generated(
    models: DataFrame,
    dependencies: DataFrame | None,
    dimensions: Sequence[str],
    attributes: Sequence[str],
    start: datetime | str,
    length: int,
    output: str,
    series_path: str,
    metadata_path: str,
    seed: int = 42,
) -> None:
    """Write the series and, when there is any, the metadata as CSV without headers."""
    check_models(
        g.fill_dimensions(models, dimensions),
        None if dependencies is None else g.fill_dimensions(dependencies, dimensions),
    )
    write_csv(
        generate(models, dependencies, dimensions, start, length, output, seed).withColumn(
            "timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
        ),
        series_path,
    )
    if attributes:
        write_csv(g.metadata_rows(g.metadata_entries(models), attributes), metadata_path)

"""All models over a set of landed tables, ready to be queried by name."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame

from pulseframe.operators import calendar, quality, samples
from pulseframe.plans import staging
from pulseframe.plans.models import materialize

# Key column of every model that is not a staging model.
DERIVED_KEYS = {
    "int_activity_samples_unpivoted": "sk",
    "int_activities_cardio_samples_pivoted": "sk",
    "int_activities_gps_samples_pivoted": "sk",
    "int_dates_spine": "date_day",
    "dim_dates": "date_day",
}
TABLES = {"dim_dates"}  # stored when published; every other model is a view


def build_models(
    landed: Mapping[str, DataFrame],
    bounds: DataFrame,
    today: Column,
    zone: str | None = None,
    series: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Lazy models by name.

    ``landed`` maps staging model names to current envelope tables; ``bounds`` is
    the one-row calendar range. ``series`` may be a stored
    :func:`~pulseframe.operators.samples.series_from_envelope`, which the three
    sample models then read instead of extracting it from the payloads each.
    """
    models = {f"stg_{name}": staging.stage(rows, name, zone) for name, rows in landed.items()}
    if series is None and "activity_details" in landed:
        series = samples.series_from_envelope(landed["activity_details"])
    if series is not None:
        models["int_activity_samples_unpivoted"] = samples.unpivot(series)
        models["int_activities_cardio_samples_pivoted"] = samples.cardio(series)
        models["int_activities_gps_samples_pivoted"] = samples.gps(series)
    spine = calendar.date_spine(bounds)
    models["int_dates_spine"] = calendar.describe_all(spine)
    models["dim_dates"] = calendar.dim_dates(spine, today)
    return models


def model_key(name: str, model: DataFrame) -> list[str]:
    """Columns that identify a row of a model; natural keys are unique per subject."""
    if name in DERIVED_KEYS:
        return [DERIVED_KEYS[name]]
    subject = ["subject_id"] if "subject_id" in model.columns else []
    return [*subject, staging.primary_key(name.removeprefix("stg_"))]


def test_models(models: Mapping[str, DataFrame]) -> DataFrame:
    """``unique`` and ``not_null`` on the key of every model."""
    return quality.data_test_report({n: (m, model_key(n, m)) for n, m in models.items()})


def publish(
    models: Mapping[str, DataFrame], path: str | None = None, rename: Callable[[str], str] = lambda name: name
) -> dict[str, DataFrame]:
    """Make the models queryable by name: views, and marts as tables under ``path`` if given."""
    return {
        rename(name): materialize(model, rename(name), "table", f"{path}/{name}")
        if path and name in TABLES
        else materialize(model, rename(name))
        for name, model in models.items()
    }

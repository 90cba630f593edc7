"""Admissions to length of stay: features, a model in time order, what drives it, and the load of resources."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from medlark.functions.storage import cut_lineage
from medlark.functions.types import col
from medlark.operators import columns, reports, sampling
from medlark.operators.clean import encode_codes
from medlark.plans.risk import StayRun, train_stay_model

# What is known on the day of admission, and how many drivers are listed.
CALENDAR = ["admission_month", "admission_weekday", "is_weekend"]
TOP = 10


class StayForecast(NamedTuple):
    features: list[str]
    run: StayRun
    top: DataFrame
    load: DataFrame


def forecast_stays(
    admissions: DataFrame, start: str, end: str, key: list[str], codes: dict[str, str], numbers: list[str],
    capacity: DataFrame, resource: str, calendar: list[str] = CALENDAR, top: int = TOP, **fit,
) -> StayForecast:
    """Days of stay learned from admissions.

    ``codes`` names the categories and their code columns, ``numbers`` the numeric features; with ``calendar`` they
    are the features, null as 0. Folds expand in the order of admission, so no model sees a later stay. ``load``
    sets the mean stay per resource against ``capacity`` (see :func:`medlark.operators.reports.utilization`). Rows
    without a known stay teach nothing and are left out. ``fit`` goes to :func:`train_stay_model`. Admissions are read once:
    what is used of them is stored, as a dozen scans follow, each of which would repeat the joins that they come from.
    """
    used = dict.fromkeys([*key, start, end, *codes, *numbers, resource])
    known = cut_lineage(admissions.where(col(start).isNotNull() & col(end).isNotNull()).select(*[col(c) for c in used]))
    coded = encode_codes(columns.stay_features(known, start, end), codes)
    features = [*numbers, *codes.values(), *calendar]
    run = train_stay_model(coded, features, "los_days", start, key, **fit)
    return StayForecast(features, run, sampling.top_features(run.importance, top),
                        reports.utilization(coded, capacity, resource, "los_days"))

"""Yearly statistics and the longevity forecast of a cleaned licence table."""

from permitry.operators import metrics
from permitry.operators.clean import with_origin
from permitry.operators.forecast import fit_stability, predict_trends
from permitry.operators.report import stability_records
from permitry.schemas import FORECAST_YEARS, ORIGIN_A, ORIGIN_B, STATISTICS_YEARS
from permitry.session import cut
from permitry.sinks.writers import write_metric

SCOPES = {"all": None, "van": ORIGIN_A, "tor": ORIGIN_B}


def statistics(licences, years=STATISTICS_YEARS):
    """All yearly statistics by name; lazy, each a small table."""
    return {
        "opens_per_year": metrics.opens_per_year(licences),
        "top5_opens_per_year": metrics.top_opens_per_year(licences),
        "closes_per_year": metrics.closes_per_year(licences),
        "top5_closes_per_year": metrics.top_closes_per_year(licences),
        "longevity_per_year": metrics.longevity_per_year(licences, years),
        "longevity_of_issued_per_year": metrics.longevity_of_issued_per_year(licences, years),
        "longevity_of_closed_per_year": metrics.longevity_of_closed_per_year(licences, years),
    }


def write_statistics(licences, out, scopes=("all", "van", "tor"), years=STATISTICS_YEARS):
    """Write every statistic of every scope under ``out``, from one pass over the licences."""
    kept = cut(metrics.compact(licences))
    for scope in scopes:
        origin = SCOPES[scope]
        rows = kept if origin is None else with_origin(kept, origin)
        for name, table in statistics(rows, years).items():
            in_order = metrics.by_year(table) if "year" in table.columns else table.orderBy(table.columns[1])
            write_metric(in_order, out, scope, name)


def forecast(licences, years=STATISTICS_YEARS, future=FORECAST_YEARS, **fitting):
    """Longevity of issued licences per city, the fitted model and the published predictions."""
    history = cut(metrics.longevity_of_issued_per_city(licences, years))
    model = fit_stability(history, **fitting)
    return history, model, stability_records(predict_trends(history, model, future))

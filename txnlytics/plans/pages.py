"""The data behind each report page, read from the store: name -> DataFrame.

Nothing runs until a table is used, so a page costs only what it shows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from txnlytics.operators import forecast, reports, storage
from txnlytics.params import SEVERITIES, Params
from txnlytics.sources.store import TableStore

_P = Params()


def enriched(store: TableStore) -> DataFrame:
    """Stored transactions with category name and colour."""
    return storage.attach_category(store.read("transactions"), store.read("categories"))


def dashboard(
    store: TableStore,
    category: str | None = None,
    status: str = "all",
    sort: str = "date_newest",
    p: Params = _P,
) -> dict[str, DataFrame]:
    rows = enriched(store)
    return {
        "kpis": reports.kpi_summary(rows, p),
        "top_category": reports.top_category(rows, p),
        "shares": reports.category_share(rows, p),
        "categories": reports.spend_by_category(rows, p),
        "monthly_total": reports.monthly_total(rows, p),
        "monthly_trend": reports.monthly_trend(rows, p),
        "category_options": reports.category_options(rows),
        "explorer": reports.txn_explorer(rows, category, status, sort),
        "explorer_footer": reports.explorer_footer(rows, category, status),
        "top_expenses": reports.top_expenses(rows, p),
        "rows": storage.transaction_rows(rows),
    }


def anomalies(
    store: TableStore, severities: Sequence[str] = SEVERITIES, search: str = "", sort: str = "amount"
) -> dict[str, DataFrame]:
    facts, found = store.read("transactions"), store.read("anomalies")
    flagged = storage.anomaly_summary(found, facts, store.read("categories"))
    return {
        "kpis": reports.anomaly_kpis(flagged),
        "scatter": reports.anomaly_scatter(facts, found),
        "cards": reports.anomaly_search(flagged, severities, search, sort),
        "footer": reports.anomaly_search_footer(flagged, severities, search),
        "rows": flagged,
    }


def forecasts(store: TableStore, month: str | None = None, p: Params = _P) -> dict[str, DataFrame]:
    """Saved forecasts of all months or of one (``yyyy-MM-dd``).

    A saved forecast has no trend of its own, so every card says it is stable.
    """
    saved = storage.forecast_summary(store.read("forecasts"), store.read("categories"))
    if month is not None:
        saved = saved.filter(F.col("forecast_month") == month)
    drawn = saved.withColumns({
        "trend": F.lit("stable"),
        "trend_note": F.lit("Based on historical linear trend"),
    })
    return {
        "overview": forecast.overview(saved),
        "alert": forecast.budget_alert(saved, p),
        "cards": forecast.forecast_cards(drawn, p),
        "table": forecast.forecast_table(saved),
    }

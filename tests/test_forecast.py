from datetime import date

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from txnlytics.operators import forecast

HISTORY = "year_month string, category string, total double, month_num int"
SPENT = "date date, amount int, category string"


def history(spark, totals, category="Food", start=1):
    rows = [(f"2024-{start + i:02d}", category, float(t), start + i) for i, t in enumerate(totals)]
    return spark.createDataFrame(rows, HISTORY)


def test_exact_line(spark):
    row = forecast.forecast(history(spark, [1000, 2000, 3000])).first()
    assert (row.predicted, row.lower_bound, row.upper_bound) == (4000.0, 4000.0, 4000.0)
    assert (row.slope, row.r2_score, row.mae, row.trend) == (1000.0, 1.0, 0.0, "increasing")
    assert row.trend_note == "Spending is rising by ~Rs 1,000 per month"
    assert row.forecast_month == date(2024, 4, 1) and row.history_months == 3
    assert [tuple(h) for h in row.history] == [("2024-01", 1000.0), ("2024-02", 2000.0), ("2024-03", 3000.0)]


def test_against_numpy(spark):
    y = np.array([120.5, 90.25, 200.0, 170.75, 60.0])
    x = np.arange(1, 6)
    slope, intercept = np.polyfit(x, y, 1)
    fit = slope * x + intercept
    row = forecast.forecast(history(spark, y)).first()
    assert row.predicted == pytest.approx(slope * 6 + intercept, abs=0.01)
    assert row.mae == pytest.approx(np.abs(y - fit).mean(), abs=0.01)
    assert row.r2_score == pytest.approx(1 - ((y - fit) ** 2).sum() / ((y - y.mean()) ** 2).sum(), abs=1e-4)
    assert row.trend == "stable"


def test_clamped_at_zero(spark):
    row = forecast.forecast(history(spark, [3000, 1500, 10])).first()
    assert row.predicted == 0.0 and row.lower_bound == 0.0 and row.trend == "decreasing"


def test_constant_series(spark):
    row = forecast.forecast(history(spark, [70, 70, 70])).first()
    assert (row.predicted, row.r2_score, row.trend) == (70.0, 1.0, "stable")


def test_two_months_are_skipped(spark):
    both = history(spark, [1, 2]).unionByName(history(spark, [1, 2, 3], "Rent"))
    assert [r.category for r in forecast.forecast(both).collect()] == ["Rent"]
    cover = forecast.coverage(both).first()
    assert (cover.months_of_data, cover.categories, cover.categories_forecast, cover.categories_skipped) == (3, 2, 1, 1)


def test_history_closes_gaps_and_excludes(spark):
    rows = [
        (date(2023, 12, 5), 10, "Food"), (date(2023, 12, 6), 5, "Food"), (date(2024, 3, 1), 7, "Food"),
        (date(2024, 1, 1), 9, "Salary & Income"), (date(2024, 1, 1), 9, "Transfer"), (date(2024, 1, 1), 9, None),
    ]
    got = forecast.monthly_history(spark.createDataFrame(rows, SPENT)).orderBy("month_num").collect()
    assert [tuple(r) for r in got] == [("2023-12", "Food", 15.0, 1), ("2024-03", "Food", 7.0, 2)]


def test_forecast_uses_the_categorys_own_last_month(spark):
    both = history(spark, [1, 2, 3], "Old").unionByName(history(spark, [1, 2, 3, 4, 5, 6], "New"))
    months = {r.category: r.forecast_month for r in forecast.forecast(both).collect()}
    assert months == {"Old": date(2024, 4, 1), "New": date(2024, 7, 1)}


def saved(spark, *predicted):
    rows = [(f"c{i}", float(v), "stable", "note", date(2024, 7, 1)) for i, v in enumerate(predicted)]
    return spark.createDataFrame(rows, "category string, predicted double, trend string, trend_note string, forecast_month date")


@pytest.mark.parametrize("amounts, level", [((150_000, 60_000), "high"), ((150_000,), "moderate"), ((100_000,), "good")])
def test_alert_levels(spark, amounts, level):
    assert forecast.budget_alert(saved(spark, *amounts)).first().level == level


def test_overview_ties_and_empty(spark):
    row = forecast.overview(saved(spark, 5, 5, 1)).first()
    assert (row.total_predicted, row.highest_category, row.lowest_category, row.forecasts) == (11.0, "c0", "c2", 3)
    assert forecast.overview(saved(spark, 5).limit(0)).first().total_predicted == 0.0


def test_cards(spark):
    rows = forecast.forecast_cards(saved(spark, 10, 60, 30)).collect()
    assert [(r.title, r.share_pct, r.band_color) for r in rows] == [
        ("C1", 60.0, "#EF4444"), ("C2", 30.0, "#F59E0B"), ("C0", 10.0, "#10B981")
    ]
    assert rows[0].hover == "→ note" and rows[0].color == "#CCCCCC"
    assert forecast.forecast_cards(saved(spark, 0)).first().share_pct == 0.0


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(0, 1e6), min_size=3, max_size=12))
def test_bounds_enclose_the_prediction(spark, totals):
    row = forecast.forecast(history(spark, totals)).first()
    assert 0 <= row.lower_bound <= row.predicted <= row.upper_bound

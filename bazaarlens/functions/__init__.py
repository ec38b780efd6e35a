"""Column expressions: money, ratios, dates, bands and great-circle distance."""

from .bands import band
from .dates import day, days_between, month_of, months_index, quarter_of, year_month
from .geo import haversine_km
from .numeric import exact, mean, money, money_out, pct, quotient, rounded

__all__ = [
    "band", "day", "days_between", "exact", "haversine_km", "mean", "money", "money_out",
    "month_of", "months_index", "pct", "quarter_of", "quotient", "rounded", "year_month",
]

"""Views over the published Gold tables.

The latest day comes from the dimension's partition folders, so a view reads one
day's folder and never derives the dimension again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from marketlake.operators import serving
from marketlake.schema import DIMENSION_SCHEMA, FACT_SCHEMA, TOP_N_DEFAULT, TOP_N_RANGE
from marketlake.session import child_folders
from marketlake.sources.tables import read_table


@dataclass(frozen=True)
class Gold:
    """The Gold tables of a warehouse and the queries the dashboard asks of them."""

    spark: SparkSession
    fact_path: str
    dimension_path: str

    def latest_day(self) -> str | None:
        days = [d[3:] for d in child_folders(self.spark, self.dimension_path)
                if d.startswith("dt=") and not d.endswith("__HIVE_DEFAULT_PARTITION__")]
        return max(days, default=None)

    def fact(self, dates: str | list[str] | None = None) -> DataFrame:
        return read_table(self.spark, self.fact_path, FACT_SCHEMA, dates)

    def current(self, as_of: str | None = None) -> DataFrame:
        """The dimension on ``as_of`` or on the latest day published."""
        day = as_of or self.latest_day()
        return read_table(self.spark, self.dimension_path, DIMENSION_SCHEMA, day if day else None)

    def top_n(self, n: int = TOP_N_DEFAULT, as_of: str | None = None) -> DataFrame:
        low, high = TOP_N_RANGE
        if not low <= n <= high:
            raise ValueError(f"n must lie between {low} and {high}")
        return serving.top_n(self.current(as_of), n)

    def kpis(self, as_of: str | None = None) -> DataFrame:
        return serving.kpis(self.current(as_of))

    def market_cap(self, n: int = TOP_N_DEFAULT, as_of: str | None = None) -> DataFrame:
        return serving.market_cap_view(self.top_n(n, as_of))

    def variation(self, n: int = TOP_N_DEFAULT, as_of: str | None = None) -> DataFrame:
        return serving.variation_view(self.top_n(n, as_of))

    def top_spread(self, n: int = TOP_N_DEFAULT, as_of: str | None = None) -> DataFrame:
        return serving.top_spread(self.top_n(n, as_of))

    def symbols(self) -> DataFrame:
        return serving.symbols(self.fact())

    def hourly_series(self, symbol: str, measure: str = "price", dates: str | list[str] | None = None) -> DataFrame:
        return serving.hourly_series(self.fact(dates), symbol, measure)

    def default_series(self, measure: str = "price", dates: str | list[str] | None = None) -> DataFrame:
        return serving.default_series(self.fact(dates), measure)

"""Table readers (driver parquet, CSV reviews, alert tables) and test adapters."""

from callpulse.sources.tables import DRIVER_TABLES, Tables

__all__ = ["DRIVER_TABLES", "Tables"]

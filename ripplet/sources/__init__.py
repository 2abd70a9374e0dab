from ripplet.sources.tables import read_table, TABLES
from ripplet.sources.bars import (daily_bars_from_lineitem, hourly_bars_from_events,
                                   ohlcv_bars, read_ohlcv_csv, clean_range)

__all__ = ["read_table", "TABLES", "daily_bars_from_lineitem", "hourly_bars_from_events",
           "ohlcv_bars", "read_ohlcv_csv", "clean_range"]

"""Where bars come from: files, or trades rolled up by day."""

from barloom.sources.files import read_bars
from barloom.sources.trades import bars_from_trades

__all__ = ["bars_from_trades", "read_bars"]

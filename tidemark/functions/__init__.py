"""Column -> Column building blocks."""
from tidemark.functions import calendar, paths, text, times

__all__ = ["calendar", "paths", "text", "times"]

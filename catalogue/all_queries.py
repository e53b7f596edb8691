"""Import every module that registers queries."""

from catalogue import chains, checks, exact, files, forecasts, models, panels, places, rows, stores  # noqa: F401

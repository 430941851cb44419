"""Panel analytics on Spark DataFrames.

Every operator takes DataFrames and returns a DataFrame. Only small things of a
bounded size reach the driver: row counts, the cut points of a global rank, and
the failed checks of a suite.
"""

from panelkit.config import GridLayout, PanelConfig

__all__ = ["GridLayout", "PanelConfig"]

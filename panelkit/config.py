"""Settings passed to the operators."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class PanelConfig:
    """Years and codes that the panel models share."""

    base_year: int
    recent_base_year: int
    last_full_year: int
    periods_per_year: int = 4
    top_n: int = 5
    national_code: str = "00"
    national_name: str = "National"
    # Decimal places to round period values to before a mean is taken; None
    # keeps all of them.
    value_scale: int | None = None
    # The index source begins with this year, whatever older rows it holds.
    index_first_year: int = 1


@dataclass(frozen=True)
class GridLayout:
    """Where things stand on a hierarchical sheet, and how they are spelt.

    Fixed values of the source format, counted from zero.
    """

    label_col: int = 1
    year_row: int = 11
    quarter_row: int = 13
    first_data_row: int = 14
    national_label: str = "TOTAL NACIONAL"
    footnote_prefix: str = "n.r:"
    not_representative: str = "n.r"
    year_pattern: str = r"Año\s+(\d{4})"
    quarter_pattern: str = r"^([1-4])º$"
    # Rows handled together when a sheet is cut into blocks; bounds the work of
    # one task whatever the length of the sheet.
    block_rows: int = 1_000_000


def layer_name(table: str, layer: str | None, default: str) -> str:
    """Qualified name of a table: the layer as given, else the default layer."""
    namespace = layer.strip() if layer is not None else default
    return f"{namespace}.{table}"

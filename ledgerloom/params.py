"""Every business parameter in one place."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from types import MappingProxyType

# --- Fixed values: results depend on these exact words and numbers -----------------------

ACCEPTED_STATUSES = (
    "delivered", "shipped", "canceled", "unavailable",
    "invoiced", "processing", "created", "approved",
)

VALID_SALE_STATUSES = ("delivered", "shipped", "invoiced", "processing", "approved")

CATEGORY_COST_RATIOS = {
    "cama_mesa_banho": "0.58",
    "beleza_saude": "0.45",
    "esporte_lazer": "0.62",
    "informatica_acessorios": "0.74",
    "relogios_presentes": "0.55",
    "moveis_decoracao": "0.60",
    "utilidades_domesticas": "0.63",
    "brinquedos": "0.57",
    "telefonia": "0.78",
    "automotivo": "0.68",
}

OPENING_STOCK_DAYS = 45
RESTOCK_INTERVAL_DAYS = 14
RESTOCK_COVER_DAYS = 21
REORDER_POINT_DAYS = 10
OVERSTOCK_DAYS = 60
MIN_OPENING_STOCK = 5

# --- End of fixed values ------------------------------------------------------------------


@dataclass(frozen=True)
class Params:
    # Landing
    lookback_days: int = 3
    max_days_per_run: int = 7
    accepted_statuses: tuple[str, ...] = ACCEPTED_STATUSES

    # Sales
    valid_statuses: tuple[str, ...] = VALID_SALE_STATUSES
    cost_ratios: Mapping[str, str] = field(
        default_factory=lambda: MappingProxyType(dict(CATEGORY_COST_RATIOS))
    )
    default_cost_ratio: str = "0.62"
    late_reprocess_days: int = 3

    # Inventory ledger
    opening_stock_days: int = OPENING_STOCK_DAYS
    restock_interval_days: int = RESTOCK_INTERVAL_DAYS
    restock_cover_days: int = RESTOCK_COVER_DAYS
    reorder_point_days: int = REORDER_POINT_DAYS
    overstock_days: int = OVERSTOCK_DAYS
    min_opening_stock: int = MIN_OPENING_STOCK

    # Checks, by model.column.test, whose failure is reported but does not fail the run
    warn_only: tuple[str, ...] = ()

    # Raw checks
    max_money: int = 1_000_000
    freshness_warn_hours: int = 36
    freshness_error_hours: int = 72

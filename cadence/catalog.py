"""The nine source tables: keys, load modes, foreign keys."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

MERGE = "merge"
REPLACE = "replace"


@dataclass(frozen=True)
class SourceTable:
    name: str
    key: tuple[str, ...]
    mode: str
    # (column, parent table, parent column)
    foreign_keys: tuple[tuple[str, str, str], ...] = ()

    @property
    def strategy_label(self) -> str:
        """Load-strategy label."""
        if self.mode == MERGE:
            return f"merge (upsert on {', '.join(self.key)})"
        return "replace (full refresh)"


# Catalogue order is the order the source lists its tables in.
SOURCE_TABLES: tuple[SourceTable, ...] = (
    SourceTable("customers", ("customer_id",), MERGE),
    SourceTable(
        "orders",
        ("order_id",),
        MERGE,
        (
            ("customer_id", "customers", "customer_id"),
            ("store_id", "stores", "store_id"),
            ("staff_id", "staffs", "staff_id"),
        ),
    ),
    SourceTable(
        "order_items",
        ("order_id", "item_id"),
        MERGE,
        (("order_id", "orders", "order_id"), ("product_id", "products", "product_id")),
    ),
    SourceTable(
        "staffs",
        ("staff_id",),
        REPLACE,
        (("store_id", "stores", "store_id"), ("manager_id", "staffs", "staff_id")),
    ),
    SourceTable("stores", ("store_id",), REPLACE),
    SourceTable("categories", ("category_id",), REPLACE),
    SourceTable(
        "products",
        ("product_id",),
        REPLACE,
        (("brand_id", "brands", "brand_id"), ("category_id", "categories", "category_id")),
    ),
    SourceTable(
        "stocks",
        ("store_id", "product_id"),
        REPLACE,
        (("store_id", "stores", "store_id"), ("product_id", "products", "product_id")),
    ),
    SourceTable("brands", ("brand_id",), REPLACE),
)

TABLES_BY_NAME = {t.name: t for t in SOURCE_TABLES}


def select_tables(only: Iterable[str] | None = None) -> list[SourceTable]:
    """The catalogue, or the part of it that is asked for.

    Case does not matter and names that are not in the catalogue are passed
    over, but a request in which none is known raises. Catalogue order.
    """
    asked = frozenset(name.casefold() for name in only or ())
    if not asked:
        return list(SOURCE_TABLES)
    if asked.isdisjoint(TABLES_BY_NAME):
        raise ValueError(f"the catalogue has none of {sorted(asked)}; it has {list(TABLES_BY_NAME)}")
    return [table for table in SOURCE_TABLES if table.name in asked]

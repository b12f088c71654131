"""The vault branch: staged orders to hubs, links and satellites."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from ..operators.vault import (
    LoadTime,
    Zones,
    load_hub,
    load_link,
    load_link_satellite,
    load_satellite,
)
from ..sources.staging import at_once, stage
from ..sources.vault_store import VaultStore, load_scope

HUBS = {
    "hub_customer": ("hk_customer", "customer_id"),
    "hub_order": ("hk_order", "order_id"),
    "hub_product": ("hk_product", "product_id"),
}
LINKS = {
    "link_customer_order": ("hk_customer_order", ("hub_customer", "hub_order")),
    "link_order_product": ("hk_order_product", ("hub_order", "hub_product")),
}
SATELLITES = {
    "sat_customer": ("hub_customer", {"name": "customer_name", "city": "customer_city"}),
    "sat_order": ("hub_order", {"amount": "order_amount", "status": "order_status"}),
    "sat_product": ("hub_product", {"name": "product_name", "category": "product_category"}),
}
LINK_SATELLITES = {
    "sat_order_product": ("link_order_product", "hk_order_product_link",
                          {"qty": "qty", "price": "price"}),
}

TABLES = [*HUBS, *LINKS, *SATELLITES, *LINK_SATELLITES]

#: The business key by which a stored table is laid out. Links and their satellites follow the
#: order, whose keys come in sequence.
ZONE_KEYS = {
    "hub_customer": "customer_id", "sat_customer": "customer_id",
    "hub_order": "order_id", "sat_order": "order_id",
    "hub_product": "product_id", "sat_product": "product_id",
    "link_customer_order": "order_id", "link_order_product": "order_id",
    "sat_order_product": "order_id",
}

Existing = Mapping[str, DataFrame | None]


def zones_of(table: str, width: int | None) -> Zones | None:
    return Zones(ZONE_KEYS[table], width) if width else None


def hub(stg: DataFrame, table: str, load_ts: LoadTime, existing: DataFrame | None = None,
        zone_width: int | None = None, once: bool = False) -> DataFrame:
    hk, bk = HUBS[table]
    return load_hub(stg, hk, bk, load_ts, existing, zones=zones_of(table, zone_width), once=once)


def link(stg: DataFrame, table: str, load_ts: LoadTime, existing: DataFrame | None = None,
         hubs: Existing | None = None, zone_width: int | None = None,
         once: bool = False) -> DataFrame:
    hk, ends = LINKS[table]
    return load_link(stg, hk, [HUBS[h] for h in ends], load_ts, existing,
                     [(hubs or {}).get(h) for h in ends], zones=zones_of(table, zone_width),
                     once=once)


def satellite(stg: DataFrame, table: str, load_ts: LoadTime, existing: DataFrame | None = None,
              parent: DataFrame | None = None, compare: str = "any",
              null_safe: bool = False, zone_width: int | None = None) -> DataFrame:
    hub_table, attrs = SATELLITES[table]
    hk, bk = HUBS[hub_table]
    return load_satellite(stg, hk, [bk], attrs, load_ts, existing, parent, compare=compare,
                          null_safe=null_safe, zones=zones_of(table, zone_width))


def link_satellite(stg: DataFrame, table: str, load_ts: LoadTime,
                   existing: DataFrame | None = None, parent: DataFrame | None = None,
                   compare: str = "any", null_safe: bool = False,
                   zone_width: int | None = None) -> DataFrame:
    link_table, hk, attrs = LINK_SATELLITES[table]
    link_hk, ends = LINKS[link_table]
    return load_link_satellite(stg, hk, [HUBS[h][1] for h in ends], attrs, load_ts, existing,
                               parent, link_hk, compare, null_safe, zones_of(table, zone_width))


def run_vault(stg: DataFrame, load_ts: LoadTime, existing: Existing | None = None,
              compare: str = "any", zone_width: int | None = None,
              tables: Sequence[str] = TABLES) -> dict[str, DataFrame]:
    """The rows one batch adds to each of `tables`.

    Hubs and links of the same batch hold every key staged with it, so nothing checks
    parents here. `stg` is read once per table and only for its columns: give a stored
    table. With `zone_width` the rows, and the `existing` ones, carry their zones, and the rows
    are gathered by them.
    """
    old, width = existing or {}, zone_width

    def added(table: str) -> DataFrame:
        if table in HUBS:
            return hub(stg, table, load_ts, old.get(table), width)
        if table in LINKS:
            return link(stg, table, load_ts, old.get(table), zone_width=width)
        if table in SATELLITES:
            return satellite(stg, table, load_ts, old.get(table), compare=compare,
                             zone_width=width)
        return link_satellite(stg, table, load_ts, old.get(table), compare=compare,
                              zone_width=width)

    return dict(zip(tables, at_once(added, tables)))


def load_vault(stg: DataFrame, store: VaultStore, load_ts: LoadTime,
               compare: str = "any", written: bool = False) -> None:
    """Append one batch to a store, hubs first. Repeating it, or finishing it after a
    failure, adds nothing twice. What the load staged is deleted with its end. Rows that are
    `written` already, as a stored table or some rows of one, are not written again."""
    with load_scope(store.spark):
        stored = stg if written else stage(stg, "stg_orders", store.spark, "zstd")
        existing = {t: store.stored(t) for t in TABLES}
        added = run_vault(stored, load_ts, existing, compare, store.zone_width)
        for layer in (HUBS, LINKS, [*SATELLITES, *LINK_SATELLITES]):
            at_once(lambda t: store.append(t, added[t], gathered=True), layer)

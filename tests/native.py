"""A small hand-made data set in the native raw schema, written as CSV files."""

from __future__ import annotations

import csv

from tradewind import schema

COLUMNS = {t: s.names for t, s in schema.RAW.items()}


def _order(oid, cid, status, bought, arrived=None, promised="2018-01-20 00:00:00"):
    return [oid, cid, status, bought, bought, None, arrived, promised]


ROWS = {
    "raw_orders": [
        # delivered exactly when promised, and one second after
        _order("o1", "c1", "delivered", "2018-01-05 10:00:00", "2018-01-20 00:00:00"),
        _order("o2", "c2", "delivered", "2018-01-06 10:00:00", "2018-01-20 00:00:01"),
        # delivered without a delivery time
        _order("o3", "c3", "delivered", "2018-02-28 00:00:00"),
        # nothing attached: no items, payments or reviews
        _order("o4", "c4", "delivered", "2018-02-28 00:00:01", "2018-03-01 00:00:00",
               "2018-03-20 00:00:00"),
        _order("o5", "c5", "canceled", "2018-03-01 09:00:00"),
        # March has no delivered order; the last one is on the 31st of May
        _order("o6", "c6", "delivered", "2018-05-31 00:00:00", "2018-06-02 00:00:00",
               "2018-06-20 00:00:00"),
        _order("o7", "c7", "delivered", "2018-04-10 08:30:00", "2018-04-12 00:00:00",
               "2018-04-20 00:00:00"),
    ],
    "raw_customers": [
        ["c1", "ana", "01000", "sao paulo", "SP"],
        ["c2", "ana", "20000", "rio", "RJ"],  # two ids in two cities: a tie
        ["c3", "bea", "01000", "sao paulo", "SP"],
        ["c4", "caio", "01000", "sao paulo", "SP"],
        ["c5", None, "99999", "nowhere", "XX"],  # unknown person and zip
        ["c6", "ana", "01000", "sao paulo", "SP"],
        ["c7", "bea", "01000", "sao paulo", "SP"],
        ["c8", "dora", "01000", "sao paulo", "SP"],  # never ordered
    ],
    "raw_order_items": [
        ["o1", 1, "p1", "s1", "2018-01-07 00:00:00", "100.00", "10.00"],
        ["o1", 2, "p2", "s1", "2018-01-07 00:00:00", "50.00", None],  # no freight
        ["o2", 1, "p3", "s1", "2018-01-08 00:00:00", "160.00", "0.00"],
        ["o3", 1, "p4", "s1", "2018-03-02 00:00:00", None, "5.00"],  # no price
        ["o6", 1, "p1", "s1", "2018-06-01 00:00:00", "10.00", "1.00"],
        ["o7", 1, "p-missing", "s1", "2018-04-12 00:00:00", "70.00", "7.00"],
        ["o-missing", 1, "p1", "s1", "2018-04-12 00:00:00", "1.00", "1.00"],
    ],
    "raw_order_payments": [
        ["o1", 1, "credit_card", 2, "100.00"],
        ["o1", 2, "voucher", 1, "50.00"],
        ["o1", 3, "voucher", 0, "10.00"],
        ["o2", 1, "boleto", 1, "160.00"],
        ["o3", 1, "boleto", 0, "5.00"],
        ["o6", 1, "debit_card", 1, "12.50"],
        ["o7", 1, "barter", 1, "77.00"],  # not a known type
    ],
    "raw_order_reviews": [
        ["r1", "o1", 5, "good, really", 'she said "yes"\nand left', "2018-01-21 00:00:00",
         "2018-01-22 00:00:00"],
        ["r2", "o1", 3, "", None, "2018-01-23 00:00:00", "2018-01-24 00:00:00"],
        ["r1", "o2", 4, None, None, "2018-01-25 00:00:00", "2018-01-26 00:00:00"],
        ["r3", "o5", 1, None, "late", "2018-03-09 00:00:00", "2018-03-10 00:00:00"],
    ],
    "raw_products": [
        ["p1", "brinquedos", 10, 100, 1, "500.00", "10.00", "10.00", "10.00"],
        ["p2", None, 10, 100, 1, "500.00", "10.00", "10.00", None],
        ["p3", "sem_nome", 10, 100, 1, None, "1.50", "2.00", "3.00"],  # untranslated
        ["p4", "casa_conforto_2", 10, 100, 1, "1.00", "1.00", "1.00", "1.00"],
    ],
    "raw_sellers": [["s1", "01000", "sao paulo", "SP"]],
    "raw_geolocation": [
        ["01000", "-23.5", "-46.6", "sao paulo", "SP"],
        ["01000", "-23.5", "-46.6", "sao paulo", "SP"],  # repeated row
        ["01000", "-23.6", "-46.7", "osasco", "SP"],  # tied city
        ["20000", "-22.9", "-43.2", "rio", "RJ"],
        ["20000", "12.0", "-43.2", "rio", "RJ"],  # outside the box
        ["30000", None, "-43.2", "bh", "MG"],
    ],
    "raw_category_translation": [
        ["brinquedos", "toys"],
        ["casa_conforto_2", "home_comfort_2"],
    ],
}


def _field(value) -> str:
    """Unquoted empty for NULL, quoted text otherwise, quotes doubled."""
    if value is None:
        return ""
    return '"' + str(value).replace('"', '""') + '"'


def write(folder: str) -> dict[str, str]:
    paths = {}
    for table, rows in ROWS.items():
        paths[table] = f"{folder}/{table}.csv"
        mark = "﻿" if table == "raw_category_translation" else ""
        with open(paths[table], "w", encoding="utf-8", newline="") as out:
            out.write(mark + ",".join(COLUMNS[table]) + "\n")
            for row in rows:
                out.write(",".join(_field(v) for v in row) + "\n")
    return paths


def read_back(path: str) -> list[dict]:
    with open(path, encoding="utf-8-sig", newline="") as f:
        return list(csv.DictReader(f))

"""Eight sample documents in long form (fixed values), and the index they are loaded into."""

import uuid

from sieveline import DocumentIndex

LONG = (
    "doc_id string, seq bigint, name string, type string, values array<string>, searchable boolean, "
    "filterable boolean, retrievable boolean, suggestable boolean, collection boolean"
)
ITEMS = [
    ("Item-1", "Sample Product", "Red", "2017-04-28T15:24:31.180Z", 2, "0,0", None, {"USD/default": 123.23}),
    ("Item-2", "Red Shirt 2", "Red", "2017-04-27T15:24:31.180Z", 4, "0,10", None,
     {"USD/default": 200.0, "USD/sale": 99.0, "EUR/sale": 300.0}),
    ("Item-3", "Red Shirt", "Red", "2017-04-26T15:24:31.180Z", 3, "0,20", None, {"USD/default": 10.0}),
    ("Item-4", "Black Sox", "Black", "2017-04-25T15:24:31.180Z", 10, "0,30", None,
     {"USD/default": 243.12, "USD/super-sale": 89.0}),
    ("Item-5", "Black Sox2", "Silver", "2017-04-24T15:24:31.180Z", 20, "0,40", None, {"USD/default": 700.0}),
    ("Item-6", "Blue Shirt", "Blue", "2017-04-23T15:24:31.180Z", 10, "0,50", "Blue Shirt 2", {"USD/default": 23.12}),
    ("Item-7", "Blue Shirt", "Blue", "2017-04-23T15:24:31.180Z", 10, "0,50", "Blue Shirt 2", {"USD/default": 23.12}),
    ("Item-8", "Blue Shirt", "Blue", "2017-04-23T15:24:31.180Z", 10, "0,50", "Blue Shirt 2", {"USD/default": 23.12}),
]


def row(doc, seq, name, kind, values, **flags):
    given = {"searchable": False, "filterable": True, "retrievable": True, "suggestable": False, "collection": False}
    return (doc, seq, name, kind, [str(v) for v in values], *{**given, **flags}.values())


def item_rows(seq, item):
    doc, name, color, date, size, place, name2, prices = item
    make = lambda *a, **f: row(doc, seq, *a, **f)
    rows = [
        make("Name", "String", [name], suggestable=True),
        make("Color", "String", [color]),
        make("Content", "String", [name, color], searchable=True, filterable=False, collection=True),
        make("Code", "String", [doc]),
        make("Size", "Integer", [size]),
        make("Date", "DateTime", [date]),
        make("Location", "GeoPoint", [place]),
        make("Catalog", "String", ["Goods", "Stuff"], collection=True),
        make("NumericCollection", "Integer", [size, 10, 20], collection=True),
        make("Is", "String", ["Priced", color, doc], collection=True),
        make("StoredField", "String", ["This value is only stored."], filterable=False),
        make("HasMultiplePrices", "Boolean", [str(len(prices) > 1).lower()]),
    ]
    by_currency = {}
    for where, amount in prices.items():
        currency, price_list = where.split("/")
        rows.append(make(f"Price_{currency}_{price_list}", "Decimal", [amount], collection=True))
        by_currency.setdefault(currency, []).append(amount)
    rows += [make(f"Price_{c}", "Decimal", v, collection=True) for c, v in by_currency.items()]
    if name2:
        rows += [make("Name 2", "String", [name2]), make("Date (2)", "DateTime", ["2020-01-01T00:00:00Z"])]
    return rows


def documents(spark, items):
    rows = [r for seq, item in enumerate(items) for r in item_rows(seq, item)]
    return spark.createDataFrame(rows, LONG)


def new_index(spark, root, scope="Shop", doc_type="Item"):
    database = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/{database}'")
    return DocumentIndex(spark, database, scope, doc_type)


def loaded_index(spark, root):
    index = new_index(spark, root, "Test")
    reports = [
        index.index(documents(spark, ITEMS[:5])),
        index.index(documents(spark, ITEMS[5:])),
        index.remove(spark.createDataFrame([("Item-7",), ("Item-8",)], "__id string")),
    ]
    return index, reports

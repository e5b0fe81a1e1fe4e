"""Column layouts of the two kinds of monthly price list.

The header names, file names and field order below are fixed values: they are
what the published files contain.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Layout:
    """How one kind of snapshot file is read and keyed."""

    file_date: str
    required: dict[str, list[str]]
    optional: dict[str, list[str]]
    metrics: list[str]
    punctuated: list[str]
    base: list[str]
    signature: list[str]
    currency_sign: bool = False
    keep_unpriced: bool = False
    day_digits: str = field(default="2")

    @property
    def fields(self) -> list[str]:
        return [*self.required, *self.optional]

    @property
    def texts(self) -> list[str]:
        return [f for f in self.fields if f not in self.metrics]


BASE = ["drug", "item_code", "form", "formulary", "program", "pack_qty"]

REQUIRED_HEADERS = {
    "item_code": ["item code"],
    "drug": ["legal instrument drug", "drug name"],
    "form": ["legal instrument form"],
    "formulary": ["formulary"],
    "program": ["program"],
    "pack_qty": ["pack quantity", "pack qty"],
    "aemp": ["aemp"],
}

SINGLE_PRICE = Layout(
    file_date=r"(?i)ex-manufacturer-prices-non-efc-([0-9]{4}-[0-9]{2}-[0-9]{2})\.(?:csv|parquet)(?:/[^/]*)?$",
    required=REQUIRED_HEADERS,
    optional={
        "moa": ["legal instrument moa", "moa"],
        "brand": ["brand name", "brand"],
        "manufacturer": ["manufacturer code", "mfr code"],
        "responsible": ["responsible person", "sponsor"],
        "pricing_qty": ["pricing quantity"],
        "max_qty": ["maximum quantity", "max quantity", "max qty"],
        "max_repeats": ["maximum repeats", "max repeats"],
        "amt_pack": ["amt trade product pack", "amt trade product", "trade product pack"],
    },
    metrics=["aemp"],
    punctuated=[
        "item_code", "drug", "form", "formulary", "program", "pack_qty",
        "brand", "responsible", "amt_pack",
    ],
    base=BASE,
    signature=[
        "moa", "brand", "manufacturer", "responsible",
        "pricing_qty", "max_qty", "max_repeats", "amt_pack",
    ],
)

MULTI_PRICE_IDENTITY = [
    "item_code", "drug", "form", "moa", "brand", "formulary", "program", "manufacturer",
    "responsible", "pack_qty", "pricing_qty", "vial_content", "max_qty", "max_repeats",
    "dispensing_rule", "dispensing_setting", "premium_type", "amt_pack",
]

MULTI_PRICE = Layout(
    file_date=r"ex-manufacturer-prices-efc-([0-9]{4}-[0-9]{2}-[0-9]{1,2})\.(?i:csv|parquet)(?:/[^/]*)?$",
    required=REQUIRED_HEADERS,
    optional={
        "moa": ["legal instrument moa", "moa"],
        "brand": ["brand name", "brand"],
        "manufacturer": ["manufacturer code", "mfr code"],
        "responsible": ["responsible person", "sponsor"],
        "pricing_qty": ["pricing quantity"],
        "vial_content": ["vial content", "vial contents"],
        "max_qty": ["maximum amount", "max amount", "maximum quantity", "max quantity", "max qty"],
        "max_repeats": ["number repeats", "max repeats", "maximum repeats"],
        "dispensing_rule": ["dispensing rule mnemonic"],
        "dispensing_setting": ["dispensing setting"],
        "amt_pack": ["amt trade product pack", "amt trade product", "trade product pack", "tpp"],
        "pemp": ["pemp"],
        "exman_price_per_vial": [
            "ex-man price per vial", "exman price per vial", "ex manufacturer price per vial",
        ],
        "dpma": ["dpma"],
        "claimed_price_pack": ["claimed price for pack"],
        "claimed_price_vial": ["claimed price for vial"],
        "claimed_dpma": ["claimed dpma"],
        "premium": ["premium", "premium value"],
        "premium_type": ["premium type"],
    },
    metrics=[
        "aemp", "pemp", "exman_price_per_vial", "dpma",
        "claimed_price_pack", "claimed_price_vial", "claimed_dpma", "premium",
    ],
    punctuated=MULTI_PRICE_IDENTITY,
    base=BASE,
    signature=[*MULTI_PRICE_IDENTITY, "amt_pack_program"],
    currency_sign=True,
    keep_unpriced=True,
)

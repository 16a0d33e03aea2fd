"""Attribution of a reservation to hotel, locale, device, placement and point of sale.

Everything here is a native column expression, so it stays inside whole-stage codegen.
All functions return NULL for malformed text instead of failing under ANSI mode.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# --- Fixed values -------------------------------------------------------------------
# Patterns and codes that decide which booking belongs where.
HOTEL_IN_LABEL = "hotel[-](.*)[_]xqdz"
LOCALE_IN_LABEL = "[-]core(.*)[-]hotel"
MOBILE_IN_LABEL = "(linkmob[-]core.*[-]hotel)"
MOBILE_IN_NAME = "(Mobile)"
DEFAULT_LOCALE = "US"
DOTTED_NAME = "^(.*)[.](.*)[.].*"
POS_BEFORE_FIRST_DOT = r"(.*?)\."
POS_AFTER_ACCOUNT_4 = r"account_4_(.*?)\."
POS_AFTER_UNDERSCORE = "(.*)[_](.*)[.](.*)[.].*"
POS_AFTER_UNDERSCORE_GROUP = 2
PLACEMENT_CODES = {"LU": "localuniversal", "MR": "mapresults"}
DEVICE_CODES = {"PC": "desktop", "Mobile": "mobile", "Tablet": "tablet"}
LABEL_PLACEMENTS = ("mapresults", "localuniversal")
DEFAULT_CAMPAIGN = 66
MARKED_KEYS = ("placement", "hotel_id")
# ------------------------------------------------------------------------------------


def _code(column: Column, codes: dict[str, str]) -> Column:
    result = F.lit(None).cast("string")
    for raw, meaning in codes.items():
        result = F.when(column == raw, meaning).otherwise(result)
    return result


def hotel_from_label(label: Column, hotel_id: Column) -> Column:
    """the hotel clicked last, as the label tells it; else the hotel booked."""
    return F.coalesce(F.regexp_extract(label, HOTEL_IN_LABEL, 1).try_cast("int"), hotel_id)


def locale_from_label(label: Column) -> Column:
    """upper-case locale in the label, 'US' when there is none."""
    found = F.regexp_extract(label, LOCALE_IN_LABEL, 1)
    return F.when(F.length(found) > 0, F.upper(found)).otherwise(DEFAULT_LOCALE)


def device_from_label(label: Column, affiliate_name: Column) -> Column:
    """mobile when the label or the affiliate says so, else web."""
    return F.when(
        label.rlike(MOBILE_IN_LABEL) | affiliate_name.rlike(MOBILE_IN_NAME), "mobile"
    ).otherwise("web")


def distribution_from_name(name: Column) -> Column:
    """text before the last but one dot."""
    return F.regexp_extract(name, DOTTED_NAME, 1)


def placement_from_name(name: Column) -> Column:
    """text between the last two dots."""
    return F.regexp_extract(name, DOTTED_NAME, 2)


def silo_pattern(placements: list[str]) -> str:
    """Alternation of placements, as one capture group."""
    return "(" + "|".join(placements) + ")"


def distribution_from_silo(silo: Column, placements: list[str]) -> Column:
    """text before the last placement word in the silo name."""
    return F.regexp_extract(silo, "(.*)" + silo_pattern(placements), 1)


def placement_from_silo(silo: Column, placements: list[str]) -> Column:
    """the placement word in the silo name."""
    return F.regexp_extract(silo, "(.*)" + silo_pattern(placements), 2)


def pos_from_name(name: Column, pattern: str = POS_BEFORE_FIRST_DOT, group: int = 1) -> Column:
    """Point of sale inside an affiliate name; '' when the name does not match."""
    return F.regexp_extract(name, pattern, group)


def affiliate_country(name: Column) -> Column:
    """F8: second underscore part of the first dotted part."""
    return F.get(F.split(F.get(F.split(name, r"\."), 0), "_"), 1)


def affiliate_placement(name: Column) -> Column:
    """F8: placement word of the second dotted part."""
    return _code(F.get(F.split(name, r"\."), 1), PLACEMENT_CODES)


def affiliate_device(name: Column) -> Column:
    """F8: device word of the third dotted part."""
    return _code(F.get(F.split(name, r"\."), 2), DEVICE_CODES)


def _entry(key: str | Column, value: Column) -> Column:
    key = F.lit(key) if isinstance(key, str) else key
    return F.struct(key.alias("key"), value.cast("string").alias("value"))


def _item_entries(item: Column) -> Column:
    """Entries of one label item: 'key-value', or placement and hotel marks in other text."""
    parts = F.split(item, "-")
    lowered = F.lower(item)
    placement = F.lit(None).cast("string")
    for word in reversed(LABEL_PLACEMENTS):
        placement = F.when(lowered.contains(word), word).otherwise(placement)
    no_entries = F.array().cast("array<struct<key:string,value:string>>")
    marks = F.concat(
        F.when(placement.isNotNull(), F.array(_entry("placement", placement))).otherwise(
            no_entries
        ),
        F.when(
            lowered.contains("hotel-"),
            F.array(_entry("hotel_id", F.get(F.split(item, "hotel-"), 1))),
        ).otherwise(no_entries),
    )
    return F.when(F.size(parts) == 2, F.array(_entry(parts[0], parts[1]))).otherwise(marks)


def label_entries(label: Column) -> Column:
    """all (key, value) entries of a label in reading order."""
    return F.flatten(F.transform(F.split(label, "_"), _item_entries))


def entry_value(entries: Column, key: str) -> Column:
    """value of one key among entries; the last one wins, NULL when it is missing."""
    hits = F.filter(entries, lambda e: e["key"] == key)
    return F.try_element_at(hits, F.lit(-1))["value"]


def label_value(label: Column, key: str) -> Column:
    """value of one label key, straight from the text where that is possible.

    A plain key occurs only as a 'key-value' item, so one pattern finds its last item
    without taking the label apart, and the expression stays in generated code.
    """
    if key in MARKED_KEYS:
        return entry_value(label_entries(label), key)
    last_item = rf"(?s)^(?:.*_)?{re.escape(key)}-([^_-]*)(?:_.*)?$"
    return F.when(label.rlike(last_item), F.regexp_extract(label, last_item, 1))


def label_map(label: Column) -> Column:
    """the label as a map in which later entries replace earlier ones."""
    entries = label_entries(label)
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    values = F.transform(
        keys,
        lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"],
    )
    return F.map_from_arrays(keys, values)

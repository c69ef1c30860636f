"""Column expressions shared by the operators."""

from shopwright.functions.columns import (
    add_seconds,
    amount,
    money,
    money_sum,
    plain_number,
    epoch_micros,
    iso_text,
    json_text,
    map_value,
    padded_id,
    row_key,
    subcategory_id,
    title_case,
    whole_seconds,
)

__all__ = [
    "add_seconds",
    "amount",
    "money",
    "money_sum",
    "plain_number",
    "epoch_micros",
    "iso_text",
    "json_text",
    "map_value",
    "padded_id",
    "row_key",
    "subcategory_id",
    "title_case",
    "whole_seconds",
]

"""What each input file must deliver: canonical columns, accepted headers, keys and types."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class TableContract:
    """``headers`` maps a canonical column to the accepted headers, the preferred one first."""

    headers: Mapping[str, tuple[str, ...]]
    types: Mapping[str, str]
    key: tuple[str, ...] = ()
    integers: tuple[str, ...] = ()
    numbers: tuple[str, ...] = ()
    timestamps: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    surrogate: str | None = None


# The headers, types and keys of the five input files.
CONTRACTS: dict[str, TableContract] = {
    "users": TableContract(
        headers={
            "user_id": ("user_id", "id"),
            "name": ("name", "user_name", "full_name"),
            "email": ("email", "email_id"),
            "password": ("password", "pass"),
            "age": ("age",),
            "gender": ("gender", "sex"),
            "marital_status": ("marital_status", "marital"),
            "occupation": ("occupation",),
            "monthly_income": ("monthly_income", "income", "monthly_income_rs"),
            "educational_qualifications": (
                "educational_qualifications", "educational_qualification", "education", "education_qualifications",
            ),
            "family_size": ("family_size", "family_size_members"),
        },
        types={
            "user_id": "int", "name": "varchar(255)", "email": "varchar(255)", "password": "varchar(255)",
            "age": "smallint", "gender": "varchar(20)", "marital_status": "varchar(20)",
            "occupation": "varchar(100)", "monthly_income": "varchar(50)",
            "educational_qualifications": "varchar(150)", "family_size": "smallint",
        },
        key=("user_id",),
        integers=("user_id", "age", "family_size"),
    ),
    "restaurant": TableContract(
        headers={
            "restaurant_id": ("restaurant_id", "id", "r_id", "res_id"),
            "name": ("name", "restaurant_name"),
            "location": ("location", "city", "area"),
            "rating": ("rating", "rate", "aggregate_rating"),
            "num_ratings": ("num_ratings", "rating_count", "num_rating", "votes"),
            "cost_for_two": (
                "cost_for_two", "cost", "approx_cost_for_two", "approx_cost_for_two_people", "cost_for_two_people",
            ),
            "cuisine": ("cuisine", "cuisines"),
            "license_number": ("license_number", "lic_no", "license_no", "licence_number", "license"),
            "website_link": ("website_link", "link", "website", "url"),
            "address": ("address",),
        },
        types={
            "restaurant_id": "int", "name": "varchar(255)", "location": "varchar(255)", "rating": "decimal(3,1)",
            "num_ratings": "int", "cost_for_two": "decimal(10,2)", "cuisine": "varchar(150)",
            "license_number": "varchar(50)", "website_link": "varchar(500)", "address": "string",
        },
        key=("restaurant_id",),
        integers=("restaurant_id", "num_ratings"),
        numbers=("rating", "cost_for_two"),
    ),
    "food": TableContract(
        headers={
            "food_id": ("food_id", "f_id", "id"),
            "name": ("name", "item", "food_item", "food_name"),
            "veg_or_non_veg": ("veg_or_non_veg", "veg_non_veg", "veg_or_nonveg", "type"),
        },
        types={"food_id": "int", "name": "varchar(255)", "veg_or_non_veg": "varchar(20)"},
        key=("food_id",),
        integers=("food_id",),
    ),
    "menu": TableContract(
        headers={
            "menu_id": ("menu_id", "mn_id"),
            "restaurant_id": ("restaurant_id", "r_id", "res_id"),
            "food_id": ("food_id", "f_id"),
            "cuisine": ("cuisine", "cuisines"),
            "price": ("price",),
        },
        types={
            "menu_id": "int", "restaurant_id": "int", "food_id": "int", "cuisine": "varchar(150)",
            "price": "decimal(10,2)",
        },
        key=("restaurant_id", "food_id"),
        integers=("menu_id", "restaurant_id", "food_id"),
        numbers=("price",),
        foreign_keys=(
            ForeignKey("restaurant_id", "restaurant", "restaurant_id"),
            ForeignKey("food_id", "food", "food_id"),
        ),
    ),
    "orders": TableContract(
        headers={
            "order_datetime": ("order_datetime", "order_date", "datetime", "date"),
            "quantity": ("quantity", "sales_qty", "qty", "order_qty"),
            "sales_amount": ("sales_amount", "amount", "total_amount"),
            "currency": ("currency",),
            "user_id": ("user_id",),
            "restaurant_id": ("restaurant_id", "r_id", "res_id"),
        },
        types={
            "order_datetime": "timestamp_ntz", "quantity": "int", "sales_amount": "decimal(12,2)",
            "currency": "varchar(10)", "user_id": "int", "restaurant_id": "int",
        },
        integers=("quantity", "user_id", "restaurant_id"),
        numbers=("sales_amount",),
        timestamps=("order_datetime",),
        foreign_keys=(
            ForeignKey("user_id", "users", "user_id"),
            ForeignKey("restaurant_id", "restaurant", "restaurant_id"),
        ),
        surrogate="order_id",
    ),
}

# Parents come before the tables that point to them.
LOAD_ORDER = ("users", "restaurant", "food", "menu", "orders")


def spark_type(declared: str) -> str:
    """The Spark type of a declared column; text lengths are a check, not a storage type."""
    return "string" if declared.startswith("varchar") else declared

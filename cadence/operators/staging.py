"""Staging projections (S1-S9): one closed, typed ``select`` per raw table.

Load-trace columns never leave the raw layer: every projection names its
columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions.columns import (
    flag_is_one,
    null_text,
    safe_date,
    safe_long,
    to_long,
    to_price,
    to_rate,
)
from cadence.plans.datasets import dataset, raw_name


@dataset("stg_brands", "staging", [raw_name("brands")], ["brand_id"])
def stg_brands(raw_brands: DataFrame) -> DataFrame:
    return raw_brands.select(to_long("brand_id").alias("brand_id"), F.col("brand_name"))


@dataset("stg_categories", "staging", [raw_name("categories")], ["category_id"])
def stg_categories(raw_categories: DataFrame) -> DataFrame:
    return raw_categories.select(
        to_long("category_id").alias("category_id"), F.col("category_name")
    )


@dataset("stg_customers", "staging", [raw_name("customers")], ["customer_id"])
def stg_customers(raw_customers: DataFrame) -> DataFrame:
    return raw_customers.select(
        to_long("customer_id").alias("customer_id"),
        F.col("first_name"),
        F.col("last_name"),
        null_text("phone").alias("phone"),
        null_text("email").alias("email"),
        F.col("street"),
        F.col("city"),
        F.col("state"),
        to_long("zip_code").alias("zip_code"),
    )


@dataset("stg_order_items", "staging", [raw_name("order_items")], ["order_id", "item_id"])
def stg_order_items(raw_order_items: DataFrame) -> DataFrame:
    return raw_order_items.select(
        to_long("order_id").alias("order_id"),
        to_long("item_id").alias("item_id"),
        to_long("product_id").alias("product_id"),
        to_long("quantity").alias("quantity"),
        to_price("list_price").alias("list_price"),
        to_rate("discount").alias("discount"),
    )


@dataset("stg_orders", "staging", [raw_name("orders")], ["order_id"])
def stg_orders(raw_orders: DataFrame) -> DataFrame:
    return raw_orders.select(
        to_long("order_id").alias("order_id"),
        to_long("customer_id").alias("customer_id"),
        to_long("order_status").alias("order_status"),
        safe_date("order_date").alias("order_date"),
        safe_date("required_date").alias("required_date"),
        safe_date("shipped_date").alias("shipped_date"),
        to_long("store_id").alias("store_id"),
        to_long("staff_id").alias("staff_id"),
    )


@dataset("stg_products", "staging", [raw_name("products")], ["product_id"])
def stg_products(raw_products: DataFrame) -> DataFrame:
    return raw_products.select(
        to_long("product_id").alias("product_id"),
        F.col("product_name"),
        to_long("brand_id").alias("brand_id"),
        to_long("category_id").alias("category_id"),
        to_long("model_year").alias("model_year"),
        to_price("list_price").alias("list_price"),
    )


@dataset("stg_staffs", "staging", [raw_name("staffs")], ["staff_id"])
def stg_staffs(raw_staffs: DataFrame) -> DataFrame:
    return raw_staffs.select(
        to_long("staff_id").alias("staff_id"),
        F.col("first_name"),
        F.col("last_name"),
        null_text("email").alias("email"),
        null_text("phone").alias("phone"),
        flag_is_one("active").alias("active"),
        to_long("store_id").alias("store_id"),
        safe_long(null_text("manager_id")).alias("manager_id"),
    )


@dataset("stg_stocks", "staging", [raw_name("stocks")], ["store_id", "product_id"])
def stg_stocks(raw_stocks: DataFrame) -> DataFrame:
    return raw_stocks.select(
        to_long("store_id").alias("store_id"),
        to_long("product_id").alias("product_id"),
        to_long("quantity").alias("quantity"),
    )


@dataset("stg_stores", "staging", [raw_name("stores")], ["store_id"])
def stg_stores(raw_stores: DataFrame) -> DataFrame:
    return raw_stores.select(
        to_long("store_id").alias("store_id"),
        F.col("store_name"),
        null_text("phone").alias("phone"),
        null_text("email").alias("email"),
        F.col("street"),
        F.col("city"),
        F.col("state"),
        to_long("zip_code").alias("zip_code"),
    )

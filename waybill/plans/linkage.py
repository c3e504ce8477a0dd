"""Joins across entities: order to shipments to invoice, master data, order portal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions import first_filled
from waybill.plans.gold import one_shipment_per_order

C = F.col


def with_warehouse_names(moves: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Movements with the warehouse's name; unknown warehouses stay with an empty name."""
    names = warehouses.select("warehouse_id", "warehouse_name")
    return moves.join(names, "warehouse_id", "left").withColumn(
        "warehouse_name", first_filled(C("warehouse_name")))


def with_carrier_codes(shipments: DataFrame, carriers: DataFrame) -> DataFrame:
    return shipments.join(carriers.select("carrier_id", "scac"), "carrier_id", "left")


def orders_with_shipments(orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """Orders with delivery facts; shipments are reduced to one row per order beforehand."""
    facts = one_shipment_per_order(shipments).select(
        "order_number", "shipment_count", "first_ship_date", "last_delivery_date")
    return orders.join(facts, "order_number", "left").withColumn(
        "shipment_count", F.coalesce("shipment_count", F.lit(0)))


def order_portal(orders: DataFrame, shipments: DataFrame, invoices: DataFrame) -> DataFrame:
    """One row per order with shipment and invoice state, for a customer's own view.

    Joined on the order, never on the customer, so no row is multiplied.
    """
    facts = one_shipment_per_order(shipments).select(
        "order_number", "shipment_count", "last_delivery_date")
    bill = invoices.select("order_number", "invoice_number", "payment_status",
                           C("total_amount").alias("invoice_amount"), "amount_due")
    delivered = C("last_delivery_date").isNotNull()
    state = (F.when(delivered & (C("last_delivery_date") <= C("promised_delivery_date")),
                    "Delivered On Time")
             .when(delivered, "Delivered Late")
             .when(C("shipment_count") > 0, "In Delivery").otherwise("Not Shipped"))
    return (orders.join(facts, "order_number", "left").join(bill, "order_number", "left")
            .select("order_number", "customer_id", "customer_name", "order_date", "order_status",
                    "total_amount", F.coalesce("shipment_count", F.lit(0))
                    .alias("shipment_count"),
                    "last_delivery_date", state.alias("delivery_state"),
                    "invoice_number", "invoice_amount", "payment_status", "amount_due"))


def order_to_invoice(orders: DataFrame, invoices: DataFrame) -> DataFrame:
    """Orders with their invoice, if any, and the difference of the two amounts."""
    bill = invoices.select("order_number", "invoice_number", "invoice_date",
                           C("total_amount").alias("invoice_amount"))
    return orders.select("order_number", "customer_id", "total_amount").join(
        bill, "order_number", "left").withColumn(
        "difference", C("invoice_amount") - C("total_amount"))


def partner_filtered(gold: DataFrame, silver: DataFrame, key: str, predicate) -> DataFrame:
    """Rows of a KPI table whose key occurs among the silver rows that meet ``predicate``."""
    return gold.join(silver.filter(predicate).select(key), key, "left_semi")

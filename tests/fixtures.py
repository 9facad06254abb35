"""Hand-written raw tables (real-mode names) for unit tests."""

import datetime as dt

TS = "timestamp_ntz"


def ts(s):
    return dt.datetime.fromisoformat(s)


def one_order(spark):
    """One delivered order, two lines, one lane (the minimal chain):
    gmv 300, freight 30, lead 4 days, delivered one day before the ETA."""
    orders = spark.createDataFrame(
        [("o1", "c1", "delivered", ts("2024-01-01 10:00:00"), ts("2024-01-01 11:00:00"),
          ts("2024-01-02 10:00:00"), ts("2024-01-05 12:00:00"), ts("2024-01-06 12:00:00"))],
        f"order_id string, customer_id string, order_status string, order_purchase_timestamp {TS}, "
        f"order_approved_at {TS}, order_delivered_carrier_date {TS}, order_delivered_customer_date {TS}, "
        f"order_estimated_delivery_date {TS}")
    items = spark.createDataFrame(
        [("o1", 1, "p1", "s1", 100.0, 10.0), ("o1", 2, "p2", "s1", 200.0, 20.0)],
        "order_id string, order_item_id int, product_id string, seller_id string, price double, "
        "freight_value double")
    customers = spark.createDataFrame([("c1", "u1", "01001", "sao paulo", "SP")],
                                      "customer_id string, customer_unique_id string, "
                                      "customer_zip_code_prefix string, customer_city string, customer_state string")
    sellers = spark.createDataFrame([("s1", "20000", "rio", "RJ")],
                                    "seller_id string, seller_zip_code_prefix string, seller_city string, "
                                    "seller_state string")
    geo = spark.createDataFrame(
        [("01001", -23.55, -46.63, "sao paulo", "SP"), ("01001", -23.55, -46.63, "sao paulo", "SP"),
         ("20000", -22.90, -43.20, "rio", "RJ")],
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
        "geolocation_city string, geolocation_state string")
    payments = spark.createDataFrame([("o1", 1, "credit_card", 3, 330.0)],
                                     "order_id string, payment_sequential int, payment_type string, "
                                     "payment_installments int, payment_value double")
    reviews = spark.createDataFrame([("r1", "o1", 5, ts("2024-01-07 00:00:00"), ts("2024-01-08 00:00:00"))],
                                    f"review_id string, order_id string, review_score int, "
                                    f"review_creation_date {TS}, review_answer_timestamp {TS}")
    products = spark.createDataFrame([("p1", "Toys"), ("p2", None)], "product_id string, product_category_name string")
    return {
        "raw_orders": orders, "raw_order_items": items, "raw_customers": customers, "raw_payments": payments,
        "raw_reviews": reviews, "raw_products": products, "raw_sellers": sellers, "raw_geolocation": geo,
    }

"""Declared schemas, as DDL text, of the tables read from text formats or streams."""

from __future__ import annotations

RAW_ORDERS = (
    "order_id string, placed_at string, city string, restaurant_id string, courier_id string, status string, "
    "distance_km double, n_items int, subtotal_inr double, weather string, is_weekend boolean, "
    "courier_rating double, restaurant_prep_min_estimate double, promised_eta_min double, "
    "accepted_at string, courier_arrived_restaurant_at string, picked_up_at string, delivered_at string, "
    "cancelled_at string, actual_prep_min double, courier_wait_min double, rider_trip_distance_km double, "
    "tip_inr double, customer_rating_of_delivery double, courier_payout_inr double, eta_error_min double, "
    "sla_breach boolean"
)

FEATURE_STORE = (
    "restaurant_id string, city string, distance_km double, prep_min_estimate double, courier_rating double, "
    "promised_eta_min double, orders_seen long, computed_at string, distance_unit string"
)

LABEL_SHEET = (
    "order_id string, city string, hour int, weather string, distance_km double, n_items int, "
    "promised_eta_min double, actual_minutes double, acceptable string"
)

RUNS = (
    "name string, params map<string,string>, metrics map<string,double>, logged_at timestamp"
)

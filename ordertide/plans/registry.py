"""Name -> (Spark query, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ordertide.plans import oracle_sql as O
from ordertide.plans import queries as Q

QueryFn = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[QueryFn, str | None]] = {
    "enriched_orders": (Q.q_enriched_orders, O.enriched_orders()),
    "route_summary": (Q.q_route_summary, O.route_summary()),
    "valuable_customers": (Q.q_valuable_customers, O.valuable_customers()),
    "full_mini_cart": (Q.q_full_mini_cart, O.full_mini_cart()),
    "half_full_cart": (Q.q_half_full_cart, O.half_full_cart()),
    "topic_fanout": (Q.q_topic_fanout, O.topic_fanout()),
    "product_paths": (Q.q_product_paths, O.product_paths()),
    "credit_reservation": (Q.q_credit_reservation, O.credit_reservation()),
    "stock_reservation": (Q.q_stock_reservation, O.stock_reservation()),
    "credit_balance": (Q.q_credit_balance, O.credit_balance()),
    "stock_balance": (Q.q_stock_balance, O.stock_balance()),
    "order_decisions": (Q.q_order_decisions, O.order_decisions()),
    "settled_credit": (Q.q_settled_credit, O.settled_credit()),
    "settled_stock": (Q.q_settled_stock, O.settled_stock()),
    "settled_credit_as_coded": (Q.q_settled_credit_as_coded, O.settled_credit(Q.AS_CODED)),
    "settled_stock_as_coded": (Q.q_settled_stock_as_coded, O.settled_stock(Q.AS_CODED)),
    "interleaved_decisions": (Q.q_interleaved_decisions, O.interleaved_decisions()),
    "interleaved_balances": (Q.q_interleaved_balances, O.interleaved_balances()),
    "error_topic": (Q.q_error_topic, O.error_topic()),
    "click_purchase_hours": (Q.q_click_purchase_hours, O.click_purchase_hours()),
    "late_replies": (Q.q_late_replies, O.late_replies()),
    "latest_order_per_customer": (Q.q_latest_order_per_customer, O.latest_order_per_customer()),
    "latest_event_per_user": (Q.q_latest_event_per_user, O.latest_event_per_user()),
    "current_orders": (Q.q_current_orders, O.current_orders()),
    "customer_order_lookup": (Q.q_customer_order_lookup, O.customer_order_lookup()),
    "event_table": (Q.q_event_table, O.event_table()),
    "product_table": (Q.q_product_table, O.product_table()),
    "event_not_null": (Q.q_event_not_null, O.event_not_null()),
    "event_checks": (Q.q_event_checks, O.event_checks()),
    "committed_products": (Q.q_committed_products, O.committed_products()),
    "decoded_enriched_orders": (Q.q_decoded_enriched_orders, O.decoded_enriched_orders()),
    "ingested_plain_orders": (Q.q_ingested_plain_orders, O.decoded_enriched_orders(Q.LIM.with_(fault_count=None))),
    "malformed_counts": (Q.q_malformed_counts, O.malformed_counts()),
    "replayed_records": (Q.q_replayed_records, O.replayed_records()),
    "product_not_null": (Q.q_product_not_null, O.product_not_null()),
    "enriched_with_gaps": (Q.q_enriched_with_gaps, O.enriched_with_gaps()),
    "half_full_lookup": (Q.q_half_full_lookup, O.half_full_lookup()),
    "error_topic_guarded": (Q.q_error_topic_guarded, O.error_topic(Q.GUARDED)),
    "credit_balance_guarded": (Q.q_credit_balance_guarded, O.credit_balance(Q.LIM.with_(price_guard=150000))),
    "reply_records": (Q.q_reply_records, O.reply_records()),
    "decision_summary": (Q.q_decision_summary, O.decision_summary()),
}


def queries() -> dict[str, QueryFn]:
    return {k: fn for k, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in REGISTRY.items() if sql is not None}

"""Parameters of the order flow.

The reference hard-codes its business limits; here they are one frozen
dataclass so tests can use the original values and the driver tables can use
values scaled to their price range.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Limits:
    # Orders with a total strictly above this go to the valuable-customer route.
    valuable_threshold: int = 4000
    # Cart-size routes: >= full_cart -> full, >= half_full_cart -> half-full.
    full_cart: int = 10
    half_full_cart: int = 5
    # Injected enrichment fault: exactly this many products -> "/ by zero".
    # None disables the rule.
    fault_count: int | None = 4
    # Starting balance of a customer (credit) and of a market (items).
    initial_credit: int = 50000
    initial_items: int = 1000
    # Guards: price >= price_guard / productCount >= count_guard -> error row.
    price_guard: int = 100000
    count_guard: int = 2000
    # The decision step's own price guard; None: the same as price_guard.
    decision_price_guard: int | None = None
    # Both replies must lie within this many seconds of each other.
    join_window_seconds: int = 10
    # "release_holder": a ROLLBACK releases the side that did reserve.
    # "as_coded": a side releases when the ROLLBACK names itself as source.
    rollback_policy: str = "release_holder"
    # Redelivery: 1 try + max_retries retries.
    max_retries: int = 4

    def with_(self, **kw) -> "Limits":
        return replace(self, **kw)


# Fixed values of the reference (defaults of the services).
REFERENCE_LIMITS = Limits()

# The driver's tables carry TPC-H-like prices (up to ~750k per order), so money
# limits are scaled instead of the prices: threshold and credit x50, the price
# guard x5 so that the guard branch is exercised.
TABLE_LIMITS = Limits(
    valuable_threshold=200000,
    initial_credit=2500000,
    initial_items=1000,
    price_guard=500000,
)

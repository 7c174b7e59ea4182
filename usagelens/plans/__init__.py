"""The three products (P1-P3) and the combined job (P4)."""

from usagelens.plans.activity import activity_snapshot
from usagelens.plans.network import network_activity
from usagelens.plans.trends import rate_plan_trends

__all__ = ["activity_snapshot", "rate_plan_trends", "network_activity"]

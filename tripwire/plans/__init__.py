from tripwire.plans.driver import DRIVER_RULES, QUERIES, comparable_alerts, comparable_events
from tripwire.plans.oracle import ORACLE_SQL

__all__ = ["DRIVER_RULES", "ORACLE_SQL", "QUERIES", "comparable_alerts", "comparable_events"]

"""Job plans: a run over a set of broadcast days, composed from the operators."""

from stockout.plans.daily import DailyRun

__all__ = ["DailyRun"]

"""Which broadcasts a run covers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIVE_CHANNEL, DATA_CHANNEL = "C", "H"


@dataclass(frozen=True)
class Scope:
    """Broadcast days ('YYYYMMDD') and channels of a run; ``None`` means all of them.

    The reference runs one day and one channel at a time; here any set of days and both
    channels go through one plan, keyed by ``pgm_id`` (a broadcast belongs to one day).
    ``numeric_day_window`` reproduces the warehouse's day+1-as-a-number order window.
    """

    days: tuple[str, ...] | None = None
    channels: tuple[str, ...] | None = None
    numeric_day_window: bool = False

    def broadcasts(self, broadcast: DataFrame) -> DataFrame:
        out = broadcast
        if self.days is not None:
            out = out.where(F.col("broad_dt").isin(list(self.days)))
        if self.channels is not None:
            out = out.where(F.col("chanl_cd").isin(list(self.channels)))
        return out

    def order_day_bounds(self) -> tuple[str, str] | None:
        """Static [first, last] order day of the run, so the fact scan can prune files or
        partitions before the join (the per-broadcast window is applied after it)."""
        if self.days is None:
            return None
        import datetime as _dt
        first, last = min(self.days), max(self.days)
        if self.numeric_day_window:
            return first, str(int(last) + 1)
        nxt = _dt.datetime.strptime(last, "%Y%m%d") + _dt.timedelta(days=1)
        return first, nxt.strftime("%Y%m%d")


ALL = Scope()

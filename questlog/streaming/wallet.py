"""C05 under C06: the running wallet balance of a live log whose events arrive out of order.

Arbitrary state (``transformWithStateInPandas``) per slot, a hash of the user: the settled balances of its users, and
their events still waiting. A timer at the earliest waiting event's time fires when the
watermark has passed it; every waiting event up to the watermark then enters its user's balance in
(time, id) order and is emitted with it, once and for all. A waiting event lives as long as
the delay; what arrives behind the watermark is dropped by Spark, so replayed events that
were settled before are not counted twice, and those that still wait are recognised by their id.

State lies in the RocksDB store with its changelog in the checkpoint: a restarted query
goes on where it stopped. A slot's waiting events are one value, and so are its balances: a call to the state store
serves many users, no event or user is a call of its own. A batch writes the waiting events of every slot it reaches, so
the number of slots (fixed by the first start, as the number of state partitions is) should grow with the log.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.economy import DEFAULT_SOURCES, _signed_amount

# An event that only carries the time: it moves the watermark when a log falls silent.
HEARTBEAT = "heartbeat"
# Slots that users are dealt to, at least.
SLOTS = 256
# An event's columns in a slot: its user (empty: the NULL user), time, whether it has no id, id and amount.
EVENT = ["who", "micros", "unnamed", "event_id", "delta"]
ID = EVENT[:4]


def _millis(micros):
    """Milliseconds of times in microseconds, rounded up: the watermark has passed one when it has passed these."""
    return -(-micros // 1000)


def _packed(rows: pd.DataFrame) -> bytes:
    """A table as one value of the state store."""
    t = pa.Table.from_pandas(rows, preserve_index=False)
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, t.schema) as w:
        w.write_table(t)
    return out.getvalue().to_pybytes()


def _unpacked(value: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(value).read_all().to_pandas()


class WalletProcessor(StatefulProcessor):
    """State of one slot: its users' (who, gold), and its waiting events with the timer."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.settled = handle.getValueState("settled", "golds binary")
        self.waiting = handle.getValueState("waiting", "events binary, timer long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        came = pd.concat([r.loc[r["counts"], EVENT] for r in rows], ignore_index=True)
        if len(came):
            held, timer = self._waiting()
            # what comes again replaces what waits
            self._wait(came if held is None else pd.concat([held, came], ignore_index=True), timer)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, _ = self._waiting()
        due = _millis(held["micros"]) <= timerValues.getCurrentWatermarkInMs()
        self._wait(held[~due], 0)
        out = held[due].sort_values(ID, ascending=[True, True, False, True], kind="stable", ignore_index=True)
        had = self.settled.get()
        golds = _unpacked(had[0]).set_index("who")["gold"] if had else pd.Series(np.empty(0, np.int64), index=pd.Index([], dtype=object))
        out["balance"] = out.groupby("who", sort=False)["delta"].cumsum() + golds.reindex(out["who"], fill_value=0).to_numpy(np.int64)
        last = out.drop_duplicates("who", keep="last").set_index("who")["balance"]
        golds = pd.concat([golds[~golds.index.isin(last.index)], last])
        self.settled.update((_packed(pd.DataFrame({"who": golds.index, "gold": golds.to_numpy(np.int64)})),))
        yield out

    def _waiting(self) -> tuple[pd.DataFrame | None, int]:
        had = self.waiting.get()
        return (_unpacked(had[0]), had[1]) if had else (None, 0)

    def _wait(self, events: pd.DataFrame, timer: int) -> None:
        """Store the waiting events, each once, with one timer, at the earliest."""
        if not len(events):
            self.waiting.clear()
            return
        events = events.drop_duplicates(ID, keep="last")
        first = int(_millis(events["micros"].min()))
        if first != timer:
            if timer:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(first)
        self.waiting.update((_packed(events), first))

    def close(self) -> None:
        pass


def wallet_stream(ev: DataFrame, sinks: Mapping[str, Column | str | int], sources: Mapping[str, str] | None = None, delay: str = "2 days", user: str = "user_id", slots: int = SLOTS) -> DataFrame:
    """(user, event_ts, event_id, delta, balance): every event of the stream with the user's balance after it, emitted in
    order when the watermark has passed it (append mode). Events without a time take no part; the NULL user is a user."""
    src, snk = _signed_amount(dict(DEFAULT_SOURCES if sources is None else sources), sinks)
    delta = F.when(F.col("event_name") != HEARTBEAT, src - snk).cast("long").alias("delta")
    rows = ev.select(F.col(user).cast("string").alias("user_id"), "event_ts", F.unix_micros("event_ts").alias("micros"), F.col("event_id").cast("long").alias("event_id"), delta)
    # no NULL reaches pandas, whose whole numbers have none
    who = F.coalesce(F.concat(F.lit("="), "user_id"), F.lit(""))
    whole = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    counts = (F.col("micros").isNotNull() & F.col("delta").isNotNull()).alias("counts")
    slot = F.pmod(F.xxhash64("user_id"), F.lit(slots)).alias("slot")
    rows = rows.select(slot, "event_ts", who.alias("who"), whole("micros"), F.col("event_id").isNull().alias("unnamed"), whole("event_id"), whole("delta"), counts)
    settled = (
        rows.withWatermark("event_ts", delay)
        .groupBy("slot")
        .transformWithStateInPandas(WalletProcessor(), "who string, micros long, unnamed boolean, event_id long, delta long, balance long", "Append", "EventTime")
    )
    who = F.when(F.col("who") != "", F.substring("who", 2, 2**31 - 1)).alias("user_id")
    return settled.select(who, F.timestamp_micros("micros").alias("event_ts"), F.when(~F.col("unnamed"), F.col("event_id")).alias("event_id"), "delta", "balance")

"""Time order for keyed state.

Micro-batches need not arrive in event order (a rate-limited reader may split one commit of the feed). The rows of a key
wait in a state map with one entry per time block until the watermark reaches them; a timer per block then hands them
on, sorted. A backlog of any length, also one that the first batch brings before there is a watermark, is therefore
read, stored and handed on block by block: neither a state value nor a call ever holds more than one block or one Arrow
batch of the input.
"""
import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

#: Regular rows (bars) that share a block.
BLOCK_ROWS = 256
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def micros(times):
    return times.astype("datetime64[us]").astype("int64")


class InTimeOrder(StatefulProcessor):
    """Base of processors that take a key's rows in time order.

    ``columns`` maps the waiting columns to their types, ``time`` names the event time, ``schema`` is that of the
    key's own state. Subclasses give ``span(key)`` (microseconds of a block, whole milliseconds), ``start()`` (the state
    of a new key, a tuple) and ``take(key, state, rows)``, which returns (new state, rows to emit as a frame or None);
    ``rows`` are tuples (microseconds, *columns) in time order.
    """

    def __init__(self, columns, time, schema):
        self.columns, self.time, self.schema = columns, time, schema

    def init(self, handle):
        self.handle = handle
        fields = ["us array<long>", *[f"{c} array<{t}>" for c, t in self.columns.items()]]
        self.waiting = handle.getMapState("waiting", "block long", ", ".join(fields))
        self.own = handle.getValueState("own", self.schema)

    def handleInputRows(self, key, rows, timerValues):
        span = self.span(key)
        for chunk in rows:
            us = micros(chunk[self.time])
            for block, part in chunk.assign(_us=us).groupby(us // span):
                block = (int(block),)
                held = self.waiting.getValue(block) if self.waiting.containsKey(block) else ([],) * (1 + len(self.columns))
                first = int(part["_us"].min())
                new = [part["_us"].tolist(), *[part[c].tolist() for c in self.columns]]
                self.waiting.updateValue(block, tuple([*a, *b] for a, b in zip(held, new)))
                if not held[0] or first < min(held[0]):
                    self.handle.registerTimer(first // 1000 - 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        span, passed = self.span(key), timerValues.getCurrentWatermarkInMs() * 1000
        block = ((expiredTimerInfo.getExpiryTimeInMs() + 1) * 1000 // span,)
        if not self.waiting.containsKey(block):
            return
        rows = sorted(zip(*self.waiting.getValue(block)))
        ready, rest = [r for r in rows if r[0] <= passed], [r for r in rows if r[0] > passed]
        if rest:
            self.waiting.updateValue(block, tuple(list(x) for x in zip(*rest)))
            self.handle.registerTimer(rest[0][0] // 1000 - 1)
        else:
            self.waiting.removeKey(block)
        if ready:
            state, out = self.take(key, self.own.get() if self.own.exists() else self.start(), ready)
            self.own.update(state)
            if out is not None and len(out):
                yield out

    def handleInitialState(self, key, initialState, timerValues):
        """Stored rows of a key that were taken before the stream began; they emit nothing."""
        us = micros(initialState[self.time])
        rows = sorted(zip(us.tolist(), *[initialState[c].tolist() for c in self.columns]))
        state = self.seeded(key, initialState) if hasattr(self, "seeded") else self.start()
        self.own.update(self.take(key, state, rows)[0])

    def close(self):
        pass


def run(rows, keys, processor, schema, initial=None):
    """The output stream of a processor over ``rows`` (with a watermark) by ``keys``; ``initial`` is a stored frame
    with the same keys whose rows seed the state."""
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    return rows.groupBy(*keys).transformWithStateInPandas(
        processor, schema, "append", "eventTime", initialState=initial.groupBy(*keys) if initial is not None else None)


def frame(rows, columns):
    return pd.DataFrame(rows, columns=columns)

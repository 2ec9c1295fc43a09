"""Timers of expiring edge state, over a state that counts what is asked of it."""

from types import SimpleNamespace

from pyspark.sql import Row

from wayfleet.streaming.expiry import EdgeExpiry

TTL = 100


class Handle:
    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def exists(self):
        self.calls += 1
        return self.value is not None

    def update(self, value):
        self.calls, self.value = self.calls + 1, value

    def clear(self):
        self.calls, self.value = self.calls + 1, None

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.discard(at)


def arrive(edge, *states):
    return [tuple(e) for e in edge.handleInputRows(("e",), iter([Row(last_updated=t, is_congested=c) for t, c in states]), None)]


def fire(edge, at):
    return [tuple(e) for e in edge.handleExpiredTimer(("e",), None, SimpleNamespace(getExpiryTimeInMs=lambda: at))]


def test_events_follow_the_rows_and_untouched_state_costs_one_call():
    handle, edge = Handle(), EdgeExpiry(TTL)
    edge.init(handle)
    assert arrive(edge, (50, False), (10, True)) == [] and handle.value == (50, False) and handle.timers == {150}
    handle.calls = 0
    assert arrive(edge, (20, True), (50, False)) == [] and handle.calls == 1      # nothing newer
    assert arrive(edge, (50, True)) == [] and handle.value == (50, True) and handle.timers == {150}
    assert arrive(edge, (160, None)) == [("e", "expired", 150, 50), ("e", "unblocked", 150, 50)] and handle.timers == {260}
    assert fire(edge, 150) == [] and fire(edge, 260) == [("e", "expired", 260, 160)] and handle.value is None
    assert arrive(edge, (400, True)) == [] and handle.timers >= {500}
    assert fire(edge, 500) == [("e", "expired", 500, 400), ("e", "unblocked", 500, 400)]

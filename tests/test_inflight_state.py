"""The state of requests in flight: few messages however many requests, the same figures however it is cut."""

import random
from collections import Counter
from types import SimpleNamespace

import pandas as pd
import pytest

from loadlens.streaming import inflight

S = 1_000_000
TIMEOUT, TICK = 600 * S, 300 * S


class State:
    """A map or value state that counts the messages sent for it."""

    def __init__(self, messages, name):
        self.messages, self.name, self.held = messages, name, {}

    def _sent(self):
        self.messages[self.name] += 1
        return self.held

    def updateValue(self, key, value):
        self._sent()[key] = value

    def removeKey(self, key):
        del self._sent()[key]

    def iterator(self):
        return iter(list(self._sent().items()))

    def values(self):
        return iter(list(self._sent().values()))

    def clear(self):
        self._sent().clear()

    def get(self):
        return self._sent().get(None)

    def update(self, value):
        self._sent()[None] = value


class Handle:
    def __init__(self):
        self.messages, self.timers, self.states = Counter(), set(), {}

    def getMapState(self, name, key, value):
        return self.states.setdefault(name, State(self.messages, name))

    def getValueState(self, name, value):
        return self.getMapState(name, None, value)

    def registerTimer(self, at_ms):
        self.messages["timers"] += 1
        self.timers.add(at_ms)


def run(batches):
    """The rows that go out over micro-batches of ``(name, kind, at)``, without any delay."""
    handle, out, mark = Handle(), [], 0
    requests = inflight._Requests(TIMEOUT, TICK)
    requests.init(handle)
    for events in [*batches, []]:
        parts = [events[i : i + 500] for i in range(0, len(events), 500)]
        frames = [pd.DataFrame(p, columns=["request_id", "kind", "at_us"]) for p in parts]
        frames = [f.assign(is_sent=f.kind == inflight.SENT) for f in frames]
        if frames:
            out += requests.handleInputRows(("gpu", 3), iter(frames), None)
        time = SimpleNamespace(getCurrentWatermarkInMs=lambda: mark // 1000)
        for due in sorted(t for t in handle.timers if t <= mark // 1000):
            timer = SimpleNamespace(getExpiryTimeInMs=lambda due=due: due)
            out += requests.handleExpiredTimer(("gpu", 3), time, timer)
            handle.timers.remove(due)
        mark = max([mark, *(at for _, _, at in events)])
    return handle, pd.concat(out), mark // 1000 * 1000


def made(n, seconds):
    rng = random.Random(7)
    events = []
    for i in range(n):
        at = rng.randrange(seconds * S)
        events.append((f"r{i}", inflight.SENT, at))
        for after in rng.sample([5, 300, 599, 600, 601, 900], rng.randrange(3)):
            events.append((f"r{i}", inflight.ANSWERED, at + after * S))
    return sorted([*events, ("no request", inflight.ANSWERED, 400 * S)], key=lambda e: e[2])


def expected(events, mark):
    sent = {r: at for r, kind, at in events if kind == inflight.SENT}
    done = {}
    for r, kind, at in events:
        if kind == inflight.ANSWERED:
            done[r] = min(at, done.get(r, at))
    ends, levels = set(), Counter()
    for r, at in sent.items():
        answered = done.get(r, at + TIMEOUT + 1) <= at + TIMEOUT
        end = done[r] if answered else at + TIMEOUT
        if -(-end // TICK) * TICK <= mark:
            ends.add((r, at, end, "answered" if answered else "timeout"))
        levels.update(range(-(-at // TICK) * TICK, min(end, mark + 1), TICK))
    return ends, levels


def test_messages_do_not_grow_with_the_requests():
    handle, out, _ = run([made(5000, 3000)])
    assert out.request_id.notna().sum() > 3000
    assert sum(handle.messages.values()) < 100


@pytest.mark.parametrize("chunk", [7, 10_000])
@pytest.mark.parametrize("parts", [1, 9])
def test_same_figures_in_any_chunks_and_micro_batches(monkeypatch, chunk, parts):
    monkeypatch.setattr(inflight, "CHUNK_ROWS", chunk, raising=False)
    monkeypatch.setattr(inflight, "OUT_ROWS", 10 * chunk, raising=False)
    events = made(1500, 3000)
    cuts = [events[len(events) * k // parts : len(events) * (k + 1) // parts] for k in range(parts)]
    for cut in cuts:
        random.Random(1).shuffle(cut)
    _, out, mark = run(cuts)
    ends, levels = expected(events, mark)
    assert set(out.device) == {"gpu"} and set(out.bucket) == {3}
    found = out[out.request_id.notna()]
    assert sorted(zip(found.request_id, found.sent_us, found.end_us, found.outcome, strict=True)) == sorted(ends)
    ticks = out[out.tick_us.notna()]
    assert sorted(zip(ticks.tick_us, ticks.in_flight, strict=True)) == sorted(levels.items())

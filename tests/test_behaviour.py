import json
import random
from datetime import datetime, timedelta, timezone

import pandas as pd
import pytest
from pyspark.sql import functions as F

from brookhouse import schemas as S
from brookhouse.operators import behaviour as B
from brookhouse.streaming.visitors import _release_in_time
from tests.conftest import rows

COMMON = {"ar": "23", "uid": "u-5", "os": "Linux", "ch": "c", "is_new": "1", "md": "m", "mid": "device-a",
          "vc": "3.0", "ba": "b", "sid": "s"}
PAGE = {"page_id": "basket", "during_time": 1200, "last_page_id": "item"}
SHOWN = [{"pos_seq": i, "item": str(i), "item_type": "sku_id", "pos_id": 9} for i in range(3)]
ACTED = [{"action_id": "favor_add", "item": "8", "item_type": "sku_id", "ts": 1700000005000}]


def record(**kw):
    base = {"common": COMMON, "page": PAGE, "ts": 1700000100000} | kw
    return {k: v for k, v in base.items() if v is not None}


def visit(mid, is_new, ts):
    return record(common=COMMON | {"mid": mid, "is_new": is_new}, ts=ts)


def test_cleansing(lines):
    no_mid = {k: v for k, v in COMMON.items() if k != "mid"}
    raw = lines(record(), record(page=None, start={"entry": "icon"}), record(ts="1700000100001"),
                record(common=no_mid, ts=None), record(common=no_mid), record(ts=None), record(page=None),
                record(common=None), record(ts="soon"), json.dumps(record())[:-5], "", None)
    assert sorted(r["ts"] for r in rows(B.clean_log(raw))) == [1700000100000, 1700000100000, 1700000100001]


def flags(spark, lines, *visits, zone="UTC"):
    fixed = B.repair_visitors(B.clean_log(lines(*[visit(*v) for v in visits])), zone)
    return [r["is_new"] for r in rows(fixed.select(F.col("ts").alias("at"), F.col("common.is_new").alias("is_new")))]


DAY = 86_400_000
T0 = 1700000100000


def test_visitor_scenario(spark, lines):
    assert flags(spark, lines, ("m", "1", T0)) == ["1"]
    assert flags(spark, lines, ("m", "1", T0), ("m", "1", T0 + DAY)) == ["1", "0"]
    assert flags(spark, lines, ("m", "1", T0), ("m", "1", T0 + 1000)) == ["1", "1"]
    assert flags(spark, lines, ("m", "0", T0), ("m", "1", T0 + 1000)) == ["0", "0"]
    assert flags(spark, lines, ("m", "x", T0 - DAY), ("m", "1", T0), ("m", None, T0 + 1)) == ["x", "1", None]
    assert flags(spark, lines, ("m", "1", T0), ("n", "1", T0 + DAY)) == ["1", "1"]


def test_day_depends_on_the_zone(spark, lines):
    late = 1712160000000 - 1000  # 2024-04-03 15:59:59 UTC, a second before midnight at +08:00
    assert flags(spark, lines, ("m", "1", late), ("m", "1", late + 2000)) == ["1", "1"]
    assert flags(spark, lines, ("m", "1", late), ("m", "1", late + 2000), zone="Asia/Shanghai") == ["1", "0"]


def replay(visits):
    """The rule record by record."""
    first, out = {}, []
    for mid, is_new, ts in sorted(visits, key=lambda v: (v[2], v[1])):
        day = datetime.fromtimestamp(ts / 1000, timezone.utc).date()
        if is_new == "1":
            if first.setdefault(mid, day) != day:
                is_new = "0"
        elif is_new == "0":
            first.setdefault(mid, day - timedelta(days=1))
        out.append((mid, ts, is_new))
    return sorted(out)


def random_visits(seed, n=200):
    rnd = random.Random(seed)
    times = rnd.sample(range(T0, T0 + 4 * DAY, 60_000), n)
    return [(rnd.choice(["hot", "hot", "hot", "b", "c"]), rnd.choice(["0", "1", "1", "x"]), t) for t in times]


@pytest.mark.parametrize("seed", range(3))
def test_repair_equals_replay(spark, lines, seed):
    visits = random_visits(seed)
    fixed = B.repair_visitors(B.clean_log(lines(*[visit(*v) for v in visits])).repartition(4), "UTC")
    got = [(r.mid, r.ts, r.is_new) for r in fixed.select("common.mid", "ts", "common.is_new").collect()]
    assert sorted(got) == replay(visits)


@pytest.fixture
def split(lines):
    return B.clean_log(lines(
        record(displays=SHOWN, actions=ACTED, err={"error_code": 42, "msg": "e"}),
        record(page=None, start={"entry": "install", "loading_time": 10}, displays=SHOWN, err={"error_code": 1}),
        record(start={"entry": "icon"}),
        record(displays=[], actions=None),
    ))


def test_split(split):
    assert B.errors(split).columns == ["error_code", "msg"]
    assert [r["error_code"] for r in rows(B.errors(split))] == [1, 42]
    assert B.pages(split).columns == ["common", "page", "ts"] and B.pages(split).count() == 2
    assert "err" not in B.starts(split).columns
    assert sorted(len(r["displays"] or []) for r in rows(B.starts(split))) == [0, 3]
    shown = rows(B.displays(split))
    assert [r["pos_seq"] for r in shown] == [0, 1, 2]
    assert all(r["ts"] == T0 and r["page"]["page_id"] == "basket" and r["common"]["mid"] == "device-a" for r in shown)
    (acted,) = rows(B.actions(split))
    assert (acted["action_id"], acted["ts"]) == ("favor_add", T0)  # not the action's own time


def test_messages_equal_the_five_outputs(split):
    sent = rows(B.split_messages(split))
    by_topic = {}
    for m in sent:
        by_topic.setdefault(m["topic"], []).append(json.loads(m["value"]))
    want = {S.TRAFFIC_ERR: B.errors, S.TRAFFIC_START: B.starts, S.TRAFFIC_PAGE: B.pages, S.TRAFFIC_DISPLAY: B.displays,
            S.TRAFFIC_ACTION: B.actions}
    assert set(by_topic) == set(want)
    for topic, output in want.items():
        expected = [json.loads(r["v"]) for r in rows(output(split).select(F.to_json(F.struct("*")).alias("v")))]
        key = lambda d: json.dumps(d, sort_keys=True)
        assert sorted(by_topic[topic], key=key) == sorted(expected, key=key), topic


def test_log_is_parsed_once_for_all_topics(split):
    plan = B.split_messages(split)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_unknown_fields_reach_the_topics(lines):
    more = {"x": {"deep": [1, 2.5, None]}}
    raw = lines(record(common=COMMON | more, page=PAGE | more, displays=[SHOWN[0] | more], actions=[ACTED[0] | more], err={"error_code": 1} | more) | more,
                '{"common":{"mid":"m","mid":"twice"},"page":{"page_id":"p"},"ts":5}')
    log = B.repair_visitors(B.clean_log(raw), "UTC")
    got = {(r["topic"], json.loads(r["value"]).get("ts")): json.loads(r["value"]) for r in rows(B.split_messages(log))}
    context = {"common": COMMON | more, "page": PAGE | more, "ts": 1700000100000}
    assert got[S.TRAFFIC_PAGE, 1700000100000] == context | more
    assert got[S.TRAFFIC_DISPLAY, 1700000100000] == SHOWN[0] | more | context
    assert got[S.TRAFFIC_ACTION, 1700000100000] == ACTED[0] | more | context
    assert got[S.TRAFFIC_ERR, None] == {"error_code": 1} | more
    assert got[S.TRAFFIC_PAGE, 5]["page"] == {"page_id": "p"}


def test_messages_of_one_topic_are_built_alone(split):
    every = [tuple(r) for r in B.split_messages(split).collect()]
    for topic in B.TOPICS:
        alone = B.split_messages(split, (topic,))
        assert sorted(map(tuple, alone.collect())) == sorted(m for m in every if m[0] == topic) != []
        plan = alone._jdf.queryExecution().optimizedPlan().toString()
        assert all(other not in plan for other in B.TOPICS if other != topic)


def test_an_item_without_fields_of_its_own_has_its_context(lines):
    page = {"common": {"mid": "m", "is_new": "0"}, "page": {"page_id": "p"}, "ts": 1, "displays": [{}, {"ts": 5}, {"item": "i"}, 3, None]}
    got = [json.loads(r.value) for r in B.split_messages(B.clean_log(lines(page)), (S.TRAFFIC_DISPLAY,)).collect()]
    context = {k: page[k] for k in ("common", "page", "ts")}
    assert got == [context, context, {"item": "i"} | context]


class Held:
    """State of a group as the engine hands it over."""

    exists, hasTimedOut, timeout, get = False, False, None, None

    def getCurrentWatermarkMs(self):
        return 100

    def update(self, value):
        self.exists, self.get = True, value

    def setTimeoutTimestamp(self, ms):
        self.timeout = ms


def test_devices_of_a_bucket_share_a_call():
    step, state = _release_in_time(), Held()
    frame = pd.DataFrame([("a", 50, "1", "a50"), ("b", 60, None, "b60"), ("a", 40, "0", "a40"), ("b", 300, "1", "b300")],
                         columns=["mid", "ts", "is_new", "record"])
    (out,) = step((0,), iter([frame]), state)
    assert out.values.tolist() == [[80, "a40"], [80, "a50"], [-1, "b60"]] and state.timeout == 300
    state.getCurrentWatermarkMs, state.hasTimedOut = lambda: 300, True
    (out,) = step((0,), iter([]), state)
    assert out.values.tolist() == [[601, "b300"]]

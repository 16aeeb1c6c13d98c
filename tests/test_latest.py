"""Streaming last-writer-wins state against a batch over all records."""

import datetime as dt
import random

from pyspark.sql import Row, functions as F

from ledgerloom.operators.quality import keep_last
from ledgerloom.session import scratch_path
from ledgerloom.sources import archive
from ledgerloom.streaming import latest
from test_records import ORD

T = dt.datetime(2024, 1, 1, 11)


def raw(spark, *rows):
    """(client, id, hour, position, amount) as raw records."""
    return spark.createDataFrame(
        [(c, "Invoice", (T + dt.timedelta(hours=h), 0, p, 0), "{%s\"TotalAmt\":%d}" % (f'"Id":"{i}",' if i else "", v)) for c, i, h, p, v in rows],
        f"client_id string, source_name string, ord {ORD}, record string")


def test_triggers(spark):
    place, out, progress = (scratch_path(spark, n) for n in ("archive", "judged", "progress"))

    def trigger(*rows):
        archive.append(raw(spark, *rows), place)
        latest.follow(spark, place, out, progress).awaitTermination()
        found = latest.verdicts(spark, out)
        newest = found.agg(F.max("batch_id")).first()[0]
        return sorted((r.client_id, r.id or "-", F_amount(r.record), r.verdict) for r in found.where(F.col("batch_id") == newest).collect())

    def F_amount(record):
        return int(record.split(":")[-1].rstrip("}"))

    assert trigger(("a", "1", 5, 0, 10), ("a", "2", 5, 1, 20), ("b", "1", 5, 0, 30), ("a", "1", 4, 0, 9)) == [
        ("a", "1", 9, "passed"), ("a", "1", 10, "new"), ("a", "2", 20, "new"), ("b", "1", 30, "new")]
    # one late, one repeated, one newer, one without an id
    assert trigger(("a", "1", 3, 0, 8), ("a", "2", 5, 1, 20), ("b", "1", 6, 0, 31), ("a", None, 6, 0, 1), ("a", "3", 1, 0, 40)) == [
        ("a", "-", 1, "keyless"), ("a", "1", 8, "late"), ("a", "2", 20, "repeated"), ("a", "3", 40, "new"), ("b", "1", 31, "new")]
    # the newest twice in one batch, and an older one again
    assert trigger(("b", "1", 7, 2, 33), ("b", "1", 7, 2, 33), ("b", "1", 7, 1, 32), ("a", "1", 4, 0, 9)) == [
        ("a", "1", 9, "late"), ("b", "1", 32, "passed"), ("b", "1", 33, "new"), ("b", "1", 33, "repeated")]
    current = sorted((r.client_id, r.id or "-", F_amount(r.record)) for r in latest.current(latest.verdicts(spark, out)).collect())
    assert current == [("a", "-", 1), ("a", "1", 10), ("a", "2", 20), ("a", "3", 40), ("b", "1", 33)]


def test_any_order_gives_the_batch_result(spark):
    pick = random.Random(3)
    rows = [(pick.choice("ab"), str(pick.randrange(8)), pick.randrange(30), pick.randrange(3), n) for n in range(150)]
    rows = list({r[:4]: r for r in rows}.values())
    place, out, progress = (scratch_path(spark, n) for n in ("archive", "judged", "progress"))
    for at in range(0, len(rows), 60):
        archive.append(raw(spark, *rows[at : at + 60], *rows[:10]), place)
        latest.follow(spark, place, out, progress).awaitTermination()
    keys = ["client_id", "source_name", "id"]
    whole = keep_last(latest.with_id(archive.read(spark, place)), keys, [F.col(c) for c in latest.POSITION]).select(*keys, "record")
    got = latest.current(latest.verdicts(spark, out))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))


def test_a_key_of_many_records(spark):
    """A key's records are judged row by row, without a frame per key; a missing time is before all others."""
    rows = [Row(client_id="a", source_name="Invoice", id="1", micros=m, block=0, pos=0, item=0, record=str(m)) for m in (5, None, 7, 5)]
    judge = latest.NewestRecord()

    class Held:
        value = None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    judge.newest = Held()
    assert [r.verdict for r in judge.handleInputRows(("a", "Invoice", "1"), iter(rows), None)] == ["passed", "passed", "new", "repeated"]
    assert [r.verdict for r in judge.handleInputRows(("a", "Invoice", "1"), iter(rows), None)] == ["late", "late", "repeated", "repeated"]
    assert judge.newest.value[0] == 7


def test_a_slot_of_many_keys(spark, monkeypatch):
    """All keys in few slots: verdicts as the rule for one key gives them, copies, missing and large numbers included."""
    monkeypatch.setattr(latest, "SLOTS", 2)
    pick = random.Random(5)
    place, out, progress = (scratch_path(spark, n) for n in ("archive", "judged", "progress"))
    keys, big = ["client_id", "source_name", "id"], (1 << 60) + 1
    states = {}
    for batch in range(3):
        rows = [(pick.choice(["a", "b", None]), "Invoice", (pick.choice([None, T, T + dt.timedelta(hours=pick.randrange(4))]), 0, pick.choice([0, big, big + 1, None]), 0),
                 '{"Id":"%d"}' % pick.randrange(9)) for _ in range(120)]
        landed = spark.createDataFrame(rows, f"client_id string, source_name string, ord {ORD}, record string")
        archive.append(landed, place)
        latest.follow(spark, place, out, progress).awaitTermination()
        want = []
        groups = {}
        for row in latest.with_id(landed).collect():
            groups.setdefault(tuple(row[k] for k in keys), []).append(row)
        for key, held in groups.items():
            judge = latest.NewestRecord()
            judge.newest = latest_state(states, key)
            want += [tuple(r)[:8] for r in judge.handleInputRows(key, iter(held), None)]
        got = latest.verdicts(spark, out).where(F.col("batch_id") == batch).select(latest.COLUMNS[:8])
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def latest_state(states, key):
    class State:
        def get(self):
            return states.get(key)

        def update(self, value):
            states[key] = value
    return State()


def test_slots_are_read_and_written_once(spark):
    """A trigger asks the state for a slot, not for each key in it."""
    import pandas as pd

    asked = []

    class State:
        value = None

        def get(self):
            asked.append("get")
            return self.value

        def update(self, value):
            asked.append("update")
            self.value = value

    judge = latest.NewestRecords()
    judge.newest = State()
    frame = pd.DataFrame([(f"a{i}", "a", "Invoice", str(i), 1, 0, i, 0, 0, "{}") for i in range(500)],
                         columns=["key", "client_id", "source_name", "id", *latest.POSITION, "blank", "record"])
    for verdict in ("new", "repeated"):
        (got,) = judge.handleInputRows((0,), iter([frame[:200], frame[200:]]), None)
        assert list(got["verdict"]) == [verdict] * 500
    assert asked == ["get", "update", "get"]

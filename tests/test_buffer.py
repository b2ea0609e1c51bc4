"""Units that wait for a load: by rows, by age, and after a crash at every step."""

import pytest

from quayside.operators import ledger as L
from quayside.operators.load import load, read_target
from quayside.streaming import buffer
from quayside.streaming.stream import StreamSettingError, pending_units, stream_load
from quayside.types import spec

COLUMNS = spec(("id", "Int64"))


def ids(spark, path):
    return sorted(r["id"] for r in read_target(spark, path, COLUMNS).collect())


def writer(spark, path, book, writes):
    def write(rows, name):
        load(rows, path, COLUMNS, book, load_id=f"s-{name}", reread=True).close()
        writes.append(name)

    return write


def test_by_rows_and_by_age(spark, tmp_path):
    path, book, writes, now = str(tmp_path / "t"), str(tmp_path / "l"), [], [0.0]
    pending = buffer.Pending(spark, str(tmp_path / "p"), 25, 60.0, writer(spark, path, book, writes), lambda: now[0])
    assert not pending.flush() and not pending.flush_due()
    for k in range(5):
        pending.add(spark.range(k * 10, k * 10 + 10), k)
    assert writes == ["0-2"] and [u["number"] for u in pending.units()] == [3, 4]
    pending.add(spark.range(20, 30), 2)  # loaded already
    pending.add(spark.range(30, 40), 3)  # waits already
    now[0] = 59.0
    assert not pending.flush_due()
    now[0] = 60.0
    assert pending.flush_due() and writes == ["0-2", "3-4"] and ids(spark, path) == list(range(50))
    pending.add(spark.range(0), 5)  # an empty unit waits like any other
    assert pending.flush() and pending.done() == 5 and not pending.units()


@pytest.mark.parametrize("step", ["rows", "unit", "plan", "write", "loaded", "done", "clear"])
def test_a_crash_at_every_step(spark, tmp_path, monkeypatch, step):
    """The driver is lost once at a step; another takes over with the micro-batch that was not committed."""
    path, book, writes = str(tmp_path / "t"), str(tmp_path / "l"), []
    write = writer(spark, path, book, writes)
    broken = [True]

    def lost(at):
        if at == step and broken[0]:
            broken[0] = False
            raise KeyboardInterrupt(at)

    real_text, real_delete = buffer.Storage.write_text, buffer.Storage.delete

    def text(self, name, content):
        kind = name.rsplit("/", 1)[-1].split(".")[0].split("-")[0]
        if str(tmp_path / "p") in name:
            lost("rows" if kind == "unit" else "loaded" if kind == "done" else "none")
        real_text(self, name, content)
        if str(tmp_path / "p") in name:
            lost({"unit": "unit", "plan": "plan", "done": "done"}.get(kind, "none"))

    def delete(self, name):
        real_delete(self, name)
        if "/p/unit-1" in name:
            lost("clear")

    def once(rows, name):
        lost("write")
        write(rows, name)

    monkeypatch.setattr(buffer.Storage, "write_text", text)
    monkeypatch.setattr(buffer.Storage, "delete", delete)
    start = lambda: buffer.Pending(spark, str(tmp_path / "p"), 20, 1e9, once)
    pending, k = start(), 0
    while k < 5:
        try:
            pending.add(spark.range(k * 10, k * 10 + 10), k)
            k += 1
        except KeyboardInterrupt:
            pending = start()
    pending.flush()
    assert not broken[0] and ids(spark, path) == list(range(50)) and not pending.units() and pending.done() == 4
    accepted = L.read_ledger(spark, book).where(f"status = '{L.ACCEPTED}'")
    assert accepted.count() == accepted.select("load_id").distinct().count() == 3


def test_an_idle_stream_loads_what_grows_old(spark, tmp_path):
    inbox, path = str(tmp_path / "in"), str(tmp_path / "t")
    spark.range(40).write.parquet(inbox)
    stream = spark.readStream.schema("id long").parquet(inbox)
    options = {"trigger": {"processingTime": "0 seconds"}, "pending_path": str(tmp_path / "p"), "pending_rows": 1000}
    query = stream_load(stream, path, COLUMNS, str(tmp_path / "l"), str(tmp_path / "c"), "s", pending_age=2.0, **options)
    try:
        query.processAllAvailable()
        for _ in range(60):
            if pending_units(query).done() >= 0 or query.awaitTermination(1):
                break
        assert pending_units(query).error is None and not pending_units(query).units() and ids(spark, path) == list(range(40))
    finally:
        query.stop()


def test_settings(spark, tmp_path):
    stream = spark.readStream.schema("id long").parquet(str(tmp_path))
    for wrong in ({"pending_rows": 0}, {"pending_age": -1}, {"buffer": "1 second", "token": "none"}):
        with pytest.raises(StreamSettingError):
            stream_load(stream, "t", COLUMNS, "l", "c", "s", pending_path="p", **wrong)

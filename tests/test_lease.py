"""Writers of one file table take turns, and dead ones are taken over."""

import threading
import time
import uuid
from datetime import date

import pytest

from tidemark.operators import lease, tables
from tidemark.schemas import TableSpec
from tidemark.session import scratch_path

SPEC = TableSpec("t", "k STRING, v INT, d DATE", ("k",), "d")


@pytest.fixture
def place(spark):
    return f"{scratch_path(spark, 'lake')}/t/data"


def together(*jobs):
    """Run all at once; the first failure is raised."""
    failures = []

    def run(job):
        try:
            job()
        except BaseException as error:  # noqa: BLE001
            failures.append(error)

    threads = [threading.Thread(target=run, args=(j,)) for j in jobs]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if failures:
        raise failures[0]


def test_one_of_many_creates_a_file(spark, place):
    with lease.writer_lease(spark, place):
        won = []
        path = f"{lease.lease_folder(place)}/contended"
        together(*[lambda i=i: won.append(i) if lease.create_file(spark, path, str(i)) else None for i in range(16)])
    assert len(won) == 1 and lease.read_file(spark, path) == str(won[0])


def test_turns(spark, place):
    inside, seen = [], []

    def work(name):
        with lease.writer_lease(spark, place) as held:
            inside.append(name)
            seen.append((len(inside), held.number))
            time.sleep(0.05)
            inside.remove(name)

    together(*[lambda n=n: work(n) for n in range(6)])
    assert [n for n, _ in seen] == [1] * 6
    assert [number for _, number in seen] == list(range(1, 7))
    assert len(lease._numbers(spark, lease.lease_folder(place))) <= 2


def test_a_held_lease_is_waited_for(spark, place):
    with lease.writer_lease(spark, place):
        with pytest.raises(TimeoutError):
            lease.acquire(spark, place, wait=0.3)


def test_a_dead_lease_is_taken_over(spark, place):
    dead = lease.acquire(spark, place, seconds=0.2)  # never renewed
    time.sleep(0.3)
    with lease.writer_lease(spark, place) as mine:
        assert mine.number == dead.number + 1
        with pytest.raises(lease.LeaseLost):
            dead.check()
        dead.release()  # says nothing about the new one
        mine.check()
        with pytest.raises(TimeoutError):
            lease.acquire(spark, place, wait=0)


def test_a_live_lease_is_renewed(spark, place):
    with lease.writer_lease(spark, place, seconds=0.6) as mine:
        time.sleep(1.5)
        mine.check()
        with pytest.raises(TimeoutError):
            lease.acquire(spark, place, wait=0)


def test_a_file_without_content_counts_as_held(spark, place):
    held = lease.acquire(spark, place)
    held.release()
    assert lease.create_file(spark, f"{held.folder}/{held.number + 1:012d}", "")
    with pytest.raises(TimeoutError):
        lease.acquire(spark, place, wait=0)


def frame(spark, rows):
    return spark.createDataFrame([(k, v, date(2026, 5, d)) for k, v, d in rows], SPEC.ddl)


def test_two_writers_lose_no_row(spark):
    """Two jobs with catalogs of their own, on the same days, new keys and replaced ones."""
    folder = scratch_path(spark, "shared")
    jobs = [tables.create_tables(spark, f"job_{uuid.uuid4().hex[:8]}", folder, specs=(SPEC,)) for _ in range(2)]

    def work(number):
        for turn in range(3):
            rows = [(f"{number}-{turn}-{i}", turn, 1 + i % 3) for i in range(20)] + [(f"{number}-same", turn, 1 + turn)]
            tables.upsert(frame(spark, rows), jobs[number].name(SPEC), SPEC.key)

    together(lambda: work(0), lambda: work(1))
    stored = spark.read.schema(SPEC.schema).parquet(f"{folder}/{SPEC.name}/data").collect()
    keys = [r.k for r in stored]
    assert len(keys) == len(set(keys)) == 2 * (3 * 20 + 1)
    assert {r.v for r in stored if r.k.endswith("same")} == {2}


def test_a_writer_that_lost_its_lease_writes_nothing(spark, monkeypatch):
    folder = scratch_path(spark, "lost")
    lake = tables.create_tables(spark, f"job_{uuid.uuid4().hex[:8]}", folder, specs=(SPEC,))
    tables.append(frame(spark, [("a", 1, 1)]), lake.name(SPEC))
    profile = tables._profile

    def stalled(*args):
        """Another writer takes over while this one computes its source."""
        form = tables.layout(spark, lake.name(SPEC))
        folder = lease.lease_folder(form.location)
        assert lease.create_file(spark, f"{folder}/{lease.newest(spark, folder) + 1:012d}", '{"holder": "x", "until": 0}')
        return profile(*args)

    monkeypatch.setattr(tables, "_profile", stalled)
    with pytest.raises(lease.LeaseLost):
        tables.upsert(frame(spark, [("a", 2, 1)]), lake.name(SPEC), SPEC.key)
    monkeypatch.undo()
    assert [r.v for r in lake.read(SPEC).collect()] == [1]
    tables.upsert(frame(spark, [("a", 2, 1)]), lake.name(SPEC), SPEC.key)
    assert [r.v for r in lake.read(SPEC).collect()] == [2]


def test_the_folder_is_searched_only_after_other_writers(spark, monkeypatch):
    folder = scratch_path(spark, "searched")
    one, two = (tables.create_tables(spark, f"job_{uuid.uuid4().hex[:8]}", folder, specs=(SPEC,)) for _ in range(2))
    searched = []
    looked = tables.folder_exists
    monkeypatch.setattr(tables, "folder_exists", lambda *a: searched.append(a[1]) or looked(*a))
    for lake, searches in ((one, 1), (one, 0), (two, 1), (two, 0), (one, 1)):
        searched.clear()
        tables.append(frame(spark, [(uuid.uuid4().hex, 1, 1)]), lake.name(SPEC))
        assert len([s for s in searched if s.endswith("data")]) == searches
    assert one.read(SPEC).count() == 5

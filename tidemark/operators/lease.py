"""One writer at a time for a file table: a numbered lease beside its files.

A lease is a file whose name is a number; creating the next number is the one atomic step, so of several
writers that want it one gets it. The file says who holds it and until when, and its holder moves that
time on while it works. A lease that ran out is dead: the next writer takes the next number. Numbers only
grow, so a holder that was taken for dead finds a higher one and stops before it overwrites anything.

The number tells a writer too whether anyone else wrote since its own last lease.
"""

from __future__ import annotations

import json
import os
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from tidemark.session import hadoop_path

LEASE_SECONDS = 300.0  # a lease nobody renews is dead after so long
WAIT_SECONDS = 3600.0
POLL_SECONDS = 0.2


class LeaseLost(RuntimeError):
    """Another writer took over; nothing more may be written."""


def lease_folder(location: str) -> str:
    """Beside the table's files, where neither readers nor partition discovery look."""
    parent, _, name = location.rstrip("/").rpartition("/")
    return f"{parent}/_lease-{name}"


def _local(place, fs) -> str | None:
    """A path that this process opens itself: the operating system creates and replaces files in one step."""
    return place.toUri().getPath() if fs.getUri().getScheme() == "file" else None


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file that must not be there yet; False if it is."""
    place, fs = hadoop_path(spark, path)
    if own := _local(place, fs):
        try:
            file = os.open(own, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
        except FileExistsError:
            return False
        with os.fdopen(file, "w") as out:
            out.write(text)
        return True
    try:
        _fill(fs.create(place, False), text)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def _fill(stream, text: str) -> None:
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def overwrite_file(spark: SparkSession, path: str, text: str) -> None:
    place, fs = hadoop_path(spark, path)
    if own := _local(place, fs):
        with open(f"{own}.new", "w") as out:
            out.write(text)
        os.replace(f"{own}.new", own)
    else:
        _fill(fs.create(place, True), text)


def read_file(spark: SparkSession, path: str) -> str:
    place, fs = hadoop_path(spark, path)
    if own := _local(place, fs):
        with open(own) as source:
            return source.read()
    stream = fs.open(place)
    try:
        return bytes(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
    finally:
        stream.close()


def _held(spark: SparkSession, path: str) -> dict:
    """Who holds a lease and until when; a file that is just being written counts as held from its time on."""
    try:
        return json.loads(read_file(spark, path))
    except ValueError:
        place, fs = hadoop_path(spark, path)
        written = fs.getFileStatus(place).getModificationTime() / 1000
        return {"holder": None, "until": written + LEASE_SECONDS}


@dataclass
class Lease:
    """Held by this writer as long as ``check`` passes."""

    spark: SparkSession
    folder: str
    number: int
    holder: str
    seconds: float
    until: float = 0.0

    @property
    def path(self) -> str:
        return f"{self.folder}/{self.number:012d}"

    def _text(self, until: float) -> str:
        return json.dumps({"holder": self.holder, "until": until})

    def check(self) -> None:
        """Before each overwrite: nobody else may have taken over."""
        if newest(self.spark, self.folder) != self.number:
            raise LeaseLost(f"lease {self.number} in {self.folder} was taken over")
        if time.time() > self.until:
            self.renew()

    def renew(self) -> None:
        self.until = time.time() + self.seconds
        overwrite_file(self.spark, self.path, self._text(self.until))

    def release(self) -> None:
        if newest(self.spark, self.folder) == self.number:
            overwrite_file(self.spark, self.path, self._text(0.0))


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    place, fs = hadoop_path(spark, folder)
    if not fs.exists(place):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(place)]
    return sorted(int(name) for name in names if name.isdigit())


def newest(spark: SparkSession, folder: str) -> int:
    return max(_numbers(spark, folder), default=0)


def acquire(
    spark: SparkSession, location: str, seconds: float = LEASE_SECONDS, wait: float = WAIT_SECONDS
) -> Lease:
    """The next lease of a table, once the last one is released or dead."""
    folder, holder = lease_folder(location), uuid.uuid4().hex
    place, fs = hadoop_path(spark, folder)
    fs.mkdirs(place)
    give_up = time.time() + wait
    while True:
        numbers = _numbers(spark, folder)
        last = numbers[-1] if numbers else 0
        held = _held(spark, f"{folder}/{last:012d}") if last else {"until": 0.0}
        if held["until"] < time.time():
            lease = Lease(spark, folder, last + 1, holder, seconds, time.time() + seconds)
            if create_file(spark, lease.path, lease._text(lease.until)):
                for old in numbers[:-1]:  # the last one stays, as others may be reading it
                    fs.delete(hadoop_path(spark, f"{folder}/{old:012d}")[0], False)
                return lease
        elif time.time() > give_up:
            raise TimeoutError(f"{folder} is held by {held['holder']} until {held['until']}")
        else:
            time.sleep(POLL_SECONDS)


@contextmanager
def writer_lease(
    spark: SparkSession, location: str, seconds: float = LEASE_SECONDS, wait: float = WAIT_SECONDS
) -> Iterator[Lease]:
    """Hold a table's lease, renewing it until the block ends."""
    lease = acquire(spark, location, seconds, wait)
    done = threading.Event()

    def keep() -> None:
        while not done.wait(seconds / 3):
            if newest(spark, lease.folder) != lease.number:
                return
            lease.renew()

    keeper = threading.Thread(target=keep, daemon=True)
    keeper.start()
    try:
        yield lease
    finally:
        done.set()
        keeper.join()
        lease.release()

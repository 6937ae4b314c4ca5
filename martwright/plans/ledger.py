"""What a refresh folder says about itself: who works in it, what is finished, what is current.

A refresh holds a *lease*, a file with a time up to which nobody else touches its folder; a thread of
the driver renews it. Every finished table has a *mark*, and the finished refresh has one. A refresh
that died leaves a lease that runs out: another one with the same request may then take the folder over,
by creating the lease of the next number, which only one can, and continue behind the last mark.
One small file beside the folders, replaced in one step, names the refresh that readers should see.

Clocks of the drivers that share a root have to agree to within the lease.
"""

import json
import math
import threading
import time
import uuid

from pyspark.sql import SparkSession

from ..storage import create_text, discard, folders, names, read_text, replace_text

LEASE_SECONDS = 600.0
PREFIX = "refresh-"
LEASE = "_lease-"
FINISHED = "_finished"
CURRENT = "_current"


class LostLease(RuntimeError):
    """Another refresh has taken this folder over."""


def _lease(spark: SparkSession, folder: str) -> tuple[int, float]:
    """Number of the last lease of a folder, and when it runs out; 0 and 0.0 without any."""
    numbers = [
        int(name[len(LEASE) :]) for name in names(spark, folder) if name.startswith(LEASE) and name[len(LEASE) :].isdigit()
    ]
    if not numbers:
        return 0, 0.0
    text = read_text(spark, f"{folder}/{LEASE}{max(numbers)}")
    # One that is created but not written yet is alive.
    return max(numbers), json.loads(text)["until"] if text else math.inf


class Ledger:
    """A refresh's own folder, for as long as it works in it: ``with Ledger.open(...) as ledger``."""

    def __init__(self, spark: SparkSession, folder: str, number: int, seconds: float):
        self.spark, self.folder, self.number, self.seconds = spark, folder, number, seconds
        self._stop = threading.Event()
        self._renewing = threading.Thread(target=self._renew_until_stopped, daemon=True)

    @classmethod
    def open(cls, spark: SparkSession, root: str, request: str, seconds: float = LEASE_SECONDS) -> "Ledger":
        """The folder of an unfinished refresh with the same request whose lease has run out, the one
        with the most marks, or else a new one."""
        left = []
        for name in folders(spark, root):
            folder = f"{root}/{name}"
            if name.startswith(PREFIX) and read_text(spark, f"{folder}/_request") == request:
                number, until = _lease(spark, folder)
                own = names(spark, folder)
                if FINISHED not in own and until < time.time():
                    left.append((-sum(n.startswith("_done-") for n in own), folder, number))
        for _, folder, number in sorted(left):
            if create_text(spark, f"{folder}/{LEASE}{number + 1}", _until(seconds)):
                return cls(spark, folder, number + 1, seconds)
        folder = f"{root}/{PREFIX}{uuid.uuid4().hex}"
        create_text(spark, f"{folder}/{LEASE}1", _until(seconds))
        replace_text(spark, f"{folder}/_request", request)
        return cls(spark, folder, 1, seconds)

    def __enter__(self) -> "Ledger":
        self._renewing.start()
        return self

    def __exit__(self, kind, error, trace) -> None:
        """Give the lease back, so that a refresh that failed can be continued at once."""
        self._stop.set()
        self._renewing.join()
        if self._is_mine():
            replace_text(self.spark, f"{self.folder}/{LEASE}{self.number}", _until(0))

    def _is_mine(self) -> bool:
        return _lease(self.spark, self.folder)[0] == self.number

    def check(self) -> None:
        if not self._is_mine():
            raise LostLease(f"another refresh works in {self.folder}")

    def renew(self) -> None:
        self.check()
        replace_text(self.spark, f"{self.folder}/{LEASE}{self.number}", _until(self.seconds))

    def _renew_until_stopped(self) -> None:
        while not self._stop.wait(self.seconds / 4):
            try:
                self.renew()
            except LostLease:
                return

    def is_done(self, table: str) -> bool:
        return read_text(self.spark, f"{self.folder}/_done-{table}") is not None

    def done(self, table: str) -> None:
        """Mark a table as finished. Whoever lost the lease meanwhile must not."""
        self.check()
        replace_text(self.spark, f"{self.folder}/_done-{table}", json.dumps({"at": time.time()}))

    def finish(self) -> None:
        self.check()
        replace_text(self.spark, f"{self.folder}/{FINISHED}", json.dumps({"at": time.time()}))


def _until(seconds: float) -> str:
    return json.dumps({"until": time.time() + seconds})


def make_current(spark: SparkSession, root: str, paths: dict[str, str]) -> None:
    """Name the tables that readers should see, all of them in one step."""
    replace_text(spark, f"{root}/{CURRENT}", json.dumps(paths, indent=1))


def current_tables(spark: SparkSession, root: str) -> dict[str, str]:
    """Paths of the tables of one finished refresh, the current one. Read this once and open the
    tables from it: they belong together whatever is published meanwhile."""
    text = read_text(spark, f"{root.rstrip('/')}/{CURRENT}")
    if text is None:
        raise ValueError(f"nothing was published under {root}")
    return json.loads(text)


def retire(spark: SparkSession, root: str, keep: int, protected: set[str]) -> list[str]:
    """Delete refreshes under ``root`` that nobody needs and return their names.

    The ``keep`` finished ones that finished last stay, and the folders in ``protected``. An unfinished
    one does not count; it stays while its lease lives and goes when that has run out. Folders
    without a lease are none of ours and stay.
    """
    finished, dead = [], []
    for name in folders(spark, root):
        folder = f"{root}/{name}"
        if not name.startswith(PREFIX) or not any(n.startswith(LEASE) for n in names(spark, folder)):
            continue
        mark = read_text(spark, f"{folder}/{FINISHED}")
        if mark is not None:
            finished.append((json.loads(mark)["at"], folder))
        elif _lease(spark, folder)[1] < time.time():
            dead.append(folder)
    old = [folder for _, folder in sorted(finished, reverse=True)[keep:]] + dead
    gone = [folder for folder in old if folder not in protected]
    for folder in gone:
        discard(spark, folder)
    return [folder.rpartition("/")[2] for folder in gone]

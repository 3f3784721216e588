"""One writer at a time: a lease document beside the data, renewed while work goes on."""

from __future__ import annotations

import threading
import time
import uuid

from pyspark.sql import SparkSession

from ..storage import Storage

#: Seconds between renewals, after which a lease of another is stale, and after which the holder itself stops (fixed values).
BEAT, STALE, OWN = 15, 300, 270
LEASE_VERSION = 1


class LeaseError(RuntimeError):
    """Names the holder."""


class Lease:
    """with Lease(...): a pipeline's destination is written by nobody else. A stale lease is taken over."""

    def __init__(self, spark: SparkSession, root: str, pipeline: str, owner: str = "", now=time.time, beat: float = BEAT):
        self.store, self.name = Storage(spark, root), f"_lease-{pipeline}"
        self.owner, self.token, self.now, self.beat = owner or "a run", uuid.uuid4().hex, now, beat
        self.renewed, self.lost, self.done = 0.0, False, threading.Event()

    def holder(self) -> dict | None:
        return self.store.read_json(self.name)

    def acquire(self) -> None:
        found = self.holder()
        if found is not None:
            if found["version"] > LEASE_VERSION:
                raise LeaseError("the lease was written by a newer version: upgrade, do not reset")
            if self.now() - found["renewed"] < STALE:
                raise LeaseError(f"{found['owner']} holds the lease since {found['taken']:.0f}")
            self.store.rename(self.name, f"{self.name}.{found['token']}.stale")  # of two that take over, one finds it
        doc = {"version": LEASE_VERSION, "owner": self.owner, "token": self.token, "taken": self.now(), "renewed": self.now()}
        if not self.store.create(self.name, doc):
            raise LeaseError(f"{(self.holder() or {}).get('owner', 'another run')} took the lease just now")
        self.renewed = self.now()

    def renew(self) -> None:
        found = self.holder()
        if found is None or found["token"] != self.token:
            self.lost = True
            return
        self.renewed = self.now()
        self.store.write_json(self.name, {**found, "renewed": self.renewed})

    def check(self) -> None:
        """Fail unless the lease still holds; called before anything is published."""
        if self.lost or self.now() - self.renewed > OWN:
            raise LeaseError("the lease was lost: another run may be writing")

    def __enter__(self) -> Lease:
        self.acquire()

        def go_on() -> None:
            while not self.done.wait(self.beat):
                self.renew()

        threading.Thread(target=go_on, daemon=True).start()
        return self

    def __exit__(self, *what) -> None:
        self.done.set()
        found = self.holder()
        if found is not None and found["token"] == self.token:
            self.store.delete(self.name)

"""Exclusive claims on the months, quarters and tables of a lake.

A claim is a file ``ops/claims/<name>/<number>`` that the file system creates only if it is
not there. It is released by a marker beside it and runs out at the time written in it. The
next claim takes the next number, so a claim that ran out is never removed to make room: two
runs that see it at the same time ask for the same number, and one of them gets it.

Times are those of the drivers; their clocks should agree to within a small part of the
duration of a claim.
"""

from __future__ import annotations

import json
import socket
import time
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession

from opslog.sources import files

_RELEASED = ".released"
#: A claim file is read as held for so long after its creation while its text is not there yet.
_BEING_WRITTEN = 60
_POLL_SECONDS = 0.2


class ClaimLost(RuntimeError):
    """The claim ran out and may have been taken by another run."""


@dataclass(frozen=True)
class Claim:
    name: str
    number: int
    owner: str
    expires: float


@dataclass(frozen=True)
class Claims:
    spark: SparkSession
    root: str

    def _folder(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _newest(self, name: str) -> tuple[int, bool, list[files.Entry]]:
        """(number of the newest claim or 0, released, all entries)."""
        there = files.entries(self.spark, self._folder(name))
        names = {e.name for e in there}
        number = max((int(n) for n in names if n.isdigit()), default=0)
        return number, f"{number:09d}{_RELEASED}" in names, there

    def _state(self, name: str) -> tuple[int, Claim | None]:
        """The newest number and, while that claim is held, the claim: from one listing."""
        number, released, there = self._newest(name)
        if not number or released:
            return number, None
        entry = next(e for e in there if e.name == f"{number:09d}")
        text = files.read_text(self.spark, entry.path)
        told = json.loads(text) if text else {"owner": "unknown", "expires": entry.modified + _BEING_WRITTEN}
        held = told["expires"] > time.time()
        return number, Claim(name, number, told["owner"], told["expires"]) if held else None

    def holder(self, name: str) -> Claim | None:
        """Who holds the name now."""
        return self._state(name)[1]

    def take(self, name: str, seconds: float) -> Claim | None:
        """The claim, or None while another run holds the name.

        The number asked for is the one after the claim that was seen to be over. If others
        were here in between, it is taken, or they are further on.
        """
        number, holder = self._state(name)
        while holder is None:
            claim = Claim(name, number + 1, f"{socket.gethostname()} {uuid.uuid4().hex[:8]}", time.time() + seconds)
            path = f"{self._folder(name)}/{claim.number:09d}"
            if files.create_new(self.spark, path, json.dumps({"owner": claim.owner, "expires": claim.expires})):
                if self._newest(name)[0] == claim.number:
                    return claim
                files.remove(self.spark, path)
            number, holder = self._state(name)
        return None

    def is_held(self, claim: Claim) -> bool:
        return claim.expires > time.time() and self._newest(claim.name)[:2] == (claim.number, False)

    def check(self, claim: Claim) -> None:
        """Raise if the claim is not held any more: to be asked before results become visible."""
        if not self.is_held(claim):
            raise ClaimLost(f"the claim on {claim.name} ran out")

    def release(self, claim: Claim) -> None:
        """Give the name free; the claims before this one are cleared away."""
        files.create_new(self.spark, f"{self._folder(claim.name)}/{claim.number:09d}{_RELEASED}", "")
        for entry in files.entries(self.spark, self._folder(claim.name)):
            number = entry.name.removesuffix(_RELEASED)
            if number.isdigit() and int(number) < claim.number:
                files.remove(self.spark, entry.path)

    @contextmanager
    def hold(self, names: Iterable[str], seconds: float, wait: float = 0) -> Iterator[dict[str, Claim]]:
        """The claims that were got, within ``wait`` seconds in all, and their release at the end.

        Names are taken in one order by all runs, so runs that wait never wait for each other.
        """
        until, held = time.time() + wait, {}
        try:
            for name in sorted(set(names)):
                while (claim := self.take(name, seconds)) is None and time.time() < until:
                    time.sleep(_POLL_SECONDS)
                if claim is not None:
                    held[name] = claim
            yield held
        finally:
            for claim in held.values():
                self.release(claim)

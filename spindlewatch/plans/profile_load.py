"""Loading the machine profiles once."""

import json
import time
import uuid

from pyspark.sql import functions as F

from spindlewatch import names
from spindlewatch.operators.refdata import (
    check_machine_count,
    complete_profiles,
    put_rows,
    round_robin,
    top_up,
)
from spindlewatch.schemas import MACHINE_PROFILE
from spindlewatch.sources.notes import Notes
from spindlewatch.sources.tables import activity_value, note_activities, read_profiles, write_profiles

# Seconds after which a load that was not heard of again counts as dead.
LEASE = 3600


class LoadInProgress(RuntimeError):
    """Another loader is at work, or was faster."""


class ProfileStore:
    """Machine profiles and the activities ledger under one folder.

    A load writes a new version of the table beside the old ones and then adds one numbered note with its name, and
    whether it finishes the load. A number can be given only once, so a writer that started from an older version
    than is there now fails instead of replacing what it has not seen; readers see the old table or the new one, and
    a load that dies anywhere is as if it had not begun. Which version is the newest is told by numbers, not by a
    clock. The ledger repeats that the load is finished; an entry that is missing is made up for.
    """

    def __init__(self, spark, root):
        self.spark = spark
        self.root = root.rstrip("/")
        self.ledger = f"{self.root}/{names.ACTIVITIES}"
        self.versions = Notes(spark, f"{self.root}/versions")
        self.claims = Notes(spark, f"{self.root}/claims", keep=2)

    def _newest(self):
        """(number, version, finished) of the newest version; the number is -1 if there is none."""
        number = self.versions.last()
        note = json.loads(self.versions.text(number) or "{}")
        return number, note.get("version"), note.get("finished", False)

    def status(self):
        return activity_value(self.spark, self.ledger, names.LOADER_KEY)

    def read(self):
        return self._read(self._newest()[1])

    def _read(self, version):
        return read_profiles(self.spark, f"{self.root}/{names.PROFILES}/{version}")

    def _add(self, number, version, finished):
        try:
            self.versions.add(number, json.dumps({"version": version, "finished": finished}))
        except FileExistsError as error:
            raise LoadInProgress("the profiles were changed by another writer in the meantime") from error

    def replace(self, profiles):
        """Make ``profiles`` the table's content."""
        number, _, finished = self._newest()
        version = f"version-{uuid.uuid4().hex}"
        write_profiles(profiles, f"{self.root}/{names.PROFILES}/{version}")
        self._add(number + 1, version, finished)

    def _note_finished(self):
        if self.status() != names.LOADER_FINISHED:
            note_activities(self.spark, self.ledger, {names.LOADER_KEY: names.LOADER_FINISHED})

    def _claim(self, lease):
        """Take the load upon oneself, and return the claim's number. A claim older than its lease is taken over."""
        number = self.claims.last()
        held = json.loads(self.claims.text(number) or '{"until": 0}')
        if time.time() < held["until"]:
            raise LoadInProgress(f"a load is at work, and counts as dead in {held['until'] - time.time():.0f} s")
        try:
            self.claims.add(number + 1, json.dumps({"until": time.time() + lease}))
        except FileExistsError as error:
            raise LoadInProgress("another load has just begun") from error
        return number + 1

    def load_once(self, candidates, templates, machine_count, most=None, lease=LEASE):
        """Bring the fleet up to ``machine_count`` and return how many candidates were loaded, or None if a
        load has finished before.

        ``candidates`` has the profile's own columns (serialNum, manufacturer, warningTemp, maxRPM) and
        ``seq``, their order; location, block and fault odds come from the templates in turn. A later
        candidate replaces an earlier one, or a stored profile, with the same serial number. A count above
        ``most``, if that is given, is refused.

        Of several loaders at once one loads: LoadInProgress tells the others that one has begun less than ``lease``
        seconds ago. One that was taken for dead and comes back does no harm, since its version has lost its number.
        """
        target = check_machine_count(machine_count, most)
        if self._newest()[2]:
            self._note_finished()
            return None
        claim = self._claim(lease)
        try:
            return self._load(candidates, templates, target)
        finally:
            # Also after a failure: the next loader need not wait. One that dies leaves its lease to run out.
            if self.claims.last() == claim:
                self.claims.replace(claim, json.dumps({"until": 0}))

    def _load(self, candidates, templates, target):
        number, version, _ = self._newest()
        stored = self._read(version)
        existing = stored.count()
        needed = max(0, target - existing)
        if needed:
            chosen = complete_profiles(round_robin(top_up(candidates, existing, target), templates))
            typed = chosen.select("seq", *[F.col(f.name).cast(f.dataType).alias(f.name) for f in MACHINE_PROFILE])
            version = f"version-{uuid.uuid4().hex}"
            write_profiles(put_rows(stored, typed), f"{self.root}/{names.PROFILES}/{version}")
        self._add(number + 1, version, True)
        self._note_finished()
        return needed

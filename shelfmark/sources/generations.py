"""Layers that change all at once: every write goes to a folder of its own, and a log names the valid ones.

A layer's home has a data folder with one ``generation=…`` folder per write and a log with one small
file per publication. What a reader sees is what the newest entry names, so a job that dies between
any two writes leaves the layer as it was, and a reader that has resolved a version keeps it while
the next one is published. The log is written by one file's rename, which is the only step that counts.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from shelfmark.schemas import LOG
from shelfmark.storage import children, remove

GENERATION = "generation"


class PublishConflict(RuntimeError):
    """Somebody else published the layer since this job read it; nothing was changed."""


@dataclass(frozen=True)
class Home:
    """Where a layer's generations lie, and the log of what is valid."""

    data: str
    log: str

    def folder(self, generation: str) -> str:
        return f"{self.data}/{GENERATION}={generation}"


@dataclass(frozen=True)
class Version:
    """One publication. ``folders`` are relative to the data folder and may be of older generations."""

    number: int
    generation: str
    folders: tuple[str, ...]
    published_at: datetime

    def paths(self, home: Home) -> list[str]:
        return [f"{home.data}/{folder}" for folder in self.folders]


@dataclass(frozen=True)
class Draft:
    """A generation that is being written and that no reader sees."""

    generation: str
    path: str

    @property
    def folder(self) -> str:
        return f"{GENERATION}={self.generation}"


def versions(spark: SparkSession, home: Home) -> list[Version]:
    """All publications that are still listed, the newest first; a row per publication comes to the driver."""
    if not children(spark, home.log):
        return []
    rows = spark.read.schema(LOG).json(f"{home.log}/*").collect()
    found = [Version(r.number, r.generation, tuple(r.folders or ()), r.published_at) for r in rows]
    return sorted(found, key=lambda v: (-v.number, v.published_at, v.generation))


def current(spark: SparkSession, home: Home) -> Version | None:
    return next(iter(versions(spark, home)), None)


def published(spark: SparkSession, home: Home) -> Version:
    version = current(spark, home)
    if version is None:
        raise FileNotFoundError(f"nothing is published in {home.log}")
    return version


@contextmanager
def drafting(spark: SparkSession, home: Home) -> Iterator[Draft]:
    """A fresh generation; its folder goes if the block fails before it is published."""
    generation = f"{datetime.now(UTC):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"
    draft = Draft(generation, home.folder(generation))
    try:
        yield draft
    except BaseException:
        remove(spark, draft.path)
        raise


def publish_draft(
    spark: SparkSession, home: Home, draft: Draft, folders: Sequence[str], before: Version | None
) -> list[Version]:
    """Make ``folders`` the layer, if ``before`` is still its newest version; returns all that are listed.

    Writers of a layer are meant to take turns. Two that overlap both list the same number: the one
    that sees another entry beside its own takes it back and fails.
    """
    number = before.number + 1 if before else 1
    entry = f"{home.log}/{number:012d}-{draft.generation}"
    row = spark.range(0, 1, 1, 1).select(
        F.lit(number).cast("long").alias("number"),
        F.lit(draft.generation).alias("generation"),
        F.array(*map(F.lit, folders)).cast("array<string>").alias("folders"),
        F.current_timestamp().alias("published_at"),
    )
    row.write.mode("errorifexists").json(entry)
    listed = versions(spark, home)
    if any(v.number >= number and v.generation != draft.generation for v in listed):
        remove(spark, entry)
        raise PublishConflict(f"{home.log} has a version {number} of another job")
    return listed


def vacuum(
    spark: SparkSession, home: Home, keep: int = 2, drafts: bool = False, listed: list[Version] | None = None
) -> list[str]:
    """Remove what only versions before the newest ``keep`` name, and return the removed folders.

    ``drafts`` also removes folders that no version names, which killed jobs leave; ask for that only
    while no job writes the layer.
    """
    listed = versions(spark, home) if listed is None else listed
    kept, old = listed[: max(1, keep)], listed[max(1, keep) :]
    valid = {folder for version in kept for folder in version.folders}
    in_use = {folder.split("/")[0] for folder in valid}
    gone = sorted({folder for version in old for folder in version.folders} - valid)
    unused = {folder.split("/")[0] for folder in gone} - in_use
    if drafts:
        unused |= {name for name in children(spark, home.data) if name.startswith(GENERATION)} - in_use
    gone = [*sorted(unused), *[folder for folder in gone if folder.split("/")[0] not in unused]]
    # entries go first: a folder that is listed must be there
    for version in old:
        remove(spark, f"{home.log}/{version.number:012d}-{version.generation}")
    for folder in gone:
        remove(spark, f"{home.data}/{folder}")
    return gone

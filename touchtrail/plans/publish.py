"""Builds that readers can trust while the next one is written.

A build writes all its tables below ``<out>/builds/<id>``. It becomes the current one by one new file
in ``<out>/_commits``: the file is named by the next number, holds the id, and is created only if no
other writer took the number. Readers look up the last commit, so they see one whole build or the
other, never a mixture; a build that fails before its commit is never seen. A commit that was cut off
does not count.
"""

from __future__ import annotations

import time
import uuid
from datetime import timedelta

from pyspark.sql import SparkSession

from touchtrail.sources import files

COMMITS, BUILDS = "_commits", "builds"


class NoBuildError(LookupError):
    """Nothing has been published yet."""


def build_path(out: str, build: str) -> str:
    return f"{out.rstrip('/')}/{BUILDS}/{build}"


def new_build() -> str:
    """An id that no other build has."""
    return f"{int(time.time())}-{uuid.uuid4().hex}"


def commits(spark: SparkSession, out: str) -> list[tuple[int, str]]:
    """(number, build) of every commit, the current one last."""
    folder, found = f"{out.rstrip('/')}/{COMMITS}", []
    for name in files.names(spark, folder):
        text = files.read_text(spark, f"{folder}/{name}") if name.isdigit() else None
        if text and text.endswith("\n"):
            found.append((int(name), text.strip()))
    return found


def is_committed(spark: SparkSession, out: str, build: str) -> bool:
    return any(build == known for _, known in commits(spark, out))


def commit(spark: SparkSession, out: str, build: str) -> int:
    """Make a build the current one, in one step; its number. Once committed, nothing more happens."""
    folder = f"{out.rstrip('/')}/{COMMITS}"
    for number, known in commits(spark, out):
        if known == build:
            return number
    taken = [int(name) for name in files.names(spark, folder) if name.isdigit()]
    number = max(taken, default=0) + 1
    while not files.write_new(spark, f"{folder}/{number:020d}", f"{build}\n"):
        number += 1
    return number


def current(spark: SparkSession, out: str) -> str:
    """The folder of the current build."""
    known = commits(spark, out)
    if not known:
        raise NoBuildError(f"no build has been published below {out}")
    return build_path(out, known[-1][1])


def roll_back(spark: SparkSession, out: str) -> str:
    """Make the build before the current one current again, as a commit of its own; its folder."""
    known = commits(spark, out)
    earlier = [build for _, build in known if build != known[-1][1]] if known else []
    if not earlier:
        raise NoBuildError(f"no earlier build below {out}")
    folder = f"{out.rstrip('/')}/{COMMITS}"
    number = known[-1][0] + 1
    while not files.write_new(spark, f"{folder}/{number:020d}", f"{earlier[-1]}\n"):
        number += 1
    return build_path(out, earlier[-1])


def expire(
    spark: SparkSession, out: str, keep: int = 3, abandoned_after: timedelta = timedelta(days=2)
) -> list[str]:
    """Remove builds that the last ``keep`` commits do not name; the ids of those removed.

    A build without any commit may still be written, so it goes only if it has not changed for
    ``abandoned_after``. Commits before the last ``keep`` go first: what they name is then out of reach.
    """
    if keep < 1:
        raise ValueError("the current build has to stay")
    known = commits(spark, out)
    kept = {build for _, build in known[-keep:]}
    committed = {build for _, build in known}
    for number, _ in known[:-keep]:
        files.remove(spark, f"{out.rstrip('/')}/{COMMITS}/{number:020d}")
    limit = (time.time() - abandoned_after.total_seconds()) * 1000
    removed = []
    for build in files.names(spark, f"{out.rstrip('/')}/{BUILDS}"):
        path = build_path(out, build)
        if build in kept or (build not in committed and files.written_at(spark, path) > limit):
            continue
        files.remove(spark, path)
        removed.append(build)
    return removed

"""Folders written aside and published by renaming, so that readers see them old or new.

A writer fills a staged folder below the root; its name begins with `_`, which readers
pass over. `publish` then notes what it is about to do in one file, the point from which
the new state counts, and renames folder by folder. A process killed before that note
leaves the old state; after it, `recover` takes the note up and ends the work. On a store
whose renames are copies the same holds, at the price of a copy. One writer at a time.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from landfall import session

#: Writer options for a staged folder: tasks move their files into it themselves, as nobody
#: reads it before it is published. A task tried again overwrites its files by their names.
COMMIT = {"mapreduce.fileoutputcommitter.algorithm.version": "2",
          "mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}
_NOTES = "_notes"
#: Renames in flight at once.
_THREADS = 16


def staged_name() -> str:
    return f"_staged-{uuid.uuid4().hex[:12]}"


def folders(spark: SparkSession, root: str, depth: int) -> list[str]:
    """The partition folders `depth` levels below root, as `a=1/b=2`; names only."""
    shown = session.list_paths(spark, "/".join([root, *["*=*"] * depth]))
    level = "[^/]+=[^/]+"
    found = re.compile("/".join([level] * depth) + "$")
    return sorted(m.group() for path in shown if (m := found.search(path)))


def _finish(spark: SparkSession, root: str, note: str) -> None:
    """Do what the note says; what is done already is left as it is."""
    plan = json.loads(session.read_text(spark, f"{root}/{_NOTES}/{note}"))
    staged, old = f"{root}/{plan['staged']}", f"{root}/{plan['staged']}-old"

    def swap(folder: str) -> None:
        target, new = f"{root}/{folder}", f"{staged}/{plan['below']}{folder}"
        arrives = session.exists(spark, new)
        # A folder that is there although its successor still waits is the old one.
        if (arrives or folder in gone) and session.exists(spark, target):
            session.move(spark, target, f"{old}/{folder}")
        if arrives:
            session.move(spark, new, target)

    gone = set(plan["gone"])
    with ThreadPoolExecutor(_THREADS) as pool:
        list(pool.map(swap, [*plan["new"], *plan["gone"]]))
    for name, text in plan["records"].items():
        session.write_text(spark, f"{root}/{name}", text)
    session.remove(spark, f"{root}/{_NOTES}/{note}")
    session.remove(spark, staged)
    session.remove(spark, old)


def recover(spark: SparkSession, root: str) -> bool:
    """End what a killed writer had begun to publish, and say whether there was such;
    drop what it had only staged."""
    notes = session.list_paths(spark, f"{root}/{_NOTES}/*.json")
    for path in notes:
        _finish(spark, root, path.rsplit("/", 1)[1])
    for path in session.list_paths(spark, f"{root}/_staged-*"):
        session.remove(spark, path)
    return bool(notes)


def publish(spark: SparkSession, root: str, staged: str, new: Iterable[str],
            gone: Iterable[str] = (), records: dict[str, str] | None = None,
            below: str = "") -> None:
    """Put the folders `new` of the staged folder, or of the folder `below/` in it, in place
    of those of the same names, remove those in `gone`, and write the small text files
    `records`."""
    plan = {"staged": staged, "below": below, "new": list(new), "gone": list(gone),
            "records": records or {}}
    note = f"{uuid.uuid4().hex}.json"
    # Written under another name and renamed, so that the note is there whole or not at all.
    session.write_text(spark, f"{root}/{_NOTES}/{note}", json.dumps(plan))
    _finish(spark, root, note)

"""The event table: days that several writers share, each day with a manifest of what counts.

Files lie in `dt=<day>/en=<kind>/<label>/`. A writer places files under a label of its own and then commits the label to
the day's manifest under its slot: the batch job has one slot, which a rerun fills anew, and a stream one for each
batch, which a repeated batch fills anew. Manifests are numbered files, written aside and put in place only if that number
is free; a writer that comes second reads the newer one and tries again. So nothing that another writer committed is
lost, and readers see whole states. Labels that left the manifest are deleted KEEP_VERSIONS commits later.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake import schema as S
from visitlake.sources.files import claim, delete, exists, matching, move, read_text, size_of, write_text

KEEP_VERSIONS = 5
BATCH_SLOT = "batch"
_STREAM_SLOT = re.compile(r"([0-9a-f]{8})-(\d{9})")
_COMPACTED = "compacted"
# Files that lie in `en=<kind>` itself, from before a day had a manifest.
_LOOSE = "."
# Labels of this module; without a manifest that names them they are not committed yet.
_OWN = re.compile(r".*-[0-9a-f]{32}(-\d+)?")

# slots: slot -> label; folded: stream -> its last batch that went into compacted files.
Manifest = dict[str, dict]


def day_dir(root: str, day: date | str) -> str:
    return f"{root.rstrip('/')}/dt={day}"


def _versions(spark: SparkSession, day: str) -> list[str]:
    return matching(spark, f"{day}/_manifest/v=*")


def _labels(spark: SparkSession, day: str) -> set[str]:
    found = {path.rsplit("/", 1)[1] for path in matching(spark, f"{day}/en=*/*")}
    return {_LOOSE if name.endswith(".parquet") else name for name in found if not (name.startswith(("_", ".")) or _OWN.fullmatch(name))}


def read_manifest(spark: SparkSession, day: str) -> tuple[int, Manifest]:
    """Number and content of a day's manifest; number 0, and all that older writers left there, for a day without one."""
    versions = _versions(spark, day)
    if not versions:
        return 0, {"slots": {label if label != _LOOSE else BATCH_SLOT: label for label in _labels(spark, day)}, "folded": {}}
    return int(versions[-1].rsplit("=", 1)[1]), json.loads(read_text(spark, versions[-1]))


def commit(spark: SparkSession, day: str, change: Callable[[Manifest], Manifest | None]) -> bool:
    """Replaces a day's manifest by what `change` makes of the newest one; False if it makes nothing of it.

    `change` is called again whenever another writer was first, so it must only depend on its argument.
    """
    while True:
        number, manifest = read_manifest(spark, day)
        changed = change({part: dict(entries) for part, entries in manifest.items()})
        if changed is None:
            return False
        aside = f"{day}/_manifest/_{uuid.uuid4().hex}"
        write_text(spark, aside, json.dumps(changed, sort_keys=True))
        if claim(spark, aside, f"{day}/_manifest/v={number + 1:08d}"):
            _forget(spark, day)
            return True
        delete(spark, aside)


def _forget(spark: SparkSession, day: str) -> None:
    """Deletes manifests beyond the last KEEP_VERSIONS, and labels that only those name."""
    versions = _versions(spark, day)
    named = lambda paths: {label for p in paths for label in json.loads(read_text(spark, p))["slots"].values()}
    old, kept = versions[:-KEEP_VERSIONS], versions[-KEEP_VERSIONS:]
    if not old:
        return
    for label in named(old) - named(kept):
        for path in matching(spark, f"{day}/en=*/*.parquet" if label == _LOOSE else f"{day}/en=*/{label}"):
            delete(spark, path)
    for path in old:
        delete(spark, path)


def live_paths(spark: SparkSession, day: str, slots: set[str] | None = None) -> list[str]:
    """Directories and files of a day that count, of all slots or of some, by one listing."""
    _, manifest = read_manifest(spark, day)
    labels = {label for slot, label in manifest["slots"].items() if slots is None or slot in slots}
    paths = matching(spark, f"{day}/en=*/*")
    return [p for p in paths if p.rsplit("/", 1)[1] in labels or (_LOOSE in labels and p.endswith(".parquet"))]


def read_paths(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], S.EVENT_SCHEMA)
    return spark.read.schema(S.EVENT_SCHEMA).option("basePath", root.rstrip("/")).parquet(*paths).select(*S.EVENT_SCHEMA.names)


def _folded(manifest: Manifest, slot: str) -> bool:
    """Whether a stream's batch is in compacted files already."""
    batch = _STREAM_SLOT.fullmatch(slot)
    return bool(batch) and int(batch[2]) <= manifest["folded"].get(batch[1], -1)


def put_events(rows: DataFrame, root: str, slot: str, always: date | None = None) -> None:
    """Fills a writer's slot in each day (`dt`) of the rows, and in the day `always` even with nothing.

    Rows have the event table's columns. Other slots stay as they are. A batch that was compacted meanwhile is there
    already and is left out.
    """
    spark, base = rows.sparkSession, root.rstrip("/")
    label = f"{slot}-{uuid.uuid4().hex}"
    incoming = f"{base}/_incoming/{label}"
    rows.select(*S.EVENT_SCHEMA.names).write.partitionBy("dt", "en").parquet(incoming)
    days = set() if always is None else {always.isoformat()}
    for path in matching(spark, f"{incoming}/dt=*/en=*"):
        day, kind = path.rsplit("/", 2)[1:]
        move(spark, path, f"{base}/{day}/{kind}/{label}")
        days.add(day.removeprefix("dt="))
    delete(spark, incoming)

    def filled(manifest: Manifest) -> Manifest | None:
        if _folded(manifest, slot):
            return None
        manifest["slots"][slot] = label
        return manifest

    for day in sorted(days):
        if not commit(spark, day_dir(base, day), filled):
            for path in matching(spark, f"{day_dir(base, day)}/en=*/{label}"):
                delete(spark, path)


def _bins(sizes: dict[str, int], target: int) -> dict[str, int]:
    """Number of the bin of each entry: the largest first, each into the first bin it fits."""
    room: list[int] = []
    placed = {}
    for name, size in sorted(sizes.items(), key=lambda e: (-e[1], e[0])):
        at = next((n for n, left in enumerate(room) if size <= left), len(room))
        if at == len(room):
            room.append(target)
        room[at] -= size
        placed[name] = at
    return placed


def compact_day(spark: SparkSession, root: str, day: date, target_bytes: int = 128 << 20) -> int:
    """Packs small files of a day's streamed batches into files of about `target_bytes`; returns how many slots went.

    Each stream's newest batch stays, as it may be repeated, and so does the batch job's slot. All is swapped by one
    commit, and by none if a writer has changed one of the packed slots meanwhile.
    """
    base, place = root.rstrip("/"), day_dir(root, day)
    _, manifest = read_manifest(spark, place)
    newest: dict[str, int] = {}
    batches = {slot: m for slot in manifest["slots"] if (m := _STREAM_SLOT.fullmatch(slot))}
    for m in batches.values():
        newest[m[1]] = max(newest.get(m[1], -1), int(m[2]))
    chosen = {slot for slot, m in batches.items() if int(m[2]) < newest[m[1]]}
    sizes = {path: size_of(spark, path) for path in live_paths(spark, place, {s for s in manifest["slots"] if s in chosen or s.startswith(_COMPACTED)})}
    of_label = {label: slot for slot, label in manifest["slots"].items()}
    bytes_of = {slot: sum(n for p, n in sizes.items() if of_label[p.rsplit("/", 1)[1]] == slot) for slot in manifest["slots"]}
    if chosen:
        chosen |= {s for s in manifest["slots"] if s.startswith(_COMPACTED) and bytes_of[s] < target_bytes // 2}
    if len(chosen) < 2:
        return 0
    taken = {slot: manifest["slots"][slot] for slot in chosen}
    paths = {p: n for p, n in sizes.items() if p.rsplit("/", 1)[1] in taken.values()}
    kinds = {p.rsplit("/", 2)[1] for p in paths}
    bins = {p: n for kind in kinds for p, n in _bins({p: s for p, s in paths.items() if p.rsplit("/", 2)[1] == kind}, target_bytes).items()}
    packing = spark.createDataFrame([(*p.rsplit("/", 2)[1:], n) for p, n in bins.items()] or [("", "", 0)], "kind string, label string, bin int")
    source = F.input_file_name()
    rows = read_paths(spark, base, list(paths)).withColumns({
        "kind": F.element_at(F.split(source, "/"), -3), "label": F.element_at(F.split(source, "/"), -2),
    }).join(F.broadcast(packing), ["kind", "label"])
    name = f"{_COMPACTED}-{uuid.uuid4().hex}"
    incoming = f"{base}/_incoming/{name}"
    rows.drop("kind", "label").repartition("en", "bin").write.partitionBy("en", "bin").parquet(incoming)
    packed = {}
    for path in matching(spark, f"{incoming}/en=*/bin=*"):
        kind, n = path.rsplit("/", 2)[1:]
        packed[f"{name}-{n.removeprefix('bin=')}"] = None
        move(spark, path, f"{place}/{kind}/{name}-{n.removeprefix('bin=')}")
    delete(spark, incoming)

    def swapped(newer: Manifest) -> Manifest | None:
        if any(newer["slots"].get(slot) != label for slot, label in taken.items()):
            return None
        slots = {slot: label for slot, label in newer["slots"].items() if slot not in taken} | {label: label for label in packed}
        folded = dict(newer["folded"])
        for slot in chosen & batches.keys():
            stream, batch = batches[slot][1], int(batches[slot][2])
            folded[stream] = max(folded.get(stream, -1), batch)
        return {"slots": slots, "folded": folded}

    if commit(spark, place, swapped):
        return len(chosen)
    for label in packed:
        for path in matching(spark, f"{place}/en=*/{label}"):
            delete(spark, path)
    return 0


def manifest_number(spark: SparkSession, root: str, day: date) -> int:
    """Grows with every commit to a day."""
    versions = _versions(spark, day_dir(root, day))
    return int(versions[-1].rsplit("=", 1)[1]) if versions else 0


def has_day(spark: SparkSession, root: str, day: date) -> bool:
    return exists(spark, day_dir(root, day))

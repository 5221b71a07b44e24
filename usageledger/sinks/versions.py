"""Tables that change from one version to the next in a single step.

A table is a folder of Parquet files, foldered by one column, and one small list per version of the
files that belong to it. The newest list is the table: files that no list names yet, or none names any
more, are no part of it, so a run may stop anywhere before its list appears and nothing has changed.
The list is written beside and renamed to its number, the one step that publishes. It also holds the
table's schema, so that no footer is read, and a mark of the caller's, such as the newest load merged.

A list has one line per file; the driver holds it the way Spark's own file listing does. A folder
without lists is version 0 with all its files. There is one writer at a time; a second one is refused
when it publishes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from typing import Any
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from usageledger.session import scratch_path
from usageledger.sinks.files import NO_VALUE, PACKED, _folder, laid_out

LISTS = "_versions"
# Names the file of a row.
FILE = "_file"
# So many keys are sent to the rows they meet; beyond that rows and keys are shuffled.
BROADCAST_KEYS = 1_000_000


@dataclass(frozen=True)
class Version:
    """The files of a table, by their paths below it."""

    number: int = 0
    files: tuple[str, ...] = ()
    schema: str | None = None
    mark: Any = None


def _root(spark: SparkSession, path: str) -> str:
    folder, files = _folder(spark, path)
    return files.makeQualified(folder).toUri().getPath().rstrip("/")


def data_files(spark: SparkSession, path: str, batch: str = "") -> list[str]:
    """The Parquet files below a table, whatever version they belong to, or those of one write.

    Spark lists them, in parallel where there are many folders, and reads none of them.
    """
    folder, files = _folder(spark, path)
    if not files.exists(folder):
        return []
    root = _root(spark, path)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    listed = reader.option("pathGlobFilter", f"{batch}*.parquet").load(path).select("path").collect()
    return sorted(r[0][r[0].index(root) + len(root) + 1 :] for r in listed)


def numbers(spark: SparkSession, path: str) -> list[int]:
    """The versions there are."""
    folder, files = _folder(spark, f"{path}/{LISTS}")
    if not files.exists(folder):
        return []
    names = [entry.getPath().getName() for entry in files.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _list_path(path: str, number: int) -> str:
    return f"{path}/{LISTS}/{number:012d}.json"


def version(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """A version by its number, or the newest one."""
    if number is None:
        number = max(numbers(spark, path), default=0)
    if number == 0:
        files = data_files(spark, path)
        if not files or numbers(spark, path):
            return Version()
        return Version(0, tuple(files), spark.read.option("mergeSchema", True).parquet(path).schema.json())
    place, storage = _folder(spark, _list_path(path, number))
    stream = storage.open(place)
    try:
        held = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Version(number, tuple(held["files"]), held["schema"], held["mark"])


def read(spark: SparkSession, path: str, of: Version | None = None, files: Iterable[str] | None = None) -> DataFrame | None:
    """The rows of a version, the newest by default, or of some of its files; None before there is any."""
    of = version(spark, path) if of is None else of
    if of.schema is None:
        return None
    schema = StructType.fromJson(json.loads(of.schema))
    names = list(of.files if files is None else files)
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{n}" for n in names])


def in_partitions(of: Version, partition: str, values: Iterable[Any]) -> list[str]:
    """The files of some values of the partition column."""
    folders = {f"{partition}={NO_VALUE if v is None else v}" for v in values}
    return [f for f in of.files if f.split("/", 1)[0] in folders]


def add_files(
    rows: DataFrame,
    path: str,
    partition: str,
    cluster: Sequence[str] = (),
    ranged: bool = False,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> list[str]:
    """Write rows beside a table's files and return the new ones, which no version has yet.

    `finish` is applied where the rows are written, so what it computes from a row is not moved between tasks.
    """
    batch = f"b{uuid.uuid4().hex}"
    dealt = laid_out(rows, partition, cluster, ranged)
    writer = (finish(dealt) if finish else dealt).write.partitionBy(partition).options(**PACKED)
    # The names of the files begin with the batch.
    writer.option("mapreduce.output.basename", batch).mode("append").parquet(path)
    return data_files(rows.sparkSession, path, batch)


def publish(
    spark: SparkSession, path: str, files: Iterable[str], schema: StructType, mark: Any = None, after: int | None = None
) -> Version:
    """Make these files the newest version.

    With `after`, the version that the files were derived from, another run's version in between
    is an error and the table stays that run's.
    """
    newest = max(numbers(spark, path), default=0)
    if after is not None and after != newest:
        raise RuntimeError(f"{path} is at version {newest}, not at {after}: another run has published")
    made = Version(newest + 1, tuple(sorted(files)), schema.json(), mark)
    body = json.dumps({"schema": made.schema, "mark": made.mark, "files": made.files})
    beside, storage = _folder(spark, f"{path}/{LISTS}/.{uuid.uuid4().hex}")
    target, _ = _folder(spark, _list_path(path, made.number))
    out = storage.create(beside, False)
    try:
        out.write(body.encode())
    finally:
        out.close()
    if storage.exists(target) or not storage.rename(beside, target):
        storage.delete(beside, False)
        raise RuntimeError(f"{path} got version {made.number} from another run")
    spark.catalog.refreshByPath(path)
    return made


def clean(spark: SparkSession, path: str, keep: Iterable[int] | None = None) -> int:
    """Delete files that no kept version names, and the lists of the others; the newest is always kept.

    What an unfinished run wrote goes too, so no other run may be writing. Returns the files deleted.
    """
    there = numbers(spark, path)
    if not there:
        return 0
    kept = ({*keep} if keep is not None else set()) | {there[-1]}
    named = {f for n in there if n in kept for f in version(spark, path, n).files}
    gone = [f for f in data_files(spark, path) if f not in named]
    delete_files(spark, path, gone)
    for n in there:
        if n not in kept:
            old, storage = _folder(spark, _list_path(path, n))
            storage.delete(old, False)
    return len(gone)


def delete_files(spark: SparkSession, path: str, names: Iterable[str]) -> None:
    """Delete files that no reader needs any more, and folders that are left empty."""
    names = list(names)
    root, storage = _folder(spark, path)
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for name in names:
        storage.delete(make(root, name), False)
    # A folder without files would still name its partition.
    for folder in {n.rsplit("/", 1)[0] for n in names if "/" in n}:
        if not storage.listStatus(make(root, folder)):
            storage.delete(make(root, folder), False)
    spark.catalog.refreshByPath(path)


@dataclass(frozen=True)
class StagedFiles:
    """What a merge changes: the files it replaces and the rows that take their place.

    `fresh` are the updates as stored, `rows` a plan over them and the replaced files that moves no
    row of a file between tasks; what had to be shuffled for it lies below `result`.
    """

    base: Version
    result: str
    replaced: tuple[str, ...]
    schema: StructType
    fresh: DataFrame
    rows: DataFrame


def places(spark: SparkSession, path: str, of: Version, keys: DataFrame, key: str, files: Iterable[str] | None = None) -> DataFrame:
    """The keys that a version holds, each with its file. Only the key column is read."""
    held = read(spark, path, of, files).select(key, file_path())
    return held.join(keys.select(key), key, "left_semi")


def file_path() -> Column:
    """The file of a row, directly above its scan."""
    return F.col("_metadata.file_path").alias(FILE)


def file_names(spark: SparkSession, path: str, found: DataFrame) -> list[str]:
    """The files that the places name, one value per file."""
    root = _root(spark, path)
    named = found.select(FILE).distinct().collect()
    return sorted(unquote(urlparse(r[0]).path)[len(root) + 1 :] for r in named)


def holding(spark: SparkSession, path: str, of: Version, keys: DataFrame, key: str, files: Iterable[str] | None = None) -> list[str]:
    """The files of a version that hold any of the keys. Only the key column is read."""
    names = list(of.files if files is None else files)
    return file_names(spark, path, places(spark, path, of, keys, key, names)) if names else []


def few(keys: DataFrame) -> bool:
    """Whether stored keys are few enough, as counted, to be broadcast."""
    return keys.count() <= BROADCAST_KEYS


def meet(rows: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    """Rows with a stored key (`left_semi`) or without one (`left_anti`); few keys go to the rows."""
    keys = keys.select(key)
    return rows.join(F.broadcast(keys) if few(keys) else keys, key, how).select(*rows.columns)


def stage_merge(
    spark: SparkSession,
    path: str,
    base: Version,
    updates: DataFrame,
    key: str,
    files: Iterable[str] | None = None,
    stored: bool = False,
    old: DataFrame | None = None,
    more: Iterable[str] = (),
    revise: Callable[[DataFrame], DataFrame] | None = None,
) -> StagedFiles:
    """Find what a merge of keyed updates changes: the rows of the files that hold updated keys, and the updates.

    All other files go into the next version unread, also those of the same partition. `updates`
    holds one row per key; `files` says where old versions of the keys can be, by default anywhere.
    With `stored` the updates are a plan over tables that the caller keeps and that give one row per key
    without a shuffle, and `old` are the `places` of the updated keys, stored, where the caller has met them already.
    `more` names files that are written anew as well, and `revise` is applied to the rows that stay of all
    files written anew.
    """
    target = read(spark, path, base)
    result = scratch_path(spark, "merge-result")
    fresh = updates
    if not stored:
        fresh = _kept(updates, f"{result}/updates")
        if not fresh.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").isEmpty():
            raise ValueError(f"updates hold several rows for one {key}")
    if target is None:
        return StagedFiles(base, result, (), fresh.schema, fresh, fresh)
    names = list(base.files if files is None else files)
    if old is None and names:
        old = _kept(places(spark, path, base, fresh, key, names), f"{result}/places")
    replaced = file_names(spark, path, old) if old is not None else []
    others = sorted(set(more) - set(replaced))
    rest = read(spark, path, base, others)
    if replaced:
        held = read(spark, path, base, replaced)
        untouched = meet(held, old, key, "left_anti")
        if not few(old):
            # The layout runs its last stage twice, and this one would sort whole rows.
            untouched = _kept(untouched, f"{result}/untouched")
        rest = rest.unionByName(untouched) if others else untouched
    merged = (revise(rest) if revise else rest).unionByName(fresh, allowMissingColumns=True)
    return StagedFiles(base, result, (*replaced, *others), merged.schema, fresh, merged)


def _kept(rows: DataFrame, path: str) -> DataFrame:
    rows.write.options(**PACKED).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def merged_view(spark: SparkSession, path: str, staged: StagedFiles) -> DataFrame:
    """The table as it will be once the merge is published."""
    gone = set(staged.replaced)
    others = read(spark, path, staged.base, [f for f in staged.base.files if f not in gone])
    return staged.rows if others is None else others.unionByName(staged.rows, allowMissingColumns=True)


def place_merge(
    spark: SparkSession,
    path: str,
    staged: StagedFiles,
    partition: str,
    cluster: Sequence[str] = (),
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> list[str]:
    """Write the staged rows as files of the table and return the files of the merged table; see `add_files`."""
    added = add_files(staged.rows, path, partition, cluster, ranged=True, finish=finish)
    gone = set(staged.replaced)
    return [*(f for f in staged.base.files if f not in gone), *added]


def publish_merge(
    spark: SparkSession, path: str, staged: StagedFiles, partition: str, cluster: Sequence[str] = (), mark: Any = None
) -> Version:
    """The merged table as the next version; until the last step the table is as it was."""
    files = place_merge(spark, path, staged, partition, cluster)
    return publish(spark, path, files, staged.schema, mark, after=staged.base.number)

"""Deliveries of dataset files: what is new or written over is taken in, and the newest replaces its dataset.

A file is known by its path, the time it was modified and its size, kept in a manifest; a run compares the
listing with it and reads the files that differ, once, for all groups and types together. A
dataset is what its newest delivery holds, a file or a folder of parts. Its rows are
one immutable set of files per version, and a pointer row says which version readers see. Parts of a
delivery that haven't changed are taken over from the version before. A delivery with the content
that is there already changes nothing.

A run that fails leaves no trace that anyone reads, and the next one takes its place; so a run can be
repeated at any time, by a scheduler or a stream that only gives the beat. One run at a time: two that write the
same version would be in each other's way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandlake.functions.calendar import month_starting
from demandlake.functions.text import dataset_type, delivered_file, file_prefix
from demandlake.operators.bucket import bucket
from demandlake.operators.clean import filter_timestamps, normalize_names, require_fields
from demandlake.operators.manifest import SIGNATURE_SUMS, added_sums, content_sums, newest
from demandlake.sources.csv import SAMPLE_LINES, looks_like_header
from demandlake.sources.tables import PARTITION
from demandlake.sources.versions import VersionedTables
from demandlake.spec import TARGET_TIME_SERIES, DatasetSpec

_SUMS = ", ".join(f"{name} long" for name in SIGNATURE_SUMS)
# One row per file that was ever listed; files that no dataset needed were not read and have no sums.
FILES = f"file string, size long, modified timestamp, group string, dataset_type string, delivered string, {_SUMS}"
# One row per dataset: the delivery it holds, since when its content is what it is, and the version its rows lie in.
DATASETS = (
    "group string, dataset_type string, delivered string, modified timestamp, changed timestamp, stored long, signature string"
)
_DATASET = ["group", "dataset_type"]
_DELIVERY = [*_DATASET, "delivered"]


@dataclass(frozen=True)
class Intake:
    """Where files arrive, where tables are kept, and what the datasets look like.

    ``specs`` has a spec for each dataset type that is taken in; fields that types share must be of one kind.
    ``settings`` gives frequency and dimensions of the buckets of single groups, others have the
    common ones. With ``groups``, files of other groups are passed over.
    """

    folder: str
    store: str
    specs: Mapping[str, DatasetSpec]
    frequency: str
    dimensions: Sequence[str] = ()
    settings: Mapping[str, tuple[str, Sequence[str]]] = field(default_factory=dict)
    groups: Sequence[str] | None = None

    def tables(self, spark: SparkSession) -> VersionedTables:
        return VersionedTables(spark, self.store)

    @property
    def widest(self) -> T.StructType:
        return max((spec.text_struct for spec in self.specs.values()), key=len)

    @property
    def row_fields(self) -> dict[str, str]:
        """Name and type of every field of a stored row."""
        found: dict[str, str] = {}
        for spec in self.specs.values():
            renamed = {spec.identifier: "identifier", spec.target: "metric"}
            for attribute in spec.attributes:
                name, kind = renamed.get(attribute.name, attribute.name), attribute.data_type.simpleString()
                if found.setdefault(name, kind) != kind:
                    raise ValueError(f"field {name!r} is {found[name]} in one dataset type and {kind} in another")
        return found

    @property
    def row_schema(self) -> str:
        return ", ".join(f"`{name}` {kind}" for name, kind in (self.row_fields | {"file": "string"}).items())


# -------------------------------------------------------------------- listing


def listed_files(spark: SparkSession, intake: Intake) -> DataFrame:
    """Every CSV file with content below the folder, by name, time and size; no content is read."""
    found = (
        spark.read.format("binaryFile")
        .options(recursiveFileLookup="true", pathGlobFilter="*.csv")
        .load(intake.folder)
        .where(F.col("length") > 0)
        .select(
            F.col("path"),
            F.col("_metadata.file_path").alias("file"),
            F.col("length").alias("size"),
            F.col("modificationTime").alias("modified"),
        )
    )
    delivered = delivered_file(F.col("file"))
    named = found.withColumns(
        {"group": file_prefix(delivered), "dataset_type": dataset_type(delivered), "delivered": delivered}
    ).where(F.col("dataset_type").isin(*intake.specs))
    return named if intake.groups is None else named.where(F.col("group").isin(*intake.groups))


def changes(listing: DataFrame, files: DataFrame, datasets: DataFrame) -> DataFrame:
    """The files of all deliveries to take in: ``listing`` rows, and whether each has to be read.

    ``files`` is the manifest, ``datasets`` what is stored. The newest delivery of a dataset, by its
    last modified part, is taken in if it is not older than what is stored, and if it is another one or any
    part of it is new, other than before, or gone. ``stored`` is the version with rows of the parts
    that are as they were; ``moved`` says that the delivery is another one or lacks parts.
    """
    latest = newest(listing.groupBy(*_DELIVERY).agg(F.max("modified").alias("modified")), _DATASET, "modified", "delivered")
    before = files.select("file", F.col("size").alias("old_size"), F.col("modified").alias("old_modified"))
    parts = listing.join(latest.select(*_DELIVERY), _DELIVERY, "left_semi").join(before, "file", "left")
    same = F.coalesce((F.col("size") == F.col("old_size")) & (F.col("modified") == F.col("old_modified")), F.lit(False))
    parts = parts.withColumn("same", same).drop("old_size", "old_modified")
    held = datasets.select(*_DATASET, F.col("delivered").alias("held"), F.col("modified").alias("held_modified"), "stored")
    known = files.where(F.col("lines").isNotNull()).groupBy(*_DELIVERY).agg(F.count(F.lit(1)).alias("known"))
    whole = parts.groupBy(*_DELIVERY).agg(
        F.max("modified").alias("last"), F.count_if("same").alias("kept"), F.count_if(~F.col("same")).alias("others")
    )
    touched = (
        whole.join(held, _DATASET, "left")
        .join(known, _DELIVERY, "left")
        .withColumn("again", F.col("held").eqNullSafe(F.col("delivered")))
        .where(F.col("held").isNull() | F.col("again") | (F.col("last") >= F.col("held_modified")))
        .where(~F.col("again") | (F.col("others") > 0) | (F.col("known") > F.col("kept")))
        .withColumn("moved", ~F.col("again") | (F.coalesce("known", F.lit(0)) > F.col("kept") + F.col("others")))
        .select(*_DELIVERY, "again", "moved", F.when(F.col("again"), F.col("stored")).alias("stored"))
    )
    return parts.join(touched, _DELIVERY).withColumn("read", ~F.col("same") | ~F.col("again")).drop("same", "again")


# -------------------------------------------------------------------- staging


def stage(spark: SparkSession, intake: Intake, paths: Sequence[str]) -> DataFrame:
    """Lines of changed files as text, with file and place: the one time that they are parsed."""
    lines = spark.read.schema(intake.widest).csv(list(paths))
    file = F.col("_metadata.file_path")
    delivered = delivered_file(file)
    return lines.select(
        *intake.widest.fieldNames(),
        file.alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        dataset_type(delivered).alias("dataset_type"),
        file_prefix(delivered).alias("group"),
    )


def header_lines(staged: DataFrame, intake: Intake) -> list[tuple[str, int]]:
    """(file, line) of the first line of each file that starts with a header.

    Each file is judged by itself. A first line that names some fields only is compared with the
    lines below it, which are looked at for such files alone.
    """
    start = staged.where(F.col("block") == 0)
    # within the first piece of a file lines are numbered as they come; a row per file, so lines needn't be shuffled to meet them
    firsts = start.groupBy("file").agg(F.min("line").alias("line")).collect()
    firsts = staged.sparkSession.createDataFrame(firsts, "file string, line long")
    found, unsure = [], {}
    for row in start.join(F.broadcast(firsts), ["file", "line"]).collect():
        fields, at = intake.specs[row["dataset_type"]].fields, (row["file"], row["line"])
        names = _text(row, len(fields)).split(",")
        if sorted(names) == sorted(fields):
            found.append(at)
        elif set(names) & set(fields):
            unsure[at] = (fields, [])
    if unsure:
        heads = staged.sparkSession.createDataFrame(list(unsure), "file string, first long")
        within = F.col("line").between(F.col("first"), F.col("first") + SAMPLE_LINES - 1)
        for row in start.join(F.broadcast(heads), "file").where(within).orderBy("line").collect():
            fields, sample = unsure[row["file"], row["first"]]
            sample.append(_text(row, len(fields)))
    return found + [at for at, (fields, sample) in unsure.items() if looks_like_header(sample, fields)]


def _text(row, width: int) -> str:
    return ",".join(row[f"_c{i}"] or "" for i in range(width))


def cleaned_rows(staged: DataFrame, headers: Sequence[tuple[str, int]], intake: Intake) -> DataFrame:
    """Typed, complete rows of all types side by side, with their group, type and file."""
    texts = intake.widest.fieldNames()
    if headers:
        named = staged.sparkSession.createDataFrame(list(headers), "file string, line long")
        staged = staged.join(F.broadcast(named), ["file", "line"], "left_anti")
    staged = staged.select(*texts, *_DATASET, "file")  # text columns are known by their places
    result = None
    for kind, spec in intake.specs.items():
        own = filter_timestamps(staged.where(F.col("dataset_type") == kind), spec)
        typed = own.select(
            *[F.col(f"_c{i}").try_cast(a.data_type).alias(a.name) for i, a in enumerate(spec.attributes)],
            *_DATASET,
            "file",
        )
        rows = normalize_names(require_fields(typed, [f for f in spec.fields if f != spec.target]), spec)
        result = rows if result is None else result.unionByName(rows, allowMissingColumns=True)
    missing = [F.lit(None).cast(kind).alias(name) for name, kind in intake.row_fields.items() if name not in result.columns]
    return result.select("*", *missing).select(*intake.row_fields, "file", *_DATASET)


# -------------------------------------------------------------------- runs


def take_in(spark: SparkSession, intake: Intake) -> int:
    """Take in what has changed in the folder; the version that is published then, or the one that was.

    Nothing but the listing is written where no file differs from the manifest. Otherwise the steps are: stage the
    changed files, sign them, write rows of the datasets with new content, bucket those of target
    series, and write manifest and pointers, all under the next version; then publish it.
    """
    tables = intake.tables(spark)
    now = tables.current()
    version = now + 1
    files, datasets = tables.read("files", now, FILES), tables.read("datasets", now, DATASETS)
    # written, since times and sizes are looked up when rows are made, and files may change meanwhile
    found = listed_files(spark, intake)
    tables.write(found, "listed", version)
    listing = tables.read("listed", version, found.schema)
    wanted = changes(listing, files, datasets).collect()
    if not wanted:
        return now
    to_read = [r for r in wanted if r["read"]]
    tables.write(_manifest(listing, files, _signed(spark, tables, intake, version, to_read)), "files", version)
    pointers = _pointers(tables.read("files", version, FILES), files, datasets, wanted, version).collect()
    replaced = {(r["group"], r["dataset_type"]) for r in pointers if r["stored"] == version}
    if replaced:
        _store(spark, tables, intake, version, replaced, to_read, [r for r in wanted if not r["read"]])
    fresh = spark.createDataFrame(pointers, DATASETS)
    kept = datasets.join(fresh.select(*_DATASET), _DATASET, "left_anti")
    tables.write(kept.unionByName(fresh), "datasets", version)
    tables.publish(version)
    _tidy(tables, version)
    return version


def _pointers(manifest: DataFrame, files: DataFrame, datasets: DataFrame, wanted: list, version: int) -> DataFrame:
    """Pointer rows of the deliveries taken in; they point to this version where any part has other lines than before."""
    parts = manifest.sparkSession.createDataFrame([(r["file"], r["moved"]) for r in wanted], "file string, moved boolean")
    old = files.select("file", *[F.col(n).alias(f"old_{n}") for n in SIGNATURE_SUMS])
    other = ~reduce(and_, [F.col(n).eqNullSafe(F.col(f"old_{n}")) for n in SIGNATURE_SUMS])
    delivered = manifest.join(parts, "file").join(old, "file", "left").withColumn("other", other | F.col("moved"))
    about = delivered.groupBy(*_DELIVERY).agg(F.max("modified").alias("modified"), F.bool_or("other").alias("other"))
    held = datasets.select(*_DATASET, *[F.col(n).alias(f"held_{n}") for n in ("signature", "stored", "changed")])
    joined = added_sums(delivered, _DELIVERY).join(about, _DELIVERY).join(held, _DATASET, "left")
    same = F.col("signature").eqNullSafe(F.col("held_signature"))
    return joined.select(
        *_DELIVERY,
        "modified",
        F.when(same, F.col("held_changed")).otherwise(F.col("modified")).alias("changed"),
        F.when(F.col("other"), F.lit(version).cast("long")).otherwise(F.col("held_stored")).alias("stored"),
        "signature",
    )


def _signed(spark, tables, intake, version, to_read) -> DataFrame:
    """Sums per file that is read, from the staged lines; staging is written here."""
    if not to_read:
        return spark.createDataFrame([], f"file string, {_SUMS}")
    staged = stage(spark, intake, [r["path"] for r in to_read])
    tables.write(staged, "staged", version, "dataset_type", "group")
    sums = content_sums(_staged(tables, intake, version), ["file"], intake.widest.fieldNames())
    # a file of blank lines only has none to sum up
    none = spark.createDataFrame([(r["file"],) for r in to_read], "file string").join(sums, "file", "left")
    return none.select("file", *[F.coalesce(n, F.lit(0)).alias(n) for n in SIGNATURE_SUMS])


def _staged(tables: VersionedTables, intake: Intake, version: int) -> DataFrame:
    text = ", ".join(f"{c} string" for c in intake.widest.fieldNames())
    return tables.read("staged", version, f"{text}, file string, block long, line long, dataset_type string, group string")


def _manifest(listing: DataFrame, files: DataFrame, sums: DataFrame) -> DataFrame:
    """All files listed now, with new sums where they were read, and the old ones where they are as they were."""
    plain = ["file", "size", "modified", *_DELIVERY]
    old = files.select("file", "size", "modified", *[F.col(n).alias(f"old_{n}") for n in SIGNATURE_SUMS])
    both = listing.select(*plain).join(sums, "file", "left").join(old, ["file", "size", "modified"], "left")
    return both.select(*plain, *[F.coalesce(F.col(n), F.col(f"old_{n}")).alias(n) for n in SIGNATURE_SUMS])


def _store(spark, tables, intake, version, replaced, to_read, unchanged) -> None:
    """Rows of the datasets with new content: from the staged lines, and from the versions that unchanged parts lie in."""
    chosen = spark.createDataFrame(sorted(replaced), "group string, dataset_type string")
    rows = None
    if to_read:
        staged = _staged(tables, intake, version).join(F.broadcast(chosen), _DATASET, "left_semi")
        rows = cleaned_rows(staged, header_lines(staged, intake), intake)
    kept = [r for r in unchanged if (r["group"], r["dataset_type"]) in replaced]
    if kept:
        # a dataset without rows has no folder
        folders = [f for f in sorted({_dataset_folder(tables, r) for r in kept}) if tables.exists(f)]
        schema = f"{intake.row_schema}, version long, dataset_type string, group string"
        stored = spark.read.schema(schema).option("basePath", f"{tables.path}/rows")
        before = stored.parquet(*folders) if folders else spark.createDataFrame([], schema)
        names = spark.createDataFrame([(r["file"],) for r in kept], "file string")
        over = before.join(names, "file", "left_semi").select(*intake.row_fields, "file", *_DATASET)
        rows = over if rows is None else rows.unionByName(over)
    # staged files hold a group and type each, so tasks write few files without a shuffle
    tables.write(rows, "rows", version, "dataset_type", "group")
    targets = sorted(group for group, kind in replaced if kind == TARGET_TIME_SERIES)
    if targets:
        _bucket(spark, tables, intake, version, targets)


def _dataset_folder(tables: VersionedTables, row) -> str:
    kind, group = tables.part("dataset_type", row["dataset_type"]), tables.part("group", row["group"])
    return f"{tables.folder('rows', row['stored'])}/{kind}/{group}"


def _bucket(spark, tables, intake, version, targets) -> None:
    """Buckets of the target series of all groups, those with the same settings at once."""
    by_setting: dict[tuple[str, tuple[str, ...]], list[str]] = {}
    for group in targets:
        frequency, dimensions = intake.settings.get(group, (intake.frequency, intake.dimensions))
        by_setting.setdefault((frequency, tuple(dimensions)), []).append(group)
    schema = f"{intake.row_schema}, dataset_type string, group string"
    rows = tables.read("rows", version, schema).where(F.col("dataset_type") == TARGET_TIME_SERIES)
    result = None
    for (frequency, dimensions), groups in by_setting.items():
        summed = bucket(rows.where(F.col("group").isin(*groups)), frequency, ["group", *dimensions])
        result = summed if result is None else result.unionByName(summed, allowMissingColumns=True)
    laid_out = result.withColumn(PARTITION, month_starting("timestamp")).hint("rebalance", "group", PARTITION)
    tables.write(laid_out, "buckets", version, "group", PARTITION)


def _tidy(tables: VersionedTables, version: int) -> None:
    """Remove staged lines, and what no dataset pointed at in the version before this one either.

    Readers that still go by the version before find their files. What is listed here is what that
    version replaced, so a folder is removed by the run after the one that replaced it.
    """
    gone = [tables.folder("staged", version), tables.folder("listed", version)]
    if version > 2:
        then, before = (tables.read("datasets", v, DATASETS).select(*_DATASET, "stored") for v in (version - 2, version - 1))
        for row in then.join(before, [*_DATASET, "stored"], "left_anti").collect():
            gone.append(_dataset_folder(tables, row))
            if row["dataset_type"] == TARGET_TIME_SERIES:
                gone.append(f"{tables.folder('buckets', row['stored'])}/{tables.part('group', row['group'])}")
        gone += [tables.folder(table, version - 2) for table in ("files", "datasets")]
    tables.remove(*gone)


# -------------------------------------------------------------------- readers


def current_datasets(spark: SparkSession, intake: Intake) -> DataFrame:
    """The pointer rows: what each dataset holds, and since when."""
    tables = intake.tables(spark)
    return tables.read("datasets", tables.current(), DATASETS)


def current_rows(spark: SparkSession, intake: Intake, kind: str) -> DataFrame:
    """Cleaned rows of all current datasets of a type, with their group."""
    spec = intake.specs[kind]
    renamed = {spec.identifier: "identifier", spec.target: "metric"}
    fields = [renamed.get(f, f) for f in spec.fields]
    rows = _visible(spark, intake, "rows", kind, f"{intake.row_schema}, version long, dataset_type string, group string")
    return rows.select("group", *fields)


def current_buckets(spark: SparkSession, intake: Intake) -> DataFrame:
    """Buckets of all current target datasets, with their group; dimensions that a group doesn't have are null."""
    dimensions = dict.fromkeys([*intake.dimensions, *(d for _, names in intake.settings.values() for d in names)])
    kinds = {name: intake.row_fields[name] for name in ("identifier", *dimensions, "timestamp", "metric")}
    schema = ", ".join(f"`{name}` {kind}" for name, kind in kinds.items())
    rows = _visible(spark, intake, "buckets", TARGET_TIME_SERIES, f"{schema}, version long, group string, {PARTITION} string")
    return rows.select("group", *kinds, PARTITION)


def _visible(spark: SparkSession, intake: Intake, table: str, kind: str, schema: str) -> DataFrame:
    tables = intake.tables(spark)
    pointers = tables.read("datasets", tables.current(), DATASETS).where(F.col("dataset_type") == kind)
    inner = f"/{tables.part('dataset_type', kind)}" if table == "rows" else ""
    folders = [
        f"{tables.folder(table, r['stored'])}{inner}/{tables.part('group', r['group'])}"
        for r in pointers.select("group", "stored").collect()
    ]
    # a dataset without rows has no folder
    folders = [f for f in folders if tables.exists(f)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{tables.path}/{table}").parquet(*folders)

"""Writing: partition overwrites, appends, compaction, file layout and key guards (Parquet)."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from .checkpoints import stored


def layout(df: DataFrame, files: int | None = None, cols: Sequence[str] = ()) -> DataFrame:
    """Fix the number of output tasks, spreading rows of one output partition over them.

    Without ``files`` the rows are left where they are and adaptive execution decides. With ``files`` the rows
    go round-robin by a hash of the whole row next to ``cols``, so a partition value that holds most rows is
    still written by many tasks.
    """
    if files is None:
        return df
    if not cols:
        return df.repartition(files)
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files))
    return df.repartition(files, *[F.col(c) for c in cols], spread)


def overwrite_partitions(
    df: DataFrame, path: str, cols: Sequence[str], files: int | None = None, codec: str = "snappy"
) -> None:
    """Replace exactly the partitions that occur in ``df``; other partitions of ``path`` stay."""
    (
        layout(df, files, cols).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").option("compression", codec)
        .partitionBy(*cols).parquet(path)
    )


def overwrite_one_partition(
    df: DataFrame, path: str, spec: Mapping[str, str], files: int | None = None, codec: str = "snappy"
) -> None:
    """Replace the one partition named by ``spec``; a column of that name in ``df`` is overridden."""
    fixed = df.withColumns({k: F.lit(v) for k, v in spec.items()})
    overwrite_partitions(fixed, path, list(spec), files, codec)


def append_new(df: DataFrame, path: str, codec: str = "snappy") -> None:
    """Append rows."""
    df.write.mode("append").option("compression", codec).parquet(path)


def affected_partitions(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct partition tuples of ``df``."""
    return df.select(*cols).distinct()


def guard_keys(
    df: DataFrame, keys: Sequence[str], observation: Observation | None = None
) -> DataFrame:
    """Drop rows with a NULL key. ``observation`` receives ``rows_in`` and ``rows_dropped`` of the same pass."""
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    if observation is not None:
        df = df.observe(
            observation,
            F.count(F.lit(1)).alias("rows_in"),
            F.count(F.when(~complete, 1)).alias("rows_dropped"),
        )
    return df.filter(complete)


def replace_single_partition(
    df: DataFrame, path: str, col: str, files: int | None = None, codec: str = "snappy"
) -> str:
    """Replace one partition of ``path``; refuses unless ``df`` holds exactly one value of ``col``.

    Only two distinct values at most reach the driver.
    """
    found = [r[0] for r in df.select(col).distinct().limit(2).collect()]
    if len(found) != 1 or found[0] is None:
        raise ValueError(f"expected exactly one {col}, found {found}")
    overwrite_one_partition(df, path, {col: found[0]}, files, codec)
    return found[0]


def partition_files(spark, path: str, cols: Sequence[str]) -> DataFrame:
    """Number and bytes of the Parquet files of each partition, from their listing; no file is opened."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return listed.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("bytes"))


def file_listing(spark, path: str, cols: Sequence[str]) -> DataFrame:
    """Partition columns, ``file``, ``at`` and ``bytes`` of every Parquet file of ``path``, from the listing.

    ``file`` is the name as scans give it, with escapes; ``at`` is the path that file systems know.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return listed.select(*cols, F.col("_metadata.file_path").alias("file"), F.col("path").alias("at"), F.col("length").alias("bytes"))


def compaction_plan(
    spark, path: str, cols: Sequence[str], file_bytes: int = 512 << 20, threshold: int = 5
) -> DataFrame:
    """The files to be put together: partition columns, ``file``, ``at``, ``bytes``, and ``wanted``, the files to make of them.

    Files of an earlier compaction to this size stay when they are at least half full. A partition has a plan if it has
    more than ``threshold`` other files and fewer would do: ``wanted`` is their bytes by ``file_bytes``, rounded up.
    """
    name = F.substring_index("file", "/", -1)
    made = name.startswith(f"{COMPACTED}{file_bytes}-")
    loose = file_listing(spark, path, cols).withColumn("made", made).filter(
        ~F.col("made") | (F.col("bytes") * 2 < file_bytes))
    totals = loose.groupBy(*cols).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("made")).alias("new"),
        F.ceil(F.sum("bytes") / file_bytes).alias("wanted")).filter(
        (F.col("new") > threshold) & (F.col("n") > F.col("wanted"))).select(
        *[F.col(c).alias(f"_{c}") for c in cols], F.greatest("wanted", F.lit(1)).alias("wanted"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in cols])
    return loose.join(totals, same).select(*cols, "file", "at", "bytes", "wanted")


# Beginnings of the names of compacted files and of files that wait for their turn, and the end of the name of the folder,
# beside the table and so in its file system, for plans and new rows.
COMPACTED, WAITING, PLANS, MOVES = "compact-", "_waiting-", ".compaction", "moves-"


def _moves(spark, path: str, run: str) -> None:
    """Carry out a plan of moves that is written as a whole: new files in, old files out. May be repeated."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    plan = spark.read.schema("kind string, source string, target string").json(f"{path}{PLANS}/{run}")
    # Names only, one at a time; their number is that of the files that are replaced.
    for move in plan.filter("kind = 'new'").select("source", "target").toLocalIterator():
        if fs.exists(hadoop(move.source)):
            fs.mkdirs(hadoop(move.target).getParent())
            if not fs.rename(hadoop(move.source), hadoop(move.target)):
                raise OSError(f"could not rename {move.source} to {move.target}")
    for old in plan.filter("kind = 'old'").select("source").toLocalIterator():
        fs.delete(hadoop(old.source), False)
    for new in plan.filter("kind = 'new'").select("target").toLocalIterator():
        folder, name = new.target.rsplit("/", 1)
        if fs.exists(hadoop(new.target)):
            fs.rename(hadoop(new.target), hadoop(f"{folder}/{name.removeprefix(WAITING)}"))
    fs.delete(hadoop(f"{path}{PLANS}/{run}"), True)


def finish_compaction(spark, path: str) -> int:
    """Carry out plans that an interrupted compaction left whole; returns their number. Unfinished ones are dropped."""
    hadoop, path = spark._jvm.org.apache.hadoop.fs.Path, path.rstrip("/")
    folder = hadoop(f"{path}{PLANS}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    runs = [s.getPath() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    whole = [r for r in runs if r.getName().startswith(MOVES) and fs.exists(hadoop(r, "_SUCCESS"))]
    for r in whole:
        _moves(spark, path, r.getName())
    if fs.exists(folder):
        fs.delete(folder, True)
    return len(whole)


def compact_partitions(
    spark, path: str, cols: Sequence[str], file_bytes: int = 512 << 20, threshold: int = 5, codec: str = "gzip"
) -> int:
    """Put the files of crowded partitions of ``path`` together, see :func:`compaction_plan`; returns the partitions done.

    Rows are read, shuffled and written once, into a folder beside ``path``. A plan of all moves is written there, too; then new files enter under names that readers pass over, old files go, and the new ones are named.
    Nothing is lost at any interruption: before the plan is whole the table is untouched, afterwards the next
    compaction (or :func:`finish_compaction`) carries it out. Not meant for tables that are read meanwhile.
    """
    finish_compaction(spark, path)
    root, run = path.rstrip("/"), uuid.uuid4().hex
    plan = stored(compaction_plan(spark, path, cols, file_bytes, threshold), "compaction-plan")
    done = plan.select(*cols).distinct().count()
    if not done:
        return 0
    table = spark.read.parquet(path)
    names = plan.select(F.col("file").alias("_file"), F.col("wanted").alias("_wanted"))
    # A row's place decides its new file, so that each gets a like share, however many read splits an old one has.
    place = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    chosen = table.select("*", F.col("_metadata.file_path").alias("_from"), place.alias("_place")).join(
        names, F.col("_from") == F.col("_file"))
    staged = f"{root}{PLANS}/rows-{run}"
    (
        chosen.withColumn("_part", F.pmod("_place", F.col("_wanted")).cast("int")).drop("_from", "_file", "_place", "_wanted")
        .repartition(*[F.col(c) for c in cols], F.col("_part"))
        .write.partitionBy(*cols, "_part").option("compression", codec).parquet(staged)
    )
    number = F.regexp_extract("source", r"/_part=([^/]*)/", 1)
    new = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(staged).select(
        F.lit("new").alias("kind"), F.col("path").alias("source"))
    new = new.withColumn("target", F.concat(
        F.lit(f"{root}/"), F.expr(f"substring(source, instr(source, '{run}') + {len(run) + 1})")))
    new = new.withColumn("target", F.concat(
        F.regexp_replace("target", r"/_part=[^/]*/[^/]*$", ""),
        F.concat(F.lit(f"/{WAITING}{COMPACTED}{file_bytes}-{run}-"), number, F.lit(".parquet"))))
    old = plan.select(F.lit("old").alias("kind"), F.col("at").alias("source"), F.lit(None).cast("string").alias("target"))
    new.unionByName(old).coalesce(1).write.json(f"{root}{PLANS}/{MOVES}{run}")
    _moves(spark, root, f"{MOVES}{run}")
    finish_compaction(spark, path)
    return done


class ChecksFailed(ValueError):
    """Rows that were written to a staging place are not published; ``violations`` has the failed checks."""

    def __init__(self, violations: Mapping[str, int]):
        super().__init__(f"not published: {dict(violations)}")
        self.violations = dict(violations)


def publish_checked(
    df: DataFrame, path: str, cols: Sequence[str], checks: Mapping[str, Column], helpers: Sequence[str] = (),
    files: int | None = None, codec: str = "snappy",
) -> dict[str, int]:
    """Write, audit, publish: replace the partitions that occur in ``df``, if all checks find 0 violations.

    ``checks`` maps names to aggregates over ``df`` that count violations; the job that writes the rows to a staging place
    beside ``path`` counts them, so the rows are made once. They are counted in the last stage of that job, where
    a repeated task counts once. ``helpers`` are columns that only the checks need. With a violation
    :class:`ChecksFailed` is raised and the table is as it was. Otherwise a plan of moves is written and carried out as in
    :func:`compact_partitions`: what is interrupted before the plan is whole changes nothing, what is interrupted later is carried
    out by the next run or :func:`finish_compaction`. Returns the counts, and the rows as ``rows``. An empty ``df`` replaces nothing. Not meant for tables that are
    read meanwhile.
    """
    spark, root, run = df.sparkSession, path.rstrip("/"), uuid.uuid4().hex
    finish_compaction(spark, root)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    staged = f"{root}{PLANS}/rows-{run}"
    fs = hadoop(root).getFileSystem(spark._jsc.hadoopConfiguration())
    seen = Observation()
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(f"check_{i}") for i, c in enumerate(checks.values())]
    (
        layout(df, files, cols).observe(seen, F.count(F.lit(1)).alias("rows"), *counts).drop(*helpers)
        .write.partitionBy(*cols).option("compression", codec).parquet(staged)
    )
    found = seen.get
    report = {name: found[f"check_{i}"] for i, name in enumerate(checks)}
    failed = {name: n for name, n in report.items() if n}
    if failed or not found["rows"]:
        fs.delete(hadoop(f"{root}{PLANS}"), True)
        if failed:
            raise ChecksFailed(failed)
        return {**report, "rows": 0}

    def listed(folder: str) -> DataFrame:
        """Files below a folder, and their partition as the text of their own folders."""
        base = hadoop(folder).toUri().getPath()
        source = F.col("path")
        below = F.substr(source, F.instr(source, F.lit(base)) + F.lit(len(base)))
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
            "recursiveFileLookup", "true").load(folder)
        return files.select(source.alias("source"), below.alias("below")).select(
            "source", F.regexp_extract("below", "^(.*)/[^/]*$", 1).alias("part"), F.substring_index("below", "/", -1).alias("name"))

    fresh = stored(listed(staged), "published-files")
    moves = fresh.select(F.lit("new").alias("kind"), "source", F.concat(
        F.lit(root), "part", F.lit(f"/{WAITING}"), "name").alias("target"))
    if fs.exists(hadoop(root)):
        replaced = listed(root).join(fresh.select("part").distinct(), "part", "left_semi")
        moves = moves.unionByName(replaced.select(
            F.lit("old").alias("kind"), "source", F.lit(None).cast("string").alias("target")))
    moves.coalesce(1).write.json(f"{root}{PLANS}/{MOVES}{run}")
    _moves(spark, root, f"{MOVES}{run}")
    finish_compaction(spark, root)
    return {**report, "rows": found["rows"]}

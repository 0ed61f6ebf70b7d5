"""Where rows go: spreading, staging, and joins that stay safe for any size and any skew.

Nothing here is specific to reviews. The rules the other operators rely on:

* a side is broadcast only after its rows and bytes were counted;
* a table that does not fit is joined by shuffle, after the keys that would fill a good part of a
  partition by themselves were taken out;
* an intermediate result that several jobs need is written to the shared checkpoint folder, so a lost
  executor never costs more than reading that folder again.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

PIN_ROWS = 100_000
BROADCAST_BYTES = 256 * 1024 * 1024

_local_folder: dict[str, str] = {}


def as_list(names: str | list[str] | tuple[str, ...]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folder:
        _local_folder[app] = tempfile.mkdtemp(prefix="reviewlake-")
    return _local_folder[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/reviewlake/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written Parquet.

    Later jobs prune its columns and know its true size; the lineage ends at the files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(*staged: DataFrame) -> None:
    """Delete tables that ``stage`` has written and that nothing reads any more."""
    for folder in {os.path.dirname(file) for df in staged for file in df.inputFiles()}:
        if "/reviewlake/" in folder:
            path = staged[0].sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(staged[0].sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished plans now: it does so once the driver has collected what held them."""
    spark.sparkContext._jvm.System.gc()


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition a scan that has fewer splits than the cluster has cores; otherwise leave it alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys) if keys else df.repartition(cores)


def colocate(df: DataFrame, keys: list[str]) -> DataFrame:
    """One hash shuffle on ``keys``; later groupings and windows that contain them need no further one.

    The partition count is given, because after the rows are exploded the input size says little
    about the work and coalescing on it would undo the parallelism.
    """
    return df.repartition(shuffle_width(df.sparkSession), *keys)


def _row_bytes(df: DataFrame) -> Column:
    total: Column = F.lit(0)
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = F.coalesce(F.octet_length(column), F.lit(0)) + 16
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) + 16
        else:
            size = F.lit(16)
        total = total + size
    return total


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Count the bytes of ``df`` (cheap on a staged table) and say whether it may be broadcast."""
    size = df.agg(F.sum(_row_bytes(df).cast("bigint")).alias("size")).first()["size"]
    return (size or 0) <= max_bytes


def pin_small(df: DataFrame, label: str, max_rows: int = PIN_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Evaluate an aggregate that is expected to be tiny, exactly once.

    Up to ``max_rows`` rows come back as a local relation marked for broadcast. A bigger result is
    staged instead and joined by whatever strategy its size calls for. Wide rows, which could be many
    bytes before they are counted, are staged and measured first.
    """
    if any(not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)) for f in df.schema.fields):
        df = stage(df, label)
        if not fits_broadcast(df, max_bytes):
            return df
    head = df.limit(max_rows + 1).toArrow()
    if head.num_rows <= max_rows and head.nbytes <= max_bytes:
        return F.broadcast(df.sparkSession.createDataFrame(head, schema=df.schema))
    return stage(df, label)


def _hot_keys(frequency: DataFrame, share: float) -> DataFrame | None:
    """Keys of ``frequency`` (keys..., _n) that fill at least ``share`` of an average shuffle partition.

    There are at most ``partitions / share`` of them, which bounds what comes to the driver. The total
    is observed in the same job that finds the largest counts.
    """
    spark = frequency.sparkSession
    partitions = shuffle_width(spark)
    seen = Observation()
    counted = frequency.observe(seen, F.sum("_n").alias("total"))
    head = counted.orderBy(F.desc("_n")).limit(int(partitions / share) + 1).toArrow()
    least = share * (seen.get["total"] or 0) / partitions
    head = head.filter([n >= least for n in head.column("_n").to_pylist()]).drop_columns(["_n"])
    if head.num_rows == 0:
        return None
    return F.broadcast(spark.createDataFrame(head, schema=frequency.drop("_n").schema))


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: str | list[str],
    how: str = "inner",
    hot_by: str | None = None,
    max_bytes: int = BROADCAST_BYTES,
    hot_share: float = 0.5,
    one_row_per_key: bool = False,
) -> DataFrame:
    """Join a table with a lookup table that holds few rows per key (``how``: inner or left).

    A lookup whose counted size is below ``max_bytes`` is broadcast. Otherwise keys that would fill a
    good part of a shuffle partition, found from ``hot_by`` (a frequency column of ``small``) or by
    counting ``big``, are served from a broadcast slice, and all other rows by a shuffle join. The two
    parts cover every row; rows with a NULL key match nothing and go with the first part. Without such
    keys it is one plain shuffle join. ``small`` is read several times, so stage it first. A ``big`` that has
    ``one_row_per_key`` cannot have hot keys: it is joined at once, without being counted.
    """
    keys = as_list(on)
    if fits_broadcast(small, max_bytes):
        return big.join(F.broadcast(small), keys, how)
    if one_row_per_key:
        return big.join(small, keys, how)

    if hot_by:
        frequency = small.groupBy(*keys).agg(F.max(hot_by).alias("_n"))
    else:
        frequency = big.groupBy(*keys).agg(F.count("*").alias("_n"))
    hot = _hot_keys(frequency, hot_share)
    if hot is None and (how == "inner" or hot_by is None):
        return big.join(small, keys, how)

    null_key = F.lit(False)
    for key in keys:
        null_key = null_key | F.col(key).isNull()
    if hot is None:
        flagged, is_hot, hot_slice = big, null_key, small.limit(0)
    else:
        flagged = big.join(hot.withColumn("_hot", F.lit(True)), keys, "left")
        is_hot = F.coalesce(F.col("_hot"), F.lit(False)) | null_key
        hot_slice = pin_small(small.join(hot, keys, "left_semi"), "hot_slice")
    first = flagged.where(is_hot).drop("_hot").join(hot_slice, keys, how)
    rest = flagged.where(~is_hot).drop("_hot").join(small, keys, how)
    return first.unionByName(rest)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this library: Spark serves it to every executor, once per application.

    Nothing is done where PYTHONPATH, which workers inherit, already names the library's folder.
    """
    root = Path(__file__).resolve().parents[2]
    context = spark.sparkContext
    if context.applicationId in _shipped or str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    package = root / Path(__file__).resolve().parents[1].name
    archive = Path(tempfile.mkdtemp(prefix="ship-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(root))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)

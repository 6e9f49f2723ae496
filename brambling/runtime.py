"""Session helpers: reading tables, cutting lineage durably, joining without hot tasks."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

_own_dirs: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The stored table `name`, as it is."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def local(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small table held by the driver. Made from Arrow it is a local relation, whose size the optimizer knows (from plain rows it doesn't)."""
    fields = StructType.fromDDL(schema).fields
    arrays = [pa.array([r[i] for r in rows], to_arrow_type(f.dataType)) for i, f in enumerate(fields)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=[f.name for f in fields]))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session. Where that is unset, an own one on this machine, which only a
    local master can use; on a cluster that is an error."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="brambling-")
        atexit.register(shutil.rmtree, _own_dirs[app], True)
    return "file://" + _own_dirs[app]


def cut(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back: later readers neither recompute it nor lose it with an executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/brambling/{label}-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def discard(df: DataFrame | None) -> None:
    """Remove the files of a table that `cut` wrote and nothing will read again, such as the last round of a loop."""
    if df is not None and (path := df.__dict__.get("cut_path")):
        jvm_path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        jvm_path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(jvm_path, True)


def attach(big: DataFrame, small: DataFrame, keys: list[str], weight: str, total: int, by: Sequence[str] = (), hot_share: float = 0.002) -> DataFrame:
    """Inner join of rows to their groups that never sends one group to one task.

    `small` has one row per key and in `weight` the number of `big`'s rows with it. Keys that hold more than `hot_share` of
    `total` rows number at most 1 / hot_share, so that list alone is broadcast. A hot key's rows are spread over one task for every
    `hot_share` of all rows it holds, by a hash of the columns `by` (all, where none are given), which tell its rows apart, so that a task run again
    deals them the same way; its row of `small` is copied as often, 2 / hot_share copies at most in all.
    """
    most = max(1000, int(total * hot_share))
    salts = F.ceil(F.col(weight) / most).cast("int")
    hot = small.where(F.col(weight) > most).select(*keys, salts.alias("_salts"))
    spread = F.pmod(F.xxhash64(*(by or big.columns)), F.col("_salts")).cast("int")
    left = big.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.coalesce(spread, F.lit(0))).drop("_salts")
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.greatest(salts, F.lit(1)) - 1)))
    return left.join(right, [*keys, "_salt"]).drop("_salt")


def blank_to_null(c: Column) -> Column:
    """Trimmed text; null where nothing is left."""
    t = F.trim(c)
    return F.when(t != "", t)

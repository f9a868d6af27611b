"""Tables written to the shared folder: how iterative operators cut their lineage.

A table on the folder named in ``spark.checkpoint.dir`` survives the loss of any executor and, unlike an
RDD checkpoint, is columnar, compressed and computed once.
"""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a folder of our own only on a local master that names none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        folder = tempfile.TemporaryDirectory(prefix="venueweave-")
        atexit.register(folder.cleanup)
        _own[app] = f"file://{folder.name}"
    return _own[app]


class Stash:
    """A DataFrame written once to the shared folder. ``df`` reads it, ``drop`` deletes it."""

    def __init__(self, df: DataFrame, name: str = "t"):
        spark = df.sparkSession
        self._spark = spark
        self.path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        # numbers are ids, hashes and measures, mostly distinct: a dictionary costs more than it saves
        numbers = {f"parquet.enable.dictionary#{c}": "false" for c, kind in df.dtypes if kind in ("bigint", "double")}
        df.write.options(compression="zstd", **numbers).parquet(self.path)
        self.df = spark.read.schema(df.schema).parquet(self.path)
        self._rows: int | None = None

    @property
    def rows(self) -> int:
        """Row count, from the files' footers."""
        if self._rows is None:
            self._rows = self.df.count()
        return self._rows

    def drop(self) -> None:
        jvm = self._spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: A side is broadcast only if it was measured and takes at most so many bytes in memory.
BROADCAST_BYTES = 32 << 20
#: Rows of a few plain columns that stay within those bytes.
BROADCAST_ROWS = 200_000
#: Bytes of a row in a hash relation besides its values.
_ROW_BYTES = 64
_NESTED = ("array", "map", "struct", "string", "binary", "variant")


def measured_bytes(df: DataFrame) -> int:
    """Bytes that the rows of ``df`` take in a hash relation, from one aggregate over it: strings by their length, nested
    values by twice that of their JSON text, everything else by eight bytes."""
    per_row = F.lit(_ROW_BYTES + 8 * len(df.columns)).cast("bigint")
    for name, kind in df.dtypes:
        if kind.startswith(_NESTED):
            text = F.col(f"`{name}`") if kind == "string" else F.to_json(F.struct(F.col(f"`{name}`").alias("v")))
            per_row = per_row + (1 if kind == "string" else 2) * F.coalesce(F.octet_length(text), F.lit(0))
    return df.agg(F.coalesce(F.sum(per_row), F.lit(0))).first()[0]


def broadcast_if_small(stash: Stash, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The stashed table with a broadcast hint if its measured bytes stay within ``limit``, else as it is."""
    plain = not any(kind.startswith(_NESTED) for _, kind in stash.df.dtypes)
    size = stash.rows * (_ROW_BYTES + 8 * len(stash.df.columns)) if plain else measured_bytes(stash.df) if stash.rows * _ROW_BYTES <= limit else limit + 1
    return F.broadcast(stash.df) if size <= limit else stash.df


def spread(stash: Stash, per_task: int) -> DataFrame:
    """The stashed rows dealt evenly to tasks of at most about ``per_task`` rows, and to every core: for work that costs CPU
    out of proportion to its bytes, by which adaptive execution would join partitions."""
    cores = stash.df.sparkSession.sparkContext.defaultParallelism
    return stash.df.repartition(max(cores, -(-stash.rows // per_task)))


def sweep(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished plans: it does so when the driver's collector finds them unused, which
    a driver with little to do may not run for long. The first round lets go of the plan, the second finds its files unused. For
    the seams between the phases of a long operator."""
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()

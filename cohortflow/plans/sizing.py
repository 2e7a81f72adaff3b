"""Stored stages for long plans, and the bounds on what may be broadcast."""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

#: Bytes of Parquet up to which a stored reference table is broadcast; above it is shuffled.
BROADCAST_BYTES = 8 << 20


def checked_rules(rules: DataFrame, max_rules: int) -> DataFrame:
    """``rules`` in one partition, refused with an error above ``max_rules`` rows (at most one more is
    read). What is derived from rules alone then needs no exchange."""
    if rules.limit(max_rules + 1).count() > max_rules:
        raise ValueError(f"the rule table has more than {max_rules} rows (Policy.max_rules)")
    return rules.coalesce(1)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The cluster's shared checkpoint folder, if the session names one."""
    return spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or None


def _path(spark: SparkSession, path: str):
    """The file system of a path, and the path as Hadoop has it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


class Stages:
    """Stages written to the shared checkpoint folder and read back.

    A stored stage is computed once and survives the loss of an executor. Stored ``by`` a key it is
    a bucketed table (as many buckets as shuffle partitions), so joins and groupings of stored
    stages by that key need no exchange. Without a configured folder all stages stay lazy, with a
    warning: later ones then compute them again. :meth:`close` removes tables and files.
    """

    def __init__(self, stored: bool = True):
        self.stored = stored
        self.paths: list[tuple[SparkSession, str, str | None]] = []
        self.large: list[DataFrame] = []

    def _new_path(self, df: DataFrame) -> str | None:
        folder = checkpoint_dir(df.sparkSession) if self.stored else None
        if self.stored and not folder:
            log.warning("spark.checkpoint.dir is not set: a stage that several others read stays lazy")
        return folder and f"{folder.rstrip('/')}/stage-{uuid.uuid4().hex}"

    def cut(self, df: DataFrame, by: str | None = None, dealt: bool = False) -> DataFrame:
        """``df`` stored, bucketed ``by`` a column if one is given. ``dealt``: its rows are already
        dealt by that column, so they are written where they are."""
        path, spark = self._new_path(df), df.sparkSession
        if not path:
            return df
        if by is None:
            df.write.parquet(path)
            self.paths.append((spark, path, None))
            return spark.read.schema(df.schema).parquet(path)
        n, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"stage_{uuid.uuid4().hex}"
        self.paths.append((spark, path, name))
        (df if dealt else df.repartition(n, by)).write.format("parquet").bucketBy(n, by).sortBy(by).option("path", path).saveAsTable(name)
        return spark.table(name)

    def small(self, df: DataFrame) -> DataFrame:
        """A reference table, stored; to be broadcast if its files are small, else left to a shuffle."""
        out = self.cut(df)
        if out is df:
            return df
        fs, path = _path(df.sparkSession, self.paths[-1][1])
        if fs.getContentSummary(path).getLength() <= BROADCAST_BYTES:
            return F.broadcast(out)
        self.large.append(out)
        return out

    def is_large(self, df: DataFrame) -> bool:
        """Whether ``df`` is a stored reference table that is left to a shuffle."""
        return any(df is x for x in self.large)

    def close(self) -> None:
        """Drop all that was stored; frames that read it can't be used any more."""
        while self.paths:
            spark, path, name = self.paths.pop()
            if name:
                spark.sql(f"DROP TABLE IF EXISTS {name}")
            fs, p = _path(spark, path)
            fs.delete(p, True)


def cut_lineage(df: DataFrame, by: str | None = None) -> DataFrame:
    """``df`` stored once in the shared checkpoint folder, bucketed ``by`` a column if one is given
    (see :class:`Stages`)."""
    return Stages().cut(df, by)

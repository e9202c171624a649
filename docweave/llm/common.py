"""Helpers shared by the operators: tables, the cluster's shared folder, written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One word: a run of anything but the ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share, spark.checkpoint.dir. Where it is unset, a local session has a temporary folder
    of its own; on a cluster that is an error, as no machine's own folder is seen by the others."""
    root, context = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext
    if not root:
        if context.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = context._docweave_shared = getattr(context, "_docweave_shared", None) or "file://" + tempfile.mkdtemp(prefix="docweave-")
    return root.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; it is removed when the driver's JVM ends."""
    path = f"{shared_root(spark)}/docweave-{label}-{uuid.uuid4().hex}"
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(target)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage, survives a lost executor."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """Bounds what a Python worker holds of a table with long texts: at most `rows` rows come to it at once, by a session setting."""
    key, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession.conf
    if not 0 < int(conf.get(key)) <= rows:
        conf.set(key, str(rows))
    return df


class Sheltered:
    """Columns of a table whose names an operator uses for columns of its own: `df` has them under other names,
    and `restored` brings them back. A column named like a result gives way to it, unless it is asked for."""

    def __init__(self, df: DataFrame, own: set[str], used: set[str]):
        """own: names that the operator makes, for results or by the way; used: those of df that it reads."""
        low, read = {c.lower() for c in own}, {c.lower() for c in used}
        taken = {c.lower() for c in df.columns} | low
        self.names, renamed = {}, {}
        for c in df.columns:
            name = c
            if c.lower() in low and c.lower() not in read:
                while name.lower() in taken:
                    name += "_"
                taken.add(name.lower())
                renamed[c] = name
            self.names[c] = name
        self.df = df.withColumnsRenamed(renamed) if renamed else df

    def restored(self, df: DataFrame, results: list[str] | tuple[str, ...] = ()) -> DataFrame:
        """The table's own columns, those named like a result left out, and then the results."""
        low = {c.lower() for c in results}
        kept = [quoted(new).alias(old) for old, new in self.names.items() if old.lower() not in low]
        return df.select(*kept, *[quoted(c) for c in results])


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def position(df: DataFrame, name: str) -> int:
    """The place of a column by its name as Spark takes names: in any case, unless several columns differ in case alone."""
    exact = [i for i, c in enumerate(df.columns) if c == name]
    found = exact or [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
    if len(found) != 1:
        raise ValueError(f"there is {'no' if not found else 'more than one'} column {name} in {', '.join(df.columns)}")
    return found[0]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")

"""Expressions and session helpers that every operator shares."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that Python's str.strip() takes as white space.
BLANKS = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(c: Column | str) -> Column:
    """Trim all Unicode white space; F.trim alone takes spaces only."""
    return F.trim(F.col(c) if isinstance(c, str) else c, F.lit(BLANKS))


def symbol_key(c: Column | str) -> Column:
    """Symbols are compared trimmed and in upper case; a blank one counts as null."""
    return F.nullif(F.upper(strip(c)), F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; timestamps without zone are read as UTC instants."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.withColumns({f.name: F.col(f.name).cast("timestamp") for f in df.schema if f.dataType.typeName() == "timestamp_ntz"})


#: Constraints double with each alias that repeats an expression, so long chains of derived columns never get planned.
CONSTRAINTS = "spark.sql.constraintPropagation.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors share; one of this machine only where none is set and the
    master is local, as in tests."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="vintara-"))
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame, constraints: bool = True) -> DataFrame:
    """Cut the lineage by a reliable checkpoint in the shared folder of spark.checkpoint.dir.

    constraints: whether the optimizer may propagate constraints through this plan.
    """
    spark = df.sparkSession
    shared_folder(spark)
    before = spark.conf.get(CONSTRAINTS)
    try:
        spark.conf.set(CONSTRAINTS, str(constraints and before == "true").lower())
        return df.checkpoint(eager=True)
    finally:
        spark.conf.set(CONSTRAINTS, before)


def partitions(df: DataFrame) -> int:
    """Tasks for a stage whose rows multiply, where sizes known beforehand would lead to too few."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores if the table comes in fewer partitions than there are cores (a file of one row group, say), for
    work that costs far more than moving the rows. Tables of more partitions, and plans with a shuffle, stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString() or df._jdf.queryExecution().toRdd().getNumPartitions() >= cores:
        return df
    return df.repartition(2 * cores)


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, wherever they run; once for each application."""
    sc = spark.sparkContext
    if not getattr(sc, "_vintara_shipped", False):
        root = Path(__file__).resolve().parent.parent
        path = Path(tempfile.mkdtemp(prefix="vintara-")) / "vintara.zip"
        with zipfile.ZipFile(path, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        sc.addPyFile(str(path))
        sc._vintara_shipped = True

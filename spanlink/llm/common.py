"""Helpers that several operators share: cutting lineage, skewed joins, Arrow columns."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Checkpoints made inside released(), to be deleted when it ends.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder all executors share.

    A folder that the session has set is used as it is, else that of ``spark.checkpoint.dir``; only a session without
    either (tests on one machine) gets a temporary folder.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="spanlink-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """The rows of df from a reliable checkpoint: later work starts there even if executors are lost."""
    shared_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    made = _made.get()
    if made is not None:
        file = out._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
        made += [file.get()] if file.isDefined() else []
    return out


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Deletes the checkpoints that cut() makes inside, at the end: what depends on them must be written by then."""
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for path in made:
            delete(spark, path)


@contextmanager
def sparing(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the actions inside go when their action ends, not when the driver happens to collect its garbage.

    What is made inside must be made for one action, as cut() does; a second one would shuffle again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def free_name(df: DataFrame, name: str) -> str:
    """name, with underscores added until no column of df has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def identified(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a column more that tells its rows apart in every read, and that column's name.

    Rows read from Parquet are told apart by file and place in the file, which don't depend on how files are split or which
    executors there are. Other rows are numbered and written first.
    """
    name = free_name(docs, "__rid")
    plan = docs._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().apply(0)
    if plan.nodeName() == "LogicalRelation":
        try:
            about = docs.metadataColumn("_metadata")
            file = about["file_path"]
            return docs.withColumn(name, F.struct(F.xxhash64(file).alias("file"), F.hash(file).alias("check"), about["row_index"].alias("row"))), name
        except AnalysisException:  # files without numbered rows, or a projection that hides them
            pass
    return cut(docs.withColumn(name, F.monotonically_increasing_id())), name


def row_id(rid: str | None) -> Column:
    """The column that tells rows apart, or a number for each row, which is good for a single read."""
    return F.monotonically_increasing_id() if rid is None else F.col(rid)


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def skewed_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", salts: int = 4, spread: Column | None = None) -> DataFrame:
    """left joined to right, where right has one row a key and a key may hold a large part of left.

    The hot side is dealt over ``salts`` parts of each key and the unique side is repeated for each, so
    both sides are shuffled for this join alone, and adaptive execution can split what is still large.
    ``spread`` is what the parts are dealt by (default: all columns of left that aren't keys).
    """
    rest = [c for c in left.columns if c not in keys]
    by = spread if spread is not None else F.xxhash64(*[left[c] for c in rest]) if rest else F.lit(0)
    a = left.withColumn("__salt", F.pmod(by, F.lit(salts)).cast("int"))
    b = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return a.join(b.hint("merge"), [*keys, "__salt"], how).drop("__salt")


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def slices(batches, rows: int = 256):
    """The batches in pieces of few rows, so that very long texts are held a few at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)

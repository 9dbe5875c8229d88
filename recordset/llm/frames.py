"""DataFrame helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Seeds of the two hashes that choose sampled rows and folds.
SAMPLE_SEED = 7919


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def apart(df: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with all columns but the used ones under names of no operator, and what turns a result back into its columns."""
    own = {c: c if c in used else f"_own{i}" for i, c in enumerate(df.columns)}
    return df.select(*(F.col(f"`{c}`").alias(n) for c, n in own.items())), lambda out: out.select(*(F.col(n).alias(c) for c, n in own.items()))


def dealt_alike(df: DataFrame) -> DataFrame:
    """``df`` such that every evaluation deals the same rows to the same partitions in the same order.

    A projection and selection of files does so by itself. What stands behind a shuffle, a join or a nondeterministic
    expression need not, so it is written to the checkpoint folder once.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    plain = plan.deterministic()
    while plain and plan.nodeName() in ("Project", "Filter"):
        plan = plan.child()
    name = plan.nodeName()
    files = name in ("LogicalRelation", "LocalRelation") or name == "LogicalRDD" and plan.rdd().isCheckpointed()
    return df if plain and files else df.checkpoint()


def crc_fold(key: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the text ''."""
    return (F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % n).cast("int")


def map_text(df: DataFrame, text: str, make: Callable[[], Callable[..., list]], fields: list[T.StructField], also: tuple[str, ...] = (),
             rows: int | None = None) -> DataFrame:
    """Append columns computed from whole texts, in Arrow batches.

    ``make()`` runs once per task and returns a function from a text column
    (nulls included), and those named in ``also``, to the new columns, one value per row. A column of ``df`` with the name of a new
    column is replaced. No row is added, dropped or moved, and nothing is shuffled. With ``rows`` the function gets, and the task hands on,
    so many rows at a time, for new columns as large as the texts.
    """
    new = {f.name.lower() for f in fields}
    kept = [c for c in df.columns if c.lower() not in new]
    at, more = [i for i, c in enumerate(df.columns) if c.lower() not in new], [df.columns.index(c) for c in also]
    # Names of all kinds, dots and repeated ones included, are set aside for the task and come back by place.
    plain = [f"c{i}" for i in range(len(kept) + len(fields))]
    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(plain, [*(df.schema.fields[j] for j in at), *fields])])
    i, types = df.columns.index(text), [arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = None
        for b in (b.slice(k, rows) for b in batches for k in range(0, b.num_rows, rows or max(b.num_rows, 1))):
            fn = fn or make()
            cols = [pa.array(v, t) if not isinstance(v, pa.Array) else v for v, t in zip(fn(b.column(i), *(b.column(j) for j in more)), types, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(j) for j in at] + cols, names=plain)

    return df.toDF(*(f"c{j}" for j in range(len(df.columns)))).mapInArrow(run, schema).toDF(*kept, *(f.name for f in fields))


def arrow_type(t: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(t)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int, keep: Column | None = None,
                    id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts of a bounded, class-balanced sample of labelled rows: (text, y, weight, fold).

    Each class is sampled by a hash of the id with rate min(1, bound / 2 / size of the class),
    so about ``bound`` rows at most are kept at any input size; ``weight`` is the inverse rate.
    Ids labelled both 0 and 1, null ids and other label values teach nothing. ``keep`` restricts the ids
    labels are learned from. The sampled ids are few by construction, so they are broadcast to the scan of
    ``docs`` and no text is shuffled for the join.
    """
    y = F.col(label).cast("int")
    lab = labels.select(F.col(id_col), y.alias("y")).filter(F.col(id_col).isNotNull() & F.col("y").isin(0, 1))
    if keep is not None:
        lab = lab.filter(keep)
    lab = lab.groupBy(id_col).agg(F.min("y").alias("y"), F.max("y").alias("_most")).filter(F.col("y") == F.col("_most")).drop("_most")
    size = {r["y"]: r["n"] for r in lab.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    rate = {v: min(1.0, bound / 2 / max(size.get(v, 0), 1)) for v in (0, 1)}
    spread = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(SAMPLE_SEED)), F.lit(1 << 30)) / float(1 << 30)
    ids = lab.filter(spread < F.when(F.col("y") == 1, rate[1]).otherwise(rate[0])).select(
        F.col(id_col).alias("_sample_id"), "y", F.when(F.col("y") == 1, 1 / rate[1]).otherwise(1 / rate[0]).alias("weight"),
        F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(SAMPLE_SEED + 1)), F.lit(2)).cast("int").alias("fold"))
    return docs.select(F.col(id_col).alias("_id"), F.col(text).alias("text")).join(
        F.broadcast(ids), F.col("_id") == F.col("_sample_id")).select("text", "y", "weight", "fold")


def fit_in_task(features: DataFrame, fit: Callable[[Iterator[pa.RecordBatch]], bytes]) -> bytes:
    """Fit a model in one executor task over bounded rows and return its pickled form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([fit(batches)], pa.binary())], names=["model"])

    got = features.repartition(1).mapInArrow(run, "model binary").collect()
    return bytes(got[0]["model"]) if got else fit(iter(()))  # Spark runs no task over a table it finds empty

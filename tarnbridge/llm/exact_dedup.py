"""Exact duplicates by a content sort.

Rows are range-partitioned by sampled splitters of their normalised text and
sorted in each partition, so equal texts stand next to each other. One pass
compares every text in full with its neighbour. The order is (first characters,
64-bit hash, text, identifier): the splitters that the driver samples stay
short, and a text with very many copies is dealt over several partitions by its
identifiers. Of the first and the last run of each partition the pass returns the
text, too, so that runs which go on over an edge are joined by their full texts;
only numbers and an identifier of those, two rows for each partition, are broadcast.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import SPACE, Workspace, by_range, every_column, other_columns, plain

#: Characters of the text that lead the sort order.
PREFIX = 48


def normalised(text):
    """The text with each run of ASCII white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


class _Runs:
    """The runs of equal neighbours in sorted batches."""

    def __init__(self):
        self.part, self.text, self.run = TaskContext.get().partitionId(), None, -1

    def starts(self, norm: pa.Array) -> np.ndarray:
        """The places where a run begins, after comparing every text with the one before it."""
        new = np.ones(len(norm), bool)
        new[1:] = pc.not_equal(norm[1:], norm[:-1]).to_numpy(zero_copy_only=False)
        new[0] = self.text is None or norm[0].as_py() != self.text
        return np.flatnonzero(new)




def _record(schema: pa.Schema, n: int, **columns) -> pa.RecordBatch:
    """A batch of n rows; a column that is not given is null, and a single value is repeated."""

    def column(f: pa.Field) -> pa.Array:
        v = columns.get(f.name)
        return v if isinstance(v, pa.Array) else pa.array(v, f.type) if isinstance(v, (list, np.ndarray)) else pa.nulls(n, f.type) if v is None else pa.repeat(pa.scalar(v, f.type), n)

    return pa.RecordBatch.from_arrays([column(f) for f in schema], schema=schema)


def _members(schema: pa.Schema):
    """From sorted (doc_id, norm): a row for each row with its run's head, size and digest, and a row for each run at an edge."""

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    def compare(batches):
        runs, held = _Runs(), []

        def close(last: bool):
            if not held:
                return
            size, digest, head = sum(map(len, held)), sha(runs.text), held[0][:1]
            for k, ids in enumerate(held):
                n = len(ids)
                yield _record(schema, n, doc_id=ids, head=head.take(pa.repeat(0, n)), size=size, text_sha256=digest, lead=[k == 0] + [False] * (n - 1), part=runs.part, run=runs.run)
            if last or runs.run == 0:
                yield _record(schema, 1, head=head, size=size, part=runs.part, run=runs.run, edge=[runs.text])
            held.clear()

        for b in batches:
            if not b.num_rows:
                continue
            ids, norm = b.column(0), b.column(1)
            at = runs.starts(norm)
            if not len(at) or at[0]:
                held.append(ids[: int(at[0])] if len(at) else ids)
            if not len(at):
                continue
            yield from close(False)
            if runs.run < 0 and len(at) > 1:  # the first run of all ends in this batch: it is closed by itself
                runs.run, runs.text = 0, norm[0].as_py()
                held.append(ids[: int(at[1])])
                yield from close(False)
                at = at[1:]
            whole = at[:-1]
            if len(whole):
                sizes = np.diff(at)
                first = pa.array(np.repeat(whole, sizes))
                lead = np.zeros(int(at[-1] - at[0]), bool)
                lead[whole - at[0]] = True
                shas = pa.array([sha(t) for t in norm.take(pa.array(whole)).to_pylist()])
                number = np.repeat(np.arange(len(whole)), sizes)
                yield _record(schema, len(lead), doc_id=ids[int(at[0]) : int(at[-1])], head=ids.take(first), size=np.repeat(sizes, sizes), text_sha256=shas.take(pa.array(number)), lead=lead, part=runs.part, run=runs.run + 1 + number)
                runs.run += len(whole)
            runs.run += 1
            runs.text = norm[int(at[-1])].as_py()
            held.append(ids[int(at[-1]) :])
        yield from close(True)

    return compare


def _leaders(plain_schema: pa.Schema):
    """From sorted (row, norm): the first row of each run, and a row for each run at an edge."""

    def compare(batches):
        runs, schema = _Runs(), plain_schema
        for b in batches:
            if not b.num_rows:
                continue
            norm, schema = b.column(1), schema.set(0, pa.field("row", b.column(0).type))  # with the session's time zone
            at = runs.starts(norm)
            if len(at):
                if runs.run < 0:
                    yield _record(schema, 1, part=runs.part, run=0, edge=[norm[0].as_py()])
                yield _record(schema, len(at), row=b.column(0).take(pa.array(at)), part=runs.part, run=runs.run + 1 + np.arange(len(at)))
                runs.run += len(at)
                runs.text = norm[int(at[-1])].as_py()
        if runs.run > 0:
            yield _record(schema, 1, part=runs.part, run=runs.run, edge=[runs.text])

    return compare


def _dealt(rows: DataFrame, norm) -> DataFrame:
    """``rows`` (with doc_id) by ranges of the content."""
    rows = rows.withColumns({"lead": F.substring(norm, 1, PREFIX), "hash": F.xxhash64(norm)})
    return by_range(rows, "lead", "hash", F.col("doc_id").asc_nulls_last())


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after ``normalised``. Of equal texts the
    row with the smallest identifier stays; of rows equal in both, one stays. A null
    text counts as empty, and empty texts are one group. A null identifier stays only
    in a group without others. Texts of any length are compared whole. An empty table
    gives no rows. Other columns are ignored. One shuffle of the texts; a task holds the
    identifiers of one run in one partition.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    out = StructType.fromDDL(f"doc_id {kind}, head {kind}, size long, text_sha256 string, lead boolean, part int, run long, edge string")
    rows = plain(docs, doc_id, text).select("doc_id", normalised(F.col("text")).alias("norm"))
    rows = _dealt(rows, F.col("norm")).sortWithinPartitions("lead", "hash", "norm", F.col("doc_id").asc_nulls_last()).select("doc_id", "norm")
    # The caller reads this table later, so it stays.
    runs = Workspace(docs.sparkSession).stored(rows.mapInArrow(_members(to_arrow_schema(out)), out), "exact-runs", keep=True)
    same = Window.partitionBy("edge")
    edges = runs.filter("edge is not null").select("part", "run", F.min_by("head", "part").over(same).alias("first"), F.sum("size").over(same).alias("total"), F.min("part").over(same).alias("at"), F.count("*").over(same).alias("n"))
    found = runs.filter("edge is null").join(F.broadcast(edges.filter("n > 1").drop("n")), ["part", "run"], "left")
    crossing = F.col("total").isNotNull()
    return found.select(
        "doc_id",
        F.when(crossing, F.col("first")).otherwise(F.col("head")).alias("keep_id"),
        F.coalesce("total", "size").alias("group_size"),
        (F.col("lead") & (~crossing | (F.col("part") == F.col("at")))).alias("kept"),
        "text_sha256",
    )


def drop_exact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with all columns, whatever their names.

    Of rows equal in identifier and normalised text the first stays, in the order of the text
    and then of the other columns as JSON. An empty table gives no rows. The rows travel
    through the content sort, so each is shuffled once.
    """
    row = StructType(docs.schema.fields)
    out = StructType().add("row", row).add("part", "integer").add("run", "long").add("edge", "string")
    rows = docs.select(F.struct(*every_column(docs)).alias("row"), docs[doc_id].alias("doc_id"), other_columns(docs, doc_id, text).alias("others"))
    rows = _dealt(rows, normalised(F.col("row")[text])).withColumn("norm", normalised(F.col("row")[text]))
    rows = rows.sortWithinPartitions("lead", "hash", "norm", F.col("doc_id").asc_nulls_last(), F.col("row")[text], "others").select("row", "norm")
    # The caller reads this table later, so it stays.
    runs = Workspace(docs.sparkSession).stored(rows.mapInArrow(_leaders(to_arrow_schema(out)), out), "exact-rows", keep=True)
    again = runs.filter("edge is not null").select("part", "run", F.min("part").over(Window.partitionBy("edge")).alias("at")).filter("part > at")
    return runs.filter("row is not null").join(F.broadcast(again.select("part", "run")), ["part", "run"], "left_anti").select("row.*")

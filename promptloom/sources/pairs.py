"""Training pairs (input, output) from files and DataFrames."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from promptloom.functions.templates import render, require_columns
from promptloom.storage import materialise

# Size of a training subset.
TRAIN_LIMIT = 500
TRAIN_MINIMUM = 2
PIECE_BYTES = 1 << 18  # of lines joined before they are placed in records


def load_pairs(spark: SparkSession, path: str, input_key: str = "input", output_key: str = "output") -> DataFrame:
    """Pairs from ``.jsonl``, ``.jsonlines`` or ``.csv``; other extensions are rejected."""
    extension = os.path.splitext(path.rstrip("/"))[1].lower()
    if extension in (".jsonl", ".jsonlines"):
        return load_pairs_jsonl(spark, path, input_key, output_key)
    if extension == ".csv":
        return load_pairs_csv(spark, path, input_key, output_key)
    raise ValueError(f"cannot load {path!r}: only .jsonl, .jsonlines and .csv are supported")


def load_pairs_jsonl(spark: SparkSession, path: str, input_key: str = "input", output_key: str = "output") -> DataFrame:
    """A record without an input fails the job; a missing output is empty. Only the two keys are parsed."""
    rows = spark.read.schema(f"`{input_key}` string, `{output_key}` string").json(path)
    missing = F.raise_error(F.lit(f"record without key {input_key}")).cast("string")
    return rows.select(
        F.coalesce(F.col(f"`{input_key}`"), missing).alias("input"),
        F.coalesce(F.col(f"`{output_key}`"), F.lit("")).alias("output"),
    )


def load_pairs_csv(spark: SparkSession, path: str, input_key: str = "input", output_key: str = "output") -> DataFrame:
    """Nulls are empty text; a file without the input column is rejected.

    Quoted values may hold line breaks; large files are read by many tasks all the same (``csv_records``).
    """
    head = spark.read.csv(path, header=True, multiLine=True, escape='"')
    require_columns(head, [input_key], "CSV file")
    schema = ", ".join(f"`{c}` string" for c in head.columns)
    # The separators of the reader stand for line breaks inside values here, where each record comes alone.
    parsed = F.from_csv("record", F.lit(schema), {"escape": '"', "multiLine": "true"})
    rows = csv_records(spark, path).select(parsed.alias("r")).select("r.*")
    output = F.col(f"`{output_key}`") if output_key in rows.columns else F.lit("")
    return rows.select(F.col(f"`{input_key}`").alias("input"), output.alias("output")).na.fill("")


def csv_records(spark: SparkSession, path: str, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """(file, record) of CSV files, without each file's header and without empty lines; a record may span lines.

    Lines are read in blocks by many tasks, which join them to pieces at once, so a line is never a row of its own afterwards. A line opens a record where
    the quotes before it, in its block and in the file's earlier blocks, are even in number. A piece notes how it would cut if its block began outside a
    value and if it began inside one; a running sum over a row per block tells which. Whole records never move; only
    those that go from piece to piece are brought together. Quotes must be doubled inside quoted values, and none may stand in unquoted ones. Lines
    end with a line feed, with or without a carriage return before it.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))
    # Stored, since the places of lines depend on the tasks that read them.
    pieces = materialise(lines.mapInArrow(partial(_line_pieces, piece_bytes=piece_bytes), _PIECES), "lines")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = pieces.groupBy("file", "block").agg(
        F.sum("odd").alias("odd"), F.min(F.when(F.col("filled"), F.col("piece"))).alias("first"),
        F.array(F.max(F.col("left_open")[0]), F.max(F.col("left_open")[1])).alias("left_open"))
    # A row per block from here on, so it is small enough to be sent to every task.
    entered = blocks.withColumn("entry", (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2).cast("int"))
    newest = F.when(F.col("left_open")[F.col("entry")].isNotNull(), F.struct("block", F.col("left_open")[F.col("entry")].alias("piece")))
    first = F.when(F.col("first").isNotNull(), F.struct("block", F.col("first").alias("piece")))
    known = entered.select("file", "block", "entry", F.last(newest, ignorenulls=True).over(earlier).alias("handed"),
                           F.min(first).over(Window.partitionBy("file")).alias("header"))
    here = F.when(F.col("opened")[F.col("entry")].isNotNull(), F.struct("block", F.col("opened")[F.col("entry")].alias("piece")))
    placed = pieces.join(F.broadcast(known), ["file", "block"]).select(
        "file", "block", "piece", "text", ((F.col("before") + F.col("entry")) % 2).cast("int").alias("inside"), F.coalesce(here, "handed").alias("owner"),
        F.coalesce(F.struct("block", "piece") == F.col("header"), F.lit(False)).alias("has_header"))
    flat = placed.select("file", "block", "piece", "text", "inside", "owner.block", "owner.piece", "has_header").toDF(*_PLACED)
    parts = materialise(flat.mapInArrow(_piece_records, _PARTS), "records")
    whole = parts.filter("key_block is null").select("file", "record")
    longer = parts.filter("key_block is not null").groupBy("file", "key_block", "key_piece").agg(
        F.array_sort(F.collect_list(F.struct("block", "piece", "record"))).alias("parts"), F.bool_or("header").alias("header")).filter("not header")
    joined = longer.select("file", F.array_join(F.transform("parts", lambda x: x["record"].cast("string")), "\n").alias("record"))
    records = whole.select("file", F.col("record").cast("string").alias("record")).unionByName(joined)
    return records.select("file", F.regexp_replace("record", "\\r$", "").alias("record")).filter("record != ''")


_PIECES = "file string, block long, piece int, before int, odd int, filled boolean, opened array<int>, left_open array<int>, text binary"
_PLACED = ["file", "block", "piece", "text", "inside", "owner_block", "owner_piece", "has_header"]
_PARTS = "file string, block long, piece int, key_block long, key_piece int, header boolean, record binary"


def _line_pieces(batches: Iterator[pa.RecordBatch], piece_bytes: int) -> Iterator[pa.RecordBatch]:
    """Joins the lines of each block, which come in order, to pieces of about ``piece_bytes`` (see ``_Block``)."""
    block = None
    for batch in batches:
        lines = batch.column("line").to_numpy(zero_copy_only=False)
        starts, files = batch.column("block").to_numpy(), batch.column("file").dictionary_encode()
        turns = np.flatnonzero((np.diff(starts) != 0) | (np.diff(files.indices.to_numpy()) != 0)) + 1
        for at, end in zip([0, *turns.tolist()], [*turns.tolist(), len(lines)]):
            if at == end:
                continue
            place = (files[at].as_py(), int(starts[at]))
            if block is None or block.place != place:
                if block is not None and block.held:
                    yield block.piece()
                block = _Block(place)
            text = b"\n".join(lines[at:end])
            block.held.append(text)
            block.size += len(text)
            if block.size >= piece_bytes:
                yield block.piece()
    if block is not None and block.held:
        yield block.piece()


class _Block:
    """What the pieces of a block so far tell, for a block that begins outside a quoted value and for one that begins inside."""

    def __init__(self, place: tuple[str, int]):
        self.place, self.held, self.size, self.count, self.before, self.opened = place, [], 0, 0, 0, [None, None]

    def piece(self) -> pa.RecordBatch:
        text = b"\n".join(self.held)
        runs = text.split(b'"')
        odd, opened = (len(runs) - 1) % 2, list(self.opened)
        for entry in (0, 1):
            inside = entry ^ self.before
            # The last record of the piece is open and begins here.
            if inside ^ odd and (not inside or any(b"\n" in run for run in runs[inside::2])):
                self.opened[entry] = self.count
        row = [*self.place, self.count, self.before, odd, bool(text.strip(b"\r \n")), opened, list(self.opened), text]
        self.held, self.size, self.count, self.before = [], 0, self.count + 1, self.before ^ odd
        return _arrow_rows([row], _PIECES)


def _arrow_rows(rows: list, schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()), "binary": pa.binary()}
    fields = [field.split(" ") for field in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.record_batch([pa.array(list(c), kinds[kind]) for c, (_, kind) in zip(columns, fields)], names=[name for name, _ in fields])


def _piece_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of placed pieces; parts of those that go from piece to piece have the key of the piece that opens them."""
    for batch in batches:
        for at in range(batch.num_rows):
            p = {name: batch.column(name)[at].as_py() for name in _PLACED}
            records, rest = _cut(p["text"], p["inside"])
            rows = []
            for i, record in enumerate(records):
                key = (None, None)
                if i == 0 and p["inside"]:
                    key = (p["owner_block"], p["owner_piece"])
                elif rest and i == len(records) - 1:
                    key = (p["block"], p["piece"])
                header = p["has_header"] and bool(record.strip(b"\r \n"))
                if header:
                    p["has_header"] = False
                if key != (None, None) or not header:
                    rows.append([p["file"], p["block"], p["piece"], *key, header, record])
            yield _arrow_rows(rows, _PARTS)


def _cut(text: bytes, inside: int) -> tuple[list[bytes], int]:
    """The text cut at line breaks outside quoted values, and whether a value is open at its end."""
    runs = text.split(b'"')
    out, held = [], []
    for i, run in enumerate(runs):
        if (i + inside) % 2 or b"\n" not in run:
            held.append(run)
            continue
        head, *middle = run.split(b"\n")
        out.append(b'"'.join([*held, head]))
        out += middle[:-1]
        held = [middle[-1]]
    return [*out, b'"'.join(held)], (len(runs) - 1 + inside) % 2


def pairs_from(df: DataFrame, input_key: str = "input", output_key: str = "output", template: str | None = None,
               **values: Column) -> DataFrame:
    """Pairs from a DataFrame. With a template, its slot ``{user}`` takes the input and ``values`` the others."""
    require_columns(df, [input_key], "training data")
    source = F.col(input_key)
    rendered = source if template is None else render(template, {"user": source, "prompt": source, **values}, "")
    output = F.coalesce(F.col(output_key), F.lit("")) if output_key in df.columns else F.lit("")
    return df.withColumns({"input": rendered, "output": output})


def bounded(df: DataFrame, order_by: str, n: int) -> DataFrame:
    """The first ``n`` rows in a fixed order; planned as a distributed top-n."""
    return df.orderBy(order_by).limit(n)


def training_subset(df: DataFrame, order_by: str, limit: int = TRAIN_LIMIT) -> DataFrame:
    """The first ``limit`` pairs; fewer than two is an error. Looks at two rows now."""
    if df.limit(TRAIN_MINIMUM).count() < TRAIN_MINIMUM:
        raise ValueError(f"training needs at least {TRAIN_MINIMUM} examples")
    return bounded(df, order_by, limit)

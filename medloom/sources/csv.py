"""Quoted CSV, read by many tasks however large a file is.

A line end inside quotes ends a line but no record, so a task that starts in the middle of a file
must know whether it starts inside quotes. A first pass counts the quotes of each split; whether
the quotes before a split are even or odd follows from a prefix sum over the splits of its file (one
row per split). A second pass puts the lines of each split together to records; each record is then
parsed by Spark's own CSV expression. Parts of records that reach over the end of a split are read
by a third pass over the splits that have such parts, and only if there are any; they are all that
is ever shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from medloom.session import scratch_dir

_SPLIT = ["source_file", "split_start"]
# Up to this many splits their parities are broadcast (some tens of MB).
BROADCAST_SPLITS = 250_000

# A part of a record: all of it, its beginning, its end, or a whole split in its middle.
WHOLE, HEAD, MIDDLE, TAIL = "whole", "head", "middle", "tail"


def csv_records(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """``record, header``: the text of each record, and whether it is the first of its file.

    A record keeps the line ends inside quotes; the one that ends it is gone, and so is a carriage
    return before it. Blank lines between records are passed over. Lines end with a line feed. A
    quote that is never closed makes one record of the rest of its file. Runs a job.
    """
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    text = reader.text(list(paths) if not isinstance(paths, str) else paths)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = text.select(
        "value",
        (quotes % 2 == 1).alias("odd"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("split_start"),
    )
    known = _parities(lines)
    few = known.count() <= BROADCAST_SPLITS
    whole = _parts(lines, known, few).where(F.col("part") == WHOLE)
    records = whole.select("record", "header")
    reaching = known.where("inside OR inside_at_end")
    if reaching.isEmpty():
        return records
    return records.unionByName(_joined(_parts(lines, reaching, few).where(F.col("part") != WHOLE), known))


def _parities(lines: DataFrame) -> DataFrame:
    """``split, source_file, split_start, inside, inside_at_end``, a row per split that has lines."""
    splits = lines.groupBy(*_SPLIT).agg(F.count_if("odd").alias("odd"))
    upto = W.Window.partitionBy("source_file").orderBy("split_start")
    quoted = F.sum("odd").over(upto)
    placed = splits.select(
        F.xxhash64(*_SPLIT).alias("split"),
        *_SPLIT,
        ((quoted - F.col("odd")) % 2 == 1).alias("inside"),
        (quoted % 2 == 1).alias("inside_at_end"),
    )
    target = scratch_dir(lines.sparkSession, "csv-splits")
    placed.write.parquet(target)
    return lines.sparkSession.read.parquet(target)


def _parts(lines: DataFrame, known: DataFrame, few: bool) -> DataFrame:
    """``part, record, header, split``: the lines of the given splits put together."""
    numbered = lines.withColumn("at", F.monotonically_increasing_id())
    chosen = F.broadcast(known) if few else known
    # A split that the first pass did not see has no parity (the files were cut otherwise).
    joined = numbered.join(chosen.select(*_SPLIT, "split", "inside"), _SPLIT, "inner")
    if not few:
        joined = joined.sortWithinPartitions(*_SPLIT, "at")
    first = (F.col("split_start") == 0).alias("first")
    return joined.select("value", "odd", "split", "inside", first).mapInArrow(
        _put_together(), "part string, record string, header boolean, split long"
    )


def _put_together():
    """The function is made here so that it travels with the task: workers need not have this
    package installed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, inside, kind, held, header = None, False, None, [], False
        parts: list[str] = []
        records: list[str] = []
        headers: list[bool] = []
        splits: list[int] = []

        def put(part: str, record: str) -> None:
            nonlocal header
            if part == "whole" and not record.strip():
                return
            parts.append(part)
            # Where a record ends a carriage return is part of the line end.
            records.append(record.removesuffix("\r") if part in ("whole", "tail") else record)
            headers.append(header and part in ("whole", "head"))
            splits.append(split)
            if part in ("whole", "head"):
                header = False

        def close() -> None:
            # The open record goes on in the next split.
            if held:
                put("head" if kind == "whole" else "middle", "\n".join(held))

        def made() -> pa.RecordBatch:
            columns = [parts, records, headers, splits]
            types = [pa.string(), pa.string(), pa.bool_(), pa.int64()]
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["part", "record", "header", "split"]
            )
            for column in (parts, records, headers, splits):
                column.clear()
            return out

        for batch in batches:
            ids = batch["split"].to_numpy()
            odd = np.array(batch["odd"].to_pylist(), bool)
            edges = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)] if len(ids) else []
            for start, stop in zip(edges, edges[1:]):
                if ids[start] != split:
                    close()
                    split, held = int(ids[start]), []
                    inside, header = batch["inside"][start].as_py(), batch["first"][start].as_py()
                    kind = "tail" if inside else None
                values = batch["value"].slice(start, stop - start).to_pylist()
                own = odd[start:stop]
                if not inside and not own.any():
                    whole = [v.removesuffix("\r") for v in values if v and not v.isspace()]
                    parts += ["whole"] * len(whole)
                    records += whole
                    headers += [header and k == 0 for k in range(len(whole))]
                    splits += [split] * len(whole)
                    header = header and not whole
                    continue
                for value, flips in zip(values, own.tolist()):
                    if not held and not inside:
                        kind = "whole"
                    held.append(value)
                    inside = inside != flips
                    if not inside:
                        put(kind, "\n".join(held))
                        held = []
            yield made()
        close()
        yield made()

    return run


def _joined(parts: DataFrame, known: DataFrame) -> DataFrame:
    """Records from their parts: a head, then what follows up to the tail."""
    placed = parts.join(known.select("split", *_SPLIT), "split")
    # In one split the tail of an earlier record comes before the head of a later one.
    order = W.Window.partitionBy("source_file").orderBy("split_start", (F.col("part") == HEAD).cast("int"))
    number = F.count_if(F.col("part") == HEAD).over(order)
    of_record = placed.withColumn("number", number).groupBy("source_file", "number")
    lines = F.array_sort(F.collect_list(F.struct("split_start", (F.col("part") == HEAD).alias("head"), "record")))
    record = F.array_join(F.transform(lines, lambda p: p["record"]), "\n").alias("record")
    return of_record.agg(record, F.max("header").alias("header")).select("record", "header")

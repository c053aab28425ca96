"""Packing documents into token sequences with a bounded number of open windows."""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotkit.llm.common import written
from depotkit.llm.tokens import encoder

CAPACITY = 1024
OPEN_WINDOWS = 64
#: Partitions whose leftovers are merged in one task: FAN_IN * OPEN_WINDOWS windows at most.
FAN_IN = 64
END_ID = 0
PIECE = "doc_id long, start long, length long, doc_tokens long, ids binary"


def token_pieces(
    docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = "byte_bpe_50k", text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Each document's ids and an end id, cut into pieces of ``capacity`` and the rest: doc_id,
    start, length, doc_tokens, ids (little-endian unsigned 32-bit). A null text is only the end id."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                names, texts = (c.to_pylist() for c in batch.slice(at, 256).columns)
                rows = []
                for name, ids in zip(names, encoder(vocabulary).encode(texts), strict=True):
                    whole = np.append(ids, np.array([END_ID], "<u4"))
                    for start in range(0, len(whole), capacity):
                        part = whole[start:start + capacity]
                        rows.append((name, start, len(part), len(whole), part.tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (*[pa.int64()] * 4, pa.binary()), strict=True)], ["doc_id", "start", "length", "doc_tokens", "ids"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, PIECE)


class Windows:
    """At most ``limit`` open windows; a piece goes where it leaves the least room."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.room: list[tuple[int, int]] = []  # free tokens and window, ascending
        self.next = 0

    def place(self, length: int) -> tuple[int, int, list[int]]:
        """The window, the offset there, and the windows that this closed."""
        closed = []
        at = bisect_left(self.room, (length, -1))
        if at < len(self.room):
            free, window = self.room.pop(at)
        else:
            if len(self.room) == self.limit:
                closed.append(self.room.pop(0)[1])  # the fullest
            free, window = self.capacity, self.next
            self.next += 1
        if free > length:
            insort(self.room, (free - length, window))
        else:
            closed.append(window)
        return window, self.capacity - free, closed


def _places(lengths: list[int], windows: Windows, waiting: dict[int, list[int]], base: int) -> tuple[list, list, list]:
    """Places pieces base, base+1, ...; pieces of closed windows leave ``waiting``. Those without a
    length go out at once, to window -1."""
    window_of, offset_of, out = [], [], []
    for k, length in enumerate(lengths, base):
        if length <= 0:
            window_of.append(-1)
            offset_of.append(-1)
            out.append(k)
            continue
        window, offset, closed = windows.place(length)
        window_of.append(window)
        offset_of.append(offset)
        waiting.setdefault(window, []).append(k)
        for done in closed:
            out += waiting.pop(done)
    return window_of, offset_of, out


def _with_places(table: pa.Table, part: int, window, offset, still_open: bool) -> pa.Table:
    n = table.num_rows
    for name, values, kind in (("_part", [part] * n, pa.int64()), ("_window", window, pa.int64()), ("_offset", offset, pa.int64()), ("_open", [still_open] * n, pa.bool_())):
        table = table.append_column(name, pa.array(values, kind))
    return table


def _online(capacity: int, limit: int):
    """Packs one partition as its rows come; holds only rows of open windows."""

    def run(batches):
        from pyspark import TaskContext

        part, windows, waiting = TaskContext.get().partitionId(), Windows(capacity, limit), {}
        held, held_window, held_offset, schema = None, [], [], None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            schema = rows.schema
            base = held.num_rows if held is not None else 0
            window, offset, out = _places(rows.column("_length").to_pylist(), windows, waiting, base)
            rows = pa.concat_tables([held, rows]) if base else rows
            window, offset = np.array(held_window + window, np.int64), np.array(held_offset + offset, np.int64)
            yield from _with_places(rows.take(pa.array(out, pa.int64())), part, window[out], offset[out], False).to_batches() if out else ()
            stay = sorted(k for ks in waiting.values() for k in ks)
            new = {k: i for i, k in enumerate(stay)}
            waiting = {w: [new[k] for k in ks] for w, ks in waiting.items()}
            held = rows.take(pa.array(stay, pa.int64())).combine_chunks()
            held_window, held_offset = window[stay].tolist(), offset[stay].tolist()
        if held is not None and held.num_rows:
            yield from _with_places(held, part, held_window, held_offset, True).to_batches()

    return run


def _merge(capacity: int, limit: int, last: bool):
    """Packs the leftovers of some partitions anew, longest first."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("_length", "descending"), ("_part", "ascending"), ("_window", "ascending"), ("_offset", "ascending")])
        part = table.column("_group")[0].as_py()
        windows, waiting = Windows(capacity, max(limit, table.num_rows) if last else limit), {}
        window, offset, out = _places(table.column("_length").to_pylist(), windows, waiting, 0)
        rows = table.drop_columns(["_part", "_window", "_offset", "_open", "_group"])
        stay = [k for ks in waiting.values() for k in ks]
        if last:
            out, stay = out + stay, []
        take = lambda which, still: _with_places(rows.take(pa.array(which, pa.int64())), part, [window[k] for k in which], [offset[k] for k in which], still)
        return pa.concat_tables([take(out, False), take(stay, True)]).combine_chunks()

    return run


def pack(
    pieces: DataFrame, length: str = "length", capacity: int = CAPACITY, open_windows: int = OPEN_WINDOWS, fan_in: int = FAN_IN
) -> DataFrame:
    """Each piece's place: ``row`` (all input columns as a struct), sequence_id, offset.

    Each partition keeps ``open_windows`` windows open. A piece goes to the open window it fills
    best; if none has room and the number is reached, the fullest is emitted and a new one opened.
    The windows left at the end of each partition are merged: their pieces are packed anew,
    ``fan_in`` partitions in a task and round after round, and the last round emits all.
    A task holds no more than fan_in * open_windows windows of rows.

    A null or non-positive length takes no room and goes as it is to sequence_id null. A length
    over ``capacity`` is an error: cut pieces first. Empty in, empty out.
    """
    size = F.coalesce(F.col(length).cast("long"), F.lit(0))
    rows = pieces.select(F.struct(*[F.col(f"`{c}`") for c in pieces.columns]).alias("row"), size.alias("_length"))
    rows = rows.withColumn("_length", F.when(F.col("_length") > capacity, F.raise_error(F.lit("a piece is longer than a sequence"))).otherwise(F.col("_length")))
    schema = T.StructType(rows.schema.fields + T.StructType.fromDDL("_part long, _window long, _offset long, _open boolean").fields)
    placed = written(rows.mapInArrow(_online(capacity, open_windows), schema), "packed")
    whole, rest = [(0, placed.filter("not _open"))], placed.filter("_open")
    parts = (rest.agg(F.max("_part")).first()[0] or 0) + 1
    turn = 0
    while True:
        turn += 1
        last = parts <= fan_in
        grouped = rest.withColumn("_group", F.expr(f"_part div {fan_in}"))
        merged = written(grouped.groupBy("_group").applyInArrow(_merge(capacity, open_windows, last), schema), f"merged-{turn}")
        whole.append((turn, merged.filter("not _open")))
        if last:
            break
        rest, parts = merged.filter("_open"), -(-parts // fan_in)
    out = None
    for level, df in whole:
        ids = F.lit(level << 58) + F.shiftleft("_part", 34) + F.col("_window")
        placed_only = lambda c: F.when(F.col("_window") >= 0, c)
        df = df.select("row", placed_only(ids).alias("sequence_id"), placed_only(F.col("_offset")).alias("offset"))
        out = df if out is None else out.unionByName(df)
    return out


def pack_documents(docs: DataFrame) -> DataFrame:
    """Places of all pieces of the documents, with a checksum of each piece's ids.

    Repeated rows are packed each for itself; null texts are one end id; rows without a doc_id
    are packed too.
    """
    pieces = token_pieces(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    # written first, so that no task needs a worker that encodes and one that packs at once
    return pack(written(pieces, "pieces")).select("row.*", "sequence_id", "offset")


def op9_query(spark, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))

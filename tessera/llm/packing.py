"""Sequence packing by minimum bin slack.

Documents are cut into full windows of ``capacity`` ids and one remaining
piece.  The multiset of remaining lengths has at most ``capacity - 1``
distinct values whatever the corpus holds, so the packing is planned on the
*counts by length*: for the largest length left, a subset-sum over bitsets
(one Python integer per stage) finds the multiset of lengths that fills the
window closest to its capacity, the counts are backtracked, and the window is
repeated as often as the counts allow.  The plan is a table of (length, ranks,
window, offset); each piece finds its window by its rank among the pieces of
its length, which comes from one distributed sort of narrow rows.  No group of
equal lengths is ever held in one task.

Defined results: null text is an empty text (its document is the end id
alone); repeated rows are packed each; null ids are kept; an empty table
gives no piece; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import tokens as tk
from tessera.llm._common import arrow_schema, batch_of, global_index, stored

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


def fill_window(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset {length: copies} that holds the largest length and comes
    closest to ``capacity`` (minimum bin slack): bounded subset-sum, bit s of
    the reached set saying that s is a sum."""
    seed = max(counts)
    room = capacity - seed
    reached, stages = 1, []
    within = (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        copies = min(counts[length] - (length == seed), room // length)
        if copies <= 0:
            continue
        before = reached
        for _ in range(copies):
            more = (reached | reached << length) & within
            if more == reached:
                break
            reached = more
        stages.append((length, copies, before))
        if reached >> room & 1:
            break
    total = reached.bit_length() - 1
    window = {seed: 1}
    for length, copies, before in reversed(stages):
        used = next(u for u in range(copies + 1) if total >= u * length and before >> (total - u * length) & 1)
        if used:
            window[length] = window.get(length, 0) + used
            total -= used * length
    return window


def plan_windows(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, ...]], int]:
    """Rows (length, first rank, pieces, pieces a window, first window,
    offset in the window), and the number of windows."""
    left, rank = dict(counts), dict.fromkeys(counts, 0)
    rows, windows = [], 0
    while left:
        window = fill_window(left, capacity)
        times = min(left[x] // m for x, m in window.items())
        offset = 0
        for length in sorted(window, reverse=True):
            m = window[length]
            rows.append((length, rank[length], times * m, m, windows, offset))
            offset += m * length
            rank[length] += times * m
            left[length] -= times * m
            if not left[length]:
                del left[length]
        windows += times
    return rows, windows


def token_pieces(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 1, capacity: int = 2048, max_pieces: int = 500_000) -> DataFrame:
    """Every document's ids cut into full windows and a remaining piece
    (``ids``: little-endian, two or four bytes each by vocabulary size)."""
    def cut(batches):
        enc = tk.encoder(tokenizer, max_pieces)
        end, width = np.array([end_id], dtype=enc.dtype).tobytes(), np.dtype(enc.dtype).itemsize
        step = capacity * width

        def rows(batch):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = enc.encode(text.as_py()) + end
                for at in range(0, len(ids), step):
                    piece = ids[at:at + step]
                    crc = zlib.crc32(np.frombuffer(piece, dtype=enc.dtype).astype("<u4").data)
                    yield doc_id, at // width, len(piece) // width, crc, len(ids) // width, piece

        for batch in batches:
            yield batch_of(list(rows(batch)), PIECES)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(cut, PIECES)


def pack(docs: DataFrame, tokenizer: str, **kw) -> DataFrame:
    """The places of all pieces: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset."""
    return pack_tables(docs, tokenizer, **kw)[1]


def pack_tables(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
                end_id: int = 1, capacity: int = 2048, max_pieces: int = 500_000) -> tuple[DataFrame, DataFrame]:
    """(pieces with their ids, a written table; places as of ``pack``).
    ``packed_sequences`` joins the two into sequences."""
    pieces = stored(token_pieces(docs, tokenizer, id_col=id_col, text_col=text_col,
                                 end_id=end_id, capacity=capacity, max_pieces=max_pieces), "pieces")
    narrow = pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    # at most `capacity` rows
    counts = {r["length"]: r["n"] for r in narrow.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows, windows = plan_windows({k: v for k, v in counts.items() if k < capacity}, capacity)
    rows.append((capacity, 0, counts.get(capacity, 0), 1, windows, 0))
    rows.sort()
    plan = np.array(rows, dtype=np.int64)
    first, seen = {}, 0  # position of each length's first piece in the sorted order
    for length in sorted(counts):
        first[length], seen = seen, seen + counts[length]
    lengths = np.array(sorted(counts), dtype=np.int64)
    firsts = np.array([first[x] for x in lengths], dtype=np.int64)
    # a piece's rank among those of its length, as a position in one order
    starts = plan[:, 1] + np.array([first.get(x, 0) for x in plan[:, 0]], dtype=np.int64)

    def place(batches):
        schema = arrow_schema(out)
        for b in batches:
            idx, length = (b.column(c).to_numpy() for c in ("_idx", "length"))
            # rows of the plan that hold no piece (capacity 0) sort last and are never met
            p = plan[np.searchsorted(starts, idx, side="right") - 1]
            j = idx - firsts[np.searchsorted(lengths, length)] - p[:, 1]
            seq, off = p[:, 4] + j // p[:, 3], p[:, 5] + j % p[:, 3] * length
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(seq), pa.array(off)], schema=schema)

    names = narrow.columns
    out = ", ".join(f"{c} long" for c in [*names, "sequence_id", "offset"])
    ordered = global_index(narrow, ["length", "doc_id", "start", "ids_crc32"], "ranked")
    return pieces, ordered.mapInArrow(place, out)


def packed_sequences(pieces: DataFrame, placed: DataFrame, *, width: int = 2, capacity: int = 2048, pad_id: int = 0) -> DataFrame:
    """One row per sequence: sequence_id, n_tokens, ids (binary, ``width``
    bytes an id), mask (1 for an id, 0 for padding), doc_ids, starts, lengths.

    Sequences are padded to ``capacity``; one whose length is a power of two
    isn't.  A sequence is bounded by the capacity, so its group is too.
    """
    ids = pieces.select("doc_id", "start", "ids_crc32", "ids").dropDuplicates(["doc_id", "start", "ids_crc32"])
    same = placed["doc_id"].eqNullSafe(ids["doc_id"]) & (placed["start"] == ids["start"]) & (placed["ids_crc32"] == ids["ids_crc32"])
    rows = placed.join(ids, same).select(placed["sequence_id"], F.struct(
        placed["offset"], placed["doc_id"], placed["start"], placed["length"], ids["ids"]).alias("p"))
    n = F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x["length"])
    size = F.col("n_tokens")
    padding = F.when(size.bitwiseAND(size - 1) == 0, F.lit(0)).otherwise(capacity - size).cast("int")
    pad = F.unhex(F.lit(int(pad_id).to_bytes(width, "little").hex()))
    ids_of = F.aggregate("p", F.unhex(F.lit("")), lambda a, x: F.concat(a, x["ids"]))
    return (rows.groupBy("sequence_id").agg(F.array_sort(F.collect_list("p")).alias("p"))
            .withColumn("n_tokens", n).withColumn("_pad", padding)
            .select("sequence_id", "n_tokens",
                    F.concat(ids_of, F.unhex(F.repeat(F.hex(pad), F.col("_pad")))).alias("ids"),
                    F.concat(F.array_repeat(F.lit(1).cast("byte"), size.cast("int")), F.array_repeat(F.lit(0).cast("byte"), F.col("_pad"))).alias("mask"),
                    F.col("p.doc_id").alias("doc_ids"), F.col("p.start").alias("starts"), F.col("p.length").alias("lengths")))

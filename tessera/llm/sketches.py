"""Document fingerprints: bottom-k sketches of shingle hashes.

A text's shingles are its windows of ``width`` code points, the first ones
reaching in from before its beginning, so that short texts have some too.
Every distinct shingle has one 48-bit hash; the fingerprint holds the ``k``
smallest, or all where there are fewer (then it is the exact set).  The k
smallest of a union are among the k smallest of its parts, so sketches merge:
parts of a long text (cut with an overlap), or the documents of a group
(:func:`merged_sketches`), give the sketch of the whole.  Two sketches
estimate resemblance, containment and the number of distinct shingles
(:func:`resemblance`, :func:`containment`, :func:`distinct_shingles`).  The
standard error of a resemblance r is sqrt(r (1 - r) / k), 0.04 at most for 128.

Scale: one row is hashed on its own, a long text a million code points at a
time.  A merge keeps k hashes per group and task before its shuffle, so a hot
group is never in one task.  :func:`with_next` deals the rows into ranges of
ids whose bounds are literal, so a lost task is recomputed alike; texts are
shuffled once, and each range gets a copy of the next one's first row.

Defined results: null text is an empty text, whose fingerprint is empty and
like (1.0) empty ones only; equal texts have equal fingerprints; rows without
an id come last, those of one id in order of their texts; repeated rows are
rows of their own; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._common import arrow_schema, batch_of

K, WIDTH, BITS = 128, 12, 48
PART = 1 << 20  # code points that are hashed at once
BEFORE = 0x110000  # what stands before a text's beginning: no code point
BASE = 0x9E3779B97F4A7C15  # of the polynomial over a window


def _window_hashes(points: np.ndarray, width: int) -> np.ndarray:
    """The polynomial of each run of ``width`` values, by doubling runs."""
    out, size, run, step = None, 0, points, 1
    while True:
        power = np.uint64(pow(BASE, step, 1 << 64))
        if width & step:
            out = run if out is None else out[:run.size - size] * power + run[size:]
            size += step
        if step * 2 > width:
            return out[:points.size - width + 1]
        run = run[:-step] * power + run[step:]
        step *= 2


def _mixed(h: np.ndarray) -> np.ndarray:
    """Spread evenly over BITS bits (the finalizer of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (h ^ (h >> np.uint64(31))) >> np.uint64(64 - BITS)


def _smallest(h: np.ndarray, k: int) -> np.ndarray:
    """The k smallest distinct values in order."""
    if h.size > 16 * k:  # most are beyond reach; where too few are left for repetitions, all are sorted
        low = np.unique(h[h < np.uint64((1 << BITS) * 8 * k // h.size)])
        if low.size >= k:
            return low[:k]
    return np.unique(h)[:k]


def sketch(text: str | None, k: int = K, width: int = WIDTH) -> np.ndarray:
    """The fingerprint of a text as sorted hashes."""
    if not text:
        return np.empty(0, np.uint64)
    best, lead = None, np.full(width - 1, BEFORE, np.uint64)
    for at in range(0, len(text), PART):
        points = np.frombuffer(text[at:at + PART].encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        points = np.concatenate((lead, points))
        part = _smallest(_mixed(_window_hashes(points, width)), k)
        best = part if best is None else merge(best, part, k)
        lead = points[points.size - width + 1:]
    return best


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of the union of what two sketches are of."""
    return np.unique(np.concatenate((a, b)))[:k]


def to_string(s: np.ndarray) -> str:
    return base64.b64encode(s.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def from_string(text: str | None) -> np.ndarray:
    six = np.frombuffer(base64.b64decode(text or ""), np.uint8).reshape(-1, 6)
    return np.concatenate((np.zeros((len(six), 2), np.uint8), six), axis=1).view(">u8").ravel().astype(np.uint64)


def _shared(a: np.ndarray, b: np.ndarray, k: int) -> tuple[int, int]:
    """(sampled shingles of the union, those of them in both)."""
    both = np.sort(np.concatenate((a, b)))
    again = both[1:] == both[:-1]
    if both.size - int(again.sum()) > k:  # the k smallest of the union are a sample of it
        rank = np.arange(1, both.size) - np.cumsum(again)
        return k, int(again[rank < k].sum())
    return both.size - int(again.sum()), int(again.sum())


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the shingles of either that are in both; exact
    where both sketches hold all; 1 for two empty ones."""
    union, shared = _shared(a, b, k)
    return shared / union if union else 1.0


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the shingles of ``a`` that are in ``b`` (1 if it has none)."""
    if not a.size:
        return 1.0
    union, shared = _shared(a, b, k)
    sample = np.unique(np.concatenate((a, b)))[:union]
    own = int(np.isin(sample, a, assume_unique=True).sum())
    return shared / own if own else 0.0


def distinct_shingles(a: np.ndarray, k: int = K) -> int:
    """Estimated number of distinct shingles; exact below k."""
    return int(a.size) if a.size < k else round((k - 1) / (float(a[k - 1]) / (1 << BITS)))


# ----------------------------------------------------------------- tables

def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = K, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_chars, fingerprint, n_shingles) of every whole text."""
    out = "doc_id long, n_chars long, fingerprint string, n_shingles long"

    def run(batches):
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                text = text.as_py() or ""
                s = sketch(text, k, width)
                rows.append((doc_id, len(text), to_string(s), distinct_shingles(s, k)))
            yield batch_of(rows, out)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, out)


def merged_sketches(prints: DataFrame, keys: list[str], *, fingerprint_col: str = "fingerprint", k: int = K) -> DataFrame:
    """One fingerprint per group: that of all its documents together
    (``keys``, fingerprint, n_shingles).  A null fingerprint is an empty one;
    a group whose key is null is a group."""
    given = prints.select(F.struct(*keys).alias("g"), F.col(fingerprint_col).alias("f"))

    def read(batches):
        for b in batches:
            sets = [from_string(f) for f in b.column(1).to_pylist()]
            rows = np.repeat(np.arange(len(sets)), [s.size for s in sets])
            hashes = np.concatenate([np.empty(0, np.uint64), *sets]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), pa.array(hashes)], names=["g", "h"])

    group = given.schema["g"].dataType.simpleString()
    hashes = given.mapInArrow(read, f"g {group}, h long").distinct()
    # WindowGroupLimit keeps k rows of a group in each task before the shuffle
    low = hashes.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("h"))).where(F.col("r") <= k)
    found = low.groupBy("g").agg(F.array_sort(F.collect_list("h")).alias("h"))  # k hashes
    kept = given.select("g").distinct().withColumnRenamed("g", "own").join(found, F.col("own").eqNullSafe(F.col("g")), "left")

    def write(batches):
        for b in batches:
            sets = [np.array(h or [], np.uint64) for h in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([to_string(s) for s in sets], pa.string()),
                                              pa.array([distinct_shingles(s, k) for s in sets], pa.int64())], names=["g", "fingerprint", "n_shingles"])

    done = kept.select("own", "h").mapInArrow(write, f"g {group}, fingerprint string, n_shingles long")
    return done.select("g.*", "fingerprint", "n_shingles")


def compared(pairs: DataFrame, a_col: str, b_col: str, *, k: int = K) -> DataFrame:
    """``pairs`` with the estimates of its two fingerprint columns: resemblance,
    a_in_b and b_in_a (containment), added at the end under these names."""
    @F.arrow_udf("struct<resemblance:double,a_in_b:double,b_in_a:double>")
    def estimates(a: pa.Array, b: pa.Array) -> pa.Array:
        rows = []
        for x, y in zip(a.to_pylist(), b.to_pylist()):
            s, t = from_string(x), from_string(y)
            rows.append({"resemblance": resemblance(s, t, k), "a_in_b": containment(s, t, k), "b_in_a": containment(t, s, k)})
        return pa.array(rows, pa.struct([(n, pa.float64()) for n in ("resemblance", "a_in_b", "b_in_a")]))

    names = [c for c in pairs.columns if c not in ("resemblance", "a_in_b", "b_in_a")]
    return pairs.select(*names, estimates(a_col, b_col).alias("_e")).select(*names, "_e.*")


def with_next(docs: DataFrame, id_col: str, text_col: str, run, out: str) -> DataFrame:
    """``run((doc_id, text), (doc_id, text) of the next row)`` of every row,
    ids descending (null ids last, one id's rows by text); after the last row
    comes the first.  ``run`` gets an iterator of such pairs (the same objects
    where a row is next and then itself) and yields rows of ``out``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # bounds of ranges of ids of about equal numbers of rows, a literal list of at most n
    cuts = rows.select(F.percentile_approx("doc_id", [(i + 1) / n for i in range(n)], 10_000)).first()[0] if n > 1 else []
    bounds = np.array(sorted(set(cuts or [])), dtype=np.int64)

    def bucket_of(ids: pa.Array) -> np.ndarray:
        null = ids.is_null().to_numpy(zero_copy_only=False)
        return np.where(null, bounds.size + 1, bounds.size - np.searchsorted(bounds, ids.fill_null(0).to_numpy(zero_copy_only=False), side="left"))

    @F.arrow_udf("int")
    def bucket(ids: pa.Array) -> pa.Array:
        return pa.array(bucket_of(ids), pa.int32())

    # the first id of each range: one row per range
    heads = {r["b"]: r["i"] for r in rows.select("doc_id", bucket("doc_id").alias("b")).groupBy("b").agg(F.max("doc_id").alias("i")).collect()}
    order = sorted(heads)
    before = {heads[b]: order[j - 1] for j, b in enumerate(order)}  # the first one's rows follow the last one's

    @F.arrow_udf("array<int>")
    def places(ids: pa.Array) -> pa.Array:
        """A row's range; for a range's first id also the range before, as -1 - number."""
        own = bucket_of(ids).tolist()
        return pa.array([[b, -1 - before[i]] if i in before else [b] for b, i in zip(own, ids.to_pylist())], pa.list_(pa.int32()))

    dealt = (rows.select("doc_id", "text", F.explode(places("doc_id")).alias("p"))
             .select("doc_id", "text", (F.col("p") < 0).alias("copy"), F.when(F.col("p") < 0, -1 - F.col("p")).otherwise(F.col("p")).alias("b"))
             .repartitionById(int(bounds.size) + 2, F.col("b"))
             .sortWithinPartitions("b", "copy", F.desc_nulls_last("doc_id"), "text"))

    def pairs(batches):
        last = None
        for batch in batches:
            ids, copies = batch.column("doc_id").to_pylist(), batch.column("copy").to_pylist()
            for doc_id, text, copy in zip(ids, batch.column("text"), copies):
                if copy and last is None:
                    continue  # a range ends with the first copy
                row = (doc_id, text.as_py())
                if last is not None:
                    yield last, row
                last = None if copy else row

    def mapped(batches):
        held, size = [], 0
        for row in run(pairs(batches)):
            held.append(row)
            size += 1
            if size == 2000:
                yield batch_of(held, out)
                held, size = [], 0
        yield batch_of(held, out)

    return dealt.mapInArrow(mapped, out)


def edited_fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = K, width: int = WIDTH) -> DataFrame:
    """Fingerprints of each text, of the text with its second half replaced by
    the beginning of the next document's, and their likeness to each other and
    to the next document's (columns of the query)."""
    out = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")

    def run(pairs):
        following, print_of = None, None
        for (doc_id, text), later in pairs:
            own = print_of if following is text else sketch(text, k, width)
            half = len(text) // 2
            edited = text[:len(text) - half] + later[1][:half]
            changed = own if edited == text else sketch(edited, k, width)
            after = own if later[1] == text else sketch(later[1], k, width)
            following, print_of = later[1], after
            yield (doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), to_string(own), to_string(changed),
                   resemblance(own, changed, k), resemblance(own, after, k))

    return with_next(docs, id_col, text_col, run, out)

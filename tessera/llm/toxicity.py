"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary and one on toxic text.
A text is cut into overlapping windows, each compressed with the ordinary
dictionary and with both; the bytes that the toxic one saves are the window's
distance.  A document's distances (the largest, the second, how many are
clearly positive) are calibrated to a probability by logistic regression.

Toxic documents are mostly ordinary prose, so the toxic dictionary is trained
on their marks: the words with a beginning (of 4 to 8 bytes, or whole) that more
of them hold than of ordinary ones, by an exact binomial test at ``max_p``, for
each word on its own, however frequent other marks are.  The trained dictionary
is filled up with the marks that training left out, to ``toxic_bytes``.

The model is fitted on a bounded sample of labelled rows: ``n_toxic`` and
``n_ordinary`` documents, those of the lowest hash of their id, and of each its
first ``max_chars`` characters, or all of it (None; then the driver holds the
sampled texts whole).  Half of them train the dictionaries, all calibrate; the
ordinary dictionary is trained on ``n_windows`` windows spread over whole texts.
The model (a few kilobytes) goes to the executors with the scoring function;
scoring reads every text whole, one pass, no shuffle.

Defined results: null and empty texts have no distance and get the score of
that; without toxic labels every score is the smoothed base rate; rows without
an id are never trained on; repeated rows get equal scores; an empty table
gives no rows.  Inputs of a score are the text and the model alone.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import zstandard as zstd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm._common import batch_of

WINDOW, STRIDE = 64, 48  # bytes; a word of up to 16 lies whole in a window
ORDINARY_BYTES, TOXIC_BYTES = 1024, 1024  # as trained
MARK = range(4, 9)  # bytes of a word's beginning
MATCH = 6  # bytes of a beginning that save some, so ordinary words mustn't share them
CLEAR = 3  # bytes saved that count as clearly positive
# What stands before each window: the end of the ordinary dictionary.  It
# costs a few bytes with either dictionary, and spares a window that doesn't
# compress from being stored as it is, which would hide what the toxic one saves.
LEAD = 48


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: list[float]

    def __post_init__(self):
        self._pair = None

    def __getstate__(self):
        return {"ordinary": self.ordinary, "toxic": self.toxic, "weights": self.weights, "_pair": None}

    def compressors(self):
        if self._pair is None:
            self._pair = [_compressor(d) for d in (self.ordinary, self.toxic + self.ordinary)]
        return self._pair

    def features(self, text: str | None) -> tuple[float, float, float]:
        """Largest and second distance, and the share of windows that count, of 8."""
        data = text.encode("utf-8", "surrogatepass") if text else b""
        if not data or not self.toxic:
            return 0.0, 0.0, 0.0
        plain, both = self.compressors()
        saved, lead = [], self.ordinary[-LEAD:]
        for at in range(0, max(1, len(data) - WINDOW + STRIDE), STRIDE):
            window = lead + data[at:at + WINDOW]
            saved.append(len(plain.compress(window)) - len(both.compress(window)))
        top = sorted(saved, reverse=True)[:2] + [0]
        return max(top[0], 0), max(top[1], 0), min(8, sum(s >= CLEAR for s in saved))

    def score(self, text: str | None) -> float:
        z = self.weights[0] + sum(w * x for w, x in zip(self.weights[1:], self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _compressor(content: bytes) -> zstd.ZstdCompressor:
    params = zstd.ZstdCompressionParameters(
        strategy=zstd.STRATEGY_BTOPT, window_log=max(11, (len(content) + 255).bit_length()), hash_log=12, chain_log=12, search_log=6, min_match=5, target_length=64,
        write_content_size=0, write_checksum=0, write_dict_id=0)
    return zstd.ZstdCompressor(compression_params=params, dict_data=zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT))


def _trained(size: int, samples: list[bytes]) -> bytes:
    """A dictionary of up to ``size`` bytes; the samples themselves if they are too few to train on."""
    samples = [s for s in samples if len(s) >= 8]
    try:
        return zstd.train_dictionary(size, samples).as_bytes()
    except (zstd.ZstdError, ValueError):
        return b"".join(samples)[:size]


def _beginnings(word: bytes) -> set[bytes]:
    return {word, *(word[:n] for n in MARK if n < len(word))}


def _tail(n: int, of: int, share: float) -> float:
    """Probability of at least n of ``of`` when each comes with probability ``share``."""
    term = math.exp(math.lgamma(of + 1) - math.lgamma(n + 1) - math.lgamma(of - n + 1) + n * math.log(share) + (of - n) * math.log1p(-share))
    total = 0.0
    for k in range(n, of + 1):
        total += term
        if term < 1e-6 * total:
            break
        term *= (of - k) / (k + 1) * share / (1 - share)
    return total


def toxic_marks(toxic: list[bytes], ordinary: list[bytes], max_p: float, min_lift: float) -> dict[bytes, float]:
    """Beginnings of words that more toxic than ordinary documents hold, with
    their probability by chance.  They are counted by documents, and by the
    neighbours of their first place in each, so that near copies count once."""
    def rare(n, m, share):
        return _tail(n, n + m, share) if n >= 3 and n > (n + m) * share else 1.0

    if not toxic or not ordinary:
        return {}
    documents = [Counter(b for text in texts for b in set().union(*map(_beginnings, set(text.split())))) for texts in (toxic, ordinary)]
    share = len(toxic) / (len(toxic) + len(ordinary))
    clear = {b for b, n in documents[0].items() if n * len(ordinary) >= min_lift * documents[1][b] * len(toxic)}
    picked = {b for b, n in documents[0].items() if rare(n, documents[1][b], share) <= max_p
              and all(b[:k] in clear for k in (*MARK[MATCH - MARK[0]:], len(b)) if k <= len(b))}
    places = []
    for texts in (toxic, ordinary):
        seen = defaultdict(set)
        for text in texts:
            words, first = text.split(), {}
            for before, word, after in zip([b"", *words], words, [*words[1:], b""]):
                for b in _beginnings(word) & picked:
                    first.setdefault(b, (before, after))
            for b, around in first.items():
                seen[b].add(around)
        places.append(seen)
    p = {b: rare(len(places[0][b]), len(places[1][b]), share) for b in picked}
    return {b: x for b, x in p.items() if x <= max_p}


def _toxic_dictionary(texts: list[bytes], marks: dict[bytes, float], size: int) -> bytes:
    """Trained on the marked words of the texts; what it lacks is put before it, the surest nearest."""
    marked = [[w for w in t.split() if not marks.keys().isdisjoint(_beginnings(w))] for t in texts]
    content = _trained(min(size, TOXIC_BYTES), [b" " + b" ".join(words) + b" " for words in marked if words])
    often = Counter(w for words in marked for w in set(words))
    best = {}
    for word, n in sorted(often.items()):
        for b in _beginnings(word) & marks.keys():
            if n > best.get(b, (0, b""))[0]:
                best[b] = n, word
    for b in sorted(best, key=lambda b: (marks[b], b)):
        if b" " + b not in content and len(content) + len(best[b][1]) + 2 <= size:
            content = b" " + best[b][1] + b" " + content
    return content


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> list[float]:
    """Newton's method; the intercept is not penalised."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w, penalty = np.zeros(x.shape[1]), ridge * np.diag([1e-3, *[1.0] * (x.shape[1] - 1)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w.tolist()


def fit(rows: list[tuple[str, int]], weight: float = 1.0, *, max_p: float = 1e-4, min_lift: float = 20.0, toxic_bytes: int = 4096, n_windows: int = 4000) -> Model:
    """A model of (text, toxic) rows; weight: how many ordinary documents a sampled one stands for."""
    texts = [[t.encode("utf-8", "surrogatepass") for t, label in rows if label == k and t] for k in (0, 1)]
    halves = [t[: max(1, len(t) // 2)] for t in texts] if min(map(len, texts)) >= 200 else texts
    marks = toxic_marks(halves[1], halves[0], max_p, min_lift)
    plain = [(t, at) for t in halves[0] for at in range(0, len(t), WINDOW)]
    step = max(1, len(plain) // n_windows)
    plain = [t[at:at + WINDOW] for t, at in plain[::step]]
    toxic = _toxic_dictionary(halves[1], marks, toxic_bytes) if marks else b""
    model = Model(_trained(ORDINARY_BYTES, plain), toxic, [])
    x = np.array([model.features(t) for t, _ in rows], dtype=float).reshape(-1, 3)
    y = np.array([label for _, label in rows], dtype=float)
    model.weights = _logistic(x, y) if len(rows) else [-3.0, 0.0, 0.0, 0.0]
    model.weights[0] -= math.log(weight) if weight > 1 and len(rows) else 0.0
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, n_toxic: int, n_ordinary: int, max_chars: int | None) -> tuple[list[tuple[str, int]], float]:
    """The bounded sample, and the labelled ordinary documents that each of its ordinary ones stands for."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    counts = {r["toxic"]: r["n"] for r in known.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = None
    for kind, n in ((F.col("toxic") > 0, n_toxic), (F.col("toxic") <= 0, n_ordinary)):
        part = known.where(kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        picked = part if picked is None else picked.unionByName(part)
    # at most n_toxic + n_ordinary rows
    text = F.col("text") if max_chars is None else F.substring("text", 1, max_chars)
    rows = (docs.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic").agg(F.min(text).alias("text"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").collect())
    rows = [(r["text"] or "", int(r["toxic"] > 0)) for r in rows]
    ordinary, toxic = (sum(label == k for _, label in rows) for k in (0, 1))
    scale = (counts.get(0, 0) / max(1, ordinary)) / max(1.0, counts.get(1, 0) / max(1, toxic))
    return rows, scale


def toxicity_scores(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3,
                    n_toxic: int = 1000, n_ordinary: int = 2000, max_chars: int | None = 20_000, **bounds) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.  labels: doc_id, toxic; bounds: those of ``fit``."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sample, scale = training_rows(docs, labels.select("doc_id", "toxic"), n_toxic, n_ordinary, max_chars)
    model = fit(sample, scale, **bounds)
    out = "doc_id long, score double"

    def run(batches):
        for batch in batches:
            yield batch_of([(doc_id, model.score(text.as_py())) for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1))], out)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, out).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

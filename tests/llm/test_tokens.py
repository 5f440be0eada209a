"""Token files and packing against whole-text encoding."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tessera.llm import arrow_tokens, packing, tokens
from tessera.llm._common import scratch, stored

WORD, BYTE = (tokens.tokenizer_path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
TEXTS = ["", " ", "a  b\n\nc", "The cat's 3.5 dogs, 'll go.\nNow", "x\t\n y 　z  w\x1c\n q", "É é é İ ß ſ K\n ẞ",
         "tab\there  \n  and\r\nmore \n", "\x00 nul \x00\x00a", "日本語 テキスト 😀 👩‍👧", "<|endoftext|> plain <|startoftext|>", "a,b. C.D!? 12 34 5"]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_pieces_equal_whole_text(path):
    enc, whole = tokens.PieceEncoder(path, max_pieces=7), Tokenizer.from_file(path)
    for text in [*TEXTS, " \n".join(TEXTS), "".join(TEXTS)]:
        got = np.frombuffer(enc.encode(text), dtype=enc.dtype).tolist()
        assert got == whole.encode(text, add_special_tokens=False).ids, repr(text)


ODD = ["a", "B", "é", "İ", "ı", "ß", "ſ", "K", "Ω", "ς", "Σ", "e\u0301", "\u0301", "\u0338", "ﬁ", "日", "ก็", "😀", "👩\u200d👧", "1", "²", "٣", "Ⅷ",
       ".", ",", "'", "'s", "'LL", "$$$", "!?", "_", "<|", "|>", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "…", "«",
       " ", "  ", "\n", "\r\n", "\t", "\u00a0", "\u2003", "\u3000", "\x00", "\x1c", "\x85", "word", "Word", "que"]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_random_odd_strings_equal_the_library(path):
    enc, whole, rng = tokens.PieceEncoder(path, max_pieces=50), Tokenizer.from_file(path), random.Random(5)
    for _ in range(10_000):
        text = "".join(rng.choices(ODD, k=rng.randint(1, 12)))
        got = np.frombuffer(enc.encode(text), dtype=enc.dtype).tolist()
        assert got == whole.encode(text, add_special_tokens=False).ids, repr(text)


def _expected(rows, path, end=1):
    whole = Tokenizer.from_file(path)
    return {r["doc_id"]: whole.encode(r["text"] or "", add_special_tokens=False).ids + [end] for r in rows}


def _crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_token_files_round_trip(spark, odd_docs):
    out = scratch(spark, "t")
    manifest = arrow_tokens.write_token_files(odd_docs, out, WORD, seq_len=64, batch_sequences=4)
    rows = arrow_tokens.read_token_files(spark, out).orderBy("start").collect()
    want = _expected(odd_docs.collect(), WORD)
    assert [r["doc_id"] for r in rows] == [None, 1, 2, 3, 4, 5, 6, 6]
    at = 0
    for r in rows:
        ids = want[r["doc_id"]]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), _crc(ids))
        at += len(ids)
    # random access: sequences of equal length, padded only where masked
    stream = []
    for m in sorted(manifest.collect()):
        file = arrow_tokens.TokenFile(m["tokens_path"])
        for i in range(m["n_sequences"]):
            ids, mask = file.sequence(i)
            assert len(ids) == len(mask) == 64 and not ids.flags.owndata
            stream += ids[np.array(mask.to_pylist(), dtype=bool)].tolist()
    assert stream == [x for r in rows for x in want[r["doc_id"]]]


def test_token_files_of_empty_table(spark, no_docs):
    out = scratch(spark, "t")
    assert arrow_tokens.write_token_files(no_docs, out, WORD).count() == 0
    assert arrow_tokens.read_token_files(spark, out).count() == 0


def _best_sum(counts, room):
    sums = {0}
    for length, n in counts.items():
        for _ in range(min(n, room // length)):
            sums |= {s + length for s in sums if s + length <= room}
    return max(sums)


def test_fill_window_is_closest():
    rng = np.random.default_rng(1)
    for _ in range(60):
        counts = Counter(rng.integers(1, 60, size=rng.integers(1, 9)).tolist())
        window = packing.fill_window(counts, 64)
        assert all(counts[x] >= m for x, m in window.items()) and max(counts) in window
        rest = Counter(counts)
        rest[max(counts)] -= 1
        assert sum(x * m for x, m in window.items()) == max(counts) + _best_sum(rest, 64 - max(counts))


def test_plan_covers_each_rank_once():
    rng = np.random.default_rng(2)
    counts = dict(Counter(rng.integers(1, 2048, size=5000).tolist()) | {7: 40_000})
    rows, windows = packing.plan_windows(counts, 2048)
    ranks, fill = defaultdict(list), Counter()
    for length, first, n, m, base, offset in rows:
        ranks[length].append((first, n))
        for j in range(n // m):
            fill[base + j] += m * length
    for length, spans in ranks.items():
        at = 0
        for first, n in sorted(spans):
            assert first == at
            at += n
        assert at == counts[length]
    assert len(fill) == windows and max(fill.values()) <= 2048
    assert sum(2048 - x for x in fill.values()) <= 0.01 * 2048 * windows


def test_pack_places_each_id_once(spark, odd_docs):
    pieces, placed = packing.pack_tables(odd_docs, BYTE, capacity=256)
    pieces, placed = (stored(df, "t") for df in (pieces, placed))  # plain tables, read again
    want = _expected(odd_docs.collect(), BYTE)
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    rows = placed.collect()
    for r in rows:
        ids = want[r["doc_id"]]
        assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == _crc(ids[r["start"]:r["start"] + r["length"]])
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append((r["start"], r["length"]))
    for spans in by_seq.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 256
    for doc, spans in by_doc.items():
        assert sum(n for _, n in spans) == len(want[doc]) * (2 if doc == 6 else 1)
    seqs = {r["sequence_id"]: r for r in packing.packed_sequences(pieces, placed, capacity=256, pad_id=9).collect()}
    assert seqs.keys() == by_seq.keys()
    dtype = np.dtype(tokens.id_dtype(BYTE))
    for s, spans in by_seq.items():
        parts = sorted((r["offset"], r["doc_id"], r["start"], r["length"]) for r in rows if r["sequence_id"] == s)
        ids = [x for _, d, a, n in parts for x in want[d][a:a + n]]
        size = len(ids) if len(ids) & (len(ids) - 1) == 0 else 256
        assert np.frombuffer(seqs[s]["ids"], dtype=dtype).tolist() == ids + [9] * (size - len(ids))
        assert seqs[s]["mask"] == [1] * len(ids) + [0] * (size - len(ids)) and seqs[s]["n_tokens"] == len(ids)
    # unpacked, the sequences give every document's ids back
    back = defaultdict(dict)
    for r in seqs.values():
        at = 0
        for d, a, n in zip(r["doc_ids"], r["starts"], r["lengths"]):
            back[d].setdefault(a, np.frombuffer(r["ids"], dtype=dtype)[at:at + n].tolist())
            at += n
    assert {d: [x for _, ids in sorted(p.items()) for x in ids] for d, p in back.items()} == want


def test_pack_empty(spark, no_docs):
    assert packing.pack(no_docs, BYTE).count() == 0

"""Repairs against the cheapest of all edits in plain Python."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tessera.llm import catalog, repair
from tessera.llm._common import read_table

SF = "/root/testdata/sf0.001"
ROWS = "conv_id long, turn long, role string, text string"
SHAPE = re.compile(r"(s?(ua)+)?")


def damage(rows):
    """{conv_id: rows after damage}"""
    out = {}
    for c, t, role, text in rows:
        kept = out.setdefault(c, [])
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        kept += [(t, "user" if code == 4 else role, text)] * (code != 0) * (1 + (code == 3))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))


def faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """(cost, audit, repaired rows), least by (cost, audit), from the end on."""
    after = {"": (0, "", []), "A": (0, "", [])}  # by what was written last: S, U, A or nothing
    follows = {"": "su", "S": "u", "U": "a", "A": "u"}
    full = {"s": "system", "u": "user", "a": "assistant"}

    def put_in(best):
        for _ in range(3):
            for state, next_ in (("", "u"), ("S", "u"), ("U", "a"), ("A", "u")):
                if next_.upper() in best:
                    cost, audit, rest = best[next_.upper()]
                    way = (cost + 3, "I" + audit, [(full[next_], "")] + rest)
                    best[state] = min(best.get(state, way), way, key=lambda w: w[:2])
        return best

    after = put_in(after)
    for (_, role, text), fault in zip(reversed(rows), reversed(found)):
        now = {}
        for state in follows:
            ways = []
            if state in after:
                cost, audit, rest = after[state]
                ways.append((cost + 4, "D" + audit, rest))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if role[:1] and role[:1] in follows[state] and role[:1].upper() in after:
                    cost, audit, rest = after[role[:1].upper()]
                    ways.append((cost + more, "K" + audit, [(role, text)] + rest))
                for r in "ua":
                    if r in follows[state] and r.upper() in after:
                        cost, audit, rest = after[r.upper()]
                        ways.append((cost + more + 3, "R" + audit, [(full[r], text)] + rest))
            if ways:
                now[state] = min(ways, key=lambda w: w[:2])
        after = put_in(now)
    return after[""]


def brute(rows):
    out = []
    for c, kept in damage(rows).items():
        kept = order(kept)
        found = faults(kept)
        turns = [t for t, _, _ in kept if t is not None]
        cost, audit, text = cheapest(kept, found)
        assert SHAPE.fullmatch("".join(r[0] for r, _ in text))
        out.append((c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(found.count(f) for f in ("blank", "duplicate", "truncated")),
                    sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:])), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in text).encode()).hexdigest()))
    return sorted(out, key=str)


def check(df, **kw):
    got = repair.repaired_conversations(df, **kw)
    assert sorted(map(tuple, got.collect()), key=str) == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def made(rnd, c, n, roles=("user", "assistant", "system", "tool", "sage", "ugly", ""), texts=None):
    pool = texts or [f"{w}{e}" for w in ("yes", "no", "what is it", "so") for e in (".", "?", "", " ! \n")] + ["", " \n", "one more."]
    return [(c, t, rnd.choice(roles), rnd.choice(pool) + (f" {rnd.randint(0, 99)}." if rnd.random() < 0.5 else "")) for t in range(n)]


def test_cheapest_is_the_least_of_all_edits():
    def every(rows, found):
        best = None
        one = [("D",)] + [("K",), ("Ru",), ("Ra",)]
        gaps = ["", "u", "a", "ua", "au"]
        for ops in itertools.product(*[one[:1] if f in ("blank", "duplicate") else one for f in found]):
            for ins in itertools.product(gaps, repeat=len(rows) + 1):
                cost, audit, roles = 0, "", ""
                for i, gap in enumerate(ins):
                    cost, audit, roles = cost + 3 * len(gap), audit + "I" * len(gap), roles + gap
                    if i < len(rows):
                        op = ops[i][0]
                        audit += op[0]
                        cost += {"D": 4, "K": 0, "R": 3}[op[0]] + 3 * (op != "D" and found[i] == "truncated")
                        roles += "" if op == "D" else op[1:] or (rows[i][1][:1] or "?")
                if SHAPE.fullmatch(roles) and (best is None or (cost, audit) < best):
                    best = cost, audit
        return best

    rnd = random.Random(5)
    for _ in range(60):
        rows = order([r[1:] for r in made(rnd, 0, rnd.randint(0, 3))])
        found = faults(rows)
        assert cheapest(rows, found)[:2] == every(rows, found)


def test_table(spark):
    rows = [tuple(r) for r in read_table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, catalog.op11_rank_convergence(spark, SF).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("block", [1, 7, 4096])
def test_chunks(spark, block):
    rnd = random.Random(block)
    rows = [r for c in range(25) for r in made(rnd, c, rnd.randint(1, min(12, 5 * block)))]
    n = 6 if block == 1 else 60
    rows += made(rnd, 100, 2 * n) + made(rnd, 101, n, ("user",)) + made(rnd, 102, n, ("tool",)) + made(rnd, 103, n, ("user", "assistant"), ["the same."])
    check(spark.createDataFrame(rows, ROWS).repartition(5), block=block)


def test_odd_rows(spark):
    long = "word " * 200_000
    rows = [(None, None, None, None), (None, 3, "user", "a."), (1, None, "assistant", "b"), (1, None, "assistant", "b"), (1, 5, None, long), (1, 5, "user", long + "."),
            (2, 2**62, "user", "é😀?"), (2, -5, "system", "x."), (3, 0, "", ""), (4, 1, "user", None)]
    df = spark.createDataFrame(rows, ROWS).selectExpr("*", "turn AS _idx", "role AS digest", "text AS edit", "conv_id AS block", "1 AS dropped", "2 AS _absent")
    check(df)
    assert repair.repaired_conversations(spark.createDataFrame([], ROWS)).count() == 0
    dropped = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    check(spark.createDataFrame([(9, dropped, "user", "gone.")], ROWS))


def test_without_damage(spark):
    rows = [(1, 0, "user", "Hello."), (1, 1, "assistant", "Hi!"), (2, 0, "assistant", "Hi!"), (3, 0, "user", "Hello?")]
    got = {r["conv_id"]: (r["cost"], r["audit"]) for r in repair.repair(spark.createDataFrame(rows, ROWS)).collect()}
    assert got == {1: (0, "KK"), 2: (3, "IK"), 3: (3, "KI")}

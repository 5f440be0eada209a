"""Repair of conversation structure: the cheapest edits that make the roles of
a conversation's rows alternate, user first and assistant last, after at most
one system row.

A row is kept (free), given the role user or assistant (REROLE), or deleted
(DELETE; a blank row, or one whose role and text came before, must be), and an
empty user or assistant row may be put in anywhere (INSERT); a truncated row
that stays costs TRUNCATED more.  Of the cheapest ways the one whose edits'
initials (D, I, K, R) come first is taken.  By the roles written so far there
are four states: none, system, user, assistant; ``costs`` is the vector of the
cheapest completions from each of them.  In each state only one role can be
put in, so initials determine a way, and going forward the least letter whose
cost leaves the optimum is the right one.

Rank convergence: conversations lie in one order of rows, cut into blocks of
equal numbers of rows; a conversation's part in a block is a chunk.  All
chunks at once go from their last row to their first, starting from a
speculative vector (that of a conversation's end).  Only differences between
states matter, so what a chunk made of a vector also holds for all that differ
from it by a constant.  A walk over the chunks' ends then compares what was
assumed with what the following chunk gives; chunks whose vectors differ by
more than a constant are run again from the new one (a fix-up pass), until
none does.  The vectors at the chunks' ends being right, each chunk says which
state it leaves for each state it is entered in; a second walk joins these up,
and every chunk traces its least way on its own.

Scale: chunks have at most ``block`` rows, whatever a conversation's length,
and no text.  The walks stream two rows a block.  What a pass found is kept,
so a chunk is run once for a vector; few vectors differ by more than a
constant, as a row or two put in or deleted lead from any state to another.  Texts are
shuffled once, to be hashed in order: SHA-256 has no parallel form, so one task
streams a conversation's rows through it, holding one of them at a time (and
the conversation's audit, a column of the result).

Defined results: rows are ordered by turn (null first), then role, then the
digest of role and text; a null role or text is one space; a null conv_id is
a conversation; a role is legal by its first letter s, u or a; an empty table
gives no row; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm._common import batch_of, global_index, stored

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLOCK = 4096
BLANK = " \t\n\x0b\x0c\r"
NONE, SYSTEM, USER, ASSISTANT = range(4)
PUT_IN = (USER, USER, ASSISTANT, USER)  # the state after the one role that can be put in
KEPT = {0: {NONE: SYSTEM}, 1: {NONE: USER, SYSTEM: USER, ASSISTANT: USER}, 2: {USER: ASSISTANT}, 3: {}}  # by initial: s, u, a, other
LETTER = {USER: "u", ASSISTANT: "a"}
FINAL = (0, 2 * INSERT, INSERT, 0)  # the vector after the last row
ABSENT, FORCED = 0, 1  # codes of rows; others: 2 + initial + 4 if truncated
FAULTS = ("absent", "none", "blank", "duplicate", "truncated")
RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


@functools.cache
def step_back(after: tuple, code: int) -> tuple:
    """The vector before a row from that after it, rows put in before it included."""
    if code == ABSENT:
        return after
    if code == FORCED:
        return tuple(x + DELETE for x in after)
    more = TRUNCATED if code >= 6 else 0
    kept = KEPT[(code - 2) % 4]
    raw = [min([DELETE + after[x], REROLE + more + after[PUT_IN[x]], *([more + after[kept[x]]] if x in kept else [])]) for x in range(4)]
    user, assistant = min(raw[USER], INSERT + raw[ASSISTANT]), min(raw[ASSISTANT], INSERT + raw[USER])
    return min(raw[NONE], INSERT + user), min(raw[SYSTEM], INSERT + user), user, assistant


@functools.cache
def leveled(costs: tuple) -> tuple:
    """The vector less its least cost: equal for vectors that differ by a constant."""
    least = min(costs)
    return tuple(x - least for x in costs)


@functools.cache
def step_on(after: tuple, code: int, state: int) -> tuple[str, int]:
    """(edits, next state) of the least way over a row.  Edits: u, a rows put
    in; D, K; U, A the row's new role."""
    if code == ABSENT:
        return "", state
    costs, edits = step_back(after, code), ""
    kept, more = KEPT[(code - 2) % 4] if code != FORCED else {}, TRUNCATED if code >= 6 else 0
    while True:
        if DELETE + after[state] == costs[state]:
            return edits + "D", state
        into = PUT_IN[state]
        if INSERT + costs[into] == costs[state]:
            edits, state = edits + LETTER[into], into
        elif state in kept and more + after[kept[state]] == costs[state]:
            return edits + "K", kept[state]
        else:
            return edits + LETTER[into].upper(), into


def vectors(codes, end: tuple) -> list[tuple]:
    """The leveled vector after each row, and before the first (the last item)."""
    out = [end]
    for code in reversed(codes):
        out.append(leveled(step_back(out[-1], code)))
    return out


def trace(codes, after: list[tuple], state: int, last: bool) -> tuple[list[str], int]:
    """Edits of each row from ``vectors``; ``last``: the conversation ends here."""
    edits = []
    for i, code in enumerate(codes):
        edit, state = step_on(after[len(codes) - 1 - i], code, state)
        edits.append(edit)
    while last and state in (SYSTEM, USER):
        state = PUT_IN[state]
        edits[-1] += LETTER[state]
    return edits, state


def _text(vector: tuple) -> str:
    return ",".join(map(str, vector))


def _vector(text: str) -> tuple:
    return tuple(map(int, text.split(",")))


def _segments(conv: list) -> list[tuple[int, int]]:
    """(first, end) of the runs of equal values."""
    cuts = [0, *[i for i in range(1, len(conv)) if conv[i] != conv[i - 1]], len(conv)]
    return list(zip(cuts, cuts[1:]))


def _ordered(df: DataFrame, *order) -> DataFrame:
    return df.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", *order)


def _back(codes: DataFrame) -> DataFrame:
    """What chunks make of their end vectors: (conv_id, block, end, start).
    Of whole blocks the first and last chunk, the others being whole conversations."""
    schema = "conv_id long, block long, end string, start string"

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("_idx")
        conv, code, end, block = (t.column(c).to_pylist() for c in ("conv_id", "code", "end", "block"))
        parts = _segments(conv)
        rows = [(conv[a], block[a], end[a], _text(vectors(code[a:b], _vector(end[a]))[-1])) for a, b in dict.fromkeys((parts[0], parts[-1]))]
        return pa.Table.from_batches([batch_of(rows, schema)])

    return codes.groupBy("block").applyInArrow(run, schema)


def _walk_back(known: DataFrame) -> DataFrame:
    """From each conversation's last chunk to its first: the vector at each
    one's end by what is known, whether its run from there is known, and
    whether it is the last.  Beyond a chunk that isn't known, the walk goes on
    with another vector's outcome, a speculation."""
    schema = "conv_id long, block long, end string, found boolean, last boolean"

    def run(batches):
        conv, block, made, vector, last = None, None, {}, _text(FINAL), True

        def close():
            nonlocal vector, last
            row = (conv, block, vector, vector in made, last)
            vector, last = made.get(vector) or next(iter(made.values())), False
            return row

        for b in batches:
            rows = []
            for c, k, end, start in zip(*(b.column(x).to_pylist() for x in ("conv_id", "block", "end", "start"))):
                if made and (c, k) != (conv, block):
                    rows.append(close())
                    made = {}
                if c != conv:
                    vector, last = _text(FINAL), True
                conv, block = c, k
                made[end] = start
            yield batch_of(rows, schema)
        yield batch_of([close()] if made else [], schema)

    return _ordered(known, F.desc("block"), "end").mapInArrow(run, schema)


def _exits(codes: DataFrame) -> DataFrame:
    """The state in which a chunk is left, by that in which it is entered."""
    schema = "conv_id long, block long, end string, last boolean, exits string"

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("_idx")
        conv, code, end, block, last = (t.column(c).to_pylist() for c in ("conv_id", "code", "end", "block", "last"))
        rows = []
        for a, b in _segments(conv):
            after = vectors(code[a:b], _vector(end[a]))
            rows.append((conv[a], block[a], end[a], last[a], "".join(str(trace(code[a:b], after, s, last[a])[1]) for s in range(4))))
        return pa.Table.from_batches([batch_of(rows, schema)])

    return codes.groupBy("block").applyInArrow(run, schema)


def _walk_on(exits: DataFrame) -> DataFrame:
    """From each conversation's first chunk to its last: the state in which each is entered."""
    schema = "conv_id long, block long, end string, last boolean, state int"

    def run(batches):
        import pyarrow as pa  # noqa: F811

        conv, state, begun = None, NONE, False
        for b in batches:
            states = []
            for c, out in zip(b.column("conv_id").to_pylist(), b.column("exits").to_pylist()):
                if c != conv or not begun:
                    conv, state, begun = c, NONE, True
                states.append(state)
                state = int(out[state])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("conv_id", "block", "end", "last")), pa.array(states, pa.int32())],
                                             names=["conv_id", "block", "end", "last", "state"])

    return _ordered(exits, "block").mapInArrow(run, schema)


def _edits(codes: DataFrame) -> DataFrame:
    """Every row's edits."""
    fields = [f for f in codes.schema.fields if f.name not in ("end", "last", "state", "block")]
    names = [f.name for f in fields]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", edit string"

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("_idx")
        conv, code, end, last, state = (t.column(c).to_pylist() for c in ("conv_id", "code", "end", "last", "state"))
        edits = []
        for a, b in _segments(conv):
            after = vectors(code[a:b], _vector(end[a]) if end[a] else FINAL)
            edits += trace(code[a:b], after, state[a] or NONE, last[a] is not False)[0]
        return t.select(names).append_column("edit", pa.array(edits, pa.string()))

    return codes.groupBy("block").applyInArrow(run, schema)


def _repaired(rows):
    """The stream of a partition's rows, each text before its row's edits, as results."""
    conv, open_, text = None, False, None

    def begin():
        return {"n": dict.fromkeys(FAULTS, 0), "turns": [None, None, 0], "illegal": 0, "cost": 0, "audit": [], "hash": hashlib.sha256(), "any": False, "role": None}

    def result():
        low, high, distinct = c["turns"]
        return (conv, high - low + 1 - distinct if distinct else 0, *(c["n"][f] for f in FAULTS[2:]), c["illegal"], c["cost"],
                "".join(c["audit"]), c["hash"].hexdigest())

    def write(role, body):
        c["hash"].update((("\n" if c["any"] else "") + role + ":" + body).encode("utf-8", "surrogatepass"))
        c["any"] = True

    c = begin()
    for conv_id, turn, role, body, edit, fault in rows:
        if open_ and conv_id != conv:
            yield result()
            c = begin()
        conv, open_ = conv_id, True
        if edit is None:
            text = body
            continue
        c["n"][FAULTS[fault]] += 1
        if fault:
            if turn is not None:
                low, high, distinct = c["turns"]
                c["turns"] = [turn if low is None else low, turn, distinct + (turn != high)]
            if c["role"] is not None and c["role"] + role[:1] not in ("su", "ua", "au"):
                c["illegal"] += 1
            c["role"] = role[:1]
        for e in edit:
            if e in "ua":
                c["cost"] += INSERT
                write("user" if e == "u" else "assistant", "")
            elif e == "D":
                c["cost"] += DELETE
            else:
                c["cost"] += (e != "K") * REROLE + (fault == 4) * TRUNCATED
                write({"K": role, "U": "user", "A": "assistant"}[e], text.as_py())
        c["audit"].append(edit.translate(_INITIALS))
    if open_:
        yield result()


_INITIALS = str.maketrans("uaUA", "IIRR")


def row_codes(rows: DataFrame, absent: Column, *, name: str = "turns") -> DataFrame:
    """Rows in order, without texts: _idx, conv_id, turn, role, digest, fault (of FAULTS), code."""
    body = F.rtrim(F.col("text"), F.lit(BLANK))
    initial = F.array_position(F.array(*map(F.lit, "sua")), F.substring("role", 1, 1))
    narrow = stored(rows.select(
        "conv_id", "turn", "role", _digest().alias("digest"), absent.alias("absent"), (body == "").alias("blank"),
        (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("cut"), F.when(initial == 0, 3).otherwise(initial - 1).cast("int").alias("initial"))
        .withColumn("key", F.sha2(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), "digest"), 256)), name)
    ordered = global_index(narrow, ["conv_id", "turn", "role", "digest"], f"{name}-ordered")
    first = ordered.where(~F.col("absent") & ~F.col("blank")).groupBy("key").agg(F.min("_idx").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    fault = (F.when(F.col("absent"), 0).when(F.col("blank"), 2).when(F.col("_idx") > F.col("first"), 3).when(F.col("cut"), 4).otherwise(1))
    code = F.when(F.col("fault") == 0, ABSENT).when(F.col("fault").isin(2, 3), FORCED).otherwise(2 + F.col("initial") + F.when(F.col("fault") == 4, 4).otherwise(0))
    return (ordered.join(first.select("key", "first"), "key", "left").withColumn("fault", fault).withColumn("code", code.cast("int"))
            .select("_idx", "conv_id", "turn", "role", "digest", "fault", "code"))


def _digest() -> Column:
    return F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)


def repair(conversations: DataFrame, *, absent: Column | None = None, block: int = BLOCK) -> DataFrame:
    """One row per conversation (RESULT) of rows (conv_id, turn, role, text):
    its faults, and the audit and digest of its cheapest repair.  A row that is
    ``absent`` is not part of its conversation, but makes it known."""
    absent = F.lit(False) if absent is None else absent
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), absent.alias("_absent"))
    codes = stored(row_codes(rows, F.col("_absent")).withColumn("block", F.expr(f"_idx div {int(block)}")), "codes")
    slim = codes.select("_idx", "conv_id", "block", "code")

    def of_chunks(chunks: DataFrame) -> DataFrame:
        """The rows of chunks with the chunks' columns."""
        c = chunks.withColumnRenamed("conv_id", "own").withColumnRenamed("block", "at")
        return slim.join(c, (slim["block"] == c["at"]) & slim["conv_id"].eqNullSafe(c["own"])).drop("own", "at")

    known = stored(_back(slim.withColumn("end", F.lit(_text(FINAL)))), "known")
    while True:
        ends = stored(_walk_back(known), "ends")
        again = ends.where(~F.col("found"))
        if again.isEmpty():
            break
        known = known.unionByName(stored(_back(of_chunks(again.select("conv_id", "block", "end"))), "known"))
    states = _walk_on(_exits(of_chunks(ends.select("conv_id", "block", "end", "last"))))
    s = states.withColumnRenamed("conv_id", "own").withColumnRenamed("block", "at")
    edits = _edits(codes.join(s, (codes["block"] == s["at"]) & codes["conv_id"].eqNullSafe(s["own"]), "left").drop("own", "at"))
    texts = rows.where(~F.col("_absent") & (F.rtrim(F.col("text"), F.lit(BLANK)) != "")).select(
        "conv_id", "turn", "role", _digest().alias("digest"), F.lit(None).cast("long").alias("_idx"), "text",
        F.lit(None).cast("string").alias("edit"), F.lit(None).cast("int").alias("fault"))
    both = texts.unionByName(edits.select("conv_id", "turn", "role", "digest", "_idx", F.lit(None).cast("string").alias("text"), "edit", "fault"))

    def run(batches):
        def stream():
            for b in batches:
                columns = [b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "edit", "fault")]
                for conv_id, turn, role, edit, fault, text in zip(*columns, b.column("text")):
                    yield conv_id, turn, role, text, edit, fault
        held = []
        for row in _repaired(stream()):
            held.append(row)
            if len(held) == 1000:
                yield batch_of(held, RESULT)
                held = []
        yield batch_of(held, RESULT)

    # a text (no _idx: first) comes before the edits of the rows that have it
    return _ordered(both, "turn", "role", "digest", "_idx").mapInArrow(run, RESULT)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with the faults of the query's contract: (conv_id, turn, role, text, dropped)."""
    def shown(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    hit = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(hit == 1, "").when(hit == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    return conversations.select("conv_id", "turn", F.when(hit == 4, "user").otherwise(shown("role")).alias("role"), text.alias("text"),
                                (hit == 0).alias("dropped"), F.explode(F.sequence(F.lit(1), F.when(hit == 3, 2).otherwise(1))).alias("_copy")).drop("_copy")


def repaired_conversations(conversations: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """Conversations after damage, repaired (columns of the query)."""
    return repair(damaged(conversations), absent=F.col("dropped"), block=block)

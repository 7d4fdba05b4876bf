"""Repair of conversation structure at least cost, over a graph of the cheapest edits.

A conversation's rows, in order, and the states of a grammar over role initials span a
graph: node (rows read, state), arcs Keep, Rerole, Delete and Insert.  Least costs from
the start and to the end are computed for every node; an arc is *tight* if both and its
own cost add up to the least total, so the tight arcs are all optimal repairs.  A frontier
of nodes then walks them from the start and takes the least edit letter at each step.

Rows are ordered by turn (nulls first), role and SHA-256 of the text, so rows of equal
turn have one order and equal rows are interchangeable.  Small conversations are repaired
by one call each.  Those beyond ``max_rows`` rows or ``max_bytes`` of text are cut into
chunks: costs through a chunk are a min-plus matrix, matrices are multiplied along the
conversation, and each chunk is walked from every state it may be entered in.  Only a
conversation's digest, by its definition, is one task's pass over its texts in order; it
holds one batch at a time.

Defined results: a null role or text is one space, which is blank text and no role's
initial; a null conversation id is one conversation; a null turn is the least one; equal
rows behind the first are duplicates; an empty table gives an empty result; other columns
are left out of the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import store

SPACE = " \t\n\x0b\f\r"
FAR = 1 << 60  # cost of what cannot be reached
DELETE, INSERT, KEEP, REROLE = "DIKR"

# fault of a row, and the letters that code it beside a known role's initial and any other
BLANK, DUPLICATE, TRUNCATED, FINE = range(4)


@dataclass(frozen=True)
class Grammar:
    """Roles by initial: ``steps`` (state, initial) -> state from state 0; ``fills`` state -> the one role that Rerole and Insert may set there."""

    n_states: int
    steps: dict[tuple[int, str], int]
    accepting: frozenset[int]
    fills: dict[int, str]
    pairs: frozenset[str]
    rerole: int = 3
    delete: int = 4
    insert: int = 3
    truncated: int = 3

    @cached_property
    def inserts(self) -> list[tuple[int, int]]:
        return [(q, self.steps[q, role[0]]) for q, role in self.fills.items()]

    @lru_cache(maxsize=4096)  # noqa: B019 - one grammar lives as long as its worker
    def arcs(self, initial: str, fault: int) -> list[tuple[str, int, int, int]]:
        """(letter, from state, to state, cost) of the edits that read a row."""
        out = [(DELETE, q, q, self.delete) for q in range(self.n_states)]
        if fault in (TRUNCATED, FINE):
            more = self.truncated if fault == TRUNCATED else 0
            out += [(KEEP, q, to, more) for (q, i), to in self.steps.items() if i == initial]
            out += [(REROLE, q, to, more + self.rerole) for q, to in self.inserts]
        return out

    def __hash__(self) -> int:
        return id(self)


#: an optional system turn, then user and assistant in turn
CHAT = Grammar(
    n_states=4,
    steps={(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2},
    accepting=frozenset({0, 3}),
    fills={0: "user", 1: "user", 2: "assistant", 3: "user"},
    pairs=frozenset({"su", "ua", "au"}),
)

Row = tuple[str, int]  # (initial of the role, fault)


def after_inserts(g: Grammar, cost: list[int]) -> list[int]:
    """Least costs from the start once rows may be inserted."""
    for _ in range(g.n_states):
        for q, to in g.inserts:
            cost[to] = min(cost[to], cost[q] + g.insert)
    return cost


def before_inserts(g: Grammar, cost: list[int]) -> list[int]:
    """Least costs to the end once rows may be inserted."""
    for _ in range(g.n_states):
        for q, to in g.inserts:
            cost[q] = min(cost[q], cost[to] + g.insert)
    return cost


def forward(g: Grammar, rows: list[Row], entry: list[int]) -> list[list[int]]:
    """Least cost of each node from the start, given the costs of entering each state."""
    layers = [after_inserts(g, list(entry))]
    for initial, fault in rows:
        at, to = layers[-1], [FAR] * g.n_states
        for _, q, r, w in g.arcs(initial, fault):
            to[r] = min(to[r], at[q] + w)
        layers.append(after_inserts(g, to))
    return layers


def backward(g: Grammar, rows: list[Row], leave: list[int]) -> list[list[int]]:
    """Least cost of each node to the end, given the costs from each state behind the last row."""
    layers = [before_inserts(g, list(leave))]
    for initial, fault in reversed(rows):
        at, to = layers[-1], [FAR] * g.n_states
        for _, q, r, w in g.arcs(initial, fault):
            to[q] = min(to[q], at[r] + w)
        layers.append(before_inserts(g, to))
    return layers[::-1]


def the_end(g: Grammar) -> list[int]:
    return [0 if q in g.accepting else FAR for q in range(g.n_states)]


def walk(g: Grammar, rows: list[Row], f: list[list[int]], b: list[list[int]], total: int, state: int, last: bool) -> tuple[str, int]:
    """(letters, state behind them) of the least optimal edits from a node on a cheapest path; rows inserted behind the last row belong to the last chunk."""
    letters: list[str] = []
    frontier = {state}
    i = 0
    while True:
        if i == len(rows) and (not last or any(q in g.accepting and f[i][q] == total for q in frontier)):
            return "".join(letters), min(frontier)
        nodes: dict[str, set[int]] = {}
        if i < len(rows):
            for letter, q, to, w in g.arcs(*rows[i]):
                if q in frontier and f[i][q] + w + b[i + 1][to] == total:
                    nodes.setdefault(letter, set()).add(to)
        for q, to in g.inserts:
            if q in frontier and f[i][q] + g.insert + b[i][to] == total:
                nodes.setdefault(INSERT, set()).add(to)
        least = min(nodes)
        letters.append(least)
        frontier = nodes[least]
        i += least != INSERT


def cheapest(g: Grammar, rows: list[Row]) -> tuple[int, str]:
    """(least cost, least letters) of a whole conversation."""
    f = forward(g, rows, [0] + [FAR] * (g.n_states - 1))
    b = backward(g, rows, the_end(g))
    return b[0][0], walk(g, rows, f, b, b[0][0], 0, True)[0]


def played(g: Grammar, letters: str, initials: Iterable[str], state: int) -> Iterator[tuple[str, str | None]]:
    """(letter, role that it sets, if any) of each edit from a state on."""
    rows = iter(initials)
    for letter in letters:
        initial = None if letter == INSERT else next(rows)
        role = g.fills[state] if letter in (INSERT, REROLE) else None
        if letter != DELETE:
            state = g.steps[state, role[0] if role else initial]
        yield letter, role


def illegal(g: Grammar, initials: list[str]) -> int:
    return sum(a + b not in g.pairs for a, b in zip(initials, initials[1:], strict=False))


# --- rows ---------------------------------------------------------------------------------


def _known(g: Grammar, role: Column) -> Column:
    """The role's initial if the grammar has it, else '-'."""
    initial = F.substring(role, 1, 1)
    return F.when(initial.isin(sorted({i for _, i in g.steps} | set("".join(g.pairs)))), initial).otherwise("-")


def prepared(df: DataFrame, g: Grammar, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, turn, role, text, the text's digest, the role's initial and whether the row is blank or truncated."""
    rows = df.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"))
    end = F.rtrim("text", F.lit(SPACE))
    fault = F.when(end == "", BLANK).when(F.right(end, F.lit(1)).isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    return rows.withColumns({"digest": F.sha2("text", 256), "initial": _known(g, F.col("role")), "fault": fault})


def _ordered() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("digest").asc()]


REPORT = [("blank", "bigint"), ("duplicate", "bigint"), ("truncated", "bigint"), ("illegal", "bigint"), ("cost", "bigint"), ("audit", "string")]
TURN = [("place", "bigint"), ("edit", "string"), ("turn", "bigint"), ("role", "string"), ("text", "string")]


def _runs(batches: Iterable[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[pa.DataType, object, list[tuple]]]:
    """(type of the ids, id, rows) of each conversation of a task, whose rows come by conversation."""
    held: list[tuple] = []
    kind = current = None
    for batch in batches:
        kind = batch.column("conv").type
        rows = zip(*(batch.column(c).to_pylist() for c in columns), strict=True)
        for key, row in zip(batch.column("conv").to_pylist(), rows, strict=True):
            if held and key != current:
                yield kind, current, held
                held = []
            current = key
            held.append(row)
    if held:
        yield kind, current, held


def _faults(rows: Iterable[tuple[str, str, str, int]]) -> list[Row]:
    """(initial, first fault) of rows of role, digest, initial and own fault; those not blank are looked for among the earlier."""
    seen: set[tuple[str, str]] = set()
    out = []
    for role, digest, initial, fault in rows:
        if fault != BLANK and (role, digest) in seen:
            fault = DUPLICATE
        seen.add((role, digest))
        out.append((initial, fault))
    return out


def _small(rows: DataFrame, g: Grammar, turns: bool) -> DataFrame:
    """Reports with the repaired digest, or repaired turns, of conversations that are held one at a time."""
    conv, turn = (rows.schema[c].dataType.simpleString() for c in ("conv", "turn"))
    fields = [(n, turn if n == "turn" else t) for n, t in TURN] if turns else [("gaps", "bigint"), *REPORT, ("repaired_sha256", "string")]
    schema = f"conv {conv}, " + ", ".join(f"{n} {t}" for n, t in fields)
    columns = ["role", "digest", "initial", "fault", "turn", "text"]

    def report(held: list[tuple]) -> list[tuple]:
        marks = _faults(r[:4] for r in held)
        cost, audit = cheapest(g, marks)
        kinds = [fault for _, fault in marks]
        known = {r[4] for r in held if r[4] is not None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        digest = hashlib.sha256("\n".join(f"{role}:{text}" for _, _, _, role, text in repaired(held, marks, audit)).encode()).hexdigest()
        return [(gaps, kinds.count(BLANK), kinds.count(DUPLICATE), kinds.count(TRUNCATED), illegal(g, [i for i, _ in marks]), cost, audit, digest)]

    def repaired(held: list[tuple], marks: list[Row], audit: str) -> Iterator[tuple]:
        left, place = iter(held), 0
        for letter, role in played(g, audit, (i for i, _ in marks), 0):
            row = None if letter == INSERT else next(left)
            if letter != DELETE:
                yield place, letter, row and row[4], role or row[0], row[5] if row else ""
                place += 1

    def out(held: list[tuple]) -> list[tuple]:
        if not turns:
            return report(held)
        marks = _faults(r[:4] for r in held)
        return list(repaired(held, marks, cheapest(g, marks)[1]))

    def run(batches):
        made: list[tuple] = []
        size, kind = 0, None
        for kind, key, held in _runs(batches, columns):  # noqa: B007 - the type is the same for all
            got = out(held)
            made += [(key, *r) for r in got]
            size += sum(len(r[-1]) + 64 for r in got)
            if size >= 4 << 20:
                yield _batch(made, fields, kind)
                made, size = [], 0
        if made:
            yield _batch(made, fields, kind)

    by_conv = rows.repartition("conv").sortWithinPartitions("conv", *_ordered())
    return by_conv.select("conv", *columns).mapInArrow(run, schema)


def _batch(made: list[tuple], fields: list[tuple[str, str]], key: pa.DataType) -> pa.RecordBatch:
    types = [key] + [{"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[t] for _, t in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)], names=["conv", *(n for n, _ in fields)])


# --- conversations of any size ------------------------------------------------------------


def _codes(g: Grammar) -> dict[tuple[str, int], str]:
    """A letter for each (initial, fault)."""
    initials = ["-", *sorted({i for _, i in g.steps} | set("".join(g.pairs)))]
    return {(i, fault): chr(0x41 + 4 * k + fault) for k, i in enumerate(initials) for fault in range(4)}


def _chunks(placed: DataFrame, g: Grammar, chunk_bits: int) -> DataFrame:
    """conv, chunk, first place and the rows' codes as a string, of at most 2 ** chunk_bits rows that follow each other."""
    first = placed.groupBy("conv", "role", "digest").agg(F.min("pos").alias("first"), F.count("*").alias("__n")).where("__n > 1")
    a, b = placed.alias("a"), first.alias("b")
    same = F.col("a.conv").eqNullSafe(F.col("b.conv")) & (F.col("a.role") == F.col("b.role")) & (F.col("a.digest") == F.col("b.digest"))
    fault = F.when(F.col("a.fault") == BLANK, BLANK).when(F.col("a.pos") > F.col("b.first"), DUPLICATE).otherwise(F.col("a.fault"))
    letters = F.create_map(*[F.lit(x) for (i, fault), code in _codes(g).items() for x in (f"{i}{fault}", code)])
    coded = a.join(b, same, "left").select("a.conv", "a.pos", letters[F.concat("a.initial", fault.cast("string"))].alias("code"))
    chunk = F.shiftright("pos", chunk_bits).alias("chunk")
    # a conversation's rows follow each other within a task's places, so a chunk's places have no gap
    parts = coded.groupBy("conv", chunk).agg(F.min("pos").alias("start"), F.array_sort(F.collect_list(F.struct("pos", "code"))).alias("rows"))
    return parts.select("conv", "chunk", "start", F.array_join(F.col("rows.code"), "").alias("codes"))


def _by_row(df: DataFrame, row, fields: list[tuple[str, T.DataType, pa.DataType]]) -> DataFrame:
    """df with columns that ``row`` makes of each row, given as a mapping."""
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, t) for n, t, _ in fields)])

    def run(batches):
        for batch in batches:
            made = [row(r) for r in batch.drop_columns(["conv"]).to_pylist()]
            arrays = [pa.array(c, t) for c, (_, _, t) in zip(zip(*made, strict=True), fields, strict=True)] if made else [pa.array([], t) for _, _, t in fields]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=schema.names)

    return df.mapInArrow(run, schema)


_LONGS = (T.ArrayType(T.LongType()), pa.list_(pa.int64()))
_LISTS = (T.ArrayType(T.ArrayType(T.LongType())), pa.list_(pa.list_(pa.int64())))
_TEXTS = (T.ArrayType(T.StringType()), pa.list_(pa.string()))


def _large(rows: DataFrame, g: Grammar, chunk_bits: int) -> tuple[DataFrame, DataFrame]:
    """(reports without digests, per row its edits) of conversations cut into chunks."""
    n = g.n_states
    # equal rows are interchangeable, so any number tells them apart: a hot one is divided too
    spread = rows.withColumn("__copy", F.monotonically_increasing_id()).repartitionByRange(F.col("conv"), *_ordered(), F.col("__copy"))
    placed = store.written(spread.sortWithinPartitions("conv", *_ordered(), "__copy").drop("__copy").withColumn("pos", F.monotonically_increasing_id()), "turns")
    chunks = store.written(_chunks(placed, g, chunk_bits), "turn-chunks")
    back = {code: row for row, code in _codes(g).items()}

    def through(r) -> tuple:
        marks = [back[c] for c in r["codes"]]
        matrix = [forward(g, marks, [0 if p == q else FAR for p in range(n)])[-1] for q in range(n)]
        kinds = [fault for _, fault in marks]
        return ([x for line in matrix for x in line], [kinds.count(BLANK), kinds.count(DUPLICATE), kinds.count(TRUNCATED), illegal(g, [i for i, _ in marks])], marks[0][0], marks[-1][0])

    def chained(r) -> tuple:
        """Costs of entering and leaving each chunk, and the sums of the conversation."""
        parts = sorted(r["parts"], key=lambda p: p["chunk"])
        enter, leave = [[0] + [FAR] * (n - 1)], [the_end(g)]
        for p in parts[:-1]:
            enter.append([min(enter[-1][q] + p["matrix"][q * n + to] for q in range(n)) for to in range(n)])
        for p in reversed(parts):
            leave.append([min(leave[-1][to] + p["matrix"][q * n + to] for to in range(n)) for q in range(n)])
        leave = leave[::-1]
        sums = [sum(p["counts"][k] for p in parts) for k in range(4)]
        sums[3] += sum(a["last"] + b["first"] not in g.pairs for a, b in zip(parts, parts[1:], strict=False))
        return [p["chunk"] for p in parts], enter, leave[1:], [*sums, before_inserts(g, leave[0])[0], parts[-1]["chunk"]]

    wide = _by_row(chunks, through, [("matrix", *_LONGS), ("counts", *_LONGS), ("first", T.StringType(), pa.string()), ("last", T.StringType(), pa.string())])
    # a row of some twenty numbers a chunk: a conversation's rows over 2 ** chunk_bits
    gathered = wide.groupBy("conv").agg(F.collect_list(F.struct("chunk", "matrix", "counts", "first", "last")).alias("parts"))
    scanned = store.written(_by_row(gathered, chained, [("at", *_LONGS), ("enter", *_LISTS), ("leave", *_LISTS), ("sums", *_LONGS)]).drop("parts"), "turn-costs")
    each = scanned.select("conv", "sums", F.explode(F.arrays_zip("at", "enter", "leave")).alias("z")).select("conv", "sums", F.col("z.at").alias("chunk"), F.col("z.enter").alias("enter"), F.col("z.leave").alias("leave"))

    def walked(r) -> tuple:
        """Letters and the state behind the chunk, for every state in which a cheapest path may enter it."""
        marks = [back[c] for c in r["codes"]]
        total, last = r["sums"][4], r["sums"][5] == r["chunk"]
        f, b = forward(g, marks, r["enter"]), backward(g, marks, r["leave"])
        got = [walk(g, marks, f, b, total, q, last) if r["enter"][q] + b[0][q] == total else ("", -1) for q in range(n)]
        return [letters for letters, _ in got], [to for _, to in got]

    def entered(r) -> tuple:
        states, chunk_ids = [0], []
        for p in sorted(r["parts"], key=lambda p: p["chunk"]):
            chunk_ids.append(p["chunk"])
            states.append(p["to"][states[-1]])
        return chunk_ids, states[:-1]

    def on(left: DataFrame, right: DataFrame) -> DataFrame:
        a, b = left.alias("a"), right.alias("b")
        both = F.col("a.conv").eqNullSafe(F.col("b.conv")) & (F.col("a.chunk") == F.col("b.chunk"))
        return a.join(b, both).select("a.*", *[f"b.{c}" for c in right.columns if c not in ("conv", "chunk")])

    walks = store.written(_by_row(on(chunks, each), walked, [("audits", *_TEXTS), ("to", *_LONGS)]).drop("enter", "leave", "sums"), "turn-walks")
    states = _by_row(walks.groupBy("conv").agg(F.collect_list(F.struct("chunk", "to")).alias("parts")), entered, [("at", *_LONGS), ("state", *_LONGS)])
    picked = states.select("conv", F.explode(F.arrays_zip("at", "state")).alias("z")).select("conv", F.col("z.at").alias("chunk"), F.col("z.state").alias("state"))
    audits = on(walks, picked).select("conv", "chunk", "start", "codes", "state", F.element_at("audits", (F.col("state") + 1).cast("int")).alias("audit"))
    audits = store.written(audits, "turn-audits")

    whole = audits.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("chunk", "audit"))).alias("parts")).select(F.col("conv").alias("__conv"), F.array_join(F.col("parts.audit"), "").alias("audit"))
    known = placed.groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv").agg(F.max("turn").alias("hi"), F.min("turn").alias("lo"), F.count("turn").alias("n_turns"))
    gaps = known.select(F.col("conv").alias("__known"), F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("n_turns"), F.lit(0)).cast("long").alias("gaps"))
    sums = [F.col("sums")[k].alias(name) for k, name in enumerate(["blank", "duplicate", "truncated", "illegal", "cost"])]
    reports = scanned.join(whole, F.col("conv").eqNullSafe(F.col("__conv"))).join(gaps, F.col("conv").eqNullSafe(F.col("__known"))).select("conv", "gaps", *sums, "audit")

    def edits(r) -> tuple:
        """For each row of a chunk what it becomes: letters and roles of the rows inserted before it, of itself, and behind the chunk's last."""
        marks = [back[c][0] for c in r["codes"]]
        out: list[list[str]] = [[]]
        for letter, role in played(g, r["audit"], marks, r["state"]):
            out[-1].append(f"{letter}{role or ''}")
            if letter != INSERT:
                out.append([])
        tail = out.pop()
        out[-1] += tail
        return (out,)

    per_row = _by_row(audits, edits, [("edits", T.ArrayType(T.ArrayType(T.StringType())), pa.list_(pa.list_(pa.string())))])
    per_row = per_row.select("start", F.posexplode("edits").alias("i", "edits")).select((F.col("start") + F.col("i")).alias("__pos"), "edits")
    done = placed.join(per_row, F.col("pos") == F.col("__pos")).select("conv", "pos", "turn", "role", "text", F.posexplode("edits").alias("k", "made"))
    letter = F.substring("made", 1, 1)
    role = F.substring("made", 2, 1 << 20)
    done = done.where(letter != DELETE)
    turns = done.select(
        "conv", "pos", "k", letter.alias("edit"), F.when(letter != INSERT, F.col("turn")).alias("turn"), F.when(role == "", F.col("role")).otherwise(role).alias("role"), F.when(letter == INSERT, "").otherwise(F.col("text")).alias("text")
    )
    return reports, turns


def _digests(turns: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's repaired turns, in one pass over sorted rows that holds a batch at a time."""
    conv = turns.schema["conv"].dataType.simpleString()

    def run(batches):
        current = state = kind = None
        made: list[tuple] = []
        for batch in batches:
            kind = batch.column("conv").type
            for key, role, text in zip(batch.column("conv").to_pylist(), batch.column("role").to_pylist(), batch.column("text"), strict=True):
                if state is None or key != current:
                    if state is not None:
                        made.append((current, state.hexdigest()))
                    current, state = key, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:".encode())
                state.update(text.as_py().encode())
        if state is not None:
            made.append((current, state.hexdigest()))
            yield _batch(made, [("repaired_sha256", "string")], kind)

    rows = turns.repartition("conv").sortWithinPartitions("conv", "pos", "k").select("conv", "role", "text")
    return rows.mapInArrow(run, f"conv {conv}, repaired_sha256 string")


def _divided(df: DataFrame, g: Grammar, names: tuple[str, str, str, str], max_rows: int, max_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    """(rows of conversations that fit one call, rows of the others or None)."""
    rows = prepared(df, g, *names)
    sizes = rows.groupBy("conv").agg(F.count("*").alias("n"), F.sum(F.octet_length("text") + F.octet_length("role")).alias("bytes"))
    large = store.written(sizes.where((F.col("n") > max_rows) | (F.col("bytes") > max_bytes)).select(F.col("conv").alias("__large")), "large-conversations")
    if large.isEmpty():
        return rows, None
    at = F.col("conv").eqNullSafe(F.col("__large"))
    return rows.join(large, at, "left_anti"), rows.join(large, at, "left_semi")


def _limits(max_rows: int, max_bytes: int, chunk_bits: int) -> None:
    if max_rows < 1 or max_bytes < 1 or not 1 <= chunk_bits <= 20:
        raise ValueError("max_rows and max_bytes must be positive, chunk_bits 1 to 20")


def report(
    df: DataFrame, grammar: Grammar = CHAT, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", max_rows: int = 20_000, max_bytes: int = 16 << 20, chunk_bits: int = 15
) -> DataFrame:
    """Per conversation its gaps, faults, least cost, audit (edit letters) and the SHA-256 of its repaired ``role:text`` lines.

    ``max_rows`` and ``max_bytes`` bound what one call holds; results are the same whatever they are.
    """
    _limits(max_rows, max_bytes, chunk_bits)
    small, large = _divided(df, grammar, (conv, turn, role, text), max_rows, max_bytes)
    out = _small(small, grammar, turns=False)
    if large is not None:
        reports, turns = _large(large, grammar, chunk_bits)
        digests = _digests(turns).withColumnRenamed("conv", "__of")
        nothing = hashlib.sha256(b"").hexdigest()
        more = reports.join(digests, F.col("conv").eqNullSafe(F.col("__of")), "left").drop("__of").withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(nothing)))
        out = out.unionByName(more)
    return out.withColumnRenamed("conv", conv)


def repair(
    df: DataFrame, grammar: Grammar = CHAT, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", max_rows: int = 20_000, max_bytes: int = 16 << 20, chunk_bits: int = 15
) -> DataFrame:
    """The repaired turns: conversation, place (ascending within it), edit (K, R or I), the turn it was, role and text."""
    _limits(max_rows, max_bytes, chunk_bits)
    small, large = _divided(df, grammar, (conv, turn, role, text), max_rows, max_bytes)
    out = _small(small, grammar, turns=True)
    if large is not None:
        _, turns = _large(large, grammar, chunk_bits)
        # inserted rows stand beside a row that was there; a cheapest repair has fewer than 16 of them at one place
        place = F.col("pos") * 16 + F.col("k")
        out = out.unionByName(turns.select("conv", place.cast("long").alias("place"), "edit", "turn", "role", "text"))
    return out.withColumnRenamed("conv", conv)


# --- damage, for trials -------------------------------------------------------------------


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, turn, role, text after planted damage, drawn by the CRC-32 of ``conv:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 takes its sentence ends, 3 repeats it, 4 makes its role user; nulls are one space."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.pmod(F.crc32(F.concat(known(conv), F.lit(":"), known(turn))), F.lit(20))
    rows = df.select(F.col(conv), F.col(turn), known(role).alias(role), known(text).alias(text), draw.alias("__draw")).where("__draw <> 0")
    new_text = F.when(F.col("__draw") == 1, "").when(F.col("__draw") == 2, F.translate(text, ".!?", "")).otherwise(F.col(text))
    new_role = F.when(F.col("__draw") == 4, "user").otherwise(F.col(role))
    times = F.explode(F.when(F.col("__draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select(conv, turn, new_role.alias(role), new_text.alias(text), times.alias("__time")).drop("__time")


def audited(df: DataFrame, grammar: Grammar = CHAT, **limits: int) -> DataFrame:
    """The report of every conversation of df after damage; one that has no rows left has zeros, an empty audit and the empty text's digest."""
    found = report(damaged(df), grammar, **limits).withColumnRenamed("conv_id", "__conv")
    every = df.select("conv_id").distinct()
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("__conv")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))

"""Conversation structure repair by rank-convergence parallel Viterbi.

A conversation is legal when the initials of its roles read ``(s?(ua)+)?``. The cheapest
edits that make it so are a shortest path over four states (nothing yet, after the
system row, after a user, after an assistant). ``before`` and ``after`` are the
costs to the end from each state in front of and behind a chunk of rows:

1. Rows are range-partitioned by conversation and order and cut into pieces of at most
   ``PIECE_ROWS`` rows and about ``PIECE_BYTES`` of text. A conversation in one piece
   is solved at once; only the others go on.
2. Chunks of pieces start backwards from a speculative cost vector, that of the end.
   Fix-up passes rerun the chunks whose vector behind them was another one until
   all vectors differ from those used only by constants. Constants add up to the cost.
3. With the stitched backward costs each chunk is traced forwards from every state;
   passes pass on the state that the chunk before ends in. Of equally cheap edits the
   least letter in ASCII is taken at every place: the least audit.

Costs: Keep 0, Rerole to user or assistant 2, Delete 3 (the only edit of a blank or
duplicate row), Insert of an empty user or assistant row 2; a truncated row that stays adds 1.

A pass touches one small row per chunk. Chunks without a row that may stay hand any vector
on and are left out of the chain. Passes are as many as neighbouring
chunks fail to converge (a stretch of one role only), two as a rule.

Defined cases: null roles and texts are one space; rows of one turn are ordered by role,
then by the SHA-256 of the text; a role without initial s, u or a can't be kept; null
conversation ids are one conversation; rows marked ``gone`` only name their conversation; a
conversation without rows has zeros and empty texts; repeated rows are duplicates; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlens.llm.scratch import cut

START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = (USER, USER, ASSISTANT, USER)  # state after an inserted or reroled row
KEEPS = {
    (START, "s"): SYSTEM,
    (START, "u"): USER,
    (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT,
    (ASSISTANT, "u"): USER,
}
ROLES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = ("su", "ua", "au")
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
END = (0, 2 * INSERT, INSERT, 0)  # costs behind the last row
MUST_GO = "x"
SPACES = " \t\n\x0b\x0c\r"

PIECE_ROWS, PIECE_BYTES = 1024, 4 << 20
CHUNK_PIECES = 64


# -- one row of the path ------------------------------------------------------------
class Steps:
    """Costs and choices for each pair of a vector behind a row and the row's symbol:
    both come from a small set, so each pair is worked out once."""

    def __init__(self) -> None:
        self.known: dict[tuple[tuple, str], tuple[tuple, int, tuple]] = {}

    def __call__(self, after: tuple, symbol: str) -> tuple[tuple, int, tuple]:
        """Vector in front (least entry 0), the constant taken off, and per state the
        ``(edits, next state)``."""
        found = self.known.get((after, symbol))
        if found is None:
            found = self.known[after, symbol] = self._solve(after, symbol)
        return found

    @staticmethod
    def _solve(after: tuple, symbol: str) -> tuple[tuple, int, tuple]:
        def edits(s: int) -> list[tuple[str, int, int]]:
            """``edit, cost with what follows, next state`` in order of the audit's letters."""
            out = [("D", DELETE + after[s], s)]
            if symbol == MUST_GO:
                return out
            stays = TRUNCATED if symbol.isupper() else 0
            to = KEEPS.get((s, symbol.lower()))
            if to is not None:
                out.append(("K", stays + after[to], to))
            to = FOLLOWS[s]
            out.append(("R" + ROLES[to][0], REROLE + stays + after[to], to))
            return out

        least = [min(cost for _, cost, _ in edits(s)) for s in range(4)]
        once = [FOLLOWS[s] for s in range(4)]
        full = [
            min(least[s], INSERT + least[once[s]], 2 * INSERT + least[once[once[s]]]) for s in range(4)
        ]
        choices = []
        for s in range(4):
            inserted, at = "", s
            while True:
                here = {e[0][0]: e for e in edits(at) if e[1] == full[at]}
                if "D" in here or INSERT + full[once[at]] != full[at]:
                    break
                at = once[at]
                inserted += ROLES[at][0]
            edit, _, to = here[min(here)]
            choices.append((inserted + edit, to))
        base = min(full)
        return tuple(v - base for v in full), base, tuple(choices)


def backward(steps: Steps, symbols: str, after: tuple) -> tuple[tuple, int]:
    """Vector in front of all ``symbols`` and the sum of the constants."""
    total = 0
    for symbol in reversed(symbols):
        after, base, _ = steps(after, symbol)
        total += base
    return after, total


def forward(steps: Steps, symbols: str, after: tuple, starts=range(4)) -> list[tuple[list[str], int]]:
    """For each start state the edits of all rows and the state behind them."""
    choices = []
    for symbol in reversed(symbols):
        after, _, choice = steps(after, symbol)
        choices.append(choice)
    choices.reverse()
    out = []
    for at in starts:
        edits = []
        for choice in choices:
            edit, at = choice[at]
            edits.append(edit)
        out.append((edits, at))
    return out


def closing(state: int) -> str:
    """Roles inserted behind the last row."""
    return {START: "", SYSTEM: "ua", USER: "a", ASSISTANT: ""}[state]


def letters(edits: list[str]) -> str:
    """Audit letters of edits: inserted roles are I, a rerole's target is not shown."""
    return "".join("I" * (len(e) - (2 if e[-2:-1] == "R" else 1)) + e[-2 if e[-2:-1] == "R" else -1] for e in edits)


def lines(edits: list[str], roles: list[str], texts: list[str], close: str = "") -> list[str]:
    """Repaired rows as ``role:text``."""
    names = {name[0]: name for name in ROLES.values()}
    out = []
    for edit, role, text in zip(edits, roles, texts, strict=True):
        target = None
        if edit[-2:-1] == "R":
            edit, target = edit[:-1], names[edit[-1]]
        out += [f"{names[c]}:" for c in edit[:-1]]
        if edit[-1] != "D":
            out.append(f"{target or role}:{text}")
    return out + [f"{names[c]}:" for c in close]


# -- faults ----------------------------------------------------------------------
def plain_fault(text: str) -> str:
    end = text.rstrip(SPACES)[-1:]
    return "blank" if not end else "" if end in ".!?" else "truncated"


def symbol_of(role: str, fault: str) -> str:
    if fault in ("blank", "duplicate"):
        return MUST_GO
    c = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return c.upper() if fault == "truncated" else c


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))


ROW = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("digest", pa.string())])
SUMMARY = {
    "gaps": pa.int64(),
    "blank": pa.int64(),
    "duplicate": pa.int64(),
    "truncated": pa.int64(),
    "illegal": pa.int64(),
    "cost": pa.int64(),
    "audit": pa.string(),
    "repaired": pa.string(),
}
PIECE = pa.schema(
    [("piece", pa.int64()), ("whole", pa.bool_()), *SUMMARY.items(), ("faults", pa.list_(pa.string())), ("rows", pa.list_(ROW))]
)
PIECE_DDL = (
    "piece long, whole boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired string, faults array<string>, rows array<struct<turn:long,role:string,text:string,digest:string>>"
)


def solve(steps: Steps, rows: list[dict]) -> dict:
    """Summary of one conversation whose rows are all at hand."""
    seen, faults = set(), []
    for r in rows:
        fault = plain_fault(r["text"])
        key = (r["role"], r["text"])
        if fault != "blank" and key in seen:
            fault = "duplicate"
        seen.add(key)
        faults.append(fault)
    symbols = "".join(symbol_of(r["role"], f) for r, f in zip(rows, faults, strict=True))
    front, total = backward(steps, symbols, END)
    ((edits, state),) = forward(steps, symbols, END, [START])
    close = closing(state)
    turns = {r["turn"] for r in rows if r["turn"] is not None}
    made = lines(edits, [r["role"] for r in rows], [r["text"] for r in rows], close)
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        "blank": faults.count("blank"),
        "duplicate": faults.count("duplicate"),
        "truncated": faults.count("truncated"),
        "illegal": illegal_pairs([r["role"][:1] for r in rows]),
        "cost": total + front[START],
        "audit": letters(edits) + "I" * len(close),
        "repaired": "\n".join(made),
    }


def _id_field(df: DataFrame, col: str, name: str) -> pa.Field:
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    id_type = df.schema[col].dataType.simpleString()
    if id_type not in arrow:
        raise ValueError(f"conversation ids of type {id_type}: cast them to bigint, int or string")
    return pa.field(name, arrow[id_type])


# -- pieces ----------------------------------------------------------------------
def _pieces(id_field: pa.Field):
    """Reads a sorted partition; one row per piece. A conversation that neither touches an end of
    the partition nor fills more than one piece is whole, and solved."""
    schema = pa.schema([id_field, *PIECE])

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for key, gone, row in zip(*batch.columns, strict=True):
                yield key.as_py(), None if gone.as_py() else row.as_py()

    def pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """``key, rows, first of its conversation, last of it``."""
        key, rows, size, first, any_row = None, [], 0, True, False
        for k, row in rows_of(batches):
            if any_row and k != key:
                yield key, rows, first, True
                rows, size, first = [], 0, True
            elif len(rows) >= PIECE_ROWS or size >= PIECE_BYTES:
                yield key, rows, first, False
                rows, size, first = [], 0, False
            key, any_row = k, True
            if row is not None:
                rows.append(row)
                size += len(row["text"])
        if any_row:
            yield key, rows, first, True

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, number = Steps(), TaskContext.get().partitionId() << 33
        held, out, size, at_start = None, [], 0, True

        def made(piece: tuple, at_end: bool) -> dict:
            key, rows, first, last = piece
            whole = first and last and not at_start and not at_end
            row = {id_field.name: key, "piece": number, "whole": whole}
            if whole:
                return row | solve(steps, rows)
            return row | {"faults": [plain_fault(r["text"]) for r in rows], "rows": rows}

        for piece in pieces_of(batches):
            if held is not None:
                out.append(made(held, False))
                at_start = at_start and not held[3]
                number += 1
                size += sum(len(r["text"]) for r in held[1]) + 100
            held = piece
            if size > PIECE_BYTES:
                yield from pa.Table.from_pylist(out, schema).to_batches()
                out, size = [], 0
        if held is not None:
            # the whole of the partition's last conversation is at its end
            out.append(made(held, True))
        yield from pa.Table.from_pylist(out, schema).to_batches()

    return cut_up


def place(
    rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, gone_col: str | None
) -> DataFrame:
    """Written pieces: ``_conv`` and the columns of ``PIECE``."""
    text = F.coalesce(rows[text_col], F.lit(" "))
    gone = F.coalesce(rows[gone_col], F.lit(False)) if gone_col else F.lit(False)
    rows = rows.select(
        rows[conv_col].alias("_conv"),
        gone.alias("_gone"),
        rows[turn_col].cast("long").alias("turn"),
        F.coalesce(rows[role_col], F.lit(" ")).alias("role"),
        F.when(~gone, text).alias("text"),
        F.sha2(text, 256).alias("digest"),
        F.monotonically_increasing_id().alias("_tie"),  # spreads a row that is repeated very often
    )
    order = [F.col("_conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "digest", "_tie"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.select("_conv", "_gone", F.struct("turn", "role", "text", "digest").alias("row"))
    cut_up = _pieces(_id_field(rows, "_conv", "_conv"))
    id_type = rows.schema["_conv"].dataType.simpleString()
    return cut(rows.mapInArrow(cut_up, f"_conv {id_type}, {PIECE_DDL}"), "pieces")


# -- conversations of several pieces -----------------------------------------------------
def _mapped(df: DataFrame, fn, ddl: str, schema: pa.Schema) -> DataFrame:
    """``fn(row, steps)`` gives the rows for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = Steps()
        for batch in batches:
            for at in range(batch.num_rows):  # a row may hold a piece's texts
                out = list(fn(batch.slice(at, 1).to_pylist()[0], steps))
                yield from pa.Table.from_pylist(out, schema).to_batches()

    return df.mapInArrow(run, ddl)


def _symbols(pieces: DataFrame) -> DataFrame:
    """One small row per piece: its symbols, faults and what of illegal pairs it holds. A role and text
    is a duplicate where it is not at its least place, found by an aggregate."""
    each = pieces.select("_conv", "piece", F.posexplode("rows").alias("i", "r"))
    first = each.groupBy("_conv", F.col("r.role").alias("role"), F.col("r.digest").alias("digest"))
    first = first.agg(F.min(F.struct("piece", "i")).alias("p"))
    firsts = first.groupBy(F.col("p.piece").alias("_piece")).agg(F.collect_list("p.i").alias("firsts"))
    plain = pieces.select("_conv", "piece", F.transform("rows", lambda r: r["role"]).alias("roles"), "faults")
    rows = plain.join(firsts.hint("merge"), F.col("piece") == F.col("_piece"), "left").drop("_piece")

    def symbols(row: dict, steps: Steps) -> Iterator[dict]:
        firsts = set(row["firsts"] or ())
        faults = [f if f == "blank" or i in firsts else "duplicate" for i, f in enumerate(row["faults"])]
        initials = [r[:1] for r in row["roles"]]
        yield {
            "piece": row["piece"],
            "symbols": "".join(symbol_of(r, f) for r, f in zip(row["roles"], faults, strict=True)),
            **{k: faults.count(k) for k in ("blank", "duplicate", "truncated")},
            "inner": illegal_pairs(initials),
            "first": initials[0] if initials else None,
            "last": initials[-1] if initials else None,
        }

    schema = pa.schema(
        [("piece", pa.int64()), ("symbols", pa.string())]
        + [(k, pa.int64()) for k in ("blank", "duplicate", "truncated", "inner")]
        + [("first", pa.string()), ("last", pa.string())]
    )
    ddl = "piece long, symbols string, blank long, duplicate long, truncated long, inner long, first string, last string"
    marked = _mapped(rows.drop("_conv"), symbols, ddl, schema)
    keys = pieces.select("_conv", F.col("piece").alias("_piece"))
    return cut(marked.join(keys.hint("merge"), F.col("piece") == F.col("_piece")).drop("_piece"), "symbols")


VECTOR = pa.list_(pa.int64())


def _links(chunks: DataFrame) -> DataFrame:
    order = Window.partitionBy("_conv").orderBy("chunk")
    keys = chunks.select("_conv", "chunk")
    return keys.select(
        F.col("chunk").alias("_chunk"), F.lead("chunk").over(order).alias("next"), F.lag("chunk").over(order).alias("previous")
    )


def _backward_passes(chunks: DataFrame) -> tuple[DataFrame, int]:
    """``chunk, next, previous, symbols, after, before, added`` with vectors that agree from chunk to
    chunk, and the number of passes."""
    schema = pa.schema(
        [("chunk", pa.int64()), ("next", pa.int64()), ("previous", pa.int64()), ("symbols", pa.string())]
        + [("after", VECTOR), ("before", VECTOR), ("added", pa.int64())]
    )
    ddl = "chunk long, next long, previous long, symbols string, after array<long>, before array<long>, added long"

    def run(row: dict, steps: Steps) -> Iterator[dict]:
        before, added = backward(steps, row["symbols"], tuple(row["after"]))
        yield {**{k: row[k] for k in ("chunk", "next", "previous", "symbols", "after")}, "before": before, "added": added}

    guess = chunks.withColumn("after", F.array(*(F.lit(v).cast("long") for v in END)))
    state = cut(_mapped(guess, run, ddl, schema), "costs")
    passes = 1
    while True:
        behind = state.select(F.col("chunk").alias("_next"), F.col("before").alias("wanted"))
        joined = state.join(behind.hint("merge"), F.col("next") == F.col("_next"), "left").drop("_next")
        wrong = F.col("wanted").isNotNull() & (F.col("wanted") != F.col("after"))
        if not joined.filter(wrong).limit(1).count():
            return state, passes
        again = joined.filter(wrong).withColumn("after", F.col("wanted")).select(*guess.columns)
        fixed = _mapped(again, run, ddl, schema)
        state = cut(joined.filter(~wrong).select(*state.columns).unionByName(fixed), "costs")
        passes += 1


def _forward_passes(costs: DataFrame) -> DataFrame:
    """``chunk, state``: the state in front of every chunk."""
    schema = pa.schema([("chunk", pa.int64()), ("previous", pa.int64()), ("ends", VECTOR)])

    def run(row: dict, steps: Steps) -> Iterator[dict]:
        ends = [to for _, to in forward(steps, row["symbols"], tuple(row["after"]))]
        yield {"chunk": row["chunk"], "previous": row["previous"], "ends": ends}

    ends = _mapped(costs, run, "chunk long, previous long, ends array<long>", schema)
    state = cut(ends.withColumn("state", F.lit(START).cast("long")), "states")
    while True:
        ahead = state.select(F.col("chunk").alias("_previous"), F.get("ends", F.col("state").cast("int")).alias("wanted"))
        joined = state.join(ahead.hint("merge"), F.col("previous") == F.col("_previous"), "left")
        now = F.coalesce("wanted", "state")
        if not joined.filter(now != F.col("state")).limit(1).count():
            return state.select("chunk", "state")
        state = cut(joined.withColumn("state", now).select("chunk", "previous", "ends", "state"), "states")


def _edits(costs: DataFrame, states: DataFrame) -> DataFrame:
    """``_chunk, edits, close``: edits of all rows of a chunk, and the roles that close the conversation."""

    def run(row: dict, steps: Steps) -> Iterator[dict]:
        ((edits, end),) = forward(steps, row["symbols"], tuple(row["after"]), [row["state"]])
        yield {"_chunk": row["chunk"], "edits": edits, "close": closing(end) if row["next"] is None else ""}

    schema = pa.schema([("_chunk", pa.int64()), ("edits", pa.list_(pa.string())), ("close", pa.string())])
    known = costs.select("chunk", "next", "symbols", "after").join(states.hint("merge"), "chunk")
    return _mapped(known, run, "_chunk long, edits array<string>, close string", schema)


class Repair(NamedTuple):
    """``conversations``: one row each, ``repaired`` null where the text is in ``pieces``;
    ``pieces``: ``conv, piece, repaired`` of the conversations of several pieces, null where no row is left."""

    conversations: DataFrame
    pieces: DataFrame


def _long_conversations(parts: DataFrame, conv_col: str) -> Repair:
    marked = _symbols(parts)
    # chunks of neighbouring pieces of one partition
    number = F.floor(F.col("piece").bitwiseAND((1 << 33) - 1) / CHUNK_PIECES)
    span = F.struct(F.shiftright("piece", 33), number)
    chunks = marked.groupBy("_conv", span.alias("span")).agg(
        F.min("piece").alias("chunk"), F.sort_array(F.collect_list(F.struct("piece", "symbols"))).alias("of")
    )
    joined = F.array_join(F.transform("of", lambda p: p["symbols"]), "")
    chunks = cut(chunks.drop("span").withColumn("symbols", joined), "chunks")
    # without a row that may stay a chunk hands any vector on
    live = chunks.filter(F.rlike("symbols", F.lit(f"[^{MUST_GO}]")))
    live = live.join(_links(live).hint("merge"), F.col("chunk") == F.col("_chunk"))
    costs, _ = _backward_passes(live.select("chunk", "next", "previous", "symbols"))
    edits = _edits(costs, _forward_passes(costs))
    solved = chunks.join(edits.hint("merge"), F.col("chunk") == F.col("_chunk"), "left")

    def per_piece(row: dict, steps: Steps) -> Iterator[dict]:
        edits = row["edits"] or ["D"] * len(row["symbols"])
        at = 0
        for p in row["of"]:
            to = at + len(p["symbols"])
            close = row["close"] or "" if p is row["of"][-1] else ""
            yield {"_piece": p["piece"], "edits": edits[at:to], "close": close, "audit": letters(edits[at:to])}
            at = to

    schema = pa.schema(
        [("_piece", pa.int64()), ("edits", pa.list_(pa.string())), ("close", pa.string()), ("audit", pa.string())]
    )
    ddl = "_piece long, edits array<string>, close string, audit string"
    edits = cut(_mapped(solved, per_piece, ddl, schema), "edits")

    def mended(row: dict, steps: Steps) -> Iterator[dict]:
        rows = row["rows"]
        made = lines(row["edits"], [r["role"] for r in rows], [r["text"] for r in rows], row["close"])
        yield {conv_col: row["_conv"], "piece": row["piece"], "repaired": "\n".join(made) if made else None}

    texts = parts.join(edits.drop("audit").hint("merge"), F.col("piece") == F.col("_piece"))
    key = _id_field(parts, "_conv", conv_col)
    made_schema = pa.schema([key, ("piece", pa.int64()), ("repaired", pa.string())])
    made_ddl = f"`{conv_col}` {parts.schema['_conv'].dataType.simpleString()}, piece long, repaired string"
    made = _mapped(texts.select("_conv", "piece", "rows", "edits", "close"), mended, made_ddl, made_schema)
    summary = _long_summary(parts, marked, chunks, costs, edits)
    return Repair(summary.select(F.col("_conv").alias(conv_col), *SUMMARY), cut(made, "repaired"))


def _long_summary(
    parts: DataFrame, marked: DataFrame, chunks: DataFrame, costs: DataFrame, edits: DataFrame
) -> DataFrame:
    """The columns of ``SUMMARY`` of conversations of several pieces, from one row per piece."""
    order = Window.partitionBy("_conv").orderBy("piece")
    cross = F.concat("last", F.lead("first").over(order))
    pairs = marked.filter(F.col("first").isNotNull())
    pairs = pairs.withColumn("illegal", F.col("inner") + F.coalesce((~cross.isin(*LEGAL)).cast("long"), F.lit(0)))
    pairs = pairs.groupBy("_conv").agg(F.sum("illegal").alias("illegal"))

    path = costs.select(F.col("chunk").alias("_chunk"), "added", "before", "previous")
    path = chunks.join(path.hint("merge"), F.col("chunk") == F.col("_chunk"), "left")
    start = F.when(F.col("previous").isNull(), F.get("before", F.lit(START))).otherwise(0)
    of_chunk = F.coalesce(F.col("added") + start, DELETE * F.length("symbols"))
    path = path.groupBy("_conv").agg(F.sum(of_chunk).alias("cost"))

    rows = marked.join(edits.select("_piece", "audit", "close").hint("merge"), F.col("piece") == F.col("_piece"))
    letters_of = F.transform(F.sort_array(F.collect_list(F.struct("piece", "audit"))), lambda p: p["audit"])
    total = rows.groupBy("_conv").agg(
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")),
        # deletions behind the last row that stays come before the inserts that close: D is less than I
        F.concat(F.array_join(letters_of, ""), F.repeat(F.lit("I"), F.max(F.length("close")))).alias("audit"),
    )
    turns = parts.select("_conv", F.explode("rows.turn").alias("turn")).filter("turn IS NOT NULL").distinct()
    turns = turns.groupBy("_conv").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
    for extra in (pairs, path, turns):
        extra = extra.withColumnRenamed("_conv", "_other").hint("merge")
        total = total.join(extra, F.col("_conv").eqNullSafe(F.col("_other")), "left").drop("_other")
    zero = [c for c in SUMMARY if c not in ("audit", "repaired")]
    return total.fillna(0, zero).withColumn("repaired", F.lit(None).cast("string"))


# -- the operator ------------------------------------------------------------------
def repair(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    gone_col: str | None = None,
) -> Repair:
    """Cheapest repair of every conversation of ``rows``; see the module."""
    pieces = place(rows, conv_col, turn_col, role_col, text_col, gone_col)
    whole = pieces.filter("whole").select(F.col("_conv").alias(conv_col), *SUMMARY)
    parts = pieces.filter("not whole").select("_conv", "piece", "faults", "rows")
    rest = _long_conversations(parts, conv_col)
    return Repair(whole.unionByName(rest.conversations), rest.pieces)


def text_digests(pieces: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """``conv_col, sha256`` of the repaired text of conversations of several pieces, read in order
    as a stream: a task holds one piece at a time, however long the conversation."""
    key = _id_field(pieces, conv_col, conv_col)
    schema = pa.schema([key, ("sha256", pa.string())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, any_row, begun = None, hashlib.sha256(), False, False

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{conv_col: now, "sha256": digest.hexdigest()}], schema)

        for batch in batches:
            for conv, text in zip(*batch.columns, strict=True):
                conv, text = conv.as_py(), text.as_py()
                if any_row and conv != now:
                    yield row()
                    digest, begun = hashlib.sha256(), False
                now, any_row = conv, True
                if text is not None:
                    digest.update((("\n" if begun else "") + text).encode())
                    begun = True
        if any_row:
            yield row()

    rows = pieces.repartition(conv_col).sortWithinPartitions(conv_col, "piece").select(conv_col, "repaired")
    return rows.mapInArrow(hashed, f"`{conv_col}` {pieces.schema[conv_col].dataType.simpleString()}, sha256 string")


def damage(conversations: DataFrame) -> DataFrame:
    """Rows as the contract damages them, by the CRC-32 of ``conv_id:turn``: dropped rows are marked in
    ``_gone``, nulls are one space."""

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    case = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), case.alias("case"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("case") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("case") == 1, F.lit(""))
        .when(F.col("case") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        (F.col("case") == 0).alias("_gone"),
        F.explode(F.when(F.col("case") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")

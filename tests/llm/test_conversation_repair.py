"""Conversation repair against brute force: all audits by a table over suffixes, faults and
digests by a plain reading of the contract; chunked solutions against whole ones."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from cardlens.llm import conversation_repair as repair
from cardlens.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def best_edits(roles, faults):
    """Least ``(cost, audit, repaired rows)`` by recursion over suffixes."""
    n = len(roles)

    def accepts(state, initial):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, initial))

    @lru_cache(maxsize=None)
    def tail(i, state, inserted):
        found = []
        if i == n and state in ("", "a"):
            found.append((0, "", ()))
        if inserted < 3:
            for role in ("user", "assistant"):
                to = accepts(state, role[0])
                if to and (rest := tail(i, to, inserted + 1)):
                    found.append((2 + rest[0], "I" + rest[1], ((role, None), *rest[2])))
        if i < n:
            if rest := tail(i + 1, state, 0):
                found.append((3 + rest[0], "D" + rest[1], rest[2]))
            if faults[i] not in ("blank", "duplicate"):
                more = faults[i] == "truncated"
                choices = [(0, "K", roles[i])] + [(2, "R", r) for r in ("user", "assistant")]
                for cost, letter, role in choices:
                    to = accepts(state, role[:1])
                    if to and (rest := tail(i + 1, to, 0)):
                        found.append((cost + more + rest[0], letter + rest[1], ((role, i), *rest[2])))
        return min(found, default=None)

    for i in range(n, 0, -1):  # fills the table from the end, so that recursion stays flat
        for state in ("", "s", "u", "a"):
            tail(i, state, 0)
    return tail(0, "", 0)


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        if not re.search(r"[^\x20\x09-\x0D]", text):
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        else:
            fault = "" if re.findall(r"[^\x20\x09-\x0D]", text)[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append(fault)
    return out


def damaged(rows):
    """``conv -> rows`` after the contract's damage, rows of a turn by role and text digest."""
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        h = zlib.crc32(key.encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        role = "user" if h == 4 else role
        mine += [(turn, role, text)] * (2 if h == 3 else 1)

    def order(r):
        return (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest())

    return {c: sorted(v, key=order) for c, v in out.items()}


def contract(rows):
    out = []
    for conv, mine in damaged(rows).items():
        turns = [t for t, *_ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        plain = [(r, t) for _, r, t in mine]
        faults = faults_of(plain)
        initials = [r[:1] for r, _ in plain]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit, kept = best_edits(tuple(r for r, _ in plain), tuple(faults))
        text = "\n".join(f"{role}:{'' if i is None else plain[i][1]}" for role, i in kept)
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out.append((str(conv), gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out)


def made(rnd, convs, longest):
    texts = ["yes.", "no!", "why?", "well", "so, ", "", " \t", "end. \n", "é. ", "a.b", None, "x" * 50 + "."]
    roles = ["user", "assistant", "system", "tool", "", "User", None]
    rows = []
    for c in [*range(convs), None]:
        n = rnd.randint(1, longest)
        odd = rnd.random() < 0.4
        for t in range(n):
            turn = t if rnd.random() < 0.9 else rnd.choice([None, t + 2])
            role = rnd.choice(roles) if odd else ("user", "assistant")[t % 2]
            text = rnd.choice(texts) if rnd.random() < 0.5 else f"row {rnd.randint(0, 99)}{rnd.choice('.!? ')}"
            rows.append((c, turn, role, text))
    return rows + rows[3:6]


def result(spark, rows, tmp_path, monkeypatch=None):
    schema = "conv_id long, turn long, role string, text string, piece string, audit string"
    data = [(*r, "p", "a") for r in rows]
    path = str(tmp_path / f"t{len(data)}")
    spark.createDataFrame(data, schema).repartition(3).write.mode("overwrite").parquet(f"{path}/conversations.parquet")
    out = QUERIES["op12_conversation_repair"](spark, path).collect()
    return sorted((str(r.conv_id), *(r[c] for c in NAMES)) for r in out)


def test_paths_by_brute_force():
    rnd = random.Random(1)
    steps = repair.Steps()
    for _ in range(1500):
        n = rnd.randint(0, 7)
        roles = [rnd.choice(["user", "assistant", "system", "tool"]) for _ in range(n)]
        faults = [rnd.choice(["", "", "", "truncated", "blank"]) for _ in range(n)]
        symbols = "".join(repair.symbol_of(r, f) for r, f in zip(roles, faults, strict=True))
        front, total = repair.backward(steps, symbols, repair.END)
        ((edits, end),) = repair.forward(steps, symbols, repair.END, [repair.START])
        audit = repair.letters(edits) + "I" * len(repair.closing(end))
        texts = [f"t{i}" for i in range(n)]
        cost, want, kept = best_edits(tuple(roles), tuple(faults))
        assert (total + front[repair.START], audit) == (cost, want), (roles, faults)
        lines = repair.lines(edits, roles, texts, repair.closing(end))
        assert lines == [f"{r}:{'' if i is None else texts[i]}" for r, i in kept]


def test_awkward_conversations(spark, tmp_path):
    rows = made(random.Random(2), 60, 9)
    assert result(spark, rows, tmp_path) == contract(rows)


def test_conversations_of_many_pieces(spark, tmp_path, monkeypatch):
    """Pieces of three rows and chunks of two pieces: the same results, through the passes."""
    monkeypatch.setattr(repair, "PIECE_ROWS", 3)
    monkeypatch.setattr(repair, "CHUNK_PIECES", 2)
    rows = made(random.Random(3), 12, 60)
    rows += [(77, t, "user", f"only users {t}.") for t in range(40)]  # parity passes through every chunk
    rows += [(78, t, "user", "the same.") for t in range(60)]  # all but one go
    rows += [(79, t, "assistant", " ") for t in range(40)]  # nothing stays
    rows += [(80, 1, "user", "hot.")] * 300
    assert result(spark, rows, tmp_path) == contract(rows)


def test_passes_are_few_where_vectors_converge(spark, monkeypatch):
    monkeypatch.setattr(repair, "END", (0, 4, 2, 0))
    talk = "sua" + "ua" * 200
    chunks = [(i, i + 1 if i < 9 else None, i - 1 if i else None, talk) for i in range(10)]
    frame = spark.createDataFrame(chunks, "chunk long, next long, previous long, symbols string")
    _, passes = repair._backward_passes(frame)
    assert passes <= 2


def test_empty_table_and_long_text(spark, tmp_path):
    assert result(spark, [], tmp_path) == []
    rows = [(1, 1, "user", "long " * 300_000 + "."), (1, 2, "assistant", "ok.")]
    assert result(spark, rows, tmp_path) == contract(rows)


def test_string_ids_and_other_types(spark):
    frame = spark.createDataFrame([("a", 1, "assistant", "x.")], "k string, t int, r string, b string")
    found = repair.repair(frame, "k", "t", "r", "b")
    row = found.conversations.first()
    assert (row.k, row.cost, row.audit) == ("a", 2, "IK")
    with pytest.raises(ValueError, match="cast"):
        repair.repair(frame.selectExpr("cast(1 as double) k", "t", "r", "b"), "k", "t", "r", "b")


def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()]
    out = QUERIES["op12_conversation_repair"](spark, SMALL).collect()
    assert sorted((str(r.conv_id), *(r[c] for c in NAMES)) for r in out) == contract(rows)

"""Repairs against exhaustive search and a plain whole-conversation program."""

import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

from strata.llm import conversation_repair as C
from strata.llm.conversation_repair import RepairParams, damage, repair_edits, repair_reports

GRAMMAR = re.compile(r"(s?(ua)+)?")


def faults_of(rows):
    seen, found = set(), []
    for role, text in rows:
        stripped = text.rstrip(" \t\n\v\f\r")
        found.append(C.BLANK if not stripped else C.REPEATED if (role, text) in seen else C.CUT if stripped[-1] not in ".!?" else C.SOUND)
        seen.add((role, text))
    return found


def exhaustive(initials, faults):
    """Every edit sequence with up to two rows put in anywhere."""
    inserts = [x for n in range(3) for x in itertools.product("ua", repeat=n)]
    best = None
    for choice in itertools.product("KUAD", repeat=len(initials)):
        if any(f >= C.REPEATED and c != "D" for c, f in zip(choice, faults)):
            continue
        for put in itertools.product(inserts, repeat=len(initials) + 1):
            roles, audit, cost = "", "", 0
            for i, c in enumerate(choice):
                roles, audit, cost = roles + "".join(put[i]), audit + "I" * len(put[i]), cost + 2 * len(put[i])
                roles += initials[i] if c == "K" else {"U": "u", "A": "a", "D": ""}[c]
                audit += {"K": "K", "U": "R", "A": "R", "D": "D"}[c]
                cost += {"K": 0, "U": 2, "A": 2, "D": 3}[c] + (faults[i] == C.CUT and c != "D")
            roles, audit, cost = roles + "".join(put[-1]), audit + "I" * len(put[-1]), cost + 2 * len(put[-1])
            if GRAMMAR.fullmatch(roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def plain(rows):
    """Cost, audit and repaired rows by recursion over (row, state) with whole strings."""
    faults = faults_of(rows)
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    turn = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    @lru_cache(None)
    def best(i, state, put):
        options = []
        if i == len(rows) and state in ("", "a"):
            options.append((0, "", ()))
        if put < 2:
            cost, audit, out = best(i, turn[state], put + 1)
            options.append((cost + 2, "I" + audit, ((names[turn[state]], ""), *out)))
        if i < len(rows):
            role, text = rows[i]
            cost, audit, out = best(i + 1, state, 0)
            options.append((cost + 3, "D" + audit, out))
            if faults[i] < C.REPEATED:
                cut = faults[i] == C.CUT
                cost, audit, out = best(i + 1, turn[state], 0)
                options.append((cost + 2 + cut, "R" + audit, ((names[turn[state]], text), *out)))
                if role[:1] in after[state]:
                    cost, audit, out = best(i + 1, after[state][role[:1]], 0)
                    options.append((cost + cut, "K" + audit, ((role, text), *out)))
        return min(options, default=(10 ** 9, "", ()))

    return best(0, "", 0)


def report(conv_id, rows):
    """The contract's columns for (turn, role, text) rows in order."""
    faults = faults_of([r[1:] for r in rows])
    turns = [t for t, _, _ in rows if t is not None]
    cost, audit, out = plain([r[1:] for r in rows])
    initials = [r[1][:1] for r in rows]
    return (conv_id, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count(C.BLANK), faults.count(C.REPEATED),
            faults.count(C.CUT), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def damaged(table):
    out = []
    for conv_id, turn, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv_id, turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def expected(table):
    groups = {row[0]: [] for row in table}
    for conv_id, *row in damaged(table):
        groups[conv_id].append(tuple(row))
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2].encode())
    return sorted((report(c, sorted(rows, key=order)) for c, rows in groups.items()), key=str)


def random_rows(rng, n):
    texts = ["Yes.", "Yes.", "no", "What?", "  ", "", "a. \t", "b.c", "é!", "."]
    return [(rng.choice(("user", "assistant", "system", "user", "assistant", "tool", "")), rng.choice(texts)) for _ in range(n)]


def solve(rows):
    faults = faults_of(rows)
    walk = C._Walk(0)
    list(walk.step({"roles": [r for r, _ in rows], "texts": [t for _, t in rows], "copies": [1] * len(rows), "faults": faults,
                    "min_turn": None, "max_turn": None, "turns": 0}) if rows else ())
    list(walk.finish())
    return walk.cost, "".join(walk.audit), walk.hash.hexdigest()


def test_against_exhaustive_search():
    rng = random.Random(0)
    for n in (0, 1, 1, 2, 2, 2, 2, 2, 2, 3, 3, 3):
        rows = random_rows(rng, n)
        # A role without an initial fits nowhere.
        assert solve(rows)[:2] == exhaustive([r[:1] or "?" for r, _ in rows], faults_of(rows)), rows


def test_checkpoints_against_whole_recursion():
    rng = random.Random(1)
    for _ in range(400):
        rows = random_rows(rng, rng.randint(0, 40))
        cost, audit, out = plain(rows)
        assert solve(rows) == (cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()), rows


def test_matrices_carry_vectors_across_blocks():
    rng = random.Random(2)
    for _ in range(100):
        n = rng.randint(1, 30)
        entries = [(rng.choice("suat"), rng.choice((0, 0, 1, 2, 3)), rng.choice((1, 1, 1, 4))) for _ in range(n)]
        vector = C.AT_END
        for entry in reversed(entries):
            vector = C.back(*entry, vector)
        cut = rng.randint(0, n)
        after = C.through(C.block_matrix(*map(list, zip(*entries[cut:]))), C.AT_END) if cut < n else C.AT_END
        assert (C.through(C.block_matrix(*map(list, zip(*entries[:cut]))), after) if cut else after) == vector


def table_of(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_reports_against_plain(spark):
    rng = random.Random(3)
    table = []
    for conv in range(150):
        for turn, (role, text) in enumerate(random_rows(rng, rng.randint(1, 12))):
            table.append((conv, None if rng.random() < 0.03 else turn * rng.choice((1, 1, 2)), None if rng.random() < 0.03 else role,
                          None if rng.random() < 0.03 else text))
    table += [(None, 0, "user", "Hi."), (None, 1, "assistant", "Ho."), (999, None, None, None)] + table[:7] + table[:2]
    dropped = next(i for i in range(1000, 9999) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    table.append((dropped, 0, "user", "All rows go."))
    frame = table_of(spark, table).repartition(4)
    want = expected(table)
    assert got(repair_reports(damage(frame), frame)) == want
    assert (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) in want
    assert got(repair_reports(damage(frame), frame, RepairParams(block_rows=2))) == want
    assert got(repair_reports(damage(frame), frame, RepairParams(block_chars=3))) == want


def test_edits_say_the_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "So?"), (1, 2, "assistant", "cut"), (1, 3, "system", " "), (2, 5, "assistant", "x" * 50_000 + ".")]
    frame = repair_edits(table_of(spark, rows).selectExpr("*", "turn AS place", "1 AS copies", "2 AS fault", "3 AS part"))
    assert frame.columns == ["conv_id", "place", "edit", "role", "text"]
    found = {c: [r for r in got(frame) if r[0] == c] for c in (1, 2)}
    for conv in (1, 2):
        cost, audit, out = plain([r[2:] for r in rows if r[0] == conv])
        edits = sorted(found[conv], key=lambda r: r[1])
        assert "".join(r[2] for r in edits) == audit and [(r[3], r[4]) for r in edits if r[2] != "D"] == list(out)


def test_one_conversation_spans_blocks_and_tasks(spark):
    rng = random.Random(7)
    rows = [(5, t, *r) for t, r in enumerate(((rng.choice(("user", "assistant")), f"{rng.choice('ab')}{t}{rng.choice(('', '.'))}") for t in range(600)))]
    rows += [(5, 700 + i % 3, "user", "The same.") for i in range(300)] + [(c, 0, "user", "Hi.") for c in range(100, 130)]
    frame = table_of(spark, rows)
    blocks = C._blocks(C.find_faults(frame), RepairParams(block_rows=50))
    assert max(len(r.roles) for r in blocks.collect()) <= 50
    order = lambda r: (r[1], r[2], r[3])
    import sys
    sys.setrecursionlimit(100_000)
    want = sorted((report(c, [r[1:] for r in sorted((r for r in rows if r[0] == c), key=order)]) for c in {r[0] for r in rows}), key=str)
    assert got(repair_reports(frame, None, RepairParams(block_rows=50))) == want


def test_empty_table(spark):
    empty = table_of(spark, [])
    assert got(repair_reports(damage(empty), empty)) == [] and got(repair_edits(empty)) == []

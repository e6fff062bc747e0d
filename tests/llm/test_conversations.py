"""Conversation repair against a plain version: cheapest edits by exhaustive relaxation, hashes over joined lines."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from hirewave.llm import conversations as cv

SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(rows, goals=(0, 3), entry=0):
    """(cost, audit) by Dijkstra over (cost, audit, place, state); rows are (initial, fault)."""
    queue, done = [(0, "", 0, entry)], set()
    while queue:
        cost, audit, at, state = heapq.heappop(queue)
        if at == len(rows) and state in goals:
            return cost, audit
        if (at, state) in done:
            continue
        done.add((at, state))
        wanted = {0: "u", 1: "u", 2: "a", 3: "u"}[state]
        after = {"u": 2, "a": 3, "s": 1}
        heapq.heappush(queue, (cost + 2, audit + "I", at, after[wanted]))
        if at < len(rows):
            role, fault = rows[at]
            heapq.heappush(queue, (cost + 3, audit + "D", at + 1, state))
            if fault not in "bd":
                more = int(fault == "t")
                if role == wanted or (role == "s" and state == 0):
                    heapq.heappush(queue, (cost + more, audit + "K", at + 1, after[role]))
                heapq.heappush(queue, (cost + 2 + more, audit + "R", at + 1, after[wanted]))
    return None


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        if kind:
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def plain(given, damaged=damage):
    """conv -> (gaps, blank, duplicate, truncated, illegal, cost, audit, hash)."""
    found = {}
    for conv in {r[0] for r in given}:
        rows = sorted((r[1:] for r in damaged([g for g in given if g[0] == conv])), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in rows:
            core = text.rstrip(" \t\n\v\f\r")
            faults.append("b" if not core.lstrip(" \t\n\v\f\r") else "d" if (role, text) in seen else " " if core[-1] in ".!?" else "t")
            seen.add((role, text))
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit = cheapest([(r[1][:1] if r[1][:1] in ("s", "u", "a") else "?", f) for r, f in zip(rows, faults)])
        kept, state, at = [], 0, 0
        for letter in audit:
            wanted = "a" if state == 2 else "u"
            role = {"u": "user", "a": "assistant"}[wanted] if letter in "IR" else rows[at][1]
            if letter != "D":
                kept.append(f"{role}:{'' if letter == 'I' else rows[at][2]}")
                state = {"u": 2, "a": 3, "s": 1}[role[0]]
            at += letter != "I"
        found[conv] = (gaps, *(faults.count(f) for f in "bdt"), illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return found


def made_up(seed, sizes, first=0):
    r = random.Random(seed)
    texts = ["Yes.", "No!", "why?", "open end", "", " \n", "Yes. ", "é.", "\xa0", "é", "Long " * 50 + ".", None]
    rows = []
    for c, n in enumerate(sizes, first):
        for t in range(n):
            role = r.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "User"]) if r.random() < 0.5 else ["user", "assistant"][t % 2]
            rows.append((c, r.choice([t, t, t, t + r.randint(0, 3), None]), role, r.choice(texts) if r.random() < 0.4 else f"text {r.random()}."))
    return rows


def result(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def as_query(spark, rows, monkeypatch):
    monkeypatch.setattr(cv, "table", lambda *_: spark.createDataFrame(rows, SCHEMA).repartition(4))
    return cv.query(spark, "")


def test_search_finds_the_cheapest_and_least_edits():
    r = random.Random(1)
    for _ in range(4000):
        rows = [(r.choice("uuaas?"), r.choice("    tbd")) for _ in range(r.randint(0, 9))]
        code = [a + b for a, b in rows]
        assert cv.Search(code, cv.ACCEPT).best(0) == cheapest(rows)
        entry, goal = r.randrange(4), r.randrange(4)
        assert cv.Search(code, (goal,)).best(entry) == cheapest(rows, (goal,), entry) if cv.Search(code, (goal,)).reachable(entry) else True


def test_the_table_of_failed_states_serves_all_entries():
    r = random.Random(5)
    for _ in range(500):
        rows = [(r.choice("uas?"), r.choice("  tbd")) for _ in range(r.randint(1, 12))]
        search = cv.Search([a + b for a, b in rows], (3,))
        for entry in (2, 0, 3, 1):
            assert search.best(entry) == cheapest(rows, (3,), entry)


def test_the_bound_never_exceeds_the_cost():
    r = random.Random(8)
    for _ in range(3000):
        rows = [(r.choice("uuaas?"), r.choice("   tbd")) for _ in range(r.randint(0, 8))]
        assert cv.bounds([a + b for a, b in rows])[0] <= min(cheapest(rows, (0, 3), e)[0] for e in range(1, 4) if cheapest(rows, (0, 3), e))


def test_pieces_put_together_equal_the_whole():
    r = random.Random(3)
    for _ in range(400):
        rows = [(r.choice("uuaas?"), r.choice("    tbd")) for _ in range(r.randint(1, 30))]
        cuts = sorted({0, len(rows), *(r.randrange(1, len(rows) + 1) for _ in range(r.randint(0, 6)))})
        folder, settled = cv.Folder(), []
        for lo, hi in zip(cuts, cuts[1:]):
            part = [a + b for a, b in rows[lo:hi]]
            settled += folder.add(lo, cv.options(part, lo == 0, hi == len(rows)))
        assert not folder.waiting and [k for k, _ in settled] == cuts[:-1]
        assert (folder.cost, "".join(a for _, a in settled)) == cheapest(rows)


@pytest.mark.parametrize("bits", [6, 1])
def test_query_equals_the_plain_version(spark, monkeypatch, bits):
    monkeypatch.setattr(cv, "PIECE_BITS", bits)
    rows = made_up(2, [0, 1, 2, 3, 8, 8, 8, 5, 40, 130, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 2, 2, 2, 2] + [6] * 40)
    rows += [(None, 0, "user", "a."), (None, None, None, None), (900, None, "user", "x"), (900, None, "user", "x"), (901, 5, "system", "only.")]
    gone = [c for c in range(2000, 2200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]  # these lose all their rows
    rows += [(c, 0, "user", "a.") for c in gone]
    got, want = result(as_query(spark, rows, monkeypatch)), plain(rows)
    assert got == want and all(got[c] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in gone)


def test_repeated_rows_of_one_huge_conversation(spark, monkeypatch):
    monkeypatch.setattr(cv, "PIECE_BITS", 3)
    rows = [(7, t // 3, ["user", "assistant"][t % 2], ["same.", f"t{t}"][t % 3 == 0]) for t in range(900)] + made_up(4, [3] * 20, 100)
    assert result(as_query(spark, rows, monkeypatch)) == plain(rows)


def test_repaired_rows_read_as_conversations(spark):
    rows = made_up(6, [7] * 30 + [100])
    found, repaired = cv.repair(spark.createDataFrame(rows, SCHEMA))
    lines = {}
    for r in sorted(repaired.collect(), key=lambda r: (r.conv, r.place, r.sub)):
        lines.setdefault(r.conv, []).append(r)
    for r in found.collect():
        kept = lines.get(r.conv, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(x.role[:1] for x in kept))
        assert "".join(x.edit for x in kept) == r.audit.replace("D", "")
        assert all((x.text == "") == (x.edit == "I") for x in kept)


def test_empty_table_odd_columns_and_long_texts(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert all(t.count() == 0 for t in cv.repair(none))
    long = "word " * 200_000 + "end."
    rows = [("a", "1", "user", long), ("a", "2", "assistant", "b."), ("b", "x", "assistant", "c")]
    odd = spark.createDataFrame(rows, "`a conv` string, t string, r string, text string").selectExpr("*", "1 as conv", "2 as place", "3 as role", "4 as turn", "5 as piece")
    found, repaired = cv.repair(odd, "a conv", "t", "r", "text")
    assert sorted((r.conv, r.cost, r.audit) for r in found.collect()) == [("a", 0, "KK"), ("b", 3, "D")]
    got = {r.conv: r.repaired_sha256 for r in cv.digests(repaired).collect()}
    assert got == {"a": hashlib.sha256(f"user:{long}\nassistant:b.".encode()).hexdigest()}


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(cv.query(spark, sf)) == plain(rows)

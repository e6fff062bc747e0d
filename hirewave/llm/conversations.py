"""Conversation structure repair by iterative-deepening A* over edits."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirewave.llm.common import materialize, table
from hirewave.session import ship_package

#: fixed costs of the edits; a truncated row that stays adds one
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
#: rows searched at once are at most 2 ** PIECE_BITS; longer conversations are put together from pieces
PIECE_BITS = 6
CACHE = 100_000

#: the role grammar (s?(ua)+)? as states 0 (nothing yet), 1 (system), 2 (user), 3 (assistant); 0 and 3 accept
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NEEDS = "uuau"
ACCEPT = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")


# search over one piece

def bounds(rows: list[str]) -> list[int]:
    """For each place a cost that the rows from there on need at least.

    Rows are two letters: role initial (s, u, a or ?) and fault (b, d, t or
    blank).  Blank rows and duplicates must go; other truncated rows cost 1 or
    go; unknown roles change or go; and one edit ends at most two meetings of
    equal initials, so each meeting costs 1 at least.
    """
    out, following = [0], ""
    for role, fault in reversed(rows):
        if fault in "bd":
            out.append(out[-1] + DELETE)
            continue
        cost = TRUNCATED * (fault == "t") + REROLE * (role == "?") + (role == following and role in "ua")
        out.append(out[-1] + cost)
        following = role
    return out[::-1]


class Search:
    """Cheapest, ASCII-least edits of a piece from a state to one of ``goals``.

    ``need`` is the transposition table: for a place and state, what the rest is
    known to cost at least after failed searches; entries share it.
    """

    def __init__(self, rows: list[str], goals: tuple[int, ...]) -> None:
        self.rows, self.goals, self.least, self.need = rows, goals, bounds(rows), {}
        self.keeps_system = any(r[0] == "s" and r[1] not in "bd" for r in rows)

    def reachable(self, entry: int) -> bool:
        from_here = {0: {0, 2, 3} | ({1} if self.keeps_system else set()), 1: {1, 2, 3}}.get(entry, {2, 3})
        return bool(from_here & set(self.goals))

    def _moves(self, at: int, state: int) -> list[tuple[str, int, int, int]]:
        """(letter, cost, place, state) in ASCII order."""
        wanted = STEP[state, NEEDS[state]]
        if at == len(self.rows):
            return [("I", INSERT, at, wanted)]
        role, fault = self.rows[at]
        out = [("D", DELETE, at + 1, state), ("I", INSERT, at, wanted)]
        if fault not in "bd":
            stays = TRUNCATED * (fault == "t")
            if (state, role) in STEP:
                out.append(("K", stays, at + 1, STEP[state, role]))
            out.append(("R", REROLE + stays, at + 1, wanted))
        return out

    def _deepen(self, entry: int, bound: int) -> str | None:
        """Depth-first within ``bound``: the first accepting path, or None and a larger ``need``."""
        need, least, end, path = self.need, self.least, len(self.rows), []
        stack = [(0, entry, bound, iter(self._moves(0, entry)), [1 << 60])]
        if end == 0 and entry in self.goals:
            return ""
        while stack:
            at, state, left, moves, low = stack[-1]
            for letter, cost, to, then in moves:
                rest = max(need.get((to, then), 0), least[to])
                if cost + rest > left:
                    low[0] = min(low[0], cost + rest)
                    continue
                path.append(letter)
                if to == end and then in self.goals:
                    return "".join(path)
                stack.append((to, then, left - cost, iter(self._moves(to, then)), [1 << 60]))
                break
            else:
                stack.pop()
                need[at, state] = max(need.get((at, state), 0), low[0])
                if stack:
                    path.pop()
                    above, before = stack[-1], left
                    above[4][0] = min(above[4][0], above[2] - before + need[at, state])
        return None

    def best(self, entry: int) -> tuple[int, str] | None:
        """(cost, audit) from ``entry``, or None where no edits lead to a goal."""
        if not self.reachable(entry):
            return None
        bound = max(self.least[0], self.need.get((0, entry), 0))
        while (audit := self._deepen(entry, bound)) is None:
            bound = self.need[0, entry]
        return bound, audit


def options(rows: list[str], first: bool, last: bool) -> list[tuple[int, int, int, str]]:
    """(entry, exit, cost, audit) of a piece for all states its neighbours may leave or want.

    The last piece may end in either accepting state (exit 3); a whole
    conversation is its own first and last piece.
    """
    out = []
    for goals in [ACCEPT] if last else [(0,), (1,), (2,), (3,)]:
        search = Search(rows, goals)
        for entry in (0,) if first else (0, 1, 2, 3):
            found = search.best(entry)
            if found:
                out.append((entry, goals[-1], *found))
    return out


def replay(places: list[int], rows: list[str], entry: int, audit: str) -> tuple[list[tuple[int, int, str, str | None]], int]:
    """[(place, sub, letter, new role)] in order of the repaired rows, and the state they end in."""
    out, at, sub, state = [], 0, 0, entry
    for letter in audit:
        role = ROLES[NEEDS[state]] if letter in "IR" else None
        out.append((places[min(at, len(places) - 1)], sub, letter, role))
        sub += 1
        if letter != "I":
            at += 1
            sub = sub if at == len(places) else 0
        if letter != "D":
            state = STEP[state, role[0] if role else rows[at - 1][0]]
    return out, state


class Folder:
    """Puts the pieces of a conversation together, in order: the cheapest, ASCII-least way over all states.

    Of two equally dear ways neither audit begins the other (an insertion
    costs), so the least audit of every piece between two states is part of
    the least whole.  What all open ways share is settled and dropped.
    """

    def __init__(self) -> None:
        self.open, self.waiting = {0: (0, [])}, []

    def add(self, piece, ways: list[tuple[int, int, int, str]]) -> Iterator[tuple[object, str]]:
        """Takes the next piece; yields the pieces whose audits are settled by it."""
        self.waiting.append(piece)
        best: dict[int, tuple[int, str, list[str]]] = {}
        for entry, leave, cost, audit in ways:
            if entry in self.open:
                before, parts = self.open[entry]
                total, text = before + cost, "".join(parts) + audit
                if leave not in best or (total, text) < best[leave][:2]:
                    best[leave] = (total, text, [*parts, audit])
        self.open = {state: (total, parts) for state, (total, _, parts) in best.items()}
        while self.waiting and len({parts[0] for _, parts in self.open.values()}) == 1:
            audit = next(iter(self.open.values()))[1][0]
            for _, parts in self.open.values():
                del parts[0]
            yield self.waiting.pop(0), audit

    @property
    def cost(self) -> int:
        """The cost, after the last piece."""
        return next(iter(self.open.values()))[0]


# jobs

def _blank(text: Column) -> Column:
    return ~text.rlike(r"[^\x20\x09-\x0D]")


def place_rows(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, place): all rows in order of conversation, turn (null first), role and text.

    Null roles and texts become one space; a turn that is no whole number counts
    as null.  Rows are range partitioned on all
    of these, so one conversation may spread over many tasks.
    """
    fill = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    plain = rows.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").try_cast("bigint").alias("turn"),
                        fill(role_col).alias("role"), fill(text_col).alias("text"))
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(plain.repartitionByRange(n, *order).sortWithinPartitions(*order)
                       .withColumn("place", F.monotonically_increasing_id()), "conversation-rows")


def pieces(placed: DataFrame) -> DataFrame:
    """(conv, piece, first, last, rows): runs of up to 2 ** PIECE_BITS neighbouring rows of a conversation, with faults.

    A row's earlier copy is found by the smallest place of its conversation,
    role and text (by SHA-256), put together in every task before the shuffle.
    """
    blank = _blank(F.col("text"))
    end = F.expr(r"right(trim(trailing ' \t\n\u000b\f\r' from text), 1)")
    initial = F.substring("role", 1, 1)
    code = F.struct("place", "turn", F.when(initial.isin("s", "u", "a"), initial).otherwise("?").alias("initial"),
                    F.when(blank, "b").when(~end.isin(".", "!", "?"), "t").otherwise(" ").alias("fault"))
    rows = placed.select("conv", "place", code.alias("code"), F.lit(False).alias("new"))
    new = (placed.where(~blank).groupBy("conv", "role", F.unhex(F.sha2("text", 256)).alias("text"))
           .agg(F.min("place").alias("place")).select("conv", "place", F.lit(None).cast(rows.schema["code"].dataType).alias("code"), F.lit(True).alias("new")))
    both = rows.unionByName(new).withColumn("piece", F.shiftright("place", PIECE_BITS))
    held = materialize(both.groupBy("conv", "piece").agg(
        F.sort_array(F.collect_list("code")).alias("rows"), F.collect_list(F.when(F.col("new"), F.col("place"))).alias("new")), "conversation-pieces")
    cut = (held.groupBy(F.col("conv").alias("_conv")).agg(F.min("piece").alias("lo"), F.max("piece").alias("hi")).where("lo < hi"))
    return held.join(cut, F.col("conv").eqNullSafe(F.col("_conv")), "left").select(
        "conv", "piece", F.coalesce(F.col("piece") == F.col("lo"), F.lit(True)).alias("first"),
        F.coalesce(F.col("piece") == F.col("hi"), F.lit(True)).alias("last"), "rows", "new")


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with their faults counted and all ways through them."""
    known: dict = {}
    for b in batches:
        out = {k: [] for k in ("places", "rows", "lo", "hi", "turns", "blank", "duplicate", "truncated", "illegal", "ways")}
        for first, last, rows, new in zip(*(b.column(i).to_pylist() for i in range(2, 6))):
            new = set(new)
            code = [r["initial"] + ("d" if r["fault"] != "b" and r["place"] not in new else r["fault"]) for r in rows]
            key = ("".join(code), first, last)
            if key not in known:
                if len(known) >= CACHE:
                    known.clear()
                known[key] = options(code, first, last)
            turns = [r["turn"] for r in rows if r["turn"] is not None]
            for name, value in (("places", [r["place"] for r in rows]), ("rows", key[0]), ("lo", turns[0] if turns else None),
                                ("hi", turns[-1] if turns else None), ("turns", len(set(turns))),
                                ("blank", sum(c[1] == "b" for c in code)), ("duplicate", sum(c[1] == "d" for c in code)),
                                ("truncated", sum(c[1] == "t" for c in code)),
                                ("illegal", sum(a[0] + z[0] not in LEGAL for a, z in zip(code, code[1:]))),
                                ("ways", [f"{p}{q}{cost} {audit}" for p, q, cost, audit in known[key]])):
                out[name].append(value)
        types = {"places": pa.list_(pa.int64()), "rows": pa.string(), "ways": pa.list_(pa.string())}
        arrays = [pa.array(v, types.get(k, pa.int64())) for k, v in out.items()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), *arrays], names=["conv", "piece", "last", *out])


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Faults, costs and edits of every conversation, and the repaired rows.

    -> (conv, gaps, blank, duplicate, truncated, illegal, cost, audit) and
    (conv, place, sub, edit, role, text), whose order in a conversation is
    (place, sub).  The search runs on pieces of up to 64 neighbouring rows, all
    pieces in parallel, for each state a piece may begin and end in; the
    results are then put together in order, so a long conversation takes many
    tasks for the search and one for a few numbers and letters a row.

    A null conversation is one of its own; null turns come first; null roles
    and texts count as one space (a blank row of unknown role); rows of one
    turn stand by role, then text, and repeated rows are duplicates.  Texts are
    never held for more than a batch of rows.  An empty table gives empty
    tables; other columns are not read.
    """
    spark = rows.sparkSession
    ship_package(spark)
    placed = place_rows(rows, conv_col, turn_col, role_col, text_col)
    kind = placed.schema["conv"].dataType.simpleString()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbers = "lo long, hi long, turns long, blank long, duplicate long, truncated long, illegal long"
    solved = pieces(placed).mapInArrow(
        _solve, f"conv {kind}, piece long, last boolean, places array<long>, rows string, {numbers}, ways array<string>")
    ordered = solved.repartition(n, "conv").sortWithinPartitions("conv", "piece")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder, entry, counts, audit, hi, end = Folder(), 0, [0] * 6, [], None, None

        def batch(conv, edits, counts=None, audit=None):
            part = [[e[j] for e in edits] for j in range(4)]
            lists = [pa.array([p], pa.list_(t)) for p, t in zip(part, (pa.int64(), pa.int64(), pa.string(), pa.string()))]
            return pa.RecordBatch.from_arrays([conv, *lists, *[pa.array([c], pa.int64()) for c in counts or [None] * 6], pa.array([audit], pa.string())],
                                              names=["conv", "places", "subs", "letters", "roles", *COUNTS, "audit"])

        for b in batches:
            held = {k: b.column(k).to_pylist() for k in b.schema.names if k != "conv"}
            done = []
            for i in range(b.num_rows):
                conv, get = b.column("conv").slice(i, 1), lambda k, i=i: held[k][i]
                for j, k in enumerate(COUNTS[1:5]):
                    counts[j + 1] += get(k)
                if get("lo") is not None:
                    counts[0] += (get("hi") - get("lo") + 1 if hi is None else get("hi") - hi) - get("turns") + (hi == get("lo"))
                    hi = get("hi")
                counts[4] += end is not None and end + get("rows")[0] not in LEGAL
                end = get("rows")[-2]
                ways = [(int(w[0]), int(w[1]), int(w[2:w.index(" ")]), w[w.index(" ") + 1:]) for w in get("ways")]
                edits = []
                for (places, codes), text in folder.add((get("places"), get("rows")), ways):
                    more, entry = replay(places, [codes[j:j + 2] for j in range(0, len(codes), 2)], entry, text)
                    edits += more
                    audit.append(text)
                if get("last"):
                    counts[5] = folder.cost
                    done.append(batch(conv, edits, counts, "".join(audit)))
                    folder, entry, counts, audit, hi, end = Folder(), 0, [0] * 6, [], None, None
                elif edits:
                    done.append(batch(conv, edits))
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]

    lists = "places array<long>, subs array<long>, letters array<string>, roles array<string>"
    folded = materialize(ordered.mapInArrow(fold, f"conv {kind}, {lists}, {', '.join(f'{c} long' for c in COUNTS)}, audit string"), "conversation-edits")
    edits = folded.select("conv", F.inline(F.arrays_zip(F.col("places").alias("place"), F.col("subs").alias("sub"), F.col("letters").alias("edit"), F.col("roles").alias("to"))))
    stays = edits.where("edit in ('K', 'R')").join(placed.select("place", "role", "text"), "place").select(
        "conv", "place", "sub", "edit", F.coalesce("to", "role").alias("role"), "text")
    added = edits.where("edit = 'I'").select("conv", "place", "sub", "edit", F.col("to").alias("role"), F.lit("").alias("text"))
    return folded.where("audit is not null").select("conv", *COUNTS, "audit"), stays.unionByName(added)


def digests(repaired: DataFrame) -> DataFrame:
    """(conv, repaired_sha256): the hash over a conversation's ``role:text`` lines.

    A hash over a whole conversation runs through it in order, so its rows
    pass one task, sorted outside Python and hashed as a stream.
    """
    kind = repaired.schema["conv"].dataType.simpleString()
    n = int(repaired.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = (repaired.select("conv", "place", "sub", F.concat("role", F.lit(":"), "text").alias("line"))
             .repartition(n, "conv").sortWithinPartitions("conv", "place", "sub"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for b in batches:
            keys, done = b.column("conv"), []
            for i, (key, line) in enumerate(zip(keys.to_pylist(), b.column("line"))):
                if state is None or key != now[0]:
                    if state is not None:
                        done.append((now[1], state.hexdigest()))
                    now, state = (key, keys.slice(i, 1)), hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(line.as_buffer())
            if done:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([k for k, _ in done]), pa.array([h for _, h in done])], names=["conv", "repaired_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([now[1], pa.array([state.hexdigest()])], names=["conv", "repaired_sha256"])

    return lines.mapInArrow(run, f"conv {kind}, repaired_sha256 string")


# query

def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` rows with the planted damage: crc32(`conv_id:turn`) % 20 drops (0), empties (1), takes the ends
    of sentences (2), repeats (3) or makes a row the user's (4).  Nulls become one space, also in the key; a null turn stays null."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate(text_of("text"), ".!?", "")).otherwise(text_of("text"))
    return (rows.withColumn("_kind", kind).where("_kind <> 0")
            .select("conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(text_of("role")).alias("role"), text.alias("text"),
                    F.explode(F.sequence(F.lit(1), F.when(F.col("_kind") == 3, 2).otherwise(1))).alias("_copy")).drop("_copy"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found, repaired = repair(damaged(given))
    known = found.join(digests(repaired).withColumnRenamed("conv", "_c"), F.col("conv").eqNullSafe(F.col("_c")), "left").drop("_c")
    every = given.select("conv_id").distinct().join(known, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    empty = hashlib.sha256(b"").hexdigest()
    return every.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS],
                        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))

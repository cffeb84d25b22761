"""Repair of conversations by a generalised LR parser with weighted edits.

The grammar of roles, (s?(ua)+)?, is compiled to an LR(0) automaton. Parse stacks are linked cells that share what lies
below; at every row each stack takes all edits (keep, rerole, delete, and inserts between rows), and equal stacks are
merged by the least (cost, audit). A conversation is cut into blocks of rows: a block's task parses it from each stack
that it may begin with, and blocks are joined like matrices over (cost, audit), so that no task reads all rows of a
long conversation. Parsing needs a few bytes a row; texts are joined to the rows kept afterwards.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from itertools import count, islice, pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloudtally.llm.common import cut, map_batches, numbered, ship

#: Productions of the role grammar; upper-case symbols are derived, `S` first.
GRAMMAR = (("S", ""), ("S", "P"), ("S", "sP"), ("P", "ua"), ("P", "Pua"))
_TERMINALS = "sua"
RENAMED = {"u": "user", "a": "assistant"}
_ALLOWED = {"su", "ua", "au"}
_REROLE, _DELETE, _INSERT, _TRUNCATED = 1, 2, 5, 5
_WHITE = r"\x20\x09-\x0D"
_BLOCK, _JOINED = 1024, 64
_TABLE = "array<struct<start:int,end:int,cost:long,audit:string>>"

Best = tuple[int, str]


def _closure(items: set[tuple[int, int]]) -> frozenset:
    todo = list(items)
    while todo:
        rule, dot = todo.pop()
        for k, (name, body) in enumerate(GRAMMAR):
            if GRAMMAR[rule][1][dot:dot + 1] == name and (k, 0) not in items:
                items.add((k, 0))
                todo.append((k, 0))
    return frozenset(items)


def _automaton() -> tuple[dict, dict, set]:
    """Moves by (state, symbol), rules that end in a state, and the states in which a parse may end."""
    start = _closure({(k, 0) for k, (name, _) in enumerate(GRAMMAR) if name == "S"})
    states, moves, todo = {start: 0}, {}, [start]
    while todo:
        state = todo.pop()
        for symbol in {GRAMMAR[r][1][d] for r, d in state if d < len(GRAMMAR[r][1])}:
            after = _closure({(r, d + 1) for r, d in state if GRAMMAR[r][1][d:d + 1] == symbol})
            if after not in states:
                states[after] = len(states)
                todo.append(after)
            moves[states[state], symbol] = states[after]
    ended = {n: [GRAMMAR[r] for r, d in s if d == len(GRAMMAR[r][1])] for s, n in states.items()}
    return moves, {n: [g for g in rules if g[0] != "S"] for n, rules in ended.items()}, {
        n for n, rules in ended.items() if any(g[0] == "S" for g in rules)}


_MOVES, _RULES, _ENDS = _automaton()


def _shifted(stack: tuple, symbol: str) -> list[tuple]:
    """The stacks after a symbol and every reduction that follows; those that can go on or end."""
    if (stack[0], symbol) not in _MOVES:
        return []
    out, todo = [], [(_MOVES[stack[0], symbol], stack)]
    while todo:
        top = todo.pop()
        if top[0] in _ENDS or any((top[0], t) in _MOVES for t in _TERMINALS):
            out.append(top)
        for name, body in _RULES[top[0]]:
            below = top
            for _ in body:
                below = below[1]
            todo.append((_MOVES[below[0], name], below))
    return out


def _stacks() -> tuple[list[tuple], list[dict[str, list[int]]]]:
    """All stacks that a prefix can leave (finitely many, as the grammar recurs on the left), and where symbols lead."""
    found = [(0, None)]
    moves: list[dict[str, list[int]]] = []
    for stack in found:
        after = {t: _shifted(stack, t) for t in _TERMINALS}
        found += [s for some in after.values() for s in some if s not in found]
        moves.append({t: [found.index(s) for s in some] for t, some in after.items()})
    return found, moves


_STACKS, _AFTER = _stacks()
_FINAL = {n for n, s in enumerate(_STACKS) if s[0] in _ENDS}


def _settle(tops: dict[int, Best]) -> dict[int, Best]:
    """The stacks with those that inserts lead to."""
    todo = [(best, s) for s, best in tops.items()]
    heapq.heapify(todo)
    while todo:
        best, s = heapq.heappop(todo)
        if tops[s] != best:
            continue
        made = (best[0] + _INSERT, best[1] + "I")
        for symbol in RENAMED:
            for t in _AFTER[s][symbol]:
                if t not in tops or made < tops[t]:
                    tops[t] = made
                    heapq.heappush(todo, (made, t))
    return tops


def parse(rows: Iterable[tuple[str, str]], start: int = 0) -> dict[int, Best]:
    """The least (cost, audit) of every stack after `rows` of (role initial, fault), beginning with stack `start`.

    Faults are `x` (blank or duplicate, must be deleted), `t` (truncated) or empty. Of equal costs the ASCII-least audit
    counts: two audits of equal cost for the same rows are never prefixes of each other, so the least one stays least.
    """
    tops = _settle({start: (0, "")})
    for initial, fault in rows:
        after: dict[int, Best] = {}

        def put(t: int, best: Best, after: dict[int, Best] = after) -> None:
            if t not in after or best < after[t]:
                after[t] = best
        kept = _TRUNCATED if fault == "t" else 0
        for s, (cost, audit) in tops.items():
            put(s, (cost + _DELETE, audit + "D"))
            if fault != "x":
                for t in _AFTER[s].get(initial, ()):
                    put(t, (cost + kept, audit + "K"))
                for symbol in RENAMED:
                    for t in _AFTER[s][symbol]:
                        put(t, (cost + kept + _REROLE, audit + "R"))
        tops = _settle(after)
    return tops


def joined(tables: list[list[tuple]]) -> list[tuple]:
    """One table of (start, end, cost, audit) for tables of consecutive blocks."""
    out = {(s, e): (c, a) for s, e, c, a in tables[0]}
    for table in tables[1:]:
        onward: dict[int, list] = {}
        for s, e, c, a in table:
            onward.setdefault(s, []).append((e, c, a))
        after: dict[tuple[int, int], Best] = {}
        for (s, m), (cost, audit) in out.items():
            for e, c, a in onward[m]:
                if (s, e) not in after or cost + c <= after[s, e][0]:
                    best = (cost + c, audit + a)
                    after[s, e] = min(best, after.get((s, e), best))
        out = after
    return [(s, e, c, a) for (s, e), (c, a) in out.items()]


def damaged(rows: DataFrame) -> DataFrame:
    """`conv_id`, `turn`, `role`, `text`, `copies`: rows dropped, emptied, cut short, repeated or renamed by a hash of their place."""
    def known(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))
    at = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    text = F.when(at == 1, "").when(at == 2, F.translate(known("text"), ".!?", "")).otherwise(known("text"))
    return rows.filter(at != 0).select("conv_id", "turn", F.when(at == 4, "user").otherwise(known("role")).alias("role"),
                                       text.alias("text"), F.when(at == 3, 2).otherwise(1).cast("long").alias("copies"))


def _named(rows: DataFrame) -> DataFrame:
    """The rows with `g` (the conversation, never null) and `said` (a 128-bit digest of conversation, role and text)."""
    g = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    rows = rows.select(g.alias("g"), F.col("turn").cast("long").alias("turn"), "role", "text", "copies")
    return rows.withColumn("said", F.md5(F.concat_ws("\x00", "g", F.octet_length("role").cast("string"), "role", "text").cast("binary")))


def _faults(named: DataFrame) -> DataFrame:
    """`g`, `turn`, `role`, `said`, `n`, `initial`, `first` (whether its first copy is the first of its kind), `blank`, `truncated`.

    Equal rows are one row of `n`, combined before any shuffle.
    """
    blank = ~F.col("text").rlike(f"[^{_WHITE}]")
    cut_short = ~blank & ~F.col("text").rlike(f"[.!?][{_WHITE}]*\\z")
    initial = F.substring("role", 1, 1)
    each = named.groupBy("g", "turn", "role", "said", blank.alias("blank"), cut_short.alias("truncated")).agg(
        F.sum("copies").alias("n"))
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    seen = each.groupBy("said").agg(F.min(place).alias("earliest"))
    return each.join(seen, "said").select(
        "g", "turn", "role", "said", "n", F.when(initial.isin(*_TERMINALS), initial).otherwise("-").alias("initial"),
        place.eqNullSafe(F.col("earliest")).alias("first"), "blank", "truncated")


class Repair:
    """Conversations repaired: `facts` has a row for each, `rows` the repaired rows."""

    def __init__(self, rows: DataFrame):
        """`rows` has `conv_id`, `turn`, `role`, `text`, `copies` (equal rows that follow each other); other columns are ignored.

        Within a conversation rows are ordered by turn, null first, then role and a digest of the text. Role and text
        must not be null. An id that is null is a conversation of its own; no rows give none.
        """
        self._kind = dict(rows.dtypes)["conv_id"]
        self._named = _named(rows)
        self._laid = cut(numbered(_faults(self._named), "turn", "role", "said"))
        self._parsed = cut(self._parse())

    def _back(self) -> Column:
        return F.when(F.col("g") != "", F.expr("substring(g, 2)")).cast(self._kind).alias("conv_id")

    def _parse(self) -> DataFrame:
        """`g`, `illegal`, `cost`, `audit`."""
        block = F.explode(F.expr(f"sequence(start div {_BLOCK}, (start + n - 1) div {_BLOCK})")).alias("block")
        low = F.greatest("start", F.col("block") * _BLOCK)
        item = F.struct(low.alias("at"), (F.least(F.col("start") + F.col("n"), (F.col("block") + 1) * _BLOCK) - low).alias("n"),
                        "initial", F.when(F.col("blank") | ~F.col("first") | (low > F.col("start")), "x").when(
                            F.col("truncated"), "t").otherwise("").alias("fault"))
        blocks = (self._laid.select("*", block).select("g", "block", item.alias("item")).groupBy("g", "block")
                  .agg(F.sort_array(F.collect_list("item")).alias("items")))

        def first():
            def work(batch: pa.RecordBatch) -> pa.RecordBatch:
                out = []
                for g, number, items in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    # Copies after the first are duplicates.
                    units = [(x["initial"], x["fault"] if not k else "x") for x in items for k in range(x["n"])]
                    wrong = sum(a + b not in _ALLOWED for (a, _), (b, _) in pairwise(units))
                    table = [(s, e, c, a) for s in range(len(_STACKS) if number else 1) for e, (c, a) in parse(units, s).items()]
                    out.append((g, number, units[0][0], units[-1][0], wrong, table))
                return _tables(out)
            return work
        schema = f"g string, block long, head string, tail string, illegal long, parsed {_TABLE}"
        tables = map_batches(blocks, first, schema, rows=64)

        def further():
            def work(batch: pa.RecordBatch) -> pa.RecordBatch:
                out = []
                for g, number, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    wrong = sum(p["illegal"] for p in parts) + sum(
                        a["tail"] + b["head"] not in _ALLOWED for a, b in pairwise(parts))
                    table = joined([[tuple(x.values()) for x in p["parsed"]] for p in parts])
                    out.append((g, number, parts[0]["head"], parts[-1]["tail"], wrong, table))
                return _tables(out)
            return work
        longest = self._laid.agg(F.max("total")).first()[0] or 0
        left = -(-longest // _BLOCK)
        while left > 1:
            part = F.struct("block", "head", "tail", "illegal", "parsed")
            groups = cut(tables).groupBy("g", F.expr(f"block div {_JOINED}").alias("number")).agg(
                F.sort_array(F.collect_list(part)).alias("parts"))
            tables = map_batches(groups, further, schema, rows=1)
            left = -(-left // _JOINED)
        ended = F.filter("parsed", lambda x: (x["start"] == 0) & x["end"].isin(*_FINAL))
        best = F.array_min(F.transform(ended, lambda x: F.struct(x["cost"].alias("cost"), x["audit"].alias("audit"))))
        return tables.select("g", "illegal", best.alias("best")).select("g", "illegal", "best.cost", "best.audit")

    def facts(self) -> DataFrame:
        """`conv_id`, `gaps`, `blank`, `duplicate`, `truncated`, `illegal`, `cost`, `audit` of every conversation with rows.

        `gaps` is null where it does not fit a long.
        """
        extra, whole = F.when(F.col("first"), F.col("n") - 1).otherwise(F.col("n")), F.col("n")
        turns = self._laid.groupBy("g", "turn").agg(
            F.sum(F.when(F.col("blank"), whole).otherwise(0)).alias("blank"),
            F.sum(F.when(F.col("blank"), 0).otherwise(extra)).alias("duplicate"),
            F.sum((F.col("truncated") & F.col("first")).cast("long")).alias("truncated"))
        span = F.max("turn").cast("decimal(20,0)") - F.min("turn").cast("decimal(20,0)") + 1 - F.count("turn")
        sums = turns.groupBy("g").agg(F.coalesce(span.try_cast("long"), F.when(F.count("turn") == 0, 0)).cast("long").alias("gaps"),
                                      *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
        return sums.join(self._parsed, "g").select(self._back(), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    def _lines(self) -> DataFrame:
        """`g`, `place`, `role`, `text` of the repaired rows."""
        def edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for g, audit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    steps = _walk(audit)
                    while some := list(islice(steps, 1 << 16)):
                        places, ats, roles = zip(*some, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([g] * len(some)), pa.array(places, pa.int64()), pa.array(ats, pa.int64()),
                             pa.array(roles, pa.string())], ["g", "place", "start", "new"])
        ship(self._parsed.sparkSession)
        made = self._parsed.select("g", "audit").mapInArrow(edits, "g string, place long, start long, new string")
        texts = self._named.groupBy("said", "turn").agg(F.first("text").alias("text"))
        kept = self._laid.filter("first and not blank").select("g", "start", "role", "said", "turn")
        lines = made.join(kept, ["g", "start"], "left").alias("m").join(
            texts.alias("t"), (F.col("m.said") == F.col("t.said")) & F.col("m.turn").eqNullSafe(F.col("t.turn")), "left")
        return lines.select("g", "place", F.coalesce("new", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))

    def rows(self) -> DataFrame:
        """`conv_id`, `place` (from 0), `role`, `text` of the repaired rows; inserted ones have an empty text."""
        return self._lines().select(self._back(), "place", "role", "text")

    def digests(self) -> DataFrame:
        """`conv_id`, `repaired_sha256`: the hash of `role:text` lines joined by newlines, of conversations with repaired rows.

        The hash takes one line after the other, so a conversation's lines pass one task, a batch at a time.
        """
        def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def out(g: str, state) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array([g]), pa.array([state.hexdigest()])], ["g", "repaired_sha256"])
            now, state = None, None
            for batch in batches:
                for g, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if g != now:
                        if state:
                            yield out(now, state)
                        now, state = g, hashlib.sha256()
                    else:
                        state.update(b"\n")
                    state.update(f"{role}:{text}".encode())
            if state:
                yield out(now, state)
        lines = self._lines().repartition("g").sortWithinPartitions("g", "place").select("g", "role", "text")
        return lines.mapInArrow(hashes, "g string, repaired_sha256 string").select(self._back(), "repaired_sha256")


def _tables(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.struct(
        [("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))]
    columns = list(zip(*rows, strict=True))
    columns[-1] = [[dict(zip(("start", "end", "cost", "audit"), x, strict=True)) for x in table] for table in columns[-1]]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                      ["g", "block", "head", "tail", "illegal", "parsed"])


def _walk(audit: str) -> Iterator[tuple[int, int | None, str | None]]:
    """Place, row (None for an insert) and new role (None for a row kept) of each repaired row."""
    at, place = count(), count()
    begins = (len(audit) - audit.count("D")) % 2  # an odd number of rows begins with a system row
    for edit in audit:
        row = None if edit == "I" else next(at)
        if edit != "D":
            n = next(place)
            yield n, row, None if edit == "K" else RENAMED["ua"[(n - begins) % 2]]


def repaired(rows: DataFrame) -> DataFrame:
    """The facts and digest of every `conv_id` of `rows` after damage; one without rows left has zeros and empty results."""
    every = rows.select("conv_id").distinct()
    repair = Repair(damaged(rows))
    facts, digests = repair.facts(), repair.digests()
    empty = hashlib.sha256().hexdigest()
    found = every.alias("e").join(facts.alias("f"), F.col("e.conv_id").eqNullSafe(F.col("f.conv_id")), "left").join(
        digests.alias("d"), F.col("e.conv_id").eqNullSafe(F.col("d.conv_id")), "left")
    zero = F.lit(0).cast("long")
    gaps = F.when(F.col("f.audit").isNull(), zero).otherwise(F.col("f.gaps")).alias("gaps")
    return found.select("e.conv_id", gaps, *[F.coalesce(f"f.{c}", zero).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
                        F.coalesce("f.audit", F.lit("")).alias("audit"),
                        F.coalesce("d.repaired_sha256", F.lit(empty)).alias("repaired_sha256"))

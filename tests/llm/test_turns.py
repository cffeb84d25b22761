import hashlib
import itertools
import random
import re
import zlib

import pytest

from cloudtally.llm import turns

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def cheapest(rows):
    """The least (cost, audit) over every sequence of edits, without merging anything."""
    found = []

    def go(at, cost, audit, roles):
        if cost > 5 * len(rows) + 2 or (roles and not re.fullmatch("s?(ua)*u?", roles)):
            return
        if at == len(rows):
            if re.fullmatch("(s?(ua)+)?", roles):
                found.append((cost, audit))
        else:
            kind, fault = rows[at]
            go(at + 1, cost + 2, audit + "D", roles)
            if fault != "x":
                more = 5 if fault == "t" else 0
                go(at + 1, cost + more, audit + "K", roles + kind)
                for new in "ua":
                    go(at + 1, cost + more + 1, audit + "R", roles + new)
        for new in "ua":
            go(at, cost + 5, audit + "I", roles + new)
    go(0, 0, "", "")
    return min(found)


def best(tops):
    return min(v for s, v in tops.items() if s in turns._FINAL)


@pytest.mark.parametrize("length", [0, 1, 2, 3])
def test_every_short_conversation(length):
    for rows in itertools.product(itertools.product("sua-", ["", "t", "x"]), repeat=length):
        assert best(turns.parse(rows)) == cheapest(rows), rows


def test_longer_conversations():
    pick = random.Random(4)
    for _ in range(60):
        rows = [(pick.choice("suuaa-"), pick.choice(["", "", "", "t", "x"])) for _ in range(5)]
        assert best(turns.parse(rows)) == cheapest(rows), rows


def test_blocks_join_to_the_whole():
    pick = random.Random(5)
    rows = [(pick.choice("suuuaaa-"), pick.choice(["", "", "", "t", "x"])) for _ in range(200)]
    parts, at = [], 0
    while at < len(rows):
        size = pick.randint(1, 40)
        starts = range(len(turns._STACKS)) if at else [0]
        parts.append([(s, e, c, a) for s in starts for e, (c, a) in turns.parse(rows[at:at + size], s).items()])
        at += size
    got = {e: (c, a) for s, e, c, a in turns.joined([turns.joined(parts[:3]), turns.joined(parts[3:])])}
    assert best(got) == best(turns.parse(rows))


def plain(rows):
    """Every contract column; costs by a table over positions and the four states of the grammar."""
    out = []
    for conv in {r[0] for r in rows}:
        after = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            hit, role, text = zlib.crc32(key.encode()) % 20, " " if role is None else role, " " if text is None else text
            role = "user" if hit == 4 else role
            text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
            said = hashlib.md5("\0".join(["" if conv is None else f"={conv}", str(len(role.encode())), role, text]).encode())
            after += [(turn is not None, turn or 0, role, said.hexdigest(), text)] * [1, 2][hit == 3] * (hit != 0)
        after.sort()
        units, seen, counts = [], set(), {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, _, text in after:
            solid = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            units.append((role[:1], {"truncated": "t", "": ""}.get(fault, "x")))
        cost, audit = table(units)
        known = [t for has, t, *_ in after if has]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(units))
        lines, at = [], 0
        begins = (len(audit) - audit.count("D")) % 2
        for edit in audit:
            if edit != "D":
                new = ["user", "assistant"][(len(lines) - begins) % 2]
                lines.append(f"{new}:" if edit == "I" else f"{after[at][2] if edit == 'K' else new}:{after[at][4]}")
            at += edit != "I"
        out.append((conv, gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def table(units):
    step = {"0s": "s", "0u": "u", "su": "u", "ua": "a", "au": "u"}

    def filled(now):
        for _ in range(4):
            for s, new in itertools.product(list(now), "ua"):
                if s + new in step:
                    made = (now[s][0] + 5, now[s][1] + "I")
                    now[step[s + new]] = min(made, now.get(step[s + new], made))
        return now
    now = filled({"0": (0, "")})
    for kind, fault in units:
        after = {}
        for s, (cost, audit) in now.items():
            ways = [(s, cost + 2, "D")]
            if fault != "x":
                more = 5 if fault else 0
                ways += [(step.get(s + kind), cost + more, "K")] + [(step.get(s + r), cost + more + 1, "R") for r in "ua"]
            for t, c, edit in ways:
                if t:
                    after[t] = min((c, audit + edit), after.get(t, (c, audit + edit)))
        now = filled(after)
    return min(v for s, v in now.items() if s in "0a")


def repaired(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows],
                                  "conv_id long, turn long, role string, text string, copies int, g string, start int")
    got = turns.repaired(frame)
    assert got.columns == COLUMNS
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_query_against_sql(query, oracle):
    got, want = query("op11_conversation_repair"), oracle("op11_conversation_repair")
    assert sorted(map(tuple, got[COLUMNS].to_numpy())) == sorted(map(tuple, want[COLUMNS].to_numpy()))
    assert (got["audit"].str.len() > 0).any()


def test_query_against_brute_force(query, sample):
    rows = [tuple(r) for r in sample("conversations").select("conv_id", "turn", "role", "text").collect()]
    got = query("op11_conversation_repair")
    assert sorted((tuple(r) for r in got[COLUMNS].itertuples(index=False)), key=str) == plain(rows)


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 3, "user", "x"), (1, None, "user", "Hi."), (1, None, "assistant", "Hi."),
            (1, 5, "", "."), (2, 0, "user", "w" * 100_000 + "?"), (2, 0, "user", "w" * 100_000 + "?"), (2, -9, "system", "\t\x0b "),
            (2, 4, "tool", "No"), (3, 1, "Assistant", "é!\n"), (4, 2 ** 62, "user", "a."), (4, 7, "user", "a."), (5, 1, "sam", "ok.\n\n")]
    rows += [(c, t, r, x) for c in range(20, 60) for t, (r, x) in enumerate([("user", "Q?"), ("assistant", "A."), ("user", "Q?")])]
    assert repaired(spark, rows) == plain(rows)
    assert repaired(spark, []) == []


@pytest.mark.parametrize("equal", [False, True])
def test_a_conversation_of_many_blocks(spark, monkeypatch, equal):
    monkeypatch.setattr(turns, "_BLOCK", 16)
    monkeypatch.setattr(turns, "_JOINED", 3)
    pick = random.Random(6)
    rows = [(7, None if equal else t // 2, "user" if equal else pick.choice(["user", "assistant", "system", "user", "assistant", "tool"]),
             "Same." if equal else pick.choice(["One.", "Two", " ", f"n{t}.", f"m{t}"])) for t in range(700)]
    rows += [(8, 1, "user", "Hi."), (8, 2, "assistant", "Ho.")]
    assert repaired(spark, rows) == plain(rows)

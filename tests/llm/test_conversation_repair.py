"""Conversation repair against an exhaustive search over all edits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from corvane.llm import conversation_repair as repair
from corvane.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
BLANK = " \t\n\x0b\x0c\r"
CONV = "conv_id bigint, turn bigint, role string, text string, cost string, audit int, kind string, piece string"


def edits(rows):
    """All (cost, audit, repaired) with at most two insertions at a place."""
    inserts = [i for n in range(3) for i in itertools.product(("user", "assistant"), repeat=n)]

    def walk(at):
        for added in inserts:
            head = (3 * len(added), "I" * len(added), [(r, "") for r in added])
            if at == len(rows):
                yield head
                continue
            role, text, fault = rows[at]
            extra = 3 * (fault == "t")
            own = [(4, "D", [])]
            if fault != "x":
                own += [(extra, "K", [(role, text)])] + [(3 + extra, "R", [(r, text)]) for r in ("user", "assistant")]
            for (c, a, r), (c2, a2, r2) in itertools.product(own, tails[at + 1]):
                yield head[0] + c + c2, head[1] + a + a2, head[2] + r + r2

    tails = {}
    for at in range(len(rows), -1, -1):
        tails[at] = list(walk(at))
    legal = [e for e in tails[0] if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "?" for r, _ in e[2]))]
    return min(legal, key=lambda e: e[:2])


def by_cost(rows):
    """As ``edits`` for longer conversations: a search over (row, state) for the least (cost, audit)."""
    best = {}

    def least(at, state):
        if (at, state) not in best:
            found = []
            for n in range(3):
                q = state
                for _ in range(n):
                    q = {0: 2, 1: 2, 2: 3, 3: 2}[q]
                if at == len(rows):
                    if q in (0, 3):
                        found.append((3 * n, "I" * n))
                    continue
                role, fault = rows[at]
                extra = 3 * (fault == "t")
                moves = [(4, "D", q)]
                if fault != "x":
                    moves.append((3 + extra, "R", {0: 2, 1: 2, 2: 3, 3: 2}[q]))
                    to = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((q, role))
                    if to:
                        moves.append((extra, "K", to))
                for c, a, to in moves:
                    rest = least(at + 1, to)
                    found.append((3 * n + c + rest[0], "I" * n + a + rest[1]))
            best[at, state] = min(found)
        return best[at, state]

    for at in range(len(rows), -1, -1):
        for state in range(4):
            least(at, state)
    return best[0, 0]


def brute(table, search):
    """The contract's columns per conversation, in plain Python."""
    out, kept = {c: [] for c, *_ in table}, []
    for c, turn, role, text in table:
        say = lambda v: " " if v is None else str(v)
        fault = zlib.crc32(f"{say(c)}:{say(turn)}".encode()) % 20
        role, text = say(role), say(text)
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out[c] += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    for c, rows in out.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2][:32].encode(),
                                 hashlib.sha256(r[2].encode()).digest()))
        seen, faults = set(), []
        for _, role, text in rows:
            core = text.rstrip(BLANK)
            faults.append("b" if not core else "d" if (role, text) in seen else "t" if core[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, *_ in rows if t is not None]
        pairs = zip(rows, rows[1:])
        cost, audit, lines = search([(r, t, "x" if f in ("b", "d") else f) for (_, r, t), f in zip(rows, faults)])
        kept.append((
            c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"),
            faults.count("t"), sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()))
    return kept


def applied(rows):
    """The repaired rows that the cheapest audit makes."""
    cost, audit = by_cost([(r[:1], f) for r, _, f in rows])
    lines, state, left = [], 0, iter(rows)
    nxt = {0: 2, 1: 2, 2: 3, 3: 2}
    for letter in audit:
        if letter == "I":
            state = nxt[state]
            lines.append(({2: "user", 3: "assistant"}[state], ""))
            continue
        role, text, _ = next(left)
        if letter == "K":
            state = {"s": 1, "u": 2, "a": 3}[role[:1]]
            lines.append((role, text))
        elif letter == "R":
            state = nxt[state]
            lines.append(({2: "user", 3: "assistant"}[state], text))
    return cost, audit, lines


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def report(spark, table):
    df = spark.createDataFrame([(*r, "c", 1, "k", "p") for r in table], CONV)
    return {tuple(r) for r in repair.repair_report(df).select(*COLUMNS).collect()}


def test_weights_equal_exhaustive_search():
    draw = random.Random(1)
    for _ in range(60):
        rows = [(draw.choice(["system", "user", "assistant", "tool", ""]), "x", draw.choice(["", "", "t", "x"]))
                for _ in range(draw.randint(0, 3))]
        cost, audit, _ = edits(rows)
        classes = [(r[:1], f) for r, _, f in rows]
        assert repair.cheapest(classes) == (cost, audit) == by_cost(classes)


@pytest.mark.parametrize("size", [1, 2, 7])
def test_maps_compose_at_any_cut(size):
    draw = random.Random(size)
    for _ in range(40):
        rows = [(draw.choice("suax"), draw.choice(["", "", "t", "x"])) for _ in range(draw.randint(1, 20))]
        maps = [repair.block_map(rows[at:at + size]) for at in range(0, len(rows), size)]
        assert repair.ended(repair.joined_all(maps)) == repair.cheapest(rows) == by_cost(rows)


def test_edge_cases_equal_brute_force(spark):
    draw = random.Random(3)
    texts = ["Fine.", "Cut", "", " \t", None, "Why?", "a" * 40 + "1.", "a" * 40 + "2.", "é \U0001f642!", "x\x0c."]
    table = [(draw.choice([None, -5, *range(40)]), draw.choice([None, *range(6)]),
              draw.choice(["user", "assistant", "system", "tool", None, "", "User"]), draw.choice(texts))
             for _ in range(300)]
    table += [(77, 1, "user", "long " * 30_000)] * 2 + [(78, -2**63, "user", "A."), (78, 2**63 - 1, "user", "A.")]
    want = {(r[0], min(r[1], 2**63 - 1), *r[2:]) for r in brute(table, applied)}
    assert report(spark, table) == want
    assert report(spark, []) == set()


def test_long_conversation_is_cut_into_pieces(spark):
    """One conversation over several pieces beside small ones, with runs of equal rows."""
    draw = random.Random(4)
    table = [(1, t if t % 7 else None, draw.choice(["user", "assistant", "system"]), draw.choice(["Same.", f"No {t}", f"Is {t}."]))
             for t in range(5_000)] + [(c, t, "user", "Hi.") for c in (0, 2, 3) for t in range(3)]
    df = spark.createDataFrame(table, "conv_id bigint, turn bigint, role string, text string").repartition(7)
    got = {r.conv_id: r for r in repair.repair_report(df).collect()}
    for row in brute(table, applied):
        assert tuple(got[row[0]][c] for c in COLUMNS) == row
    whole = {r.conv_id: r for r in repair.summaries(repair.damaged(df), piece_bits=5, fan_in=3).collect()}
    assert len(whole) == 4 and repair.ended(list(zip(whole[1].costs, whole[1].audits))) == (got[1].cost, got[1].audit)
    assert (whole[1].blank, whole[1].duplicate, whole[1].illegal) == (got[1].blank, got[1].duplicate, got[1].illegal)


def test_query_equals_brute_force(spark):
    from corvane.llm.common import table

    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = {tuple(r) for r in QUERIES["op11_conversation_repair"](spark, SF).select(*COLUMNS).collect()}
    assert got == set(brute(rows, applied))

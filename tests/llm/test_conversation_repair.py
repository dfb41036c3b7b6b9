from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from auditlake.llm import queries
from auditlake.llm.conversation_repair import EMPTY, ENDS, Row, damage, joined, repair, search, transfers

SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def outcomes(rows, gap=2):
    """(cost, audit, roles) of every way to edit a few rows, with up to two insertions in each place."""
    slots = [list(itertools.product("ua", repeat=n)) for n in range(gap + 1)]
    places = [x for n in slots for x in n]
    choices = []
    for r in rows:
        own = [(4, "D", "")]
        if not r.must_go:
            extra = 3 if r.truncated else 0
            own += [(extra, "K", r.initial or "?"), (3 + extra, "R", "u"), (3 + extra, "R", "a")]
        choices.append(own)
    for put in itertools.product(places, repeat=len(rows) + 1):
        for edits in itertools.product(*choices):
            cost, audit, roles = 0, "", ""
            for p, e in itertools.zip_longest(put, edits):
                cost, audit, roles = cost + 3 * len(p), audit + "I" * len(p), roles + "".join(p)
                if e:
                    cost, audit, roles = cost + e[0], audit + e[1], roles + e[2]
            if LEGAL.match(roles):
                yield cost, audit, roles


FACTS = st.lists(st.builds(Row, st.sampled_from(["s", "u", "a", "x", ""]), st.booleans(), st.booleans()), max_size=3)


@given(FACTS)
@settings(max_examples=60, deadline=None)
def test_search_finds_the_least_of_all_repairs(rows):
    assert search(rows) == min(outcomes(rows))[:2]


def least(rows):
    """The same by a table of prefixes, for long conversations."""
    paths = {"": (0, "")}

    def grown(paths):
        for _ in range(3):
            for role, (cost, audit) in list(paths.items()):
                to = "a" if role == "u" else "u"
                paths[to] = min(paths.get(to, (1 << 40, "")), (cost + 3, audit + "I"))
        return paths

    grown(paths)
    for r in rows:
        new = {}

        def put(role, cost, audit):
            new[role] = min(new.get(role, (1 << 40, "")), (cost, audit))

        for role, (cost, audit) in paths.items():
            put(role, cost + 4, audit + "D")
            if r.must_go:
                continue
            extra = 3 if r.truncated else 0
            put("a" if role == "u" else "u", cost + 3 + extra, audit + "R")
            if r.initial and role + r.initial in ("s", "u", "su", "au", "ua"):
                put(r.initial, cost + extra, audit + "K")
        paths = grown(new)
    return min(paths[k] for k in ("", "a") if k in paths)


@given(st.lists(st.builds(Row, st.sampled_from("suax"), st.booleans(), st.booleans()), max_size=40), st.integers(1, 9))
@settings(max_examples=150, deadline=None)
def test_segments_give_what_the_whole_gives(rows, size):
    whole = search(rows)
    assert whole == least(rows)
    table = None
    for at in range(0, len(rows), size):
        part = transfers(rows[at : at + size])
        table = part if table is None else joined(table, part)
    if table is not None:
        assert min(table[EMPTY, b] for b in ENDS if (EMPTY, b) in table) == whole


def damaged(rows):
    out, ids = [], {}
    for conv, turn, role, text in rows:
        ids.setdefault(conv, None)
        name = lambda x: " " if x is None else str(x)
        what = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        if what == 1:
            text = ""
        if what == 2:
            text = re.sub("[.!?]", "", text)
        if what == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if what == 0 else 2 if what == 3 else 1)
    return out, ids


def expected(rows):
    """The contract's row of each conversation, by brute force."""
    found, ids = damaged(rows)
    out = {}
    for conv in ids:
        mine = [r for r in found if r[0] == conv]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        facts, seen, counts = [], set(), {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
        for _, _, role, text in mine:
            body = text.strip(" \t\n\v\f\r")
            kind = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            counts[kind] += 1
            facts.append(Row(role[:1], kind in ("blank", "duplicate"), kind == "truncated"))
        cost, audit = least(facts)
        lines, at = [], 0
        for letter in audit:
            role = "assistant" if lines and lines[-1][:1] == "u" else "user"
            text = ""
            if letter != "I":
                role, text = (mine[at][2] if letter == "K" else role), mine[at][3]
                at += 1
            if letter != "D":
                lines.append(f"{role}:{text}")
        turns = {r[1] for r in mine if r[1] is not None}
        pairs = [a[2][:1] + b[2][:1] for a, b in itertools.pairwise(mine)]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            counts["blank"], counts["duplicate"], counts["truncated"],
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def conversations(seed, n):
    rng, rows = random.Random(seed), []
    texts = ["Hello there.", "No end", "  ", "", "What? ", "Fine!\n", "ñandú 你好。", "So. ", "x" * 3000 + "."]
    for conv in [None, *range(n)]:
        for turn in range(rng.choice([1, 2, 3, 5, 8, 40])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", None, "", "User", "tool"])
            rows.append((conv, rng.choice([turn, turn, turn, None, turn + 2]), role, rng.choice([*texts, None, f"{turn}."])))
    # One conversation of many rows, one with the same row throughout.
    rows += [(n, k, rng.choice(["user", "assistant"]), rng.choice(["a.", "b.", f"{k}.", f"{k}"])) for k in range(300)]
    rows += [(n + 1, 5, "user", "again.")] * 100
    return rows


def result(df):
    return {r.conv: tuple(r)[1:] for r in df.collect()}


def test_every_conversation_is_repaired_as_by_brute_force(spark):
    rows = conversations(1, 40)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS conv", "2 AS id", "3 AS key", "4 AS kind")
    hurt = damage(df, "conv_id", "turn", "role", "text")
    want = expected(rows)
    assert result(repair(hurt, "conv_id", "turn", "role", "text")) == want
    # The way of long conversations, for those of more than 7 rows.
    assert result(repair(hurt, "conv_id", "turn", "role", "text", segment=7)) == want


def test_messages_are_those_of_the_digest(spark):
    rows = conversations(2, 6)
    df = spark.createDataFrame(rows, SCHEMA)
    sums = result(repair(df, "conv_id", "turn", "role", "text", segment=9))
    found: dict = {}
    for r in repair(df, "conv_id", "turn", "role", "text", segment=9, messages=True).orderBy("place").collect():
        found.setdefault(r.conv, []).append(f"{r.role}:{r.text}")
    for conv, values in sums.items():
        assert values[-1] == hashlib.sha256("\n".join(found.get(conv, [])).encode()).hexdigest()
        assert LEGAL.match("".join(line[:1] for line in found.get(conv, [])))


def test_no_rows_and_only_dropped_rows(spark):
    assert repair(spark.createDataFrame([], SCHEMA), "conv_id", "turn", "role", "text").count() == 0
    gone = [(c, t, "user", "Hi.") for c in range(50) for t in range(30) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    df = damage(spark.createDataFrame(gone, SCHEMA), "conv_id", "turn", "role", "text")
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert set(result(repair(df, "conv_id", "turn", "role", "text")).values()) == {nothing}
    assert set(result(repair(df, "conv_id", "turn", "role", "text", segment=1)).values()) == {nothing}


def test_query_over_its_whole_table(spark, tmp_path):
    rows = conversations(3, 30)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.QUERIES["op11_conversation_repair"](spark, str(tmp_path))
    assert {r.conv_id: tuple(r)[1:] for r in found.collect()} == expected(rows)

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import product

import pyarrow.parquet as pq
import pytest

from llm_rows import SF_SMALL
from ladle.llm import conversations as cv
from ladle.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
CORE = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    """The contract's faults, in plain Python."""
    out = []
    for conv, turn, role, text in rows:
        spell = lambda x: " " if x is None else str(x)
        role, text = spell(role), spell(text)
        fault = zlib.crc32(f"{spell(conv)}:{spell(turn)}".encode()) % 20
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if fault == 3 else 1)
    return out


def follow(state):
    """Roles as a string so far -> the role an insert or rerole gives."""
    return "a" if state.endswith("u") else "u"


def legal(s):
    return re.fullmatch("(s?(ua)+)?", s) is not None


def brute(rows):
    """One conversation: every audit's (cost, letters) over states told by the roles kept, longest first removed."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, faults = set(), []
    for _, _, role, text in rows:
        core = CORE.findall(text)
        faults.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    best = {"": (0, "", ())}  # last roles -> cheapest, least

    def inserted(table):
        for _ in range(3):
            for s, (cost, audit, turns) in list(table.items()):
                role = follow(s)
                add(table, role, (cost + 2, audit + "I", (*turns, ({"u": "user", "a": "assistant"}[role], ""))))
        return table

    def add(table, state, value):
        if state not in table or value[:2] < table[state][:2]:
            table[state] = value

    for (_, _, role, text), fault in zip(rows, faults):
        new = {}
        for s, (cost, audit, turns) in inserted(best).items():
            add(new, s, (cost + 3, audit + "D", turns))
            if fault in ("blank", "duplicate"):
                continue
            late = fault == "truncated"
            r = follow(s)
            add(new, r, (cost + 2 + late, audit + "R", (*turns, ({"u": "user", "a": "assistant"}[r], text))))
            i = role[:1]
            if (i == "s" and s == "") or (i in ("u", "a") and i == follow(s)):
                add(new, i, (cost + late, audit + "K", (*turns, (role, text))))
        best = new
    cost, audit, turns = min(v for s, v in inserted(best).items() if s in ("", "a"))
    assert legal("".join(r[0] for r, _ in turns))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()
    return (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest), turns


def expected(rows, ids):
    of = defaultdict(list)
    for r in rows:
        of[r[0]].append(r)
    return {k: brute(of[k])[0] for k in ids}


def as_dict(df):
    rows = df.collect()
    got = {r[0]: tuple(r)[1:] for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("sf_dir", [SF_SMALL, "/root/testdata/sf0.01"])
def test_whole_table_against_brute_force(spark, sf_dir):
    rows = [tuple(r.values()) for r in pq.read_table(f"{sf_dir}/conversations.parquet").select(
        ["conv_id", "turn", "role", "text"]).to_pylist()]
    got = QUERIES["op12_conversations"](spark, sf_dir)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert as_dict(got) == expected(damaged(rows), {r[0] for r in rows})


ODD = [(None, None, None, None), (None, 3, "user", "hi."), (1, None, "user", "x."), (1, None, "assistant", "y"), (1, 2, "", "z."),
       (1, 2, "", "z."), (2, 0, "System", "s."), (3, 0, "system", "Go."), (3, 0, "system", "Go."), (3, 9, "tool", "q!  \n"),
       (4, 0, "user", "é" * 30000 + "."), (4, 1, "assistant", "ok?"), (5, 0, "", ""), (6, 1, "user", "same."), (6, 5, "user", "same."),
       (6, 7, "assistant", "same."), (7, 0, "assistant", "a."), (7, 1, "user", "u."), (8, -5, "s", ". x"), (8, 5, "a", " \v.\f ")]


def test_odd_rows(spark):
    df = spark.createDataFrame(ODD, SCHEMA).repartition(3)
    assert as_dict(cv.repair(cv.damage(df), copies="copies")) == expected(damaged(ODD), {r[0] for r in ODD})
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in ODD]
    assert as_dict(cv.repair(df)) == expected(plain, {r[0] for r in ODD})


def test_all_rows_dropped_and_empty_table(spark):
    df = spark.createDataFrame([(5, 0, "user", "x.", 0), (5, 1, "user", "y.", 0)], SCHEMA + ", copies long")
    empty = hashlib.sha256(b"").hexdigest()
    assert as_dict(cv.repair(df, copies="copies")) == {5: (0, 0, 0, 0, 0, 0, "", empty)}
    assert cv.repair(df.limit(0)).count() == 0 and cv.repaired_turns(df.limit(0)).count() == 0


def test_extra_columns_with_clashing_names(spark):
    names = ["key", "n", "d", "ord", "said", "first", "known", "copies_", "codes", "fault", "m", "has"]
    df = spark.createDataFrame(ODD, SCHEMA).selectExpr("*", *[f"{i} AS {c}" for i, c in enumerate(names)])
    assert as_dict(cv.repair(cv.damage(df), copies="copies")) == expected(damaged(ODD), {r[0] for r in ODD})


def big_conversation(n, seed):
    rng = random.Random(seed)
    return [(1, t // 3, rng.choice(["user", "assistant", "system", "tool", "user", "assistant"]),
             rng.choice(["a.", "b", "", "c!", f"t{t}.", f"u{t}", f"v{t}?", f"w{t}."])) for t in range(n)]


@pytest.mark.parametrize("piece", [1, 2, 7, 64])
def test_one_conversation_in_many_pieces(spark, piece):
    """One key holds nearly all rows: it is cut, solved in pieces, and gives what brute force gives."""
    rows = big_conversation(300, piece) + [(2, 0, "user", "x."), (3, 0, "system", "y.")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    whole, pieces = cv.repair_parts(df, piece_rows=piece)
    assert pieces.where("key = 1").count() >= 100 / piece
    assert as_dict(cv.repair(df, piece_rows=piece)) == expected(rows, {1, 2, 3})
    turns = [(r.role, r.text) for r in cv.repaired_turns(df, piece_rows=piece).where("conv_id = 1").orderBy("ord", "pos").collect()]
    assert turns == list(brute([r for r in rows if r[0] == 1])[1])


def test_equal_rows_are_counted_not_shuffled(spark):
    """A third of all rows are one row; they reach the pieces as one row with a count."""
    df = spark.range(60000).selectExpr("1L AS conv_id", "5L AS turn", "'user' AS role", "'same.' AS text")
    (r,) = cv.repair(df).collect()
    assert (r.duplicate, r.cost, r.illegal) == (59999, 59999 * 3 + 2, 59999)
    assert len(r.audit) == 60001 and set(r.audit) == {"D", "I", "K"}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4])
def test_meeting_in_the_middle_against_every_audit(n):
    """All code strings of a length: the least letters of Hirschberg's recursion against a full forward search."""
    for codes in product([0, 1, 2, 3, 4, 6], repeat=n):
        table = {cv.START: (0, "")}
        for c in codes:
            new = {}
            for s, (cost, audit) in table.items():
                for t, x, w in cv.STEPS[c][s]:
                    new[t] = min(new.get(t, (1 << 60, "")), (cost + x, audit + w))
            table = new
        want = min((cost + cv.ACCEPT[s], audit + cv.closing(s)) for s, (cost, audit) in table.items())
        assert cv.solve(bytes(codes)) == want

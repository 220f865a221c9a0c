"""Repaired conversations beside a plain search over whole letters."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from quadloom.llm import conversations

SPACE = " \t\n\v\f\r"


def damage(rows):
    """What the contract does to (conv_id, turn, role, text), in order of conversations."""
    out = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        out += [(conv, turn, role, text)] * (2 if fault == 3 else 1)
    return out


def faults_of(rows):
    """The first fault of each (role, text)."""
    seen, found = set(), []
    for role, text in rows:
        bare = text.strip(SPACE)
        if not bare:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        elif bare[-1] not in ".!?":
            found.append("truncated")
        else:
            found.append("")
        seen.add((role, text))
    return found


def cheapest(rows, faults):
    """(cost, letters, repaired rows): whole letters are kept for every state."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    def insertions(now):
        for _ in range(4):
            for state, (cost, edits, out) in list(now.items()):
                for to in after[state]:
                    if to != "s":
                        offer = (cost + 3, edits + "I", (*out, (name[to], "")))
                        if to not in now or offer[:2] < now[to][:2]:
                            now[to] = offer
        return now

    now = {"": (0, "", ())}
    for (role, text), fault in zip(rows, faults, strict=True):
        # of each state all that insertions reach: the least letters after a row need not be the least before it
        reached, ways = now, []
        for state, (cost, edits, out) in reached.items():
            ways.append((state, cost, edits, out))
            for _ in range(3):
                state = "u" if state in ("", "s", "a") else "a"
                cost, edits, out = cost + 3, edits + "I", (*out, (name[state], ""))
                ways.append((state, cost, edits, out))
        now = {}
        for state, cost, edits, out in ways:
            offers = [(state, (cost + 4, edits + "D", out))]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                if role[:1] and role[0] in after[state]:
                    offers.append((role[0], (cost + more, edits + "K", (*out, (role, text)))))
                for to in after[state]:
                    if to != "s":
                        offers.append((to, (cost + 3 + more, edits + "R", (*out, (name[to], text)))))
            for to, offer in offers:
                if to not in now or offer[:2] < now[to][:2]:
                    now[to] = offer
    return min(insertions(now)[s] for s in ("", "a") if s in now or s in insertions(now))


def order(row):
    none = lambda x: (x is not None, x)
    return none(row[0]), none(row[1]), row[2].encode(), row[3].encode()


def expected(rows):
    """The rows of the query for whole tables of (conv_id, turn, role, text)."""
    left, found = sorted(damage(rows), key=order), {}
    for conv in {r[0] for r in rows}:
        own = [r for r in left if r[0] == conv]
        pairs = [(r[2], r[3]) for r in own]
        faults = faults_of(pairs)
        cost, edits, out = cheapest(pairs, faults)
        turns = {r[1] for r in own if r[1] is not None}
        found[conv] = (
            conv,
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(pairs)),
            cost,
            edits,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
        )
    return sorted(found.values(), key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_division_finds_what_a_plain_search_finds(seed):
    random.seed(seed)
    for _ in range(150):
        n = random.randrange(0, 40)
        faults = random.choices(["", "blank", "duplicate", "truncated"], [6, 1, 1, 2], k=n)
        pairs = [(random.choice(["system", "user", "user", "assistant", "assistant", "tool", ""]), f"t{i}") for i in range(n)]
        cost, edits, _ = cheapest(pairs, faults)
        codes = bytes(65 + 4 * ["", "blank", "duplicate", "truncated"].index(f) + ("sua".find(r[:1]) if r else -1) % 4 for (r, _), f in zip(pairs, faults, strict=True))
        total, vector = conversations.forward(codes, conversations.only(0))
        end = conversations.crossing(vector, (0, 6, 3, 0))
        found = conversations.letters(codes, 0, end) + "I" * ((0, 6, 3, 0)[end] // 3)
        assert (total + vector[end][0] + (0, 6, 3, 0)[end], found) == (cost, edits)


def test_every_sequence_of_letters():
    """The least of all sequences of letters whatever, for short conversations."""
    random.seed(5)
    for _ in range(12):
        n = random.randrange(1, 4)
        faults = random.choices(["", "blank", "truncated"], [4, 1, 2], k=n)
        roles = random.choices("suax", k=n)
        best = None
        for inserts in itertools.product(range(3), repeat=n + 1):
            for edits in itertools.product("DKR", repeat=n):
                out, cost = "", 0
                for i in range(n):
                    for _ in range(inserts[i]):
                        out, cost = out + ("a" if out.endswith("u") else "u"), cost + 3
                    if edits[i] == "D":
                        cost += 4
                        continue
                    if faults[i] == "blank":
                        break
                    cost += (3 if faults[i] == "truncated" else 0) + (3 if edits[i] == "R" else 0)
                    out += roles[i] if edits[i] == "K" else "a" if out.endswith("u") else "u"
                else:
                    for _ in range(inserts[n]):
                        out, cost = out + ("a" if out.endswith("u") else "u"), cost + 3
                    if re.fullmatch("(s?(ua)+)?", out):
                        text = "".join("I" * k + e for k, e in zip(inserts, edits, strict=False)) + "I" * inserts[n]
                        best = min(best or (cost, text), (cost, text))
        pairs = [(r, "t" * (i + 1)) for i, r in enumerate(roles)]
        assert cheapest(pairs, faults)[:2] == best


def test_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert got(conversations.digests(table)) == expected(rows)


def test_edges_and_extra_columns(spark):
    rows = [
        (None, 1, "user", "Hello."),
        (None, None, None, None),
        (1, 0, "system", "A."),
        (1, 0, "system", "A."),
        (1, 0, "assistant", "B"),
        (1, 1, "user", " \t"),
        (1, 7, "", "c!"),
        (1, 9, "user", "x" * 300_000 + "!"),
        (2, None, "assistant", None),
        (2, None, "user", ""),
        (3, 5, "ufo", "Kept?"),
        (3, 6, "a", "é" * 70 + "1."),
        (3, 6, "a", "é" * 70 + "2."),
        *((4, n // 2, "user", "again.") for n in range(60)),
        *((5, n, ("user", "assistant")[n % 2], f"{n}.") for n in range(40)),
    ]
    clash = "conv_id long, turn long, role string, text string, at string, block string, codes string, Audit string, kind string, fault string, own string"
    df = spark.createDataFrame([(*r, *["z"] * 7) for r in rows], clash)
    mine, wanted = got(conversations.digests(df)), expected(rows)
    # texts alike in 64 characters are in the order of their hashes
    assert [r[:-1] for r in mine] == [r[:-1] for r in wanted]
    assert [r for r in mine if r[0] != 3] == [r for r in wanted if r[0] != 3]
    assert conversations.digests(df.where("false")).count() == 0
    assert conversations.repair(df.where("false")).count() == 0


def test_long_conversation_over_many_blocks(spark, monkeypatch):
    """One conversation with most rows, in blocks of eight: the same as a plain search."""
    random.seed(9)
    monkeypatch.setattr(conversations, "BLOCK_BITS", 3)
    roles = ["user", "assistant", "user", "assistant", "system", "tool"]
    rows = [(7 if n % 5 else n, n // 3, random.choice(roles), random.choice(["So.", "Or", "", f"own {n}.", f"own {n}"])) for n in range(900)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    assert got(conversations.digests(df)) == expected(rows)


def test_repaired_rows(spark):
    rows = [("k", 0, "assistant", "Hi."), ("k", 1, "assistant", "Cut"), ("k", 2, "user", "So?"), ("k", 3, "user", "So?")]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    found = conversations.repair(df).orderBy("place").select("place", "edit", "role", "text").collect()
    audit = conversations.audits(df).first()
    assert "".join(r.role[0] for r in found) in ("", "ua", "uaua")
    joined = "\n".join(f"{r.role}:{r.text}" for r in found)
    assert hashlib.sha256(joined.encode()).hexdigest() == audit.repaired_sha256
    assert "".join(r.edit for r in found) == audit.audit.replace("D", "")
    assert found[0].place == 0 and conversations.repair(df).agg(F.count("*")).first()[0] == len(found)

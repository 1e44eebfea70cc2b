import hashlib
import itertools
import random
import re
import zlib

import pytest

from airq.llm import conversation as c
from airq.llm.queries import QUERIES

SHAPE = re.compile(r"(s?(ua)+)?")
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def repair_by_hand(rows):
    """All edits of all rows, inserts between them as needed: the cheapest, then the least audit, with its messages."""
    found = faults(rows)
    best = None
    choices = [[("D", 4, None)] if f in ("blank", "duplicate") else [("D", 4, None), *([("K", 0, r)] if r else []), ("R", 3, "user"), ("R", 3, "assistant")] for (r, _), f in zip(rows, found)]
    for picks in itertools.product(*choices):
        for fills in itertools.product(["", "u", "a", "ua", "au"], repeat=len(rows) + 1):
            shape, audit, price, messages = "", "", 0, []
            for i in range(len(rows) + 1):
                for f in fills[i]:
                    shape, audit, price = shape + f, audit + "I", price + 3
                    messages.append(("user" if f == "u" else "assistant") + ":")
                if i < len(rows):
                    letter, cost, role = picks[i]
                    audit, price = audit + letter, price + cost
                    if letter != "D":
                        price += 3 * (found[i] == "truncated")
                        shape += role[:1]
                        messages.append(f"{role}:{rows[i][1]}")
            if SHAPE.fullmatch(shape) and (best is None or (price, audit) < best[:2]):
                best = (price, audit, messages)
    return best


def plain_dp(rows):
    """A shortest path with whole audits as strings."""
    states = {"": (0, "")}
    follow = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def fill(at):
        for _ in range(4):
            for (p, r), q in follow.items():
                if p in at and r != "s":
                    at[q] = min(at.get(q, (1 << 60, "")), (at[p][0] + 3, at[p][1] + "I"))
        return at

    states = fill(states)
    for (role, _), fault in zip(rows, faults(rows)):
        new = {p: (x + 4, a + "D") for p, (x, a) in states.items()}
        if fault not in ("blank", "duplicate"):
            cut = 3 * (fault == "truncated")
            for (p, r), q in follow.items():
                if p in states:
                    x, a = states[p]
                    if r == role[:1]:
                        new[q] = min(new.get(q, (1 << 60, "")), (x + cut, a + "K"))
                    if r != "s":
                        new[q] = min(new.get(q, (1 << 60, "")), (x + cut + 3, a + "R"))
        states = fill(new)
    return min(states[q] for q in ("", "a") if q in states)


def repair(rows):
    messages = []
    work = c.Repair(lambda edit, turn, role, text: messages.append(f"{role}:{text}"))
    for turn, (role, text) in enumerate(rows):
        work.add(turn, role, text)
    return work.finish(), messages


def random_rows(dice, n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", " ", ""]
    return [(dice.choice(roles), dice.choice(["Yes.", "No!", "why", "", " \n", f"t{dice.random()}.", f"x{dice.random()} "])) for _ in range(n)]


def test_against_all_edits():
    dice = random.Random(4)
    for _ in range(60):
        rows = random_rows(dice, dice.randint(0, 3))
        found, messages = repair(rows)
        price, audit, want = repair_by_hand(rows)
        assert (found.cost, found.audit, messages) == (price, audit, want), rows
        assert found.repaired_sha256 == hashlib.sha256("\n".join(want).encode()).hexdigest()


@pytest.mark.parametrize("settle", [1, 3, 1024])
def test_against_whole_strings(settle, monkeypatch):
    """Settling early changes nothing."""
    monkeypatch.setattr(c, "SETTLE_ROWS", settle)
    dice = random.Random(settle)
    for _ in range(300):
        rows = random_rows(dice, dice.randint(0, 40))
        found, messages = repair(rows)
        assert (found.cost, found.audit) == plain_dp(rows)
        assert SHAPE.fullmatch("".join(m[0] for m in messages))
        counts = faults(rows)
        assert (found.blank, found.duplicate, found.truncated) == tuple(counts.count(f) for f in ("blank", "duplicate", "truncated"))


def test_colliding_hashes_are_verified(monkeypatch):
    """With two hash values almost all prefixes collide; the order of audits stays that of their letters."""
    monkeypatch.setattr(c, "PRIME", 2)
    dice = random.Random(9)
    for _ in range(150):
        rows = random_rows(dice, dice.randint(0, 25))
        found, _ = repair(rows)
        assert (found.cost, found.audit) == plain_dp(rows)


def test_order_of_audits():
    dice = random.Random(8)
    nodes = [c.Node(None, "")]
    for _ in range(400):
        nodes.append(c.Node(dice.choice(nodes), dice.choice("KRDI")))
    for _ in range(3000):
        a, b = dice.choice(nodes), dice.choice(nodes)
        assert c.before(a, b) == (c.letters(a) < c.letters(b))
        depth = dice.randint(0, a.depth)
        assert c.letters(c.ancestor(a, depth)) == c.letters(a)[:depth]


def test_long_conversation_stays_small():
    """Rows that are settled are forgotten."""
    work = c.Repair(lambda *message: None)
    widest = 0
    for i in range(30_000):
        work.add(i, ("user", "assistant", "user", "tool")[i % 4], f"text {i}.")
        widest = max(widest, len(work.rows), *(n.depth for n in work.node if n is not None))
    assert widest <= 2 * c.SETTLE_ROWS + 10
    found = work.finish()
    assert len([e for e in found.audit if e != "I"]) == 30_000 and found.gaps == 0


def damage_by_hand(table):
    out = {}
    for r in table:
        rows = out.setdefault(r.conv_id, [])
        key = f"{' ' if r.conv_id is None else r.conv_id}:{' ' if r.turn is None else r.turn}"
        fault = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (r.role, r.text))
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        rows += [(r.turn, role, text)] * (2 if fault == 3 else 1)
    for rows in out.values():
        rows.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
    return out


def assert_query(rows, table):
    got = {r.conv_id: r for r in rows}
    want = damage_by_hand(table)
    assert len(rows) == len(want) and got.keys() == want.keys()
    for key, damaged in want.items():
        r = got[key]
        plain = [x[1:] for x in damaged]
        found = faults(plain)
        turns = [x[0] for x in damaged if x[0] is not None]
        assert (r.cost, r.audit) == plain_dp(plain)
        assert (r.blank, r.duplicate, r.truncated) == tuple(found.count(f) for f in ("blank", "duplicate", "truncated"))
        assert r.gaps == (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0)
        assert r.illegal == sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(plain, plain[1:]))
        assert r.repaired_sha256 == hashlib.sha256("\n".join(apply(plain, r.audit)).encode()).hexdigest()


def apply(rows, audit):
    """The messages of an audit: roles of edited and inserted rows follow from what comes before them."""
    out, left = [], list(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else left.pop(0)
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if out and out[-1][0][:1] == "u" else "user"
        out.append((role, text))
    return [f"{r}:{t}" for r, t in out]


def test_query_against_plain_code(spark, folder):
    table = spark.read.parquet(f"{folder}/conversations.parquet").collect()
    assert_query(QUERIES["op11_conversation"](spark, folder).collect(), table)


SCHEMA = "conv_id long, turn long, role string, text string, present string, fault int, copy int, _id int"


def test_edges(spark, tmp_path):
    """Null ids, turns, roles and texts, repeated rows and turns, a long text, conversations that lose all rows."""
    long = "word " * 400_000
    rows = [(i, t, r, f"text {i} {t}.") for i in range(150) for t, r in ((0, "user"), (1, "assistant"))][:299]
    rows += [(None, 1, "user", "a."), (None, None, None, None), (200, None, "user", "x."), (200, None, "assistant", "y."), (201, 5, "", "z.")]
    rows += [(202, 3, "user", long), (202, 3, "assistant", "w."), (203, 2, "user", "same.")] + [(203, 2, "user", "same.")] * 4
    df = spark.createDataFrame([(*r, "p", 1, 2, 3) for r in rows], SCHEMA)
    path = str(tmp_path)
    df.write.parquet(f"{path}/conversations.parquet")
    assert_query(QUERIES["op11_conversation"](spark, path).collect(), df.collect())
    df.where("false").write.parquet(f"{path}/none/conversations.parquet")
    none = QUERIES["op11_conversation"](spark, f"{path}/none")
    assert none.columns == ["conv_id", *c.SUMMARY] and none.count() == 0


def test_messages(spark):
    df = spark.createDataFrame([("a", 1, "assistant", "Hi."), ("a", 2, "tool", "Well."), ("b", 1, "user", "")], "conv_id string, turn int, role string, text string")
    got = sorted(tuple(r) for r in c.repaired_messages(df).collect())
    # two new roles cost 6, an insert and a delete 7
    assert got == [("a", 0, "R", 1, "user", "Hi."), ("a", 1, "R", 2, "assistant", "Well.")]
    found = {r.conv_id: r for r in c.audit_conversations(df).collect()}
    assert found["b"].audit == "D" and found["b"].repaired_sha256 == hashlib.sha256(b"").hexdigest()

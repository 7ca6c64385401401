import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from conftest import SMALL
from pyspark.sql import types as T

from basketflow.llm import conversation_repair as c

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
VALID = re.compile(r"(s?(ua)+)?\Z")


def damage(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * (2 if fault == 3 else 1)


def cheapest(rows):
    """All edits, row by row, the best for each string of initials' end: a table of (cost, letters, text)."""
    faults, seen = [], set()
    for _, role, text in rows:
        stripped = text.strip(" \t\n\x0b\f\r")
        faults.append("blank" if not stripped else "duplicate" if (role, text) in seen else "truncated" if stripped[-1] not in ".!?" else "")
        seen.add((role, text))

    def step(state, initial):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, initial))

    def inserted(table):
        table = dict(table)
        for _ in range(2):
            for state, (cost, letters, out) in list(table.items()):
                for role in ("user", "assistant"):
                    to = step(state, role[0])
                    if to is not None:
                        table[to] = min(table.get(to, (1 << 60, "", [])), (cost + 3, letters + "I", out + [f"{role}:"]))
        return table

    table = {"": (0, "", [])}
    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for state, (cost, letters, out) in inserted(table).items():
            options = [(state, 4, "D", [])]
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                options.append((step(state, role[:1]), more, "K", [f"{role}:{text}"]))
                options += [(step(state, new[0]), 3 + more, "R", [f"{new}:{text}"]) for new in ("user", "assistant")]
            for to, extra, letter, said in options:
                if to is not None:
                    after[to] = min(after.get(to, (1 << 60, "", [])), (cost + extra, letters + letter, out + said))
        table = after
    ends = inserted(table)
    cost, letters, out = min(ends[s] for s in ("", "a") if s in ends)
    return cost, letters, out, faults


def brute(original, rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, role, text))
    out = []
    for conv in {r[0] for r in original}:
        group = sorted(groups[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        cost, audit, said, faults = cheapest(group)
        assert VALID.match("".join(x[0] for x in said))
        turns = {t for t, _, _ in group if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(group, group[1:])]
        out.append((
            conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs),
            cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


COLUMNS = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


def ours(spark, rows):
    """Repaired as they are, without damage."""
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted((tuple(r[n] for n in COLUMNS) for r in c.digests(df, c.repaired(df)).collect()), key=repr)


def plain(rows):
    return [(a, b, " " if r is None else r, " " if t is None else t) for a, b, r, t in rows]


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    out = c.op11_conversation_repair(spark, SMALL)
    assert out.columns == COLUMNS
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute(rows, list(damage(rows)))


def talk(draw, conv, n):
    roles, texts = ["system", "user", "assistant", "tool", "", None, "ustad"], ["Hi.", "Well?", "cut", "so! ", "  ", "", None, "a\nb.\n", "é漢!"]
    rows = []
    for k in range(n):
        role = draw.choice(roles[:3] if draw.random() < 0.8 else roles)
        text = draw.choice(texts) if draw.random() < 0.5 else f"{draw.randint(0, 10**6)}{draw.choice(['.', '', '?'])}"
        rows.append((conv, draw.choice([k, k, k, k + 1, None]), role, text))
    return rows


@pytest.mark.parametrize("piece", [1, 3, 4096])
def test_random_conversations(spark, monkeypatch, piece):
    """Also cut into pieces of any size, with null turns and ids, ties and copies."""
    monkeypatch.setattr(c, "PIECE_ROWS", piece)
    draw = random.Random(piece)
    rows = [r for conv in [None, *range(120)] for r in talk(draw, conv, draw.randint(1, 9))] + talk(draw, 500, 300)
    rows += [(501, 1, "user", "same.")] * 70 + [(501, 2, "assistant", "same.")] * 3
    draw.shuffle(rows)
    assert ours(spark, rows) == brute(rows, plain(rows))


def test_every_short_conversation():
    """All codes up to three rows against the table of all edits."""
    texts = {0: "x{}.", c._MUST_GO: " ", c._CUT: "x{}", c._MUST_GO | c._CUT: " "}
    for n in range(4):
        for number in range(16**n):
            codes = bytes(number // 16**k % 16 for k in range(n))
            rows = [(k, ("system", "user", "assistant", "tool")[code & 3], texts[code & 12].format(k)) for k, code in enumerate(codes)]
            rows = [(k, r, " " * (k + 1) if t == " " else t) for k, r, t in rows]
            assert c.settled(codes) == cheapest(rows)[:2]


def test_prices_and_distances():
    """Prices never exceed an arc and the price behind it, and hold with equality on some arc out of every node."""
    draw = random.Random(2)
    for _ in range(50):
        codes = bytes(draw.randrange(16) for _ in range(draw.randint(1, 40)))
        prices = c.auction(codes, c.AT_END)
        for i, code in enumerate(codes):
            for s in range(4):
                lengths = [cost + prices[i + 1][to] for _, cost, to in c._ARCS[code][s]] + [c.INSERT + prices[i][c.NEXT[s]]]
                assert prices[i][s] == min(lengths)
        between = c.distances(codes)
        for s in range(4):
            assert prices[0][s] == min(between[4 * s + e] + c.AT_END[e] for e in range(4))


def test_long_conversation_is_linear(spark):
    codes = bytes(random.Random(1).randrange(16) for _ in range(100_000))
    prices = c.auction(codes, c.AT_END)
    letters, _ = c.trace(codes, prices, 0)
    assert len(letters) - letters.count("I") == 100_000


def test_very_long_text_and_messages(spark):
    rows = [(1, 1, "user", "x" * 3_000_000 + "."), (1, 2, "assistant", "y" * 3_000_000), (1, 3, "assistant", "z.")]
    df = spark.createDataFrame(rows, SCHEMA)
    said = [(m.role, len(m.text)) for p in sorted(c.repaired(df).collect(), key=lambda p: p.part) for m in p.messages]
    assert ours(spark, rows) == brute(rows, rows)
    assert said == [("user", 3_000_001), ("assistant", 2)]


def test_odd_tables(spark):
    rows = [(1, 1, "user", "Hi.", "extra"), (1, 2, "assistant", "Ho.", None)]
    names = ["conv_id", "turn", "role", "text"]
    wide = spark.createDataFrame([(*r, *["x"] * 4) for r in rows], "conv_id long, turn long, role string, text string, audit string, part string, place string, said string, copies string")
    assert sorted(p.audit for p in c.repaired(wide).collect()) == ["KK"]
    empty = spark.createDataFrame([], SCHEMA)
    assert c.repaired(empty).count() == 0 and c.digests(empty, c.repaired(empty)).count() == 0
    only = spark.createDataFrame([(5, None, None, None)], SCHEMA)
    row = c.digests(only, c.repaired(only)).first()
    assert [row[n] for n in COLUMNS] == [5, 0, 1, 0, 0, 0, 4, "D", hashlib.sha256(b"").hexdigest()] and names == SCHEMA.names

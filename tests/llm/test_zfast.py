import hashlib
import random
import zlib

import duckdb
import pytest
from lakeledger.llm import zfast
from lakeledger.llm.oracle import OP13
from lakeledger.llm.queries import op13_zfast

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def token(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def grouped(rows):
    """{conv: [(role, text), ...]} in order."""
    out = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            out.setdefault(conv, []).append((turn is not None, turn or 0, token(role or "", text or ""), (role or "", text or "")))
    return {c: [x[-1] for x in sorted(turns)] for c, turns in out.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    """The plain trie: a node for every prefix."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for path in members:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    rows, sums = [], {}
    for path in sorted(members, key=len, reverse=True):
        own = (len(members[path]) - 1) * len(path[-1][1]) if path else 0
        below = [sums[k] for k in kids.get(path, [])]
        sums[path] = (own + sum(b[0] for b in below), sum(b[1] for b in below) or 1)
        ends = sorted(c for c in members[path] if len(convs[c]) == len(path))
        rows.append((min(members[path]), len(path), min(members[path[:-1]]) if path else None, len(members[path]), len(below),
                     sums[path][1], sums[path][0], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(rows, key=lambda r: (r[1], r[0]))


def collected(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=lambda r: (r[1], r[0]))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_brute_force_and_sql(spark, sf):
    path = f"/root/testdata/{sf}/conversations.parquet"
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(path).collect()]
    got = collected(op13_zfast(spark, f"/root/testdata/{sf}"))
    assert got == brute(rebuilt(grouped(rows)))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}'")
    assert sorted(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({OP13})").fetchall(), key=lambda r: (r[1], r[0])) == got


SCHEMA = "conv_id long, turn long, role string, text string, pos int, arr string"


def frame(spark, convs):
    return spark.createDataFrame([(c, i, *t, 0, "x") for c, turns in convs.items() for i, t in enumerate(turns)], SCHEMA)


def test_shapes(spark):
    rng = random.Random(4)
    spine = [("u", f"t{i}") for i in range(40)]
    convs = {i: spine[:i + 1] for i in range(40)}  # each a prefix of the next
    convs |= {100 + i: spine[:i] + [("u", f"off{i}")] for i in range(40)}  # one branch at each depth
    convs |= {200 + i: [("u", rng.choice("ab")) for _ in range(rng.randrange(1, 9))] for i in range(150)}  # bushy, with copies
    convs |= {400 + i: spine[:7] for i in range(60)}  # copies
    convs |= {500 + i: [("é", "ü" * i), ("a", "")] for i in range(5)}
    for batches in (1, 3):
        rows = zfast.positioned(frame(spark, convs))
        assert collected(zfast.prefix_trie(rows, rows.select("conv").distinct(), batches)) == brute(convs)


def test_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(zfast, "BLOCK", 8)
    long = [("u", f"t{i % 5}") for i in range(61)]
    convs = {1: long, 2: long[:24], 3: long[:24] + [("x", "end")], 4: long[:25], 5: long[:60] + [("x", "z")], 6: long[:8], 7: long[:3],
             8: long, 9: [("u", "t0")] * 16, 10: [("u", "t0")] * 30}
    assert collected(zfast.conversation_trie(frame(spark, convs))) == brute(convs)


def test_edges(spark):
    rows = [(None, 0, "user", "nobody"), (7, None, None, None), (7, 1, "user", "hi"), (7, 1, "user", "hi"), (7, 1, "user", "ho"), (8, 0, "", ""),
            (8, 5, "user", "x" * 300_000), (-5, 3, "user", "minus"), (-5, 4, "user", "b"), (0, 0, "a", "base"), (100, 2, "é", "\U0001F600"),
            (105, 0, "user", "one"), (305, 0, "user", "turnless?")]
    turns = spark.createDataFrame([(*r, 1, "y") for r in rows], SCHEMA)
    assert collected(zfast.conversation_trie(turns)) == brute(grouped(rows))
    turns.write.mode("overwrite").parquet(zfast.staged(turns, "t").sparkSession.conf.get("spark.checkpoint.dir") + "/edge/conversations.parquet")
    root = spark.conf.get("spark.checkpoint.dir") + "/edge"
    assert collected(op13_zfast(spark, root)) == brute(rebuilt(grouped(rows)))
    assert zfast.conversation_trie(turns.where("false")).collect() == []
    assert zfast.conversation_trie(turns.where("conv_id IS NULL")).collect() == []


def test_one_conversation_over_many_tasks(spark):
    n = 3000  # more than a range of the order holds
    turns = spark.range(n).selectExpr("1L AS conv_id", "id DIV 2 AS turn", "'u' AS role", "CAST(id % 3 AS STRING) AS text").repartition(16)
    got = collected(zfast.conversation_trie(turns))
    rows = [(1, i // 2, "u", str(i % 3)) for i in range(n)]
    assert got == brute(grouped(rows))


def test_two_fattest(spark):
    got = spark.range(1, 70).selectExpr("CAST(id AS INT) AS r").selectExpr("r", "explode(sequence(0, r - 1)) AS l").selectExpr(
        "l", "r", f"{zfast.fattest('l', 'r')} AS f").collect()
    for x in got:
        assert x.f == max(range(x.l + 1, x.r + 1), key=lambda v: v & -v)

import hashlib
import random
import re
import zlib
from collections import defaultdict

from readloom.llm import trie
from readloom.llm.queries import QUERIES


def built_turns(rows):
    """{conv: [(role, text)]} after the loan of first turns."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    turns = {c: [x[1:] for x in sorted(t)] for c, t in own.items()}
    out = {}
    for c, t in turns.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 4
        lender = turns.get(c - c % 20, []) if c is not None else []
        out[c] = lender[:h] + t[h:]
    return out


def brute(rows):
    convs = built_turns(rows)
    members = defaultdict(list)
    for c, t in convs.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    smallest = {n: min((c for c in m if c is not None), default=None) for n, m in members.items()}
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
        saved[node] = max(len(members[node]) - 1, 0) * words + sum(saved[c] for c in children[node])
    out = []
    for node, m in members.items():
        ends = sorted((c for c in m if len(convs[c]) == len(node)), key=lambda c: (c is not None, c or 0))
        digest = hashlib.sha256(",".join("" if c is None else str(c) for c in ends).encode()).hexdigest()
        parent = smallest[node[:-1]] if node else None
        own = (smallest[node], len(node), parent, len(m), len(children[node]), leaves[node], saved[node], digest)
        out.append(own)
    return sorted(out, key=repr)


def found(spark, rows, tmp_path):
    path = str(tmp_path / "sf")
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{path}/conversations.parquet")
    df = QUERIES["op12_prefix_trie"].run(spark, path)
    assert df.columns[:4] == ["conv_id", "depth", "parent_conv_id", "n_convs"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_against_brute_force(spark, tmp_path):
    rng = random.Random(2)
    rows = []
    for c in range(300):
        text = ["a b", "c", "", None]
        rows += [(c * rng.choice([1, 1, 3]), t, rng.choice(["user", "assistant", None]), rng.choice(text)) for t in range(rng.randrange(14))]
    rows += [(None, 1, "user", "x"), (None, None, "user", "y z"), (7, None, "system", "first"), (7, 2, "user", "a b"), (7, 2, "user", "a b")]
    assert found(spark, rows, tmp_path) == brute(rows)


def test_long_shared_beginnings(spark, tmp_path):
    """Blocks that a group shares, and boundaries at every place of a block."""
    rows = []
    for c in range(60):
        shared = 5 + c % 17
        rows += [(1000 + c, t, "user", f"turn {t} w" if t < shared else f"own {c % 23} {t}") for t in range(shared + c % 6)]
    rows += [(5, t, "user", f"turn {t} w") for t in range(200)]
    assert found(spark, rows, tmp_path) == brute(rows)


def test_copies_and_turnless(spark, tmp_path):
    rows = [(c, t, "user", f"same {t}") for c in range(150) for t in range(6)]
    rows += [(400 + c, 0, "user", "short") for c in range(40)]
    assert found(spark, rows, tmp_path) == brute(rows)


def test_empty_table(spark, tmp_path):
    assert found(spark, [], tmp_path) == []


def test_block_length_does_not_matter(spark):
    rng = random.Random(9)
    rows = [(c, t, "user", rng.choice("aab")) for c in range(80) for t in range(rng.randrange(1, 12))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS conv", "2 AS at", "3 AS d1")
    turns = trie.digested(df, "conv_id", "turn", "role", "text").withColumnRenamed("place", "at")
    convs = turns.select("conv").distinct()
    got = [sorted(map(repr, trie.prefix_trie(turns, convs, block).collect())) for block in (1, 16)]
    assert got[0] == got[1]

import hashlib
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from terracat.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    turns = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        built[c] = tuple(turns.get(base, [])[:h] + v[h:])
    members = defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    words = lambda p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
    out = set()
    for p, m in members.items():
        under = [q for q in members if q[:len(p)] == p]
        child = [q for q in under if len(q) == len(p) + 1]
        leaves = [q for q in under if not any(len(r) == len(q) + 1 and r[:len(q)] == q for r in under)]
        ends = ",".join(map(str, sorted(c for c in m if len(built[c]) == len(p))))
        out.add((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(child), len(leaves),
                 sum((len(members[q]) - 1) * words(q) for q in under), hashlib.sha256(ends.encode()).hexdigest()))
    return out


def result(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert all(t == "bigint" for c, t in df.dtypes if c != "ends_sha256")
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("small", [False, True])
def test_table_equals_brute_force(spark, monkeypatch, small):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    if small:
        monkeypatch.setattr(prefix_trie, "CHUNK", 2)
        monkeypatch.setattr(prefix_trie, "ID_RANGE", 3)
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert result(prefix_trie.trie(df)) == brute(rows)


def test_long_chain_copies_and_branches(spark, monkeypatch):
    """A long conversation, copies of it that end elsewhere, branches off it; few rounds."""
    monkeypatch.setattr(prefix_trie, "CHUNK", 16)
    turns = [("user", f"word {k} " + "x " * (k % 5)) for k in range(150)]
    rows = []
    for c, n in ((40, 150), (60, 150), (80, 149), (100, 75), (120, 30)):
        rows += [(c, k, *turns[k]) for k in range(n)]
    for c in range(200, 260, 20):
        rows += [(c, k, *turns[k]) for k in range(c // 4)] + [(c, 500 + k, "assistant", f"branch {c} {k}") for k in range(40)]
    rows += [(c, k, "user", "same") for c in range(300, 340) for k in range(6)]
    written = []
    monkeypatch.setattr(prefix_trie, "materialize",
                        lambda df, name, f=prefix_trie.materialize: (written.append(name), f(df, name))[1])
    got = result(prefix_trie.trie(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute(rows)
    assert written.count("trie_marked") <= 10  # log2 of about 300 nodes, not 150 levels


def test_odd_rows(spark):
    assert result(prefix_trie.trie(spark.createDataFrame([], SCHEMA))) == set()
    rows = [(None, 0, "user", "no conversation"), (5, None, "user", "first"), (5, 0, None, None), (5, 0, None, None), (5, 0, "", ""),
            (5, 1, "user", "a" * 40_000), (5, 1, "assistant", " \t\n"), (-7, 0, "user", "negative id"), (-7, 1, "user", "b c"), (-7, 2, "x", "y"), (-7, 3, "x", "z"),
            (20, 0, "user", "base"), (23, 0, "user", "other"), (24, 0, "a", "b"), (25, 4, "a", "b"), (25, 5, "a", "b"), (26, 1, "a", "b"), (47, 0, "only", "turn"), (2**40 + 1, 0, "u", "t")]
    df = spark.createDataFrame(rows, SCHEMA)
    clash = df.withColumn("owner", F.lit(1)).withColumn("depth", F.lit("x")).withColumn("pos", F.lit(None).cast("int"))
    assert result(prefix_trie.trie(clash)) == brute(rows)
    assert any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in brute(rows))  # turnless members


def test_only_turnless(spark):
    c = next(c for c in range(21, 200) if c % 20 and zlib.crc32(str(c).encode()) % 4)
    rows = [(c, 0, "user", "gone")]
    assert result(prefix_trie.trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)

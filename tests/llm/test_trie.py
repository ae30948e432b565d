import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest

from quillspark.llm import trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, depth string, n string"


def sequences(rows, rebuild):
    """conv -> its turns, from the definition."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    if not rebuild:
        return own
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]  # % of SQL
    return made


def brute(rows, rebuild=True):
    convs = sequences(rows, rebuild)
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids = defaultdict(list)
    for path in members:
        if path:
            kids[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[k] for k in kids[path]) if kids[path] else 1
        saved[path] = sum(saved[k] for k in kids[path]) + (len(members[path]) - 1) * (len(path[-1][1]) if path else 0)
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items()
    )


def check(spark, rows, rebuild=True, partitions=3):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(partitions)
    got = (trie.rebuilt_trie if rebuild else trie.conversation_trie)(df)
    assert got.columns == COLUMNS
    found = sorted(tuple(r) for r in got.collect())
    assert found == brute(rows, rebuild)
    return found


def test_nulls_ties_repeats_and_missing_bases(spark):
    rows = [(c, t, random.Random(c).choice(["user", "assistant", None]), random.Random(c * t % 5).choice(["", "a", "é😀", None])) for c in (0, 1, 2, 5, 99, 100, 101, 250, 251, 299) for t in range(c % 9)]
    rows += [(0, None, "system", "first"), (7, 1, "user", "b"), (7, 1, "user", "a"), (7, 1, "assistant", "z"), (7, 1, "user", "a"), (None, 1, "user", "lost"), (300, 3, None, None)]
    check(spark, rows)
    check(spark, rows, rebuild=False)


def test_snapshots_of_one_conversation_and_copies(spark):
    """Each conversation starts with the one before: as many rounds as conversations."""
    rows = [(c, t, "user", f"turn {t}") for c in range(1, 7) for t in range(2 * c)] + [(c, t, "user", f"turn {t}") for c in range(20, 30) for t in range(7)]
    check(spark, rows, rebuild=False)


def test_a_long_conversation_over_many_ranges(spark):
    rows = [(3, t, "user", str(t % 7)) for t in range(3000)] + [(4, t, "user", str(t % 7)) for t in range(2500)] + [(5, 0, "user", "0")]
    check(spark, rows, rebuild=False, partitions=5)
    check(spark, rows, partitions=5)


def test_many_conversations_end_at_one_node(spark, monkeypatch):
    monkeypatch.setattr(trie, "ID_BLOCK", 4)
    rows = [(c, t, "user", f"same {t}") for c in (*range(-9, 40), 1000, 1001) for t in range(7)]
    found = check(spark, rows, rebuild=False)
    assert len(found) == 8 and found[-1][3] == 51


def test_random_forests(spark):
    r = random.Random(5)
    rows = [(r.randrange(-3, 130), r.choice([None, 0, 1, 2, 3, 4]), r.choice("ua"), r.choice(["x", "yy", ""])) for _ in range(700)]
    check(spark, rows)


def test_no_rows_no_nodes(spark):
    assert check(spark, []) == []
    assert check(spark, [(None, 1, "user", "a")]) == []


def test_turns_that_share_a_key_raise(spark):
    passed = spark.createDataFrame([(1, 1, 5, 5, 1, 9, 9, 1), (2, 1, 6, 5, 1, 9, 9, 1)], "conv long, depth long, g1 long, g2 long, chars long, k1 long, k2 long, total long")
    convs = spark.createDataFrame([(1,), (2,)], "conv long")
    with pytest.raises(Exception, match="share a key"):
        trie._nodes(passed, convs).collect()

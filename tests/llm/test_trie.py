import hashlib
import zlib
from collections import defaultdict

from wayline.llm import prefix_trie
from .conftest import CLASHING

COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def sequences(rows, rebuild):
    """Each conversation's turns, read row by row."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            token = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, token, role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    if not rebuild:
        return own
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        rebuilt[c] = own.get(base, [])[:h] + turns[h:]
    return rebuilt


def by_hand(rows, rebuild):
    members, ends = defaultdict(list), defaultdict(list)
    found = sequences(rows, rebuild)
    for c, turns in found.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        size = len(node[-1][1]) if node else 0
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = (len(members[node]) - 1) * size + sum(saved[k] for k in children[node])
    digest = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(
        (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children[n]), leaves[n], saved[n], digest(ends[n]))
        for n, m in members.items()
    )


def trie(spark, rows, rebuild):
    df = spark.createDataFrame([(*r, *([7] * 5), 0.5, "w", "r", 1, 1, 7, 0.5) for r in rows], f"conv_id long, turn long, role string, text string, {CLASHING}")
    found = prefix_trie.conversation_trie(df, rebuild=rebuild)
    return sorted(tuple(r) for r in found.select(*COLUMNS).collect())


def example():
    rows = []
    for c in [*range(-120, 320), 10_000, 10_005, 10_099]:
        length = (c * 7919) % 9
        rows += [(c, t, ["user", "assistant"][t % 2], f"text {(c // 10 if t < 3 else c) * (t + 1) % 13} é🙂") for t in range(length)]
    rows += [(5_000 + i, t, "user", f"the same {t}") for i in range(40) for t in range(12)]  # copies, and two that go on
    rows += [(5_000 + i, 12 + t, "user", "tail") for i in (3, 4) for t in range(i)]
    rows += [(6_000, None, None, None), (6_000, None, "user", None), (6_000, 3, None, "x"), (6_000, 3, None, "x"), (6_000, 3, "b", "a")]
    rows += [(None, 0, "user", "no id"), (6_001, 0, "user", ""), (6_002, 0, "", "user"), (6_003, 1, "user", "y" * 100_000)]
    return rows


def test_trie_equals_reading_row_by_row(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    rows = example()
    for rebuild in (False, True):
        assert trie(spark, rows, rebuild) == by_hand(rows, rebuild)


def test_turnless_and_single_conversations(spark):
    rows = [(c, 0, "user", "x") for c in range(1, 60)]  # most lose their only turn, and there is no conversation 0
    assert trie(spark, rows, True) == by_hand(rows, True)
    rows = [(9, t, "user", str(t)) for t in range(30)]
    assert trie(spark, rows, False) == by_hand(rows, False)


def test_levels_follow_what_sequences_share(spark, monkeypatch):
    """Only turns that two different sequences share cost a level, however long conversations and their copies are."""
    levels = []
    peel = prefix_trie._peel
    monkeypatch.setattr(prefix_trie, "_peel", lambda s, arrivals, deepest: (levels.append(deepest), peel(s, arrivals, deepest))[1])
    rows = [(c, t, "user", f"{c % 3 if t > 1 else 0} {t}") for c in range(9) for t in range(200)]
    assert trie(spark, rows, False) == by_hand(rows, False)
    assert levels == [2]


def test_no_conversations(spark):
    assert trie(spark, [], True) == []
    assert trie(spark, [(None, 1, "user", "x")], False) == []

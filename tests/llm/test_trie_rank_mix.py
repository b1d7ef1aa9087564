"""The prefix trie, ranked search and source mixing against plain versions, and on unusual input."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from vasculum.llm import mixing, prefix_trie, ranking

CONVERSATIONS = "conv_id long, turn long, role string, text string, conv string, k long, name string, words string"


def plain_trie(rows):
    """Nodes by prefix: (smallest member, depth, parent's, members, children, leaves, saved, hash)."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", (text or "")[:32], hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(x[2], x[5]) for x in sorted(t)] for c, t in turns.items()}
    whole = {}
    for c in own:
        base, h = c - c % 20, zlib.crc32(str(c).encode()) % 4
        whole[c] = own[c] if base == c else own.get(base, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[tuple(whole[c][:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(m) - 1) * words
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in m if len(whole[c]) == len(p))
        parent = members[p[:-1]][0] if p else None
        out.append((m[0], len(p), parent, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found_trie(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 7, "y", "z") for r in rows], CONVERSATIONS).repartition(5)
    return sorted((tuple(r)[1:] for r in prefix_trie.conversation_trie(frame).collect()), key=str)


def test_trie_with_long_odd_and_copied_conversations(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(c, t, rng.choice(["user", None]), rng.choice(["a b", "c", "", None])) for c in range(50) for t in range(rng.randrange(1, 7))]
    rows += [(c, t, "user", f"{t % 3} x") for c in (100, 101, 115) for t in range(150 - c % 3)]  # several chunks of 32
    rows += [(c, t, "user", f"{t % 3} x" if t < 70 else f"other {c}") for c in (120, 122) for t in range(140)]
    rows += [(9_000 * c, t, "user", "copy") for c in range(1, 40) for t in range(3)]  # ids of one node lie in several runs
    rows += [(30, 0, "user", "a b"), (30, 0, "user", "a b"), (31, None, "user", "first"), (32, 1, "b", "tie"), (32, 1, "a", "tie"), (None, 0, "user", "nobody")]
    rows += [(223, 0, "user", "gone")]  # its only turn is replaced by those of a conversation that is not there
    assert zlib.crc32(b"223") % 4 > 0
    assert found_trie(spark, rows) == plain_trie(rows)
    monkeypatch.setattr(prefix_trie, "CHUNK", 4)
    few = [r for r in rows if r[0] is not None and r[0] < 103]
    assert found_trie(spark, few) == plain_trie(few)


def test_trie_of_nothing_and_of_an_empty_turn(spark):
    assert found_trie(spark, []) == []
    assert found_trie(spark, [(None, 1, "user", "x")]) == []
    rows = [(1, 0, None, None)]
    assert found_trie(spark, rows) == plain_trie(rows)


def plain_ranks(docs, items, top):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(low))

    counted = [(i, Counter(terms(t))) for i, t, *_ in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, words = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counted:
            m = 75 + 25 * sum(c.values()) * n_docs // words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, k, s[3], -s[0]) for k, s in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("settings", [{}, {"FIRST_SLICE": 2, "LAST_SLICE": 8, "ITEM_CHARS": 60, "BUCKET_ROWS": 9, "PART_BYTES": 40}])
def test_ranking(spark, documents, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(ranking, name, value)
    rng = random.Random(8)
    words = ["the", "The", "cat", "naïve", "日本", "x1", "dog", "a-b", "rare", "owl", " nb"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))), "en") for i in range(150)]
    docs += [(500 + i, "the cat sat on the cat", "en") for i in range(60)]  # ties
    docs += [(None, "rare owl", "en"), (7, "rare owl", "en"), (7, "rare owl", "en"), (8, None, "en"), (9, "", "en"), (10, " .,;", "en"), (11, "word " * 30_000 + "owl", "en")]
    items = [(1, "The CAT sat"), (2, "rare rare owl"), (3, None), (4, " ."), (5, "unheard"), (None, "dog the"), (6, "日本 naïve x1 " * 40), (6, "b")]
    frame = spark.createDataFrame([(i, t, 3, "x") for i, t in items], "item_id long, text string, score long, rank string")
    found = ranking.rank(documents(docs), frame).collect()
    assert sorted((tuple(r) for r in found), key=str) == plain_ranks(docs, items, 20)


def test_ranking_of_nothing(spark, documents):
    items = spark.createDataFrame([(1, "the")], "item_id long, text string")
    assert ranking.rank(documents([]), items).count() == 0
    assert ranking.rank(documents([(1, ". .", "en")]), items).count() == 0
    assert ranking.rank(documents([(1, "the", "en")]), items.limit(0)).count() == 0


def plain_targets(sizes, weights, share, most):
    """Reshare the excess by weight until no source is above its cap."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, open_, rest = dict.fromkeys(names, 0.0), list(names), share * sum(sizes.values())
    while open_ and rest > 1e-9:
        whole = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += rest * weight[s] / whole
        rest = sum(max(0, target[s] - most * sizes[s]) for s in open_)
        for s in open_:
            target[s] = min(target[s], most * sizes[s])
        open_ = [s for s in open_ if target[s] < most * sizes[s]]
    return target


def mixed(spark, rows, **settings):
    frame = spark.createDataFrame([(i, t, s, "x", 1) for i, t, s in rows], "doc_id long, text string, source string, key string, size long").repartition(4)
    return frame, mixing.mix(frame, **settings).collect()


def test_mixing(spark):
    rng = random.Random(9)
    sources = ["hot"] * 6 + ["b", "B", "é", "src", None]
    rows = [(i, "w " * rng.randrange(0, 40), rng.choice(sources)) for i in range(1_500)]
    rows += [(1, None, "b"), (None, "one two", "b"), (None, "one two", "b"), (2, "", "empty"), (3, "single " * 500, "lone")]
    rows += [(77, "same text here", "copies")] * 200
    frame, found = mixed(spark, rows)
    assert len(found) == len(rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    target = plain_targets(sizes, (5, 2, 1), 1.5, 2)
    taken, largest = Counter(), Counter()
    for r in found:
        assert r.taken == r.size * r.copies and 0 <= r.copies <= 2 and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source])
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in sizes)
    assert abs(taken["copies"] - target["copies"]) <= 3  # repeated rows are told apart
    again = mixing.mix(frame.repartition(1)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    other = mixing.mix(frame, seed=1).collect()
    assert sorted(map(str, other)) != sorted(map(str, found))


def test_mixing_three_times_and_of_nothing(spark):
    rows = [(i, "a b c", "x" if i % 3 else "y") for i in range(300)]
    _, found = mixed(spark, rows, weights=(1, 6), share=1.8, most=3)
    target = plain_targets({"x": 600, "y": 300}, (1, 6), 1.8, 3)
    for s in "xy":
        assert abs(sum(r.taken for r in found if r.source == s) - target[s]) <= 3
    assert max(r.copies for r in found) == 3
    assert mixed(spark, [])[1] == []
    assert all(r.taken == 0 and r.target == 0 for r in mixed(spark, [(1, None, None), (2, " ", "a")])[1])


def test_mixing_nests_its_budgets(spark):
    """What is taken twice lies under what is taken once, in the order of the key."""
    rows = [(i, "w " * (i % 7 + 1), "s") for i in range(400)] + [(1_000 + i, "w " * 9, "t") for i in range(400)]
    _, found = mixed(spark, rows, weights=(3, 2), share=1.2)
    key = {i: hashlib.md5(f"0:{i}:{t}".encode()).hexdigest() for i, t, _ in rows}
    for s in "st":
        own = sorted((key[r.doc_id], r.copies) for r in found if r.source == s)
        assert [c for _, c in own] == sorted((c for _, c in own), reverse=True)

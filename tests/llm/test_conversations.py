"""Reply trees and the prefix trie against brute force, with nulls, ties, repeated
rows, long texts, clashing column names and no rows."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from jobsift.llm import prefix_trie, queries, reply_trees

MARKS = ["", "</turn>", "<turn><role>", "\\", "\\\\", "<\\/turn>\n", "<", "</", "</role>\n", "\\### Assistant: </turn> ok", "über\n\n", "𝄞 a", "plain"]


def _escape(x: str) -> str:
    x = x.replace("\\", "\\\\")
    for mark in ("</", "<turn>", "<role>"):
        x = x.replace(mark, "<\\" + mark[1:])
    return x


def _branches(rows: list[tuple]) -> dict:
    """All ways root to leaf of each tree: [(score, leaf, [(role, text)])], best first."""
    out: dict = {}
    for tree in {r[0] for r in rows}:
        said: dict = {}
        for _, node, parent, role, text, score in rows:
            if tree == _ and (node not in said or (parent or "", role or "", text or "") < said[node][:3]):
                said[node] = (parent or "", role or "", text or "", score)
        ways = []
        for leaf in said:
            if any(p == leaf and n != leaf for n, (p, *_) in said.items()):
                continue
            way, at = [leaf], leaf
            while said[at][0] in said and said[at][0] != at:
                at = said[at][0]
                way.append(at)
            scores = [said[n][3] for n in way if said[n][3] is not None]
            ways.append((sum(scores) / len(scores) if scores else None, leaf, [said[n][1:3] for n in reversed(way)]))
        out[tree] = sorted(ways, key=lambda w: (w[0] is None, -(w[0] or 0), w[1]))
    return out


def _trees() -> list[tuple]:
    rnd = random.Random(5)
    rows = []
    for tree in (1, 2, 3, None):
        for n in range(40):
            parent = None if n == 0 or rnd.random() < 0.05 else f"n{rnd.randrange(max(0, n - 3), n):02d}"
            rows.append((tree, f"n{n:02d}", parent, rnd.choice(["user", "assistant", None, "</role>\nx"]), rnd.choice(MARKS) + rnd.choice(MARKS), rnd.choice([None, 1.0, 0.5, 0.25])))
    rows += [(4, "a", "gone", "user", "orphan", None), (4, "b", "b", "assistant", "itself", 2.0), (4, "b", "b", "assistant", "itself", 2.0), (5, "x", None, None, None, None)]
    return rows


@pytest.mark.parametrize("most", [1, 3, None])
def test_branches_equal_brute_force(spark, most):
    rows = _trees()
    replies = spark.createDataFrame([(*r, "k") for r in rows], "thread long, id string, answers string, role string, text string, score double, key string")
    out = reply_trees.read_back(reply_trees.format_trees(replies, "thread", "id", "answers", score="score", branches=most)).collect()
    want = _branches(rows)
    assert len(out) == sum(len(w[:most]) for w in want.values())
    for tree, ways in want.items():
        mine = [r for r in out if r["tree"] == tree]
        if most is None:
            key = lambda way: repr(way)
            assert sorted(([tuple(t) for t in r["turns"]] for r in mine), key=key) == sorted((w[2] for w in ways), key=key)
            continue
        for r in mine:
            score, _, turns = ways[int(r["branch"]) - 1]
            assert [tuple(t) for t in r["turns"]] == turns and (r["score"] is None) == (score is None)
            assert score is None or abs(r["score"] - score) < 1e-9
    for r in out:
        turns = [tuple(t) for t in r["turns"]]
        assert r["formatted"] == "".join(f"<turn><role>{_escape(a)}</role>\n{_escape(b)}</turn>\n" for a, b in turns)
        assert r["n_turns"] == len(turns) and r["learnt"] == "".join(b for a, b in turns if a == "assistant")
        assert [r["formatted"][s["start"]:s["start"] + s["length"]] for s in r["loss"]] == [_escape(b) for a, b in turns if a == "assistant"]


def test_a_ring_has_no_root(spark):
    ring = spark.createDataFrame([(1, "a", "c"), (1, "b", "a"), (1, "c", "b")], "t long, n string, p string").selectExpr("*", "'user' AS role", "'x' AS text")
    with pytest.raises(reply_trees.ReplyRing):
        reply_trees.format_trees(ring, "t", "n", "p")


def _conversations() -> list[tuple]:
    rnd = random.Random(9)
    rows = []
    for c in [*range(0, 40), 55, 57, 103]:
        n = rnd.choice([1, 2, 3, 8, 9, 16, 17, 30])
        rows += [(c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["a", "b", "über", None, "z" * 3000]) if rnd.random() < 0.5 else MARKS[t % len(MARKS)], t) for t in range(n)]
    rows += [(70, None, "user", "no turn"), (70, 1, "user", "first"), (70, 1, "user", "first"), (71, 0, "user", "x")]
    rows += [(c, 0, "user", "its opening is not there") for c in (201, 202, 203, 204)]
    return [r[:4] for r in rows]


@pytest.fixture(scope="module")
def talks(spark):
    return spark.createDataFrame([(*r, "t", 1) for r in _conversations()] + [(None, 1, "user", "nobody", "t", 1)], "conv_id long, turn long, role string, text string, tree string, depth long")


def _given() -> dict:
    given: dict = {}
    for c, turn, role, text in _conversations():
        given.setdefault(c, []).append((-1 if turn is None else turn, role or "", text or ""))
    return {c: [t[1:] for t in sorted(turns)] for c, turns in given.items()}


def test_conversations_come_back(spark, talks):
    out = {r["tree"]: r for r in reply_trees.read_back(reply_trees.format_conversations(talks)).collect()}
    want = _given() | {None: [("user", "nobody")]}
    assert {c: [tuple(t) for t in r["turns"]] for c, r in out.items()} == want
    assert all(r["learnt"] == "".join(x for role, x in want[c] if role == "assistant") for c, r in out.items())
    assert reply_trees.format_conversations(talks.where("turn = 99")).count() == 0


def _trie(rebuilt: dict) -> set:
    nodes: dict = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    children: dict = {}
    for way in nodes:
        if way:
            children[way[:-1]] = children.get(way[:-1], 0) + 1
    out = set()
    for way, members in nodes.items():
        below = [w for w in nodes if w[:len(way)] == way]
        saved = sum((len(nodes[w]) - 1) * len(w[-1][1].encode()) for w in below if w)
        ends = ",".join(str(c) for c in sorted(members) if len(rebuilt[c]) == len(way))
        out.add((min(members), len(way), min(nodes[way[:-1]]) if way else None, len(members), children.get(way, 0), sum(w not in children for w in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def test_trie_equals_brute_force(spark, talks, monkeypatch):
    given = _given()
    rebuilt = {}
    for c in given:
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = given.get(c - c % 5, [])[:h] + given[c][h:]
    assert any(not t for t in rebuilt.values()) and any(len(t) > 16 for t in rebuilt.values())
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    turns = prefix_trie.numbered_turns(talks)
    out = prefix_trie.prefix_trie(prefix_trie.with_shared_openings(turns)).collect()
    assert len(out) == len(_trie(rebuilt)) and {tuple(r) for r in out} == _trie(rebuilt)
    plain = prefix_trie.prefix_trie(turns).collect()
    assert {tuple(r) for r in plain} == _trie(given)


def test_no_conversations_no_nodes(talks):
    none = prefix_trie.numbered_turns(talks.where("turn = 99"))
    assert prefix_trie.prefix_trie(prefix_trie.with_shared_openings(none)).count() == 0


def test_registered_with_sql():
    assert {"op11_reply_trees", "op12_prefix_trie"} <= set(queries.ORACLE)

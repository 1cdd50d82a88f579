"""The prefix trie and the filter audit against plain Python, over awkward rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import pytest

from genoweave.llm import audit, trie

CONVS = "conv_id long, turn long, role string, text string, pos long, node long, digest string"


def conversations(seed):
    rnd = random.Random(seed)
    out = []
    for c in [*range(-7, 30), 1000, 1001, 10**12 + 3]:
        for t in range(rnd.choice([0, 1, 2, 3, 8, 9])):
            out.append((c, rnd.choice([t, t, t, None, 0]), rnd.choice(["user", None, ""]), rnd.choice(["a", "b", "", None, "ä,1", "a" * 50])))
    long = [(t, rnd.choice("uv"), rnd.choice(["x", "y"])) for t in range(133)]
    for c in (100, 101, 102, 103, 200, 201):  # copies, so that shared paths are long
        out += [(c, t, r, x + ("!" if c == 103 and t > 70 else "")) for t, r, x in long]
    out += [(c, t, "s", "same") for c in range(300, 340) for t in range(2)]  # a third of the conversations are equal
    out += [(None, 1, "user", "no id"), (5, None, "user", "twice"), (5, None, "user", "twice")]
    rnd.shuffle(out)
    return [(*r, 1, 2, "clash") for r in out]


def plain_trie(rows):
    convs = defaultdict(list)
    for c, t, r, x, *_ in rows:
        if c is not None:
            r, x = r or "", x or ""
            convs[c].append((t is not None, t or 0, hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).digest(), (r, x)))
    convs = {c: [t[-1] for t in sorted(v, key=lambda t: t[:3])] for c, v in convs.items()}
    full = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        full[c] = tuple(convs.get(base, [])[:h] + own[h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                children[turns[: d - 1]].add(turns[:d])
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(full[c]) == len(p))))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, ())), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_plain_python(spark, seed, monkeypatch):
    monkeypatch.setattr(trie, "PIECE_BYTES", 100)
    rows = conversations(seed)
    got = trie.prefix_trie(spark.createDataFrame(rows, CONVS).repartition(5))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_trie(rows)


def test_trie_without_conversations(spark):
    assert trie.prefix_trie(spark.createDataFrame([], CONVS)).collect() == []
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "a", "b", 0, 0, "")], CONVS)).collect() == []


def test_names_have_no_gaps(spark):
    got = sorted(r["n"] for r in trie.named(spark.range(1000).selectExpr("id % 137 AS k").repartition(7), ["k"], "n").collect())
    assert got == list(range(137))


DOCS = "doc_id long, text string, source string, mask int, part string, good int"


def documents(seed):
    rnd = random.Random(seed)
    texts = [" ".join(rnd.choice(["ab", "Cd", "e", "x#", "ÄÖ", f"w{k}"]) for k in range(n)) for n in (0, 1, 10, 49, 50, 60, 80, 200)]
    texts += [" ".join(f"word{k}" for k in range(n)) for n in (49, 50, 51, 300)] + ["", None, " \t\n\x0b\f\r", "\x1c one word", "A" * 100, "z" * 5000, "a&b", "The end. " * 40]
    out = [(i, rnd.choice(texts), rnd.choice(["s0", "s0", "s1", None, ""])) for i in range(150)]
    out += [(150 + i, texts[5], "s0") for i in range(80)] + [(3, texts[5], "s1"), (3, texts[5], "s1"), (None, texts[5], "s0"), (None, "only null ids", "s1"), (None, "only null ids", "s1")]
    rnd.shuffle(out)
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1])) for i in range(0, 230, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (99999, 1, 1)]
    return [(*r, 7, "clash", 1) for r in out], labels


def plain_audit(docs, labels):
    import re

    first = {}
    for i, t, *_ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, x in labels if x == 1}
    rows = []
    for i, t, part, *_ in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = "".join(f for f, bad in zip("ABCDE", (len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), re.search("[#$%&*|]", t), i is not None and i > first.get(t, i))) if bad)
        rows.append((part or "", fails, i is not None and i in good, i is not None and i in toxic))
    out, shapley = {}, Counter()
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        for p in permutations("ABCDE"):
            left = mine
            for k, f in enumerate(p):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                early = sum(f in r[1] and any(e in r[1] for e in p[:k]) for r in mine)
                out[part, "".join(p), k + 1] = (len(left), len(gone), early, sum(r[1] == f for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone))
                shapley[part, f] += len(gone)
    return sorted((*key, *v, shapley[key[0], key[1][key[2] - 1]]) for key, v in out.items())


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_equals_applying_the_filters(spark, seed):
    docs, labels = documents(seed)
    got = audit.filter_audit(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, got.collect())) == plain_audit(docs, labels)


def test_audit_of_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.filter_audit(docs, labels).collect() == []
    one = audit.filter_audit(spark.createDataFrame([(1, None, None, 0, "", 0)], DOCS), labels).collect()
    assert len(one) == 600 and {r["part"] for r in one} == {""} and sum(r["removed"] for r in one) == 120

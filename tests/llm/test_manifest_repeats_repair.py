"""The manifest, the removal of repeated passages and the repair of conversations against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareweather.llm import merkle, repair, repeats

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "river stone lamp cloud table green house window paper street garden winter".split()


def prose(seed, n=80):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def clashing(df):
    names = ("g", "i", "n", "k", "slice", "total", "leaf", "root", "path", "tk", "t", "sha", "name", "digest", "least", "begin", "of", "at", "h", "c", "fault", "place", "conv_key")
    return df.withColumns({c: F.lit("clash") for c in names})


# -- manifest ------------------------------------------------------------------


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([sha("".join(now[a:a + 16])) for a in range(0, len(now), 16)])
    return levels


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def manifest_of(rows):
    def leaf(r, text):
        return sha("".join(map(field, (r[0], r[3], r[2], r[4], text))))

    by_source = defaultdict(list)
    for r in rows:
        by_source[r[3]].append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        by_source[s].sort(key=lambda x: x[:3])
        trees[s] = tree([x[2] for x in by_source[s]])
    upper = tree([trees[s][-1][0] for s in sources])
    out = []
    for g, s in enumerate(sources):
        for i, (_, _, own, r) in enumerate(by_source[s]):
            touched = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]) if r[1] is not None else None
            now, proof = leaf(r, lower) if touched else own, ""
            for levels, at in ((trees[s], i), (upper, g)):
                for level in levels[:-1]:
                    a = at - at % 16
                    left, right = "".join(level[a:at]), "".join(level[at + 1:a + 16])
                    proof, now, at = proof + left + right, sha(left + now + right), at // 16
            out.append((r[0], own, trees[s][-1][0], upper[-1][0], sha(proof), now, now == upper[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sources", [1, 2, 19])
def test_manifest(spark, sources):
    r = random.Random(sources)
    rows = [(k, r.choice([None, "", "Text É", prose(k, 5).title()]), r.choice([None, "en"]), None if k % 7 == 0 and sources > 1 else f"s{min(k % 37, k % sources)}é", r.choice([None, k])) for k in range(700)]
    rows += rows[:40] + [(None, "x", "en", "s0é", 1), (None, "Y", None, "s0é", 2), (None, None, None, None, None), (3, "other", "en", "s0é", 1), (4, prose(4, 20_000), "en", "lone", 1)]
    got = merkle.manifest(clashing(spark.createDataFrame(rows, DOCUMENTS).repartition(7)))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    found = sorted([tuple(x) for x in got.collect()], key=repr)
    assert found == manifest_of(rows)
    assert {x[-1] for x in found} == {True, False}


def test_small_levels_are_few_files(spark, monkeypatch):
    """Levels above the leaves are written to as many files as they fill, not to one for each task of a shuffle."""
    files = []
    monkeypatch.setattr(merkle, "cut", lambda df, cut=merkle.cut: files.append((done := cut(df)).rdd.getNumPartitions()) or done)
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('s', id % 3) AS source", "'en' AS lang", "5L AS n_chars", "concat('Text ', id) AS text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = merkle.manifest(docs.repartition(9)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(out) == 3000 and len({r.root for r in out}) == 1
    # Of the sorted run, of its slices by source and of the numbered leaves there are more; all else fits into one each.
    assert files[3:] and set(files[3:]) == {1}


def test_manifest_of_little(spark):
    assert merkle.manifest(spark.createDataFrame([], DOCUMENTS)).collect() == []
    rows = [(1, "Only", "en", "a", 4)]
    assert [tuple(x) for x in merkle.manifest(spark.createDataFrame(rows, DOCUMENTS)).collect()] == manifest_of(rows)


# -- repeated passages ---------------------------------------------------------


def without_repeats(rows):
    first = {}
    texts = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    for d, words in texts:
        for i in range(len(words) - 49 if d is not None else 0):
            w = tuple(words[i:i + 50])
            first[w] = min(first.get(w, d), d)
    out = []
    for d, words in texts:
        gone = set()
        for i in range(len(words) - 49 if d is not None else 0):
            if first[tuple(words[i:i + 50])] < d:
                gone.update(range(i, i + 50))
        out.append((d, len(words), len(gone), sha(" ".join(w for i, w in enumerate(words) if i not in gone))))
    return sorted(out, key=repr)


def passages(seed, n):
    """Texts that share passages of 30 to 90 words, near copies, copies, and one word again and again."""
    r = random.Random(seed)
    shared = [prose(1000 + k, r.randrange(30, 90)) for k in range(6)]
    rows = []
    for k in range(n):
        kind = k % 5
        if kind == 0:
            text = " ".join([prose(k, r.randrange(60)), r.choice(shared), prose(-k, r.randrange(60))])
        elif kind == 1:
            words = prose(7, 400).split()
            for _ in range(r.randrange(4)):
                words[r.randrange(len(words))] = f"w{r.randrange(99)}"
            text = "\n".join(words)
        elif kind == 2:
            text = " ".join(["same"] * r.randrange(40, 300))
        elif kind == 3:
            text = rows[r.randrange(len(rows))][1]
        else:
            text = prose(k, r.randrange(120)) + " é😀 " + r.choice(shared)
        rows.append((r.choice([k, k // 2, -k]), text))
    return rows + rows[:9] + [(None, rows[1][1]), (None, None), (5, None), (6, ""), (7, " \t\n")]


@pytest.mark.parametrize("most,shard", [(repeats.MOST_STRETCHES, repeats.SHARD_WORDS), (3, 2_000)])
def test_repeats(spark, monkeypatch, most, shard):
    """With small limits, names go to many shards and those of more than three stretches are compared by hash."""
    monkeypatch.setattr(repeats, "MOST_STRETCHES", most)
    monkeypatch.setattr(repeats, "SHARD_WORDS", shard)
    rows = passages(5, 160)
    got = repeats.deduplicated(clashing(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)))
    assert sorted([tuple(x) for x in got.collect()], key=repr) == without_repeats(rows)


def test_repeats_of_nothing(spark):
    assert repeats.deduplicated(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_index():
    """Intervals of backward search hold the suffixes that begin with what was searched, up to a window."""
    r = random.Random(3)
    texts = [np.array([r.randrange(4) for _ in range(r.randrange(1, 40))]) for _ in range(30)]
    ids = np.array([r.randrange(12) for _ in texts])
    index = repeats.Index(texts, ids, 6)
    found = {(int(s), int(p)) for a, b in index.earlier(ids) for s, p in zip(a, b)}
    least = {}
    for t, d in zip(texts, ids.tolist()):
        for i in range(len(t) - 5):
            w = tuple(t[i:i + 6].tolist())
            least[w] = min(least.get(w, d), d)
    assert found == {(k, i) for k, t in enumerate(texts) for i in range(len(t) - 5) if least[tuple(t[i:i + 6].tolist())] < ids[k]}
    for pattern in ([3], [0, 1], [2, 2, 1], [1, 0, 3, 3]):
        low, high = np.array([0]), np.array([len(index.text)])
        for symbol in reversed(pattern):
            low, high = index.extended(low, high, np.array([symbol + 1]))
        assert high[0] - low[0] == sum(t[i:i + len(pattern)].tolist() == pattern for t in texts for i in range(len(t)))


# -- conversations -------------------------------------------------------------


def cheapest(rows):
    """By all ways to edit, but those dearer by more than 12 than the best so far."""
    to = {"n": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def inserted(ways):
        out = set(ways)
        for _ in range(3):
            out |= {(to[s], c + 5, e + "I", (*t, (names[to[s]], ""))) for s, c, e, t in out if not e.endswith("III")}
        return out

    ways = inserted({("n", 0, "", ())})
    for role, text, gone, cut_off in rows:
        after, extra = set(), 5 if cut_off else 0
        for s, c, e, t in ways:
            after.add((s, c + 2, e + "D", t))
            if not gone:
                if s == "n" and role[:1] == "s":
                    after.add(("s", c + extra, e + "K", (*t, (role, text))))
                after.add((to[s], c + extra + 1, e + "R", (*t, (names[to[s]], text))))
                if role[:1] == to[s]:
                    after.add((to[s], c + extra, e + "K", (*t, (role, text))))
        best = min(x[1] for x in after)
        ways = inserted({x for x in after if x[1] <= best + 12})
    _, cost, audit, turns = min((x for x in ways if x[0] in "na"), key=lambda x: x[1:3])
    return cost, audit, sha("\n".join(f"{r}:{t}" for r, t in turns))


def test_cheapest_edits():
    r = random.Random(11)
    for _ in range(300):
        rows = [(r.choice(["user", "assistant", "system", "tool", "user", "assistant"]), str(r.random()), r.random() < 0.2, r.random() < 0.25) for _ in range(r.randrange(6))]
        search = repair.Repair()
        for x in rows:
            search.turn(*x)
        assert search.end() == cheapest(rows)


def test_edits_are_final_early():
    """What is undecided stays short, however long the conversation; turns that must go are decided at once."""
    r = random.Random(2)
    for gone in (0.1, 1.0):
        search, most = repair.Repair(sink := []), 0
        for i in range(20_000):
            search.turn(r.choice(["user", "assistant"]), "x", r.random() < gone, r.random() < 0.1, i)
            most = max(most, search.undecided())
        cost, audit, _ = search.end()
        assert most < 400 and "".join(e for _, e, _ in sink) == audit and cost > 0
        assert [at for at, e, _ in sink if e != "I"] == list(range(20_000))


def expected_repair(rows):
    by = defaultdict(list)
    ids = {r[0] for r in rows}
    for c, turn, role, text in rows:
        key = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
        hit, role, text = zlib.crc32(key.encode()) % 20, " " if role is None else role, " " if text is None else text
        if hit:
            text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
            by[c] += [(turn is not None, turn or 0, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    out = []
    for c in ids:
        seen, turns, count = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        own = sorted(by[c])
        for _, _, role, text in own:
            last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else None
            seen.add((role, text))
            if fault:
                count[fault] += 1
            turns.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        numbers = [t for known, t, _, _ in own if known]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit, digest = cheapest(turns)
        out.append((c, gaps, *count.values(), illegal, cost, audit, digest))
    return sorted(out, key=repr)


def test_repair(spark):
    r = random.Random(4)
    rows = []
    for c in range(60):
        turns = list(range(r.randrange(7)))
        for t in turns + [None] * (c % 3 == 0):
            rows.append((c if c else None, t, r.choice(["user", "assistant", "system", None, "tool"] if c % 2 else ["user", "assistant"]), r.choice(["Yes.", "no", "Why? ", "", " \n", None, f"line {t}!", "é😀。"])))
    rows += [(99, None, "user", None), (98, 5, None, "a. "), (98, 5, None, "a. "), (98, 9, "assistant", "b\n.\t")]
    table = clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4))
    got = sorted([tuple(x) for x in repair.repaired(repair.damaged(table), table).collect()], key=repr)
    assert got == expected_repair(rows)
    # The repaired turns themselves give the same hashes.
    turns = defaultdict(list)
    for x in sorted(repair.repaired_turns(repair.damaged(table)).collect(), key=lambda x: x.place):
        turns[x.conv_id].append(f"{x.role}:{x.text}")
    assert {c: sha("\n".join(turns[c])) for c in {r[0] for r in rows}} == {x[0]: x[-1] for x in got}


def test_repair_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repaired(repair.damaged(none), none).collect() == []
    assert repair.repaired_turns(repair.damaged(none)).collect() == []


def test_long_conversation_spreads(spark):
    """Neighbours are counted over many tasks of one conversation."""
    rows = spark.range(20_000).selectExpr("1L AS conv_id", "id AS turn", "element_at(array('user', 'assistant', 'assistant'), cast(id % 3 + 1 as int)) AS role", "concat('t', id, '.') AS text")
    faults = repair.faults(rows)
    assert repair.illegal_pairs(faults).collect()[0].illegal == sum(i % 3 == 1 for i in range(19_999))

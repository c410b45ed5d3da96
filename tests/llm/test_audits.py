"""Byte repeats, source divergences and Merkle proofs against brute force on small tables."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from salescast.llm import divergence, manifest, suffixes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `a.b` int, tree string, leaf string, shard int, term string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, la, s, n, 1, "x", "y", 2, "z") for i, t, la, s, n in rows], SCHEMA)


ODD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, "   \n\t ", "en", "b", 6), (5, "same text", "en", "a", 9),
    (5, "same text", "en", "a", 9), (5, "other text", "en", "a", 9), (6, "Same  TEXT é", None, "b", 12), (7, "日本語 é 😀\n\nx", "ja", "c", 9),
    (None, "no id", "en", "a", 5), (None, None, None, None, None), (None, "no id", "en", "a", 5), (9, "1234 !!", "de", None, 7), (14, "x", "", "", 2**63 - 1),
]


def repeats(rows, width):
    """Result rows of :func:`suffixes.remove_repeats` by looking at every string."""
    raws = [(i, (t or "").encode()) for i, t, *_ in rows]
    first = {}
    for i, raw in raws:
        for p in range(len(raw) - width + 1):
            if i is not None:
                first[raw[p : p + width]] = min(i, first.get(raw[p : p + width], i))
    found = []
    for i, raw in raws:
        gone = np.zeros(len(raw) + 1, bool)
        for p in range(len(raw) - width + 1):
            if i is not None and first[raw[p : p + width]] < i:
                gone[p : p + width] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        found.append((i, len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
    return sorted(found, key=str)


def noise(rng, size, letters):
    return "".join(rng.choices(letters, k=size))


def texts_with_repeats(seed):
    """Long shared passages, edited copies, runs of one letter, periods, and letters of several bytes."""
    rng = random.Random(seed)
    letters = rng.choice(["ab", "abcdefgh ", "aé日😀 "])
    passages = [noise(rng, rng.choice([49, 50, 51, 60, 90, 200]), letters) for _ in range(5)]
    passages += ["x" * 130, "xy" * 60, "x" * 49]
    rows = []
    for i in range(40):
        parts = [rng.choice([*passages, noise(rng, rng.randrange(80), letters)]) for _ in range(rng.randrange(6))]
        text = "".join(parts)
        if text and rng.random() < 0.4:
            k = rng.randrange(len(text))
            text = text[:k] + "#" + text[k + 1 :]
        rows.append((rng.choice([i, i, i, rng.randrange(40), None]), rng.choice([text, text, text, None]), "en", "a", 1))
    rows += [(1000 + k, rows[k][1], "en", "a", 1) for k in range(8)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_byte_repeats_by_brute_force(spark, seed):
    rows = texts_with_repeats(seed)
    found = suffixes.remove_repeats(table(spark, rows).repartition(5))
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(repeats(rows, 50), key=str)


def test_byte_repeats_of_texts_in_parts(spark, monkeypatch):
    """Small parts and batches: borders inside repeats, settled rows of several batches."""
    monkeypatch.setattr(suffixes, "PART", 97)
    monkeypatch.setattr(suffixes, "BATCH", 300)
    monkeypatch.setattr(suffixes, "_SETTLED", 3)
    for seed in (7, 8):
        rows = texts_with_repeats(seed)
        found = suffixes.remove_repeats(table(spark, rows).repartition(3))
        assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(repeats(rows, 50), key=str)


def test_one_very_long_text_and_a_hot_passage(spark):
    rng = random.Random(3)
    passage, long = noise(rng, 400, "abcdefghij "), noise(rng, 3_000_000, "abcdefghijklmnop ")
    rows = [(i, noise(rng, 30, "klmno") + passage + noise(rng, 30, "pqrst"), "en", "a", 1) for i in range(600)]
    rows += [(5000, long, "en", "a", 1), (5001, "z" + long[1_000_000:1_000_400] + "z", "en", "a", 1), (4000, " " * 700_000, "en", "a", 1)]
    found = {r["doc_id"]: r for r in suffixes.remove_repeats(table(spark, rows)).collect()}
    assert found[0]["n_removed"] == 0
    assert [i for i in range(1, 600) if not 400 <= found[i]["n_removed"] < 412] == []
    assert (found[5000]["n_removed"], found[5001]["n_removed"], found[5001]["n_spans"]) == (0, 400, 1)
    assert found[4000]["n_removed"] == 0 and found[4000]["n_bytes"] == 700_000


def test_radix_groups_are_the_repeated_rows():
    rng = np.random.default_rng(1)
    digits, docs = rng.integers(0, 3, (300, 4)).astype(np.uint64), rng.integers(0, 5, 300)
    alive, group = suffixes.radix(digits, docs)
    groups = {}
    for row, k in zip(alive.tolist(), group.tolist()):
        groups.setdefault(k, []).append(row)
    plain = {}
    for row, key in enumerate(map(tuple, digits.tolist())):
        plain.setdefault(key, []).append(row)
    expected = [rows for rows in plain.values() if len({int(docs[r]) for r in rows}) > 1]
    assert sorted(sorted(r) for r in groups.values()) == sorted(expected)


def shards_of(run, *columns):
    """Tables by shard of what a task of op 11 deals out."""
    found = defaultdict(list)
    for batch in run(iter([pa.RecordBatch.from_arrays([*columns], [f"c{k}" for k in range(len(columns))])])):
        for k in range(batch.num_rows):
            found[batch["shard"][k].as_py()].append(pa.Table.from_batches([batch.slice(k, 1)]))
    return {k: pa.concat_tables(v) for k, v in found.items()}


def marks_of(shards, run):
    """Marks by document, and the most memory a shard took."""
    found, most = defaultdict(list), 0
    for shard in shards.values():
        tracemalloc.start()
        marks = run(shard)
        most = max(most, tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        for row in marks.to_pylist():
            found[row["doc"]].append((row["content"], row["mask"]))
    return found, most


def looked_at(texts, shards):
    """(marks of stretches, marks of windows, the most memory a shard of either took), without Spark; each text is a batch."""
    docs, raws = pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.binary())
    sent = defaultdict(list)
    for k in range(len(texts)):
        for shard, t in shards_of(suffixes._first_digits(suffixes._quantiles(shards)), docs[k : k + 1], raws[k : k + 1]).items():
            sent[shard].append(t)
    marks, first = marks_of({k: pa.concat_tables(v) for k, v in sent.items()}, suffixes._stretch_marks)
    kind = pa.list_(pa.struct([("content", pa.int64()), ("mask", pa.int64())]))
    asked = pa.array([[{"content": c, "mask": m} for c, m in marks[k]] for k in range(len(texts))], kind)
    sent = shards_of(suffixes._last_digits(suffixes._even(shards)), docs, raws, asked)
    windows, last = marks_of(sent, suffixes._window_marks)
    return {k: sorted(v) for k, v in marks.items()}, {k: sorted(v) for k, v in windows.items()}, first, last


def test_shards_are_alike_though_landmarks_are_small():
    text = noise(random.Random(5), 400_000, "abcdefghijklmnop ").encode()
    sent = shards_of(suffixes._first_digits(suffixes._quantiles(16)), pa.array([1], pa.int64()), pa.array([text], pa.binary()))
    rows = [len(suffixes._arrays(suffixes._packs(sent[k])[0], 2)[1]) for k in range(16)]
    assert sum(rows) > 20_000 and max(rows) < 1.2 * min(rows)


def test_slices_of_a_shard_find_the_same(monkeypatch):
    rng = random.Random(11)
    passages = [noise(rng, rng.choice([60, 90, 200]), "ab") for _ in range(4)]
    texts = ["".join(rng.choice([*passages, noise(rng, 60, "abc")]) for _ in range(5)).encode() for _ in range(60)]
    whole = looked_at(texts, 2)[:2]
    assert len(whole[0]) > 40 and len(whole[1]) > 40
    for size in (7, 100):
        monkeypatch.setattr(suffixes, "SLICE", size)
        assert looked_at(texts, 2)[:2] == whole


def test_memory_of_a_passage_before_many_different_texts():
    rng = random.Random(12)
    passage = noise(rng, 90, "abcdefghij ")
    texts = [(passage + noise(rng, 40, "klmnopqrst")).encode() for _ in range(12_000)]
    docs, raws = pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.binary())
    found = suffixes.Stretches([*enumerate(texts)])
    asked = [[{"content": c, "mask": 0} for c in part.tolist()] for part in np.split(found.content.view(np.int64), np.cumsum(np.bincount(found.rows))[:-1])]
    kind = pa.list_(pa.struct([("content", pa.int64()), ("mask", pa.int64())]))
    sent = shards_of(suffixes._last_digits(suffixes._even(1)), docs, raws, pa.array(asked, kind))
    marks, most = marks_of(sent, suffixes._window_marks)
    assert len(marks) == len(texts) - 1 and most < 100e6


def diverged(rows, least):
    """Result rows of :func:`divergence.audit`."""
    docs = [(la or "", s or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) for _, t, la, s, _ in rows]
    found = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        held = Counter(t for _, _, terms in mine for t in set(terms))
        kept = [t for t in held if held[t] >= least]

        def shares(terms):
            n = Counter(terms)
            total = sum(n[t] for t in kept)
            return n, {t: 1 + 10**9 * (n[t] + 2) // (total + 2 * len(kept)) for t in kept}

        _, q = shares([t for _, _, terms in mine for t in terms])
        by_source = {s: shares([t for _, s2, terms in mine for t in terms if s2 == s]) for s in {d[1] for d in mine}}
        for s, (n, p) in by_source.items():
            f = lambda a, b: (a - b) ** 2 // (a + b)
            pairs = [(-sum(f(p[t], r[t]) for t in kept), o.encode(), o) for o, (_, r) in by_source.items() if o != s]
            terms = [(-f(p[t], q[t]), t.encode(), t) for t in kept if n[t] > 0 and p[t] > q[t]]
            found += [(lang, s, "pair", o, -v, k + 1) for k, (v, _, o) in enumerate(sorted(pairs))]
            found += [(lang, s, "term", t, -v, k + 1) for k, (v, _, t) in enumerate(sorted(terms)[:10])]
    return sorted(found)


def word_rows(seed, n=300):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "ÉTÉ", "été", "naïve", "x", "don't", "日本", "a_b", "WORD", "word", "😀", *(f"w{chr(97 + k)}" for k in range(20))]
    rows = []
    for i in range(n):
        source = rng.choice(["a", "b", "c", "é", None])
        own = vocabulary[: 12 + 4 * len((source or "").encode())]
        text = " ".join(rng.choices(own, k=rng.randrange(30)))
        rows.append((i, rng.choice([text, text, text, None]), rng.choice(["en", "en", "fr", None, "lone"]), source, 1))
    return [*rows, (900, "only one here", "sole", "q", 1), (901, "", "two", "q", 1), (902, "nothing kept", "two", "r", 1)]


@pytest.mark.parametrize("seed", range(2))
def test_divergences_by_brute_force(spark, seed, monkeypatch):
    rows = word_rows(seed)
    monkeypatch.setattr(divergence, "SHARD_TERMS", 5)
    monkeypatch.setattr(divergence, "_MERGE_ROWS", 20)
    found = divergence.audit(table(spark, rows).repartition(6))
    assert sorted(tuple(r) for r in found.collect()) == diverged(rows, 10)


def test_divergence_of_slices_and_long_texts(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(["óñ", "ab", "Çédille", "zz"], k=200_000 if i == 3 else 20_000)), "en", "ab"[i % 2], 1) for i in range(24)]
    assert sorted(tuple(r) for r in divergence.audit(table(spark, rows).coalesce(1)).collect()) == diverged(rows, 10)


def test_shares_are_exact_for_large_counts():
    for count, total, kept in ((0, 0, 1), (10**15, 10**15 + 7, 3), (3 * 10**15 + 1, 8 * 10**15, 10**6), (1, 10**9 + 7, 5)):
        assert int(divergence.share(np.array([count]), total, kept)[0]) == 1 + 10**9 * (count + 2) // (total + 2 * kept)


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(i, t, la, s, n):
    values = [None if v is None else str(v) for v in (i, s, la, n, t)]
    return digest(*("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def up(nodes):
    return [digest(*nodes[k : k + 2]) for k in range(0, len(nodes), 2)]


def path(nodes, place):
    """(siblings, root) of one leaf."""
    passed = []
    while len(nodes) > 1:
        other = place ^ 1
        passed.append((place & 1, nodes[other] if other < len(nodes) else ""))
        nodes, place = up(nodes), place // 2
    return passed, nodes[0]


def audited(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    names = sorted(trees, key=lambda la: (la is not None, (la or "").encode()))
    leaves = {la: sorted(((r[0] is not None, r[0] or 0, leaf_of(*r), r) for r in trees[la]), key=lambda x: x[:3]) for la in names}
    roots = [path([x[2] for x in leaves[la]], 0)[1] for la in names]
    found = []
    for k, la in enumerate(names):
        above, root = path(roots, k)
        for place, (_, _, leaf, r) in enumerate(leaves[la]):
            below, _ = path([x[2] for x in leaves[la]], place)
            i, t, _, s, n = r
            altered = i is not None and zlib.crc32(str(i).encode()) % 7 == 0 and n is not None
            node = leaf_of(i, t, la, s, n + 1) if altered else leaf
            for right, other in below + above:
                node = digest(other, node) if right else digest(node, other)
            found.append((i, leaf, roots[k], root, digest(*(o for _, o in below + above)), node, node == root))
    return sorted(found, key=str)


def audit(docs):
    return manifest.audit(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 0)


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 2, None: 1}, {"en": 65, "de": 64, "": 3}, {"en": 4200, "fr": 63, None: 129}])
def test_proofs_by_brute_force(spark, sizes):
    rng = random.Random(5)
    rows = [(rng.randrange(10**6), f"text {k}", la, rng.choice(["a", None]), rng.choice([k, None])) for la, n in sizes.items() for k in range(n)]
    rows += rows[: len(rows) // 3] if len(rows) > 100 else []
    found = [tuple(r) for r in audit(table(spark, rows)).collect()]
    assert sorted(found, key=str) == audited(rows)
    assert {r[-1] for r in found if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7} <= {True}


def test_proofs_of_many_trees_and_of_one_row_copied(spark):
    rows = [(k, "t", f"lang{k % 130}", "a", 1) for k in range(300)] + [(7, "copied", "en", "a", 3)] * 500
    assert sorted((tuple(r) for r in audit(table(spark, rows)).collect()), key=str) == audited(rows)


def test_some_requests_are_answered_alone(spark):
    """A request for few leaves gets the same paths; one for a leaf that is not there gets none."""
    leaves = spark.createDataFrame([("+en", k, digest(str(k))) for k in range(200)], "tree string, order long, leaf string")
    nodes = manifest.ranked(leaves, ["order", "leaf"]).selectExpr("tree", "n", "rank", "leaf AS digest")
    trees = manifest.build(nodes)
    none = F.array().cast("array<struct<at: int, others: array<string>>>")
    starts = trees.tops.select("tree", F.array("digest").alias("roots"), none.alias("path"))
    asked = spark.createDataFrame([("+en", 5, 50), ("+en", 199, 60), ("+en", 199, 61), ("+en", 900, 70), ("+xx", 1, 80)], "tree string, rank long, payload int")
    found = {r["payload"]: r for r in manifest.descend(trees, starts, asked).collect()}
    assert sorted(found) == [50, 60, 61]
    for payload, place in ((50, 5), (60, 199)):
        expected, root = path([digest(str(k)) for k in range(200)], place)
        got = [(p["at"], "".join(p["others"])) for p in reversed(found[payload]["path"])]
        assert got == [(right if other else 0, other) for right, other in expected]
        assert found[payload]["roots"] == [root] and found[payload]["digest"] == digest(str(place))


RUNS = {"bytes": suffixes.remove_repeats, "divergence": divergence.audit, "manifest": audit}


@pytest.mark.parametrize("name", sorted(RUNS))
def test_empty_tables(spark, name):
    assert RUNS[name](table(spark, ODD).where("false")).count() == 0


def test_odd_rows(spark):
    odd = table(spark, ODD)
    assert sorted((tuple(r) for r in RUNS["bytes"](odd).collect()), key=str) == repeats(ODD, 50)
    assert sorted((tuple(r) for r in RUNS["manifest"](odd).collect()), key=str) == audited(ODD)
    assert sorted(tuple(r) for r in RUNS["divergence"](odd).collect()) == diverged(ODD, 10)

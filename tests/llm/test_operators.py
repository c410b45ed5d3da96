"""Edge cases and properties of the operators on small tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from salescast.llm import chat, exact_dedup, language, mixing, pieces, quality, simhash, substring, token_counts, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, kept string, score string, `odd name` int"
LONG = " ".join(f"word{i % 977} and" for i in range(30_000))


def table(spark, rows):
    return spark.createDataFrame([(i, t, la, s, None, "x", "y", None, 1) for i, t, la, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (1, None, None, None), (2, "", "en", "a"), (3, "   \n\t ", "en", "b"), (4, LONG, "en", "a"),
        (5, "same text", "en", "a"), (5, "same text", "en", "a"), (6, "same  text", None, "b"), (7, "日本語 é 😀\n\nx", "ja", "c"),
        (None, "no id", "en", "a"), (None, None, None, None), (8, LONG + " end", "en", None), (9, "1234 !!", "de", "b"),
    ]
    return table(spark, rows)


PER_ROW = {
    "tokens": lambda d: token_counts.token_counts(d).select("doc_id").where("true"),
    "toxicity": lambda d: toxicity.score(d, toxicity.Model([("idiot", False)])),
    "simhash": simhash.near_groups,
    "language": lambda d: language.predict(d, language.fit(d)),
    "exact": exact_dedup.exact_groups,
    "mix": mixing.mix,
    "quality": quality.quality_rules,
    "substring": substring.remove_repeats,
    "pieces": pieces.encode,
}


@pytest.mark.parametrize("name", sorted(PER_ROW))
def test_odd_rows_each_give_a_row(odd, name):
    found = PER_ROW[name](odd)
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in found.select("doc_id").distinct().collect())
    assert ids == [(False, i) for i in range(1, 10)] + [(True, 0)]
    if name != "tokens":
        assert found.count() == odd.count()


@pytest.mark.parametrize("name", sorted(PER_ROW))
def test_empty_tables(odd, name):
    assert PER_ROW[name](odd.where("false")).count() == 0


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_and_empty_tables(spark, odd, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, odd, "")
    assert name == "sentencepiece" or out.columns == odd.columns
    assert out.count() <= 2 * odd.count()
    assert stage(spark, odd.where("false"), "").count() == 0


def test_stages_keep_one_of_each_copy(spark, odd):
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.exact_copies(spark, odd, "").collect()]
    texts = [exact_dedup.normal_bytes((t or "").encode()) for _, t in kept]
    assert len(texts) == len(set(texts)) == 8 and (5, "same text") in kept and (6, "same  text") not in kept


def test_verdicts_are_those_of_the_row_not_of_its_id(spark):
    """NULL ids and ids used again: a row neither falls nor stays with another."""
    rng = random.Random(8)
    prose = [" ".join(rng.choices("the of and to in is was that for it with as cat house river green".split(), k=120)) for _ in range(6)]
    junk = "x " * 5
    docs = table(spark, [(None, prose[0], "en", "a"), (None, junk, "en", "a"), (7, prose[1], "en", "a"), (7, junk, "en", "b")])
    assert sorted(r["text"] for r in corpus_pipeline.quality_rules(spark, docs, "").collect()) == sorted(prose[:2])
    # one group without an id, one group with an id that another text has too
    near = [prose[2], prose[2].upper(), prose[3], prose[3].upper(), prose[4], prose[5]]
    docs = table(spark, [(i, t, "en", "a") for i, t in zip([None, None, 8, 9, 9, None], near)])
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_copies(spark, docs, "").collect()]
    assert (8, prose[3]) in kept and (9, prose[4]) in kept and (None, prose[5]) in kept and len(kept) == 4
    # sources without ids keep their targets
    docs = table(spark, [(None, f"w{i} " * 20, "en", "abc"[i % 3]) for i in range(240)] + [(5, "same " * 20, "en", "c")] * 30)
    copies = sum(r["copies"] for r in mixing.mix(docs).collect())
    mixed = corpus_pipeline.mix_sources(spark, docs, "")
    assert mixed.count() == copies
    size = {r["source"]: r["n"] * 20 for r in mixed.groupBy("source").agg(F.count("*").alias("n")).collect()}
    target = {r["source"]: r["target"] for r in mixing.source_targets(docs.select("source", F.lit(20).alias("size"))).collect()}
    assert all(abs(size.get(s, 0) - t) <= 20 for s, t in target.items())


# exact dedup


def test_radix_trie_is_a_dictionary():
    rng = random.Random(5)
    trie, plain = exact_dedup.RadixTrie(), {}
    for _ in range(3000):
        key = bytes(rng.choice(b"ab") for _ in range(rng.randrange(12)))
        owner = rng.choice([None, rng.randrange(1000)])
        trie.insert(key, owner, 1)
        old, n = plain.get(key, (None, 0))
        known = [o for o in (old, owner) if o is not None]
        plain[key] = (min(known, default=None), n + 1)
    spilled = list(trie.spill())
    assert spilled and len({k[:1] for k, _, _ in spilled}) == 1
    assert {k: (o, n) for k, o, n in spilled + list(trie.drain())} == plain
    assert not list(trie.drain())


def test_a_small_trie_budget_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "TRIE_BYTES", 50)
    rows = [(i, f"text {i % 40} " + "x" * (i % 7), "en", "a") for i in range(400)]
    found = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.exact_groups(table(spark, rows)).collect()}
    by_text = {}
    for i, t, *_ in rows:
        by_text.setdefault(t, []).append(i)
    assert found == {i: (min(g), len(g)) for g in by_text.values() for i in g}


# mixing


def test_targets_are_met_and_no_document_is_taken_too_often(spark):
    rng = random.Random(1)
    sizes = {"a": 4000, "b": 600, "c": 60, None: 500}
    rows = [(len(sizes) * k + n, "w " * rng.randrange(1, 60), "en", s) for n, (s, m) in enumerate(sizes.items()) for k in range(m)]
    found = mixing.mix(table(spark, rows)).collect()
    total = sum(r["size"] for r in found)
    by_source = {}
    for r in found:
        assert r["copies"] <= 2 and r["taken"] == r["copies"] * r["size"]
        got = by_source.setdefault(r["source_size"], [r["target"], 0])
        got[1] += r["taken"]
    assert sum(t for t, _ in by_source.values()) == pytest.approx(1.5 * total, rel=1e-6)
    for size, (target, taken) in by_source.items():
        assert target <= 2 * size + 1e-6 and abs(taken - target) <= 0.05 * target + 120
    assert sorted(found) == sorted(mixing.mix(table(spark, rows[::-1]).repartition(7)).collect())


def test_the_mix_repeats_rows(spark):
    docs = table(spark, [(i, "a b c " * (i % 5 + 1), "en", "ab"[i % 2]) for i in range(200)])
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()}
    taken = {r["doc_id"]: r["count"] for r in mixing.take_mix(docs).groupBy("doc_id").count().collect()}
    assert taken == {i: n for i, n in copies.items() if n}


# substring dedup


def covered_by_brute_force(docs, width):
    first = {}
    for i in sorted(docs):
        words = docs[i].split()
        for k in range(len(words) - width + 1):
            first.setdefault(tuple(words[k : k + width]), i)
    out = {}
    for i, text in docs.items():
        words, gone = text.split(), set()
        for k in range(len(words) - width + 1):
            if first[tuple(words[k : k + width])] < i:
                gone.update(range(k, k + width))
        out[i] = (len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone))
    return out


@pytest.mark.parametrize("width,rounds,letters", [(50, 3, 400), (12, 2, 6), (9, 1, 2), (20, 3, 1)])
def test_repeats_by_brute_force(spark, width, rounds, letters):
    rng = random.Random(width)
    passages = [[f"w{rng.randrange(letters)}" for _ in range(rng.randrange(width, 3 * width))] for _ in range(6)]
    docs = {}
    for i in range(60):
        words = []
        for _ in range(rng.randrange(4)):
            words += [f"w{rng.randrange(letters)}" for _ in range(rng.randrange(2 * width))]
            passage = rng.choice(passages)
            cut = rng.randrange(len(passage) // 2)
            words += passage[cut:] if rng.random() < 0.5 else passage
        docs[i] = " ".join(words)
    rows = [(i, t, "en", "a") for i, t in docs.items()]
    found = substring.remove_repeats(table(spark, rows), width=width, rounds=rounds).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in found} == covered_by_brute_force(docs, width)


def test_equal_windows_pick_equal_anchors():
    rng = np.random.default_rng(3)
    shared = rng.integers(0, 1 << 62, 60).astype(np.uint64)
    one = np.concatenate([rng.integers(0, 1 << 62, 31).astype(np.uint64), shared, rng.integers(0, 1 << 62, 9).astype(np.uint64)])
    other = np.concatenate([rng.integers(0, 1 << 62, 8).astype(np.uint64), shared])
    names = np.concatenate([one, other])
    levels = substring.recompress(names, np.repeat([0, 1], [len(one), len(other)]))
    a, _ = substring.anchors(levels, np.arange(31, 31 + 11))
    b, _ = substring.anchors(levels, np.arange(len(one) + 8, len(one) + 8 + 11))
    assert (a == b).all()


# chat


def test_snapshots_collapse(spark):
    turns = {1: "abc", 2: "ab", 3: "abcd", 4: "abx", 5: "abx", 6: "z", 7: ""}
    rows = [(c, k, "user", t) for c, text in turns.items() for k, t in enumerate(text)]
    rows += [(3, 0, "user", "a")] * 3 + [(8, 0, None, None), (8, None, "user", "<|user|> hi"), (None, 0, "user", "q")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("n", F.lit(1))
    found = {r["conv_id"]: r for r in chat.format_chats(df).collect()}
    assert {c: (r["n_turns"], r["n_copies"]) for c, r in found.items()} == {3: (4, 1), 4: (3, 2), 6: (1, 1), 8: (2, 1), None: (1, 1)}
    assert found[6]["chat"] == "<|user|>\nz\n"
    assert found[8]["chat"] == "<|user|>\n< |user|> hi\n<|unknown|>\n\n"
    assert chat.format_chats(df.where("false")).count() == 0


# language


def test_families_and_undetermined(spark):
    assert language.family_of("en") == language.family_of("de") != language.family_of("fr")
    assert language.family_of("xx") == "xx"
    rows = [(i, ("the cat and the dog " if i % 3 else "ｘｙｚ жук и кот ") * 5, "en" if i % 3 else "ru", "a") for i in range(90)]
    docs = table(spark, rows + [(100, "123 ...", "en", "a"), (101, None, "ru", "a"), (102, "the dog", None, "a")])
    found = {r["doc_id"]: r for r in language.predict(docs, language.fit(docs)).collect()}
    assert all(found[i]["lang_pred"] == ("en" if i % 3 else "ru") for i in range(90))
    assert found[100]["lang_pred"] == found[101]["lang_pred"] == "und" and found[102]["lang_pred"] == "en"
    one = language.fit(docs.where("lang = 'ru'"))
    assert {r["lang_pred"] for r in language.predict(docs, one).collect()} == {"ru", "und"}
    assert {r["lang_pred"] for r in language.predict(docs, language.fit(docs.where("false"))).collect()} == {"und"}


# toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(new[-1] + 1, row[j + 1] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def test_automaton_accepts_what_the_edit_distance_allows():
    rng = random.Random(4)
    lexicon = [("idiot", False), ("worthless", False), ("scum", False), ("low", True), ("moron", False)]
    scanner = toxicity.Scanner(toxicity.Automaton(lexicon, frozenset({4})))
    limit = {0: 1, 1: 2, 2: 0, 4: 0}
    for _ in range(1500):
        word = list(rng.choice([t for t, _ in lexicon]))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(word) + 1)
            word[at : at + rng.randrange(2)] = rng.choice(["", "x", "o", "l"])
        word = "".join(word)
        if not word:
            continue
        near = [(distance(word, lexicon[t][0]), t) for t, n in limit.items() if distance(word, lexicon[t][0]) <= n]
        expected = [("low", 0)] if word.startswith("low") else [(lexicon[t][0], e) for e, t in [min(near)]] if near else []
        assert [(lexicon[t][0], e) for t, e, _ in scanner([f"a {word}, b".encode()])[0]] == expected


def test_quotation_weighs_less_than_abuse():
    weight = toxicity.context_weight
    assert weight("he said: “the word ", "” was used") < weight("what a ", " of a man")
    assert weight("“you ", "” he shouted") > weight("“an ", "” he shouted")


def test_misspellings_are_caught_and_clean_words_left_alone(spark):
    rng = random.Random(2)
    clean = "the cat sat on a mat while birds sang over green hills and rivers ran".split()
    rows = []
    for i in range(600):
        words = rng.choices(clean, k=30)
        if i % 5 == 0:
            words[rng.randrange(30)] = rng.choice(["dumbhead", "stinker"])
        rows.append((i, " ".join(words), int(i % 5 == 0)))
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    assert {t for t, _ in model.lexicon} == {"dumbhead", "stinker"}
    tests = [(1, "what a dumbhed on the hills"), (2, "the cat sat on a mat"), (3, "STINKER!!!"), (4, None), (5, "st*nker ran")]
    found = {r["doc_id"]: r["predicted"] for r in toxicity.score(spark.createDataFrame(tests, "doc_id long, text string"), model).collect()}
    assert found == {1: 1, 2: 0, 3: 1, 4: 0, 5: 1}


def test_every_term_of_a_broad_vocabulary_is_found_misspelt(spark):
    rng = random.Random(5)
    rude = ["".join(rng.choices("bdfgklmnprstvz", k=8)) for _ in range(100)]
    stems = ["wurmkopf", "wurmlump", "wurmsack"]
    clean = "the cat sat on a mat while birds sang over green hills and rivers ran".split()
    rows = []
    for i in range(3150):
        words = rng.choices(clean, k=30)
        if i % 5 == 0:
            k = i // 5
            words[rng.randrange(30)] = rude[k % 100] if k < 600 else stems[k % 3]
        rows.append((i, " ".join(words), int(i % 5 == 0)))
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    # no word is in 2 % of the toxic rows but those of one beginning, which does not replace them
    assert ("wurm", True) in model.lexicon or any(b and "wurm".startswith(t) for t, b in model.lexicon)
    assert {(w, False) for w in rude + stems} <= set(model.lexicon)
    tests = [w[:4] + w[5:] for w in rude] + ["wrmkopf", "wumlump", "wurnsack", "vurmkopf"]
    table = spark.createDataFrame([(i, f"what a {w} on the hills") for i, w in enumerate(tests)], "doc_id long, text string")
    assert toxicity.score(table, model).where("predicted = 0").count() == 0


def test_an_emptied_table_gives_the_same_hits(monkeypatch):
    lexicon, texts = [("worthless", False), ("idiot", False), ("low", True)], [b"a worthles idoit idot", b"lower", b"wortles x", None]
    scanner = toxicity.Scanner(toxicity.Automaton(lexicon))
    expected = [scanner([t])[0] for t in texts]
    monkeypatch.setattr(toxicity, "_TABLE_ITEMS", 0)
    assert [scanner([t])[0] for t in texts] == expected and sum(map(len, expected)) == 4


def test_without_toxic_rows_nothing_is_toxic(spark):
    train = spark.createDataFrame([(1, "a b c", 0), (2, "d", None)], "doc_id long, text string, toxic int")
    model = toxicity.fit(train)
    assert model.lexicon == [] and toxicity.score(train, model).where("predicted = 1").count() == 0


# token counts


def test_given_sections_may_overlap_and_leave_gaps(spark):
    docs = table(spark, [(1, "é😀 hello world", "en", "a"), (2, "abc", "en", "a")])
    sections = spark.createDataFrame([(1, 0, 0, 2), (1, 1, 1, 8), (1, 2, 3, 999), (1, 3, 5, 5)], "doc_id long, section int, start int, end int")
    found = {r["section"]: r for r in token_counts.token_counts(docs, sections).collect()}
    assert sorted(found) == [0, 1, 2, 3] and found[2]["end"] == 14
    assert found[3]["n_tokens"] == 0 and found[2]["n_tokens"] <= found[2]["doc_tokens"]
    assert found[0]["share"] + found[2]["share"] <= found[0]["doc_tokens"]


# pieces


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary(pieces.MODEL)


def chunked(vocabulary, text, size):
    text = " " + text
    cut = [(text[max(p - 1, 0) : p], text[p : p + size + vocabulary.longest - 1], min(size, len(text) - p)) for p in range(0, len(text), size)]
    states = pieces.scan([pieces.transfer(vocabulary, *c) for c in cut])
    ids = []
    for c, entry, leave in zip(cut, states, states[1:]):
        head, middle, tail = pieces.trace(vocabulary, *c, entry, leave)
        ids += head + pieces.encode_units(vocabulary, [middle])[0].tolist() + tail
    return ids


def cost(vocabulary, ids):
    known = {i: s for s, i in vocabulary.pieces.values()}
    return sum(known.get(i, 0) for i in ids)


@pytest.mark.parametrize("size", [16, 17, 23, 64])
def test_chunks_give_the_best_segmentation(vocabulary, size):
    texts = ["internationalization" * 9, "a" * 200, " " * 70 + "y", "日本語テキスト" * 9 + "x", "▁ a ▁b", "The quick brown fox\njumps over the lazy dog" * 4, "a"]
    for text in texts:
        whole = pieces.encode_units(vocabulary, [" " + text])[0].tolist()
        parts = chunked(vocabulary, text, size)
        assert pieces.decode_ids(vocabulary, parts) == pieces.decode_ids(vocabulary, whole) == text
        assert cost(vocabulary, parts) == cost(vocabulary, whole)
        bytes_ = set(vocabulary.byte_ids)
        assert [i for i in parts if i in bytes_] == [i for i in whole if i in bytes_]


def test_side_by_side_equals_one_by_one(vocabulary):
    rng = random.Random(6)
    words = [" " * rng.randrange(3) + "".join(rng.choices("etaoin shrdlu".replace(" ", "") + "éñ日", k=rng.randrange(1, 20))) for _ in range(400)]
    flat, counts = pieces._side_by_side(vocabulary, words)
    at = 0
    for word, n in zip(words, counts):
        assert flat[at : at + n].tolist() == pieces._trace(vocabulary, word)
        at += n


def test_long_documents_go_through_the_scan(spark, odd):
    decoded = pieces.decode(pieces.encode(odd, chunk=64), text_col="back")
    found = sorted((r["doc_id"] or 0, r["back"]) for r in decoded.collect())
    assert found == sorted((r["doc_id"] or 0, r["text"] or "") for r in odd.collect())

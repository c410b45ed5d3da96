"""Ids do not depend on how a text is cut, nor on how the scan is bracketed."""

import random

import numpy as np
import pytest

from salescast.llm import pieces


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary(pieces.MODEL)


def chunks_of(vocabulary, text, size):
    text = " " + text
    sizes = [(at, min(size, len(text) - at)) for at in range(0, len(text), size)]
    return [(text[max(at - 1, 0) : at], text[at : at + n + vocabulary.longest - 1], n) for at, n in sizes]


def probes():
    rng = random.Random(2)
    texts = [" " * 400, "a" * 400, "ab" * 200, "The quick brown fox jumps. " * 9, "日本語テキスト" * 20, "▁ a ▁b\x00\x01" * 9, "x", " "]
    for _ in range(120):
        letters = rng.choice(["a ", "ab", "  a", "aeiou", "the ", "abc 日😀", "\n\t =", "inter al"])
        texts.append("".join(rng.choices(letters, k=rng.randrange(1, 150))))
    return texts


@pytest.mark.parametrize("size", [17, 23, 64])
def test_ids_are_those_of_the_whole_text(vocabulary, size):
    for text in probes():
        cut = chunks_of(vocabulary, text, size)
        states = pieces.scan([pieces.transfer(vocabulary, *c) for c in cut])
        ids = []
        for c, entry, leave in zip(cut, states, states[1:]):
            head, middle, tail = pieces.trace(vocabulary, *c, entry, leave)
            ids += head + pieces.encode_units(vocabulary, [middle])[0].tolist() + tail
        assert ids == pieces.encode_units(vocabulary, [" " + text])[0].tolist()


def dense(element):
    return element.after if element.head is None else pieces._held(element.head[:, None] + element.after)


def test_products_do_not_depend_on_brackets(vocabulary):
    rng = random.Random(3)
    for text in ["ab" * 60, "the " * 30, " " * 90 + "y" * 40, "aaaa" * 20 + " b " * 9]:
        elements = [pieces.transfer(vocabulary, *c) for c in chunks_of(vocabulary, text, 17)]
        results = []
        for _ in range(4):
            parts = list(elements)
            while len(parts) > 1:
                k = rng.randrange(len(parts) - 1)
                parts[k : k + 2] = [pieces.product(parts[k], parts[k + 1])]
            results.append(dense(parts[0]))
        assert all((r == results[0]).all() for r in results)
        plain = dense(elements[0])
        for e in elements[1:]:
            plain = pieces._held((plain[:, :, None] + dense(e)[None]).max(axis=1))
        assert (plain == results[0]).all()


def test_elements_survive_their_bytes(vocabulary):
    for text in ("a" * 40, "the cat sat"):
        element = pieces.transfer(vocabulary, *chunks_of(vocabulary, text, 17)[0])
        again = pieces.Element.from_bytes(element.to_bytes())
        assert np.array_equal(again.after, element.after) and np.array_equal(again.order, element.order)
        assert (again.head is None) == (element.head is None)


@pytest.mark.parametrize("chunk", [17, 64])
def test_ids_in_spark_do_not_depend_on_the_chunk(spark, monkeypatch, chunk):
    """Blocks of three chunks, texts of a few to hundreds of chunks, the scans in Spark."""
    monkeypatch.setattr(pieces, "BLOCK", 3)
    texts = [*probes()[:40], None, "", "word " * 900, "a" * 5000, " " * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    whole = {r["doc_id"]: r["ids"] for r in pieces.encode(docs).collect()}
    cut = {r["doc_id"]: (r["ids"], r["text_md5"]) for r in pieces.encode(docs, chunk=chunk, digest=True).collect()}
    assert {k: ids for k, (ids, _) in cut.items()} == whole
    whole = {r["doc_id"]: r["text_md5"] for r in pieces.encode(docs, digest=True).collect()}
    assert {k: md5 for k, (_, md5) in cut.items()} == whole

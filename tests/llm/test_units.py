"""Units of texts: cut, counted and segmented in whole arrays, with the ids of one by one."""

import random
import re
import sys
from itertools import groupby

import numpy as np
import pytest

from salescast.llm import pieces


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary(pieces.MODEL)


def probes(vocabulary):
    rng = random.Random(4)
    known = sorted(vocabulary.known)
    texts = ["", " ", "a", "  ", "x\0\0y", " a  b ", "é" * 60 + " 😀 😀x", "▁ a ▁b\n\n", " " * 70, "ab" * 40]
    for _ in range(200):
        letters = rng.choice([known, list("etaoin shr"), list("  a\n"), list("日本語 😀é"), list("\x00 x\U0010ffff")])
        texts.append("".join(rng.choices(letters, k=rng.randrange(0, 120))))
    return texts


def test_work_in_python_does_not_grow_with_the_words(vocabulary):
    """Calls are counted, not seconds: one for each word of a text was most of the time once."""
    calls = []
    text = " the cat sat on the mat" * 5000
    pieces.encode_units(vocabulary, [" warm"])
    sys.setprofile(lambda frame, event, argument: calls.append(event) if event in ("call", "c_call") else None)
    try:
        ids = pieces.encode_units(vocabulary, [text])[0]
    finally:
        sys.setprofile(None)
    assert pieces.decode_ids(vocabulary, [0, *ids.tolist()])[1:] in text
    assert len(calls) < 5000  # 30,000 words


def test_units_begin_where_no_piece_can_reach(vocabulary):
    letters = "".join(re.escape(c) for c in sorted(vocabulary.known))
    unit = re.compile(f" *[{letters}]+| +|.", re.DOTALL)
    texts = probes(vocabulary)
    for some in (texts, texts[:1], texts[4:5], texts[::-1], []):
        units, single, sequence, firsts = pieces._units(vocabulary, some)
        assert len(set(units)) == len(units)
        found = [[units[k] for k in sequence[a:b]] for a, b in zip(firsts[:-1], firsts[1:])]
        assert found == [unit.findall(t) for t in some]
        assert single.tolist() == [u != " " and u not in vocabulary.known and len(u) == 1 for u in units]


def test_ids_of_units_are_those_of_one_by_one(vocabulary):
    texts = probes(vocabulary)
    expected = []
    for text in texts:
        ids = []
        for spelt, run in groupby(text, lambda c: c != " " and c not in vocabulary.known):
            ids += [i for c in run for i in vocabulary.spelt(c)] if spelt else pieces._trace(vocabulary, "".join(run))
        expected.append(ids)
    assert [ids.tolist() for ids in pieces.encode_units(vocabulary, texts)] == expected


def test_letters_lead_to_pieces_and_nowhere_else(vocabulary):
    prefixes = {p[:n] for p in vocabulary.pieces for n in range(1, len(p) + 1)}
    rng = random.Random(5)
    known = sorted(vocabulary.known)
    probes = sorted(prefixes) + [p + rng.choice(known) for p in sorted(vocabulary.pieces)]
    nodes = np.zeros(len(probes), np.int32)
    for n in range(max(map(len, probes))):
        here = np.flatnonzero([len(p) > n for p in probes])
        letters = vocabulary.letters[[ord(probes[k][n]) for k in here]]
        alive = (nodes[here] > 0) | (n == 0)
        nodes[here] = np.where(alive, vocabulary.step(nodes[here], letters), 0)
    ids = vocabulary.node_id[nodes]
    for probe, node, number in zip(probes, nodes, ids):
        assert (node > 0) == (probe in prefixes)
        assert number == vocabulary.pieces.get(probe, (0, -1))[1]

"""Letters of every plane, and columns with the names that stages use."""

import pytest

import corpus_pipeline
from salescast.llm import language, toxicity

MATHS = "".join(chr(0x1D400 + 26 + ord(c) - ord("a")) for c in "idiots")


def test_toxic_words_of_every_plane(spark):
    """A learned word in mathematical letters or rare ideographs is found; emoji are no letters."""
    rare = "\U00020000\U00020001\U00020002\U00020003"
    rows = []
    for i in range(400):
        toxic = i % 4 == 0
        word = [MATHS, rare][i % 8 == 0]
        rows.append((i, f"some plain words {'abcdefg'[i % 7] * (i % 5 + 1)} {word if toxic else 'friend'} 😀 {'hijkl'[i % 5] * 3} and more", int(toxic)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    known = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = toxicity.fit(toxicity.sample(docs, known))
    found = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    clean = [s for i, s in found.items() if i % 4]
    assert min(s for i, s in found.items() if i % 4 == 0) > 0.5 > max(clean)


def test_classes_agree_with_words():
    letters = {"a": 1, "*": 2, MATHS[0]: 3}
    text = "ab* 😀 " + MATHS + " \U00020000 1 ﹏￿ é"
    import numpy as np

    codes = np.array([ord(c) for c in text], np.uint32)
    classes = toxicity._classes(codes, toxicity._alphabet(letters), letters).tolist()
    assert classes == [letters.get(c, 4 if c.isalnum() else 0) for c in text]


@pytest.mark.parametrize("text, lettered", [("😀 123", False), ("İ", True), ("𝒽𝑒𝓁𝓁𝑜", True), ("𠀀", True), ("\U0001F600\U0001F4A9", False), ("ß", True), ("", False), (None, False)])
def test_letters_of_every_plane(text, lettered):
    _, found = language.vectors([None if text is None else text.encode()])
    assert found.tolist() == [lettered]


def test_texts_without_letters_are_und(spark):
    train = [(i, ["the cat and the dog walk", "der hund und die katze gehen"][i % 2], ["en", "de"][i % 2]) for i in range(60)]
    docs = spark.createDataFrame(train, "doc_id long, text string, lang string")
    asked = spark.createDataFrame([(1, "😀 123", None), (2, "İ", None), (3, None, None)], docs.schema)
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(asked, language.fit(docs)).collect()}
    assert found[1] == found[3] == ("und", 0.0) and found[2][0] in ("en", "de")


CLASHING = ["a.b", "_row_key", "_row_id", "_copies", "_times", "key", "row", "_kept_key", "_mix_key", "_keep_sha", "_place", "_copy", "kept", "a`b", "fp", "size", "_row_sha"]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES[:4]])
def test_stages_leave_columns_with_their_names_alone(spark, name):
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id < 60").collect()
    rows = [(*r, *[f"{c} of {r[0]}" for c in CLASHING]) for r in [*given, given[0]]]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join("`" + c.replace("`", "``") + "` string" for c in CLASHING)
    docs = spark.createDataFrame(rows, schema)
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, "")
    assert out.columns == docs.columns
    found = out.collect()
    assert found and {tuple(r) for r in found} <= set(rows)

"""Language identification in two steps: the family first, then languages within it.

Features are relative frequencies of hashed character n-grams of one to three
letters, with word boundaries, as square roots. Linear support vector machines
separate each pair of families, and within a family each pair of languages; the
pairs vote. Every machine is trained by one task on a bounded sample, and all of
them side by side. What reaches the driver is one weight vector per pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.llm.text import raw_texts, slices

#: About so many documents of each language are used for learning, chosen by a hash of their id.
TRAIN_ROWS_PER_LANGUAGE = 1_500
FEATURES = 1 << 12
UNDETERMINED = "und"

# Families of languages by ISO 639-1 code; any other code is a family of its own.
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca", "gl"],
    "slavic": ["ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk"],
    "uralic": ["fi", "et", "hu"],
    "baltic": ["lt", "lv"],
    "turkic": ["tr", "az", "kk", "uz"],
    "indic": ["hi", "bn", "ur", "mr", "pa", "gu", "ne"],
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}

_U = np.uint32
_TABLE: dict[str, np.ndarray] = {}


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang.lower(), lang)


def _lowered(c: str) -> int:
    """Code point of a letter in lower case, its own if that has several; 0 for anything else."""
    if not c.isalpha():
        return 0
    return ord(c.lower()) if len(c.lower()) == 1 else ord(c)


def _letters() -> np.ndarray:
    """:func:`_lowered` of the basic plane."""
    if "letters" not in _TABLE:
        _TABLE["letters"] = np.fromiter(map(_lowered, map(chr, range(1 << 16))), _U, 1 << 16)
    return _TABLE["letters"]


def _plain(codes: np.ndarray) -> np.ndarray:
    """:func:`_lowered` of code points of every plane."""
    plain = _letters()[np.minimum(codes, 0xFFFF)]
    beyond = codes > 0xFFFF
    if beyond.any():
        distinct, place = np.unique(codes[beyond], return_inverse=True)
        plain[beyond] = np.array([_lowered(chr(c)) for c in distinct.tolist()], _U)[place]
    return plain


def vectors(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(rows x FEATURES) unit vectors, and which texts have a letter."""
    result = np.zeros((len(texts), FEATURES), np.float32)
    lettered = np.zeros(len(texts), bool)
    for row, raw in enumerate(texts):
        codes = np.frombuffer((raw or b"").decode().encode("utf-32-le"), _U)
        plain = _plain(codes)
        keep = (plain > 0) | np.concatenate([[False], plain[:-1] > 0]) if len(plain) else plain > 0
        plain = np.concatenate([[_U(0)], plain[keep], [_U(0)]])  # each gap as one boundary
        if len(plain) < 3:
            continue
        lettered[row] = True
        one = plain[1:-1]
        two = plain[:-1] * _U(0x01000193) + plain[1:]
        three = two[:-1] * _U(0x01000193) + plain[2:]
        counts = np.zeros(FEATURES)
        for salt, grams in ((1, one), (2, two), (3, three)):
            slot = ((grams + _U(salt)) * _U(0x9E3779B1)) >> _U(20)
            counts += np.bincount(slot, minlength=FEATURES)
        root = np.sqrt(counts)
        result[row] = root / np.linalg.norm(root)
    return result, lettered


def _train_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights and bias of a linear support vector machine (squared hinge) by dual coordinate descent."""
    x = np.column_stack([x, np.ones(len(x), np.float32)]).astype(np.float32)
    alpha, w = np.zeros(len(x)), np.zeros(x.shape[1])
    slack = 0.5 / penalty
    norms = np.einsum("ij,ij->i", x, x) + slack
    order = np.random.default_rng(7)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(x)):
            gradient = y[i] * float(x[i] @ w) - 1 + slack * alpha[i]
            new = max(alpha[i] - gradient / norms[i], 0.0)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


@dataclass
class Model:
    #: Languages of each family.
    languages: dict[str, list[str]] = field(default_factory=dict)
    #: Weights (FEATURES and a bias) of the machine of a pair, positive for the first.
    machines: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)


def _problems(languages: list[str]) -> list[tuple[str, str, str]]:
    """(kind, one, other): pairs of families, and pairs of languages within a family."""
    families: dict[str, list[str]] = {}
    for lang in sorted(languages):
        families.setdefault(family_of(lang), []).append(lang)
    found = [("family", *pair) for pair in combinations(sorted(families), 2)]
    return found + [("language", *pair) for own in families.values() for pair in combinations(own, 2)]


def fit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    rows: int = TRAIN_ROWS_PER_LANGUAGE,
) -> Model:
    """A model from all languages of ``docs``, about ``rows`` documents of each.

    Rows with a NULL language are left out, texts without a letter too. Without
    rows the model knows no language and predicts ``und``.
    """
    known = docs.where(F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Model()
    share = F.lit(0)
    for lang, n in sorted(counts.items()):
        share = F.when(F.col("lang") == lang, int(1_000_000 * min(1.0, rows / n))).otherwise(share)
    sample = known.where(F.pmod(F.xxhash64(F.lit("sample"), "id"), F.lit(1_000_000)) < share)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            x, lettered = vectors(raw_texts(batch.column(0)))
            keep = np.flatnonzero(lettered)
            data = [x[k].tobytes() for k in keep]
            yield pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(keep)), pa.array(data, pa.binary())], ["lang", "x"])

    problems = _problems(list(counts))
    if not problems:
        return Model({family_of(lang): [lang] for lang in counts})
    members = {}
    for n, (kind, *pair) in enumerate(problems):
        for side, name in zip((1, -1), pair):
            for lang in counts:
                if (family_of(lang) if kind == "family" else lang) == name:
                    members.setdefault(lang, []).append((n, side))
    tasks = F.lit(None).cast("array<struct<n:int,y:int>>")
    for lang, own in members.items():
        pairs = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(y).alias("y")) for n, y in own])
        tasks = F.when(F.col("lang") == lang, pairs).otherwise(tasks)
    dealt = sample.select("text", "lang").mapInArrow(featured, "lang string, x binary").select(F.explode(tasks).alias("t"), "x")

    def train(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        x = np.frombuffer(b"".join(frame["x"]), np.float32).reshape(-1, FEATURES)
        order = np.lexsort(x[:, :8].T)  # the same whatever order rows arrive in
        y = frame["y"].to_numpy(float)
        return pd.DataFrame({"n": [key[0]], "w": [_train_svm(x[order], y[order]).astype(np.float32).tobytes()]})

    trained = dealt.select("t.n", "t.y", "x").groupBy("n").applyInPandas(train, "n int, w binary").collect()
    model = Model()
    for lang in sorted(counts):
        model.languages.setdefault(family_of(lang), []).append(lang)
    model.machines = {problems[r["n"]][1:]: np.frombuffer(r["w"], np.float32) for r in trained}
    return model


def _vote(x: np.ndarray, names: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(index of the winner, its confidence) by votes of the pairs; margins break ties."""
    votes = np.zeros((len(x), len(names)))
    margin = np.full((len(x), len(names)), np.inf)
    for a, b in combinations(range(len(names)), 2):
        w = model.machines.get((names[a], names[b]))
        if w is None:
            continue
        m = x @ w[:-1] + w[-1]
        squash = np.tanh(m) / 4
        votes[:, a] += (m > 0) + squash
        votes[:, b] += (m <= 0) - squash
        margin[:, a] = np.minimum(margin[:, a], m)
        margin[:, b] = np.minimum(margin[:, b], -m)
    best = votes.argmax(axis=1)
    return best, 1 / (1 + np.exp(-np.clip(4 * margin[np.arange(len(x)), best], -30, 30)))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, lang_pred, score (0 to 1).

    NULL texts and texts without a letter are ``und`` with score 0. Rows that
    repeat are each predicted. An empty table gives an empty result. Only the two
    named columns are read.
    """
    schema = pa.schema([(id_col, pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
    families = sorted(model.languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, 2 << 20):
            x, lettered = vectors(raw_texts(batch.column(1)))
            langs = np.full(len(x), UNDETERMINED, dtype=object)
            score = np.zeros(len(x))
            if families and len(x):
                family, sure = _vote(x, families, model)
                for k, name in enumerate(families):
                    rows = np.flatnonzero((family == k) & lettered)
                    if not len(rows):
                        continue
                    own = model.languages[name]
                    best, surer = _vote(x[rows], own, model)
                    langs[rows] = np.array(own, dtype=object)[best]
                    score[rows] = sure[rows] * surer
            columns = [batch.column(0), pa.array(langs.tolist(), pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` long, lang_pred string, score double")

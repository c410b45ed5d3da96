"""Toxicity by a learned lexicon, found also when misspelled, weighed by its context.

``fit`` learns a lexicon from labelled documents: words and word beginnings that
toxic documents have and others have not. Support counts different neighbours,
so a term that only copies of one document have is none.

The lexicon becomes a trie, and its product with Levenshtein automata becomes one
deterministic automaton: its states are the sets of (trie node, edits) that a
beginning of a word can be in. All words of a batch run through it side by side;
most die after a few letters. Words of five letters allow one edit, of nine two,
shorter ones and beginnings none, but words under a beginning are looked for
beside it. Every term has its edits, unless its misspellings stand in so many
clean training documents that with them it would be no term.

Each hit weighs by its edits and by the words around it: inside quotation marks
or after a verb of reporting it counts less, unless somebody is addressed.
A logistic model turns a document's largest and summed weights into its score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescast.llm.text import raw_texts, slices, stored

#: About so many labelled rows are used for learning, chosen by a hash of their id.
TRAIN_ROWS = 24_000
THRESHOLD = 0.3

_MIN_TOXIC, _MIN_CONTEXTS, _MIN_ODDS = 4, 3, math.log(50)
_PREFIXES = range(3, 9)
_FLUSH = 200_000
#: Trie nodes in the states of an automaton beyond which its table is emptied.
_TABLE_ITEMS = 8_000_000
_FUZZY_WEIGHT = {0: 1.0, 1: 0.95, 2: 0.85}
_INNER = "*@$"
_WORD = re.compile(r"[^\W_]+(?:[*@$][^\W_]+)*")

# Words that report speech, words that address somebody, quotation marks.
_REPORTING = set(
    "said says say wrote writes called calls quote quoted term word sagte sagt schrieb nannte zitat wort "
    "dit disait mot appelle cite dijo dice palabra llama cita".split()
)
_ADDRESS = set("you your yours u du dich dir ihr dein deine tu te toi vous votre tú usted ustedes vosotros".split())
_OPEN, _CLOSE = "\"“„«‹", "\"”“»›"


def terms_of(word: str) -> Iterator[tuple[str, bool]]:
    """The terms that a word supports: itself, and its beginnings; True marks a beginning."""
    if len(word) >= 3:
        yield word, False
    for n in _PREFIXES:
        if len(word) > n:
            yield word[:n], True


def split_words(lowered: str) -> list[str]:
    """Runs of letters and digits of a lower-cased text; ``*@$`` count between letters."""
    return _WORD.findall(lowered)


def _alphabet(letters: dict[str, int]) -> np.ndarray:
    """Class of each code point of the basic plane: 0 outside of words, else the letter's number or the last class."""
    table = np.fromiter((chr(c).isalnum() for c in range(1 << 16)), bool, 1 << 16).astype(np.int16)
    table[0xD800:0xE000] = 0
    table *= len(letters) + 1
    for letter, number in letters.items():
        if ord(letter) < 1 << 16:
            table[ord(letter)] = number
    return table


def _classes(codes: np.ndarray, table: np.ndarray, letters: dict[str, int]) -> np.ndarray:
    """As :func:`_alphabet`, for code points of every plane."""
    classes = table[np.minimum(codes, 0xFFFF)]
    beyond = codes > 0xFFFF
    if beyond.any():
        distinct, place = np.unique(codes[beyond], return_inverse=True)
        other = len(letters) + 1
        classes[beyond] = np.array([letters.get(c, other * c.isalnum()) for c in map(chr, distinct.tolist())], np.int16)[place]
    return classes


def _with_inner(codes: np.ndarray, inside: np.ndarray) -> np.ndarray:
    marks = np.isin(codes, [ord(c) for c in _INNER])
    flanked = np.zeros(len(codes), bool)
    flanked[1:-1] = marks[1:-1] & inside[:-2] & inside[2:]
    return inside | flanked


def _support(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, label) to partial (term, beginning, toxic, clean, contexts)."""
    toxic, clean, contexts = Counter(), Counter(), Counter()

    def flush():
        keys = list(toxic.keys() | clean.keys())
        columns = [[k[0] for k in keys], [k[1] for k in keys]]
        columns += [[c[k] for k in keys] for c in (toxic, clean, contexts)]
        for c in (toxic, clean, contexts):
            c.clear()
        types = [pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]
        names = ["term", "beginning", "toxic", "clean", "contexts"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    for batch in slices(batches, 0):
        for raw, label in zip(raw_texts(batch.column(0)), batch.column(1).to_pylist()):
            tokens = split_words((raw or b"").decode().lower())
            if label:
                near = {}
                for before, word, after in zip(["", *tokens], tokens, [*tokens[1:], ""]):
                    # 63 kinds of neighbours, told apart by their lengths and letters
                    kind = 1 << (sum(map(ord, before)) * 31 + sum(map(ord, after))) % 63
                    for term in terms_of(word):
                        near[term] = near.get(term, 0) | kind
                toxic.update(near.keys())
                for term, kinds in near.items():
                    contexts[term] |= kinds
            else:
                clean.update({term for word in set(tokens) for term in terms_of(word)})
        if len(toxic) + len(clean) > _FLUSH:
            yield flush()
    if toxic or clean:
        yield flush()


def _odds(toxic: float, clean: float, n1: int, n0: int) -> float:
    return math.log((toxic + 0.5) / (n1 + 1)) - math.log((clean + 0.5) / (n0 + 1))


def learn_lexicon(train: DataFrame) -> tuple[list[tuple[str, bool]], list[tuple[int, int]]]:
    """(term, beginning), and the toxic and clean documents of each, from (text, label) rows.

    What limits the lexicon is the support and the odds of a term, not a number
    of terms. A beginning stands beside the words under it, which keep their edits.
    """
    counted = train.groupBy().agg(F.sum("label"), F.count("*")).first()
    n1, n0 = counted[0] or 0, counted[1] - (counted[0] or 0)
    if not n1:
        return [], []
    support = train.mapInArrow(_support, "term string, beginning boolean, toxic long, clean long, contexts long")
    support = support.groupBy("term", "beginning").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.bit_count(F.bit_or("contexts")).alias("contexts")
    )
    odds = F.log((F.col("toxic") + 0.5) / (n1 + 1)) - F.log((F.col("clean") + 0.5) / (n0 + 1))
    frequent = (F.col("toxic") >= _MIN_TOXIC) & (F.col("contexts") >= _MIN_CONTEXTS)
    good = support.where(frequent & (odds >= _MIN_ODDS)).select("term", "beginning", "toxic", "clean").collect()
    good.sort(key=lambda r: (-r.toxic, len(r.term), r.term, r.beginning))
    words = [r for r in good if not r.beginning]
    covered: dict[str, int] = {}
    for r in words:
        for n in _PREFIXES:
            if len(r.term) >= n:
                covered[r.term[:n]] = max(covered.get(r.term[:n], 0), r.toxic)
    chosen: dict[str, object] = {}
    for r in good:
        # a beginning has to catch clearly more than the best single word under it
        if r.beginning and r.toxic > 1.5 * covered.get(r.term, 0) and not any(r.term[:n] in chosen for n in _PREFIXES):
            chosen[r.term] = r
    terms = sorted([*chosen.values(), *words], key=lambda r: (-r.toxic, r.term, r.beginning))
    return [(r.term, r.beginning) for r in terms], [(r.toxic, r.clean) for r in terms]


def edits_allowed(term: str, beginning: bool) -> int:
    return 0 if beginning or len(term) < 5 else 1 if len(term) < 9 else 2


class Automaton:
    """The deterministic product of a lexicon trie and Levenshtein automata.

    A state has the fewest edits for each trie node a beginning of a word can be
    at. A state, and a step from it, is worked out when a word first needs it, so
    a lexicon may be of any size; between batches a full table is emptied.
    """

    def __init__(self, lexicon: Sequence[tuple[str, bool]], exact: frozenset[int] = frozenset()):
        self.letters = {c: k + 1 for k, c in enumerate(sorted({c for term, _ in lexicon for c in term}))}
        self.n_classes = len(self.letters) + 2
        self.limits = [0 if n in exact else edits_allowed(*t) for n, t in enumerate(lexicon)]
        self.children: list[dict[int, int]] = [{}]
        self.words: list[int] = [-1]
        self.stems: list[int] = [-1]
        self.budget: list[int] = [0]
        for number, (term, beginning) in enumerate(lexicon):
            node, allowed = 0, self.limits[number]
            self.budget[0] = max(self.budget[0], allowed)
            for c in term:
                k = self.letters[c]
                if k not in self.children[node]:
                    self.children[node][k] = len(self.children)
                    self.children.append({})
                    self.words.append(-1)
                    self.stems.append(-1)
                    self.budget.append(0)
                node = self.children[node][k]
                self.budget[node] = max(self.budget[node], allowed)
            (self.stems if beginning else self.words)[node] = number
        self._empty()

    def _empty(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.states: list[bytes] = []
        self.size = 0
        self.table = np.zeros((64, self.n_classes), np.int32)
        self.term, self.edits, self.stem = (np.zeros(64, np.int32) for _ in range(3))
        self.variants: list[tuple[int, ...]] = []
        self._number({})
        self.table[0] = 0
        self._number(self._closed({0: 0}))

    def _closed(self, state: dict[int, int]) -> dict[int, int]:
        """With the deletions of letters of the term."""
        stack = list(state.items())
        while stack:
            node, edits = stack.pop()
            for child in self.children[node].values():
                if edits < min(self.budget[child], state.get(child, 9) - 1):
                    state[child] = edits + 1
                    stack.append((child, edits + 1))
        return state

    def _step(self, number: int, k: int) -> dict[int, int]:
        found: dict[int, int] = {}
        items = np.frombuffer(self.states[number], np.int32)
        for node, edits in zip((items >> 2).tolist(), (items & 3).tolist()):
            child = self.children[node].get(k)
            if child is not None and edits < found.get(child, 9):
                found[child] = edits
            if edits < self.budget[node]:
                if edits + 1 < found.get(node, 9):
                    found[node] = edits + 1
                for c in self.children[node].values():
                    if edits < self.budget[c] and edits + 1 < found.get(c, 9):
                        found[c] = edits + 1
        return self._closed(found)

    def _number(self, state: dict[int, int]) -> int:
        key = np.sort(np.array([node << 2 | edits for node, edits in state.items()], np.int32)).tobytes()
        number = self.numbers.get(key)
        if number is not None:
            return number
        number = self.numbers[key] = len(self.states)
        self.states.append(key)
        self.size += len(state)
        if number == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.term, self.edits, self.stem = (np.concatenate([x, x]) for x in (self.term, self.edits, self.stem))
        hits = sorted((e, self.words[n]) for n, e in state.items() if self.words[n] >= 0 and e <= self.limits[self.words[n]])
        self.table[number, 1:] = -1
        self.edits[number], self.term[number] = hits[0] if hits else (0, -1)
        self.stem[number] = max((self.stems[n] for n, e in state.items() if e == 0), default=-1)
        self.variants.append(tuple(t for _, t in hits) if hits and hits[0][0] else ())
        return number

    def hits(self, classes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(word, term, edits, state) of the words that begin at ``starts`` and are in the language."""
        if self.size > _TABLE_ITEMS:
            self._empty()
        word, at = np.arange(len(starts)), starts.copy()
        state = np.ones(len(starts), np.int32)
        found = []
        while len(word):
            k = classes[at]
            over = k == 0
            ended = over & (self.term[state] >= 0)
            found.append((word[ended], self.term[state[ended]], self.edits[state[ended]], state[ended]))
            unknown = self.table[state, k] < 0
            for s, c in map(lambda x: divmod(x, self.n_classes), np.unique(state[unknown].astype(np.int64) * self.n_classes + k[unknown]).tolist()):
                number = self._number(self._step(s, c))
                self.table[s, c] = number
            state = self.table[state, k]
            stem = self.stem[state] >= 0
            found.append((word[stem], self.stem[state[stem]], np.zeros(stem.sum(), np.int32), np.zeros(stem.sum(), np.int32)))
            alive = (state > 0) & ~stem & ~over
            word, at, state = word[alive], at[alive] + 1, state[alive]
        return tuple(np.concatenate(x) for x in zip(*found)) if found else tuple(np.zeros(0, np.int64) for _ in range(4))


@lru_cache(1)
def _automaton(lexicon: tuple[tuple[str, bool], ...], exact: frozenset[int]) -> Automaton:
    """The automaton of a Python worker, kept from task to task."""
    return Automaton(lexicon, exact)


def context_weight(left: str, right: str) -> float:
    """Weight of a hit from the text around it: 1 as abuse, less as a quotation."""
    opened = max(map(left.rfind, _OPEN))
    quoted = opened >= 0 and any(c in right for c in _CLOSE) and not (left[opened] == '"' and left.count('"') % 2 == 0)
    before = set(split_words(left)[-6:])
    near = before.union(split_words(right)[:6])
    weight = (0.4 if quoted else 1.0) * (0.6 if before & _REPORTING else 1.0)
    return max(weight, 0.7) if near & _ADDRESS else weight


@dataclass
class Model:
    lexicon: list[tuple[str, bool]] = field(default_factory=list)
    exact: frozenset[int] = frozenset()
    weights: tuple[float, ...] = (-4.0, 6.0, 1.0)


_SIDE = 120


class Scanner:
    """Runs a model's automaton over batches of texts."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.table = _alphabet(automaton.letters)

    def __call__(self, texts: list[bytes | None]) -> list[list[tuple[int, int, float]]]:
        """(term, edits, context weight) of the hits in each text."""
        return self.scan(texts)[0]

    def scan(self, texts: list[bytes | None]) -> tuple[list[list[tuple[int, int, float]]], list[set[int]]]:
        """The hits in each text, and all terms that misspelt words of it can stand for."""
        lowered = [(raw or b"").decode().lower() for raw in texts]
        joined = "\n".join(lowered) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        classes = _classes(codes, self.table, self.automaton.letters)
        inside = _with_inner(codes, classes > 0)
        classes[inside & (classes == 0)] = self.automaton.n_classes - 1
        starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
        ends = np.cumsum([len(t) + 1 for t in lowered])
        word, term, edits, state = self.automaton.hits(classes, starts)
        place = starts[word]
        found: list[list] = [[] for _ in texts]
        misspelt: list[set[int]] = [set() for _ in texts]
        docs = np.searchsorted(ends, place, "right").tolist()
        for doc, at, t, e, s in zip(docs, place.tolist(), term.tolist(), edits.tolist(), state.tolist()):
            end = int(ends[doc])
            left = joined[max(end - len(lowered[doc]) - 1, at - _SIDE) : at]
            right = joined[at : min(end, at + _SIDE)]
            after = next((k for k, c in enumerate(right) if not (c.isalnum() or c in _INNER)), len(right))
            found[doc].append((t, e, context_weight(left, right[after:])))
            misspelt[doc].update(self.automaton.variants[s])
        return found, misspelt


def features(hits: list[tuple[int, int, float]]) -> tuple[float, float]:
    """(largest weight, log of one plus their sum) of a document's hits."""
    weights = [_FUZZY_WEIGHT[e] * w for _, e, w in hits]
    return max(weights, default=0.0), math.log1p(sum(weights))


def _train_features(model: Model):
    schema = pa.schema([("label", pa.int64()), ("x1", pa.float64()), ("x2", pa.float64()), ("fuzzy", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(_automaton(tuple(model.lexicon), model.exact))
        for batch in slices(batches, 0):
            rows = []
            for label, hits, terms in zip(batch.column(1).to_pylist(), *scanner.scan(raw_texts(batch.column(0)))):
                rows.append((label, *features(hits), [] if label else sorted(terms)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, penalty: float = 0.1) -> np.ndarray:
    """Penalised logistic regression with an intercept by Newton steps; ``n`` weighs rows."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-3, *[penalty] * (x.shape[1] - 1)])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (n * (y - p)) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(train: DataFrame, text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model from labelled rows; pass a bounded sample, see :func:`sample`.

    Rows with a NULL label are left out; NULL texts are empty. Without a toxic
    row the lexicon is empty and every document gets the same low score.
    """
    rows = train.where(F.col(label_col).isNotNull()).select(
        F.col(text_col).cast("string").alias("text"), (F.col(label_col) == 1).cast("long").alias("label")
    )
    lexicon, support = learn_lexicon(rows)
    if not lexicon:
        return Model()
    exact: frozenset[int] = frozenset()
    columns = "label long, x1 double, x2 double, fuzzy array<long>"
    seen = rows.mapInArrow(_train_features(Model(lexicon, exact)), columns).toPandas()
    clean = seen[seen.label == 0]
    misspelt = Counter(t for terms in clean.fuzzy for t in terms)
    n1, n0 = len(seen) - len(clean), len(clean)
    # with its misspellings a term has to keep the odds of a term
    exact = frozenset(
        t for t, n in misspelt.items()
        if n > max(2, 0.001 * n0) or _odds(support[t][0], support[t][1] + n, n1, n0) < _MIN_ODDS
    )
    if exact:
        seen = rows.mapInArrow(_train_features(Model(lexicon, exact)), columns).toPandas()
    x = seen[["x1", "x2"]].to_numpy()
    weights = _logistic(x, seen.label.to_numpy(float), np.ones(len(x)))
    return Model(lexicon, exact, tuple(weights.tolist()))


def sample(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    rows: int = TRAIN_ROWS,
    keep: Column | None = None,
) -> DataFrame:
    """About ``rows`` labelled documents, chosen by a hash of their id.

    The labels that are chosen are so few that they go to every task; texts are
    not shuffled. The sample is written once, as several passes read it.
    """
    labels = labels.where(keep) if keep is not None else labels
    share = min(1.0, rows / max(labels.count(), 1))
    part = F.pmod(F.xxhash64(F.lit("sample"), F.col(id_col)), F.lit(1_000_000)) < int(share * 1_000_000)
    docs = docs.where(keep) if keep is not None else docs
    return stored(docs.where(part).join(F.broadcast(labels.where(part)), id_col))


def _score(model: Model, id_col: str, threshold: float):
    schema = pa.schema([(id_col, pa.int64()), ("score", pa.float64()), ("predicted", pa.int32()), ("n_hits", pa.int64())])
    bias, largest, summed = model.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(_automaton(tuple(model.lexicon), model.exact))
        for batch in slices(batches, 1):
            found = scanner(raw_texts(batch.column(1)))
            x = np.array([features(hits) for hits in found])
            score = 1 / (1 + np.exp(-np.clip(bias + largest * x[:, 0] + summed * x[:, 1], -30, 30)))
            columns = [batch.column(0), score, (score >= threshold).astype(np.int32), np.array([len(h) for h in found])]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], schema=schema)

    return run


def score(
    docs: DataFrame,
    model: Model,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of ``docs``: id, score (0 to 1), predicted, n_hits.

    NULL and empty texts have no hits and get the score of such. Rows that repeat
    are each scored. An empty table gives an empty result. Only the two named
    columns are read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_score(model, id_col, threshold), f"`{id_col}` long, score double, predicted int, n_hits long")

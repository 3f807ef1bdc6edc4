"""Toxicity: Levenshtein automata run along a lexicon trie, with context windows that tell quotation from abuse."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from claimscope.llm.common import stored

WORDS = re.compile(r"[^\W_]+")
#: Labelled documents of each class that the lexicon and the weights are learned from, at most: the toxic ones, and others.
TOXIC_SAMPLE, OTHER_SAMPLE = 4_000, 8_000
#: Shortest and longest beginnings of words that may become stems.
SHORTEST, LONGEST = 3, 24
#: Characters on either side of a hit in which quotation is looked for.
WINDOW = 60
# Marks and words that show that something is quoted or talked about.
OPENING, CLOSING = "\"“„«‘‹", "\"”“»’›"
REPORTING = frozenset("said says wrote writes called calls quote quoted quoting reported term word slur insult dit disait mot sagte schrieb wort dijo palabra".split())
#: Means and precision of the weights before any label is seen: none, exact hits, misspelled hits, quoted hits.
PRIOR, PRECISION = (-3.0, 4.5, 4.5, 0.5), 0.05


class LexiconAutomaton:
    """Finds lexicon terms in words: whole terms within a few edits, stems at the beginning of a word exactly.

    All terms lie in one trie. A state is the set of (trie node, edits so far) that a Levenshtein automaton of any term
    could be in; states and steps are made when first met and remembered, within bounds, so most words are refused
    after a few characters. Terms of 5 letters or more allow one edit, of 9 or more two.
    """

    STATES = 200_000

    def __init__(self, words: Sequence[str], stems: Sequence[str]):
        self.children: list[dict[str, int]] = [{}]
        self.ends, self.stem, self.edits = [-1], [False], [0]
        for word in words:
            allowed = 0 if len(word) < 5 else 1 if len(word) < 9 else 2
            for node in self._insert(word):
                self.edits[node] = max(self.edits[node], allowed)
            self.ends[node] = allowed
        for stem in stems:
            self.stem[self._insert(stem)[-1]] = True
        self._reset()

    def _insert(self, term: str) -> list[int]:
        path = [0]
        for c in term:
            at = self.children[path[-1]]
            if c not in at:
                at[c] = len(self.children)
                self.children.append({})
                self.ends.append(-1)
                self.stem.append(False)
                self.edits.append(0)
            path.append(at[c])
        return path

    def _close(self, items: dict[int, int]) -> frozenset[tuple[int, int]]:
        """Adds what is reached by leaving out letters of a term; keeps the fewest edits of each node."""
        todo = list(items.items())
        while todo:
            node, e = todo.pop()
            for child in self.children[node].values():
                if e + 1 <= self.edits[child] and items.get(child, 99) > e + 1:
                    items[child] = e + 1
                    todo.append((child, e + 1))
        return frozenset(items.items())

    def _reset(self) -> None:
        self.ids: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.accept: list[tuple[int, bool]] = []
        self.start = self._state(self._close({0: 0}))

    def _state(self, items: frozenset) -> int:
        """Number of a state; -1 where nothing can match any more."""
        if not items:
            return -1
        if items not in self.ids:
            self.ids[items] = len(self.sets)
            self.sets.append(items)
            self.steps.append({})
            whole = min((e for n, e in items if 0 <= self.ends[n] >= e), default=-1)
            self.accept.append((whole, any(e == 0 and self.stem[n] for n, e in items)))
        return self.ids[items]

    def _step(self, state: int, c: str) -> int:
        items: dict[int, int] = {}

        def reach(node: int, e: int) -> None:
            if (e == 0 or e <= self.edits[node]) and items.get(node, 99) > e:
                items[node] = e

        for node, e in self.sets[state]:
            reach(node, e + 1)
            for letter, child in self.children[node].items():
                reach(child, e if letter == c else e + 1)
        return self._state(self._close(items))

    def edits_to(self, word: str) -> int:
        """Edits to the nearest term, 0 also for a stem that begins the word; -1 where no term is near enough."""
        if len(self.sets) > self.STATES:
            self._reset()
        at = self.start
        for c in word:
            after = self.steps[at].get(c)
            if after is None:
                after = self.steps[at][c] = self._step(at, c)
            if after < 0:
                return -1
            at = after
            if self.accept[at][1]:
                return 0
        return self.accept[at][0]


@dataclass
class ToxicityModel:
    words: list[str] = field(default_factory=list)
    stems: list[str] = field(default_factory=list)
    spared: list[str] = field(default_factory=list)  # words of their own that are near a term
    weights: tuple[float, ...] = PRIOR

    def scorer(self) -> Scorer:
        return Scorer(self)


def quoted(text: str, start: int, end: int) -> bool:
    """Whether a hit stands between quotation marks of one line, or soon after a word of reporting, in its window."""
    left = text[max(0, start - WINDOW):start].rpartition("\n")[2]
    right = text[end:end + WINDOW].partition("\n")[0]
    opened = max(left.rfind(c) for c in OPENING)
    closed = max(left.rfind(c) for c in CLOSING if c not in OPENING)
    if opened > closed and any(c in right for c in CLOSING):
        return True
    return any(w in REPORTING for w in WORDS.findall(left.lower())[-3:])


class Scorer:
    """Scores texts; remembers a bounded number of words without a hit."""

    REMEMBERED = 500_000

    def __init__(self, model: ToxicityModel):
        self.automaton = LexiconAutomaton(model.words, model.stems)
        self.weights = model.weights
        self.spared = frozenset(model.spared)
        self.clean: set[str] = set()

    def features(self, text: str | None) -> tuple[float, float, float]:
        """Logarithms of one more than the exact, the misspelled and the quoted hits."""
        if not text:
            return 0.0, 0.0, 0.0
        lowered = text.lower()
        hits = {}
        if len(self.clean) > self.REMEMBERED:
            self.clean.clear()
        for word in set(WORDS.findall(lowered)) - self.clean - self.spared:
            e = self.automaton.edits_to(word)
            if e < 0:
                self.clean.add(word)
            else:
                hits[word] = e
        if not hits:
            return 0.0, 0.0, 0.0
        counts = [0, 0, 0]
        whole = text if len(text) == len(lowered) else lowered
        for m in WORDS.finditer(lowered):
            e = hits.get(m[0])
            if e is not None:
                counts[2 if quoted(whole, m.start(), m.end()) else min(e, 1)] += 1
        return tuple(math.log1p(c) for c in counts)

    def score(self, text: str | None) -> float:
        z = self.weights[0] + sum(w * x for w, x in zip(self.weights[1:], self.features(text), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def choose_terms(rows: list[tuple[str, int, int]], toxic: int, other: int, tried: int) -> tuple[list[str], list[str]]:
    """Words and stems that point to toxic documents, from (beginning, contexts in toxic, in other documents).

    ``$`` ends a whole word. A beginning counts if at least 95 % of its contexts are toxic and chance would hardly make
    any of the ``tried`` beginnings so; of those that continue each other, the longest that keeps nine tenths of the contexts.
    """
    base = min(max(toxic / max(toxic + other, 1), 1e-6), 1 - 1e-6)
    needed = math.log(max(tried, 2)) + 1
    counts = {}
    for term, pos, neg in rows:
        p = pos / (pos + neg)
        if p >= 0.95:
            gain = pos * math.log(p / base) + (neg * math.log((1 - p) / (1 - base)) if neg else 0.0)
            if gain >= needed:
                counts[term] = pos
    longer: dict[str, list[str]] = {}
    for term in counts:
        longer.setdefault(term[:-1], []).append(term)
    chosen = set()
    for term in counts:
        if term[:-1] in counts:
            continue
        while True:
            best = max(longer.get(term, []), key=lambda t: (counts[t], t), default=None)
            if best is None or counts[best] < 0.9 * counts[term]:
                break
            term = best
        chosen.add(term)
    return sorted(t[:-1] for t in chosen if t.endswith("$")), sorted(t for t in chosen if not t.endswith("$"))


def with_misspelled(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Adds each toxic row once more, at a quarter of its weight, with its exact hits taken for misspelled ones. So
    misspelled hits get a weight even where the labelled rows have none, held down by those that clean rows have."""
    hit = (y == 1) & (x[:, 0] > 0)
    moved = x[hit].copy()
    moved[:, 1] = np.log1p(np.expm1(moved[:, 0]) + np.expm1(moved[:, 1]))
    moved[:, 0] = 0
    return np.concatenate([x, moved]), np.concatenate([y, y[hit]]), np.concatenate([n, n[hit] / 4])


def fit_weights(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, ...]:
    """Logistic regression of rows that count ``n`` times, by Newton steps from the prior means; without rows it gives those."""
    prior = np.array(PRIOR)
    w = prior.copy()
    full = np.column_stack([np.ones(len(x)), x]) if len(x) else np.empty((0, len(prior)))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -30, 30)))
        slope = full.T @ (n * (y - p)) - PRECISION * (w - prior)
        bend = (full.T * (n * p * (1 - p))) @ full + PRECISION * np.eye(len(prior))
        step = np.linalg.solve(bend, slope)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(w.tolist())


def held_out(id_col: Column) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text, divisible by 5. A null id is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          toxic_sample: int = TOXIC_SAMPLE, other_sample: int = OTHER_SAMPLE) -> ToxicityModel:
    """Lexicon and weights from labelled documents that are not held out.

    The sample takes at most ``toxic_sample`` toxic and ``other_sample`` other documents, those whose ids hash lowest;
    its texts are read whole. Words near a term that other documents of the sample hold as often are words of their own, not
    misspellings. Words count once for each pair of neighbours, so copies of a document count once.
    Documents without a label, labels without a document and null labels are left out; of several labels of a
    document the highest counts.
    """
    known = labels.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{label_col}`").cast("int").alias("label")).where(
        F.col("label").isNotNull() & F.col("doc").isNotNull() & ~held_out(F.col("doc")))
    known = known.groupBy("doc").agg(F.max("label").alias("label"))
    texts = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    order = [F.xxhash64("doc"), F.col("doc")]
    picked = known.where("label = 1").orderBy(*order).limit(toxic_sample).unionAll(known.where("label <> 1").orderBy(*order).limit(other_sample))
    sample = stored(texts.join(F.broadcast(picked), "doc").select("label", "text"), "toxic-sample")

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()

        def handed_on() -> pa.RecordBatch:
            cols = list(zip(*seen, strict=True)) or [[]] * 3
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.bool_(), pa.int64()), strict=True)], ["word", "toxic", "context"])

        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = WORDS.findall((text.as_py() or "").lower())
                for before, word, after in zip(["", *words], words, [*words[1:], ""], strict=False):
                    seen.add((word, label == 1, xxhash.xxh3_64_intdigest(f"{before} {after}") >> 1))
                if len(seen) > 100_000:
                    yield handed_on()
        yield handed_on()

    met = sample.mapInArrow(contexts, "word string, toxic boolean, context long").distinct()
    by_word = stored(met.groupBy("word").agg(F.count(F.when(F.col("toxic"), 1)).alias("pos"), F.count(F.when(~F.col("toxic"), 1)).alias("neg")), "toxic-words")
    toxic, other = by_word.agg(F.coalesce(F.sum("pos"), F.lit(0)), F.coalesce(F.sum("neg"), F.lit(0))).first()
    lengths = F.sequence(F.lit(SHORTEST), F.least(F.length("word") + 1, F.lit(LONGEST)))
    starts = by_word.where(F.length("word") >= SHORTEST - 1).select(
        F.explode(F.transform(lengths, lambda n: F.concat("word", F.lit("$")).substr(F.lit(1), n))).alias("term"), "pos", "neg")
    starts = starts.groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).where(F.col("pos") + F.col("neg") >= 3)
    starts = stored(starts, "toxic-beginnings")
    precise = starts.where(F.col("pos") >= 19 * F.col("neg"))  # of a bounded sample
    words, stems = choose_terms([tuple(r) for r in precise.collect()], toxic, other, starts.count())

    automaton = LexiconAutomaton(words, stems)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([automaton.edits_to(w) > 0 for w in batch.column(0).to_pylist()], pa.bool_()))

    # what other documents hold is no misspelling; of a bounded sample
    spared = sorted(r["word"] for r in by_word.where("neg > 0 AND neg >= pos").select("word").mapInArrow(near, "word string").collect())
    model = ToxicityModel(words, stems, spared)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            rows = [scorer.features(t) for t in batch.column(1).to_pylist()]
            cols = list(zip(*rows, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.float64()) for c in cols]], ["label", "a", "b", "c"])

    rows = sample.mapInArrow(featured, "label int, a double, b double, c double").groupBy("label", "a", "b", "c").count().collect()
    x = np.array([[r["a"], r["b"], r["c"]] for r in rows], float).reshape(-1, 3)
    y, n = np.array([float(r["label"] == 1) for r in rows]), np.array([float(r["count"]) for r in rows])
    return ToxicityModel(words, stems, spared, fit_weights(*with_misspelled(x, y, n)))


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold``); columns of those names are replaced.

    Only the text is scored. Null and empty texts get the score of a text without hits; every other row is scored by
    its whole text. Other columns are handed through.
    """
    rows = docs.drop("score", "predicted")
    names, at = rows.columns, rows.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            scores = [scorer.score(t.as_py()) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())],
                                             [*names, "score", "predicted"])

    schema = StructType([StructField(f.name, f.dataType, True) for f in rows.schema.fields] + [StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    return rows.mapInArrow(run, schema)

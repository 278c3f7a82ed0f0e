"""Toxicity of whole texts: a lexicon met with misspellings, weighed by its context.

The lexicon is a trie of whole terms, some fixed and some learned. A Levenshtein automaton runs over it: a state
is a set of (trie node, errors so far), reached states and their moves are kept as they appear, and most words die
after a few letters. Words of clean documents that merely lie near a term are learned as exceptions. Each hit is set
apart by its errors and by its context window, whether quoted or reported or said to someone; a logistic model over
these counts gives the score. No evidence of abuse can have a negative weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraops.llm.common import fold, kept_where, labelled_sample, release, slices, texts_of, written

#: Abusive words of general knowledge, before any label is seen.
TERMS = """
    bastard bitch clown creep cretin degenerate dimwit disgusting dumb dumbass dunce fool freak garbage halfwit
    hideous idiot idiotic ignorant imbecile jackass jerk liar loser lowlife lunatic maggot moron moronic numbskull
    parasite pathetic pig repulsive retard scum scumbag simpleton slime slut sleazy stupid swine trash twit ugly
    vermin vile weasel whore wimp worthless wretch
""".split()
#: Words that show someone else's speech, or that someone is spoken to.
REPORTED = frozenset("said says say called calls wrote writes quoted quote quotes word words term phrase añadió dijo dit écrit sagte schrieb wort mot palabra".split())
DIRECTED = frozenset("you your yours you're youre u ur du dein deine sie tu te toi votre vous usted eres".split())
OPENING, CLOSING = frozenset("\"“«„'‘"), frozenset("\"”»“'’")
#: Words looked at on either side of a hit, and words in the window that is counted over.
CONTEXT, WINDOW = 10, 50
#: The model is learned from at most so many labelled documents, half of either label, with at most so many bytes of text.
MODULUS, HELD_OUT, SAMPLE_ROWS, SAMPLE_BYTES, THRESHOLD = 3, 1, 8_000, 64_000_000, 0.7
#: Share of the toxic sample documents that a learned term must be in, and the log-odds that it must have.
LEARNED_SHARE, LEARNED_ODDS = 0.004, 3.0
#: A misspelt form is an exception if so many clean sample documents have it and its log-odds are lower.
SPARED, SPARED_ODDS = 2, 1.5
#: Weights before any label is seen, and which of them count as evidence of abuse, so that they are never negative.
FEATURES = ("bias", "exact", "one error", "two errors", "quoted", "rate", "window", "directed")
PRIOR = np.array([-4.0, 2.5, 0.9, 0.5, 0.2, 1.0, 0.5, 0.5])
EVIDENCE = np.array([False, True, True, True, False, True, True, True])
PRIOR_SPREAD = 1.5


def errors_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class LevenshteinTrie:
    """Distance of a word from the nearest term, or -1 beyond what the term's length allows."""

    KEPT = 200_000

    def __init__(self, terms: list[str], errors: bool = True):
        self.children: list[dict[str, int]] = [{}]
        self.slack, self.final = [-1], [-1]  # errors that terms below or at a node allow
        for term in terms:
            node, allowed = 0, errors_allowed(term) if errors else 0
            for letter in term:
                self.slack[node] = max(self.slack[node], allowed)
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.slack.append(-1)
                    self.final.append(-1)
                node = self.children[node][letter]
            self.slack[node] = max(self.slack[node], allowed)
            self.final[node] = allowed
        self.letters = {c for child in self.children for c in child}
        self._restart()

    def _restart(self) -> None:
        self.moves: dict[tuple[int, str], int] = {}
        self.states: list[dict[int, int]] = [{}]  # state 0 is dead
        self.numbers: dict[frozenset, int] = {frozenset(): 0}
        self.start = self._number(self._closed({0: 0}))

    def _number(self, state: dict[int, int]) -> int:
        key = frozenset(state.items())
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(state)
        return self.numbers[key]

    def _put(self, state: dict[int, int], node: int, errors: int) -> bool:
        if errors > self.slack[node] or state.get(node, 9) <= errors:
            return False
        state[node] = errors
        return True

    def _closed(self, state: dict[int, int]) -> dict[int, int]:
        """With the nodes that leaving out letters of a term reaches."""
        todo = list(state)
        while todo:
            node = todo.pop()
            todo += [c for c in self.children[node].values() if self._put(state, c, state[node] + 1)]
        return state

    def _step(self, number: int, letter: str) -> int:
        after: dict[int, int] = {}
        for node, errors in self.states[number].items():
            self._put(after, node, errors + 1)
            children = self.children[node]
            if (same := children.get(letter)) is not None:
                self._put(after, same, errors)
            if errors < self.slack[node]:
                for child in children.values():
                    self._put(after, child, errors + 1)
        return self._number(self._closed(after))

    def distance(self, word: str) -> int:
        if len(self.moves) > self.KEPT:
            self._restart()
        state = self.start
        for letter in word:
            letter = letter if letter in self.letters else "\0"
            after = self.moves.get((state, letter))
            if after is None:
                after = self.moves[state, letter] = self._step(state, letter)
            if not after:
                return -1
            state = after
        return min((e for node, e in self.states[state].items() if e <= self.final[node]), default=-1)


_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "“”«»„‘’…¿¡"


class Finder:
    """What a text holds of the terms; errors and contexts can be left out, to see what they are worth."""

    KEPT = 500_000

    def __init__(self, terms: list[str], spared: list[str] = (), errors: bool = True, contexts: bool = True):
        self.trie = LevenshteinTrie(terms, errors)
        self.spared, self.contexts = frozenset(spared), contexts
        self.known: dict[str, int] = {}

    def distance(self, word: str) -> int:
        """That of the word without the marks around it; -1 for exceptions too."""
        far = self.known.get(word)
        if far is None:
            bare = word.strip(_EDGES)
            far = self.trie.distance(bare) if bare and bare not in self.spared else -1
            if len(word) <= 32:
                self.known[word] = far
        return far

    def features(self, texts: list[str]) -> np.ndarray:
        """A row of FEATURES for each text."""
        if len(self.known) > self.KEPT:
            self.known.clear()
        split = [t.lower().split() for t in texts]
        hits = {w: far for w in {w for words in split for w in words} if (far := self.distance(w)) >= 0}
        return np.array([self._row(words, hits) for words in split]).reshape(-1, len(FEATURES))

    def _row(self, words: list[str], hits: dict[str, int]) -> tuple[float, ...]:
        at = [k for k, w in enumerate(words) if w in hits] if hits else []
        found, quoted, directed = [0, 0, 0], 0, 0.0
        plain = []
        for k in at:
            before, after = words[max(0, k - CONTEXT) : k], words[k + 1 : k + 1 + CONTEXT]
            if self.contexts and _cited(words[k], before, after):
                quoted += 1
                continue
            far = hits[words[k]]
            plain.append((k, 0.5**far))
            found[far] += 1
            directed += self.contexts and 0.5**far * any(w.strip(_EDGES) in DIRECTED for w in before[-4:] + after[:3])
        rate = 100 * sum(x for _, x in plain) / max(len(words), 20)
        return (1.0, *map(np.log1p, (*found, quoted, rate, _densest(plain), directed)))


def _cited(word: str, before: list[str], after: list[str]) -> bool:
    """Whether the word is reported, or a quotation that opens in the window before it, or at it, closes at it or after it."""
    if any(w.strip(_EDGES) in REPORTED for w in before[-4:]):
        return True
    opened = word[0] in OPENING
    for w in reversed(before):
        if opened or w[-1] in CLOSING:
            break
        opened = w[0] in OPENING
    return opened and any(w.rstrip(".,;:!?")[-1:] in CLOSING for w in (word, *after))


def plain_words(text: str, contexts: bool = True) -> list[str]:
    """The distinct words of a text that are neither quoted nor reported, without the marks around them."""
    words = text.lower().split()
    bare = [w.strip(_EDGES) for w in words]
    if contexts and (not OPENING.isdisjoint(text) or not REPORTED.isdisjoint(bare)):
        bare = [b for k, b in enumerate(bare) if not _cited(words[k], words[max(0, k - CONTEXT) : k], words[k + 1 : k + 1 + CONTEXT])]
    return list(dict.fromkeys(filter(None, bare)))


def _densest(hits: list[tuple[int, float]]) -> float:
    """The greatest sum over a window of (place, weight)."""
    best = held = 0.0
    first = 0
    for place, weight in hits:
        held += weight
        while hits[first][0] <= place - WINDOW:
            held -= hits[first][1]
            first += 1
        best = max(best, held)
    return best


@dataclass(frozen=True)
class ToxicityModel:
    terms: tuple[str, ...]
    spared: tuple[str, ...]
    weights: tuple[float, ...]
    errors: bool = True
    contexts: bool = True

    def finder(self) -> Finder:
        return Finder(list(self.terms), list(self.spared), self.errors, self.contexts)

    def score(self, text: Column) -> Column:
        """Probability that the text is toxic; a null text counts as empty."""

        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            release()
            finder, weights = self.finder(), np.array(self.weights)
            for batch in batches:
                texts = batch.tolist()
                rows = [finder.features(texts[a:b]) for a, b in slices(texts)]
                yield pd.Series(1 / (1 + np.exp(-np.concatenate(rows) @ weights)) if rows else np.empty(0))

        return F.pandas_udf(scored, "double")(F.coalesce(text.cast("string"), F.lit("")))


def learned_terms(sample: DataFrame, errors: bool = True, contexts: bool = True) -> tuple[list[str], list[str]]:
    """(terms, exceptions): the lexicon, and the forms near a term that are words of clean documents.

    Words that are quoted or reported count neither for nor against a term.

    A learned term is a whole word that toxic sample documents have and hardly any other. A fixed term that clean
    documents have is left out. Documents that share their word of the smallest hash, near copies above all, count
    once. What comes to the driver is bounded by the sample.
    """

    def plain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release()
        for batch in batches:
            for a, b in slices(texts := batch.text.tolist()):
                yield pd.DataFrame({"label": batch.label.iloc[a:b], "words": [plain_words(t, contexts) for t in texts[a:b]]})

    long = F.filter("words", lambda w: F.length(w) >= 7)
    family = F.coalesce(F.array_min(F.transform(long, lambda w: F.xxhash64(w))), F.xxhash64("words"))
    docs = sample.mapInPandas(plain, "label double, words array<string>")
    docs = written(docs.withColumn("family", family).dropDuplicates(["label", "family"]).select("label", "words"), "families")
    sizes = {r["label"]: r["count"] for r in docs.groupBy("label").count().collect()}
    toxic, clean = sizes.get(1.0, 0), sizes.get(0.0, 0)
    rows = docs.select("label", F.explode("words").alias("term")).where(F.length("term") > 3)
    counts = written(rows.groupBy("term").agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c")), "words")
    odds = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
    least = max(3.0, LEARNED_SHARE * toxic)
    learned = counts.where((F.col("t") >= least) & (odds >= min(LEARNED_ODDS, float(np.log(2 * clean + 2)) - 1)))
    spoilt = counts.where(F.col("term").isin(TERMS) & (F.col("c") > 0.02 * F.col("t") + 1))
    terms = sorted({*TERMS, *(r["term"] for r in learned.collect())} - {r["term"] for r in spoilt.collect()})

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = LevenshteinTrie(terms, errors)
        for batch in batches:
            yield batch[[trie.distance(w) > 0 for w in batch.term]]

    spared = counts.where((F.col("c") >= SPARED) & (odds < SPARED_ODDS)).select("term").mapInPandas(near, "term string")
    return terms, sorted(r["term"] for r in spared.collect())


def fit_toxicity(documents: DataFrame, labels: DataFrame, errors: bool = True, contexts: bool = True) -> ToxicityModel:
    """The lexicon, exceptions and weights from a sample of labelled documents outside the held-out fold.

    The sample has at most SAMPLE_ROWS documents and SAMPLE_BYTES of text. Without labelled rows the fixed terms
    and the prior weights hold.
    """
    sample = labelled_sample(documents, labels, "toxic", MODULUS, HELD_OUT, SAMPLE_ROWS, SAMPLE_BYTES, balanced=True)
    terms, spared = learned_terms(sample, errors, contexts)
    model = ToxicityModel(tuple(terms), tuple(spared), tuple(PRIOR.tolist()), errors, contexts)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = model.finder()
        for batch in batches:
            texts = batch.text.tolist()
            for a, b in slices(texts):
                yield pd.DataFrame({"label": batch.label.iloc[a:b].to_numpy(), "x": list(finder.features(texts[a:b]))})

    found = sample.mapInPandas(rows, "label double, x array<double>").toPandas()
    if found.empty:
        return model
    return replace(model, weights=tuple(fitted(np.stack(found.x.to_numpy()), found.label.to_numpy()).tolist()))


def fitted(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights with a normal prior about PRIOR, those of evidence kept from falling below zero.

    Newton steps on one weight at a time, each cut off at its bound: the loss is convex, so they meet its minimum.
    """
    weights, line = PRIOR.copy(), x @ PRIOR
    for _ in range(500):
        moved = 0.0
        for k in range(len(weights)):
            p = 1 / (1 + np.exp(-np.clip(line, -30, 30)))
            slope = x[:, k] @ (p - y) + (weights[k] - PRIOR[k]) / PRIOR_SPREAD**2
            bend = (x[:, k] ** 2) @ (p * (1 - p)) + 1 / PRIOR_SPREAD**2
            after = weights[k] - np.clip(slope / bend, -1, 1)
            after = max(after, 0.0) if EVIDENCE[k] else after
            line += x[:, k] * (after - weights[k])
            moved, weights[k] = max(moved, abs(after - weights[k])), after
        if moved < 1e-7:
            break
    return weights


def toxicity(docs: DataFrame, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of docs; the model is learned from documents and labels.

    Repeated rows give repeated results, a null text counts as empty, a null doc_id is kept (held_out false),
    other columns are ignored; an empty table gives no rows.
    """
    model = fit_toxicity(documents, labels)
    out = texts_of(docs).select("doc_id", fold(F.col("doc_id"), MODULUS, HELD_OUT).alias("held_out"), model.score(F.col("text")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def without_toxic(docs: DataFrame, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs, all columns as they are, whose score is below THRESHOLD.

    A null text is scored as an empty one and stays null; repeated rows stay or go together, null ids and columns
    of any name stay as they are; an empty table gives no rows.
    """
    model = fit_toxicity(documents, labels)
    return kept_where(docs, lambda text: model.score(text) < THRESHOLD)

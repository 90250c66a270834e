"""Toxicity by a fuzzy lexicon with context windows.

The lexicon is learnt from labelled training texts: words, and stems that many words
begin with, that are far more frequent in toxic texts. Its terms form a trie. The
words of every text are matched by walking the trie together with the states of a
Levenshtein automaton, so misspelled terms are found with their distance: a letter
more, less or another, or two neighbours in the wrong order. A stem may be followed by
anything, if its last letter is in place; longer stems are also found misspelled in
that way, shorter ones where they are the whole word. Every hit has a window of words:
hits inside quotation marks or beside words that report speech count as quotation, all
others as abuse. A logistic regression over counts and log-odds of both kinds gives the
score.

Null and empty texts have no hits and get the score of that case. Repeated rows give
repeated rows; in the fit, equal texts of an id count once for each of its labels.
Without labelled rows, or with one label only, the lexicon is empty and all scores are
the (smoothed) share of label 1. The fit uses up to ``SAMPLE`` labelled training texts,
those with the least hashes of their ids.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import crc_bucket, give_back, map_batches, ship_package, text_chunks, whole_text

#: Labelled rows of the fit at most.
SAMPLE = 20_000
#: Terms of the lexicon at most.
TERMS = 400
#: Texts that a term must occur in, and its least log-odds.
LEAST_TEXTS = 4
LEAST_LOG_ODDS = 2.5
STEM_LENGTHS = range(4, 9)
#: Words after which a prefix counts as a stem.
LEAST_ENDINGS = 6
#: Words to either side that tell quotation from abuse.
WINDOW = 6
#: Words that a worker remembers with their matches.
CACHED_WORDS = 50_000
#: States of the automaton that a worker keeps.
MAX_STATES = 50_000

# Words that report speech, in the four languages of the texts.
REPORTING = (
    "said says say called calls wrote writes word term quote quoted quotes "
    "dit disait mot terme citation sagte sagt wort begriff zitat dijo dice palabra cita"
).split()
# Letters that stand for others in disguised words.
LOOK_ALIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})

_WORD = re.compile(r"[^\W_]+(?:[@$!*][^\W_]+)*")
_QUOTES = re.compile("[\"“”„«»]")


class Lexicon:
    """Terms in a trie, intersected with a Levenshtein automaton.

    A state is a set of (trie node, edits so far); the states that words lead to are
    made once and kept with their transitions, so a word costs a step for each letter
    and ends as soon as no term is in reach. ``~node`` in a state stands for a node whose
    letter has been read before that of its parent, which is still to come.
    """

    def __init__(self, terms: list[tuple[str, bool, float]]):
        self.terms = terms  # (letters, is a stem, log-odds)
        self.children: list[dict[str, int]] = [{}]
        self.term_at: list[int] = [-1]
        self.reach: list[int] = [0]  # edits that the terms below a node allow
        self.letter: list[str] = [""]
        self.parent: list[int] = [0]
        for number, (letters, stem, _) in enumerate(terms):
            node, allowed = 0, edits_allowed(len(letters))
            for letter in letters:
                self.reach[node] = max(self.reach[node], allowed)
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term_at.append(-1)
                    self.reach.append(0)
                    self.letter.append(letter)
                    self.parent.append(node)
                node = self.children[node][letter]
            self.reach[node] = max(self.reach[node], allowed)
            self.term_at[node] = number
        self.cache: dict[str, tuple[int, int]] = {}
        self._forget()

    def _forget(self) -> None:
        self.steps: list[dict[str, int]] = []
        self.hits: list[tuple[tuple[int, int], ...]] = []
        self.stem: list[tuple[int, int]] = []
        self.number: dict[tuple, int] = {}
        self.sets: list[bytes] = []  # node * 4 + edits, as 32-bit integers
        self._state({0: 0}, (-1, 0))

    def _state(self, row: dict[int, int], stem: tuple[int, int]) -> int:
        """The number of the state with these nodes, in which the stem has just ended; a
        missing letter is an edit too."""
        waiting = [node for node in row if node >= 0]
        while waiting:
            node = waiting.pop()
            for child in self.children[node].values():
                if row[node] < self.reach[child] and row[node] + 1 < row.get(child, 99):
                    row[child] = row[node] + 1
                    waiting.append(child)
        key = (array("i", sorted(node * 4 + edits for node, edits in row.items())).tobytes(), stem)
        if key not in self.number:
            self.number[key] = len(self.sets)
            self.sets.append(key[0])
            self.steps.append({})
            self.hits.append(tuple((self.term_at[n], e) for n, e in row.items() if n >= 0 and self.term_at[n] >= 0))
            self.stem.append(stem)
        return self.number[key]

    def _step(self, state: int, letter: str) -> int:
        row: dict[int, int] = {}
        in_place: dict[int, int] = {}  # nodes whose own letter was read, so that a stem may end

        def reach(node: int, target: int, edits: int, exact: bool) -> None:
            if edits <= self.reach[target]:
                row[node] = min(edits, row.get(node, edits))
                if exact:
                    in_place[node] = min(edits, in_place.get(node, edits))

        for packed in array("i", self.sets[state]):
            node, edits = packed >> 2, packed & 3
            if node < 0:  # the second of two exchanged letters
                if letter == self.letter[self.parent[~node]]:
                    reach(~node, ~node, edits, True)
                continue
            for own, child in self.children[node].items():
                reach(child, child, edits + (own != letter), own == letter)
                after = self.children[child].get(letter) if own != letter else None
                if after is not None:
                    reach(~after, after, edits + 1, False)
            reach(node, node, edits + 1, False)  # a letter too many
        ends = [(edits, -self.terms[self.term_at[n]][2], self.term_at[n]) for n, edits in in_place.items() if self.term_at[n] >= 0]
        ends = [e for e in ends if self.terms[e[2]][1] and e[0] <= stem_edits(len(self.terms[e[2]][0]))]
        return self._state(row, (min(ends)[2], min(ends)[0]) if ends else (-1, 0)) if row else -1

    def match(self, word: str) -> tuple[int, int]:
        """Number of the nearest term and its distance, or (-1, 0)."""
        found = self.cache.get(word)
        if found is None:
            found = self._search(word)
            if found[0] < 0 and not word.isalpha() and (plain := word.translate(LOOK_ALIKE)) != word:
                found = self._search(plain)
            if len(self.cache) >= CACHED_WORDS:
                self.cache.clear()
            self.cache[word] = found
        return found

    def _search(self, word: str) -> tuple[int, int]:
        if len(self.sets) > MAX_STATES:
            self._forget()
        near = []  # (edits, -log-odds, term)
        state = 0
        for letter in word:
            after = self.steps[state].get(letter)
            if after is None:
                after = self.steps[state][letter] = self._step(state, letter)
            if after < 0:
                break
            term, edits = self.stem[after]
            if term >= 0:  # whatever follows a stem belongs to it
                near.append((edits, -self.terms[term][2], term))
            state = after
        else:
            allowed = edits_allowed(len(word))
            near += [
                (edits, -self.terms[term][2], term)
                for term, edits in self.hits[state]
                if edits <= min(allowed, edits_allowed(len(self.terms[term][0])))
            ]
        return (min(near)[2], min(near)[0]) if near else (-1, 0)


def edits_allowed(length: int) -> int:
    """Short words are not matched with edits, as those make other words."""
    return 0 if length < 5 else 1 if length < 9 else 2


def stem_edits(length: int) -> int:
    """A stem that any ending may follow makes other words sooner."""
    return edits_allowed(length - 1)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


FEATURES = 8
#: Where a row of features has the logarithms of 1 + the numbers of hits.
ABUSE, QUOTATION = 1, 4


def features(lexicon: Lexicon, text: str) -> list[float]:
    """Logarithms of counts and log-odds of hits, for abuse and for quotation, and the
    density of abuse."""
    abuse = quoted = fuzzy = 0
    abuse_odds = quoted_odds = best = 0.0
    hits = []
    tokens = [(m.group(), m.start()) for m in _WORD.finditer(text.lower())] if lexicon.terms else []
    for i, (word, start) in enumerate(tokens):
        known = lexicon.cache.get(word)
        term, edits = lexicon.match(word) if known is None else known
        if term >= 0:
            hits.append((i, start, term, edits))
    for i, start, term, edits in hits:
        odds = lexicon.terms[term][2] / (1 + edits)
        if is_quotation(text, tokens, i, start):
            quoted += 1
            quoted_odds += odds
        else:
            abuse += 1
            abuse_odds += odds
            best = max(best, odds)
            fuzzy += edits > 0
    return [
        1.0,
        math.log1p(abuse),
        math.log1p(abuse_odds),
        best / 5,
        math.log1p(quoted),
        math.log1p(quoted_odds),
        math.log1p(fuzzy),
        10 * abuse / (len(tokens) + 10),
    ]


def is_quotation(text: str, tokens: list[tuple[str, int]], i: int, start: int) -> bool:
    """Whether the hit stands between quotation marks within its window, or a word of
    the window reports speech."""
    low, high = max(0, i - WINDOW), min(len(tokens), i + WINDOW + 1)
    if any(tokens[j][0] in _REPORTING for j in range(low, high) if j != i):
        return True
    end = tokens[high][1] if high < len(tokens) else len(text)
    before = _QUOTES.search(text, tokens[low][1] - 1 if tokens[low][1] else 0, start)
    after = _QUOTES.search(text, start + len(tokens[i][0]), end)
    return before is not None and after is not None


_REPORTING = frozenset(REPORTING)


def learn_lexicon(counts: dict[str, list[int]], totals: list[int]) -> Lexicon:
    """Terms from the numbers of texts of label 0 and 1 that hold each word or stem;
    stems are written with a star. The strongest terms stay; of stems that begin alike the
    stronger one, and words also beside the stem that covers them, as a whole word is
    found with more edits."""
    scored = []
    for term, (clean, toxic) in counts.items():
        if toxic >= LEAST_TEXTS:
            odds = math.log((toxic + 0.5) / (totals[1] + 1)) - math.log((clean + 0.5) / (totals[0] + 1))
            if odds >= LEAST_LOG_ODDS:
                scored.append((round(toxic * odds, 6), term.rstrip("*"), term.endswith("*"), odds))
    # Of stems with the same texts the longest is the most specific.
    scored.sort(key=lambda x: (-x[0], x[2], -len(x[1]), x[1]))
    terms, stems = {}, []
    for _, letters, stem, odds in scored:
        if len(terms) >= TERMS:
            break
        if letters not in terms and not (stem and any(letters.startswith(s) for s in stems)):
            terms[letters] = (letters, stem, odds)
            if stem:
                stems.append(letters)
    return Lexicon(list(terms.values()))


def _candidate_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """term, toxic, texts: in how many of the task's texts of a label each word and
    each stem occurs; a stem's count goes with the number of its endings."""
    for batch in text_chunks(batches):
        counts: Counter = Counter()
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words = set(words_of(text))
            stems = {word[:n] + "*" for word in words for n in STEM_LENGTHS if len(word) > n}
            counts.update((term, toxic) for term in words | stems)
        terms = list(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([t for t, _ in terms], pa.string()),
                pa.array([x for _, x in terms], pa.int32()),
                pa.array([counts[t] for t in terms], pa.int64()),
            ],
            names=["term", "toxic", "texts"],
        )


def _endings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """term, word: each stem with the words that begin with it, once for a slice of texts."""
    for batch in text_chunks(batches):
        words = {word for text in batch.column("text").to_pylist() for word in words_of(text)}
        pairs = [(word[:n] + "*", word) for word in words for n in STEM_LENGTHS if len(word) > n]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[i] for p in pairs], pa.string()) for i in range(2)], names=["term", "word"]
        )


@dataclass(frozen=True)
class Model:
    terms: list[tuple[str, bool, float]]
    weights: list[float]


def fit(sample: DataFrame) -> Model:
    """The lexicon and the weights from text, toxic (0 or 1). Candidate terms are
    counted by a grouping, and cut to TERMS strong ones before they leave it."""
    totals = {row["toxic"]: row["count"] for row in sample.groupBy("toxic").count().collect()}
    clean, toxic = totals.get(0, 0), totals.get(1, 0)
    if not clean or not toxic:
        return Model([], [math.log((toxic + 0.5) / (clean + 0.5))] + [0.0] * (FEATURES - 1))
    counted = map_batches(sample.select("text", "toxic"), _candidate_terms, "term string, toxic int, texts bigint")
    sums = counted.groupBy("term").agg(
        F.sum(F.when(F.col("toxic") == 0, F.col("texts")).otherwise(0)).alias("clean"),
        F.sum(F.when(F.col("toxic") == 1, F.col("texts")).otherwise(0)).alias("toxic"),
    )
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    endings = map_batches(sample.filter("toxic = 1").select("text"), _endings, "term string, word string")
    stems = endings.groupBy("term").agg(F.count_distinct("word").alias("endings")).filter(F.col("endings") >= LEAST_ENDINGS)
    sums = sums.join(stems, "term", "left").filter(~F.col("term").endswith("*") | F.col("endings").isNotNull())
    strong = (
        sums.filter((F.col("toxic") >= LEAST_TEXTS) & (odds >= LEAST_LOG_ODDS))
        .orderBy((F.col("toxic") * odds).desc(), "term")
        .limit(20 * TERMS)
    )
    counts = {row["term"]: [row["clean"], row["toxic"]] for row in strong.collect()}
    lexicon = learn_lexicon(counts, [clean, toxic])
    rows = map_batches(sample.select("text", "toxic"), _featured(lexicon.terms), "features array<double>, toxic int")
    # SAMPLE rows of FEATURES numbers at most, by their hash where an id has many rows.
    collected = rows.orderBy(F.xxhash64("features"), "toxic").limit(SAMPLE).toPandas()
    return Model(lexicon.terms, logistic(np.array(collected["features"].tolist()), collected["toxic"].to_numpy(float)))


def _featured(terms):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(terms)
        for batch in text_chunks(batches):
            rows = [features(lexicon, text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column("toxic")], names=["features", "toxic"])

    return work


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> list[float]:
    """Weights of a ridge logistic regression, by Newton steps. Rows are sorted first,
    so that the order in which they came does not matter."""
    order = np.lexsort((y, *x.T))
    x, y = x[order], y[order]
    weights = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (y - p) - penalty * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    return [float(w) for w in weights]


def labelled_sample(documents: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """text, toxic of the labelled training rows with the least hashes of their ids,
    ``limit`` at most. Ids and hashes of texts are cut before the texts move."""
    usable = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(crc_bucket("doc_id", 4) != 2)
    by_hash = F.xxhash64("doc_id")
    chosen = usable.select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct().orderBy(by_hash, "doc_id", "toxic").limit(limit)
    texts = documents.select("doc_id", whole_text().alias("text"))
    # Both broadcasts are ``limit`` rows of two or three numbers at most. An id with many
    # texts or both labels has as many rows, so that it is cut again.
    known = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", F.xxhash64("text").alias("content")).distinct()
    known = known.orderBy(by_hash, "doc_id", "content", "toxic").limit(limit)
    hashed = texts.withColumn("content", F.xxhash64("text")).join(F.broadcast(known), ["doc_id", "content"])
    return hashed.groupBy("doc_id", "content", "toxic").agg(F.min("text").alias("text")).select("text", "toxic")


def score(documents: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep``, score (0 to 1), abuse and quotation (numbers of hits)."""
    columns = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    place = keep.index(text) if text in keep else len(keep)  # the text moves to Python once
    rows = documents.select(*columns, *([whole_text(text).alias(f"k{place}")] if place == len(keep) else []))
    kept = ", ".join(f"k{i} {rows.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep)))
    terms, weights = model.terms, np.array(model.weights)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(terms)
        for batch in text_chunks(batches, f"k{place}"):
            x = np.array([features(lexicon, t or "") for t in batch.column(place).to_pylist()])
            scores = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            hits = [pa.array(np.rint(np.expm1(x[:, i])).astype(np.int64)) for i in (ABUSE, QUOTATION)]
            added = [pa.array(scores), *hits]
            own = batch.columns[: len(keep)]
            yield pa.RecordBatch.from_arrays([*own, *added], names=[*batch.schema.names[: len(keep)], "score", "abuse", "quotation"])

    scored = map_batches(rows, work, f"{kept}, score double, abuse bigint, quotation bigint")
    return scored.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "score", "abuse", "quotation")


def score_column(spark: SparkSession, model: Model, text: str = "text") -> Column:
    """The score of each text as a column: texts go to Python, scores come back, and the
    other columns of a row stay where they are."""
    ship_package(spark)
    terms, weights = model.terms, np.array(model.weights)

    @F.arrow_udf("double")
    def scores(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lexicon = Lexicon(terms)
        for batch in texts:
            parts = []
            for piece in text_chunks([pa.RecordBatch.from_arrays([batch], names=["text"])]):
                x = np.array([features(lexicon, t) for t in piece.column("text").to_pylist()])
                parts.append(pa.array(1 / (1 + np.exp(-np.clip(x @ weights, -30, 30))), pa.float64()))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.float64())
        del lexicon
        give_back()

    return scores(whole_text(text))

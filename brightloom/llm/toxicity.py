"""Toxicity from a lexicon trie met by Levenshtein automata, and from the hits' surroundings."""

from __future__ import annotations

import math
import re
from bisect import bisect
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import arrow_pass, fold_of, only, texts_of, window_hashes, word_hashes

#: Labelled rows of each class that the lexicon and the weights are fitted on, at most.
SAMPLE = 4_000
#: Prefixes that may become lexicon stems.
SHORTEST, LONGEST = 4, 12
#: Toxic sample rows a lexicon entry must occur in, and must explain where each explained before counts half.
SUPPORT, NEWS = 3, 2.0
#: Least ratio of the odds of toxic among a lexicon entry's rows to those among all rows, and
#: the normal quantile of its lower bound (Wilson's, one-sided 95 %).
LIFT, CERTAIN = 4.0, 1.645
#: Share of the accepted terms that may owe their toxic rows to chance (Benjamini and Hochberg).
CHANCE = 0.01
#: Evidence that is left of a hit for each edit, and inside quotation marks.
PER_EDIT = 0.6
QUOTED = 0.2
#: Evidence beyond which a text is as toxic as can be.
MOST = 10.0
REMEMBERED = 200_000
_TOKEN = re.compile(r"\w+")
#: Marks that open a quotation with those that close it, and the kind of each mark.
_MARK = re.compile("[\n\"“„”«»‹›]")
_CLOSING = {"\"": "\"", "“": "”“", "„": "“”", "”": "”", "«": "»", "‹": "›"}
_KIND = {"\"": 0, "“": 1, "„": 1, "”": 1, "«": 2, "»": 2, "‹": 3, "›": 3}


@dataclass(frozen=True)
class Entry:
    """A lexicon term. An open one also stands for all words that begin with it."""

    term: str
    open: bool
    weight: float

    @property
    def edits(self) -> int:
        n = len(self.term) - 2 * self.open
        return 0 if n < 5 else 1 if n < 9 else 2


class Lexicon:
    """The trie of all entries, run against words by Levenshtein automata.

    A state is the set of trie nodes within reach and their least edits. States and
    their transitions are made when a word first needs them and kept, so a word costs one
    lookup a letter, and most words leave the trie after a few letters."""

    def __init__(self, entries: list[Entry]):
        self.children: list[dict[str, int]] = [{}]
        self.ends: dict[int, list[Entry]] = {}
        self.slack: list[int] = [max((e.edits for e in entries), default=0)]
        for entry in entries:
            node = 0
            for letter in entry.term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.slack.append(0)
                node = self.children[node][letter]
                self.slack[node] = max(self.slack[node], entry.edits)
            self.ends.setdefault(node, []).append(entry)
        self.states: list[tuple[tuple[tuple[int, int], ...], float]] = []
        self.numbers: dict[tuple, int] = {}
        self.moves: list[dict[str, int]] = []
        self.final: list[float] = []
        self.start = self._state({0: 0}, 0.0)
        self.known: dict[str, float] = {}

    def _worth(self, reach: dict[int, int], open_only: bool) -> float:
        return max((e.weight * PER_EDIT ** edits for node, edits in reach.items() for e in self.ends.get(node, ())
                    if edits <= e.edits and (e.open or not open_only)), default=0.0)

    def _state(self, reach: dict[int, int], carried: float) -> int:
        """The state of these nodes, after letters of the trie that the word leaves out."""
        todo = list(reach.items())
        while todo:
            node, edits = todo.pop()
            for child in self.children[node].values():
                if edits + 1 <= self.slack[child] and edits + 1 < reach.get(child, 99):
                    reach[child] = edits + 1
                    todo.append((child, edits + 1))
        carried = max(carried, self._worth(reach, open_only=True))
        key = (tuple(sorted(reach.items())), carried)
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
            self.final.append(max(carried, self._worth(reach, open_only=False)))
        return self.numbers[key]

    def _move(self, state: int, letter: str) -> int:
        nodes, carried = self.states[state]
        reach: dict[int, int] = {}
        for node, edits in nodes:
            steps = [(child, edits + (c != letter)) for c, child in self.children[node].items()] + [(node, edits + 1)]
            for to, cost in steps:
                if cost <= self.slack[to] and cost < reach.get(to, 99):
                    reach[to] = cost
        self.moves[state][letter] = out = self._state(reach, carried)
        return out

    def evidence(self, word: str) -> float:
        """Weight of the best entry within its edits of `word`, less for each edit; 0 if none."""
        got = self.known.get(word)
        if got is None:
            state = self.start
            for letter in word:
                to = self.moves[state].get(letter)
                state = self._move(state, letter) if to is None else to
                if not self.states[state][0]:
                    break
            got = self.final[state]
            if len(self.known) < REMEMBERED:
                self.known[word] = got
        return got

    def features(self, text: str) -> tuple[float, float]:
        """Evidence of the text's hits: used by the text itself, and quoted by it."""
        low = text.lower()
        if not any(map(self.evidence, set(_TOKEN.findall(low)))):
            return 0.0, 0.0
        own, quoted, spans = 0.0, 0.0, _quotations(low)
        for hit in _TOKEN.finditer(low):
            worth = self.evidence(hit[0])
            if worth:
                at = bisect(spans, (hit.start(), len(low))) - 1
                if at >= 0 and hit.start() < spans[at][1]:
                    own, quoted = own + QUOTED * worth, quoted + worth
                else:
                    own += worth
        return min(own, MOST), min(quoted, MOST)


def _quotations(text: str) -> list[tuple[int, int]]:
    """Spans inside quotation marks, in order and apart. Marks are paired from the start of
    each line, however long the quotation; one that the line doesn't close quotes nothing."""
    spans: list[tuple[int, int]] = []
    opened: dict[int, tuple[int, str]] = {}
    for found in _MARK.finditer(text):
        mark, at = found[0], found.start()
        if mark == "\n":
            opened.clear()
            continue
        start, by = opened.get(_KIND[mark], (0, ""))
        if by and mark in _CLOSING[by]:
            spans.append((start, at))
            del opened[_KIND[mark]]
        elif mark in _CLOSING:
            opened[_KIND[mark]] = (at, mark)
    apart: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if apart and start < apart[-1][1]:
            apart[-1] = (apart[-1][0], max(end, apart[-1][1]))
        else:
            apart.append((start, end))
    return apart


@dataclass(frozen=True)
class Model:
    """Entries and the weights of intercept, own and quoted evidence."""

    entries: tuple[Entry, ...]
    weights: tuple[float, float, float]

    def score(self, features: np.ndarray) -> np.ndarray:
        z = self.weights[0] + features @ np.array(self.weights[1:])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _prefix_counts(batch: pa.RecordBatch) -> dict:
    """Of each prefix and each whole word (ended by a blank), the rows of the batch that have it."""
    toxic, clean = Counter(), Counter()
    for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
        found = set()
        for word in set(_TOKEN.findall((text or "").lower())):
            found.add(word + " ")
            found.update(word[:n] for n in range(SHORTEST, min(len(word), LONGEST) + 1))
        (toxic if label else clean).update(found)
    both = list(toxic | clean)
    return {"prefix": both, "toxic": [toxic[p] for p in both], "clean": [clean[p] for p in both]}


def _odds(toxic: int, clean: int, n_toxic: int, n_clean: int) -> float:
    return math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))


def _lift(toxic: int, clean: int, n_toxic: int, n_clean: int) -> float:
    """Lower bound of a term's odds of toxic, in multiples of those of all rows. It rests on
    the rows that have the term: how many clean rows lack it moves only the scale."""
    n, z2 = toxic + clean, CERTAIN ** 2
    share = toxic / n
    low = (share + z2 / (2 * n) - CERTAIN * math.sqrt(share * (1 - share) / n + z2 / (4 * n * n))) / (1 + z2 / n)
    return low / (1 - low) * n_clean / n_toxic


def _by_chance(toxic: int, clean: int, base: float) -> float:
    """Probability of as many toxic rows or more among a term's rows, if each is toxic with probability `base`."""
    n = toxic + clean
    logs = [math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(base) + (n - k) * math.log1p(-base)
            for k in range(toxic, n + 1)]
    return math.fsum(map(math.exp, logs))


def _telling(counts: dict[str, tuple[int, int]], n_toxic: int, n_clean: int) -> list[str]:
    """Terms, sorted, whose odds are LIFT times those of all rows for certain, and that are
    not among the rows of one class by chance, allowing for the number of terms tried."""
    if not n_toxic or not n_clean:
        return []
    base = n_toxic / (n_toxic + n_clean)
    ranked = sorted((_by_chance(*both, base), term) for term, both in counts.items() if _lift(*both, n_toxic, n_clean) >= LIFT)
    last = max((i for i, (p, _) in enumerate(ranked, 1) if p * len(counts) <= CHANCE * i), default=0)
    return sorted(term for _, term in ranked[:last])


def _held(candidates: dict[str, int]):
    """Of each toxic row, the numbers of the candidates it has."""

    def rows(batch: pa.RecordBatch) -> dict:
        out = []
        for text in batch.column("text").to_pylist():
            found = set()
            for word in set(_TOKEN.findall((text or "").lower())):
                found.add(candidates.get(word + " "))
                found.update(candidates.get(word[:n]) for n in range(SHORTEST, min(len(word), LONGEST) + 1))
            out.append(sorted(found - {None}))
        return {"found": out}

    return rows


def _choose(rows: list[list[int]], names: list[str], odds: np.ndarray, enough: float) -> list[int]:
    """Candidates that together explain the toxic rows, the one that explains most first;
    longer and more telling ones win near ties. A row that a candidate explains counts half
    for the next. So words that merely come along in copies don't get in."""
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    what = np.array([c for r in rows for c in r], np.int64)
    favour = (1 + 0.02 * np.array([len(n) for n in names])) * odds
    weight = np.ones(len(rows))
    chosen: list[int] = []
    open_to = np.ones(len(names), bool)
    while len(what):
        gain = np.bincount(what, weight[of], minlength=len(names)) * open_to
        gain[gain < enough] = 0
        best = int((gain * favour).argmax())
        if not gain[best]:
            break
        chosen.append(best)
        weight[of[what == best]] *= 0.5
        open_to &= ~np.array([n.startswith(names[best]) or names[best].startswith(n) for n in names])
    return chosen


def _family(batch: pa.RecordBatch) -> dict:
    """A value that near copies mostly share: the least hash of their three-word runs."""
    out = []
    for text in texts_of(batch):
        h = window_hashes(word_hashes(text.lower().split()), 3)
        out.append(int(h.min().view(np.int64)) if len(h) else xxhash.xxh3_64_intdigest(text) >> 1)
    return {"text": batch.column("text"), "label": batch.column("label"), "family": out}


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float, float]:
    """Weighted ridge logistic regression by Newton steps, each halved until it improves."""
    a = np.column_stack([np.ones(len(x)), x])
    beta, ridge = np.zeros(3), np.array([1e-3, 0.05, 0.05])

    def loss(b: np.ndarray) -> float:
        return float((weight * (np.logaddexp(0, a @ b) - y * (a @ b))).sum() + (ridge * b * b).sum() / 2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -500, 500)))
        gradient = a.T @ (weight * (y - p)) - ridge * beta
        step = np.linalg.solve(a.T @ (a * (weight * p * (1 - p))[:, None]) + np.diag(ridge) + 1e-9 * np.eye(3), gradient)
        size, now = 1.0, loss(beta)
        while size > 1e-6 and loss(beta + size * step) > now:
            size /= 2
        beta = beta + size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return tuple(beta.tolist())


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """Lexicon and weights from labelled rows whose id's crc32 modulo 5 is not 0.

    At most `sample` rows of each class are used, those with the least id hashes, one of
    each family of near copies; the classes are weighted back to their shares of all labelled rows. Null labels and ids
    are left out. Without a labelled toxic row the lexicon is empty and every score is low."""
    marks = only(labels, **{id_col: "doc_id", label_col: "label"}).where(
        F.col("doc_id").isNotNull() & F.col("label").isNotNull() & (fold_of(F.col("doc_id")) != 0))
    sizes = {int(r["label"] > 0): r["count"] for r in marks.groupBy((F.col("label") > 0).cast("int").alias("label")).count().collect()}
    chosen = None
    for label in (0, 1):
        part = (marks.where((F.col("label") > 0).cast("int") == label).select("doc_id", F.lit(label).alias("label")).distinct()
                .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
        chosen = part if chosen is None else chosen.union(part)
    rows = only(docs, **{id_col: "doc_id", text_col: "text"}).join(F.broadcast(chosen), "doc_id").select("text", "label")
    rows = (arrow_pass(rows, _family, "text string, label int, family long")
            .dropDuplicates(["family", "label"]).select("text", "label").cache())
    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    counts = (arrow_pass(rows, _prefix_counts, "prefix string, toxic long, clean long").groupBy("prefix")
              .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(f"toxic >= {SUPPORT}").collect())
    odds = {r["prefix"]: _odds(r["toxic"], r["clean"], n.get(1, 0), n.get(0, 0)) for r in counts}
    of = {r["prefix"]: (r["toxic"], r["clean"]) for r in counts}
    pure = _telling(of, n.get(1, 0), n.get(0, 0))
    worth = {p: math.log(_lift(*of[p], n[1], n[0])) for p in pure}
    held = [r["found"] for r in arrow_pass(rows.where("label = 1"), _held({p: i for i, p in enumerate(pure)}), "found array<int>").collect()]
    entries = tuple(Entry(pure[i].rstrip(), pure[i][-1] != " ", worth[pure[i]])
                    for i in _choose(held, pure, np.array([odds[p] for p in pure]), NEWS))
    x = _featured(rows, entries, {"label": "int"}).select("own", "quoted", "label").collect()
    rows.unpersist()
    if not n.get(1) or not n.get(0):
        return Model(entries, (-5.0, 0.0, 0.0))
    y = np.array([r["label"] for r in x], float)
    weight = np.where(y > 0, sizes[1] / n[1], sizes[0] / n[0])
    return Model(entries, _fit(np.array([(r["own"], r["quoted"]) for r in x]), y, weight / weight.mean()))


def _featured(rows: DataFrame, entries: tuple[Entry, ...], keep: dict[str, str], text: str = "text") -> DataFrame:
    made: list[Lexicon] = []

    def run(batch: pa.RecordBatch) -> dict:
        if not made:
            made.append(Lexicon(list(entries)))
        both = [made[0].features(t or "") for t in batch.column(text).to_pylist()]
        return {**{c: batch.column(c) for c in keep}, "own": [b[0] for b in both], "quoted": [b[1] for b in both]}

    columns = ", ".join(f"{c} {kind}" for c, kind in keep.items())
    return arrow_pass(rows.select(*keep, text), run, f"{columns}, own double, quoted double")


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score and predicted (1 from a score of 0.5) for every row, over whole texts.

    Null and empty texts have no hits and get the score of no evidence. Null ids and
    repeated rows are kept, other columns ignored; no rows give no rows."""
    made: list[Lexicon] = []

    def run(batch: pa.RecordBatch) -> dict:
        if not made:
            made.append(Lexicon(list(model.entries)))
        both = np.array([made[0].features(t or "") for t in batch.column("text").to_pylist()]).reshape(-1, 2)
        score = model.score(both)
        return {"doc_id": batch.column("doc_id"), "score": score, "predicted": (score >= 0.5).astype(np.int32)}

    rows = only(docs, **{id_col: "doc_id", text_col: "text"}).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return arrow_pass(rows, run, "doc_id long, score double, predicted int")


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, that ``score_toxicity`` predicts as 0."""
    made: list[Lexicon] = []

    def run(batches):
        for batch in batches:
            if not made:
                made.append(Lexicon(list(model.entries)))
            both = np.array([made[0].features(t or "") for t in batch.column(text_col).to_pylist()]).reshape(-1, 2)
            yield batch.filter(pa.array(model.score(both) < 0.5))

    return docs.mapInArrow(run, docs.schema)

"""Toxicity scores: a learned lexicon in a trie, met by Levenshtein automata, with context windows around each hit."""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.llm.common import materialize

#: Labelled rows that a model is fitted on, about; all other steps read every row.
FIT_ROWS = 8000
#: A term of the lexicon is in one of so many toxic texts of the sample at least, and in five; the lower bound of its share of toxic texts is so high at least.
ONE_TEXT_IN, LEAST_SHARE = 120, 0.55
#: Scores from here on are predictions of label 1.
THRESHOLD = 0.7
STEM_LENGTHS = (4, 5, 6, 7)
#: Characters on each side of a hit that its context is read from.
WINDOW = 80
WORD = re.compile(r"[^\W_]+")
#: Words that report speech, and words that address somebody; in English, German, French and Spanish.
REPORTING = frozenset("said says wrote called quote quoted term word sagte schrieb nannte wort dit écrit appelé mot dijo escribió llamó palabra".split())
ADDRESSING = frozenset("you your youre du dich dein ihr euch tu toi vous votre tú usted eres".split())
QUOTES, STRAIGHT = ("“”", "„“", "«»", "‘’"), '"'
#: Words whose match is remembered in each task, and states of the automaton that are kept, before both are made anew.
REMEMBERED, STATES = 1 << 20, 1 << 16


@dataclass(frozen=True)
class Term:
    text: str
    stem: bool  # a stem also stands at the start of longer words
    weight: float
    fuzzy: bool = True

    @property
    def edits(self) -> int:
        return 0 if not self.fuzzy or len(self.text) < 5 else 1 if len(self.text) < 9 else 2


class LexiconAutomaton:
    """The Levenshtein automata of all terms, intersected with their trie and made deterministic as words are read.

    A state is a set of items (trie node, edits so far, awaited character of a swapped pair). ``match`` gives (term
    number, edits) of the nearest term, the first one among equals, or None. Insertions, deletions, substitutions and
    swaps of neighbours cost one edit.
    """

    def __init__(self, terms: list[Term]):
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        for k, t in enumerate(terms):
            at = 0
            for c in t.text:
                if c not in self.children[at]:
                    self.children[at][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                at = self.children[at][c]
            self.ends[at].append(k)
        self.budget = [0] * len(self.children)  # most edits of any term below a node
        for node in reversed(range(len(self.children))):
            below = [self.budget[x] for x in self.children[node].values()]
            self.budget[node] = max([*below, *(terms[k].edits for k in self.ends[node])], default=0)
        self._forget()

    def _forget(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.items: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.finals: list[tuple[int, int] | None] = []
        self.start = self._state({(0, 0, "")}, None)

    def _state(self, items: set, found: tuple[int, int] | None) -> int:
        work, closed = list(items), set(items)
        while work:  # a character of the term that the word leaves out
            node, e, wait = work.pop()
            if not wait:
                for x in self.children[node].values():
                    if e + 1 <= self.budget[x] and (x, e + 1, "") not in closed:
                        closed.add((x, e + 1, ""))
                        work.append((x, e + 1, ""))
        best: dict[tuple[int, str], int] = {}
        for node, e, wait in closed:
            best[node, wait] = min(e, best.get((node, wait), e))
        for (node, wait), e in best.items():
            for k in self.ends[node] if not wait else ():
                if self.terms[k].stem and e <= self.terms[k].edits and (found is None or (e, k) < found):
                    found = (e, k)
        key = frozenset({(n, e, w) for (n, w), e in best.items()} | ({found} if found else set()))
        if key not in self.states:
            self.states[key] = len(self.items)
            self.items.append(frozenset((n, e, w) for (n, w), e in best.items()))
            self.steps.append({})
            whole = [(e, k) for (node, wait), e in best.items() if not wait for k in self.ends[node] if e <= self.terms[k].edits]
            self.finals.append(min([*whole, *([found] if found else [])], default=None))
            self._found = getattr(self, "_found", {})
            self._found[self.states[key]] = found
        return self.states[key]

    def _step(self, state: int, c: str) -> int:
        after = set()
        for node, e, wait in self.items[state]:
            if wait:
                if c == wait:
                    after.add((node, e, ""))
                continue
            if e + 1 <= self.budget[node]:
                after.add((node, e + 1, ""))
            for x, child in self.children[node].items():
                cost = e if x == c else e + 1
                if cost <= self.budget[child]:
                    after.add((child, cost, ""))
                if x != c and (other := self.children[child].get(c)) is not None and e + 1 <= self.budget[other]:
                    after.add((other, e + 1, x))
        self.steps[state][c] = to = self._state(after, self._found[state])
        return to

    def match(self, word: str) -> tuple[int, int] | None:
        if len(self.items) > STATES:
            self._forget()
        at = self.start
        for c in word:
            to = self.steps[at].get(c)
            at = self._step(at, c) if to is None else to
            if not self.items[at]:
                break
        found = self.finals[at]
        return found and (found[1], found[0])


@dataclass
class ToxicityModel:
    terms: list[Term] = field(default_factory=list)
    coefficients: list[float] = field(default_factory=lambda: [-3.0, 0.0, 0.0, 0.0])


def quotations(line: str) -> list[tuple[int, int]]:
    """Where quotations begin and end in a line: marks of one kind in pairs, the straight ones by turns; one that does not end is none."""
    spans = []
    for opening, closing in QUOTES:
        at = line.find(opening)
        while at >= 0 and (end := line.find(closing, at + 1)) >= 0:
            spans.append((at, end))
            at = line.find(opening, end + 1)
    marks = [m.start() for m in re.finditer(STRAIGHT, line)]
    return spans + list(zip(marks[::2], marks[1::2], strict=False))


def context_score(text: str, start: int, end: int, quoted: bool) -> float:
    """1 for a plain hit; less inside a quotation or after a word that reports speech; more where somebody is addressed."""
    left, right = text[max(0, start - WINDOW) : start].rpartition("\n")[2], text[end : end + WINDOW].partition("\n")[0]
    before, after = WORD.findall(left)[-8:], WORD.findall(right)[:8]
    score = 0.2 if quoted else 1.0
    if not REPORTING.isdisjoint(before):
        score *= 0.5
    elif not ADDRESSING.isdisjoint(before + after) and not quoted:
        score *= 1.5
    return score


class Scorer:
    """Features of texts under a model; one per task."""

    def __init__(self, model: ToxicityModel):
        self.model, self.automaton, self.memory = model, LexiconAutomaton(model.terms), {}

    def hits(self, text: str) -> list[tuple[int, int, float]]:
        """(term, edits, context score) of each hit, in order."""
        text, memory = text.lower(), self.memory
        if len(memory) > REMEMBERED:
            memory.clear()
        found = {}
        for w in set(WORD.findall(text)):
            if w not in memory:
                memory[w] = self.automaton.match(w)
            if memory[w]:
                found[w] = memory[w]
        if not found:
            return []
        out, at, line_end, spans = [], 0, -1, []
        for m in WORD.finditer(text):
            if m[0] not in found:
                continue
            if m.start() > line_end:  # the quotations of the hit's line, once for each line
                at = text.rfind("\n", 0, m.start()) + 1
                line_end = text.find("\n", m.start())
                line_end = len(text) if line_end < 0 else line_end
                spans = sorted(quotations(text[at:line_end]))
                starts = [s for s, _ in spans]
                ends = list(accumulate((e for _, e in spans), max))
            k = bisect(starts, m.start() - at) - 1
            out.append((*found[m[0]], context_score(text, m.start(), m.end(), k >= 0 and ends[k] >= m.end() - at)))
        return out

    def features(self, text: str | None) -> tuple[list[float], list[tuple[int, int, float]]]:
        hits = self.hits(text or "")
        if not hits:
            return [1.0, 0.0, 0.0, 0.0], hits
        worth = [(self.model.terms[k].weight * c / (1 + e), c >= 0.75) for k, e, c in hits]
        plain, quoted = sum(w for w, direct in worth if direct), sum(w for w, direct in worth if not direct)
        several = float(len({k for k, _, c in hits if c >= 0.75}) > 1)
        return [1.0, float(np.log1p(plain)), float(np.log1p(quoted)), several], hits


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from; a null doc_id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 60) -> list[float]:
    w = np.zeros(x.shape[1])
    penalty = ridge * np.r_[1e-3, np.ones(x.shape[1] - 1)]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + penalty * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 2.0 / max(1e-12, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-8:
            break
    return [float(v) for v in w]


def _least_share(t: Column, n: Column, z: float = 1.64) -> Column:
    """The lower end of Wilson's interval for ``t`` cases of ``n``."""
    p = t / n
    return (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def _beginnings(word: str) -> list[str]:
    return [word[:n] for n in STEM_LENGTHS if n <= len(word)]


def _lexicon(counts: list, toxic: int, clean: int) -> list[Term]:
    """Words and stems, of those that mark toxic texts; a stem stands in for its words where it is found in many more texts than any."""
    words = {r["term"][2:]: (r["t"], r["c"]) for r in counts if r["term"][0] == "w"}
    stems = {r["term"][2:]: (r["t"], r["c"]) for r in counts if r["term"][0] == "p"}
    most: dict[str, int] = {}
    deeper: dict[str, int] = {}
    for found, best in ((words, most), (stems, deeper)):
        for w, (t, _) in found.items():
            for s in _beginnings(w):
                if found is words or s != w:
                    best[s] = max(best.get(s, 0), t)
    kept: dict[str, tuple[int, int]] = {}
    for s in sorted(stems, key=lambda s: (len(s), s)):
        t = stems[s][0]
        if t > 1.3 * most.get(s, 0) and deeper.get(s, 0) < 0.95 * t and kept.keys().isdisjoint(_beginnings(s)):
            kept[s] = stems[s]
    chosen = [(w, True, v) for w, v in kept.items()] + [(w, False, v) for w, v in words.items() if kept.keys().isdisjoint(_beginnings(w))]
    odds = lambda v: float(np.log((v[0] + 0.5) / (toxic + 1)) - np.log((v[1] + 0.5) / (clean + 1)))
    return [Term(w, s, max(0.1, odds(v))) for w, s, v in sorted(chosen, key=lambda x: (-x[2][0], x[0], x[1]))]


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, clean_rate: float = 0.002) -> ToxicityModel:
    """Learn from about ``fit_rows`` labelled rows (chosen by hash) that are not held out; of equal and most nearly equal texts, one counts.

    All terms that mark toxic texts significantly are taken. A term is matched with edits only if that finds it in at most ``clean_rate`` of the clean texts. Rows without doc_id
    or label are left out; without labels of both kinds, every text gets the same low score.
    """
    ids = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, fit_rows / max(1, ids.count()))
    ids = ids.where(F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    chosen = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id").select("text", (F.col("toxic") > 0).cast("int").alias("toxic"))
    spoken = chosen.withColumn("w", F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    pairs = F.zip_with(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", 2, F.greatest(F.size("w") - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b))
    alike = F.coalesce(F.array_min(pairs), F.xxhash64("text"))  # the least hash of word pairs: equal for most near copies
    sample = materialize(spoken.groupBy("toxic", alike.alias("alike")).agg(F.min("text").alias("text")).select("text", "toxic"), "toxicity-fit")
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not n.get(0) or not n.get(1):
        return ToxicityModel()
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    stem = lambda k: F.transform(F.filter("w", lambda x: F.length(x) > k), lambda x: F.concat(F.lit("p:"), F.substring(x, 1, k)))
    terms = F.array_distinct(F.concat(F.transform("w", lambda x: F.concat(F.lit("w:"), x)), *(stem(k) for k in STEM_LENGTHS)))
    counted = sample.select("toxic", words.alias("w")).select("toxic", F.explode(terms).alias("term")).groupBy("term").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    marking = (F.col("t") >= max(5, n[1] // ONE_TEXT_IN)) & (_least_share(F.col("t"), F.col("t") + F.col("c")) >= LEAST_SHARE)
    found = counted.where(marking).collect()  # each is in a set share of the toxic texts, so their number follows the terms of a text, not the texts
    model = ToxicityModel(_lexicon(found, n[1], n[0]))

    def edited(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        for b in batches:
            yield pd.DataFrame([(k,) for text in b["text"] for k in {k for k, e, _ in scorer.hits(text) if e}], columns=["term"])

    loose = {r["term"] for r in sample.where("toxic = 0").mapInPandas(edited, "term int").groupBy("term").count().where(F.col("count") > max(1, int(clean_rate * n[0]))).collect()}
    model.terms = [Term(t.text, t.stem, t.weight, k not in loose) for k, t in enumerate(model.terms)]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        for b in batches:
            yield pd.DataFrame({"x": [scorer.features(text)[0] for text in b["text"]], "toxic": b["toxic"]})

    got = sample.mapInPandas(rows, "x array<double>, toxic int").groupBy("x", "toxic").count().collect()  # at most fit_rows short rows
    repeat = np.array([r["count"] for r in got])
    x, y = np.repeat(np.array([r["x"] for r in got]), repeat, axis=0), np.repeat(np.array([r["toxic"] for r in got], dtype=float), repeat)
    model.coefficients = _logistic(x, y)
    return model


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with a struct column ``toxicity`` (score, n_hits, n_quoted, n_misspelled); only ``text`` is read.

    Null and empty texts have no hits and get the score of such texts; repeated rows score alike; whole texts count,
    however long; no rows give no rows. A column named ``toxicity`` is replaced, all others stay as they are.
    """

    @F.pandas_udf("score double, n_hits int, n_quoted int, n_misspelled int")
    def toxicity(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer, w = Scorer(model), np.array(model.coefficients)
        for texts in parts:
            out = []
            for text in texts:
                x, hits = scorer.features(text)
                z = float(np.clip(np.dot(x, w), -30, 30))
                out.append((1 / (1 + np.exp(-z)), len(hits), sum(c < 0.75 for _, _, c in hits), sum(e > 0 for _, e, _ in hits)))
            yield pd.DataFrame(out, columns=["score", "n_hits", "n_quoted", "n_misspelled"])

    return docs.withColumn("toxicity", toxicity("text"))

"""Toxicity scores: a lexicon trie learnt from labels, met by Levenshtein automata, with context windows.

The lexicon holds word beginnings and whole words that occur in toxic training documents far more often than
chance allows. Words are read by the product of the trie and the Levenshtein automaton of distance 1, made
deterministic as it is used: a state is the set of (trie node, errors) that the letters so far can reach, and
most words end in the empty state after a few letters. A swap of two neighbouring letters is one error. Whole words
of at least `FUZZY_LEAST` letters and beginnings of at least `BEGIN_LEAST` may have one.

An occurrence is quoted if quotation marks stand on both sides within `WINDOW` characters of it on its line. Each
(term, errors, quoted) has a weight of its own: the log-ratio of its rates in toxic and clean training documents,
drawn towards a fraction of the term's plain weight while there are few cases (towards none for beginnings with an
error, which are common in harmless words, so that these count by their own cases only). A document's score is the logistic
of the prior log-odds plus, for each term found, the largest weight among its occurrences.

Bounds of the model (parameters): at most `toxic_docs` and `clean_docs` training documents, drawn by hash of the
id, and `terms` lexicon entries. Scoring reads whole texts.

Defined results: null and empty texts get the prior; labels that are null are ignored, of repeated labels the
largest counts; of documents that repeat an id one is learnt from; without labels every score is the smoothed prior;
an empty table gives an empty result; a column named toxic_score_ is replaced, other columns pass unchanged.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import append_columns, held_out, materialise

SHORTEST, LONGEST = 3, 10
#: Marks the end of a whole word in the trie.
END = "$"
#: Letters from which a whole word may have an error, and a beginning: shorter beginnings with an error are common in
#: harmless words.
FUZZY_LEAST, BEGIN_LEAST = 5, 8
#: In place of an error count: two neighbouring letters are being read in the wrong order.
SWAP = 2
WINDOW = 60
MARKS = "\"'“”„«»‘’"
#: What separates words, in learning and in scoring alike; quotation marks are part of it.
CUT = "[ \\t\\n\\x0B\\f\\r\u00a0\u3000.,;:!?()\\[\\]{}|<>%&$#*_=+~^/\\\\…\"'“”„«»‘’-]+"
SPLIT = re.compile(f"[^{CUT[1:-2]}]+").findall
#: Apostrophes inside words are no quotation marks.
INNER = re.compile(r"(?<=\w)['’](?=\w)").sub
APART = frozenset(c for c in map(chr, range(0x3100)) if re.fullmatch(CUT, c))
QUOTED_SHARE, FUZZY_SHARE, DRAWN = 0.25, 0.6, 3.0
KEPT_WORDS = 400_000


@dataclass
class ToxicityModel:
    """Lexicon terms with their weights by (errors, quoted), and the prior log-odds."""

    prior: float
    weights: dict[str, dict[tuple[int, bool], float]] = field(default_factory=dict)


class Matcher:
    """The lazily determinised product of a lexicon trie and the Levenshtein automaton of distance 1."""

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.begins: dict[int, str] = {}
        self.wholes: dict[int, str] = {}
        for term in terms:
            node = 0
            for c in term.removesuffix(END):
                node = self.children[node].setdefault(c, len(self.children))
                if node == len(self.children):
                    self.children.append({})
            (self.wholes if term.endswith(END) else self.begins)[node] = term
        self.states: list[frozenset[tuple[int, int, str]]] = [frozenset([(0, 0, "")])]
        self.numbers = {self.states[0]: 0}
        self.steps: list[dict[str, int]] = [{}]
        self.kept: dict[str, tuple[tuple[str, int], ...]] = {}

    def _step(self, state: int, c: str) -> int:
        """The state after one more letter. Members are (node, errors, letter): errors 0 or 1, or SWAP with a letter
        that was read too early and is due next."""
        found = set()
        for node, errors, due in self.states[state]:
            here = self.children[node]
            if errors == SWAP:
                if c in here and due in self.children[here[c]]:
                    found.add((self.children[here[c]][due], 1, ""))
                continue
            if c in here:
                found.add((here[c], errors, ""))
            if not errors:
                found.add((node, 1, ""))
                found.add((node, SWAP, c))
                for child in here.values():
                    found.add((child, 1, ""))
                    if c in self.children[child]:
                        found.add((self.children[child][c], 1, ""))
        to = frozenset(x for x in found if not (x[1] == 1 and (x[0], 0, "") in found))
        if to not in self.numbers:
            self.numbers[to] = len(self.states)
            self.states.append(to)
            self.steps.append({})
        self.steps[state][c] = self.numbers[to]
        return self.numbers[to]

    def match(self, word: str) -> tuple[tuple[str, int], ...]:
        """(term, errors) of each lexicon term that the word is or begins with, with one error at most."""
        found: dict[str, int] = {}
        state = 0
        steps, states = self.steps, self.states
        for c in word:
            to = steps[state].get(c)
            state = self._step(state, c) if to is None else to
            if not states[state]:
                break
            for node, errors, _ in states[state]:
                term = self.begins.get(node)
                if term and errors != SWAP and (not errors or len(term) >= BEGIN_LEAST):
                    found[term] = min(errors, found.get(term, 1))
        for node, errors, _ in states[state]:
            if errors == SWAP:
                continue
            ends = [node] if errors else [node, *self.children[node].values()]
            for i, n in enumerate(ends):
                wrong = errors + (i > 0)
                for term, least in ((self.wholes.get(n), FUZZY_LEAST + 1), (self.begins.get(n), BEGIN_LEAST)):
                    if term and (not wrong or len(term) >= least):
                        found[term] = min(wrong, found.get(term, 1))
        return tuple(sorted(found.items()))

    def of_token(self, token: str) -> tuple[tuple[str, int], ...]:
        known = self.kept.get(token)
        if known is None:
            if len(self.kept) >= KEPT_WORDS:
                self.kept.clear()
            known = self.kept[token] = self.match(token)
        return known

    def terms_in(self, text: str) -> dict[tuple[str, int, bool], None]:
        """Every (term, errors, quoted) of a text."""
        low = text.lower()
        found: dict[tuple[str, int, bool], None] = {}
        for token in set(SPLIT(low)):
            hits = self.of_token(token)
            if hits:
                for quoted in set(quotations(low, token)):
                    for term, errors in hits:
                        found[term, errors, quoted] = None
        return found


def quotations(text: str, token: str):
    """Whether each occurrence of a token, as a whole word, stands in quotation marks."""
    at = text.find(token)
    while at >= 0:
        end = at + len(token)
        if (not at or text[at - 1] in APART) and (end == len(text) or text[end] in APART):
            before = INNER("", text[max(0, at - WINDOW) : at].rpartition("\n")[2])
            after = INNER("", text[end : end + WINDOW].partition("\n")[0])
            yield any(c in after for c in MARKS) and sum(before.count(c) for c in MARKS) % 2 == 1
        at = text.find(token, end)


def drawn(rows: DataFrame, most: int, count: int) -> DataFrame:
    """The `most` rows that come first by hash of the id. Hashes are uniform, so a bound on them leaves few more rows
    than are wanted (a count of ids says where it lies), whatever the size of the table; the rest is an exact top-k."""
    share = (most + 10 * math.sqrt(most) + 100) / max(count, 1)
    place = F.shiftrightunsigned(F.xxhash64("id"), 1)
    near = rows if share >= 1 else rows.where(place / float(1 << 63) < share)
    return near.orderBy(place, "id").limit(most)


def training_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, toxic_docs: int, clean_docs: int) -> tuple[DataFrame, int, int]:
    """(text, toxic) of the drawn documents, and how many toxic and clean labels the training fold holds.

    Of documents that repeat a drawn id, the one with the smallest hash of the text is taken, so the sample is bounded.
    """
    known = labels.where(~held_out(key) & F.col(label).isNotNull()).groupBy(F.col(key).alias("id")).agg((F.max(label) > 0).alias("toxic"))
    known = materialise(known.where("id IS NOT NULL"))
    counts = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    toxic, clean = counts.get(True, 0), counts.get(False, 0)
    chosen = drawn(known.where("toxic"), toxic_docs, toxic).unionByName(drawn(known.where("NOT toxic"), clean_docs, clean))
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).where("text IS NOT NULL").join(F.broadcast(chosen), "id")
    one = texts.groupBy("id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return materialise(one.select("text", "toxic").distinct()), toxic, clean


def lexicon(sample: DataFrame, toxic: int, clean: int, terms: int) -> list[str]:
    """Trie nodes whose share of toxic documents is beyond chance, the most telling first, none above another."""
    words = F.array_distinct(F.split(F.lower("text"), CUT))
    words = F.filter(words, lambda w: F.char_length(w) >= SHORTEST)
    heads = F.transform(
        words,
        lambda w: F.concat(
            F.transform(F.sequence(F.lit(SHORTEST), F.least(F.char_length(w), F.lit(LONGEST))), lambda n: F.substring(w, F.lit(1), n)),
            F.array(F.concat(w, F.lit(END))),
        ),
    )
    nodes = sample.select("toxic", F.explode(F.array_distinct(F.flatten(heads))).alias("node"))
    nodes = nodes.groupBy("node").agg(F.count_if("toxic").alias("bad"), F.count_if(~F.col("toxic")).alias("good"))
    nodes = materialise(nodes.where(F.col("bad") + F.col("good") >= 3))
    base = toxic / (toxic + clean)
    n, share = F.col("bad") + F.col("good"), F.col("bad") / (F.col("bad") + F.col("good"))
    rest = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(0.0)
    telling = n * (share * F.log(share / base) + rest)
    least = math.log(max(2, nodes.count())) + 2
    picked = nodes.where((F.col("bad") > 0) & (share > base)).withColumn("telling", telling).where((F.col("telling") >= least) & (share >= 0.5))
    rows = picked.orderBy(F.desc("telling"), F.desc(F.char_length("node")), "node").limit(terms).collect()
    chosen: list[str] = []
    above: set[str] = set()
    taken: set[str] = set()
    for r in rows:
        heads_of = {r.node[:i] for i in range(1, len(r.node))}
        if r.node not in above and not heads_of & taken:
            chosen.append(r.node)
            taken.add(r.node)
            above |= heads_of
    return chosen


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    toxic_docs: int = 1500, clean_docs: int = 3000, terms: int = 2000,
) -> ToxicityModel:
    """Learn lexicon, weights and prior from the training fold."""
    sample, n_toxic, n_clean = training_sample(docs, labels, key, text, label, toxic_docs, clean_docs)
    model = ToxicityModel(math.log((n_toxic + 0.5) / (n_clean + 4.5)))
    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(True, 0), sizes.get(False, 0)
    found = lexicon(sample, toxic, clean, terms) if toxic and clean else []
    if not found:
        return model

    def cases(batches):
        matcher = Matcher(found)
        for batch in batches:
            out = [
                (*hit, bad)
                for t, bad in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                for hit in matcher.terms_in(t)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True) if out else [[]] * 4, (pa.string(), pa.int32(), pa.bool_(), pa.bool_()), strict=True)], ["term", "errors", "quoted", "toxic"])

    seen = sample.mapInArrow(cases, "term string, errors int, quoted boolean, toxic boolean")
    rows = seen.groupBy("term", "errors", "quoted").agg(F.count_if("toxic").alias("bad"), F.count_if(~F.col("toxic")).alias("good")).collect()
    counts = {(r.term, r.errors, r.quoted): (r.bad, r.good) for r in rows}
    for term in found:
        ratios = {}
        for case in ((0, False), (0, True), (1, False), (1, True)):
            bad, good = counts.get((term, *case), (0, 0))
            ratio = math.log((bad + 0.5) / (toxic + 1)) - math.log((good + 0.5) / (clean + 1))
            if case == (0, False):
                ratios[case] = ratio
            else:
                share = (FUZZY_SHARE if term.endswith(END) else 0.0) if case[0] else 1.0
                prior = ratios[0, False] * share * (QUOTED_SHARE if case[1] else 1)
                n = bad + good
                ratios[case] = (DRAWN * prior + n * ratio) / (DRAWN + n)
        model.weights[term] = ratios
    return model


_matchers: dict[str, Matcher] = {}


def score_text(text: str | None, model: ToxicityModel, matcher: Matcher) -> float:
    total = model.prior
    if text:
        best: dict[str, float] = {}
        for term, errors, quoted in matcher.terms_in(text):
            weight = model.weights[term][errors, quoted]
            best[term] = max(weight, best.get(term, -math.inf))
        total += sum(best.values())
    return 1 / (1 + math.exp(-max(-60.0, min(60.0, total))))


def score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """docs with toxic_score_ appended."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    name = hashlib.sha256(repr(model).encode()).hexdigest()

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        if name not in _matchers:
            _matchers.clear()
            _matchers[name] = Matcher(list(shared.value.weights))
        matcher = _matchers[name]
        return [pa.array([score_text(t, shared.value, matcher) for t in batch.column(text).to_pylist()], pa.float64())]

    return append_columns(docs, "toxic_score_ double", make)

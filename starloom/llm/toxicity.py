"""Operator 6: toxicity by a weighted finite-state pattern grammar.

Words of a clause become tags (insult, threat, target, negation, report,
word).  Small transducers rewrite the tags in turn: a threat verb before a
target is a menace, a target before an insult aims it, a negation before either
denies it, a verb of speech before it reports it; the last one weighs the
patterns that are left: insult (bare), aimed, menace, denied, reported.  Their
composition is one machine, run over the clauses of a text that holds an insult
or a threat.  A clause scores the sum of its patterns' weights times the
strengths of their words; the text's score is the logistic function of a bias
plus the clause scores.

The weights and the bias are fitted, one weight a pattern, to the labelled
training rows: a logistic regression whose ridge draws them to the fixed
``PRIOR``, under which a bare insult, a denied and a reported one stay below the
threshold and one aimed insult or menace reaches it.  So how much a bare, denied
or reported insult counts is what the labels say of it.

The insult tag is learnt too: words and word beginnings that mark toxic
documents, with their log-odds as strengths, join a small fixed list.  Only
occurrences that the grammar leaves standing (neither denied nor reported)
count, for either class; words that have a role in the grammar are no insults.
Training reads at most ``SAMPLE`` labelled documents of each class, those first
in the order of a hash of the id.

Defined cases: null and empty texts have no clause and get the bias;
null ids are never training rows and count as not held out; null labels are
ignored, several labels of an id count as toxic if one is; of several texts of
an id the least one in code point order is learnt, and of equal texts with
both labels the toxic one, so the order of rows changes nothing; without
training rows of both classes the fixed list and ``PRIOR`` decide; repeated rows
score alike; an empty table gives an empty result; extra columns are ignored by
:func:`toxicity_scores` and kept by :func:`keep_clean`.  Texts of any length are
read whole, clause by clause.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import prepare, text_column, written

SAMPLE = 10_000          # labelled documents of each class that are read
MIN_DOCS = 3             # an entry occurs in so many toxic documents
MIN_ODDS = 4.0           # least log-odds of an entry
STEMS = (4, 5, 6, 7)      # lengths of word beginnings that are tried
THRESHOLD = 0.7
PATTERNS = ("insult", "aimed", "menace", "denied", "reported")
PRIOR = (-3.0, 2.0, 4.0, 4.0, 0.0, 0.0)  # bias and a weight a pattern: what holds where the labels say nothing
RIDGE = 0.1

INSULTS = ("idiot moron stupid fool loser scum trash clown pathetic worthless disgusting dumb imbecile bastard "
           "idiota imbécil estúpido basura dummkopf abschaum trottel crétin imbécile ordure").split()
THREATS = "kill hurt destroy beat attack shoot stab burn töten schlagen tuer frapper matar golpear".split()
TARGETS = ("you your he she him her they them this that these those people du dich ihr sie er "
           "tu toi vous il elle ils tú usted él ella ellos").split()
NEGATIONS = "not no never without hardly nicht kein keine nie pas jamais aucun nunca ningún jamás".split()
REPORTS = ("said says wrote called reported quoted claimed told sagte schrieb nannte dit écrit disait "
           "dijo escribió llamó").split()

_CLAUSE = re.compile(r"[.!?;\n]+")
_WORD = re.compile(r"[^\W\d_]+")
ANY = "*"


@dataclass
class Transducer:
    """A deterministic weighted transducer over tags; ``ANY`` stands for the tags a state does not name."""

    start: object
    arcs: dict = field(default_factory=dict)  # state -> {tag: (output tag, weight, next state)}

    def step(self, state, tag):
        out = self.arcs[state].get(tag)
        if out is None:
            out = self.arcs[state][ANY]
        return (tag if out[0] == ANY else out[0]), out[1], out[2]

    def compose(self, other: "Transducer", tags: list[str]) -> "Transducer":
        """Feed this machine's output to ``other``; weights add up."""
        start = (self.start, other.start)
        made, todo = Transducer(start), [start]
        while todo:
            state = todo.pop()
            if state in made.arcs:
                continue
            made.arcs[state] = {}
            for tag in tags:
                mid, w1, a = self.step(state[0], tag)
                out, w2, b = other.step(state[1], mid)
                made.arcs[state][tag] = (out, w1 + w2, (a, b))
                todo.append((a, b))
        return made


def within(trigger: set[str], reach: int, rewrite: dict[str, str]) -> Transducer:
    """For ``reach`` words after a trigger tag, rewrite tags as told."""
    t = Transducer(0)
    for left in range(reach + 1):
        arcs = {ANY: (ANY, 0.0, max(left - 1, 0))}
        if left:
            arcs.update({a: (b, 0.0, left - 1) for a, b in rewrite.items()})
        arcs.update({x: (rewrite.get(x, ANY) if left else ANY, 0.0, reach) for x in trigger})
        t.arcs[left] = arcs
    return t


def weigher(weights: dict[str, float]) -> Transducer:
    arcs = {tag: (ANY, w, 0) for tag, w in weights.items()}
    return Transducer(0, {0: {ANY: (ANY, 0.0, 0), **arcs}})


TAGS = ["insult", "threat", "target", "negation", "report", "word"]
MARKED = ["insult", "aimed", "menace"]


def grammar(weights=PRIOR[1:]) -> Transducer:
    """Threat, target, negation, report and weight transducers composed to one machine of numbered states."""
    menace = within({"threat"}, 3, {"target": "menace"})
    aim = within({"target"}, 4, {"insult": "aimed"})
    deny = within({"negation"}, 3, {m: "denied" for m in MARKED})
    report = within({"report"}, 8, {**{m: "reported" for m in MARKED}, "denied": "denied"})
    machine = menace
    for part in (aim, deny, report, weigher(dict(zip(PATTERNS, weights)))):
        machine = machine.compose(part, TAGS)
    number = {state: k for k, state in enumerate(machine.arcs)}
    arcs = {number[state]: {tag: (tag if out == ANY else out, weight, number[after]) for tag, (out, weight, after) in by_tag.items()}
            for state, by_tag in machine.arcs.items()}
    return Transducer(number[machine.start], arcs)


class Tagger(dict):
    """Word -> (tag, strength), remembered for a bounded number of words."""

    LIMIT = 500_000

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        super().__init__()
        self.words, self.stems = words, stems
        self.sizes = sorted({len(s) for s in stems})
        self.fixed = {w: t for t, ws in (("report", REPORTS), ("negation", NEGATIONS), ("target", TARGETS),
                                         ("threat", THREATS)) for w in ws}

    def __missing__(self, word: str):
        if len(self) > self.LIMIT:
            self.clear()
        found = (self.fixed.get(word, "word"), 1.0)
        if found[0] == "word":
            best = self.words.get(word, 0.0)
            for n in self.sizes:
                if len(word) > n:
                    best = max(best, self.stems.get(word[:n], 0.0))
            if best:
                found = ("insult", best)
        self[word] = found
        return found


def clauses(text: str) -> Iterator[list[str]]:
    for clause in _CLAUSE.split(text.lower()):
        yield _WORD.findall(clause)


def matched_clauses(text: str, tagger: Tagger, machine: Transducer) -> Iterator[tuple[float, list[tuple[str, float]]]]:
    """Score and (pattern, strength) pairs of each clause that matches."""
    if not any(tagger[w][0] in ("insult", "threat") for w in set(_WORD.findall(text.lower()))):
        return
    for words in clauses(text):
        state, score, found = machine.start, 0.0, []
        for word in words:
            tag, strength = tagger[word]
            out, weight, state = machine.arcs[state][tag]
            if out in PATTERNS:
                score += weight * strength
                found.append((out, strength))
        if found:
            yield score, found


def pattern_sums(text: str, tagger: Tagger, machine: Transducer) -> list[float]:
    """Strengths of a text's matches, summed by pattern."""
    sums = dict.fromkeys(PATTERNS, 0.0)
    for _, found in matched_clauses(text, tagger, machine):
        for pattern, strength in found:
            sums[pattern] += strength
    return list(sums.values())


def text_score(text: str, bias: float, tagger: Tagger, machine: Transducer) -> float:
    total = bias + sum(score for score, _ in matched_clauses(text, tagger, machine))
    return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def standing_words(text: str, tagger: Tagger, machine: Transducer) -> set[str]:
    """Words without a role in the grammar that, were they insults, would be neither denied nor reported somewhere."""
    found = set()
    for words in clauses(text):
        state = machine.start
        for word in words:
            tag = tagger[word][0]
            if tag in ("word", "insult") and machine.arcs[state]["insult"][0] in MARKED:
                found.add(word)
            state = machine.arcs[state][tag][2]
    return found


def fit_weights(sums, labels, rounds: int = 100) -> list[float]:
    """Bias and pattern weights: logistic regression by damped Newton steps, its ridge centred on ``PRIOR``."""
    y, prior = np.asarray(labels, dtype=float), np.array(PRIOR)
    if len(y) == 0 or y.min() == y.max():
        return list(PRIOR)
    x = np.column_stack([np.ones(len(y)), np.asarray(sums, dtype=float)])

    def loss(w):
        z = x @ w
        return float(np.sum(np.logaddexp(0, z) - y * z) + RIDGE / 2 * np.sum((w - prior) ** 2))

    w = prior
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + RIDGE * (w - prior)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(w)), grad)
        rate, before = 1.0, loss(w)
        while rate > 1e-6 and loss(w - rate * step) > before:
            rate /= 2
        w = w - rate * step
        if np.abs(step).max() < 1e-9 or rate <= 1e-6:
            break
    return w.tolist()


def _remainder(id_col: str) -> Column:
    return F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 3


def _training(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """``_id, _y, _t``: bounded samples of the training rows of each class."""
    ids = labels.where(F.col(f"`{label_col}`").isNotNull() & F.col(f"`{id_col}`").isNotNull() & (_remainder(id_col) != 1)) \
        .groupBy(F.col(f"`{id_col}`").alias("_id")).agg(F.max(label_col).cast("int").alias("_y"))
    one = ids.where("_y = 1").orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE)
    zero = ids.where("_y = 0").orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE)
    chosen = one.unionByName(zero)  # at most 2 * SAMPLE ids: the broadcast below is bounded
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), text_column(text_col).alias("_t"))
    found = rows.join(F.broadcast(chosen), "_id").groupBy("_id", "_y").agg(F.min("_t").alias("_t"))
    return written(found, "toxic-sample")


def learn_lexicon(sample: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Words and beginnings that, left standing, mark toxic documents, with their log-odds divided by ``MIN_ODDS``."""
    texts = sample.groupBy(F.md5("_t").alias("_k")).agg(F.max("_y").alias("_y"), F.first("_t").alias("_t"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger, machine = Tagger({}, {}), grammar()
        for b in batches:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for y, t in zip(b.column("_y").to_pylist(), b.column("_t")):
                words = standing_words(t.as_py(), tagger, machine)
                found = {w for w in words if len(w) > 2}
                found |= {w[:n] + "*" for w in words for n in STEMS if len(w) > n}
                seen[y].update(found)
            names = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(names, type=pa.string()), pa.array([seen[1][n] for n in names], type=pa.int64()),
                                              pa.array([seen[0][n] for n in names], type=pa.int64())], names=["f", "t", "c"])

    sizes = {r._y: r.n for r in texts.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    words, stems = {w: 1.0 for w in INSULTS}, {}
    if toxic and clean:
        counts = texts.select("_y", "_t").mapInArrow(count, "f string, t long, c long") \
            .groupBy("f").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
        odds = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
        # every word of the bounded sample that passes; the list grows with ``SAMPLE``, not with the corpus
        for r in counts.where(F.col("t") >= MIN_DOCS).withColumn("o", odds).where(F.col("o") >= MIN_ODDS).collect():
            into, key = (stems, r.f[:-1]) if r.f.endswith("*") else (words, r.f)
            into[key] = max(into.get(key, 0.0), r.o / MIN_ODDS)
    return words, stems


@dataclass
class Model:
    words: dict[str, float]
    stems: dict[str, float]
    weights: list[float]  # bias, then a weight a pattern

    def scorer(self):
        """A function from a text to its score."""
        tagger, machine = Tagger(self.words, self.stems), grammar(self.weights[1:])
        return lambda text: text_score(text, self.weights[0], tagger, machine)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> Model:
    """Learn the lexicon and the pattern weights from the training rows among ``docs``."""
    prepare(docs.sparkSession)
    sample = _training(docs, labels, id_col, text_col, label_col)
    words, stems = learn_lexicon(sample)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger, machine = Tagger(words, stems), grammar()
        for b in batches:
            sums = [pattern_sums(t.as_py(), tagger, machine) for t in b.column("_t")]
            yield pa.RecordBatch.from_arrays([b.column("_y").cast(pa.int32()), pa.array(sums, type=pa.list_(pa.float64()))], names=["y", "s"])

    # at most 2 * SAMPLE rows; sorted, as sums of floats depend on their order
    rows = sorted((r.y, r.s) for r in sample.select("_y", "_t").mapInArrow(measure, "y int, s array<double>").collect())
    return Model(words, stems, fit_weights([s for _, s in rows], [y for y, _ in rows]))


def _scored(rows: DataFrame, model: Model) -> DataFrame:
    """Replace the last column, ``_t``, by ``_score``."""
    schema = rows.drop("_t").schema.add("_score", "double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model.scorer()
        for b in batches:
            names = [n for n in b.schema.names if n != "_t"]
            scores = pa.array([of(t.as_py()) for t in b.column("_t")], type=pa.float64())
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in names], scores], names=[*names, "_score"])

    return rows.mapInArrow(score, schema)


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic") -> DataFrame:
    """id, held_out, score, predicted per document."""
    model = train(docs, labels, id_col, text_col, label_col)
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), text_column(text_col).alias("_t"))
    return _scored(rows, model).select(
        F.col("_id").alias(id_col), F.coalesce(_remainder("_id") == 1, F.lit(False)).alias("held_out"),
        F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               label_col: str = "toxic") -> DataFrame:
    """The documents that score below the threshold, with all columns."""
    model = train(docs, labels, id_col, text_col, label_col)
    names = [f"_c{k}" for k in range(len(docs.columns))]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for n, c in zip(names, docs.columns)], text_column(text_col).alias("_t"))
    return _scored(rows, model).where(F.col("_score") < THRESHOLD) \
        .select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])

"""Subject areas of documents, by interpolated n-gram language models of their statements.

A text is a series of statements (sentences, lines, comments; of program code also the names in
it).  One model is trained for each subject and one for the background, on a
bounded sample of labelled documents: people label documents, not statements, so a statement's origin
is estimated among its document's subjects and the background, the models are counted anew, and so on.
A statement is compared by its cross-entropy a token: it belongs to the subject whose cross-entropy is lowest,
if that is below the background's by the subject's least difference and leaves the others behind by its
margin; a document has the subjects it makes STATEMENTS statements about.  Differences and margins are
calibrated on labelled documents kept out of training, for each subject where that is worth it.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled documents that the models are fitted on at most; the first in the order of a hash of doc_id.
LABELLED = 6_000
#: Share of these kept out of training, to calibrate the margin.
HELD_OUT = 5
#: Entries of the count table of each order, as powers of two.
BITS = (18, 19, 19)
#: Weights of the orders in the interpolation, from one word to three.  Estimated on held-out statements they come out at
#: (0.01, 0.04, 0.95), which finds less: F1 0.921 against 0.926 on labels kept apart.
ORDERS = (0.2, 0.4, 0.4)
ROUNDS = 8
#: Further rounds in which a statement may belong to any subject, so that wrong and missing labels lose their hold.
FREE_ROUNDS = 4
#: Weight of the background at the start, against one share for each subject of a document.
FIRST_BACKGROUND = 0.1
#: Statements that make a subject.
STATEMENTS = 2
#: Times that a subject's model must have seen one of a statement's words.
SEEN = 2.0
#: Margins tried, as the probability that a statement belongs to its subject.
MARGINS = (0.5, 0.7, 0.8, 0.9, 0.95, 0.98, 0.99, 0.995)
#: Margins tried for names, which are too short for a sure judgement; least differences tried, in nats a token; the mark of a name.
NAME_MARGINS, GAPS = (0.5, 0.6, 0.75, 0.9), (0.0, 0.1, 0.25, 0.5, 1.0)
#: What holds where nothing is labelled: margin, margin for names, least difference; and the gain in F1 for which a subject leaves the common choice.
START, GAIN = (0.9, 0.6, 0.0), 0.01
NAME = "name: "
#: Distinct statements a task remembers before it starts afresh.
REMEMBERED = 200_000
#: The subject of all program code.
CODE_SUBJECT = "software"

#: Words of programming languages and their libraries, which name no thing a program handles.
CODE_WORDS = frozenset(
    "and any append args array as assert async await bool boolean break byte case catch char class const continue def default del delete dict do double elif else enum err error errors except export extends"
    " false final finally fn float for from func function get getlogger global go goto id if impl implements import in include index input int integer interface is items iter json key keys lambda len length let"
    " limit list log logger logging long loop main map match math max method min missing mod module mut name new nil none not null number object of or os out output package pass pipeline pow prev print printf private"
    " protected pub public push raise range raw rect result return row rows select self set short size skipped sort start static std store str strict string struct sum super switch sys test this throw throws time total"
    " trait true try tuple type typeof undefined union unsigned update use using val value values var vec void warn warning where while with yield".split()
)

_TOKEN = re.compile(r"[^\W\d_㐀-鿿]+|[㐀-鿿]|#")
_BREAK = re.compile(r"[.!?。！？;]+(?:\s|$|[\"')\]])|[。！？]|\n+|\"\s*:\s*\"?|<\w+>")
_CODE_LINE = re.compile(
    r"^\s*(?:(?:export |async |pub |static |public |private )*(?:def|function|func|fn|class|struct|interface|enum)\s+\w+|import\s+\w+|from\s+[\w.]+\s+import\b|(?:const|let|var)\s+\w+\s*=|#include\b|package\s+\w+|using\s+\w+|return\b.*[;)\]]?$|if\s*\(.*\)|for\s+\w+\s+in\s.*:$|'use strict'|\}\s*$|\w+(?:\.\w+)*\(.*\);?$|SELECT\b|CREATE\b|#!)"
)
_NAME = re.compile(r"[A-Za-z][A-Za-z_]{2,}")
_COMMENT = re.compile(r'"""(.*?)"""|^[ \t]*(?://|#(?!include|!))[ \t]*([^\n]+)$|/\*(.*?)\*/|^[ \t]*--[ \t]+([^\n]+)$', re.S | re.M)


def is_code(text: str) -> bool:
    """Program code: a third of the lines that say anything, and at least three, have the form of code."""
    lines = [x for x in text.split("\n") if x.strip()]
    hits = sum(bool(_CODE_LINE.match(x)) for x in lines)
    return hits >= 3 and hits * 3 >= len(lines)


def statements(text: str | None, with_names: bool = True) -> tuple[list[str], bool]:
    """(statements in lower case with # for numbers, whether the text is program code).

    with_names: each name in program code is a statement too, marked by NAME in front.  Models are trained
    without them: what a name deals with is judged by what people write about such things."""
    if not text:
        return [], False
    code = is_code(text)
    parts = [next(g for g in m if g) for m in _COMMENT.findall(text) if any(m)] if code else [text]
    out = []
    for part in parts:
        for s in _BREAK.split(part):
            plain = re.sub(r"\d+", "#", s.strip().lower())
            if len(plain) > 2:
                out.append(plain)
    if code and with_names:
        for n in dict.fromkeys(_NAME.findall(_COMMENT.sub("\n", text))):
            words = [w for w in re.sub(r"(?<=[a-z])(?=[A-Z])", " ", n).replace("_", " ").lower().split() if w not in CODE_WORDS]
            if words:
                out.append(NAME + " ".join(words))
    return out, code


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0x7F4A7C15))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Grams:
    """Table positions of the words, pairs and triples of a list of statements."""

    def __init__(self, texts: list[str]) -> None:
        codes: dict[str, int] = {}
        rows = [[codes.setdefault(w, zlib.crc32(w.encode())) if w not in codes else codes[w] for w in _TOKEN.findall(t.removeprefix(NAME))] for t in texts]
        self.named = np.fromiter((t.startswith(NAME) for t in texts), bool, len(texts))
        lengths = np.fromiter((len(r) for r in rows), np.int64, len(rows))
        word = np.fromiter((w for r in rows for w in r), np.uint64, int(lengths.sum()))
        self.lengths = lengths
        self.row = np.repeat(np.arange(len(texts)), lengths)
        first = np.zeros(len(word), bool)
        starts = (np.cumsum(lengths) - lengths)[lengths > 0]
        first[starts] = True
        one, two = np.roll(word, 1), np.roll(word, 2)
        one[first] = 1
        second = np.roll(first, 1)
        if len(second):
            second[0] = False
        two[first | second] = 2
        mask = [np.uint64((1 << b) - 1) for b in BITS]
        self.w = (word & mask[0]).astype(np.int64)
        self.w1 = (one & mask[0]).astype(np.int64)
        self.b = (_mix(one, word) & mask[1]).astype(np.int64)
        self.b1 = (_mix(two, one) & mask[1]).astype(np.int64)
        self.t = (_mix(_mix(two, one), word) & mask[2]).astype(np.int64)


class Models:
    """Counts of each order by class (0 is the background), and what each class needs to be accepted."""

    def __init__(self, counts: list[np.ndarray], accept: np.ndarray | None = None) -> None:
        self.counts, self.total = counts, counts[0].sum(0) + 1e-6
        self.accept = np.tile(START, (counts[0].shape[1], 1)) if accept is None else accept

    @classmethod
    def count(cls, grams: Grams, weight: np.ndarray) -> Models:
        classes = weight.shape[1]
        tables = [np.empty((1 << bits, classes), np.float32) for bits in BITS]
        for k in range(classes):  # one class at a time keeps the driver's memory low
            each = weight[:, k][grams.row]
            for table, at, bits in zip(tables, (grams.w, grams.b, grams.t), BITS, strict=True):
                table[:, k] = np.bincount(at, each, 1 << bits)
        return cls(tables)

    def _parts(self, grams: Grams, s: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The probability of each token by each order, under each class."""
        words, pairs, triples = self.counts
        return (
            (words[grams.w[s]] + 0.02) / (self.total + 0.02 * 5e4),
            pairs[grams.b[s]] / (words[grams.w1[s]] + 1.0),
            triples[grams.t[s]] / (pairs[grams.b1[s]] + 0.5),
        )

    def cross_entropy_sums(self, grams: Grams) -> np.ndarray:
        """Minus the log probability of each statement under each class."""
        out = np.zeros((len(grams.lengths), self.counts[0].shape[1]))
        step = 200_000
        for i in range(0, len(grams.w), step):
            s = slice(i, i + step)
            log = -np.log(sum(w * p for w, p in zip(ORDERS, self._parts(grams, s), strict=True)))
            rows = grams.row[s]
            for k in range(out.shape[1]):
                out[:, k] += np.bincount(rows, log[:, k], len(out))
        return out

    def posterior(self, grams: Grams, allowed: np.ndarray | None = None) -> np.ndarray:
        """The share of each class in a statement; its words decide, not how common a subject is."""
        return _shares(-self.cross_entropy_sums(grams), allowed)

    def judged(self, grams: Grams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(likeliest class, its share, how much lower its cross-entropy a token is than the background's); class 0 where no word was seen SEEN times in it."""
        sums = self.cross_entropy_sums(grams)
        shares = _shares(-sums)
        best = shares.argmax(1)
        at = np.arange(len(best))
        gap = (sums[:, 0] - sums[at, best]) / np.maximum(grams.lengths, 1)
        most = np.zeros(len(best))
        np.maximum.at(most, grams.row, self.counts[0][grams.w, best[grams.row]])
        return np.where(most >= SEEN, best, 0), shares[at, best], gap

    def decide(self, grams: Grams) -> np.ndarray:
        """The class of each statement; 0 unless one is accepted."""
        best, share, gap = self.judged(grams)
        needed = self.accept[best]
        return np.where((share >= np.where(grams.named, needed[:, 1], needed[:, 0])) & (gap >= needed[:, 2]), best, 0)


def _shares(score: np.ndarray, allowed: np.ndarray | None = None) -> np.ndarray:
    if allowed is not None:
        score = np.where(allowed, score, -1e9)
    p = np.exp(score - score.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def train(labelled: list[tuple[int, str, list[str]]], subjects: list[str]) -> Models:
    """Models from (doc_id, text, subjects); what a subject needs to be accepted is what has the best F1 on the documents held out."""
    held = [x for x in labelled if zlib.crc32(str(x[0]).encode()) % HELD_OUT == 0]
    kept = [x for x in labelled if zlib.crc32(str(x[0]).encode()) % HELD_OUT] or labelled
    texts, allowed = [], []
    for _, text, given in kept:
        parts, code = statements(text, with_names=False)
        mine = np.zeros(len(subjects) + 1, bool)
        mine[0] = True
        for s in [*given, *([CODE_SUBJECT] if code else [])]:
            if s in subjects:
                mine[subjects.index(s) + 1] = True
        texts += parts
        allowed += [mine] * len(parts)
    if not texts:
        return Models([np.zeros((1 << b, len(subjects) + 1), np.float32) for b in BITS])
    grams, may = Grams(texts), np.array(allowed)
    weight = may / may.sum(1, keepdims=True)
    alone = may.sum(1) == 1
    weight[~alone, 0] *= FIRST_BACKGROUND  # else it takes everything: it is allowed everywhere
    for _ in range(ROUNDS):
        weight = Models.count(grams, weight).posterior(grams, may)
    for _ in range(FREE_ROUNDS):
        weight = Models.count(grams, weight).posterior(grams)
    models = Models.count(grams, weight)
    _calibrate(models, held or kept, subjects)
    return models


def _calibrate(models: Models, held: list[tuple[int, str, list[str]]], subjects: list[str]) -> None:
    """The margins and least difference with the best F1 over all subjects, and for a subject those that are much better for it."""
    parts = [statements(text) for _, text, _ in held]
    grams = Grams([s for p, _ in parts for s in p])
    doc = np.repeat(np.arange(len(held)), [len(p) for p, _ in parts])
    code = np.array([c for _, c in parts], bool)
    best, share, gap = models.judged(grams)
    mine = [np.flatnonzero(best == k + 1) for k in range(len(subjects))]
    wanted = [np.array([subject in given for _, _, given in held], bool) for subject in subjects]

    def hits(k: int, choice: tuple[float, float, float]) -> np.ndarray:
        """(right, found, wanted) documents of a subject."""
        margin, name_margin, least = choice
        at = mine[k]
        taken = at[(share[at] >= np.where(grams.named[at], name_margin, margin)) & (gap[at] >= least)]
        got = np.bincount(doc[taken], minlength=len(held)) >= STATEMENTS
        if subjects[k] == CODE_SUBJECT:
            got |= code
        return np.array([(got & wanted[k]).sum(), got.sum(), wanted[k].sum()])

    f1 = lambda n: 2 * n[0] / max(1, n[1] + n[2])
    choices = list(itertools.product(MARGINS, NAME_MARGINS, GAPS))
    table = np.array([[hits(k, c) for c in choices] for k in range(len(subjects))]).reshape(len(subjects), len(choices), 3)
    common = int(np.argmax([f1(n) for n in table.sum(0)])) if len(subjects) else 0
    models.accept[:] = choices[common]
    for k in range(len(subjects)):
        scores = np.array([f1(n) for n in table[k]])
        if scores.max() > scores[common] + GAIN:  # a subject goes its own way only where that is worth it
            models.accept[k + 1] = choices[int(scores.argmax())]


def _judge(models, subjects: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Models(*models.value)
        known: dict[str, int] = {}
        code_class = subjects.index(CODE_SUBJECT) if CODE_SUBJECT in subjects else None
        for b in batches:
            if len(known) > REMEMBERED:
                known.clear()
            parts = [statements(t) for t in b.column("text").to_pylist()]
            new = list(dict.fromkeys(s for p, _ in parts for s in p if s not in known))
            for i in range(0, len(new), 20_000):
                some = new[i : i + 20_000]
                best = m.decide(Grams(some))
                known.update(zip(some, best.tolist(), strict=True))
            ids, names, counts = [], [], []
            for doc, (own, code) in zip(b.column("doc_id").to_pylist(), parts, strict=True):
                n = [0] * (len(subjects) + 1)
                for s in own:
                    n[known[s]] += 1
                for k, subject in enumerate(subjects):
                    if n[k + 1] >= STATEMENTS or (code and k == code_class):
                        ids.append(doc)
                        names.append(subject)
                        counts.append(n[k + 1])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(names, pa.string()), pa.array(counts, pa.int32())], ["doc_id", "subject", "statements"])

    return run


def fit(documents: DataFrame, labels: DataFrame, areas: DataFrame, limit: int = LABELLED) -> tuple[Models, list[str]]:
    """Models from labelled documents, at most `limit`: the first in the order of a hash of doc_id.

    Each subject that any rater gave counts as the document's, once; a wrong one finds no statements of
    its own and does little harm.  Labels that aren't in areas ('none') name no subject."""
    subjects = sorted(r["subject"] for r in areas.select("subject").where("subject is not null").distinct().collect())
    given = labels.where("doc_id is not null and subject is not null").groupBy("doc_id").agg(F.collect_set("subject").alias("given"))
    chosen = given.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = documents.select("doc_id", "text").join(chosen, "doc_id").where("text is not null").collect()
    labelled = sorted(((int(r["doc_id"]), r["text"], sorted(r["given"])) for r in rows), key=lambda x: x[0])
    return train(labelled, subjects), subjects


def subjects_of(documents: DataFrame, labels: DataFrame, areas: DataFrame, limit: int = LABELLED) -> DataFrame:
    """(doc_id, subject, statements): the subjects of each document, by the number of its statements about them.

    documents: doc_id, text; other columns are ignored.  Texts are judged whole, whatever their length.
    Documents with null or empty text have no subject; so has every document if nothing is labelled,
    but for program code.  Repeated texts get the same subjects.  Judging is one pass without a shuffle;
    the models that travel with it have a fixed size."""
    models, subjects = fit(documents, labels, areas, limit)
    sent = documents.sparkSession.sparkContext.broadcast((models.counts, models.accept))
    return documents.select("doc_id", "text").where("doc_id is not null").mapInArrow(_judge(sent, subjects), "doc_id long, subject string, statements int")


def makeup(found: DataFrame, documents: DataFrame) -> DataFrame:
    """(subject, documents, characters, share of all documents); 'none' for documents without a subject."""
    sized = documents.where("doc_id is not null").select("doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("characters"))
    joined = sized.join(found.select("doc_id", "subject"), "doc_id", "left")
    every = sized.agg(F.count("*").alias("every"))
    by = joined.groupBy(F.coalesce("subject", F.lit("none")).alias("subject")).agg(F.count("*").alias("documents"), F.sum("characters").alias("characters"))
    return by.join(F.broadcast(every), F.lit(True)).select("subject", "documents", "characters", F.round(F.col("documents") / F.col("every"), 6).alias("share"))  # one row

"""Toxicity scores behind a noisy-channel decoder.

Writers hide words by leetspeak, by spacing letters out and by repeating them. Here such a token is an
observation: a lattice holds every intended character that may lie behind each observed one, and a
Viterbi search finds the most likely intended word under a character trigram model of the whole corpus.
The restored words are then scored with word and sub-word evidence learned from labelled rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from riskweave.llm.common import stored, unused

THRESHOLD = 0.7
SAMPLE_ROWS = 20_000  # labelled rows that the classifier is fitted on, at the most
RECOUNTS = 6  # rounds at the most; usually two or three change something
LEAST_TEXTS = 4  # toxic texts a feature must occur in to be looked at
TOXIC_SHARE = 0.3  # weight of the labelled toxic texts in the character model

# Characters of the model: 0 is the edge of a word, 1 any character that is not a listed letter.
LETTERS = [chr(c) for c in (*range(ord("a"), ord("z") + 1), *range(0xDF, 0x100)) if chr(c).isalpha()]
SYMBOL = {c: i for i, c in enumerate(LETTERS, start=2)}
SYMBOLS = len(LETTERS) + 2

# Letters that a character may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
}
LEET_COST, REPEAT_COST, GAP_COST = 2.0, 1.0, 0.2
GAPS = " ._-*~'/"

_TAIL = re.compile(r"[\W_]*")  # matched from a word's end, so that a long run is read once
_STRIP_LEFT = re.compile(r"^[^\w@$!|+(<€£¡]+")
_HIDDEN = re.compile(r"[0-9@$!|+(<€£¡]|\w[._\-*~'/]+\w|(.)\1\1|(.)\2(.)\3")
_SPACED = re.compile(r"(?<!\S)(?:\S[ \t]){2,}\S(?!\S)")


# -- the character model ------------------------------------------------------------------------


def _symbol_table() -> np.ndarray:
    table = np.ones(0x10FFFF + 1, np.uint8)
    for c in range(0x3001):
        if chr(c).isspace():
            table[c] = 0
    for c, i in SYMBOL.items():
        table[ord(c)] = i
    return table


def trigram_counts(texts: Iterable[str], table: np.ndarray, piece: int = 1 << 20) -> np.ndarray:
    """How often each triple of symbols occurs, over whole texts in lower case."""
    counts = np.zeros(SYMBOLS**3, np.int64)
    for text in texts:
        text = f"  {text.lower()}  "
        for at in range(0, len(text) - 2, piece):
            part = table[np.frombuffer(text[at : at + piece + 2].encode("utf-32-le"), np.uint32)].astype(np.int32)
            counts += np.bincount((part[:-2] * SYMBOLS + part[1:-1]) * SYMBOLS + part[2:], minlength=SYMBOLS**3)
    return counts


def _joined(texts: list[str | None], limit: int = 1 << 20) -> Iterator[str]:
    """Short texts put together, two spaces between them, so that numpy works on long arrays."""
    held, size = [], 0
    for t in texts:
        held.append(t or "")
        size += len(held[-1])
        if size >= limit:
            yield "  ".join(held)
            held, size = [], 0
    if held:
        yield "  ".join(held)


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table, counts = _symbol_table(), np.zeros(SYMBOLS**3, np.int64)
    for batch in batches:
        counts += trigram_counts(_joined(batch["text"].to_pylist()), table)
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["gram", "n"])


def corpus_trigrams(docs: DataFrame) -> np.ndarray:
    """Trigram counts of all texts. What reaches the driver is at most one number per triple of symbols."""
    rows = docs.select("text").mapInArrow(_counting, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = np.zeros(SYMBOLS**3)
    for r in rows.collect():
        counts[r["gram"]] = r["n"]
    return counts


def _probabilities(counts: np.ndarray) -> np.ndarray:
    """Trigram, bigram and unigram shares, interpolated."""
    three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    two, one = three.sum(0), three.sum((0, 1)) + 1.0
    share = lambda n: (n + 1e-3) / (n + 1e-3).sum(-1, keepdims=True)
    return 0.8 * share(three) + 0.15 * share(two)[None] + 0.05 * (one / one.sum())[None, None]


def character_costs(corpus: np.ndarray, toxic: np.ndarray, toxic_share: float = TOXIC_SHARE) -> np.ndarray:
    """-log p(third | first two), for the mixture of all texts with those labelled toxic."""
    mixed = (1 - toxic_share) * _probabilities(corpus) + toxic_share * _probabilities(toxic)
    return -np.log(mixed)


class Decoder:
    """Finds the intended word behind an observed one."""

    def __init__(self, costs: np.ndarray):
        self.costs = costs.tolist()

    def _arcs(self, c: str, before: str | None) -> list[tuple[int | None, str, float]]:
        """(symbol, character, cost) of what may lie behind an observed character; None: nothing lies behind it."""
        arcs: list[tuple[int | None, str, float]] = [(SYMBOL.get(c, 1), c, 0.0)]
        arcs += [(SYMBOL[x], x, LEET_COST) for x in LEET.get(c, "")]
        if c == before:
            arcs.append((None, "", REPEAT_COST))
        if c in GAPS:
            arcs.append((None, "", GAP_COST))
        return arcs

    def decode(self, observed: str) -> str:
        """Viterbi over states of two intended characters."""
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}  # cost, and the path back
        before = None
        for c in observed:
            arcs, following = self._arcs(c, before), {}
            for (a, b), (cost, path) in best.items():
                row = self.costs[a][b]
                for symbol, character, extra in arcs:
                    state = (a, b) if symbol is None else (b, symbol)
                    total = cost + extra + (0.0 if symbol is None else row[symbol])
                    if state not in following or total < following[state][0]:
                        following[state] = (total, (path, character) if character else path)
            best, before = following, (before if c in GAPS else c)
        ends = [(cost + self.costs[a][b][0], path) for (a, b), (cost, path) in best.items()]
        least = min(cost for cost, _ in ends)
        return min(_spelled(path) for cost, path in ends if cost == least)

    def restored(self, word: str) -> str:
        """A word in lower case as it was meant; most words have a lattice of one path and return at once."""
        core = _STRIP_LEFT.sub("", word[: len(word) - _TAIL.match(word[::-1]).end()])
        return self.decode(core) if core and _HIDDEN.search(core) else core

    def words(self, text: str) -> set[str]:
        """Distinct observed words of a text, runs of single characters taken as one word as well."""
        low = text.lower()
        found = set(low.split())
        found.update(m[0] for m in _SPACED.finditer(low))
        return found


def _spelled(path: tuple | None) -> str:
    letters = []
    while path is not None:
        path, letter = path
        letters.append(letter)
    return "".join(reversed(letters))


# -- evidence -----------------------------------------------------------------------------------


def features(word: str) -> list[str]:
    """The word, its beginnings of 4 to 6 and its inner runs of 5 and 6 characters; ^ and $ mark its edges."""
    marked = f"^{word}$"
    return [marked] + [marked[:k] for k in (5, 6, 7) if len(word) >= k - 1] + [
        word[i : i + k] for k in (5, 6) for i in range(1, len(word) - k + 1)
    ]


class Evidence(NamedTuple):
    """Lower bounds of p(toxic | feature), the score of texts without any, and the character costs."""

    weights: dict[str, float]
    base: float
    costs: np.ndarray


def lower_bound(hits: int, total: int, z: float = 2.0) -> float:
    """The lower end of Wilson's interval of a share."""
    p = hits / total
    return (p + z * z / (2 * total) - z * math.sqrt(p * (1 - p) / total + z * z / (4 * total * total))) / (1 + z * z / total)


def surprise(hits: int, total: int, share: float) -> float:
    """Log-likelihood ratio of a feature's share of toxic texts against the overall share."""
    part = lambda n, of, q: n * math.log(n / (of * q)) if n else 0.0
    return 2 * (part(hits, total, share) + part(total - hits, total, 1 - share))


def chosen(counts: Iterable[tuple[str, int, int]], toxic: int, clean: int, tried: int, least: float = 0.5) -> dict[str, float]:
    """Features that mark toxic texts far beyond chance, given how many features were tried."""
    if not toxic or not clean:
        return {}
    share, bar = toxic / (toxic + clean), 2 * math.log(max(tried, 2)) + 10
    kept = {f: lower_bound(p, p + n) for f, p, n in counts if p > share * (p + n) and surprise(p, p + n, share) >= bar}
    return {f: w for f, w in kept.items() if w >= least}


def recounted(weights: dict[str, float], strongest: dict[tuple[str, int], int], least: float = 0.5) -> dict[str, float]:
    """Weights after a look at the texts, toxic (1) and clean (0), where a feature is the strongest of a word.

    A feature that is so in clean texts is worth its share there; others keep their weight.
    """
    out = {}
    for feature, weight in weights.items():
        toxic, clean = (strongest.get((feature, label), 0) for label in (1, 0))
        weight = min(weight, lower_bound(toxic, toxic + clean)) if clean else weight
        if weight >= least:
            out[feature] = weight
    return out


NOTHING = (0.0, 0, "")


class Scorer:
    """Scores texts: 1 - (1 - base) * product of (1 - evidence of each distinct restored word)."""

    def __init__(self, evidence: Evidence, remembered: int = 500_000):
        self.decoder, self.base = Decoder(evidence.costs), evidence.base
        self.automaton = ahocorasick.Automaton()
        for feature, weight in evidence.weights.items():
            self.automaton.add_word(feature, (weight, -len(feature), feature))
        if evidence.weights:
            self.automaton.make_automaton()
        self.any, self.known, self.remembered = bool(evidence.weights), {}, remembered

    def best(self, observed: str) -> tuple[float, int, str]:
        """The strongest feature of a word: (weight, minus its length, feature), of equal ones the shortest."""
        if observed not in self.known:
            if len(self.known) >= self.remembered:
                self.known.clear()
            marked = f"^{self.decoder.restored(observed)}$"
            self.known[observed] = max((x for _, x in self.automaton.iter(marked)), default=NOTHING) if self.any else NOTHING
        return self.known[observed]

    def word(self, observed: str) -> float:
        return self.best(observed)[0]

    def score(self, text: str | None) -> float:
        clean = 1 - self.base
        for word in sorted(self.decoder.words(text or "")):
            if weight := self.word(word):
                clean *= 1 - weight
        return 1 - clean


# -- jobs ---------------------------------------------------------------------------------------


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def training_rows(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(toxic, text) of at most `sample_rows` labelled documents that are not held out.

    The choice goes by a hash of doc_id, so it repeats. A document with several labels is toxic if one
    says so; null labels and null ids are left out. The chosen labels are few enough to broadcast.
    """
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
    sample = usable.groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    return stored(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "toxic", "text"), "toxicity-sample")


def _sketch(words: list[str]) -> int:
    """The least hash of three words in a row; near copies mostly agree on it."""
    h = np.array([hash_word(w) for w in words] or [0], np.uint64)
    if len(h) > 2:
        h = h[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ (h[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ h[2:]
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return int(h.min() >> np.uint64(1))


def hash_word(word: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word)


def _sketching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sketches = [_sketch((t or "").lower().split()) for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["toxic"], pa.array(sketches, pa.int64())], names=["doc_id", "toxic", "sketch"]
        )


def _feature_rows(costs, among) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(feature, texts that have it) of a task's texts; `among` limits it to the features given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder, wanted, counts = Decoder(costs.value), among and among.value, Counter()
        for batch in batches:
            for text in batch["text"].to_pylist():
                words = {decoder.restored(w) for w in decoder.words(text or "")}
                found = {f for w in words for f in features(w)}
                counts.update(found if wanted is None else found & wanted)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["feature", "n"]
        )

    return run


def _strongest_rows(handle) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(feature, toxic, n): texts in which the feature is the strongest of some word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, counts = Scorer(handle.value), Counter()
        for batch in batches:
            for toxic, text in zip(batch["toxic"].to_pylist(), batch["text"].to_pylist(), strict=True):
                counts.update((f, toxic) for f in {scorer.best(w)[2] for w in scorer.decoder.words(text or "")} if f)
        names, labels = zip(*counts, strict=True) if counts else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(labels, pa.int32()), pa.array(list(counts.values()), pa.int64())],
            names=["feature", "toxic", "n"],
        )

    return run


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Evidence:
    """The character model of all of `docs`, and evidence from the labelled sample.

    Of copies and near copies in the sample one counts, else every word of a text that was copied often
    would look like evidence. A part of a marked word, such as its middle, is found in unmarked words
    too and owes its share to the whole word; so features are counted again where they are the strongest
    of a word, and judged by that. The features that reach the driver are those of at most
    `sample_rows` texts that occur in several toxic ones.
    """
    spark = docs.sparkSession
    sample = training_rows(docs, labels, sample_rows)
    toxic = corpus_trigrams(sample.where("toxic = 1"))
    costs = character_costs(corpus_trigrams(docs), toxic)
    ones = sample.mapInArrow(_sketching, "doc_id long, toxic int, sketch long").groupBy("sketch", "toxic").agg(F.min("doc_id").alias("doc_id"))
    distinct = stored(sample.join(F.broadcast(ones.select("doc_id")), "doc_id").select("toxic", "text"), "toxicity-train")
    sizes = {r["toxic"]: r["count"] for r in distinct.groupBy("toxic").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)

    def having(label: int, among=None) -> DataFrame:
        rows = distinct.where(F.col("toxic") == label).repartition(max(1, spark.sparkContext.defaultParallelism * 2))
        counted = rows.mapInArrow(_feature_rows(handle, among), "feature string, n long")
        return counted.groupBy("feature").agg(F.sum("n").alias("n"))

    handle = spark.sparkContext.broadcast(costs)
    in_toxic = stored(having(1), "toxicity-features")
    candidates = {r["feature"]: r["n"] for r in in_toxic.where(F.col("n") >= LEAST_TEXTS).collect()}
    in_clean = {r["feature"]: r["n"] for r in having(0, spark.sparkContext.broadcast(set(candidates))).collect()}
    tried = in_toxic.count()
    weights = chosen(((f, n, in_clean.get(f, 0)) for f, n in candidates.items()), n_toxic, n_clean, tried)
    for _ in range(RECOUNTS if weights else 0):
        strongest = spark.sparkContext.broadcast(Evidence(weights, 0.0, costs))
        rows = distinct.repartition(max(1, spark.sparkContext.defaultParallelism * 2))
        made = rows.mapInArrow(_strongest_rows(strongest), "feature string, toxic int, n long")
        again = {(r["feature"], r["toxic"]): r["n"] for r in made.groupBy("feature", "toxic").agg(F.sum("n").alias("n")).collect()}
        judged = recounted(weights, again)
        if judged == weights:
            break
        weights = judged
    evidence = Evidence(weights, 0.0, costs)
    unmarked = scores(distinct.withColumn("doc_id", F.lit(0)), evidence, keep=("toxic",)).where("score = 0")
    left = unmarked.agg(F.count("*").alias("n"), F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")).first()
    base = min(0.4, ((left["toxic"] or 0) + 0.5) / (left["n"] + 1)) if n_toxic else 0.0
    return Evidence(weights, base, costs)


def _scoring(handle, kept: tuple[str, ...], output: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(handle.value)
        for batch in batches:
            score = pa.array([scorer.score(t) for t in batch["text"].to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), score], names=[*kept, output])

    return run


def scores(docs: DataFrame, evidence: Evidence, keep: tuple[str, ...] = ("doc_id",), output: str = "score") -> DataFrame:
    """The columns `keep` of `docs` with a score; one scan, nothing is shuffled."""
    handle = docs.sparkSession.sparkContext.broadcast(evidence)
    read = docs.select(*keep, *([] if "text" in keep else ["text"]))
    schema = T.StructType([*docs.select(*keep).schema, T.StructField(output, T.DoubleType())])
    return read.mapInArrow(_scoring(handle, keep, output), schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, in the contract's form.

    Null and empty texts get the base score, that of texts without any evidence. Without toxic labels
    every score is 0. Repeated rows are scored each; an empty table gives none.
    """
    scored = scores(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select(
        "doc_id", F.coalesce(is_held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not predicted toxic, with their columns."""
    (score,) = unused(docs, "score")
    return scores(docs, fit(docs, labels), tuple(docs.columns), score).where(F.col(score) < threshold).drop(score)

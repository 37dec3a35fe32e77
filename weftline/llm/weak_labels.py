"""Document classifier without hand labels: labellers, expectation-maximisation, hashed scorer.

Simple labellers vote good, bad or nothing on two questions, form (is it prose?) and harm (is
it abusive?). For each question expectation-maximisation over the counted vote patterns of all
documents estimates how often each labeller is right on good and on bad ones, and the share of
bad ones; only the counted patterns, 3 to the number of labellers at most, reach the driver. A
document's label is the probability that it is bad in neither respect. A linear scorer on
hashed words and shapes learns these labels and scores all documents.

Abuse is also looked up in a word list learned from labelled rows, if there are any: from
``LABEL_ROWS`` of them at most, those with the smallest hashes of their id, the words that occur
in many abusive documents and hardly in others, ``LIST_WORDS`` at most, dealt to two labellers.

The scorer is fitted on ``SAMPLE_ROWS`` documents at most, those with the smallest hashes of id
and text; everything else covers all documents. It is trained in ``PARTS`` parts whose weights
are averaged, so no task holds the sample.

A null or blank text gets no votes on form, counts as not harmful, and is scored by its shape
like any other. Null ids are kept. Repeated rows come out as often. An empty table gives an
empty result. Further columns are not looked at; ``keep_good`` passes all columns on.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import in_small_batches
from weftline.session import cut_lineage

SAMPLE_ROWS = 20_000
PARTS = 8
ROUNDS = 3
EPOCHS = 4
BITS = 18
KEEP_FROM = 0.5
#: Labelled rows that the word list is learned from, words in it, and what a word must show:
#: documents and share of the abusive ones it occurs in, and how much rarer it is elsewhere.
LABEL_ROWS = 20_000
LIST_WORDS = 2_000
LIST_DOCS = 2
LIST_SHARE = 0.005
LIST_RATIO = 0.02

#: Words of abuse, in two lists for two labellers.
INSULTS = (
    (b"idiot", b"moron", b"stupid", b"loser", b"clown"),
    (b"trash", b"scum", b"pathetic", b"worthless", b"disgusting"),
)
#: Characters that prose seldom holds.
SYMBOLS = b"#%&*$|~^<>{}[]\\=_@+"

BAD, GOOD, NONE = 0, 1, 2
QUESTIONS = {"form": ("surface", "odd_words", "plain", "variety", "repeats"), "harm": ("list_a", "list_b", "list_c", "list_d", "several")}
_UPPER = bytes(range(65, 91))
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
_STRIP = b".,;:!?\"'()-*#$%&|/"
_MARKS = (b"!!", b"##", b"%%", b"&&", b"**", b"$$")


#: Four lists: the two fixed ones, and the halves of the learned one.
Lists = tuple[frozenset[bytes], ...]
FIXED_LISTS: Lists = (*(frozenset(words) for words in INSULTS), frozenset(), frozenset())


def plain_words(text: str | None) -> list[bytes]:
    """Words in lower case without marks at their ends."""
    return [w.strip(_STRIP) for w in (text or "").lower().encode("utf-8", "surrogatepass").split()]


def shape_of(text: str | None, lists: Lists = FIXED_LISTS) -> tuple[list[bytes], dict[str, float]]:
    """Plain words of a text, and its measures."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    tokens, words = raw.split(), plain_words(text)
    n = max(1, len(tokens))
    size = max(1, len(raw))
    letters = len(raw) - len(raw.translate(None, _LETTERS))
    known = set(words)
    hits = {f"list_{name}": sum(1 for w in words if w in own) if own & known else 0 for name, own in zip("abcd", lists)}
    same = sum([a == b for a, b in zip(words, words[1:])]) / n
    lone = sum([not w for w in words]) / n
    marks = sum([t.endswith(_MARKS) for t in tokens]) / n
    return words, hits | {
        "n": len(tokens),
        "symbols": (len(raw) - len(raw.translate(None, SYMBOLS))) / size,
        "capitals": (len(raw) - len(raw.translate(None, _UPPER))) / max(1, letters),
        "letters": letters / size,
        "same": same,
        "lone": lone,
        "marks": marks,
        "variety": len(known) / n,
    }


def _vote(value: float, good_to: float, bad_from: float) -> int:
    return BAD if value >= bad_from else GOOD if value <= good_to else NONE


def votes_of(m: dict[str, float]) -> dict[str, list[int]]:
    """Votes of the labellers of each question. Labellers of one question look at overlapping signs."""
    hits = m["list_a"] + m["list_b"] + m["list_c"] + m["list_d"]
    long_enough = m["n"] >= 30
    form = [
        # Characters: symbols and capitals. Words: marks, lone marks, repeated words. And so on.
        max(_vote(m["symbols"], 0.01, 0.03), _vote(m["capitals"], 0.3, 0.5), key=(GOOD, NONE, BAD).index),
        _vote(m["marks"] + m["lone"] + m["same"], 0.1, 0.2),
        _vote(m["marks"] + m["lone"] + max(0.0, m["capitals"] - 0.3) + m["symbols"], 0.05, 0.15),
        NONE if not long_enough else GOOD if m["variety"] >= 0.4 else BAD if m["variety"] <= 0.25 else NONE,
        max(_vote(m["same"], 0.1, 0.2), NONE if not long_enough else _vote(1 - m["variety"] + m["lone"], 0.65, 0.75), key=(GOOD, NONE, BAD).index),
    ]
    lists = [BAD if m[f"list_{x}"] else GOOD for x in "abcd"]
    return {
        "form": form if m["n"] else [NONE] * len(form),
        "harm": [*lists, BAD if hits >= 2 else NONE if hits else GOOD],
    }


def _pattern(votes: list[int]) -> int:
    code = 0
    for v in votes:
        code = code * 3 + v
    return code


def features_of(words: list[bytes], m: dict[str, float]) -> np.ndarray:
    """Hashed places of the distinct words and of the shape."""
    found = [crc32(w) & ((1 << BITS) - 1) for w in set(words)]
    shape = [f"{k}={min(20, round(m[k] * 20))}" for k in ("symbols", "capitals", "same", "lone", "marks", "variety")]
    shape += [f"{k}={min(3, int(m[k]))}" for k in ("list_a", "list_b", "list_c", "list_d")] + [f"size={int(math.log2(m['n'] + 1))}"]
    # The shape is said several times over, or a long text's words would drown it.
    found += [crc32(s.encode()) & ((1 << BITS) - 1) for s in shape for _ in range(4)]
    return np.array(found, np.int32)


def _weight(places: np.ndarray) -> float:
    return 4.0 / math.sqrt(len(places))


def fit_labellers(counts: dict[int, int], labellers: int, rounds: int = 50) -> tuple[float, np.ndarray]:
    """(share of bad ones, chance of each vote given the class) by expectation-maximisation.

    ``counts``: pattern of votes to number of documents. Votes are taken as independent given
    the class; no vote says nothing. Labellers start out as right in nine of ten cases.
    """
    patterns = np.array(list(counts), np.int64)
    weights = np.array(list(counts.values()), float)
    votes = np.stack([patterns // 3 ** (labellers - 1 - j) % 3 for j in range(labellers)], axis=1)
    chance = np.zeros((2, labellers, 3))
    chance[BAD, :, BAD], chance[BAD, :, GOOD] = 0.9, 0.1
    chance[GOOD, :, GOOD], chance[GOOD, :, BAD] = 0.9, 0.1
    chance[:, :, NONE] = 1.0
    bad = 0.2
    for _ in range(rounds):
        post = posterior(votes, bad, chance)
        for cls, own in ((BAD, post * weights), (GOOD, (1 - post) * weights)):
            for v in (BAD, GOOD):
                mass = ((votes == v) * own[:, None]).sum(axis=0)
                given = ((votes != NONE) * own[:, None]).sum(axis=0)
                # A prior of ten documents at the starting chances keeps rates off zero and one.
                start = 0.9 if cls == v else 0.1
                chance[cls, :, v] = (mass + 10 * start) / (given + 10)
        bad = float(((post * weights).sum() + 1) / (weights.sum() + 5))
    return bad, chance


def posterior(votes: np.ndarray, bad: float, chance: np.ndarray) -> np.ndarray:
    """Probability of bad for each row of votes."""
    odds = math.log(bad / (1 - bad)) + sum(
        np.log(chance[BAD, j, votes[:, j]]) - np.log(chance[GOOD, j, votes[:, j]]) for j in range(votes.shape[1])
    )
    return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def learned_lists(docs: DataFrame, labels: DataFrame) -> Lists:
    """The fixed lists and one learned from ``labels`` (doc_id, toxic)."""
    rows = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("_id"))
    sample = rows.agg(F.max("toxic").alias("_toxic")).orderBy(F.xxhash64("_id")).limit(LABEL_ROWS)
    # Two numbers a row and a fixed number of rows: the broadcast has a bound.
    texts = docs.select(F.col("doc_id").cast("bigint").alias("_id"), F.col("text").cast("string").alias("_text"))
    known = texts.join(F.broadcast(sample), "_id").dropDuplicates(["_id"]).select("_text", (F.col("_toxic") == 1).alias("_toxic"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[bytes, list[int]] = {b"": [0, 0]}
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                for word in {b"", *plain_words(text.as_py())}:
                    seen.setdefault(word, [0, 0])[toxic] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()), pa.array([n[1] for n in seen.values()], pa.int64()), pa.array([n[0] for n in seen.values()], pa.int64())],
                ["word", "toxic", "other"],
            )

    counted = cut_lineage(known.mapInArrow(run, "word binary, toxic bigint, other bigint").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")))
    # Every document holds the empty word, so its row has the totals.
    total = counted.where(F.octet_length("word") == 0).first()
    if total is None or not total["toxic"] or not total["other"]:
        return FIXED_LISTS
    often = (F.col("toxic") >= LIST_DOCS) & (F.col("toxic") >= LIST_SHARE * total["toxic"])
    rarer = F.col("other") / total["other"] <= LIST_RATIO * F.col("toxic") / total["toxic"]
    found = counted.where((F.octet_length("word") > 0) & often & rarer).orderBy(F.desc("toxic"), "word").limit(LIST_WORDS).collect()
    words = [bytes(r["word"]) for r in found]
    return (*FIXED_LISTS[:2], frozenset(w for w in words if crc32(w) % 2), frozenset(w for w in words if not crc32(w) % 2))


def label_model(docs: DataFrame, lists: Lists = FIXED_LISTS) -> dict[str, tuple[float, np.ndarray]]:
    """Fitted labellers of each question, from the votes on all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, int], int] = {}
        for batch in batches:
            for text in batch.column(0):
                for question, votes in votes_of(shape_of(text.as_py(), lists)[1]).items():
                    key = (question, _pattern(votes))
                    seen[key] = seen.get(key, 0) + 1
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in seen]), pa.array([k[1] for k in seen], pa.int64()), pa.array(list(seen.values()), pa.int64())],
                ["question", "pattern", "n"],
            )

    found = in_small_batches(docs).select(F.col("text").cast("string")).mapInArrow(run, "question string, pattern bigint, n bigint")
    rows = found.groupBy("question", "pattern").agg(F.sum("n").alias("n")).collect()
    counts: dict[str, dict[int, int]] = {q: {} for q in QUESTIONS}
    for r in rows:
        counts[r["question"]][r["pattern"]] = r["n"]
    return {q: fit_labellers(c, len(QUESTIONS[q])) for q, c in counts.items() if c}


def _target(m: dict[str, float], model: dict[str, tuple[float, np.ndarray]]) -> float:
    keep = 1.0
    for question, votes in votes_of(m).items():
        keep *= 1 - float(posterior(np.array([votes]), *model[question])[0])
    return keep


def _sgd(weights: np.ndarray, rows: list[tuple[np.ndarray, float]], epochs: int, seed: int) -> np.ndarray:
    """Logistic regression on soft labels; the last place is the bias."""
    weights = weights.copy()
    order = np.random.default_rng(seed)
    for epoch in range(epochs):
        rate = 0.5 / (1 + epoch)
        for i in order.permutation(len(rows)):
            places, target = rows[i]
            scale = _weight(places)
            score = weights[places].sum() * scale + weights[-1]
            step = rate * (target - 1 / (1 + math.exp(-max(-50.0, min(50.0, score)))))
            np.add.at(weights, places, step * scale)
            weights[-1] += step
    return weights


def _trainer(start: bytes, turn: int):
    def train(table: pa.Table) -> pa.Table:
        table = table.sort_by("order")
        rows = [(np.asarray(p.values), t.as_py()) for p, t in zip(table.column("places"), table.column("target"))]
        own = _sgd(np.frombuffer(start, "<f8"), rows, EPOCHS, turn)
        return pa.table({"rows": pa.array([len(rows)], pa.int64()), "weights": pa.array([own.astype("<f4").tobytes()], pa.binary())})

    return train


def fit_scorer(docs: DataFrame, model: dict[str, tuple[float, np.ndarray]], lists: Lists = FIXED_LISTS, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Weights of the hashed linear scorer, an array of fixed size."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, targets = [], []
            for text in batch.column(1):
                words, m = shape_of(text.as_py(), lists)
                places.append(features_of(words, m))
                targets.append(_target(m, model))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(places, pa.list_(pa.int32())), pa.array(targets)], ["order", "places", "target"])

    keyed = docs.select(F.xxhash64("doc_id", "text").alias("order"), F.col("text").cast("string").alias("text"))
    # The bound of the sample as a hash: first the order's threshold, then the texts under it.
    orders = keyed.select("order").orderBy("order").limit(sample_rows)
    limit = orders.agg(F.max("order")).first()[0]
    chosen = keyed.where(F.col("order") <= F.lit(limit)) if limit is not None else keyed
    sample = cut_lineage(chosen.select("order", "text").mapInArrow(features, "order bigint, places array<int>, target double"))
    weights = np.zeros((1 << BITS) + 1)
    for turn in range(ROUNDS):
        parts = sample.groupBy(F.pmod("order", F.lit(PARTS)).alias("part")).applyInArrow(_trainer(weights.astype("<f8").tobytes(), turn), "rows bigint, weights binary").collect()
        total = sum(p["rows"] for p in parts)
        if not total:
            break
        weights = sum(np.frombuffer(p["weights"], "<f4").astype(float) * p["rows"] for p in sorted(parts, key=lambda p: bytes(p["weights"][-8:]))) / total
    return weights.astype("<f4")


def _fitted_judge(docs: DataFrame, labels: DataFrame | None, sample_rows: int):
    """What scores one text, fitted on ``docs``; None for an empty table."""
    lists = learned_lists(docs, labels) if labels is not None else FIXED_LISTS
    model = label_model(docs, lists)
    if not model:
        return None
    # An array of fixed size.
    weights = docs.sparkSession.sparkContext.broadcast(fit_scorer(docs, model, lists, sample_rows).tobytes())

    def judge(text: str | None) -> tuple[float, float]:
        own = np.frombuffer(weights.value, "<f4")
        words, m = shape_of(text, lists)
        places = features_of(words, m)
        score = float(own[places].sum(dtype=np.float64) * _weight(places) + own[-1])
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, score)))), _target(m, model)

    return judge


def score_documents(docs: DataFrame, labels: DataFrame | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, score, weak_label, keep): chance of a good document by the scorer, and by the labellers."""
    judge = _fitted_judge(docs, labels, sample_rows)
    schema = "doc_id bigint, score double, weak_label double, keep boolean"
    if judge is None:
        return docs.sparkSession.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [judge(t.as_py()) for t in batch.column(1)]
            columns = [[s for s, _ in found], [w for _, w in found], [s >= KEEP_FROM for s, _ in found]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], ["doc_id", "score", "weak_label", "keep"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` whose text the scorer accepts, as they are."""
    judge = _fitted_judge(docs, labels, sample_rows)
    if judge is None:
        return docs

    # Only texts go to Python, only flags come back; rows stay as they are.
    @F.arrow_udf("boolean")
    def accepted(texts: pa.Array) -> pa.Array:
        return pa.array([judge(t.as_py())[0] >= KEEP_FROM for t in texts], pa.bool_())

    return docs.where(accepted(F.col("text").cast("string")))

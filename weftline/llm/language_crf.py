"""Languages of words in code-switched text by a linear-chain conditional random field.

Labels are the languages that training documents name. A word's features are its n-grams and
affixes with the word's ends marked, hashed into a table of weights, and the language in whose
lexicon it stands. Learned transitions say how likely a language follows another. The forward and
backward passes give each word the probability of every language; a document's language is the
one with the most probability over its words that have letters, its score the mean of that
probability.

Training takes a bounded sample: about ``SAMPLE_DOCS`` documents of each language, chosen by a
hash, of each at most ``SAMPLE_PIECES`` pieces of ``PIECE_WORDS`` words from anywhere in the text,
``SAMPLE_ROWS`` pieces in all. Sequences are made of pieces in the order of their hashes, so they
switch between languages and the transitions are learned from switches too. The ``LANGUAGES`` most
frequent languages are learned. Every word of every document is labelled, in sequences of up to
``SEQUENCE_WORDS`` words of one document.

Training rows are those with a language and a crc32 of the id, modulo ``FOLDS``, other than
``HELD_OUT``; nothing but text is an input of a prediction. A text that is null or has no letter
is ``und`` with score 0, and so are all if no language was learned. A null id hashes as an empty
one, repeated rows have equal results, ties go to the language first by name. An empty table
gives no rows. ``doc_id``, ``text`` and ``lang`` are read; further columns are not looked at.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import mixed

FOLDS, HELD_OUT = 4, 2
UNDETERMINED = "und"
SAMPLE_DOCS = 200
SAMPLE_PIECES = 6
PIECE_WORDS = 40
SAMPLE_ROWS = 20_000
LANGUAGES = 200
SEQUENCE_WORDS = 128
#: Bits of the table of weights.
BITS = 16
#: A word is in the lexicon of a language if the sample has it so often, so much of it in that language.
LEXICON_LEAST, LEXICON_SHARE = 4, 0.8
EPOCHS, SEQUENCES, RATE, DECAY = 5, 32, 0.25, 1e-6
#: Pieces of one training sequence.
JOINED = 3
BATCH_BYTES = 8 << 20
#: Cells of emissions that are held at once.
_CELLS = 8 << 20

# Code points that stand for a word's ends; letters have others.
_START, _END = 1, 2


def is_held_out() -> Column:
    number = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return number % FOLDS == HELD_OUT


def letters_of(word: bytes) -> str:
    """Letters of a word in lower case."""
    text = word.decode("utf-8", "replace").lower()
    return text if text.isalpha() else "".join(filter(str.isalpha, text))


def _hashed(codes: np.ndarray, at: np.ndarray, n: int, kind: int) -> np.ndarray:
    h = np.full(len(at), 0x51ED + 8 * n + kind, np.uint64)
    for j in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + codes[at + j]
    return h


def _features(forms: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(owner, slot) of all features of ``forms``, by owner; a form without letters has none."""
    raw = "".join([chr(_START) + f + chr(_END) for f in forms]).encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(raw, np.uint32).astype(np.uint64)
    first = np.flatnonzero(codes == _START)
    last = np.flatnonzero(codes == _END)
    size = last - first + 1
    owner = np.repeat(np.arange(len(forms)), size)
    number = np.arange(len(codes)) - first[owner]
    left = size[owner] - number
    parts = []
    for n in (2, 3):
        at = np.flatnonzero((left >= n) & (size[owner] > 2))
        parts.append((owner[at], _hashed(codes, at, n, 0)))
    whole = np.flatnonzero(size >= 5)
    # Longer affixes: three letters at the start, three and four at the end.
    parts.append((whole, _hashed(codes, first[whole], 4, 1)))
    parts.append((whole, _hashed(codes, last[whole] - 3, 4, 2)))
    whole = np.flatnonzero(size >= 6)
    parts.append((whole, _hashed(codes, last[whole] - 4, 5, 2)))
    owners = np.concatenate([o for o, _ in parts])
    slots = (mixed(np.concatenate([h for _, h in parts])) >> np.uint64(64 - BITS)).astype(np.int64)
    order = np.argsort(owners, kind="stable")
    return owners[order], slots[order]


def _form_hash(forms: list[str]) -> np.ndarray:
    """A 64-bit hash of each whole form."""
    raw = "".join([f + chr(_END) for f in forms]).encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(raw, np.uint32).astype(np.uint64)
    ends = np.flatnonzero(codes == _END)
    starts = np.concatenate(([0], ends[:-1] + 1)).astype(np.int64)
    number = np.arange(len(codes)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat(mixed(codes + mixed(number.astype(np.uint64) + np.uint64(1))), starts) if len(forms) else np.zeros(0, np.uint64)


@dataclass
class Model:
    """Weights by slot and language, transition scores, and the lexicon: hashes of forms and their languages."""

    languages: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    known: np.ndarray
    known_language: np.ndarray
    lexicon: np.ndarray

    def in_lexicon(self, forms: list[str]) -> np.ndarray:
        """The language in whose lexicon each form stands, or -1."""
        if not len(self.known):
            return np.full(len(forms), -1)
        hashes = _form_hash(forms)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, self.known_language[at], -1)

    def emissions(self, forms: list[str]) -> np.ndarray:
        """A score of each language for each form."""
        scores = np.zeros((len(forms), len(self.languages)), np.float32)
        owner, slot = _features(forms)
        if len(owner):
            heads = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            scores[owner[heads]] = np.add.reduceat(self.weights[slot], heads, axis=0)
        found = self.in_lexicon(forms)
        at = np.flatnonzero(found >= 0)
        scores[at] += self.lexicon[found[at]]
        return scores


def forward_backward(scores: np.ndarray, sizes: np.ndarray, transitions: np.ndarray, pairs: bool = False):
    """Marginal probabilities of (sequence, word, language), and if asked the expected transitions in all.

    ``scores`` is padded; words of a sequence beyond its size have zero probability.
    """
    count, length, kinds = scores.shape
    step = np.exp(transitions - transitions.max())
    inside = np.arange(length) < sizes[:, None]
    local = np.exp(scores - scores.max(axis=2, keepdims=True)) * inside[:, :, None]
    forward = np.zeros_like(local)
    backward = np.zeros_like(local)
    forward[:, 0] = local[:, 0] / np.maximum(local[:, 0].sum(axis=1, keepdims=True), 1e-30)
    for t in range(1, length):
        now = (forward[:, t - 1] @ step) * local[:, t]
        forward[:, t] = now / np.maximum(now.sum(axis=1, keepdims=True), 1e-30)
    at_end = np.zeros((count, kinds), local.dtype)
    for t in range(length - 1, -1, -1):
        own = (at_end * local[:, t + 1]) @ step.T if t + 1 < length else at_end
        own = np.where((sizes == t + 1)[:, None], 1.0, own)
        at_end = backward[:, t] = own / np.maximum(own.sum(axis=1, keepdims=True), 1e-30)
    marginal = forward * backward
    marginal /= np.maximum(marginal.sum(axis=2, keepdims=True), 1e-30)
    if not pairs:
        return marginal
    expected = np.zeros((kinds, kinds))
    for t in range(length - 1):
        both = forward[:, t, :, None] * step * (local[:, t + 1] * backward[:, t + 1])[:, None, :]
        total = both.sum(axis=(1, 2), keepdims=True)
        expected += (both / np.where(total > 0, total, 1)).sum(axis=0)
    return marginal, expected


def _padded(values: np.ndarray, sizes: np.ndarray, fill: int) -> np.ndarray:
    """Rows of ``sizes`` values each, filled up to the longest."""
    out = np.full((len(sizes), int(sizes.max())), fill, values.dtype)
    out[np.arange(out.shape[1]) < sizes[:, None]] = values
    return out


def train(pieces: list[tuple[int, str, str]]) -> Model | None:
    """Fit a model to (hash, language, text) pieces."""
    pieces = sorted(p for p in pieces if p[2])
    languages = sorted({p[1] for p in pieces})
    if not languages:
        return None
    kinds = len(languages)
    code = {name: k for k, name in enumerate(languages)}
    numbers: dict[str, int] = {}
    words = [[numbers.setdefault(f, len(numbers)) for f in map(letters_of, text.encode("utf-8", "replace").split())] for _, _, text in pieces]
    labels = [np.full(len(w), code[p[1]]) for w, p in zip(words, pieces)]
    forms = list(numbers)
    flat, gold = np.concatenate([np.array(w, np.int64) for w in words]), np.concatenate(labels)
    counts = np.zeros((len(forms), kinds))
    np.add.at(counts, (flat, gold), 1)
    total = counts.sum(axis=1)
    often = np.flatnonzero((total >= LEXICON_LEAST) & (counts.max(axis=1) >= LEXICON_SHARE * total) & np.array([f != "" for f in forms], bool))
    hashes = _form_hash(forms)[often]
    order = np.argsort(hashes)
    model = Model(
        languages, np.zeros((1 << BITS, kinds), np.float32), np.zeros((kinds, kinds)),
        hashes[order], counts[often].argmax(axis=1)[order], np.zeros((kinds, kinds), np.float32),
    )
    if kinds == 1:
        return model
    owner, slot = _features(forms)
    begins = np.searchsorted(owner, np.arange(len(forms) + 1))
    standing = model.in_lexicon(forms)
    sums = [np.full(a.shape, 1e-3) for a in (model.weights, model.transitions, model.lexicon)]
    groups = [range(i, min(i + JOINED, len(pieces))) for i in range(0, len(pieces), JOINED)]
    sequences = [(np.concatenate([words[i] for i in g]).astype(np.int64), np.concatenate([labels[i] for i in g])) for g in groups]
    rng = np.random.default_rng(1)

    def climb(which: int, target: np.ndarray, rows, gradient: np.ndarray) -> None:
        sums[which][rows] += gradient**2
        target[rows] -= (RATE * gradient / np.sqrt(sums[which][rows])).astype(target.dtype)

    for _ in range(EPOCHS):
        turn = rng.permutation(len(sequences))
        for i in range(0, len(turn), SEQUENCES):
            some = [sequences[k] for k in turn[i : i + SEQUENCES]]
            sizes = np.array([len(w) for w, _ in some])
            ids, place = np.unique(np.concatenate([w for w, _ in some]), return_inverse=True)
            known = np.concatenate([y for _, y in some])
            # The features of the forms at hand.
            many = begins[ids + 1] - begins[ids]
            whose = np.repeat(np.arange(len(ids)), many)
            own = slot[np.arange(len(whose)) + np.repeat(begins[ids] - (np.cumsum(many) - many), many)]
            scores = np.stack([np.bincount(whose, model.weights[own, k], len(ids)) for k in range(kinds)], axis=1)
            at = np.flatnonzero(standing[ids] >= 0)
            scores[at] += model.lexicon[standing[ids[at]]]
            table = scores[_padded(place, sizes, 0)]
            marginal, expected = forward_backward(table, sizes, model.transitions, pairs=True)
            error = marginal[np.arange(marginal.shape[1]) < sizes[:, None]]
            error[np.arange(len(known)), known] -= 1
            by_form = np.stack([np.bincount(place, error[:, k], len(ids)) for k in range(kinds)], axis=1) / len(some)
            used, back = np.unique(own, return_inverse=True)
            slopes = np.stack([np.bincount(back, by_form[whose, k], len(used)) for k in range(kinds)], axis=1)
            climb(0, model.weights, used, slopes + DECAY * model.weights[used])
            seen = np.zeros((kinds, kinds))
            for _, y in some:
                np.add.at(seen, (y[:-1], y[1:]), 1)
            climb(1, model.transitions, slice(None), (expected - seen) / len(some) + DECAY * model.transitions)
            slopes = np.zeros((kinds, kinds))
            np.add.at(slopes, standing[ids[at]], by_form[at])
            climb(2, model.lexicon, slice(None), slopes + DECAY * model.lexicon)
    return model


def _sample_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Some pieces of each text, those with the smallest hashes."""
    for batch in batches:
        rows = []
        for h, lang, text in zip(*(c.to_pylist() for c in batch.columns)):
            words = text.encode("utf-8", "replace").split()
            starts = np.arange(0, len(words), PIECE_WORDS)
            order = mixed(np.uint64(h % (1 << 64)) + mixed(starts.astype(np.uint64)))
            for at in np.argsort(order, kind="stable")[:SAMPLE_PIECES].tolist():
                piece = b" ".join(words[starts[at] : starts[at] + PIECE_WORDS]).decode("utf-8", "replace")
                rows.append((int(order[at] >> np.uint64(1)), lang, piece))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows])], ["h", "lang", "text"])


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pieces = [row for b in batches for row in zip(*(c.to_pylist() for c in b.columns))]
    if pieces:
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(pieces))])], ["model"])


def fit(docs: DataFrame) -> Model | None:
    """A model from the labelled rows of ``docs`` that are not held out; None if there are none."""
    rows = docs.where(F.col("lang").isNotNull() & ~is_held_out()).select(F.col("doc_id").cast("string").alias("doc_id"), "text", "lang")
    many = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    if not many:
        return None
    # A hash below its language's share of the range picks about SAMPLE_DOCS rows of each.
    rates = {r["lang"]: min(1.0, SAMPLE_DOCS / r["n"]) for r in many}
    share = F.element_at(F.create_map(*[x for k, v in rates.items() for x in (F.lit(k), F.lit(v))]), F.col("lang"))
    h = F.xxhash64("doc_id", "text")
    chosen = rows.where(F.col("text").isNotNull()).where((F.pmod(h, F.lit(1 << 30)) / float(1 << 30)) < share)
    pieces = chosen.select(h.alias("h"), "lang", "text").mapInArrow(_sample_pieces, "h bigint, lang string, text string")
    found = pieces.orderBy("h", "lang", "text").limit(SAMPLE_ROWS).mapInArrow(_trained, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else None


def _word_probabilities(model: Model, words: np.ndarray, scores: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Probabilities of the languages of each word, in sequences of one document each."""
    kinds = len(model.languages)
    out = np.zeros((len(words), kinds), np.float32)
    # Documents cut into sequences, which are handled from the longest to the shortest.
    per = -(-sizes // SEQUENCE_WORDS)
    number = np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per)
    begins = np.repeat(np.cumsum(sizes) - sizes, per) + number * SEQUENCE_WORDS
    own = np.minimum(SEQUENCE_WORDS, np.repeat(sizes, per) - number * SEQUENCE_WORDS)
    order = np.argsort(-own, kind="stable")
    block = max(1, _CELLS // (SEQUENCE_WORDS * kinds))
    for i in range(0, len(order), block):
        some = order[i : i + block]
        length = own[some]
        at = begins[some][:, None] + np.minimum(np.arange(int(length[0])), length[:, None] - 1)
        inside = np.arange(int(length[0])) < length[:, None]
        marginal = forward_backward(scores[words[at]], length, model.transitions.astype(np.float32))
        out[at[inside]] = marginal[inside]
    return out


def _labelled(model: Model | None, batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in batch.column("text").to_pylist()]
    sizes = np.array([len(t) for t in texts], np.int64)
    coded = pa.array([w for t in texts for w in t], pa.binary()).dictionary_encode()
    forms = [letters_of(w) for w in coded.dictionary.to_pylist()]
    words = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    lettered = np.array([f != "" for f in forms], bool)[words] if len(words) else np.zeros(0, bool)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    spans: list[list[dict]] = [[] for _ in texts]
    langs, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    if model is not None and lettered.any():
        p = _word_probabilities(model, words, model.emissions(forms), sizes)
        sums = np.stack([np.bincount(doc, p[:, k] * lettered, len(sizes)) for k in range(p.shape[1])], axis=1)
        many = np.bincount(doc, lettered, len(sizes))
        best = sums.argmax(axis=1)
        for i in np.flatnonzero(many).tolist():
            langs[i] = model.languages[best[i]]
            scores[i] = min(1.0, float(sums[i, best[i]] / many[i]))
        own = p.argmax(axis=1)
        begins = np.cumsum(sizes) - sizes
        cuts = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (doc[1:] != doc[:-1]), [True])))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            spans[doc[a]].append({"start": a - int(begins[doc[a]]), "words": b - a, "lang": model.languages[own[a]]})
    kind = pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64()), ("lang", pa.string())]))
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores), pa.array(sizes), pa.array(spans, kind)],
        ["doc_id", "held_out", "lang_pred", "score", "n_words", "spans"],
    )


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, n_words, spans) of every row of ``docs``.

    ``spans`` are the stretches of words, numbered from 0, whose most probable language is one.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            group = (np.cumsum(sizes) - sizes) // BATCH_BYTES
            cuts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True]))) if len(sizes) else [0]
            for a, b in zip(cuts[:-1], cuts[1:]):
                yield _labelled(sent.value, batch.slice(int(a), int(b - a)))

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", is_held_out().alias("held_out"))
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double, n_words bigint, spans array<struct<start:bigint,words:bigint,lang:string>>")


def predict_languages(docs: DataFrame) -> DataFrame:
    """Fit on the rows that are not held out, then predict every row."""
    return predict(docs, fit(docs))

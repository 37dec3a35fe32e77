"""BPE encoding and decoding of whole texts through a prefix tree of distinct words.

The encoding of a prefix is the encoding of a shorter prefix plus one last token, so a prefix's
state is that token and where it starts. The distinct words of a piece of the table are walked
depth first, in sorted order: the path shared with the word before keeps its states, and each
new character adds one. A last token is right if it and the token before it would not have been
merged otherwise, which only the merges along their common border decide.

Words come from the tokenizer file's own pattern. Texts with characters beyond Latin-1, or with
strings of special tokens, are normalised and split by the library; for the others lower case
is all that its normalisation does. Rows stay where they are: there is no shuffle, and memory
is bounded by a piece of some million characters and a cache of some hundred thousand words.

A null text is empty, an empty text has no tokens. Strings of special tokens in a text are
those tokens, as in the library. Repeated rows come out as often. An empty table gives an empty
result. Further columns are not looked at; null ids stay null.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weftline.llm.common import in_small_batches

#: Characters encoded at a time, and words whose encodings are kept between.
PIECE_CHARS = 4_000_000
CACHE_WORDS = 150_000
CACHE_PAIRS = 200_000
_NEVER = 1 << 60
#: A word as the pattern finds it, or marked: a word the library has split, a special token.
Word = str | tuple[str, str]
_SPLIT, _SPECIAL = "split", "special"
#: White space of the file's pattern; the pattern module's own also takes the separators 1c to 1f.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def _byte_names() -> list[str]:
    """Characters that stand for bytes: printable ones for themselves, the others from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


_BYTES = _byte_names()


class TrieEncoder:
    """Encoder of one tokenizer file of the BPE kind with a word-end mark (or none)."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        added = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.end = model["model"].get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["model"]["vocab"]
        self.names = {i: s for s, i in (self.ids | added).items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for n, merge in enumerate(model["model"]["merges"]):
            left, right = (self.ids[s] for s in (merge.split(" ") if isinstance(merge, str) else merge))
            self.rank[left, right] = n
            self.made.setdefault(self.ids[self.names[left] + self.names[right]], (n, left, right))
        self.special = regex.compile("|".join(sorted(map(regex.escape, added), key=len, reverse=True))) if added else None
        self.added = added
        self._pairs: dict[tuple[int, int], bool] = {}
        self._whole: dict[int, bool] = {}
        self._words: dict[Word, tuple[int, str, str]] = {}
        self._pattern = self._own_pattern(model)
        self._inner = self._endings("")
        self._final = self._endings(self.end) if self.end else self._inner

    def _border(self, token: int, right: bool) -> Iterator[tuple[int, int]]:
        """Tokens that stand at a token's edge while it is built, with the rank that ends each."""
        until = _NEVER
        while True:
            yield token, until
            if token not in self.made:
                return
            until, *halves = self.made[token]
            token = halves[1] if right else halves[0]

    def _clash(self, left: int, right: int, before: int) -> bool:
        """Would a merge of a rank under ``before`` join the two across their border?

        Of equal ranks the leftmost merge goes first: one inside ``left`` before, one inside
        ``right`` after the one across.
        """
        for a, a_until in self._border(left, True):
            for b, b_until in self._border(right, False):
                n = self.rank.get((a, b))
                if n is not None and n < before and n < a_until and n <= b_until:
                    return True
        return False

    def _sound(self, token: int) -> bool:
        """Is the token the encoding of its own text?"""
        known = self._whole.get(token)
        if known is None:
            if token in self.made:
                n, left, right = self.made[token]
                known = self._sound(left) and self._sound(right) and not self._clash(left, right, n)
            else:
                known = True
            self._whole[token] = known
        return known

    def _follows(self, left: int, right: int) -> bool:
        known = self._pairs.get((left, right))
        if known is None:
            if len(self._pairs) >= CACHE_PAIRS:
                self._pairs.clear()
            known = self._pairs[left, right] = not self._clash(left, right, _NEVER)
        return known

    def _endings(self, end: str) -> dict[str, int]:
        """Tokens with the mark ``end``, by text without it, and -1 for every text they end in."""
        found: dict[str, int] = {}
        for name, token in self.ids.items():
            if end and not name.endswith(end) or not self._sound(token):
                continue
            text = name[: len(name) - len(end)]
            for start in range(1, len(text)):
                found.setdefault(text[start:], -1)
            found[text] = token
        return found

    def _last(self, text: str, at: int, states: list[tuple[int, int]], endings: dict[str, int]) -> tuple[int, int]:
        """(last token, where it starts) of the first ``at`` characters of ``text``. Only one is right."""
        pairs = self._pairs
        for start in range(at - 1, -1, -1):
            token = endings.get(text[start:at])
            if token is None:
                break
            if token >= 0:
                if not start:
                    return token, 0
                known = pairs.get((states[start][0], token))
                if known or known is None and self._follows(states[start][0], token):
                    return token, start
        raise ValueError(f"no token ends {text[:at]!r}")

    def encode_words(self, words: list[str]) -> dict[str, tuple[int, ...]]:
        """Encodings of distinct words, each given as the model's own characters."""
        out: dict[str, tuple[int, ...]] = {}
        states: list[tuple[int, int]] = [(-1, 0)]
        before = ""
        for word in sorted(words):
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            # The path down to the last character but one is kept for the next word.
            del states[shared + 1 :]
            for at in range(len(states), len(word)):
                states.append(self._last(word, at, states, self._inner))
            before = word[: len(states) - 1]
            token, at = self._last(word, len(word), states, self._final)
            tokens = [token]
            while at:
                token, at = states[at]
                tokens.append(token)
            out[word] = tuple(reversed(tokens))
        return out

    @staticmethod
    def _own_pattern(model: dict) -> regex.Pattern | None:
        """Pattern of the words, if the file lower-cases, keeps the matches of one pattern and maps bytes."""
        steps = [n["type"] for n in (model["normalizer"] or {}).get("normalizers", [])]
        split, *rest = (model["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        if steps != ["NFC", "Replace", "Lowercase"] or [r["type"] for r in rest] != ["ByteLevel"]:
            return None
        if not split.get("invert") or split.get("behavior") != "Removed" or rest[0]["use_regex"] or rest[0]["add_prefix_space"]:
            return None
        return regex.compile(split["pattern"]["Regex"].replace(r"\s", _SPACE))

    def words(self, text: str) -> list[Word]:
        """Words of a text; those that the library has split and special tokens are marked as such."""
        if not self.special:
            return self._plain_words(text)
        found: list[Word] = []
        at = 0
        for special in self.special.finditer(text):
            found += self._plain_words(text[at : special.start()])
            found.append((_SPECIAL, special[0]))
            at = special.end()
        return found + self._plain_words(text[at:]) if at else self._plain_words(text)

    def _plain_words(self, text: str) -> list[Word]:
        if self._pattern:
            try:
                text.encode("latin-1")
            except UnicodeError:
                pass
            else:
                return self._pattern.findall(text.lower())
        normal = self.tokenizer.normalizer.normalize_str(text) if self.tokenizer.normalizer else text
        return [(_SPLIT, w) for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    def learn(self, words: set[Word]) -> None:
        """Encode the words that are not known yet."""
        new = {}
        for word in words:
            if word in self._words:
                continue
            if isinstance(word, tuple):
                new[word] = word[1]
            else:
                new[word] = word if word.isascii() and word.isprintable() else "".join([_BYTES[b] for b in word.encode()])
        special = {word for word in new if word[0] == _SPECIAL and isinstance(word, tuple)}
        encoded = self.encode_words({own for word, own in new.items() if word not in special})
        if len(self._words) + len(new) > CACHE_WORDS:
            self._words = {w: v for w, v in self._words.items() if w in words}
        names = self.names
        for word, own in new.items():
            ids = (self.added[own],) if word in special else encoded[own]
            self._words[word] = (len(ids), " ".join(map(str, ids)), " ".join([names[i] for i in ids]))

    def encode(self, texts: list[str]) -> Iterator[list[tuple[int, str, str]]]:
        """For each text its words' (number of ids, ids as text, tokens as text)."""
        split = [self.words(t) for t in texts]
        self.learn(set().union(*split))
        known = self._words
        for own in split:
            yield [known[w] for w in own]

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by blanks, which is the library's way for a file without a decoder."""
        return " ".join([self.names[i] for i in ids if i in self.names])


@lru_cache(2)
def encoder(path: str) -> TrieEncoder:
    return TrieEncoder(path)


def _parts(texts: pa.Array) -> Iterator[list[str]]:
    """Texts of a batch, some million characters at a time."""
    part: list[str] = []
    size = 0
    for text in texts:
        own = text.as_py() or ""
        if part and size + len(own) > PIECE_CHARS:
            yield part
            part, size = [], 0
        part.append(own)
        size += len(own)
    if part:
        yield part


def encode_table(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(doc_id, ids): all token ids of each row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            at = 0
            for part in _parts(batch.column(1)):
                rows = [np.array(" ".join([c[1] for c in found]).split(), np.int32) for found in own.encode(part)]
                ends = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(rows)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), ids], ["doc_id", "ids"])
                at += len(part)

    return in_small_batches(docs).select(F.col("doc_id").cast("bigint"), F.col(text).cast("string")).mapInArrow(run, "doc_id bigint, ids array<int>")


def encode_and_decode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of the ids and of the decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            counts, ids, decoded = [], [], []
            for part in _parts(batch.column(1)):
                for found in own.encode(part):
                    counts.append(sum([c[0] for c in found]))
                    ids.append(hashlib.sha256(" ".join([c[1] for c in found]).encode()).hexdigest())
                    decoded.append(hashlib.sha256(" ".join([c[2] for c in found]).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return in_small_batches(docs).select(F.col("doc_id").cast("bigint"), F.col(text).cast("string")).mapInArrow(run, schema)

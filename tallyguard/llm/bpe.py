"""Word BPE encoding and decoding with a compiled lexicon.

The corpus' most frequent words (counted over all documents) are encoded once and compiled into a
minimal acyclic transducer (``lexicon``); the file is sent to the executors and memory-mapped
there. Words that it lacks are merged exactly. The lexicon only saves time: ids do not depend on it.

Null text counts as empty; texts of any length are encoded whole; repeated rows give repeated
results; an empty table gives an empty table; columns called like a result are replaced.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import tempfile
import unicodedata
import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyguard.llm import lexicon
from tallyguard.llm.common import stored

LEXICON_WORDS = 1 << 17
# A worker forgets all chunks and words once it holds more chunks, or chunks of more characters.
REMEMBERED, REMEMBERED_LENGTH = 300_000, 1 << 23
# Characters of texts whose chunks are looked up at once.
TOGETHER = 1_500_000
# Longer words are merged by a heap.
SHORT = 64
NEVER = 1 << 62
# Fixed values of the tokenizer file's format.
WORD_END = "</w>"
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{L}\p{N}]+")
WHITE = regex.compile("[\t\n\x0b\x0c\r \x85\xa0  -     　]+")
# White space to Python's str.split(), but not to the tokenizer.
NOT_WHITE = ("\x1c", "\x1d", "\x1e", "\x1f")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary: printable Latin-1 bytes
    stand for themselves, the others are numbered from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, extra = [], 256
    for byte in range(256):
        letters.append(chr(byte if byte in plain else extra))
        extra += byte not in plain
    return letters


class Merger:
    """The vocabulary and merges of a tokenizer file, applied word by word."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        ids = dict(file["model"]["vocab"])
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.tokens = {i: t for t, i in (*ids.items(), *self.special.items())}
        self.marks = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        letters = byte_letters()
        self.inner, self.last = [ids[c] for c in letters], [ids[c + WORD_END] for c in letters]
        # A pair of ids as one number, its rank, and the id that a rank makes.
        self.base = len(self.tokens)
        merges = [tuple(m) for m in file["model"]["merges"]]
        self.ranks = {ids[a] * self.base + ids[b]: rank for rank, (a, b) in enumerate(merges)}
        self.made = [ids[a + b] for a, b in merges]

    def word_ids(self, word: bytes) -> list[int]:
        """Exact merges: the pair with the best rank first, the leftmost of equal ones."""
        parts = [self.inner[b] for b in word]
        parts[-1] = self.last[word[-1]]
        if len(parts) > SHORT:
            return self._merge_long(parts)
        get, base = self.ranks.get, self.base
        ranks = [get(a * base + b, NEVER) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == NEVER:
                break
            i = ranks.index(best)
            parts[i] = self.made[best]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(parts[i - 1] * base + parts[i], NEVER)
            if i < len(ranks):
                ranks[i] = get(parts[i] * base + parts[i + 1], NEVER)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same for long words: a heap of (rank, place) over a linked list of parts."""
        get, base, n = self.ranks.get, self.base, len(parts)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n

        def rank(i: int) -> int:
            return get(parts[i] * base + parts[after[i]], NEVER) if after[i] < n else NEVER

        heap = [(r, i) for i in range(n - 1) if (r := rank(i)) != NEVER]
        heapq.heapify(heap)
        while heap:
            best, i = heapq.heappop(heap)
            if not alive[i] or rank(i) != best:
                continue
            gone = after[i]
            parts[i], alive[gone], after[i] = self.made[best], False, after[gone]
            if after[i] < n:
                before[after[i]] = i
            for j in (before[i], i):
                if j >= 0 and (r := rank(j)) != NEVER:
                    heapq.heappush(heap, (r, j))
        return [part for part, kept in zip(parts, alive) if kept]

    def pieces(self, chunk: str) -> list[bytes | int]:
        """The words of a text without white space, as bytes; special tokens as their ids."""
        plain = normal(chunk)
        if plain.isalpha():
            return [plain.encode()]
        found: list[bytes | int] = []
        at = 0
        for mark in self.marks.finditer(chunk):
            found += [p.encode() for p in PIECES.findall(normal(chunk[at : mark.start()]))]
            found.append(self.special[mark[0]])
            at = mark.end()
        found += [p.encode() for p in PIECES.findall(normal(chunk[at:]))]
        return found


def normal(text: str) -> str:
    """Composed form in lower case, letter by letter (a final sigma is no special case)."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return text.lower()


def chunks(text: str) -> list[str]:
    if any(c in text for c in NOT_WHITE):
        return [c for c in WHITE.split(text) if c]
    return text.split()


class Encoder:
    """Encodes batches of texts; words are looked up in the lexicon, then merged, then remembered."""

    def __init__(self, path: str, lexicon_path: str | None):
        self.merger = Merger(path)
        self.lexicon = lexicon.Lexicon(lexicon_path) if lexicon_path else None
        # Per word and chunk: ids as text, number of ids, tokens as text.
        self.words: dict[bytes, tuple[str, int, str]] = {}
        self.chunks: dict[str, tuple[str, int, str]] = {}
        self.length = 0

    def _form(self, ids: list[int]) -> tuple[str, int, str]:
        return " ".join(map(str, ids)), len(ids), " ".join([self.merger.tokens[i] for i in ids])

    def learn(self, every: set[str]) -> None:
        """Remember the forms of all these chunks, and of a bounded number and length of others."""
        if len(self.chunks) > REMEMBERED or self.length > REMEMBERED_LENGTH:
            self.words.clear()
            self.chunks.clear()
            self.length = 0
        fresh = [c for c in every if c not in self.chunks]
        self.length += sum(map(len, fresh))
        pieces = [self.merger.pieces(c) for c in fresh]
        unknown = list({p for own in pieces for p in own if type(p) is bytes and p not in self.words})
        if unknown:
            places = self.lexicon.places(unknown).tolist() if self.lexicon else [-1] * len(unknown)
            for word, place in zip(unknown, places):
                ids = self.lexicon.ids_of(place) if place >= 0 else self.merger.word_ids(word)
                self.words[word] = self._form(ids)
        for chunk, own in zip(fresh, pieces):
            parts = [self.words[p] if type(p) is bytes else self._form([p]) for p in own]
            self.chunks[chunk] = parts[0] if len(parts) == 1 else _joined(parts)

    def encode_all(self, texts: Iterable[str]) -> Iterator[tuple[str, int, str]]:
        """Per text: ids as text, their number, and tokens as text."""
        waiting, length = [], 0
        for text in texts:
            waiting.append(chunks(text))
            length += len(text)
            if length > TOGETHER:
                yield from self._forms(waiting)
                waiting, length = [], 0
        yield from self._forms(waiting)

    def _forms(self, waiting: list[list[str]]) -> Iterator[tuple[str, int, str]]:
        self.learn(set().union(*waiting))
        known = self.chunks
        for own in waiting:
            yield _joined([known[c] for c in own])


def _joined(forms: list[tuple[str, int, str]]) -> tuple[str, int, str]:
    ids, numbers, tokens = zip(*forms) if forms else ((), (), ())
    return " ".join(ids), sum(numbers), " ".join(tokens)


def _digest(form: tuple[str, int, str]) -> tuple[int, str, str]:
    """Number of ids, and digests of the ids and of the decoded text."""
    ids, n, tokens = form
    return n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(tokens.encode()).hexdigest()


@lru_cache(maxsize=1)
def _encoder(path: str, lexicon_name: str) -> Encoder:
    return Encoder(path, SparkFiles.get(lexicon_name))


def frequent_words(docs: DataFrame, text: str, most: int) -> list[str]:
    """Up to ``most`` frequent words of letters in all texts.

    Words are cut off by their counts' class (an eighth of a power of two), so no task sorts them
    and the driver gets the chosen ones only.
    """
    words = F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}{2,}"), F.lit(0))
    counts = docs.select(F.explode(words).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    classed = stored(counts.filter("n > 1").select("w", F.floor(F.log2("n") * 8).alias("c")), "words")
    sizes = classed.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()
    total, least = 0, None
    for c, n in sorted((tuple(r) for r in sizes), reverse=True):
        total += n
        if total > most:
            break
        least = c
    return [] if least is None else [r["w"] for r in classed.filter(F.col("c") >= least).select("w").collect()]


def compile_lexicon(docs: DataFrame, text: str, path: str, most: int = LEXICON_WORDS) -> str:
    """Compile the corpus' frequent words and send the file to the executors; returns its name."""
    merger = Merger(path)
    words = sorted({normal(w).encode() for w in frequent_words(docs, text, most)})
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    folder = tempfile.mkdtemp(prefix="lexicon-")
    lexicon.write(os.path.join(folder, name), words, [merger.word_ids(w) for w in words])
    docs.sparkSession.sparkContext.addFile(os.path.join(folder, name))
    return name


def encode(docs: DataFrame, text: str = "text", path: str | None = None, most: int = LEXICON_WORDS) -> DataFrame:
    """``docs`` with ``ids`` (array of int) and ``decoded`` (the text that the ids decode to)."""
    return _mapped(docs, text, path, most, ["ids", "decoded"], [T.ArrayType(T.IntegerType()), T.StringType()], _whole)


def _whole(form: tuple[str, int, str]) -> tuple[list[int], str]:
    return [int(i) for i in form[0].split()], form[2]


def digests(docs: DataFrame, text: str = "text", path: str | None = None, most: int = LEXICON_WORDS) -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 and decoded_sha256; ids themselves are not kept."""
    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
    return _mapped(docs, text, path, most, names, [T.LongType(), T.StringType(), T.StringType()], _digest)


def _mapped(docs: DataFrame, text: str, path: str | None, most: int, names: list[str], types: list, result) -> DataFrame:
    path = path or public_tokenizers.path("word_bpe_49k.json")
    name = compile_lexicon(docs, text, path, most)
    docs = docs.drop(*[n for n in names if n != text])
    place = docs.columns.index(text)
    kept = [i for i, c in enumerate(docs.columns) if c not in names]
    schema = T.StructType([*[docs.schema[i] for i in kept], *[T.StructField(n, t) for n, t in zip(names, types)]])
    arrow = [{"bigint": pa.int64(), "string": pa.string()}.get(t.simpleString(), pa.list_(pa.int32())) for t in types]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, name)
        for batch in batches:
            found = list(map(result, encoder.encode_all(t.as_py() or "" for t in batch.column(place))))
            columns = [pa.array([f[i] for f in found], t) for i, t in enumerate(arrow)]
            kept_columns = [batch.column(i) for i in kept]
            yield pa.RecordBatch.from_arrays([*kept_columns, *columns], names=schema.names)

    return docs.mapInArrow(add, schema)

"""Operator 8: BPE encoding and decoding with a minimal acyclic transducer as lexicon.

Frequent words (stretches without white space) are compiled with their ids into a shared-suffix automaton
(``lexicon.py``), which every task maps into memory. Words the automaton does not accept are merged exactly.
The words that go into the automaton only decide speed, never a result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import chunks, expand, register, table, texts_of
from .lexicon import Lexicon, compile_words

# Most frequent words of all documents that the automaton holds.
LEXICON_WORDS = 100_000
# Letters after the Latin blocks; below them nothing composes and every class is settled.
LATER_FROM = "\u0250"
# Stretches of more bytes are merged one by one.
LONG = 48
NO_MERGE = 1 << 30
_SEPARATORS = "\x1c\x1d\x1e\x1f"


def split_words(text: str) -> list[str]:
    """The stretches without white space. Python also splits at four control characters that are none here."""
    if any(c in text for c in _SEPARATORS):
        return [w for w in regex.split(r"\s+", text) if w]
    return text.split()


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 characters for themselves, the others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class Merger:
    """Exact ids of single words, from a tokenizer file's vocabulary and merges."""

    def __init__(self, definition: bytes) -> None:
        spec = json.loads(definition)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")")
        pattern = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        self.pieces = regex.compile(pattern)
        self.letters = byte_letters()
        pairs = [(self.vocab[a] << 20 | self.vocab[b], r, self.vocab[a + b]) for r, (a, b) in enumerate(model["merges"])]
        self.merges = {key: (rank, to) for key, rank, to in pairs}
        self.merged = np.array([to for _, _, to in pairs] or [0], np.int32)
        self.pairs, self.ranks = np.array(sorted((k, r) for k, r, _ in pairs) or [(-1, 0)], np.int64).T.copy()
        self.tokens = np.array([""] * (1 + max([*self.vocab.values(), *self.specials.values()])), dtype=object)
        for token, number in [*self.vocab.items(), *self.specials.items()]:
            self.tokens[number] = token
        self.first = np.array([self.vocab[c] for c in self.letters], np.int32)
        self.last = np.array([self.vocab[c + self.end] for c in self.letters], np.int32)
        # Splits words whose letters the installed Unicode tables may class differently.
        self.library = Tokenizer.from_str(definition.decode())
        self.byte_of = {c: b for b, c in enumerate(self.letters)}

    def _pieces(self, part: str) -> list[bytes]:
        """The part in lower case, cut into the stretches that merges never cross."""
        lower = part.lower()
        if lower.isalpha() and max(part) < LATER_FROM:
            return [lower.encode()]
        if not part or max(part) < LATER_FROM:
            return [p.encode() for p in self.pieces.findall(lower)]
        normal = self.library.normalizer.normalize_str(part)
        cut = self.library.pre_tokenizer.pre_tokenize_str(normal)
        return [bytes(self.byte_of[c] for c in p) for p, _ in cut]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 20 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], NO_MERGE).astype(np.int32)

    def _merge_long(self, data: bytes) -> np.ndarray:
        """Merges of one long stretch: pairs by rank and place, from a heap over a linked list."""
        ids = self.first[np.frombuffer(data, np.uint8)].tolist()
        ids[-1] = int(self.last[data[-1]])
        after, before = [*range(1, len(ids)), -1], [-1, *range(len(ids) - 1)]
        get = self.merges.get
        heap = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(len(ids) - 1) if (m := get(ids[i] << 20 | ids[i + 1]))]
        heapq.heapify(heap)
        while heap:
            _, at, left, right, to = heapq.heappop(heap)
            nxt = after[at]
            if ids[at] != left or nxt < 0 or ids[nxt] != right:
                continue
            ids[at], ids[nxt], after[at] = to, -1, after[nxt]
            if after[at] >= 0:
                before[after[at]] = at
                if m := get(to << 20 | ids[after[at]]):
                    heapq.heappush(heap, (m[0], at, to, ids[after[at]], m[1]))
            if before[at] >= 0 and (m := get(ids[before[at]] << 20 | to)):
                heapq.heappush(heap, (m[0], before[at], ids[before[at]], to, m[1]))
        return np.array([i for i in ids if i >= 0], np.int32)

    def merge(self, stretches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all stretches one after the other, and how many each has. In every round each stretch
        makes its merge of least rank, the leftmost of equals."""
        sizes = np.fromiter(map(len, stretches), np.int64, len(stretches))
        flat = np.frombuffer(b"".join(stretches), np.uint8)
        starts = np.cumsum(sizes) - sizes
        counts = sizes.copy()
        out: list[tuple[np.ndarray, np.ndarray]] = []
        low = 0
        for width in (4, 8, 12, 16, 24, LONG):
            rows = np.flatnonzero((sizes > low) & (sizes <= width))
            low = width
            if not len(rows):
                continue
            column = np.arange(width)
            inside = column < sizes[rows, None]
            ids = np.zeros((len(rows), width), np.int32)
            ids[inside] = self.first[flat[expand(starts[rows], sizes[rows])]]
            ids[np.arange(len(rows)), sizes[rows] - 1] = self.last[flat[starts[rows] + sizes[rows] - 1]]
            rank = np.full((len(rows), width), NO_MERGE, np.int32)
            pair = inside[:, 1:]
            rank[:, :-1][pair] = self._rank(ids[:, :-1][pair], ids[:, 1:][pair])
            while len(rows):
                at = rank.argmin(axis=1)
                line = np.arange(len(rows))
                best = rank[line, at]
                open_ = best < NO_MERGE
                if not open_.all():
                    done = ~open_
                    kept = column < counts[rows[done], None]
                    out.append((rows[done], ids[done][kept]))
                    rows, ids, rank, at, best = rows[open_], ids[open_], rank[open_], at[open_], best[open_]
                    line = np.arange(len(rows))
                    if not len(rows):
                        break
                source = np.minimum(column + (column > at[:, None]), width - 1)
                ids = np.take_along_axis(ids, source, 1)
                rank = np.take_along_axis(rank, source, 1)
                ids[line, at] = self.merged[best]
                counts[rows] -= 1
                rank[line, counts[rows] - 1] = NO_MERGE
                inner = at + 1 < counts[rows]
                rank[line[inner], at[inner]] = self._rank(ids[line[inner], at[inner]], ids[line[inner], at[inner] + 1])
                inner = at > 0
                rank[line[inner], at[inner] - 1] = self._rank(ids[line[inner], at[inner] - 1], ids[line[inner], at[inner]])
        for row in np.flatnonzero(sizes > LONG):
            found = self._merge_long(stretches[row])
            counts[row] = len(found)
            out.append((np.array([row]), found))
        ends = np.cumsum(counts)
        result = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint32)
        for rows, found in out:
            result[expand(ends[rows] - counts[rows], counts[rows])] = found
        return result, counts

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words (stretches without white space) one after the other, and how many each has."""
        known: dict[bytes | int, int] = {}
        parts, per_word = [], np.zeros(len(words), np.int64)
        for i, word in enumerate(words):
            cut = self._pieces(word) if "<|" not in word else self._with_specials(word)
            per_word[i] = len(cut)
            parts += [known.setdefault(p, len(known)) for p in cut]
        stretches = [p for p in known if isinstance(p, bytes)]
        pool, counts = self.merge(stretches)
        fixed = [p for p in known if not isinstance(p, bytes)]
        pool = np.concatenate([pool, np.array(fixed, np.uint32)])
        counts = np.concatenate([counts, np.ones(len(fixed), np.int64)])
        starts = np.cumsum(counts) - counts
        # Specials come after the stretches in the pool, whenever they were met.
        place = np.zeros(len(known), np.int64)
        is_fixed = np.fromiter((not isinstance(p, bytes) for p in known), np.bool_, len(known))
        place[~is_fixed] = np.arange(len(stretches))
        place[is_fixed] = len(stretches) + np.arange(len(fixed))
        used = place[np.array(parts, np.int64)]
        ids = pool[expand(starts[used], counts[used])]
        reach = np.concatenate([[0], np.cumsum(counts[used])])
        return ids, np.diff(reach[np.concatenate([[0], np.cumsum(per_word)])])

    def _with_specials(self, word: str) -> list[bytes | int]:
        found: list[bytes | int] = []
        for part in self.special_split.split(word):
            found += [self.specials[part]] if part in self.specials else self._pieces(part)
        return found


class Encoder:
    """Ids of whole texts: automaton first, exact merges for what it does not hold."""

    def __init__(self, definition: bytes, lexicon: bytes) -> None:
        self.merger = Merger(definition)
        self.lexicon = Lexicon(lexicon)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text's ids end."""
        split = [split_words(t) for t in texts]
        words = [w for one in split for w in one]
        codes, distinct = pd.factorize(np.array(words, dtype=object)) if words else (np.zeros(0, np.int64), [])
        number = self.lexicon.numbers(w.encode("utf-8") for w in distinct)
        known = number >= 0
        offsets = self.lexicon.offsets
        starts, counts = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
        starts[known] = offsets[number[known]]
        counts[known] = offsets[number[known] + 1] - offsets[number[known]]
        merged, sizes = self.merger.words([distinct[i] for i in np.flatnonzero(~known)])
        counts[~known] = sizes
        starts[~known] = len(self.lexicon.ids) + np.cumsum(sizes) - sizes
        pool = np.concatenate([self.lexicon.ids, merged])
        per_word = counts[codes]
        ids = pool[expand(starts[codes], per_word)]
        word_ends = np.cumsum([len(one) for one in split])
        ends = np.concatenate([[0], np.cumsum(per_word)])[word_ends]
        return ids, ends

    def decode(self, ids: np.ndarray) -> str:
        """The tokens as the file's absent decoder gives them: joined by single spaces."""
        return " ".join(self.merger.tokens[ids])


def read_definition(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def build_lexicon(docs: DataFrame, definition: bytes, words: int = LEXICON_WORDS) -> bytes:
    """The automaton of the most frequent words of all documents. ``words`` bounds what one task compiles; the driver
    holds the finished block only. Any choice of words gives the same ids."""
    counted = (
        texts_of(docs)
        .select(F.explode(F.split("text", r"[ \t\n\x0B\f\r]+")).alias("word"))
        .filter((F.col("word") != "") & (F.octet_length("word") <= 40))
        .groupBy("word")
        .count()
        .filter("count > 1")
        .orderBy(F.desc("count"), "word")
        .limit(words)
    )

    def compiled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # A stretch that itself holds other white space is not one word.
        chosen = [w for batch in batches for w in batch["word"] if split_words(w) == [w]]
        ids, counts = Merger(definition).words(chosen)
        parts = np.split(ids, np.cumsum(counts)[:-1]) if chosen else []
        yield pd.DataFrame({"block": [compile_words({w.encode(): i.tolist() for w, i in zip(chosen, parts, strict=True)})]})

    found = counted.select("word").coalesce(1).mapInPandas(compiled, "block binary").toArrow().column("block").to_pylist()
    return found[0] if found else compile_words({})


def encode_documents(docs: DataFrame, path: str, words: int = LEXICON_WORDS) -> DataFrame:
    """doc_id, ids array<int> and decoded string of every row of ``docs``. Null and empty texts have no ids and
    decode to an empty text; repeated rows stay repeated; other columns are ignored."""
    return _run(docs, path, words, _arrays, "doc_id long, ids array<int>, decoded string")


def digest_documents(docs: DataFrame, path: str, words: int = LEXICON_WORDS) -> DataFrame:
    """As ``encode_documents``, with counts and digests in place of the ids and the decoded text."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _run(docs, path, words, _digests, schema)


def _run(docs: DataFrame, path: str, words: int, shape, schema: str) -> DataFrame:
    definition = read_definition(path)
    lexicon = build_lexicon(docs, definition, words)
    shared = docs.sparkSession.sparkContext.broadcast((definition, lexicon))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(*shared.value)
        for batch in batches:
            for part in chunks(batch):
                ids, ends = encoder.encode(part["text"].tolist())
                yield shape(encoder, part["doc_id"], ids, ends)

    return texts_of(docs).mapInPandas(work, schema)


def _arrays(encoder: Encoder, doc_id: pd.Series, ids: np.ndarray, ends: np.ndarray) -> pd.DataFrame:
    per_text = np.split(ids.astype(np.int32), ends[:-1])
    return pd.DataFrame({"doc_id": doc_id.array, "ids": per_text, "decoded": [encoder.decode(i) for i in per_text]})


def _digests(encoder: Encoder, doc_id: pd.Series, ids: np.ndarray, ends: np.ndarray) -> pd.DataFrame:
    per_text = np.split(ids.astype("<u4"), ends[:-1])
    return pd.DataFrame(
        {
            "doc_id": doc_id.array,
            "n_tokens": [len(i) for i in per_text],
            "ids_sha256": [hashlib.sha256(i.tobytes()).hexdigest() for i in per_text],
            "decoded_sha256": [hashlib.sha256(encoder.decode(i).encode()).hexdigest() for i in per_text],
        }
    )


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register()
def op8_bpe_lexicon(spark: SparkSession, folder: str) -> DataFrame:
    return digest_documents(table(spark, folder, "documents"), tokenizer_path())

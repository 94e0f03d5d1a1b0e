"""Operator 2: token ids as files of independently coded, checksummed blocks.

Texts are encoded with the tokenizers library, an end id closes each document, and the documents are dealt out by
ranges of doc_id. A file is a range: Parquet rows, one per block, each with the coded ids of a stretch of the file,
their number and checksum, and the documents (and pieces of long documents) they hold. Every block is coded from
empty models (``coder.py``), so each can be read alone and a lost one harms no other.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from streamtally.session import fresh_folder, stored

from .bpe import read_definition, split_words, tokenizer_path
from .coder import decode_blocks, encode_blocks
from .common import chunks, expand, register, table, texts_of

END_ID = 2
BLOCK_IDS = 2_048
# Blocks that are coded side by side.
LANES = 1_024
# Distinct words whose ids a task remembers, and characters of text that it encodes at a time.
MEMO_WORDS = 1 << 17
TEXT_CHARS = 1 << 20
BLOCKS = "file int, block int, n_ids int, crc32 long, payload binary, docs array<struct<doc:long,doc_id:long,start:long,n:int,last:boolean>>"


# Words that start with letters which nothing composes with and hold no others; how many the library gets as one text.
PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-\u012f\u0131-\u024f]+[!-@\[-`{-~]*")
TOGETHER = 128


class _Memo:
    """The ids of words that a task has met, in one pool; beyond ``MEMO_WORDS`` words are encoded again."""

    def __init__(self, tokenizer: Tokenizer) -> None:
        self.tokenizer = tokenizer
        suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
        # Ids that end a piece of a word, if the file marks them, and ids that start with a letter.
        vocabulary = tokenizer.get_vocab(with_added_tokens=False) if suffix else {}
        self.ending, self.letter = np.zeros(1 << 16, np.bool_), np.zeros(1 << 16, np.bool_)
        self.ending[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.letter[[i for token, i in vocabulary.items() if token[:1].isalpha()]] = True
        self.at: dict[str, int] = {}
        self.pool, self.starts, self.counts = np.zeros(0, np.uint16), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint16) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A pool of ids, and of each word where its ids start there and how many they are. Plain words go to the library
        many at a time, in one text. Each of them has a piece that starts with a letter, its first: a text with as many
        such pieces as words is cut before them; the words of any other go one by one."""
        plain = np.fromiter((PLAIN.fullmatch(w) is not None for w in words), np.bool_, len(words))
        starts, counts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        found: list[np.ndarray] = []
        size, alone = 0, [np.flatnonzero(~plain)]
        rows = np.flatnonzero(plain)
        groups = [rows[i : i + TOGETHER] for i in range(0, len(rows), TOGETHER)]
        for group, ids in zip(groups, self._library([" ".join([words[i] for i in g]) for g in groups]), strict=True):
            first = self.letter[ids]
            first[1:] &= self.ending[ids[:-1]]
            cuts = np.flatnonzero(first)
            if len(cuts) != len(group) or cuts[0] > 0:
                alone.append(group)
                continue
            starts[group], counts[group] = size + cuts, np.diff(cuts, append=len(ids))
            found.append(ids)
            size += len(ids)
        rows = np.concatenate(alone)
        single = self._library([words[i] for i in rows])
        counts[rows] = [len(ids) for ids in single]
        starts[rows] = size + np.cumsum(counts[rows]) - counts[rows]
        return np.concatenate([*found, *single, np.zeros(0, np.uint16)]), starts, counts

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A pool of ids, and of each word where its ids start there and how many they are."""
        known = self.at
        index = np.fromiter((known.get(w, -1) for w in words), np.int64, len(words))
        missing = np.flatnonzero(index < 0)
        new = [words[i] for i in missing]
        fresh, starts, counts = self._encoded(new)
        index[missing] = np.arange(len(self.starts), len(self.starts) + len(new))
        pool = np.concatenate([self.pool, fresh])
        all_starts, all_counts = np.concatenate([self.starts, len(self.pool) + starts]), np.concatenate([self.counts, counts])
        kept = min(MEMO_WORDS - len(known), len(new))
        if kept > 0:
            known.update(zip(new[:kept], range(len(self.starts), len(self.starts) + kept), strict=True))
            held = expand(starts[:kept], counts[:kept])
            self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(counts[:kept]) - counts[:kept]])
            self.counts, self.pool = all_counts[: len(self.starts)], np.concatenate([self.pool, fresh[held]])
        return pool, all_starts[index], all_counts[index]


def _ids_of(memo: _Memo, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other and how many each has. White space always parts the ids of a text, so
    each distinct word is encoded by the library once."""
    split = [split_words(t) for t in texts]
    words = [w for one in split for w in one]
    codes, distinct = pd.factorize(np.array(words, dtype=object)) if words else (np.zeros(0, np.int64), [])
    pool, starts, counts = memo.ids(list(distinct))
    per_word = counts[codes]
    reach = np.concatenate([[0], np.cumsum(per_word)])
    ends = reach[np.cumsum([len(s) for s in split])]
    return pool[expand(starts[codes], per_word)], np.diff(np.r_[0, ends])


def _tokenised(batches: Iterator[pd.DataFrame], definition: bytes, end_id: int) -> Iterator[tuple[int | None, bytes]]:
    """(doc_id, ids of two bytes each with the end id) of each row in turn."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_str(definition.decode())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    if max(tokenizer.get_vocab_size(), end_id + 1) > 1 << 16:
        raise ValueError("the file format holds ids below 65,536")
    memo = _Memo(tokenizer)
    end = np.array([end_id], "<u2").tobytes()
    for batch in batches:
        for part in chunks(batch, size=TEXT_CHARS):
            ids, counts = _ids_of(memo, part["text"].tolist())
            per_text = np.split(ids.astype("<u2"), np.cumsum(counts)[:-1])
            for doc_id, found in zip(part["doc_id"], per_text, strict=True):
                yield None if pd.isna(doc_id) else int(doc_id), found.tobytes() + end


def write_files(docs: DataFrame, definition: bytes, folder: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Writes all documents in ascending order of doc_id, null ids first, texts of one id by their hash.

    Null and empty texts have the end id alone; whole texts are written, a long one over many blocks; rows equal in id
    and text stand next to each other, each on its own; an empty table gives files without rows. Other columns are
    ignored."""
    # Texts travel, and are encoded where they are written: Spark runs what it deals out by range once more, to find
    # the ranges. The last key only spreads equal rows, in which no order can be seen.
    keys = ["doc_id", "hash", "spread"]
    texts = texts_of(docs).withColumns({"hash": F.xxhash64("text"), "spread": F.spark_partition_id()})
    ordered = texts.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")

    def blocks(file: int, docs_: list[tuple], stream: list[bytes], first: int) -> pd.DataFrame:
        ids = np.frombuffer(b"".join(stream), "<u2").astype(np.int32)
        cuts = [ids[i : i + block_ids] for i in range(0, len(ids), block_ids)]
        held: list[list[dict]] = [[] for _ in cuts]
        at = 0
        for doc, doc_id, start, n in docs_:
            lo, end = at, at + n
            while lo < end:
                hi = min(end, (lo // block_ids + 1) * block_ids)
                held[lo // block_ids].append({"doc": doc, "doc_id": doc_id, "start": start, "n": hi - lo, "last": hi == end})
                lo = hi
            at = end
        return pd.DataFrame(
            {
                "file": file,
                "block": np.arange(first, first + len(cuts), dtype=np.int32),
                "n_ids": [len(c) for c in cuts],
                "crc32": [zlib.crc32(c.astype("<u4").tobytes()) for c in cuts],
                "payload": encode_blocks(cuts),
                "docs": held,
            }
        )

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        file = TaskContext.get().partitionId()
        start, number, first = 0, 0, 0
        waiting: list[tuple] = []
        stream: list[bytes] = []
        size = 0
        for doc_id, ids in _tokenised(batches, definition, end_id):
            n = len(ids) // 2
            waiting.append((number, doc_id, start, n))
            stream.append(ids)
            start, number, size = start + n, number + 1, size + n
            if size >= LANES * block_ids:
                out = blocks(file, waiting, stream, first)
                yield out
                first, waiting, stream, size = first + len(out), [], [], 0
        if waiting:
            yield blocks(file, waiting, stream, first)

    ordered.mapInPandas(work, BLOCKS).write.parquet(folder)


def read_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Of every piece of a document: file, doc, doc_id, start (ids before the document in its file), block, and its
    ids. A block whose ids do not have its checksum raises an error that names it."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo in range(0, len(batch), LANES):
                part = batch.iloc[lo : lo + LANES]
                ids = decode_blocks(list(part["payload"]), list(part["n_ids"]))
                rows = []
                for file, block, crc, docs, found in zip(part["file"], part["block"], part["crc32"], part["docs"], ids, strict=True):
                    if zlib.crc32(found.astype("<u4").tobytes()) != crc:
                        raise ValueError(f"block {block} of file {file} is damaged")
                    at = 0
                    for d in docs:
                        rows.append((file, d["doc"], d["doc_id"], d["start"], block, d["n"], found[at : at + d["n"]].astype("<u4").tobytes()))
                        at += d["n"]
                out = pd.DataFrame(rows, columns=["file", "doc", "doc_id", "start", "block", "n", "ids"])
                yield out.astype({"doc_id": "Int64"})

    schema = "file int, doc long, doc_id long, start long, block int, n int, ids binary"
    return spark.read.schema(BLOCKS).parquet(folder).mapInPandas(work, schema)


def _joined_crc(a: int, b: int, size: int) -> int:
    """crc32 of two joined byte strings, the second of ``size`` bytes, from theirs: a's is carried over zero bytes,
    as a product of polynomials over two elements."""

    def times(x: int, y: int) -> int:
        out = 0
        for bit in range(31, -1, -1):
            if x >> bit & 1:
                out ^= y
            y = (y >> 1) ^ (0xEDB88320 if y & 1 else 0)
        return out

    # x^8 to the power of size, by squaring; bit 31 is the constant term.
    power, base = 1 << 31, 1 << 23
    while size:
        if size & 1:
            power = times(power, base)
        base = times(base, base)
        size >>= 1
    return times(power, a) ^ b


def file_digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, all from the files: a row for each row written, also
    for equal ones, null ids and empty texts (which hold the end id); none for an empty table. A document over many
    blocks is read piece by piece and its checksums are joined."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(crc=[zlib.crc32(i) for i in batch["ids"]]).drop(columns="ids")

    pieces = stored(read_blocks(spark, folder).mapInPandas(sums, "file int, doc long, doc_id long, start long, block int, n int, crc long"), "pieces")
    docs = pieces.groupBy("file", "doc").agg(
        F.first("doc_id").alias("doc_id"), F.first("start").alias("start"), F.sum("n").cast("long").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("block", "n", "crc"))).alias("parts"),
    )

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for parts in batch["parts"]:
                crc = parts[0]["crc"]
                for p in parts[1:]:
                    crc = _joined_crc(crc, p["crc"], 4 * p["n"])
                found.append(crc)
            yield batch.drop(columns="parts").assign(ids_crc32=np.array(found, np.int64))

    # One row per file: how many ids all files before it hold.
    files = pieces.groupBy("file").agg(F.sum("n").alias("ids"))
    base = files.select("file", F.coalesce(F.sum("ids").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    summed = docs.mapInPandas(whole, "file int, doc long, doc_id long, start long, n_tokens long, ids_crc32 long")
    return summed.join(base, "file").select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


@register()
def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    target = fresh_folder(spark, "token-files")
    write_files(table(spark, folder, "documents"), read_definition(tokenizer_path()), target)
    return file_digests(spark, target)

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from streamtally.llm import bpe, token_files
from streamtally.llm.coder import decode_blocks, encode_blocks
from streamtally.session import fresh_folder

from .frames import awkward, documents, empty


def test_coder_round_trips():
    rng = np.random.default_rng(3)
    blocks = [rng.integers(0, 1 << 16, n).astype(np.int32) for n in (0, 1, 5, 300)]
    blocks += [np.zeros(400, np.int32), np.full(7, 65_535, np.int32), np.tile(np.arange(10, dtype=np.int32), 50)]
    coded = encode_blocks(blocks)
    for got, want in zip(decode_blocks(coded, [len(b) for b in blocks]), blocks, strict=True):
        assert (got == want).all()
    assert len(coded[4]) < 60 and len(coded[6]) < 400
    # Blocks are independent: one alone is read as in company.
    assert (decode_blocks(coded[3:4], [300])[0] == blocks[3]).all()
    assert encode_blocks([]) == [] and decode_blocks([], []) == []


def test_coded_bytes_stay_the_format():
    """Files of earlier versions are read: the coded bytes of some blocks, from mixed to constant."""
    rng = np.random.default_rng(5)
    blocks = [(rng.zipf(1.3, n) % 49_000).astype(np.int32) for n in (700, 1, 0, 350, 699)]
    blocks += [np.tile(rng.integers(0, 1 << 16, 40), 9).astype(np.int32), np.full(300, 65_535, np.int32)]
    coded = encode_blocks(blocks)
    assert zlib.crc32(b"".join(coded)) == 104_862_694
    assert all((a == b).all() for a, b in zip(decode_blocks(coded, [len(b) for b in blocks]), blocks, strict=True))


def test_digests_from_the_files(spark):
    library = Tokenizer.from_file(bpe.tokenizer_path())
    rows = awkward()
    folder = fresh_folder(spark, "files")
    token_files.write_files(documents(spark, rows), bpe.read_definition(bpe.tokenizer_path()), folder, block_ids=64)
    got = token_files.file_digests(spark, folder).collect()
    start, want = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_damage_is_seen(spark):
    folder, bad = fresh_folder(spark, "files"), fresh_folder(spark, "files")
    token_files.write_files(documents(spark, {1: "some words to keep"}), bpe.read_definition(bpe.tokenizer_path()), folder)
    spark.read.parquet(folder).selectExpr("file", "block", "n_ids", "crc32 + 1 as crc32", "payload", "docs").write.parquet(bad)
    with pytest.raises(Exception, match="damaged"):
        token_files.file_digests(spark, bad).collect()


def test_empty_table(spark):
    folder = fresh_folder(spark, "files")
    token_files.write_files(empty(spark), bpe.read_definition(bpe.tokenizer_path()), folder)
    assert token_files.file_digests(spark, folder).count() == 0


class Counted:
    """The library, with the number of texts that it was given."""

    def __init__(self, library: Tokenizer) -> None:
        self.library, self.texts = library, 0

    def __getattr__(self, name):
        return getattr(self.library, name)

    def encode_batch(self, texts, **options):
        self.texts += len(texts)
        return self.library.encode_batch(texts, **options)

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.library.encode_batch_fast(texts, **options)


def test_plain_words_share_texts():
    """New words with one stretch of letters at their start go to the library together, and keep the ids they have alone."""
    library = Tokenizer.from_file(bpe.tokenizer_path())
    letters = [chr(c) for c in range(0x21, 0x250) if chr(c).isprintable()]
    plain = [a + b + c for a in "aBz" for b in "eXoq" for c in ["", "rd", "st,", "ing...", "s'", "no7!"]]
    odd = ["it's", "don't,", "a1b2", "İstanbul", "<|endoftext|>", "ab<|endoftext|>cd", "'ssh", "x.y", "日本語", "éa", "ñandú", "7", "--"]
    words = list(dict.fromkeys([*odd, *plain, *letters, *(f"a{c}" for c in letters), *(f"a{c}b" for c in letters)]))
    memo = token_files._Memo(Counted(library))
    for _ in range(2):
        pool, starts, counts = memo.ids(words)
        assert [pool[s : s + n].tolist() for s, n in zip(starts, counts, strict=True)] == [library.encode(w, add_special_tokens=False).ids for w in words]
    memo = token_files._Memo(Counted(library))
    memo.ids(plain)
    assert memo.tokenizer.texts < len(plain) / 20

import hashlib
import random

import numpy as np
from tokenizers import Tokenizer

from streamtally.llm import bpe
from streamtally.llm.lexicon import Lexicon, compile_words

from .frames import awkward, documents, empty

PATH = bpe.tokenizer_path()


def test_lexicon_accepts_its_words_only():
    rng = random.Random(1)
    words = {bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 7))): [rng.randrange(9) for _ in range(rng.randrange(4))] for _ in range(200)}
    lexicon = Lexicon(compile_words(words))
    asked = [*words, b"", b"zzz", b"abcabcabcabc", b"aaaaaaa"]
    for word, number in zip(asked, lexicon.numbers(asked), strict=True):
        if word in words:
            assert lexicon.ids[lexicon.offsets[number] : lexicon.offsets[number + 1]].tolist() == words[word]
        else:
            assert number == -1
    # Endings are shared: fewer states than a tree of the words would have.
    assert len(lexicon.finals) < len({w[:i] for w in words for i in range(len(w) + 1)})


def test_empty_lexicon():
    assert Lexicon(compile_words({})).numbers([b"a", b""]).tolist() == [-1, -1]


def test_words_agree_with_the_library_on_all_letters():
    merger, library = bpe.Merger(bpe.read_definition(PATH)), Tokenizer.from_file(PATH)
    texts = [f"a{chr(c)}B" for c in [*range(0x3000), *range(0xA000, 0xB000), *range(0x1F300, 0x1F700)]]
    split = [bpe.split_words(t) for t in texts]
    ids, counts = merger.words([w for one in split for w in one])
    ends = np.concatenate([[0], np.cumsum(counts)])[np.cumsum([0, *map(len, split)])]
    for at, found in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        assert ids[ends[at] : ends[at + 1]].tolist() == found.ids, texts[at]


def test_digests_agree_with_the_library(spark):
    library = Tokenizer.from_file(PATH)
    rows = awkward()
    got = bpe.digest_documents(documents(spark, rows), PATH, words=20).collect()
    want = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_arrays_and_empty_table(spark):
    got = {r.doc_id: r for r in bpe.encode_documents(documents(spark, {1: "hello world", 2: None}), PATH).collect()}
    assert list(got[1].ids) == Tokenizer.from_file(PATH).encode("hello world", add_special_tokens=False).ids
    assert list(got[2].ids) == [] and got[2].decoded == ""
    assert bpe.digest_documents(empty(spark), PATH).count() == 0


def test_lexicon_counts_words_of_all_documents(spark):
    # Each word stands in two of 24,000 documents, which share one text.
    docs = spark.range(24_000).selectExpr("id AS doc_id", "concat('word', id div 2) AS text")
    block = bpe.build_lexicon(docs, bpe.read_definition(PATH))
    assert (Lexicon(block).numbers(f"word{i}".encode() for i in range(12_000)) >= 0).all()

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from streamtally.llm import toxicity

from .frames import awkward, documents, empty, text

FOLDER = "/root/testdata/sf0.01"


def labelled(n=600):
    """Every fourth document holds words of one rare stem."""
    bad = lambda i: " ".join(f"vexo{'abcdefgh'[(i + k) % 8]}r" for k in range(2))
    return {i: text(i, 30) + (f" {bad(i)} {text(i + 7, 10)}" if i % 4 == 1 else "") for i in range(n)}, {i: int(i % 4 == 1) for i in range(n)}


def test_held_out_accuracy_on_words_of_a_rare_stem(spark):
    texts, toxic = labelled()
    labels = spark.createDataFrame([(i, t, 1) for i, t in toxic.items()], "doc_id long, toxic int, quality int")
    got = toxicity.score_documents(documents(spark, texts), labels).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(texts) and 100 < len(held) < 200
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([r.predicted == toxic[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    kept = toxicity.drop_toxic(documents(spark, texts), labels)
    assert kept.columns == documents(spark, texts).columns
    assert kept.count() == sum(r.predicted == 0 for r in got)


def test_held_out_labels_are_never_used(spark):
    texts, toxic = labelled(200)
    flip = {i: 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t for i, t in toxic.items()}
    frames = [spark.createDataFrame(list(x.items()), "doc_id long, toxic int") for x in (toxic, flip)]
    a, b = ({r.doc_id: r.score for r in toxicity.score_documents(documents(spark, texts), f).collect()} for f in frames)
    assert a == pytest.approx(b)


class PlainModel:
    """The same two models, written down letter by letter over strings."""

    def __init__(self, rows):
        self.n = {1: Counter(), 0: Counter()}
        for text_, toxic in rows:
            for word in toxicity.WORD.findall(text_.lower()):
                marked = f"\x02{word}\x03"
                for end in range(2, len(marked) + 1):
                    self.n[toxic][marked[max(0, end - toxicity.ORDER) : end]] += 1
        self.grams = set(self.n[0]) | set(self.n[1])
        self.context = {c: defaultdict(dict) for c in (0, 1)}
        for c in (0, 1):
            for g, n in self.n[c].items():
                self.context[c][self.of(g)][g] = n
        # Continuation counts are shared: of how many different grams is this the ending.
        self.low = Counter(g[-toxicity.BACKOFF :] for g in self.grams)
        self.letter = Counter(g[-1] for g in self.grams)
        self.low_context = defaultdict(dict)
        for low, ways in self.low.items():
            self.low_context[low[:-1]][low] = ways

    @staticmethod
    def of(gram):
        """The context of a gram: the up to five letters before its last one."""
        return gram[:-1]

    def p_letter(self, x):
        return self.letter[x] / sum(self.letter.values())

    def p_shared(self, low_context, x):
        d, held = toxicity.DISCOUNT, self.low_context[low_context]
        return (max(held.get(low_context + x, 0) - d, 0) + d * len(held) * self.p_letter(x)) / sum(held.values())

    def back(self, c, context):
        held = self.context[c].get(context, {})
        return toxicity.DISCOUNT * len(held) / sum(held.values()) if held else 1.0

    def p(self, c, context, x, low_context):
        held = self.context[c].get(context, {})
        seen = max(held.get(context + x, 0) - toxicity.DISCOUNT, 0) / sum(held.values()) if held else 0.0
        return seen + self.back(c, context) * self.p_shared(low_context, x)


CORPUS = [("Abc abd xyz abcdefghi abcdefghj", 1), ("abc abc abcdefghi zzz", 0), ("xyzabc ÉTÉ 12 été", 1), ("abdabd", 0)]


def test_every_probability_against_a_plain_model_and_sums_of_one(spark):
    plain = PlainModel(CORPUS)
    # Only a context as long as a gram allows comes from the middle of a word: its ends tell it apart.
    lows = {g: g[-toxicity.BACKOFF : -1] for g in plain.grams}
    for c in (0, 1):
        for context in {plain.of(g) for g in plain.grams}:
            low = context[-(toxicity.BACKOFF - 1) :]
            assert sum(plain.p(c, context, x, low) for x in plain.letter) == pytest.approx(1)
    counts = toxicity.gram_counts(spark.createDataFrame(CORPUS, "text string, toxic int")).cache()
    weights, backing = (
        {r.key: r.weight for r in frame.collect()} for frame in toxicity.gram_weights(counts)
    )
    assert len(weights) == counts.count() == len(plain.grams)

    def key(gram, order):
        marked = np.frombuffer(gram.encode("utf-32-le"), np.uint32)
        return int(toxicity._gram_keys(marked, np.array([len(marked)]), order)[-1])

    for g in plain.grams:
        want = math.log(plain.p(1, plain.of(g), g[-1], lows[g]) / plain.p(0, plain.of(g), g[-1], lows[g]))
        assert weights[key(g, toxicity.ORDER)] == pytest.approx(want), g
    for context in {plain.of(g) for g in plain.grams}:
        want = math.log(plain.back(1, context) / plain.back(0, context))
        assert backing[key(context, toxicity.ORDER - 1)] == pytest.approx(want), context


def test_grams_travel_by_their_spelling(spark, capsys):
    """Only a spelling and two counts of a gram are shuffled; its five keys come after the sum."""
    rows = [(f"{t} naïve 漢字 \U00010428\U00010429x", c) for t, c in CORPUS]
    counts = toxicity.gram_counts(spark.createDataFrame(rows, "text string, toxic int"))
    plain = PlainModel(rows)
    got = {r.spelling: (r.n_toxic, r.n_ordinary) for r in counts.collect()}
    assert got == {g: (plain.n[1][g], plain.n[0][g]) for g in plain.grams}
    capsys.readouterr()
    counts.explain("formatted")
    sent = re.findall(r"Exchange *\nInput \[(\d+)\]: \[(\w+)", capsys.readouterr().out)
    assert set(sent) == {("3", "spelling")}


def test_joined_tables_give_the_same_scores(spark):
    texts, toxic = labelled(160)
    labels = spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int")
    rows = [*texts.items(), *awkward(), (7, text(7, 40)), (None, None)]
    docs = documents(spark, rows).withColumn("seen", F.lit("mine")).withColumn("_did", F.lit("too"))
    key = lambda r: (r.doc_id is None, r.doc_id, r.score)
    one, two = (
        sorted(toxicity.score_documents(docs, labels, broadcast_rows=n).collect(), key=key) for n in (10**9, 0)
    )
    assert len(one) == len(two) == len(rows)
    for a, b in zip(one, two, strict=True):
        assert (a.doc_id, a.held_out, a.predicted) == (b.doc_id, b.held_out, b.predicted) and a.score == pytest.approx(b.score, abs=1e-5)
    kept = [toxicity.drop_toxic(docs, labels, n) for n in (10**9, 0)]
    assert kept[0].columns == docs.columns
    assert kept[0].count() == kept[1].count() == sum(r.predicted == 0 for r in one)


def test_unseen_grams_back_off_whatever_was_counted(spark):
    rows = [(text(i, 40), i % 2) for i in range(40)]
    counts = toxicity.gram_counts(spark.createDataFrame(rows, "text string, toxic int")).cache()
    weights, backing = toxicity.gram_weights(counts)
    grams, contexts = toxicity._by_key(weights), toxicity._by_key(backing)
    want = {r.key: r.weight for r in weights.collect()}
    assert len(grams[0]) == counts.count() == len(want)
    assert toxicity._look_up(grams, np.array(list(want))) == pytest.approx(list(want.values()))
    # Neighbours of known keys shared their slots: they are other grams, never counted.
    others = np.array([k ^ 1 for k in want if k ^ 1 not in want])
    assert np.isnan(toxicity._look_up(grams, others)).all()
    assert toxicity.evidence(["qqqqqqqq"], grams, contexts)[0] == pytest.approx(0, abs=0.2)
    assert np.isnan(toxicity._look_up((np.zeros(0, np.int64), np.zeros(0, np.float32)), others)).all()


def test_expressions_of_fold_3_only_are_learnt(spark, monkeypatch):
    texts, toxic = labelled()
    third = [i for i in texts if zlib.crc32(str(i).encode()) % 4 == 3]
    for i in third[::3]:
        texts[i], toxic[i] = f"{text(i, 20)} quuzwyth quuzwyths {text(i + 3, 20)}", 1
    texts |= {9000: f"{text(1, 20)} quuzwyth quuzwyths {text(2, 20)}", 9001: f"{text(1, 20)} {text(2, 20)}"}
    labels = spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int")
    tables, by_key = [], toxicity._by_key
    monkeypatch.setattr(toxicity, "_by_key", lambda w: tables.append(by_key(w)) or tables[-1])
    score = {r.doc_id: r.score for r in toxicity.score_documents(documents(spark, texts), labels).collect()}
    assert score[9000] >= toxicity.THRESHOLD > score[9001]
    # The curve's models have not counted the word, those of the scores have.
    grams = toxicity._gram_keys(*toxicity._letters(["quuzwyth"]), toxicity.ORDER)[1:]
    assert [bool(np.isin(grams, tables[i][0]).all()) for i in (0, -2)] == [False, True]


def test_awkward_rows_without_labels_and_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.score_documents(documents(spark, awkward()), none).collect()
    assert len(got) == len(awkward()) and all(r.score == 0 and r.predicted == 0 for r in got)
    odd = spark.createDataFrame([(0, 1), (0, 0), (5, None), (None, 1), (6, 0), (9, 7)], "doc_id long, toxic int")
    assert toxicity.score_documents(documents(spark, awkward()), odd).count() == len(awkward())
    assert toxicity.score_documents(empty(spark), none).count() == 0

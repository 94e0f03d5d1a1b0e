import random
import re

import pytest
from pyspark.sql import functions as F

from streamtally.llm import line_dedup

from .frames import awkward, documents, empty, text


def kept(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_a_repeated_passage_goes_from_later_documents(spark):
    passage = "\n".join([text(1, 30), text(2, 25)])
    rows = {1: f"{text(10, 8)}\n{passage}\n{text(11, 9)}", 2: f"{text(12, 7)}\n{text(13, 60)}\n{passage}", 3: passage, 4: text(14, 70)}
    out = kept(line_dedup.dedup_lines(documents(spark, rows)))
    assert out == {1: rows[1], 2: f"{text(12, 7)}\n{text(13, 60)}", 3: "", 4: rows[4]}
    left = line_dedup.drop_repeats(documents(spark, rows))
    assert sorted(kept(left)) == [1, 2, 4] and left.columns == documents(spark, rows).columns
    assert {r.doc_id: r.n_chars for r in left.collect()}[2] == len(out[2])


def test_matches_are_extended_both_ways(spark):
    lines = [text(i, 6) for i in range(30)]
    rows = {1: "\n".join(lines), 2: "\n".join([text(70, 6), *lines[4:22], text(71, 6)])}
    assert kept(line_dedup.dedup_lines(documents(spark, rows)))[2] == "\n".join([text(70, 6), text(71, 6)])


def test_short_repeats_stay(spark):
    rows = {1: f"{text(1, 12)}\n{text(2, 60)}", 2: f"{text(1, 12)}\n{text(3, 60)}", 3: text(1, 12)}
    assert kept(line_dedup.dedup_lines(documents(spark, rows))) == rows


def test_repeats_inside_one_document(spark):
    line = text(1, 45)
    rows = {1: f"{line}\n{text(2, 10)}\n{line}\n{text(3, 10)}\n{line}", 2: "\n".join(["go on"] * 200)}
    out = kept(line_dedup.dedup_lines(documents(spark, rows)))
    assert out[1] == f"{line}\n{text(2, 10)}\n{text(3, 10)}"
    assert len(out[2]) < len(rows[2]) and "go on" in out[2]


def test_every_repeat_of_the_guaranteed_length_is_gone(spark):
    shared = [text(i, 5 + 9 * (i % 7)) for i in range(24)]
    rows = {d: "\n".join(text(1000 * d + i, 20) if (d + i) % 5 == 0 else shared[(i + d) % 24] for i in range(30)) for d in range(12)}
    out = kept(line_dedup.dedup_lines(documents(spark, rows)))
    seen, reach = set(), line_dedup.GRAM_WORDS + line_dedup.WINDOW_WORDS
    for d in sorted(out):
        lines = [x for x in out[d].split("\n") if x.strip()]
        for i in range(len(lines)):
            size, n = 0, 0
            while i + n < len(lines) and size < reach:
                size, n = size + len(lines[i + n].split()), n + 1
            if size >= reach:
                key = tuple(lines[i : i + n])
                assert key not in seen or (d, i) == (0, 0)
                seen.add(key)


def test_awkward_rows_and_empty_table(spark):
    out = line_dedup.dedup_lines(documents(spark, awkward()))
    rows = [(r.doc_id, r.text) for r in out.collect()]
    # 0 and 4 are equal texts of 40 words; the repeated rows of document 10 are one document.
    want = [(i, "" if i == 4 else t) for i, t in awkward()]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


def test_no_python_on_the_main_path(spark):
    plan = line_dedup.dedup_lines(documents(spark, {1: "a"}))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("names", [("_did", "_seen", "_runs"), ("did", "Seen", "runs")])
def test_columns_of_any_name_pass(spark, names):
    docs = documents(spark, [*awkward(), (20, text(5, 20_000)), (21, "\n".join([text(1, 45), text(2, 9)])), (22, text(1, 45))])
    for name in names:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    out = line_dedup.drop_repeats(docs)
    rows = out.collect()
    assert out.columns == docs.columns and {20, 21} <= {r.doc_id for r in rows} and 22 not in {r.doc_id for r in rows}
    assert all(r[n] == f"{n}:{'none' if r.doc_id is None else r.doc_id}" for r in rows for n in names)


def runs_by_hand(rows, gram_words=40, window_words=10):
    """Deleted lines of every document, from all pairs of a fingerprint and the first place of its gram."""
    docs = {}
    for i, t in rows.items():
        docs[i] = [(pos, x, len(re.findall(r"[^ \t\r\x0B\f]+", x))) for pos, x in enumerate(t.split("\n")) if re.search(r"[^ \t\r\x0B\f]", x)]
    grams = {}
    for i, lines in docs.items():
        start = 0
        for k, (_, _, n) in enumerate(lines):
            held, m = 0, 0
            while k + m < len(lines) and held < gram_words:
                held, m = held + lines[k + m][2], m + 1
            grams[i, k] = (start, tuple(x for _, x, _ in lines[k : k + m]) if held >= gram_words else None)
            start += n
    gone = {i: set() for i in rows}
    places = {}
    for (i, k), (_, gram) in sorted(grams.items()):
        if gram is not None:
            places.setdefault(gram, []).append((i, k))
    for gram, where in places.items():
        (a, k), *later = where
        for b, m in later:
            x, y = docs[a], docs[b]
            fore = 0
            while k + fore < len(x) and m + fore < len(y) and x[k + fore][1] == y[m + fore][1]:
                fore += 1
            back = 0
            while back < min(k, m) and x[k - back - 1][1] == y[m - back - 1][1] and (a != b or back < m - k - 1):
                back += 1
            gone[b] |= {y[j][0] for j in range(m - back, m + fore)}
    return gone


def test_deleted_lines_against_all_pairs(spark):
    """What goes is part of what all pairs of equal grams would delete; what stays repeats no 50 words of whole lines."""
    rng = random.Random(12)
    pool = [text(100 + i, rng.randrange(3, 16)) for i in range(40)]
    rows = {}
    for i in range(30):
        lines = []
        while len(lines) < 24:
            at = rng.randrange(40)
            lines += pool[at : at + rng.randrange(1, 9)] if rng.random() < 0.5 else [text(rng.randrange(10**6), rng.randrange(2, 14)), ""]
        rows[i] = "\n".join(lines)
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(documents(spark, rows)).collect()}
    every = runs_by_hand(rows)
    deleted = 0
    for i, t in rows.items():
        lines = t.split("\n")
        stay = [x for j, x in enumerate(lines) if j not in every[i]]
        left = got[i].split("\n")
        # The lines that all pairs leave are all there, in order, and so are no others than the document's own.
        at = iter(left)
        assert all(x in at for x in stay), i
        at = iter(lines)
        assert all(x in at for x in left), i
        deleted += len(lines) - len(left)
    assert deleted > 50
    again = runs_by_hand(got, gram_words=50)
    assert not any(x for lines in again.values() for x in lines)

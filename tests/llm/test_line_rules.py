import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from streamtally.llm import line_rules

from .frames import awkward, documents, empty, text

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(t: str) -> tuple:
    words = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(8)}
    n = len(words)
    return (
        n, sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
        n < 20 or 100 * len(covered) > 30 * n,
    )


def reason(line: str) -> str | None:
    words = WORD.findall(line)
    if not words:
        return None
    separators = sum(re.fullmatch(r"[|>»·•/\\]+", w) is not None for w in words)
    said = lambda phrases: re.search("(^|[^a-z])(" + "|".join(phrases) + ")", line.lower())
    if separators >= 3 and 4 * separators >= len(words) or len(words) <= 8 and said(line_rules.LINKS):
        return "navigation"
    if len(words) <= 30 and said(line_rules.NOTICES):
        return "boilerplate"
    marks = sum(line.count(c) for c in "!#$%&*<>|^~=_")
    if not re.search(r"[.!?…。！？][\"'”’»)\]]*[\x20\x09-\x0D]*$", line) or 2 * marks > len(words):
        return "punctuation"
    return None


def verdict(t: str) -> tuple[str, bool]:
    lines = t.split("\n")
    chars = lambda some: sum(len(w) for x in some for w in WORD.findall(x))
    lost = chars(x for x in lines if reason(x))
    return "\n".join(x for x in lines if not reason(x)), not base(t)[5] and 100 * lost <= 50 * chars(lines)


PROSE = [f"{text(i, 12)}." for i in range(8)]
NAV = "Home | About | News | Contact | Jobs"


def cases():
    rng = random.Random(4)
    mixed = ["\n".join(rng.choice([*PROSE, NAV, "All rights reserved.", "no end here", "", "WOW!! " * 6, "Read more"]) for _ in range(rng.randrange(1, 9))) for _ in range(60)]
    repeats = [" ".join(rng.choice("ab") for _ in range(rng.randrange(5, 40))) for _ in range(60)]
    exact = [" ".join(f"w{i % k}" for i in range(n)) for k, n in ((8, 16), (8, 15), (9, 16), (9, 17), (20, 28), (1, 8), (1, 9), (30, 37), (30, 38))]
    long = " ".join(f"w{i}" for i in range(20_000))
    return mixed + repeats + exact + [long + ".", "so " * 20_000 + ".", (text(3, 3000) + ". ") * 2]


def test_equals_brute_force(spark):
    rows = [(100 + i, t) for i, t in enumerate(cases())] + awkward()
    got = line_rules.clean(documents(spark, rows).drop("doc_id").withColumn("doc_id", F.col("text"))).collect()
    assert len(got) == len(rows)
    for r in got:
        t = r.doc_id or ""
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(t), t[:80]
        assert (r.clean_text, r.kept) == verdict(t), t[:80]
        assert [(x.line, x.reason) for x in r.removed_lines] == [(i, reason(x)) for i, x in enumerate(t.split("\n")) if reason(x)]


def test_clean_documents_stay_and_pages_of_links_go(spark):
    prose, links = "\n".join(PROSE), "\n".join([*[NAV] * 9, PROSE[0], "© All rights reserved."])
    some = "\n".join([NAV, *PROSE, "Read more"])
    got = {r.doc_id: (r.kept, r.clean_text) for r in line_rules.clean(documents(spark, {1: prose, 2: links, 3: some})).collect()}
    assert got == {1: (True, prose), 2: (False, PROSE[0]), 3: (True, prose)}


@pytest.mark.parametrize("name", ["text2", "words", "lines", "doc", "worded", "_end", "line"])
def test_columns_of_any_name_pass(spark, name):
    docs = documents(spark, awkward()).withColumn(name, F.lit("mine")).withColumn("kept", F.lit("replaced"))
    found = line_rules.clean(docs)
    assert found.columns == [c for c in docs.columns if c not in line_rules._ADDED] + list(line_rules._ADDED)
    assert {r[name] for r in found.collect()} == {"mine"} and dict(found.dtypes)["kept"] == "boolean"


def test_nothing_leaves_the_jvm_or_its_row(spark):
    assert line_rules.clean(empty(spark)).count() == 0
    plan = line_rules.clean(documents(spark, awkward()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Exchange" not in plan

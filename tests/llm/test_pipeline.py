import hashlib
import struct
from collections import defaultdict

import xxhash
from tokenizers import Tokenizer

import __spark_entry__ as spark_entry
import corpus_pipeline
from streamtally.llm import bpe, catalog, mixing, toxicity
from streamtally.session import fresh_folder
from tests.compare import oracle_connection, oracle_rows, spark_rows, type_differences

from .frames import awkward, text
from .test_jaccard import brute as components
from .test_line_dedup import runs_by_hand
from .test_mixing_sharding import water
from .test_toxicity import labelled

FOLDER = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == columns, name
        if name != "mixing":
            assert 0 < docs.count() <= before
            before = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert last.count() == docs.count() and last.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_every_query_is_registered():
    names = spark_entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in catalog.queries()}
    assert set(catalog.queries()) | {"pipeline"} <= set(names)


def test_queries_with_sql_agree(spark):
    con = oracle_connection(FOLDER)
    for name, sql in catalog.oracles().items():
        frame = catalog.queries()[name](spark, FOLDER)
        assert type_differences(frame, con, sql) == []
        assert spark_rows(frame) == oracle_rows(con, sql)


def plain_mix(rows):
    """How often each row is taken: budgets by filling one child after another, then prefixes of the seeded order."""
    leaf = lambda r: ("even" if r[3] and r[3][-1] in "02468" else "odd", r[2] or "unknown", r[3] or "unknown")
    size, keys = defaultdict(int), defaultdict(dict)
    for r in rows:
        size[leaf(r)] += len(r[1].split())
        seen = xxhash.xxh64_intdigest(r[1].encode(), 42)
        keys[leaf(r)][r[0]] = (-(2**63) if r[0] is None else r[0], seen - (1 << 64) if seen >> 63 else seen)

    def below(path):
        found = defaultdict(float)
        for k, n in size.items():
            if n and k[: len(path)] == path:
                found[k[len(path)]] += mixing.MAX_EPOCHS * n
        return found

    weigh = lambda level: lambda k: mixing.WEIGHTS[level].get(k, 1.0)
    budget = {}
    for d, part in water(below(()), weigh("domain"), sum(size.values())).items():
        for la, piece in water(below((d,)), weigh("lang"), part).items():
            for s, rest in water(below((d, la)), weigh("source"), piece).items():
                budget[d, la, s] = int(rest + 1e-9)
    taken = []
    for k in size:
        epochs, left = divmod(budget.get(k, 0), size[k]) if size[k] else (0, 0)
        mine = [r for r in rows if leaf(r) == k]
        order = sorted(mine, key=lambda r: hashlib.md5(f"{mixing.SEED}:{epochs}:{keys[k][r[0]][0]}:{keys[k][r[0]][1]}".encode()).hexdigest())
        over = left == 0
        for r in order:
            left -= len(r[1].split())
            over |= left < 0
            taken += [r] * (epochs + (0 if over else 1))
    return taken


def test_run_against_a_plain_chain(spark):
    texts, toxic = labelled(120)
    passage = "\n".join(text(700 + i, 22) for i in range(4))
    for i in (8, 20, 36, 40):
        texts[i] = f"{text(i, 20)}\n{passage}\n{text(i + 300, 15)}"
    base = text(888, 150).split()
    for n, i in enumerate((10, 26, 32, 50)):
        texts[i] = " ".join(w if k != 7 + 40 * n else "edited" for k, w in enumerate(base))
    texts[60] = texts[12]
    awkward_rows = [(1000 + n if i is not None else None, t) for n, (i, t) in enumerate(awkward())]
    rows = [
        (i, t, None if i == 14 else ("en", "de", "fr")[(i or 0) % 3], None if i == 16 else f"src{(i or 0) % 4}", len(t or ""))
        for i, t in [*texts.items(), *awkward_rows]
    ]
    folder = fresh_folder(spark, "tables")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = spark.createDataFrame([(i, 1, t) for i, t in toxic.items()], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")

    score = {r.doc_id: r.score for r in toxicity.score_documents(docs, labels).collect()}
    kept = [r for r in rows if score[r[0]] < toxicity.THRESHOLD]
    assert len(kept) < len(rows) - 20
    # A missing id comes first.
    key = lambda i: -1 if i is None else i
    gone = runs_by_hand({key(i): t or "" for i, t, *_ in kept})
    shorter = []
    for i, t, *rest in kept:
        left = t if not gone[key(i)] else "\n".join(x for j, x in enumerate(t.split("\n")) if j not in gone[key(i)])
        if not gone[key(i)] or left.split():
            shorter.append((i, left, *rest))
    assert len(shorter) < len(kept)
    group = {i: c for i, _, c in components([(i, t) for i, t, *_ in shorter])}
    single = [r for r in shorter if r[0] is None or group[r[0]] == r[0]]
    assert len(single) <= len(shorter) - 3
    mixed = plain_mix([(i, t or "", *rest) for i, t, *rest in single])
    tokenizer = Tokenizer.from_file(bpe.tokenizer_path())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    want = []
    for i, t, *_ in mixed:
        ids = tokenizer.encode(t, add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()), key=repr) == sorted(want, key=repr)

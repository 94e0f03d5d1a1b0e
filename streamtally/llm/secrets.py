"""Operator 4: secret scans, with DataFrame functions only.

Base spans come from three patterns. The method adds the spans of other tokens that pass a battery of randomness
tests. Every token of 20 and more characters of an encoding alphabet is given the encoding it fits (hexadecimal,
base 36 or base 64) and three statistics: chi-squared against a uniform alphabet, runs of equal character classes,
serial correlation of neighbours. The null hypothesis is ordinary writing of the same length: each statistic's
p-value is the chance of looking as random as this or more so. The three are combined by Fisher's method, and a
false-discovery bound (Benjamini and Hochberg), in strata of similar length over the whole corpus, says which stand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import register, table

KINDS = ("assign", "access", "hex")
ASSIGN = r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
TWO_KINDS = "[0-9]|[a-z].*[A-Z]|[A-Z].*[a-z]"
FALSE_DISCOVERIES = 0.01
# Of each encoding its alphabet in order, and the chance that two letters of ordinary writing agree.
ALPHABETS = {
    "hex": ("0123456789abcdef", 0.10),
    "base36": ("0123456789abcdefghijklmnopqrstuvwxyz", 0.065),
    "base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 0.065),
}
# In ordinary writing: how often the class of character changes, and how strongly neighbours are related.
CLASS_CHANGES = 0.15
NEIGHBOURS = 0.3
# No single p-value may be above this.
AGAINST = 0.85
# Strata hold lengths from one power of two to the next; p-values fall into bins of a quarter of a natural logarithm.
BINS = 4.0


_PLACES = "array<struct<s:bigint,e:bigint,m:string,g:string>>"


def _let(body, **values: Column) -> Column:
    """``body`` of a struct of values, each computed once however often the body names it."""
    return F.element_at(F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), body), 1)


def _with_matches(rows: DataFrame, name: str, pattern: str, group: int = 0) -> DataFrame:
    """Adds the matches of a pattern in ``text``, leftmost and not overlapping: start, end (code points), the match
    and one group of it.

    The matches and the pieces between them are cut out once each; a place is the length of all before it."""
    found = rows.withColumn("_found", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    any_ = F.size("_found") > 0
    inner = F.regexp_extract_all("text", F.lit(pattern), F.lit(group)) if group else F.col("_found")
    cut = found.withColumns(
        {
            "_inner": F.when(any_, inner).otherwise(F.array().cast("array<string>")),
            "_skips": F.when(any_, F.transform(F.split("text", pattern, -1), lambda p: F.length(p))).otherwise(F.array().cast("array<int>")),
        }
    )
    lengths = F.zip_with(
        F.arrays_zip("_found", "_inner"), F.slice("_skips", 1, F.size("_found")), lambda m, p: F.struct(p.alias("skip"), m["_found"].alias("m"), m["_inner"].alias("g"))
    )
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_PLACES).alias("out"))
    walked = F.aggregate(
        lengths,
        start,
        lambda acc, x: _let(
            lambda v: F.struct(
                v["e"].alias("at"),
                F.concat(acc["out"], F.array(F.struct(v["s"].alias("s"), v["e"].alias("e"), x["m"].alias("m"), x["g"].alias("g")))).alias("out"),
            ),
            s=(acc["at"] + x["skip"]).cast("long"),
            e=(acc["at"] + x["skip"] + F.length(x["m"])).cast("long"),
        ),
        lambda acc: acc["out"],
    )
    return cut.withColumn(name, F.when(F.size("_found") > 0, walked).otherwise(F.array().cast(_PLACES))).drop("_found", "_inner", "_skips")


def _normal_of(z: Column) -> Column:
    """The standard normal distribution function, by its logistic approximation."""
    return _let(
        lambda x: 1 / (1 + F.exp(-(1.5976 * x["z"] + 0.07056 * x["z"] * x["z"] * x["z"]))),
        z=F.greatest(F.least(z, F.lit(8.0)), F.lit(-8.0)),
    )


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def _neighbours(values: Column, join) -> Column:
    """``join`` of each element and its successor."""
    rest = F.greatest(F.size(values) - 1, F.lit(0))
    return F.zip_with(F.slice(values, 1, rest), F.slice(values, 2, rest), join)


def log_p(token: Column) -> Column:
    """-ln of the combined p-value of a token: large where ordinary writing of its length would not look like it."""
    return _let(_encoded, s=F.regexp_replace(token, "=+$", ""))


def _encoded(x: Column) -> Column:
    s, lower = x["s"], F.lower(x["s"])
    one_case = (s == lower) | (s == F.upper(s))
    encoding = (
        F.when(lower.rlike("^[0-9a-f]+$") & one_case, F.lit("hex"))
        .when(lower.rlike("^[0-9a-z]+$") & one_case, F.lit("base36"))
        .otherwise(F.lit("base64"))
    )
    return _let(_tokenised, s=s, encoding=encoding)


def _tokenised(x: Column) -> Column:
    s, encoding = x["s"], x["encoding"]
    letters = F.when(encoding == "base64", F.translate(s, "-_", "+/")).otherwise(F.lower(s))
    alphabet = F.coalesce(*[F.when(encoding == name, F.lit(letters_)) for name, (letters_, _) in ALPHABETS.items()])
    agree = F.coalesce(*[F.when(encoding == name, F.lit(chance)) for name, (_, chance) in ALPHABETS.items()])
    # Separators belong to no class of their own: words joined by them do not change class.
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(s, "[A-Z]", "A"), "[a-z]", "a"), "[0-9]", "0")
    kinds = F.regexp_replace(kinds, "[-_/+]", "")
    # Nor does a capital that begins a word: names joined in camel case are writing.
    kinds = F.regexp_replace(kinds, "Aa", "aa")
    split = lambda c: F.filter(F.split(c, ""), lambda one: one != "")
    return _let(
        _counted,
        letters=letters,
        alphabet=alphabet,
        agree=agree,
        k=F.length(alphabet).cast("double"),
        n=F.greatest(F.length(s), F.lit(2)).cast("double"),
        chars=split(letters),
        classes=split(kinds),
    )


def _counted(x: Column) -> Column:
    # Squared counts of the characters, places in the alphabet, changes of class.
    squares = _sum(
        F.transform(
            F.array_distinct(x["chars"]),
            lambda c: F.pow((F.length(x["letters"]) - F.length(F.replace(x["letters"], c, F.lit("")))).cast("double"), F.lit(2.0)),
        )
    )
    return _let(
        _centred,
        k=x["k"],
        n=x["n"],
        excess=(x["n"] - 1) * (x["k"] * x["agree"] - 1),
        squares=squares,
        places=F.transform(x["chars"], lambda c: F.instr(x["alphabet"], c).cast("double")),
        changes=_sum(_neighbours(x["classes"], lambda a, b: (a != b).cast("double"))),
    )


def _centred(x: Column) -> Column:
    return _let(
        _tested,
        k=x["k"], n=x["n"], excess=x["excess"], squares=x["squares"], changes=x["changes"],
        off=_let(lambda y: F.transform(y["p"], lambda v: v - y["mean"]), p=x["places"], mean=_sum(x["places"]) / x["n"]),
    )


def _tested(x: Column) -> Column:
    k, n = x["k"], x["n"]
    # Chi-squared of the counts against a uniform alphabet; not central under ordinary writing.
    chi = (x["squares"] * k / n - n - (k - 1) - x["excess"]) / F.sqrt(2 * (k - 1) + 4 * x["excess"])
    runs = (x["changes"] - (n - 1) * CLASS_CHANGES) / F.sqrt((n - 1) * CLASS_CHANGES * (1 - CLASS_CHANGES))
    spread = _sum(F.transform(x["off"], lambda v: v * v))
    together = _sum(_neighbours(x["off"], lambda a, b: a * b))
    serial = _let(lambda y: (F.abs(F.when(y["v"] > 0, y["c"] / y["v"]).otherwise(1.0)) - NEIGHBOURS) * F.sqrt(n), v=spread, c=together)
    return _let(_combined, chi=_normal_of(chi), runs=1 - _normal_of(runs), serial=_normal_of(serial))


def _combined(x: Column) -> Column:
    parts = [x["chi"], x["runs"], x["serial"]]
    total = sum((-F.log(F.greatest(p, F.lit(1e-15))) for p in parts), F.lit(0.0))
    # Fisher: twice the sum is chi-squared with six degrees of freedom, whose tail has a closed form. A token that
    # one test finds to be like most ordinary writing is no candidate, however the others see it.
    score = _let(lambda y: y["t"] - F.log(1 + y["t"] + y["t"] * y["t"] / 2), t=total)
    return F.when(F.greatest(*parts) > AGAINST, 0.0).otherwise(score)


def _stratum(span: Column) -> Column:
    return F.floor(F.log2((span["e"] - span["s"]).cast("double"))).cast("int")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, base (kind, s, e) and added spans of every row, and nothing of the text.

    Places are code points, ends exclusive. Null and empty texts have no spans; repeated rows are scanned alike and
    count each in the false-discovery bound; whole texts are scanned, however long; an empty table has no rows; other
    columns are ignored. A token is a candidate if it holds a digit or letters of both cases."""
    from streamtally.session import stored

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    for name, pattern, group in (("assign", ASSIGN, 2), ("access", ACCESS, 0), ("hex", HEX, 0), ("candidates", CANDIDATE, 0)):
        rows = _with_matches(rows, name, pattern, group)
    places = lambda k: F.transform(k, lambda m: F.struct(m["s"].alias("s"), m["e"].alias("e")))
    spans = rows.select(
        "doc_id",
        places(F.filter("assign", lambda m: F.length(m["g"]) >= 8)).alias("assign"),
        places("access").alias("access"),
        places("hex").alias("hex"),
        "candidates",
    )
    # A token of one case and no digit is a word or several: no test would call it random.
    tested = F.transform(
        F.filter("candidates", lambda m: m["m"].rlike(TWO_KINDS)),
        lambda m: F.struct(m["s"].alias("s"), m["e"].alias("e"), log_p(m["m"]).alias("score")),
    )
    scanned = stored(spans.select("doc_id", *KINDS, tested.alias("tested")), "scanned")

    # Benjamini and Hochberg over bins: the least score of a stratum whose expected false share is low enough.
    scored = scanned.select(F.explode("tested").alias("t")).select(_stratum(F.col("t")).alias("stratum"), F.floor(F.col("t.score") * BINS).cast("int").alias("bin"))
    bins = scored.groupBy("stratum", "bin").agg(F.count("*").alias("n"))
    stratum = Window.partitionBy("stratum")
    ranked = bins.withColumn("rank", F.sum("n").over(stratum.orderBy(F.desc("bin")))).withColumn("m", F.sum("n").over(stratum))
    allowed = ranked.filter(F.exp(-F.col("bin") / BINS) * F.col("m") <= FALSE_DISCOVERIES * F.col("rank"))
    limits = allowed.groupBy("stratum").agg(F.min("bin").alias("bin"))
    # One number per power of two of a token's length: at most 32 entries.
    least = {r.stratum: r.bin for r in limits.collect()}
    passes = (lambda t: F.lit(False)) if not least else (
        lambda t: F.floor(t["score"] * BINS) >= F.coalesce(*[F.when(_stratum(t) == k, F.lit(v)) for k, v in sorted(least.items())], F.lit(2**31 - 1))
    )
    return scanned.select("doc_id", *KINDS, F.filter("tested", passes).alias("random"))


def _tagged(kind: str):
    order = (*KINDS, "random").index(kind)
    return lambda m: F.struct(m["s"].alias("s"), F.lit(order).alias("o"), m["e"].alias("e"), F.lit(kind).alias("k"))


def digests(found: DataFrame) -> DataFrame:
    def listed(kinds: tuple[str, ...]) -> Column:
        parts = [
            F.transform(k, _tagged(k))
            for k in kinds
        ]
        rows = F.array_sort(F.concat(*parts))
        return F.array_join(F.transform(rows, lambda r: F.concat_ws(":", r["k"], r["s"].cast("string"), r["e"].cast("string"))), ",")

    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(KINDS).cast("binary"), 256).alias("base_sha256"),
        listed((*KINDS, "random")).alias("spans"),
        F.size("random").cast("long").alias("n_random"),
    )


@register()
def op4_secret_battery(spark: SparkSession, folder: str) -> DataFrame:
    return digests(scan(table(spark, folder, "documents")))

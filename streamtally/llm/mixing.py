"""Operator 9: mixing sources to target weights by hierarchical budgeting.

Documents hang on the leaves of a domain-language-source tree. The token budget flows from the root down: at every
inner node it is shared by the children's weights, no child gets more than its documents can give in the allowed
number of epochs, and what a child cannot use goes to its siblings first; only what a whole subtree cannot use
reaches the subtree's siblings. Each leaf then takes its documents in seeded epochs: whole epochs, and of the last
one the prefix of its seeded order that stays within the budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import NO_ID, merged, register, row_key, table, unused

LEVELS = ("domain", "lang", "source")
# Target weights; names that are not listed weigh DEFAULT_WEIGHT.
WEIGHTS = {"domain": {"even": 2.0}, "lang": {"en": 4.0}, "source": {"src0": 10.0}}
DEFAULT_WEIGHT = 1.0
BUDGET_SHARE = 1.0
MAX_EPOCHS = 2
SEED = "mix-1"
# A leaf's seeded order is cut in two steps of so many hash digits (of 16 values) each.
DIGITS = 3


def default_domain() -> Column:
    """The documents name no domain: sources are grouped by their last digit, even or odd."""
    return F.when(F.col("source").rlike("[02468]$"), "even").otherwise("odd")


def leaves_of(docs: DataFrame, domain: Column | None = None) -> DataFrame:
    """Key, leaf and number of words of every row; null languages and sources are leaves named unknown."""
    did, seen = row_key(docs)
    text = F.coalesce(F.col("text"), F.lit(""))
    # A word ends where no white space follows a letter: counted by what splitting at white space leaves.
    words = F.size(F.filter(F.split(text, r"[ \t\n\x0B\f\r]+"), lambda w: w != ""))
    return docs.select(
        did.alias("did"),
        seen.alias("seen"),
        F.coalesce(default_domain() if domain is None else domain, F.lit("unknown")).alias("domain"),
        F.coalesce("lang", F.lit("unknown")).alias("lang"),
        F.coalesce("source", F.lit("unknown")).alias("source"),
        words.cast("long").alias("n_tokens"),
    )


def _weight(level: str, weights: dict[str, dict[str, float]]) -> Column:
    named = weights.get(level, {})
    cases = [F.when(F.col(level) == name, F.lit(float(w))) for name, w in named.items()]
    return F.coalesce(*cases, F.lit(DEFAULT_WEIGHT))


def budgets(available: DataFrame, total: int, weights: dict[str, dict[str, float]] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Of every leaf (domain, lang, source, n_tokens) the budget in whole tokens.

    At each node the children are ordered by what they can give per unit of weight; a child is filled up as long as
    its share at equal filling of the rest would exceed what it can give. All as window sums over the siblings."""
    level_rows = available.withColumn("can_give", F.col("n_tokens") * max_epochs)
    shares = None
    for depth, level in enumerate(LEVELS):
        path = list(LEVELS[: depth + 1])
        parents = path[:-1]
        children = level_rows.groupBy(*path).agg(F.sum("can_give").alias("can_give")).withColumn("weight", _weight(level, weights))
        if shares is None:
            children = children.withColumn("share", F.lit(int(total)).cast("double"))
        else:
            children = merged(children, shares.withColumnRenamed("budget", "share"), parents)
        siblings = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
        ordered = siblings.orderBy(F.col("can_give") / F.col("weight"), level)
        before = ordered.rowsBetween(Window.unboundedPreceding, -1)
        rest_weight = F.sum("weight").over(siblings) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
        rest_share = F.col("share") - F.coalesce(F.sum("can_give").over(before), F.lit(0))
        filled = children.withColumns({"rest_weight": rest_weight, "rest_share": rest_share}).withColumn(
            "full", F.col("can_give") * F.col("rest_weight") <= F.col("rest_share") * F.col("weight")
        )
        # From the first child that is not filled up on, the rest is shared at one rate.
        first_open = F.min(F.when(~F.col("full"), F.struct((F.col("can_give") / F.col("weight")).alias("r"), F.col(level).alias("name"),
                                                           (F.col("rest_share") / F.col("rest_weight")).alias("rate")))).over(siblings)
        shares = filled.withColumn("open", first_open).select(
            *path,
            F.when(F.col("open").isNull(), F.col("can_give").cast("double"))
            .when(F.struct((F.col("can_give") / F.col("weight")).alias("r"), F.col(level).alias("name"))
                  < F.struct(F.col("open.r").alias("r"), F.col("open.name").alias("name")), F.col("can_give").cast("double"))
            .otherwise(F.col("open.rate") * F.col("weight")).alias("budget"),
        )
    return merged(available, shares, list(LEVELS)).withColumn("budget", F.floor("budget").cast("long"))


def _order(seed: str, epoch: Column) -> Column:
    """The seeded order of an epoch."""
    return F.md5(F.concat_ws(":", F.lit(seed), epoch.cast("string"), F.col("did").cast("string"), F.col("seen").cast("string")))


def mix(docs: DataFrame, share: float = BUDGET_SHARE, weights: dict[str, dict[str, float]] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
        seed: str = SEED, domain: Column | None = None) -> DataFrame:
    """did, seen (the key of a row), leaf, n_tokens, budget of the leaf and n_copies: how often the row is taken.

    The budget is ``share`` of all words. Empty and null texts weigh nothing; they come with every whole epoch and
    with the prefix they fall into. Repeated rows share a key and stand next to each other in every order; each
    counts with its own tokens and is taken or left like its twins, so that a budget may be missed by a group of
    twins, never exceeded. An empty table gives no rows."""
    from streamtally.session import stored

    rows = stored(leaves_of(docs, domain), "leaves")
    path = list(LEVELS)
    available = stored(rows.groupBy(*path).agg(F.sum("n_tokens").alias("n_tokens")), "available")
    total = available.agg(F.sum("n_tokens")).first()[0] or 0
    plan = stored(budgets(available.filter("n_tokens > 0"), int(total * share), weights, max_epochs), "budgets")
    plan = merged(available.select(*path), plan, path, "left").select(
        *path,
        F.coalesce("budget", F.lit(0)).alias("budget"),
        F.coalesce(F.floor(F.col("budget") / F.col("n_tokens")).cast("long"), F.lit(0)).alias("epochs"),
        F.coalesce(F.col("budget") % F.col("n_tokens"), F.lit(0)).alias("left_over"),
    )
    # Twins together; the order of the last epoch as a hash whose leading digits are bins.
    keyed = rows.groupBy("did", "seen", *path).agg(F.sum("n_tokens").alias("group_tokens"), F.max("n_tokens").alias("n_tokens")).join(plan, path)
    keyed = stored(keyed.withColumn("at", _order(seed, F.col("epochs"))), "ordered")
    first, second = F.substring("at", 1, DIGITS), F.substring("at", 1, 2 * DIGITS)

    def cut(part: DataFrame, bin_: Column, before: str) -> DataFrame:
        """Tokens that come before each bin of a leaf."""
        sums = part.groupBy(*path, bin_.alias("bin")).agg(F.sum("group_tokens").alias("tokens"))
        earlier = Window.partitionBy(*path).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        return sums.withColumn(before, F.coalesce(F.sum("tokens").over(earlier), F.lit(0)))

    coarse = cut(keyed, first, "earlier")
    # Only in the one bin that the budget ends in does the exact order matter: cut it finer, then row by row.
    edge = stored(
        merged(coarse, plan.select(*path, "left_over"), path)
        .filter("earlier <= left_over and earlier + tokens > left_over")
        .groupBy(*path).agg(F.min("bin").alias("edge"), F.min("earlier").alias("earlier")), "edges")
    near = keyed.join(edge, path).filter(first == F.col("edge"))
    fine = merged(merged(cut(near, second, "within"), edge, path), plan.select(*path, "left_over"), path)
    fine_edge = stored(
        fine.filter("earlier + within <= left_over and earlier + within + tokens > left_over")
        .groupBy(*path).agg(F.min("bin").alias("fine_edge"), F.min(F.col("earlier") + F.col("within")).alias("fine_earlier")), "fine-edges")
    running = Window.partitionBy(*path).orderBy("at", "did", "seen").rowsBetween(Window.unboundedPreceding, 0)
    last = (
        keyed.join(fine_edge, path).filter(second == F.col("fine_edge"))
        .withColumn("through", F.col("fine_earlier") + F.sum("group_tokens").over(running))
        .filter("through <= left_over").select("did", "seen", *path, F.lit(1).alias("in_last"))
    )
    placed = keyed.join(fine_edge.select(*path, "fine_edge"), path, "left").join(last.hint("merge"), ["did", "seen", *path], "left")
    extra = F.when(F.col("left_over") == 0, 0).when(F.col("fine_edge").isNull(), F.lit(1)).when(second < F.col("fine_edge"), 1).otherwise(F.coalesce("in_last", F.lit(0)))
    return placed.select("did", "seen", *path, "n_tokens", "budget", (F.col("epochs") + extra).cast("long").alias("n_copies"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns, whatever their names.

    Null ids, empty and null texts, repeated rows and empty tables as in :func:`mix`: twins are taken or left together."""
    from streamtally.session import stored

    taken = stored(mix(docs, **options).filter("n_copies > 0").select("did", "seen", "n_copies").groupBy("did", "seen").agg(F.max("n_copies").alias("n_copies")), "taken")
    did, seen = row_key(docs)
    id_, hash_, copies, copy = unused(docs, "did", "seen", "copies", "copy")
    keyed = docs.withColumns({id_: did, hash_: seen})
    rows = merged(keyed, taken.select(F.col("did").alias(id_), F.col("seen").alias(hash_), F.col("n_copies").alias(copies)), [id_, hash_])
    return rows.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).select(*[F.col(f"`{c}`") for c in docs.columns])


@register()
def op9_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = mix(docs)
    # Rows without doc_id have a key of their own in the mix.
    doc_id = F.nullif(F.col("did"), F.lit(NO_ID)).alias("doc_id")
    return found.select(doc_id, *LEVELS, "n_tokens", "budget", "n_copies")

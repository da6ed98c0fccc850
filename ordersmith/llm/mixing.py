"""Mixing sources to target weights over a domain, language, source tree.

A token budget flows down the tree.  At each node the children share it by
their weights, none above what its leaves can give; what a child cannot take
goes to its siblings in proportion to their weights, and only what a whole
subtree cannot take goes back to the ancestors.  A leaf can give its tokens
``epochs`` times.  It gives the prefix of a sequence: its documents in a seeded
order, then in the next epoch's order, until its budget is reached; the last
document is taken in part.

Null ``lang`` and ``source`` are the leaf value ``unknown``; null texts have no
tokens.  Children without a given weight share equally what ``other`` weighs.
Rows with equal id and text keep an order of their own only up to that tie.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

#: Words, as every engine's regular expressions read them.
WORD = "[^\\x20\\x09-\\x0D]+"
#: A leaf's documents are dealt out by hash to this many slices; only the slice in
#: which the budget ends is ordered by row, so no leaf is ever sorted whole.
SLICES = 4096
#: Slices whose tokens are summed up together first, so that no task orders all slices of a leaf.
RUN = 64


@dataclass(frozen=True)
class Mix:
    """``weights[level][value]``; a value not named weighs ``other``."""
    weights: dict[str, dict[str, float]] = field(default_factory=dict)
    other: float = 1.0
    #: Tokens wanted, as a share of those available.
    share: float = 0.5
    epochs: int = 2
    seed: int = 17


LEVELS = ("domain", "lang", "source")
#: Weights of the query and of the pipeline.
PRODUCTION = Mix(weights={"domain": {"core": 3.0, "wide": 2.0, "tail": 1.0}, "lang": {"en": 4.0, "de": 2.0, "fr": 2.0, "es": 2.0}})


def domain_of(source: Column) -> Column:
    """The domain of a source: by its number, if its name ends with one, else ``tail``."""
    n = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    return F.when(n == "", "tail").when(n.cast("int") % 5 == 0, "core").when(n.cast("int") % 5 <= 2, "wide").otherwise("tail")


def _named(level: Column) -> Column:
    return F.coalesce(level.cast("string"), F.lit("unknown"))


def leaves_of(docs: DataFrame) -> DataFrame:
    """``doc_id``, text, tree levels and token count of each row."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), _named(F.col("lang")).alias("lang"), _named(F.col("source")).alias("source"))
    return d.withColumns({"domain": domain_of(F.col("source")), "tokens": F.size(F.split(F.concat(F.lit(" "), "text"), "[\\x20\\x09-\\x0D]+(?=[^\\x20\\x09-\\x0D])")).cast("long") - 1})


def _weight(level: str, mix: Mix) -> Column:
    named = mix.weights.get(level, {})
    out = F.lit(float(mix.other))
    for k, v in named.items():
        out = F.when(F.col(level) == k, F.lit(float(v))).otherwise(out)
    return out


def _fill(nodes: DataFrame, parents: list[str], level: str) -> DataFrame:
    """Share each parent's ``budget`` among its children by weight, none above ``cap``.

    Sorted by cap per weight, the children that are filled come first: the
    k-th is filled if its cap is at most its part of what those before it left.
    """
    by = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    order = [F.col("cap") / F.col("w"), F.col(level)]
    up = by.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    down = by.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    n = nodes.withColumns({"taken": F.coalesce(F.sum("cap").over(up), F.lit(0.0)), "rest_w": F.sum("w").over(down)})
    n = n.withColumn("full", F.col("cap") * F.col("rest_w") <= F.col("w") * (F.col("budget") - F.col("taken")))
    whole = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    n = n.withColumns({"spent": F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(whole), F.lit(0.0)), "open_w": F.sum(F.when(~F.col("full"), F.col("w"))).over(whole)})
    return n.withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise((F.col("budget") - F.col("spent")) * F.col("w") / F.col("open_w"))).drop("taken", "rest_w", "full", "spent", "open_w")


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``domain``, ``lang``, ``source``, ``tokens`` available and ``budget`` (whole tokens) of each leaf."""
    leaf = leaves.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    leaf = leaf.withColumn("cap", (F.col("tokens") * mix.epochs).cast("double"))
    top = leaf.agg(F.floor(F.sum("tokens") * F.lit(mix.share)).cast("double").alias("budget"))
    n = leaf.groupBy("domain").agg(F.sum("cap").alias("cap")).withColumn("w", _weight("domain", mix)).crossJoin(F.broadcast(top))  # one row
    n = _fill(n, [], "domain")
    for i, level in enumerate(LEVELS[1:], 1):
        parents = list(LEVELS[:i])
        child = leaf.groupBy(*LEVELS[:i + 1]).agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens")).withColumn("w", _weight(level, mix))
        n = _fill(child.join(n.select(*parents, "budget"), parents), parents, level)
    return n.select(*LEVELS, "tokens", F.floor(F.col("budget") + 1e-6).cast("long").alias("budget"))


def _key(mix: Mix, epoch: Column, doc_id: Column, h: Column) -> Column:
    """A row's place in an epoch's order; its first three digits are the slice.  Equal only for equal id and text."""
    return F.md5(F.concat_ws("|", F.lit(str(mix.seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")), h).cast("binary"))


def _narrow(docs: DataFrame) -> DataFrame:
    """Each row with tokens, without its text: id, leaf, tokens and the md5 of the text."""
    return written(leaves_of(docs).select("doc_id", *LEVELS, "tokens", F.md5("text").alias("h")).where("tokens > 0"), "mix-docs")


def _epochs(one: DataFrame, mix: Mix) -> DataFrame:
    """Each row once per epoch, with its ``key`` and ``slice`` there."""
    e = one.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(mix.epochs - 1))))
    e = e.withColumn("key", _key(mix, F.col("epoch"), F.col("doc_id"), F.col("h")))
    return e.withColumn("slice", F.conv(F.substring("key", 1, 3), 16, 10).cast("int"))


def _slices(e: DataFrame, plan: DataFrame) -> DataFrame:
    """Of each leaf the slices that give tokens: those wholly ``inside`` the budget,
    and at most one in which it ends."""
    sums = e.groupBy(*LEVELS, "epoch", "slice").agg(F.sum("tokens").alias("slice_tokens"))
    sums = written(sums.withColumn("run", F.floor(F.col("slice") / RUN)), "mix-sums")
    # tokens before a slice: those before its run of slices, and those before it in the run
    runs = sums.groupBy(*LEVELS, "epoch", "run").agg(F.sum("slice_tokens").alias("run_tokens"))
    above = Window.partitionBy(*LEVELS).orderBy("epoch", "run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("run_before", F.coalesce(F.sum("run_tokens").over(above), F.lit(0))).drop("run_tokens")
    within = Window.partitionBy(*LEVELS, "epoch", "run").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("in_run", F.coalesce(F.sum("slice_tokens").over(within), F.lit(0)))
    sums = sums.join(runs, [*LEVELS, "epoch", "run"]).withColumn("before", F.col("run_before") + F.col("in_run"))
    sums = sums.join(plan.select(*LEVELS, "budget"), list(LEVELS)).where("before < budget")
    sums = sums.select(*LEVELS, "epoch", "slice", "before", "budget", (F.col("before") + F.col("slice_tokens") <= F.col("budget")).alias("inside"))
    return written(sums, "mix-slices")


def _edge(j: DataFrame) -> DataFrame:
    """Rows of the slices in which a budget ends, and what is taken of them."""
    edge = Window.partitionBy(*LEVELS, "epoch", "slice").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    part = j.where("not inside").withColumn("at", F.col("before") + F.coalesce(F.sum("tokens").over(edge), F.lit(0)))
    return part.withColumn("taken", F.least(F.col("tokens"), F.col("budget") - F.col("at"))).where("taken > 0")


def mix_sources(docs: DataFrame, mix: Mix = PRODUCTION) -> DataFrame:
    """Rows ``doc_id, domain, lang, source, tokens, epoch, taken``: how many tokens of
    which document each epoch gives; ``taken`` is at least 1."""
    one = _narrow(docs)
    e = _epochs(one, mix)
    j = e.join(_slices(e, budgets(one, mix)), [*LEVELS, "epoch", "slice"])
    cols = ["doc_id", *LEVELS, "tokens", "epoch"]
    whole = j.where("inside").select(*cols, F.col("tokens").alias("taken"))
    return whole.unionByName(_edge(j).select(*cols, "taken"))


def last_taken(docs: DataFrame, mix: Mix) -> DataFrame:
    """``lang``, ``source`` and ``last``: of each leaf that gives tokens, the place
    (epoch, key) up to which it gives them.  One row per leaf, whatever its rows."""
    one = _narrow(docs)
    e = _epochs(one, mix)
    sums = _slices(e, budgets(one, mix))
    # "g" follows every hexadecimal digit: the end of a slice that is taken whole
    ends = sums.where("inside").select(*LEVELS, F.struct("epoch", F.concat(F.lpad(F.lower(F.hex("slice")), 3, "0"), F.lit("g")).alias("key")).alias("last"))
    rows = _edge(e.join(sums.where("not inside"), [*LEVELS, "epoch", "slice"])).select(*LEVELS, F.struct("epoch", "key").alias("last"))
    # the domain is a function of the source
    return ends.unionByName(rows).groupBy("lang", "source").agg(F.max("last").alias("last"))


def keep_mixed(docs: DataFrame, mix: Mix) -> DataFrame:
    """The rows, all columns, that the mixture takes tokens of, whole and once.

    The first epoch comes first, so a row is taken if its place there is not past
    its leaf's last one.  The table of last places has a row per leaf, so it
    does not grow with the documents and no text is shuffled; of rows repeated
    with one id and text all stay if one does."""
    last = written(last_taken(docs, mix).select(F.col("lang").alias("m_lang"), F.col("source").alias("m_source"), F.col("last").alias("m_last")), "mix-last")
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    place = F.struct(F.lit(0).alias("epoch"), _key(mix, F.lit(0), docs["doc_id"].cast("long"), F.md5(text)).alias("key"))
    leaf = (_named(docs["lang"]) == last["m_lang"]) & (_named(docs["source"]) == last["m_source"])
    return docs.join(last, leaf & text.rlike(WORD) & (place <= last["m_last"]), "left_semi")

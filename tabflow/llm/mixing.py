"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source has a target, a number of size units (words, tokens). A target
takes a source's documents whole: complete epochs first, then a sample for the
rest. In the sample each document has the exponential key -ln(u) / weight, u
uniform from a keyed hash of the document and weight its quality weight;
documents are sorted by key within their source and their sizes summed up.
Those whose middle lies within the budget are taken, so what a source gives is
at most half a document away from its target.

Targets share the sum of all sizes by source weight. A target stops at
``max_epochs`` times its source's size; the excess goes to the others by
weight, round by round until none is above. All sums are exact whole numbers
and the keys are functions of the documents, so reruns agree.

Only DataFrame functions are used. Sources are counted by partial aggregates
and numbered over ranges; prefix sums run in ranges of bounded size, so a
source that holds most rows is spread over many tasks, and equal rows too.

Edge cases: a null text has size 0; null is a source of its own, the last one;
rows with a null or repeated doc_id are documents of their own; rows that are
equal in id, text, source and weight are exchanged freely; a weight that is
null or not above 0 counts as ``LEAST_WEIGHT``; sources without size get the
target 0; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import NOT_SPACE, materialize
from tabflow.llm.order import ordered

LEAST_WEIGHT = 1e-6
_HEX_DIGITS = 13  # 52 bits of a uniform number


def word_count(text: Column) -> Column:
    """Number of maximal runs without white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(f"{NOT_SPACE}+")), F.lit(0)).cast("long")


def uniform(seed: int, doc_id: Column, text: Column) -> Column:
    """A number above 0 and below 1 from the seed, the id and the text."""
    whole = F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("-")), F.md5(F.coalesce(text, F.lit(""))))
    digits = F.conv(F.substring(F.md5(whole), 1, _HEX_DIGITS), 16, 10).cast("long")
    return (digits + F.lit(0.5)) / F.lit(float(16**_HEX_DIGITS))


def targets(sources: DataFrame, weights: Sequence[int], max_epochs: int) -> DataFrame:
    """_group, target of each source. ``sources``: a table of _group (its
    number) and _group_size; weights repeat over the numbers.

    Each round is one aggregate: the shared size and weight of the sources not
    yet at their limit. A round that finds no other one above it is the last."""
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("weights must be above 0")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), F.pmod("_group", F.lit(len(weights))).cast("int") + 1)
    exact = "decimal(38,0)"
    own = sources.select("_group", weight.cast(exact).alias("weight"), (F.col("_group_size") * max_epochs).cast(exact).alias("limit"))
    own = materialize(own, "mix-sources")
    total = own.agg(F.sum("limit").alias("limits")).first()["limits"]
    if not total:  # no source, or none with a size
        return own.select("_group", F.lit(0.0).alias("target"))
    total = int(total) // max_epochs
    at_limit, shared, among = F.lit(False), total, 0
    before = None
    while True:
        left = own.agg(
            F.coalesce(F.sum(F.when(at_limit, F.col("limit"))), F.lit(0)).alias("full"),
            F.coalesce(F.sum(F.when(~at_limit, F.col("weight"))), F.lit(0)).alias("among"),
        ).first()
        shared, among = total - int(left["full"]), int(left["among"])
        if (shared, among) == before or not among:
            break
        before = shared, among
        # target = weight * shared / among reaches the limit; whole numbers on both sides
        at_limit = F.col("limit") * F.lit(among).cast("decimal(19,0)") <= F.col("weight") * F.lit(shared).cast("decimal(19,0)")
    share = (F.col("weight") * F.lit(shared).cast("decimal(19,0)")).cast("double") / F.lit(float(among or 1))
    return own.select("_group", F.when(at_limit, F.col("limit").cast("double")).otherwise(share).alias("target"))


def measure(docs: DataFrame, seed: int = 0, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, source, size (words) and draw (the uniform number) of ``docs``
    (doc_id, source, text): all that the mix needs of the texts, so that
    weights are joined to narrow rows. Columns in ``carry`` are kept."""
    draw = uniform(seed, F.col("doc_id"), F.col("text"))
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), draw.alias("draw"), *carry)


def mix(measured: DataFrame, weights: Sequence[int], max_epochs: int = 3) -> DataFrame:
    """doc_id, source, size, source_size, target, epochs (complete ones of the
    source), sampled (one time more) and taken (size units over all times).
    ``measured``: doc_id, source, size, draw and weight (quality, above 0);
    ``weights`` of the sources repeat in the order of their names."""
    weight = F.when(F.col("weight") > LEAST_WEIGHT, F.col("weight").cast("double")).otherwise(F.lit(LEAST_WEIGHT))
    key = (-F.log("draw") / weight).alias("_key")
    narrow = measured.select("doc_id", "source", F.col("source").isNull().alias("_no_source"), "size", key)
    places = ordered(materialize(narrow, "mix-documents"), ["_no_source", "source"], ["_key", "doc_id", "size"], "size")
    rows = places.rows(targets(places.groups(), weights, max_epochs))
    source_size, target = F.col("_group_size").cast("long"), F.col("target")
    epochs = F.when(source_size > 0, F.least(F.floor(target / source_size), F.lit(max_epochs))).otherwise(0).cast("int")
    rows = rows.withColumns({"source_size": source_size, "epochs": epochs})
    budget = F.col("target") - F.col("epochs") * F.col("source_size")
    sampled = (F.col("epochs") < max_epochs) & (2 * F.col("_before") + F.col("size") <= 2 * budget) & (F.col("size") > 0)
    rows = rows.withColumn("sampled", sampled)
    taken = (F.col("size") * (F.col("epochs") + F.col("sampled").cast("int"))).cast("long")
    return rows.select("doc_id", "source", "size", "source_size", "target", "epochs", "sampled", taken.alias("taken"))

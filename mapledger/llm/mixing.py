"""Mixing to target weights with soft memberships.

Domains are what the labelled table tells apart: clean, toxic and poor documents. A classifier learned from a
bounded sample of labelled rows gives every document a probability of each domain, so a document of t tokens
contributes t * p_k expected tokens to domain k. Rates (how often a document should be seen) are fitted so that
the expected totals meet the targets:

    minimise  |W (sum_d r_d a_d - T)|^2 + pull * sum_d t_d (r_d - 1)^2   with  0 <= r_d (<= most)

by projected gradient. Each step needs one sum over all documents, as wide as there are domains: a map-side
combined aggregation whose result is the only thing that reaches the driver. W whitens the domains, so that a
unit step is safe and few steps are needed. A document's rate follows from its own
posteriors and the short list of steps taken, so nothing is joined or rewritten between steps.

Defined results: null, empty and blank texts have no tokens and keep rate 1. Null or repeated ids are rows like
any other. Targets need not add up to 1; under a bound on rates a domain is never asked for more than it holds. Without labelled rows
all domains are equally likely. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapledger.llm.steps import staged
from mapledger.llm.textbytes import column_bytes, mix, word_hashes, word_spans

#: Labelled documents that the domain classifier learns from, at most: those whose hashed ids are least.
SAMPLE = 8192
BUCKETS = 1 << 18
EPOCHS = 6
STEPS = 24
PULL = 1e-3
FLOOR = 3e-3

DOMAINS = ("clean", "toxic", "poor")
#: Wanted shares of expected tokens by domain.
TARGETS = (0.96, 0.03, 0.01)


def word_buckets(data: np.ndarray) -> np.ndarray:
    """Distinct buckets of a text's words, one mark for a word repeated at once, and three marks of its form. Other word
    pairs are not used."""
    words = word_hashes(data)
    if not len(words):
        return np.zeros(0, np.int64)
    low = np.uint64(BUCKETS - 1)
    pairs = mix((words[1:] ^ words[:-1]) + np.uint64(1))
    capitals = np.count_nonzero((data >= 65) & (data <= 90))
    marks = np.count_nonzero((data >= 33) & (data <= 47))
    form = np.array([4 * min(9, 20 * capitals // len(data)), 1000 + min(9, 20 * marks // len(data)),
                     2000 + int(np.log2(len(words)))], np.uint64)
    return np.unique(np.concatenate((words & low, pairs[pairs == mix(np.ones(1, np.uint64))][:1] & low, mix(form) & low))).astype(np.int64)


class DomainModel:
    """Softmax regression over the presence of words."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray) -> None:
        self.weights, self.bias = weights, bias

    def posteriors(self, buckets: np.ndarray) -> np.ndarray:
        logits = self.bias + (self.weights[buckets].sum(axis=0) if len(buckets) else 0)
        shares = np.exp(logits - logits.max())
        return shares / shares.sum()


def learn(examples: list[tuple[np.ndarray, int]], classes: int, seed: int = 11) -> DomainModel:
    """Stochastic gradient descent with a step size for each weight from its past gradients."""
    weights, bias = np.zeros((BUCKETS, classes)), np.zeros(classes)
    seen, seen_bias = np.full((BUCKETS, classes), 1e-2), np.full(classes, 1e-2)
    draw = np.random.default_rng(seed)
    model = DomainModel(weights, bias)
    for _ in range(EPOCHS):
        for i in draw.permutation(len(examples)):
            buckets, truth = examples[i]
            wrong = model.posteriors(buckets)
            wrong[truth] -= 1
            seen_bias += wrong * wrong
            bias -= 0.1 * wrong / np.sqrt(seen_bias)
            seen[buckets] += wrong * wrong
            weights[buckets] -= 0.1 * wrong / np.sqrt(seen[buckets])
    return DomainModel(weights.astype(np.float32), bias)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [word_buckets(data).astype(np.int32).tobytes() for data in column_bytes(batch.column(0))]
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.binary())], names=["label", "buckets"])


def labelled_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, label): 2 poor, 1 toxic, 0 clean; rows without labels teach nothing."""
    domain = F.when(F.col("quality") == 0, 2).when(F.col("toxic") == 1, 1).otherwise(0)
    return labels.where("doc_id is not null and quality in (0, 1) and toxic in (0, 1)").groupBy("doc_id").agg(
        F.max(domain).cast("int").alias("label"))


def fit(documents: DataFrame, labelled: DataFrame, classes: int = len(DOMAINS), sample: int = SAMPLE) -> DomainModel:
    chosen = labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = (
        documents.select("doc_id", "text").join(chosen, "doc_id").select("text", "label")
        .mapInArrow(_examples, "label int, buckets binary").collect()
    )
    rows.sort(key=lambda r: (r.label, bytes(r.buckets)))
    return learn([(np.frombuffer(r.buckets, np.int32), r.label) for r in rows], classes)


def memberships(documents: DataFrame, model: DomainModel, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The kept columns, tokens long, posteriors array<double>."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<tokens: bigint, posteriors: array<double>>")
    def judge(texts: pa.Array) -> pa.Array:
        held, tokens, shares = shared.value, [], []
        for data in column_bytes(texts):
            tokens.append(len(word_spans(data)[0]))
            shares.append(held.posteriors(word_buckets(data)).tolist())
        return pa.StructArray.from_arrays(
            [pa.array(tokens, pa.int64()), pa.array(shares, pa.list_(pa.float64()))], names=["tokens", "posteriors"])

    return documents.select(*keep, judge("text").alias("_m")).select(*keep, "_m.tokens", "_m.posteriors")


def fitted_steps(members: DataFrame, targets: Sequence[float], total: float | None = None,
                 most: float | None = None, steps: int = STEPS, lead: float = 1.0) -> list[tuple[np.ndarray, float]]:
    """The gradient steps that fit the rates, each with its momentum; `total` expected tokens are wanted (as many
    as there are, if not given), and no rate may exceed `most`. Of the leading domain alone `lead` times as much is wanted.

    A document's step is its gradient over its tokens, and its pull to 1 is weighed by its tokens: so tokens cancel,
    documents of one membership get one rate whatever their length, and the domains' Gram matrix is all there is to
    whiten."""
    kinds = range(len(targets))
    part = [F.col("posteriors")[k] for k in kinds]
    first = members.agg(
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("all"),
        *[F.coalesce(F.sum(part[k] * F.col("tokens")), F.lit(0.0)).alias(f"n{k}") for k in kinds],
        *[F.coalesce(F.sum(part[i] * part[j] * F.col("tokens")), F.lit(0.0)).alias(f"g{i}{j}") for i in kinds for j in kinds]
    ).first()
    if not first["all"]:
        return []
    gram = np.array([[first[f"g{i}{j}"] for j in kinds] for i in kinds])
    wanted = np.array(targets, float) / sum(targets) * float(first["all"] if total is None else total)
    wanted[0] *= lead
    if most is not None:
        # What is not there cannot be asked for, but in the leading domain, whose rates it holds at the bound.
        here = np.array([first[f"n{k}"] for k in kinds])
        wanted[1:] = np.minimum(wanted[1:], most * here[1:])
    values, axes = np.linalg.eigh(gram)
    # Domains with next to no tokens must not outweigh the others: their variance counts as FLOOR of the largest.
    inverse = axes @ np.diag(1 / np.maximum(values, FLOOR * values.max())) @ axes.T
    momentum, history = 1.0, []
    for _ in range(steps):
        sums = with_rates(members, history, most).agg(
            *[F.sum(part[k] * F.col("tokens") * F.col("_ahead")).alias(f"s{k}") for k in kinds]).first()
        gap = np.array([sums[f"s{k}"] for k in kinds]) - wanted
        following = (1 + (1 + 4 * momentum * momentum) ** 0.5) / 2
        history.append((inverse @ gap, (momentum - 1) / following))
        momentum = following
        if np.abs(gap).max() <= 1e-7 * first["all"]:
            break
    return history


def with_rates(members: DataFrame, history: list[tuple[np.ndarray, float]], most: float | None = None) -> DataFrame:
    """Add the rate after all steps, and `_ahead`, the point where the next gradient is taken: one pass over the
    short list of steps inside the row."""
    if not history:
        return members.withColumn("rate", F.lit(1.0)).withColumn("_ahead", F.lit(1.0))
    width = len(history[0][0])
    steps = F.array(*[
        F.struct(*[F.lit(float(v)).alias(f"v{k}") for k, v in enumerate(step)], F.lit(float(beta)).alias("beta"))
        for step, beta in history])
    start = F.struct(F.lit(1.0).alias("rate"), F.lit(1.0).alias("ahead"))

    def advance(state: Column, step: Column) -> Column:
        push = sum((F.col("posteriors")[k] * step[f"v{k}"] for k in range(width)), F.lit(0.0))
        rate = F.greatest(F.lit(0.0), state["ahead"] - push - PULL * (state["ahead"] - 1))
        if most is not None:
            rate = F.least(rate, F.lit(float(most)))
        return F.struct(rate.alias("rate"), (rate + step["beta"] * (rate - state["rate"])).alias("ahead"))

    moved = members.withColumn("_state", F.aggregate(steps, start, advance))
    return moved.withColumn("rate", F.when(F.col("tokens") == 0, 1.0).otherwise(F.col("_state.rate"))).withColumn(
        "_ahead", F.col("_state.ahead")).drop("_state")


def mixed(documents: DataFrame, labels: DataFrame, targets: Sequence[float] = TARGETS,
          total: float | None = None, most: float | None = None) -> DataFrame:
    """(doc_id, tokens, p_<domain>..., rate) for every document."""
    model = fit(documents, labelled_domains(labels))
    members = staged(memberships(documents, model), "memberships")
    history = fitted_steps(members, targets, total, most)
    return with_rates(members, history, most).select(
        "doc_id", "tokens", *[F.col("posteriors")[k].alias(f"p_{d}") for k, d in enumerate(DOMAINS)], "rate")


def thinned_steps(members: DataFrame, targets: Sequence[float]) -> list[tuple[np.ndarray, float]]:
    """The steps of a mixture by thinning. The leading domain's wanted tokens are set a little beyond what it holds, so
    that its documents keep rate 1; the others' are set to their shares of what it does hold."""
    clean = members.agg(F.coalesce(F.sum(F.col("posteriors")[0] * F.col("tokens")), F.lit(0.0))).first()[0]
    return fitted_steps(members, targets, clean * sum(targets) / targets[0], 1.0, steps=STEPS // 2, lead=1.05)


def drawn(documents: DataFrame, labels: DataFrame, targets: Sequence[float] = TARGETS) -> DataFrame:
    """One pass over the mixture: each document stays with its rate, 1 at most, as probability, drawn by a hash of
    its id and text. It has the documents' own columns.

    Documents of the first domain keep rate 1, and the mixture is reached by thinning the others as far as posteriors
    tell the domains apart: what a document of the first domain holds of another is not thinned."""
    model = fit(documents, labelled_domains(labels))
    held = staged(memberships(documents, model, keep=[]), "memberships")
    history = thinned_steps(held, targets)
    own = [F.col(f"`{c}`") for c in documents.columns]
    named = documents.select(F.struct(*own).alias("_own"), "text", "doc_id")
    rated = with_rates(memberships(named, model, keep=["_own", "text", "doc_id"]), history, 1.0)
    chance = F.pmod(F.xxhash64("doc_id", "text", F.lit(29)), F.lit(1 << 20)) / float(1 << 20)
    return rated.where(chance < F.col("rate")).select("_own.*")

"""Soft-membership mixing of documents to target token shares. DataFrame operations only.

1. A classifier made of tables: letters are counted per document (length minus length without the letter), summed
   per domain over the labelled rows, and turned into smoothed log frequencies; a document's posterior over the
   domains is a softmax of its letter frequencies against them.
2. Every document gets a rate r >= floor. Its expected tokens of domain k are r * tokens * posterior_k. The rates
   minimise the squared distance between expected totals and targets: each round sums the totals of all documents
   (one aggregation), and moves every rate along the gradient, scaled by the inverse of the posteriors' second
   moments, then projects it onto r >= floor. A round that does not come closer is retried with half the step.

Only numbers per domain reach the driver. Rates are an expression over the stored posteriors, so they need no state.

Edge cases: a null or empty text has no tokens and the domains' prior as posterior; null domains teach nothing; with no
labelled row every posterior is uniform; a domain that no document can supply keeps its shortfall; an empty table
gives an empty result; repeated rows count each.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoreach.operators.joins import Workspace

#: The classifier is fitted on at most about so many labelled rows.
FIT_ROWS = 20_000
LETTERS = "enatirosdhulcgmbpfvqwzéyjkxèßñçêüäöóíàáâëîïôùúûœ"
#: A text weighs like at most this many independent letters.
STRENGTH = 60.0


def with_letter_counts(rows: DataFrame, text: str) -> DataFrame:
    """Add ``_x``, the counts of LETTERS, and take ``text`` away.

    Each letter is counted by removing it from what the letters before it have left, frequent ones first, so later
    ones search a short rest. Every step is a projection of its own: its text is used twice and computed once.
    """
    own, sizes = [c for c in rows.columns if c != text], []
    for i, c in enumerate(LETTERS):
        rows = rows.select(*own, *sizes, F.octet_length(text).alias(f"_n{i}"), F.replace(F.col(text), F.lit(c), F.lit("")).alias(text))
        sizes.append(f"_n{i}")
    rows = rows.select(*own, *sizes, F.octet_length(text).alias(f"_n{len(LETTERS)}"))
    counts = [(F.col(f"_n{i}") - F.col(f"_n{i + 1}")) / F.lit(float(len(c.encode()))) for i, c in enumerate(LETTERS)]
    return rows.select(*own, F.array(*counts).alias("_x"))


def _features(docs: DataFrame, keep: bool = False) -> DataFrame:
    row = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")] if keep else []
    lower = docs.select(*row, F.col("doc_id"), F.lower(F.coalesce(F.col("text"), F.lit(""))).alias("_text"))
    counted = lower.select(*(["_row"] if keep else []), "doc_id", F.regexp_count(F.col("_text"), F.lit(r"\S+")).cast("long").alias("n_tokens"), "_text")
    return with_letter_counts(counted, "_text")


def fit_classifier(docs: DataFrame, labelled: DataFrame, domains: list[str], fit_rows: int = FIT_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Log letter frequencies (domain, letter) and log priors from a bounded hash sample of (doc_id, domain)."""
    known = labelled.filter(F.col("domain").isin(domains)).groupBy("doc_id").agg(F.min("domain").alias("domain"))
    share = min(1.0, fit_rows / max(known.count(), 1))
    known = known.filter(F.pmod(F.xxhash64(F.col("doc_id"), F.lit("fit")), F.lit(1 << 30)) < int((1 << 30) * share))
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    counted = _features(rows.select("doc_id", "text")).join(F.broadcast(known), "doc_id")
    sums = counted.groupBy("domain").agg(F.count(F.lit(1)).alias("n"), *(F.sum(F.col("_x")[i]).alias(f"_{i}") for i in range(len(LETTERS)))).collect()
    totals = np.ones((len(domains), len(LETTERS)))
    prior = np.ones(len(domains))
    for row in sums:
        k = domains.index(row["domain"])
        prior[k] += row["n"]
        totals[k] += [row[f"_{i}"] or 0.0 for i in range(len(LETTERS))]
    return np.log(totals / totals.sum(1, keepdims=True)), np.log(prior / prior.sum())


def posteriors(docs: DataFrame, frequencies: np.ndarray, priors: np.ndarray, keep: bool = False) -> DataFrame:
    """doc_id, n_tokens, p (array of posteriors in the domains' order), and the whole row as ``_row`` if wanted."""
    own = ["_row", "doc_id", "n_tokens"] if keep else ["doc_id", "n_tokens"]
    found = _features(docs, keep).withColumn("_n", F.aggregate("_x", F.lit(0.0), lambda a, x: a + x))
    weight = F.when(F.col("_n") > 0, F.least(F.col("_n"), F.lit(STRENGTH)) / F.col("_n")).otherwise(F.lit(0.0))
    score = [sum((F.col("_x")[i] * float(v) for i, v in enumerate(row)), F.lit(0.0)) * weight + float(prior) for row, prior in zip(frequencies, priors, strict=True)]
    found = found.select(*own, *(s.alias(f"_s{k}") for k, s in enumerate(score)))
    names = [F.col(f"_s{k}") for k in range(len(score))]
    top = F.greatest(*names) if len(names) > 1 else names[0]
    found = found.select(*own, *(F.exp(s - top).alias(f"_e{k}") for k, s in enumerate(names)))
    total = sum((F.col(f"_e{k}") for k in range(len(names))), F.lit(0.0))
    # Exploding the one array keeps the optimiser from writing its expression out at each of its many uses.
    p = F.array(*(F.col(f"_e{k}") / total for k in range(len(names))))
    return found.select(*own, F.explode(F.array(p)).alias("p"))


def _moved(rate: Column, step: np.ndarray, floor: float) -> Column:
    return F.greatest(F.lit(float(floor)), rate - sum((F.col("p")[k] * float(s) for k, s in enumerate(step)), F.lit(0.0)))


def fit_rates(members: DataFrame, targets: np.ndarray, floor: float = 0.0, keep_all: bool = False, rounds: int = 20, close: float = 1e-6) -> tuple[Column, np.ndarray]:
    """The rate as an expression over ``p``, and the expected shares it gives.

    Totals are relative to the documents' own tokens. ``keep_all`` raises the total until no domain has to shrink.
    """
    k = len(targets)
    weigh = lambda rate: [F.sum(rate * F.col("n_tokens") * F.col("p")[i]).alias(f"a{i}") for i in range(k)]
    second = [F.sum(F.col("n_tokens") * F.col("p")[i] * F.col("p")[j]).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)]
    rate = F.lit(1.0)
    row = members.agg(F.sum("n_tokens").alias("n"), *weigh(rate), *second).first()
    n = float(row["n"] or 0)
    if not n:
        return rate, np.zeros(k)
    now = np.array([row[f"a{i}"] for i in range(k)]) / n
    gram = np.array([[row[f"g{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)]) / n
    inverse = np.linalg.pinv(gram, rcond=1e-9)
    goal = targets * (max(1.0, float((now / targets).max())) if keep_all else 1.0)
    scale = 1.0
    for _ in range(rounds):
        if np.abs(now - goal).max() < close or scale < 1e-3:
            break
        trial = _moved(rate, scale * (inverse @ (now - goal)), floor)
        row = members.agg(*weigh(trial)).first()
        got = np.array([row[f"a{i}"] for i in range(k)]) / n
        if ((got - goal) ** 2).sum() < ((now - goal) ** 2).sum():
            rate, now = trial, got
        else:
            scale /= 2
    return rate, now


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], floor: float = 0.0, keep_all: bool = False, fit_rows: int = FIT_ROWS, keep: bool = False) -> DataFrame:
    """Rate of every document: doc_id, n_tokens, domain (likeliest), p (posteriors, in sorted domain order), rate.

    ``labelled`` is (doc_id, domain); ``targets`` maps each domain to its wanted share of tokens (scaled to sum 1).
    With ``keep`` the rows come along as ``_row``; their posteriors are then computed again instead of joined by id.
    """
    domains = sorted(targets)
    wanted = np.array([targets[d] for d in domains], float)
    if not len(wanted) or (wanted <= 0).any():
        raise ValueError("every target share must be above zero")
    model = fit_classifier(docs, labelled, domains, fit_rows)
    members = Workspace(docs.sparkSession).save(posteriors(docs, *model), "posteriors")
    rate, _ = fit_rates(members, wanted / wanted.sum(), floor, keep_all)
    likeliest = F.element_at(F.array(*map(F.lit, domains)), F.array_position("p", F.array_max("p")).cast("int"))
    out = posteriors(docs, *model, keep=True) if keep else members
    return out.select(*(["_row"] if keep else []), "doc_id", "n_tokens", likeliest.alias("domain"), "p", rate.alias("rate"))


def copies(rate: Column, *key: Column) -> Column:
    """A whole number of copies with the rate as its mean, decided by a hash of the key."""
    chance = F.pmod(F.xxhash64(*key, F.lit("copies")), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(rate) + (chance < rate - F.floor(rate)).cast("int")).cast("int")

"""Mixing to target weights with soft memberships: posteriors of domains, then rates by projected gradients.

Everything runs as DataFrame expressions. A document belongs to every domain with the probability that
a classifier learned from the labelled table gives; its tokens count towards the domains in those shares.
Rates, one per document, are fitted so that the expected tokens of the domains meet their targets.
"""

from __future__ import annotations

import logging
import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitepulse.llm.common import stored

#: White space of the word pattern, for Java's expressions.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Upper edges of the bins of the numeric features.
EDGES = {
    "words": [50, 100, 200, 400, 800, 1600],
    "word_length": [4.0, 4.5, 5.0, 5.5, 6.0, 7.0],
    "symbols": [0.0001, 0.005, 0.02, 0.1],
    "line_words": [4, 8, 16, 32, 64],
}
#: Words whose presence is a feature, and labelled documents they are chosen from.
CUES, CUE_ROWS = 24, 4_000
#: Gradient steps between two written tables of rates, and at most.
STEPS_PER_TABLE, STEPS = 8, 120
#: Steps that change totals by no more than this share of the gap that is left lead no further.
STILL = 1e-6
log = logging.getLogger(__name__)


def domain_column() -> Column:
    """The domain of a labelled document: its quality and its toxicity."""
    return F.concat(F.lit("quality"), F.col("quality").cast("string"), F.lit("_toxic"), F.col("toxic").cast("string"))


def labelled_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain), one row per document with both labels; of several the largest name counts."""
    return (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), domain_column().alias("domain"))
        .where("doc_id IS NOT NULL AND domain IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("domain").alias("domain"))
    )


def cue_words(texts: DataFrame, domains: DataFrame, names: list[str], rows: int = CUE_ROWS) -> list[str]:
    """The words whose presence departs most from independence of a domain, from a bounded sample of labels."""
    share = min(1.0, rows / max(1, domains.count()))
    sample = domains.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20))).limit(2 * rows)
    sample = stored(texts.join(F.broadcast(sample), "doc_id"), "mixing-sample")
    sizes = {r["domain"]: r["n"] for r in sample.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    words = sample.select("domain", F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("word")).where(
        F.length("word").between(4, 24)
    )
    counted = words.groupBy("word").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("domain") == d).alias(f"n_{k}") for k, d in enumerate(names)]
    )
    score = F.lit(0.0)
    for k, d in enumerate(names):
        p = sizes.get(d, 0) / max(total, 1)
        if 0 < p < 1:
            score = F.greatest(score, F.abs(F.col(f"n_{k}") - F.col("n") * p) / F.sqrt(F.col("n") * p * (1 - p)))
    best = counted.where("n >= 5").orderBy(score.desc(), "word").limit(CUES)
    return [r["word"] for r in best.select("word").collect()]


def _bin(value: Column, edges: list[float]) -> Column:
    found = F.lit(0)
    for edge in edges:
        found = found + (value >= edge).cast("int")
    return found


def features(texts: DataFrame, cues: list[str]) -> DataFrame:
    """(doc_id, text_hash, tokens, f0, f1, ...): words of the text and the bin of every feature."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.regexp_count(text, F.lit(WORD)).cast("bigint")
    bare = F.length(F.translate(text, " \t\n\x0b\x0c\r", ""))
    lines = F.length(text) - F.length(F.translate(text, "\n", "")) + 1
    base = texts.select("doc_id", "text_hash", text.alias("text"), words.alias("tokens"), bare.alias("bare"), lines.alias("lines"))
    symbols = F.length("text") - F.length(F.translate("text", SYMBOLS, ""))
    many = F.greatest("tokens", F.lit(1))
    low = F.lower("text")
    columns = [
        _bin(F.col("tokens"), EDGES["words"]),
        _bin(F.col("bare") / many, EDGES["word_length"]),
        _bin(symbols / F.greatest("bare", F.lit(1)), EDGES["symbols"]),
        _bin(F.col("tokens") / F.col("lines"), EDGES["line_words"]),
        *[F.contains(F.col("low"), F.lit(cue)).cast("int") for cue in cues],
    ]
    return base.withColumn("low", low).select(
        "doc_id", "text_hash", "tokens", *[c.alias(f"f{i}") for i, c in enumerate(columns)]
    )


def posteriors(found: DataFrame, domains: DataFrame, names: list[str], cues: int) -> DataFrame:
    """(doc_id, text_hash, tokens, p0, p1, ...): naive Bayes over the bins, from all labelled documents."""
    sizes = [len(e) + 1 for e in EDGES.values()] + [2] * cues
    known = found.join(domains, "doc_id")
    counts = known.groupBy("domain").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(f"f{i}") == b).alias(f"n{i}_{b}") for i, size in enumerate(sizes) for b in range(size)],
    )
    rows = {r["domain"]: r for r in counts.collect()}
    total = sum(r["n"] for r in rows.values())

    def log_of(domain: str, i: int, b: int) -> float:
        own = rows.get(domain)
        return math.log(((own[f"n{i}_{b}"] if own else 0) + 0.5) / ((own["n"] if own else 0) + 0.5 * sizes[i]))

    logs = []
    for domain in names:
        own = rows.get(domain)
        value = F.lit(math.log(((own["n"] if own else 0) + 0.5) / (total + 0.5 * len(names))))
        for i, size in enumerate(sizes):
            value = value + F.element_at(F.array(*[F.lit(log_of(domain, i, b)) for b in range(size)]), F.col(f"f{i}") + 1)
        logs.append(value)
    scored = found.select("doc_id", "text_hash", "tokens", *[v.alias(f"l{k}") for k, v in enumerate(logs)])
    top = F.greatest(*[F.col(f"l{k}") for k in range(len(names))]) if len(names) > 1 else F.col("l0")
    scored = scored.withColumn("top", top)
    shares = [F.exp(F.col(f"l{k}") - F.col("top")) for k in range(len(names))]
    total_share = shares[0]
    for s in shares[1:]:
        total_share = total_share + s
    return scored.select("doc_id", "text_hash", "tokens", *[(s / total_share).alias(f"p{k}") for k, s in enumerate(shares)])


def fit_rates(
    shares: DataFrame,
    targets: list[float],
    least: float = 0.0,
    most: float = 16.0,
    upsample: bool = False,
    tolerance: float = 1e-4,
) -> DataFrame:
    """Adds ``rate``: least <= rate <= most, so that sums of rate * tokens * p_k are in the ratio of the targets.

    Least squares on the domain totals by projected gradients from rate 1, each taken a little ahead of the
    last rates. Totals are weighted by the inverse of their Gram matrix, which makes a full step safe and
    exact until a rate meets a bound; the steps end when all totals are within ``tolerance`` of the whole,
    or when the bounds leave no way further: three steps in a row that change next to nothing of the gap that
    is left. A gap beyond ``tolerance`` is then logged as a warning, and so is a whole that ``most`` cuts down. The whole is the number of tokens, or with ``upsample`` the
    smallest one in which no domain has to shrink. Every step is one aggregate of two rows of totals; rates
    are a chain of expressions that is written after every ``STEPS_PER_TABLE`` steps.
    """
    k = len(targets)
    p = [F.col(f"p{i}") for i in range(k)]
    tokens = F.col("tokens")
    first = shares.agg(
        F.sum("tokens").alias("total"),
        *[F.sum(tokens * p[i]).alias(f"m{i}") for i in range(k)],
        *[F.sum(tokens * p[i] * tokens * p[j]).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)],
    ).first()
    now = shares.withColumn("rate", F.lit(1.0))
    total = float(first["total"] or 0)
    if not total:
        return now
    weights = np.asarray(targets, float) / sum(targets)
    current = np.array([first[f"m{i}"] for i in range(k)]) / total
    whole = max(1.0, float(np.max(current / np.maximum(weights, 1e-6)))) if upsample else 1.0
    aim = weights * min(whole, most)
    if whole > most:
        log.warning("the targets need %.3g times the tokens, over the most copies of %.3g", whole, most)
    gram = np.array([[first[f"g{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)]) / total**2
    inverse = np.linalg.inv(gram + np.eye(k) * max(np.trace(gram) * 1e-9, 1e-300))
    kept = [F.col(c) for c in shares.columns]
    now = now.withColumn("ahead", F.col("rate"))
    gap = gap_ahead = current - aim
    since, still, step = 0, 0, 0
    while np.abs(gap).max() > tolerance and still < 3 and step < STEPS:
        step += 1
        pull = inverse @ gap_ahead
        change = F.lit(0.0)
        for i in range(k):
            change = change + p[i] * float(pull[i] / total)
        fresh = F.least(F.lit(most), F.greatest(F.lit(least), F.col("ahead") - tokens * change))
        ahead = F.col("fresh") + since / (since + 3) * (F.col("fresh") - F.col("rate"))
        now = now.select(*kept, "rate", fresh.alias("fresh")).select(*kept, F.col("fresh").alias("rate"), ahead.alias("ahead"))
        if step % STEPS_PER_TABLE == 0:
            now = stored(now, "mixing-rates")
        sums = now.agg(
            *[F.sum(F.col(c) * tokens * p[i]).alias(f"{c}{i}") for c in ("rate", "ahead") for i in range(k)]
        ).first()
        moved, gap_ahead = (np.array([sums[f"{c}{i}"] for i in range(k)]) / total - aim for c in ("rate", "ahead"))
        still = still + 1 if np.abs(moved - gap).max() <= STILL * np.abs(moved).max() else 0
        since = 0 if moved @ inverse @ moved > gap @ inverse @ gap else since + 1
        gap = moved
    if np.abs(gap).max() > tolerance:
        log.warning("rates miss their targets by %s of the tokens after %d steps", [round(float(g), 6) for g in gap], step)
    return now.drop("ahead")


def mix_documents(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float],
    least: float = 0.0,
    most: float = 16.0,
    upsample: bool = False,
    tolerance: float = 1e-4,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, tokens, domain (the likeliest), posteriors and rate.

    ``targets`` maps each domain to its weight; labels of other domains are left out, and so are domains
    without a label, of which no text can be known to be. A null or empty text
    has no tokens and keeps rate 1; without labels the posteriors are equal. Rows with an id that repeats
    with another text count with their own; a null id is never labelled.
    """
    names = sorted(targets)
    texts = docs.selectExpr(
        "cast(doc_id as bigint) doc_id", "xxhash64(cast(text as string)) text_hash", "cast(text as string) text"
    )
    domains = stored(labelled_domains(labels).where(F.col("domain").isin(names)), "mixing-domains")
    labelled = {r["domain"] for r in domains.select("domain").distinct().collect()}
    names = [n for n in names if n in labelled] or names
    cues = cue_words(texts.select("doc_id", "text"), domains, names)
    found = stored(features(texts, cues), "mixing-features")
    shares = stored(posteriors(found, domains, names, len(cues)), "mixing-shares")
    rated = fit_rates(shares, [targets[n] for n in names], least, most, upsample, tolerance)
    likeliest = F.lit(names[0])
    best = F.col("p0")
    for i, name in enumerate(names[1:], 1):
        likeliest = F.when(F.col(f"p{i}") > best, name).otherwise(likeliest)
        best = F.greatest(best, F.col(f"p{i}"))
    return rated.select(
        "doc_id",
        "text_hash",
        "tokens",
        likeliest.alias("domain"),
        F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.col(f"p{i}") for i in range(len(names))])).alias(
            "posteriors"
        ),
        "rate",
    )


def repeat_documents(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """Every row of ``docs`` as often as its rate says; the fraction is settled by a hash of the row."""
    part = F.pmod(F.xxhash64("doc_id", "text_hash", F.lit("mix")), F.lit(1 << 30)) / float(1 << 30)
    copies = mixed.groupBy("doc_id", "text_hash").agg(F.max("rate").alias("rate"))
    copies = copies.withColumn("_copies", (F.floor("rate") + (part < F.col("rate") - F.floor("rate")).cast("int")).cast("int"))
    keyed = docs.withColumn("_hash", F.xxhash64(F.col("text").cast("string")))
    copies = stored(copies.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_key"), "_copies"), "mixing-copies")
    joined = keyed.join(copies, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_key")))
    once = joined.where("_copies > 0").withColumn("_nth", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return once.select(*docs.columns)

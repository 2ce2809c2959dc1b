"""Mixing documents to target weights of domains they belong to in part."""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventfares.settings import keep

TARGET = {"good": 0.80, "poor": 0.15, "toxic": 0.05}
BINS = 1 << 12
DOCS_PER_DOMAIN = 2000
SMOOTHING = 1.0
EVIDENCE_WORDS = 30.0
ROUNDS = 25
CLOSE = 1e-6


def domain_of(quality: Column, toxic: Column) -> Column:
    """The domain a label names: `toxic`, else `good` or `poor` by quality, null if neither is known."""
    return F.when(toxic == 1, "toxic").when(quality == 1, "good").when(quality == 0, "poor")


def train(
    docs: DataFrame, labels: DataFrame, domains: list[str], docs_per_domain: int = DOCS_PER_DOMAIN
) -> tuple[np.ndarray, np.ndarray]:
    """Log-priors of `domains`, and for each the log-likelihood of every bin of words.

    Naive Bayes over the distinct words of labelled texts. Of a domain with more than
    `docs_per_domain` labelled documents about that many are used, chosen by a hash of the id, which
    also bounds the table that is broadcast. Priors are of all labels. A document that is labelled
    more than once counts as toxic if any label says so, and as of its least quality. A domain
    without labels is as likely for any word.
    """
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    known = known.select("doc_id", domain_of(F.col("quality"), F.col("toxic")).alias("domain")).where(F.col("domain").isin(domains))
    sizes = {r.domain: r.n for r in known.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return np.full(len(domains), -np.log(len(domains))), np.full((len(domains), BINS), -np.log(BINS))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    chosen = [(F.col("domain") == d) & (draw < docs_per_domain / n) for d, n in sizes.items()]
    some = chosen[0]
    for other in chosen[1:]:
        some = some | other
    words = (
        docs.select("doc_id", "text")
        .join(F.broadcast(known.where(some)), "doc_id")
        .select("domain", F.explode(_bins(_words(F.col("text")))).alias("bin"))
    )
    counts = np.full((len(domains), BINS), SMOOTHING)
    for row in words.groupBy("domain", "bin").agg(F.count("*").alias("n")).collect():
        counts[domains.index(row.domain), row.bin] += row.n
    priors = np.array([sizes.get(d, 0) + SMOOTHING for d in domains])
    return np.log(priors / priors.sum()), np.log(counts / counts.sum(axis=1, keepdims=True))


def _words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")


def _bins(words: Column) -> Column:
    return F.transform(F.array_distinct(words), lambda w: F.pmod(F.xxhash64(w), F.lit(BINS)).cast("int"))


def memberships(docs: DataFrame, priors: np.ndarray, likelihoods: np.ndarray, text: str = "text") -> DataFrame:
    """`docs` with `n_tokens`, its words, and `membership`, the probability of each domain.

    The evidence of a long text is scaled down to that of `EVIDENCE_WORDS` words, as words are not
    independent: a text belongs to several domains in part. A text without words has the priors.
    """
    table = F.from_json(F.lit(json.dumps(np.round(likelihoods - likelihoods.mean(axis=0), 9).T.tolist())), "array<array<double>>")
    # The columns of `docs` travel in one of ours, so that no name of theirs meets a name of ours. Words
    # and bins sit in generators, so that no lambda works them out again.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.explode(F.array(_words(F.col(f"`{text}`")))).alias("words"))
    binned = rows.select("row", F.size("words").cast("bigint").alias("n_tokens"), F.explode(F.array(_bins(F.col("words")))).alias("bins"))
    weight = F.least(F.lit(1.0), EVIDENCE_WORDS / F.greatest(F.size("bins"), F.lit(1)))

    def evidence(d: int) -> Column:
        total = F.aggregate("bins", F.lit(0.0), lambda sum_, b: sum_ + F.get(F.get(table, b), F.lit(d)))
        return total * weight + float(priors[d])

    scored = binned.select("row", "n_tokens", F.explode(F.array(F.array(*[evidence(d) for d in range(len(priors))]))).alias("evidence"))
    top = F.array_max("evidence")
    likely = scored.select("row", "n_tokens", F.explode(F.array(F.transform("evidence", lambda e: F.exp(e - top)))).alias("likely"))
    total = F.aggregate("likely", F.lit(0.0), lambda a, b: a + b)
    new = likely.select("row", F.struct("n_tokens", F.transform("likely", lambda x: x / total).alias("membership")).alias("new"))
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("n_tokens", "membership")]
    return new.select(*kept, "new.n_tokens", "new.membership")


def fit_rates(members: DataFrame, target: np.ndarray, rounds: int = ROUNDS) -> tuple[Column, dict]:
    """The rate of each row of `members(n_tokens, membership)` as a column, and what it comes to.

    Rates r >= 0 start at 1 and minimise the distance of the expected tokens of each domain,
    `sum(r * n_tokens * membership)`, from `target` times all tokens, by projected gradient steps.
    Gradients are scaled by the length of a row, so that rates follow memberships alone, and taken in
    the inverse of the second moments of the rows whose rates are above 0, in which a full step
    would fit at once if it took no rate to 0. A rate is a function of its row and of one vector per
    step, so a step is one pass that leaves a few sums, and those are all that reaches the driver.
    The rates of the closest step are the result. A row without tokens keeps 1.
    """
    d = len(target)
    share = [F.get("membership", F.lit(k)) for k in range(d)]
    part = [F.col("n_tokens") * p for p in share]
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    steps, rate, best = 0, F.lit(1.0), None
    while True:
        moves = F.when(rate > 0, 1.0).otherwise(0.0)
        sums = members.agg(
            F.sum(F.lit(1.0) * F.col("n_tokens")).alias("n"),
            *[F.sum(rate * part[k]).alias(f"t{k}") for k in range(d)],
            *[F.sum(moves * part[i] * share[j]).alias(f"s{i}_{j}") for i, j in pairs],
        ).first()
        total = sums["n"]
        if not total:
            return F.lit(1.0), {"steps": 0, "distance": 0.0}
        goal = np.asarray(target) / np.sum(target) * total
        missing = np.array([sums[f"t{k}"] for k in range(d)]) - goal
        distance = float(np.linalg.norm(missing) / np.linalg.norm(goal))
        if best is None or distance < best[1]["distance"]:
            kept = F.when(F.col("n_tokens") > 0, rate).otherwise(F.lit(1.0))
            best = kept, {"steps": steps, "distance": distance}
        if distance < CLOSE or steps == rounds:
            return best
        moments = np.zeros((d, d))
        for i, j in pairs:
            moments[i, j] = moments[j, i] = sums[f"s{i}_{j}"]
        step = np.linalg.pinv(moments, rcond=1e-9, hermitian=True) @ missing
        change = share[0] * float(step[0])
        for k in range(1, d):
            change = change + share[k] * float(step[k])
        rate, steps = F.greatest(F.lit(0.0), rate - change), steps + 1


def mix(docs: DataFrame, labels: DataFrame, target: dict[str, float] | None = None) -> DataFrame:
    """`docs` with `n_tokens`, `membership` by domain in the order of their names, and `rate`.

    A null text has no tokens and any rate fits it; it keeps 1. Documents that repeat an id are rows
    of their own. Columns of `docs` with the names of new ones are replaced; an empty table gives no
    rows. `labels` may lack documents and have unknown ones; extra columns of it are not looked at.
    """
    target = target or TARGET
    domains = sorted(target)
    docs = docs.drop("n_tokens", "membership", "rate")
    members = keep(memberships(docs, *train(docs, labels, domains)), "memberships")
    rate, _ = fit_rates(members, np.array([target[d] for d in domains]))
    return members.withColumn("rate", rate)


def draw(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """`mixed` with each row as often as its rate: the whole part, and once more by a draw.

    The draw is a hash of id and text, so it is the same every time.
    """
    chance = F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit("draw")), 11) / float(1 << 53)
    copies = F.floor(F.col("rate") + chance).cast("int")
    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")
    drawn = mixed.where(copies > 0).select(row, F.explode(F.array_repeat(F.lit(1), copies)).alias("copy"))
    return drawn.select(*[F.col("row").getField(c).alias(c) for c in columns])


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    mixed = mix(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    domains = sorted(TARGET)
    return mixed.select("doc_id", "n_tokens", *[F.get("membership", F.lit(k)).alias(f"p_{d}") for k, d in enumerate(domains)], "rate")

"""The classification registry: reconcile with a snapshot, choose candidates, fold observations, decide on publication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import flags, holds, quarter_start, retry_delay
from .master import carry_forward
from .store import keep_last, write_snapshot

TIERS = ("macro_sector", "sector", "industry", "basic_industry")


def snapshot_validity(snapshot: DataFrame, state: DataFrame, share: float = 0.95, bootstrap: int = 20) -> DataFrame:
    """(n, n_keys, n_blank, n_prior, overlap, valid): a snapshot is not empty, has no blank or repeated key, and covers the prior
    active keys (any overlap counts while these are few)."""
    own = snapshot.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("isin").alias("n_keys"), F.count_if((F.coalesce("isin", F.lit("")) == "") | (F.coalesce("symbol", F.lit("")) == "")).alias("n_blank"))
    active = state.filter("status <> 'inactive'").select("isin")
    prior = active.agg(F.count(F.lit(1)).alias("n_prior"))
    shared = active.join(snapshot.select("isin").distinct(), "isin", "left_semi").agg(F.count(F.lit(1)).alias("overlap"))
    c = F.col
    enough = F.when(c("n_prior") == 0, True).when(c("n_prior") < bootstrap, c("overlap") > 0).otherwise((c("n") >= c("n_prior") * share) & (c("overlap") >= c("n_prior") * share))
    out = own.crossJoin(prior).crossJoin(shared)  # one row each
    return out.withColumn("valid", (c("n") > 0) & (c("n_keys") == c("n")) & (c("n_blank") == 0) & enough)


def reconcile(state: DataFrame, snapshot: DataFrame, today: str, *, force_pending: bool = False, audit: bool = False, manual: bool = False) -> DataFrame:
    """The state after a valid snapshot, with reasons (why a key is a candidate, joined by ';', empty if it is none).

    state: isin, symbol, status (pending, classified, inactive), tiers, attempts, retry_on, deferred, backlog, audit_attempt_on, absences.
    A snapshot with an ordinal, the place of each key in its file, passes it on.
    """
    place = ["ordinal"] if "ordinal" in snapshot.columns else []
    t = F.lit(today).cast("date")
    if manual:
        untouched = (F.col("status") == "pending") & F.col("sector").isNull() & (F.col("attempts") == 0) & F.col("retry_on").isNull()
        state = state.withColumn("backlog", F.col("backlog") | untouched)
    s, n = state.alias("s"), snapshot.select(F.col("isin").alias("_isin"), F.col("symbol").alias("_symbol"), *place).alias("n")
    both = s.join(n, F.col("s.isin") == F.col("n._isin"), "full_outer")
    old, new = F.col("isin").isNotNull(), F.col("_isin").isNotNull()
    seen = old & new
    gone = F.when(old & ~new, F.col("absences") + 1).otherwise(0)
    due_retry = (F.col("status") == "pending") & (F.lit(force_pending) | (~F.col("backlog") & ~F.col("deferred") & (F.col("retry_on").isNull() | (F.col("retry_on") <= t))))
    due_audit = F.lit(audit) & (F.col("audit_attempt_on").isNull() | (F.col("audit_attempt_on") < quarter_start(t)))
    reasons = flags({
        "new": ~old & new, "reactivated": seen & (F.col("status") == "inactive"), "renamed": seen & (F.col("symbol") != F.col("_symbol")),
        "retry_due": seen & due_retry, "audit_due": seen & due_audit,
    })
    known = F.col("sector").isNotNull()
    status = F.when(~old, "pending").when(new, F.when(known, "classified").otherwise("pending")).when(gone >= 2, "inactive").otherwise(F.col("status"))
    return both.select(
        F.coalesce("_isin", "isin").alias("isin"), F.coalesce("_symbol", "symbol").alias("symbol"), status.alias("status"), *TIERS,
        F.coalesce("attempts", F.lit(0)).alias("attempts"), "retry_on", F.coalesce("deferred", F.lit(False)).alias("deferred"), F.coalesce("backlog", F.lit(manual)).alias("backlog"),
        "audit_attempt_on", F.coalesce(gone, F.lit(0)).alias("absences"), reasons.alias("reasons"), *place,
    )


def candidates(reconciled: DataFrame, limit: int | None = None) -> DataFrame:
    """Candidates in the snapshot's order, or of their ISIN where it has none; at most limit of them."""
    picked = reconciled.filter("reasons <> ''").orderBy(*(["ordinal"] if "ordinal" in reconciled.columns else []), "isin")
    return picked if limit is None else picked.limit(limit)


def fold(reconciled: DataFrame, attempts: DataFrame, today: str, *, audit: bool = False, delays: tuple[int, ...] = (1, 3, 7)) -> DataFrame:
    """The state after a batch of attempts (isin, ordinal, outcome, tiers): a complete observation classifies and resets retries, a
    failure postpones, after the last delay to the full audit. An outcome of 'deferred' stops the batch: later attempts do not count."""
    stop = attempts.filter("outcome = 'deferred'").agg(F.min("ordinal").alias("_stop"))
    done = attempts.crossJoin(F.broadcast(stop)).filter("_stop is null or ordinal < _stop")  # one row
    got = done.select("isin", F.col("outcome").alias("_outcome"), *(F.col(x).alias(f"_{x}") for x in TIERS))
    t = F.lit(today).cast("date")
    rows = reconciled.join(got, "isin", "left")
    ok, failed = holds(F.col("_outcome") == "observed"), holds(F.col("_outcome") == "failed")
    tries = F.when(ok, 0).when(failed, F.col("attempts") + 1).otherwise(F.col("attempts"))
    later = F.date_add(t, retry_delay(F.col("attempts") + 1, delays))
    return rows.select(
        "isin", "symbol", F.when(ok, "classified").when(failed, "pending").otherwise(F.col("status")).alias("status"), *(F.when(ok, F.col(f"_{x}")).otherwise(F.col(x)).alias(x) for x in TIERS),
        tries.alias("attempts"), F.when(ok, None).when(failed, later).otherwise(F.col("retry_on")).alias("retry_on"),
        F.when(failed, F.col("attempts") + 1 > len(delays)).otherwise(F.col("deferred")).alias("deferred"),
        F.when(ok | failed, False).otherwise(F.col("backlog")).alias("backlog"),
        F.when((ok | failed) & F.lit(audit), t).otherwise(F.col("audit_attempt_on")).alias("audit_attempt_on"), "absences",
    )


def active_view(state: DataFrame) -> DataFrame:
    """Classified keys that are not inactive, under their current symbol."""
    return state.filter((F.col("status") != "inactive") & F.col("sector").isNotNull()).select("isin", "symbol", *TIERS)


def observed_keys(observations: DataFrame, state: DataFrame) -> DataFrame:
    """Observations (symbol, ...) with the isin that has their symbol now, the largest one of several; those of unknown symbols go."""
    return observations.join(keep_last(state.select("symbol", "isin"), ["symbol"], ["isin"]), "symbol")


def flat_state(state: DataFrame, provenance: DataFrame, updated_on: str) -> DataFrame:
    """What is stored of each key, one row: labels and where they come from (isin, observed_at, source_url, extractor_version,
    fragment_hash) only where they are known, days as ISO text, counters, and the day of the update."""
    known, day = F.col("sector").isNotNull(), lambda c: F.col(c).cast("string").alias(c)
    origin = keep_last(provenance, ["isin"], ["observed_at", "source_url", "extractor_version", "fragment_hash"])
    rows = state.join(origin, "isin", "left")
    return rows.select(
        "isin", "symbol", "status", *(F.when(known, F.col(c)).alias(c) for c in TIERS), "observed_at", "source_url", "extractor_version", "fragment_hash", "backlog", day("audit_attempt_on"),
        "absences", day("retry_on"), "attempts", "deferred", F.lit(updated_on).cast("date").alias("date"),
    )


def write_state(state: DataFrame, provenance: DataFrame, path: str, version: str, updated_on: str) -> str:
    """The flat state in order of its keys as a new snapshot."""
    return write_snapshot(flat_state(state, provenance, updated_on).orderBy("isin"), path, version)


def widened(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Current keys, and those of the previous, wider artifact that current has not."""
    return carry_forward(current, previous, ["isin"])


def widened_verdict(current: DataFrame, previous: DataFrame) -> DataFrame:
    """(n, n_prior, accepted): whether the widened registry has at least as many keys as the one before."""
    n = widened(current, previous).agg(F.count(F.lit(1)).alias("n"))
    return n.crossJoin(previous.agg(F.count(F.lit(1)).alias("n_prior"))).withColumn("accepted", F.col("n") >= F.col("n_prior"))  # one row each


def from_seed(seed: DataFrame, today: str, name: str = "seed") -> DataFrame:
    """A first state from seed labels."""
    have = F.col("sector").isNotNull()
    return seed.select(
        "isin", "symbol", F.when(have, "classified").otherwise("pending").alias("status"), *TIERS, F.lit(0).alias("attempts"), F.lit(None).cast("date").alias("retry_on"), F.lit(False).alias("deferred"),
        F.lit(False).alias("backlog"), F.lit(None).cast("date").alias("audit_attempt_on"), F.lit(0).alias("absences"), F.when(have, name).alias("source"), F.when(have, F.lit(today).cast("date")).alias("observed_on"),
    )


def changes(current: DataFrame, previous: DataFrame) -> DataFrame:
    """(isin, change): added, removed, taxonomy (a tier differs), renamed; unchanged keys are left out."""
    a, b = current.select("isin", F.struct("symbol", *TIERS).alias("now")), previous.select("isin", F.struct("symbol", *TIERS).alias("was"))
    both = a.join(b, "isin", "full_outer")
    tiers = lambda x: F.struct(*(F.col(f"{x}.{t}") for t in TIERS))
    change = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed").when(~tiers("now").eqNullSafe(tiers("was")), "taxonomy").when(~F.col("now.symbol").eqNullSafe(F.col("was.symbol")), "renamed")
    return both.select("isin", change.alias("change")).filter("change is not null")


def decide_publication(current: DataFrame, previous: DataFrame, provenance: DataFrame, *, observed: int | None = None, expected: int | None = None) -> DataFrame:
    """One row: counts and decision. In this order: unchanged, empty, coverage, diversity, taxonomy_change, missing_provenance, publish."""
    diff = changes(current, previous).join(provenance.select("isin").distinct().withColumn("_p", F.lit(True)), "isin", "left")
    d = diff.agg(F.count(F.lit(1)).alias("n_changed"), F.count_if(F.col("change") == "taxonomy").alias("n_taxonomy"), F.count_if((F.col("change") != "removed") & F.col("_p").isNull()).alias("n_missing"))
    a = current.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("sector").alias("n_sectors"))
    b = previous.agg(F.count(F.lit(1)).alias("n_prior"), F.count_distinct("sector").alias("n_prior_sectors"))
    c = F.col
    short = F.lit(observed is not None and expected is not None and observed < 0.99 * expected)
    decision: Column = (
        F.when(c("n_changed") == 0, "unchanged").when(c("n") == 0, "empty").when(short | (c("n") < 0.99 * c("n_prior")), "coverage")
        .when(c("n_sectors") < 0.5 * c("n_prior_sectors"), "diversity").when((c("n_prior") > 0) & (c("n_taxonomy") > 0.1 * c("n_prior")), "taxonomy_change")
        .when(c("n_missing") > 0, "missing_provenance").otherwise("publish")
    )
    return a.crossJoin(b).crossJoin(d).withColumn("decision", decision)  # one row each


def collection_report(state: DataFrame, attempted: DataFrame, today: str) -> DataFrame:
    """One row of counts over the keys that are not inactive."""
    tried = attempted.select("isin").distinct().withColumn("_tried", F.lit(True))
    t, pending = F.lit(today).cast("date"), F.col("status") == "pending"
    rows = state.filter("status <> 'inactive'").join(tried, "isin", "left")
    out = rows.agg(
        F.count(F.lit(1)).alias("active"), F.count("_tried").alias("attempted"), F.count_if(F.col("status") == "classified").alias("classified"), F.count_if(pending).alias("pending"),
        F.count_if(pending & F.col("backlog")).alias("baseline_pending"), F.count_if(pending & (F.col("retry_on") > t)).alias("retry_pending"), F.count_if(F.col("deferred")).alias("audit_pending"),
    )
    return out.withColumn("coverage_pct", F.round(F.try_divide(F.col("classified") * 100, F.col("active")), 4))

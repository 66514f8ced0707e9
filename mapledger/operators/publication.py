"""Publication runs: claims, batches, outcomes, attempts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mapledger.functions import logs, states
from mapledger.functions.ids import publisher_id
from mapledger.functions.text import basename
from mapledger.operators import selections


def _ts(moment: dt.datetime) -> Column:
    return F.lit(moment).cast("timestamp_ntz")


def updated(df: DataFrame, changes: dict[str, Column], drop: tuple[str, ...] = ()) -> DataFrame:
    """The frame with some columns replaced, in the same order, helper columns dropped."""
    return df.select(*[changes.get(c, F.col(c)).alias(c) for c in df.columns if c not in drop])


# ---- claims ---------------------------------------------------------------


def expire_claims(
    datasets: DataFrame, now: dt.datetime, timeout_seconds: int, campaign: str | None = None
) -> DataFrame:
    """Dataset state with stale claims released."""
    cutoff = now - dt.timedelta(seconds=timeout_seconds)
    hit = (
        (F.col("registration_status") == "ACTIVE") & (F.col("publication_status") == "PENDING")
        & (F.col("publication_claimed_at") < _ts(cutoff))
    )
    if campaign is not None:
        hit = hit & (F.col("campaign") == campaign)
    hit = F.coalesce(hit, F.lit(False))
    return updated(datasets, {
        "publication_claim_id": F.when(~hit, F.col("publication_claim_id")),
        "publication_claimed_at": F.when(~hit, F.col("publication_claimed_at")),
    })


def expired_attempts(
    attempts: DataFrame, datasets: DataFrame, now: dt.datetime, timeout_seconds: int, campaign: str | None = None
) -> DataFrame:
    """Running attempts whose dataset and run match a stale claim."""
    held = selections.expired(datasets, now, timeout_seconds, campaign).select(
        "dataset_id", F.col("publication_claim_id").alias("run_id")
    )
    return attempts.filter(F.col("status") == "RUNNING").join(held, ["dataset_id", "run_id"], "left_semi")


def abandon_attempts(
    attempts: DataFrame, datasets: DataFrame, now: dt.datetime, timeout_seconds: int, campaign: str | None = None
) -> DataFrame:
    """Attempt history with the running attempts of stale claims closed."""
    held = selections.expired(datasets, now, timeout_seconds, campaign).select(
        "dataset_id", F.col("publication_claim_id").alias("run_id"), F.lit(True).alias("_stale")
    )
    j = attempts.join(held, ["dataset_id", "run_id"], "left").select(*attempts.columns, "_stale")
    hit = F.col("_stale").isNotNull() & F.coalesce(F.col("status") == "RUNNING", F.lit(False))
    return updated(j, {
        "finished_at": F.when(hit, _ts(now)).otherwise(F.col("finished_at")),
        "status": F.when(hit, F.lit("ABANDONED")).otherwise(F.col("status")),
        "error_message": F.when(hit, F.lit(states.LEASE_EXPIRED)).otherwise(F.col("error_message")),
    }, drop=("_stale",))


def claim(
    datasets: DataFrame, run_id: str, now: dt.datetime, campaign: str | None = None, limit: int | None = None,
    exclude: DataFrame | None = None, timeout_seconds: int | None = None,
) -> DataFrame:
    """Dataset state after one run claims its datasets.

    A plan, not a lock: parquet has no compare-and-set, so one writer at a time applies
    claims. With a limit the chosen ids form a table of at most that many rows.
    """
    d = datasets if timeout_seconds is None else expire_claims(datasets, now, timeout_seconds, campaign)
    chosen = selections.claimable(d, campaign, limit, exclude).select("dataset_id", F.lit(True).alias("_mine"))
    j = d.join(chosen, "dataset_id", "left").select(*d.columns, "_mine")
    mine = F.col("_mine").isNotNull()
    return updated(j, {
        "publication_claim_id": F.when(mine, F.lit(run_id)).otherwise(F.col("publication_claim_id")),
        "publication_claimed_at": F.when(mine, _ts(now)).otherwise(F.col("publication_claimed_at")),
    }, drop=("_mine",))


def retry_failed(datasets: DataFrame, campaign: str | None = None, limit: int | None = None) -> DataFrame:
    """Failed datasets back to pending; catalog check columns stay as they are."""
    chosen = selections.failed(datasets, campaign, limit).select("dataset_id", F.lit(True).alias("_mine"))
    j = datasets.join(chosen, "dataset_id", "left").select(*datasets.columns, "_mine")
    return updated(
        j, {"publication_status": F.when(F.col("_mine"), F.lit("PENDING")).otherwise(F.col("publication_status"))},
        drop=("_mine",),
    )


# ---- reading publisher output ----------------------------------------------


def aliases(members: DataFrame, scope: list[str]) -> DataFrame:
    """Publisher form -> registered id inside a scope; of two ids with one form the later wins."""
    return members.groupBy(*scope, publisher_id(F.col("dataset_id")).alias("emitted_id")).agg(
        F.max_by("dataset_id", "pos").alias("dataset_id")
    )


def reported_statuses(log: DataFrame, scope: list[str]) -> DataFrame:
    """Every status of the log lines: scope, line_no, match_no, status, emitted_id."""
    hits = log.filter(F.col("line").contains(logs.STATUS_MARK))
    m = hits.select(*scope, "line_no", F.posexplode(logs.status_matches(F.col("line"))).alias("match_no", "m"))
    return m.select(*scope, "line_no", "match_no", "m.status", "m.emitted_id")


def resolve_statuses(log: DataFrame, members: DataFrame, scope: list[str]) -> DataFrame:
    """Reported statuses with their registered id; null where the id is unknown."""
    return reported_statuses(log, scope).join(aliases(members, scope), [*scope, "emitted_id"], "left")


def last_statuses(resolved: DataFrame, scope: list[str]) -> DataFrame:
    """The last status of each known dataset."""
    return resolved.filter(F.col("dataset_id").isNotNull()).groupBy(*scope, "dataset_id").agg(
        F.max_by("status", F.struct("line_no", "match_no")).alias("status")
    )


def error_texts(log: DataFrame, scope: list[str]) -> DataFrame:
    """One error text per scope: last error line, else last failing status line."""
    line = F.col("line")
    hits = log.filter(logs.is_error_line(line) | line.contains("PUB_STATUS=FAIL"))
    return hits.groupBy(*scope).agg(logs.error_text(line, F.col("line_no")).alias("error_text"))


# ---- batch outcomes ---------------------------------------------------------


def staged_members(members: DataFrame, scope: list[str]) -> DataFrame:
    """Batch members with the reason they could not be staged, if any.

    The second and later mapfile of one name inside a batch is refused; only members
    that were staged count. A batch has a fixed number of members, so the window is small.
    """
    name = basename(F.col("mapfile"))
    same_name = Window.partitionBy(*scope, "_name")
    m = members.withColumn("_name", name)
    first = F.min(F.when(F.col("stage_error").isNull(), F.col("pos"))).over(same_name)
    m = m.withColumn("_first", first)
    # Fixed value: message format.
    duplicate = F.concat(F.lit("ValueError: Duplicate mapfile basename in batch: "), F.col("_name"))
    return m.withColumn(
        "stage_error", F.when(F.col("pos") > F.col("_first"), duplicate).otherwise(F.col("stage_error"))
    ).drop("_name", "_first")


def batch_outcomes(
    members: DataFrame, runs: DataFrame, log: DataFrame, record_missing: bool = True, timeout_seconds: int = 600
) -> DataFrame:
    """What one publisher call means for every member of its batch.

    ``members``: run_id, batch_no, pos, dataset_id, mapfile, stage_error. ``runs``: run_id,
    batch_no, exit_code, timed_out, output_length, batch_error, log_file. ``log``: run_id,
    batch_no, line_no, line.

    Adds attempt_status, exit_code, error_message, new_status (null: dataset state stays),
    clears_claim and counted (whether the member counts as a result of the run). A batch
    whose members were all refused never ran: it has no row in ``runs`` and no log, and its
    members fail all the same. Members of any other batch without a run are unreached.
    ``batch_no`` is a number or, with retry batches, a text such as ``1-retry-1``.
    """
    scope = ["run_id", "batch_no"]
    if "string" in {dict(df.dtypes)["batch_no"] for df in (members, runs, log)}:
        members, runs, log = (df.withColumn("batch_no", F.col("batch_no").cast("string")) for df in (members, runs, log))
    m = staged_members(members, scope)
    staged = m.filter(F.col("stage_error").isNull())
    found = last_statuses(resolve_statuses(log, staged, scope), scope).withColumnRenamed("status", "reported")
    m = m.join(found, [*scope, "dataset_id"], "left")
    # One row per batch, joined back instead of a window over its members.
    totals = m.groupBy(*scope).agg(
        F.count("reported").alias("n_reported"),
        F.count("stage_error").alias("n_refused"),
        F.min(F.when(F.col("stage_error").isNull(), F.col("pos"))).alias("first_pos"),
    )
    ran = runs.withColumn("_ran", F.lit(True))
    facts = totals.join(ran, scope, "left").join(error_texts(log, scope), scope, "left")
    j = m.join(facts, scope)
    refused = F.col("stage_error").isNotNull()
    broken = F.col("batch_error").isNotNull()
    reported = F.col("reported").isNotNull()
    silent = (F.col("n_reported") == 0) & (F.col("n_refused") == 0) & F.col("_ran").isNotNull() & F.lit(record_missing)
    deferred = silent & (F.col("pos") == F.col("first_pos"))
    status = (
        F.when(refused | broken, F.lit("FAILED"))
        .when(reported, F.col("reported"))
        .when(deferred, F.when(F.col("timed_out"), F.lit("TIMEOUT")).otherwise(F.lit("NO_STATUS")))
        .otherwise(F.lit("UNREACHED"))
    )
    text = (
        F.when(refused, F.col("stage_error"))
        .when(broken, F.col("batch_error"))
        .when(F.col("reported") == "FAILED", F.col("error_text"))
        .when(reported, F.lit(None))
        .when(deferred, states.missing_status_text(
            F.col("error_text"), F.col("timed_out"), F.lit(timeout_seconds), F.col("exit_code"), F.col("output_length")
        ))
        .otherwise(F.lit(states.UNREACHED))
    )
    final = refused | broken | reported
    return j.select(
        *scope, "pos", "dataset_id",
        status.alias("attempt_status"),
        F.when(refused | broken, F.lit(-1)).otherwise(F.col("exit_code")).cast("int").alias("exit_code"),
        text.alias("error_message"),
        F.when(final, status).alias("new_status"),
        (final | deferred).alias("clears_claim"),
        final.alias("counted"),
        "log_file",
    )


def run_summary(outcomes: DataFrame) -> DataFrame:
    """Per run: counted results, successes, failures and deferred datasets."""
    counted, status = F.col("counted"), F.col("attempt_status")
    return outcomes.groupBy("run_id").agg(
        F.count_if(counted).alias("total"),
        F.count_if(counted & (status == "SUCCESS")).alias("success"),
        F.count_if(counted & (status != "SUCCESS")).alias("failed"),
        F.count_if(status.isin("NO_STATUS", "TIMEOUT")).alias("deferred"),
    )


def run_failures(outcomes: DataFrame) -> DataFrame:
    """The failed results behind a run summary."""
    return outcomes.filter(F.col("counted") & (F.col("attempt_status") != "SUCCESS")).select(
        "run_id", "dataset_id", "exit_code", "error_message"
    )


def unreached(members: DataFrame, completed: DataFrame) -> DataFrame:
    """Members without a result, for the next batch; their order column stays."""
    return members.join(completed.select("run_id", "batch_no", "dataset_id"), ["run_id", "batch_no", "dataset_id"], "left_anti")


# ---- applying results --------------------------------------------------------


def apply_results(datasets: DataFrame, results: DataFrame) -> DataFrame:
    """Dataset state after final results (dataset_id, status): claim and catalog check columns reset."""
    r = results.select("dataset_id", F.col("status").alias("_status"))
    j = datasets.join(r, "dataset_id", "left").select(*datasets.columns, "_status")
    hit = F.col("_status").isNotNull()
    return updated(j, {
        "publication_status": F.coalesce(F.col("_status"), F.col("publication_status")),
        "publication_claim_id": F.when(~hit, F.col("publication_claim_id")),
        "publication_claimed_at": F.when(~hit, F.col("publication_claimed_at")),
        "stac_status": F.when(hit, F.lit("UNCHECKED")).otherwise(F.col("stac_status")),
        "stac_checked_at": F.when(~hit, F.col("stac_checked_at")),
        "stac_http_status": F.when(~hit, F.col("stac_http_status")),
    }, drop=("_status",))


def batch_rank(batch_no: Column) -> Column:
    """An ordering of batch numbers and of retry batches behind their batch (``2`` < ``10`` < ``10-retry-1``)."""
    numbers = F.regexp_extract_all(batch_no.cast("string"), F.lit("[0-9]+"), F.lit(0))
    return F.transform(numbers, lambda n: n.cast("bigint"))


def final_results(outcomes: DataFrame) -> DataFrame:
    """The result that decides each dataset: that of its last run and batch."""
    order = F.struct("run_id", batch_rank(F.col("batch_no")).alias("rank"), "pos")
    return outcomes.filter(F.col("new_status").isNotNull()).groupBy("dataset_id").agg(
        F.max_by("new_status", order).alias("status")
    )


def clear_claims(datasets: DataFrame, released: DataFrame) -> DataFrame:
    """Release claims (dataset_id, claim_id); a null claim_id releases whoever holds it."""
    whoever = released.filter(F.col("claim_id").isNull()).select("dataset_id").distinct().withColumn("_any", F.lit(True))
    holders = released.filter(F.col("claim_id").isNotNull()).select(
        "dataset_id", F.col("claim_id").alias("publication_claim_id")
    ).distinct().withColumn("_held", F.lit(True))
    j = datasets.join(whoever, "dataset_id", "left").join(holders, ["dataset_id", "publication_claim_id"], "left")
    j = j.select(*datasets.columns, "_any", "_held")
    hit = F.col("_any").isNotNull() | F.col("_held").isNotNull()
    return updated(j, {
        "publication_claim_id": F.when(~hit, F.col("publication_claim_id")),
        "publication_claimed_at": F.when(~hit, F.col("publication_claimed_at")),
    }, drop=("_any", "_held"))


def finish_attempts(attempts: DataFrame, finished: DataFrame, now: dt.datetime) -> DataFrame:
    """Close attempts by id; ``finished`` has attempt_id, status, exit_code, log_file, error_message."""
    values = ("status", "exit_code", "log_file", "error_message")
    f = finished.select("attempt_id", F.struct(*values).alias("_new"))
    j = attempts.join(f, "attempt_id", "left").select(*attempts.columns, "_new")
    hit = F.col("_new").isNotNull()
    changes = {v: F.when(hit, F.col("_new")[v]).otherwise(F.col(v)) for v in values}
    changes["finished_at"] = F.when(hit, _ts(now)).otherwise(F.col("finished_at"))
    return updated(j, changes, drop=("_new",))


def attempt_id() -> Column:
    """The id of a dataset's attempt in one run: the same wherever and whenever it is derived."""
    return F.sha2(F.concat_ws("\u0001", F.lit("attempt"), F.col("run_id"), F.col("dataset_id")), 256)


def new_attempts(members: DataFrame, now: dt.datetime, id_expr: Column | None = None) -> DataFrame:
    """Running attempts for staged members."""
    return members.select(
        (attempt_id() if id_expr is None else id_expr).alias("attempt_id"),
        "dataset_id", "run_id", _ts(now).alias("started_at"),
        F.lit(None).cast("timestamp_ntz").alias("finished_at"), F.lit("RUNNING").alias("status"),
        F.lit(None).cast("int").alias("exit_code"), F.lit(None).cast("string").alias("log_file"),
        F.lit(None).cast("string").alias("error_message"),
    )


def last_outcomes(outcomes: DataFrame) -> DataFrame:
    """The outcome that ends each dataset's attempt in a run: that of its last batch."""
    order = F.struct(batch_rank(F.col("batch_no")).alias("rank"), "pos")
    kept = [c for c in outcomes.columns if c not in ("run_id", "dataset_id")]
    return outcomes.groupBy("run_id", "dataset_id").agg(F.max_by(F.struct(*kept), order).alias("_last")).select(
        "run_id", "dataset_id", "_last.*").select(*outcomes.columns)


def attempts_of_outcomes(outcomes: DataFrame, now: dt.datetime, id_expr: Column | None = None) -> DataFrame:
    """Closed attempts as history rows, one per outcome."""
    return outcomes.select(
        (attempt_id() if id_expr is None else id_expr).alias("attempt_id"),
        "dataset_id", "run_id", _ts(now).alias("started_at"), _ts(now).alias("finished_at"),
        F.col("attempt_status").alias("status"), "exit_code", "log_file", "error_message",
    )

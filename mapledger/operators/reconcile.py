"""Comparison of the catalog with a remote catalog's recorded responses."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapledger import schemas
from mapledger.functions import states
from mapledger.functions.ids import item_url, publisher_id
from mapledger.functions.once import with_once
from mapledger.functions.text import iso_timestamp, json_kind, member, text_member
from mapledger.operators.publication import updated
from mapledger.operators.reports import latest_success
from mapledger.sources.responses import body_text

# Defaults of a comparison.
GRACE_SECONDS = 600


def judged_responses(responses: DataFrame, retries: int | None = None) -> DataFrame:
    """One row per requested item: the first conclusive response, else the last error.

    All recorded attempts count unless ``retries`` bounds them. Bodies are text or bytes; hashes are of the bytes.

    Not found and a readable success are conclusive, as is any status outside the
    retried ones; overload, server errors, transport errors and unreadable bodies are
    retried. Responses condense to one row per item before the shuffle.
    """
    counted = responses if retries is None else responses.filter(F.col("attempt_no") <= retries)
    as_bytes = isinstance(responses.schema["body"].dataType, T.BinaryType)
    r = with_once(counted, _doc=F.try_parse_json(body_text(F.col("body")) if as_bytes else F.col("body")))
    d, status = F.col("_doc"), F.col("http_status")
    is_object = F.coalesce(json_kind(d) == "OBJECT", F.lit(False))
    present = is_object & F.coalesce(
        (text_member(d, "$.id") == F.col("item_id")) & (json_kind(member(d, "$.id")) == "STRING")
        & (text_member(d, "$.collection") == F.col("collection_id"))
        & (json_kind(member(d, "$.collection")) == "STRING") & (text_member(d, "$.type") == "Feature"),
        F.lit(False),
    )
    answered = F.col("error").isNull() & status.isNotNull()
    outcome = (
        F.when(~answered, F.lit(None))
        .when(status == 404, F.lit("ABSENT"))
        .when((status == 200) & d.isNull(), F.lit(None))
        .when((status == 200) & present, F.lit("PRESENT"))
        .when(status == 200, F.lit("MISMATCH"))
        .when((status == 429) | (status >= 500), F.lit(None))
        .otherwise(F.lit("ERROR"))
    )
    # Message texts.
    judged = F.col("o")
    text = (
        F.when(judged == "MISMATCH", F.lit(states.MISMATCH_TEXT))
        .when(judged == "ERROR", F.concat(F.lit("Unexpected HTTP status "), status.cast("string")))
    )
    retried = F.coalesce(
        F.col("error"),
        F.when(status == 200, F.lit("JSONDecodeError: response body is not valid JSON")),
        F.when(status == 429, F.lit("HTTPError: 429 Client Error")),
        F.concat(F.lit("HTTPError: "), status.cast("string"), F.lit(" Server Error")),
        F.lit(states.NO_RESPONSE_TEXT),
    )
    ok200 = (status == 200) & is_object
    answer = F.struct(
        judged.alias("outcome"), status.alias("http_status"),
        F.when(ok200, text_member(d, "$.id")).alias("response_item_id"),
        F.when(ok200, text_member(d, "$.collection")).alias("response_collection"),
        states.response_hash(F.col("body")).alias("response_hash"), text.alias("error_message"),
    )
    s = with_once(r, o=outcome).select(
        "collection_id", "item_id", "attempt_no", "o", answer.alias("answer"), retried.alias("retried")
    )
    final = F.col("o").isNotNull()
    g = s.groupBy("collection_id", "item_id").agg(
        F.min_by("answer", F.when(final, F.col("attempt_no"))).alias("a"),
        F.max_by("retried", F.when(~final, F.col("attempt_no"))).alias("last_error"),
    )
    a = F.col("a")
    return g.select(
        "collection_id", "item_id",
        F.coalesce(a["outcome"], F.lit("ERROR")).alias("outcome"),
        a["http_status"].alias("http_status"), a["response_item_id"].alias("response_item_id"),
        a["response_collection"].alias("response_collection"), a["response_hash"].alias("response_hash"),
        F.when(a.isNull(), F.col("last_error")).otherwise(a["error_message"]).alias("error_message"),
    )


def in_grace(publication_status: Column, latest: Column, now: dt.datetime, grace_seconds: int) -> Column:
    """Published so recently that the remote catalog may not know yet."""
    edge = now - dt.timedelta(seconds=grace_seconds)
    return F.coalesce(
        (publication_status == "SUCCESS") & (latest > F.lit(edge).cast("timestamp_ntz")), F.lit(False)
    )


def compare(
    scope: DataFrame, attempts: DataFrame, responses: DataFrame, base_url: str, now: dt.datetime,
    retries: int | None = None, grace_seconds: int = GRACE_SECONDS,
) -> DataFrame:
    """Outcome of every dataset in scope (dataset_id, campaign, project, publication_status).

    Responses to others, and to datasets in their grace period, are left out before any body is read."""
    recent = latest_success(attempts)
    d = scope.join(recent, "dataset_id", "left").withColumns({
        "collection_id": F.col("project"), "item_id": publisher_id(F.col("dataset_id")),
    })
    waiting = in_grace(F.col("publication_status"), F.col("latest_success"), now, grace_seconds)
    asked = d.filter(~waiting).select("collection_id", "item_id").distinct()
    answers = judged_responses(responses.join(asked, ["collection_id", "item_id"], "left_semi"), retries)
    j = d.join(answers, ["collection_id", "item_id"], "left")
    moment = F.lit(now).cast("timestamp_ntz")

    def unless_waiting(column: Column) -> Column:
        return F.when(~waiting, column)

    return j.select(
        "dataset_id", "campaign", "project", "publication_status", "latest_success", "collection_id", "item_id",
        item_url(base_url, F.col("collection_id"), F.col("item_id")).alias("request_url"),
        moment.alias("started_at"), moment.alias("finished_at"),
        F.when(waiting, F.lit("WAITING")).otherwise(F.coalesce("outcome", F.lit("ERROR"))).alias("outcome"),
        unless_waiting(F.col("http_status")).alias("http_status"),
        unless_waiting(F.col("response_item_id")).alias("response_item_id"),
        unless_waiting(F.col("response_collection")).alias("response_collection"),
        unless_waiting(F.col("response_hash")).alias("response_hash"),
        F.when(waiting, F.lit(states.GRACE_TEXT))
        .when(F.col("outcome").isNull(), F.lit(states.NO_RESPONSE_TEXT))
        .otherwise(F.col("error_message")).alias("error_message"),
    )


def classified(checks: DataFrame) -> DataFrame:
    return checks.withColumn(
        "classification", states.drift_class(F.col("publication_status"), F.col("outcome"))
    )


def actionable(checks: DataFrame) -> DataFrame:
    """Drift and interface errors, in report columns."""
    rows = classified(checks).filter(~F.col("classification").isin("CONSISTENT", "WAITING"))
    return rows.withColumn("checked_at", iso_timestamp(F.col("finished_at"))).select(*schemas.DRIFT_FIELDS)


def discrepancies(checks: DataFrame, limit: int = 20) -> DataFrame:
    return checks.filter(F.col("outcome") != "PRESENT").orderBy(F.asc_nulls_last("dataset_id")).limit(limit).select(
        "outcome", "dataset_id", "error_message"
    )


def outcome_counts(checks: DataFrame) -> DataFrame:
    return checks.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def state_comparisons(checks: DataFrame) -> DataFrame:
    return checks.groupBy(F.concat_ws("/", "publication_status", "outcome").alias("comparison")).agg(
        F.count(F.lit(1)).alias("n")
    )


def classification_counts(checks: DataFrame) -> DataFrame:
    return classified(checks).groupBy("classification").agg(F.count(F.lit(1)).alias("n"))


def check_rows(checks: DataFrame, run_id: str, id_expr: Column | None = None) -> DataFrame:
    """History rows of a comparison."""
    extra = {"check_id": F.expr("uuid()") if id_expr is None else id_expr, "run_id": F.lit(run_id)}
    return checks.select(*[extra.get(f.name, F.col(f.name)).alias(f.name) for f in schemas.CHECKS.fields])


def apply_checks(datasets: DataFrame, checks: DataFrame) -> DataFrame:
    """Dataset state after a comparison; the publication status is never touched."""
    c = checks.select("dataset_id", F.struct("outcome", "finished_at", "http_status").alias("_c"))
    j = datasets.join(c, "dataset_id", "left").select(*datasets.columns, "_c")
    hit = F.col("_c").isNotNull()
    return updated(j, {
        "stac_status": F.when(hit, F.col("_c.outcome")).otherwise(F.col("stac_status")),
        "stac_checked_at": F.when(hit, F.col("_c.finished_at")).otherwise(F.col("stac_checked_at")),
        "stac_http_status": F.when(hit, F.col("_c.http_status")).otherwise(F.col("stac_http_status")),
    }, drop=("_c",))

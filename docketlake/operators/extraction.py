"""From digest texts to validated nested records."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from docketlake.functions import answers as A, text as X
from docketlake.functions.prompts import DEFAULT_TEMPLATE, build_prompt
from docketlake.operators.calls import CALL_LOG, INITIAL_DELAY, MAX_JITTER, RETRYABLE, ask_once
from docketlake.operators.keys import known_keys, top_per_group
from docketlake.schemas import ACTION_ELEMENT

# Fixed value.
NO_SECTIONS = "No enforcement action sections detected by pre-filter"


def pending_digests(texts: DataFrame, done: DataFrame, key: str = "digest_date",
                    limit: int | None = None, order: str | None = None) -> DataFrame:
    """Digests with an enforcement section and no record yet, at most ``limit`` per year.

    With a limit, ``order`` (the key, if not given) must name one digest each.

    The pre-filter only looks at texts that have no record: its condition names a
    column of the other side, so it cannot move below the join.
    """
    known = known_keys(done, key).withColumn("_known", F.lit(True))
    new_hit = F.when(F.col("_known").isNull(), X.has_section(F.col("text")))
    pending = texts.join(known, key, "left").where(new_hit).select(*texts.columns)
    if limit is None:
        return pending
    # Only the names are ranked; the texts follow them.
    order = order or key
    chosen = top_per_group(pending.select("year", order), "year", order, limit)
    return pending.join(chosen.select(order), order, "left_semi").select(*texts.columns)


def prefilter(texts: DataFrame) -> DataFrame:
    return texts.withColumn("has_actions", X.has_section(F.col("text")))


def prefilter_tally(texts: DataFrame) -> DataFrame:
    """Number of digests with and without an enforcement section."""
    return prefilter(texts).groupBy("has_actions").agg(F.count("*").alias("n"))


def prompts(texts: DataFrame, template: str = DEFAULT_TEMPLATE) -> DataFrame:
    """Prompt per digest; lines of tables are left out of the text."""
    return texts.withColumn("prompt", build_prompt(X.drop_table_lines(F.col("text")), template))


def call_extractor(work: DataFrame, make_client: Callable[[], Callable[[str], str]],
                   key: str = "digest_date", concurrency: int | None = None) -> DataFrame:
    """Call a caller-supplied function once for every prompt and log the try.

    ``make_client`` runs once per task and returns ``prompt -> answer``. ``concurrency``
    spreads the prompts over that many tasks, which bounds how many run at once. For
    calls that are tried again and whose log survives the job, see
    :func:`docketlake.operators.calls.call_in_batches`.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = make_client()
        for batch in batches:
            rows = [(k, 0, *ask_once(ask, prompt)) for k, prompt in zip(batch["prompt_key"], batch["prompt"])]
            out = pd.DataFrame(rows, columns=["prompt_key", "attempt", "http_status", "response", "error"])
            out["http_status"] = out["http_status"].astype("Int32")
            yield out

    slim = work.select(F.col(key).cast("string").alias("prompt_key"), "prompt")
    if concurrency is not None:
        slim = slim.repartition(concurrency)
    return slim.mapInPandas(run, CALL_LOG)


def retry_schedule(attempts: DataFrame, key: str, initial_delay: float = INITIAL_DELAY) -> DataFrame:
    """Which tries may be repeated, and how long to wait before the next one.

    The jitter is a hash of key and attempt, so a recomputed row waits the same.
    """
    base = F.lit(initial_delay) * F.pow(F.lit(2.0), F.col("attempt"))
    jitter = F.pmod(F.xxhash64(key, "attempt"), F.lit(1 << 20)) / float(1 << 20) * MAX_JITTER
    return (
        attempts.withColumn("retryable", F.coalesce(F.col("http_status").isin(RETRYABLE), F.lit(False)))
        .withColumn("base_delay_s", base)
        .withColumn("wait_s", base * (1 + jitter))
    )


def resolve_calls(log: DataFrame, key: str, valid: Column) -> DataFrame:
    """What a log of calls means for each digest.

    The first valid answer wins; an invalid answer or a status that is not
    retryable ends the tries as failed, a failure without a status as error; when
    the tries run out the digest has failed.
    """
    status = F.col("http_status")
    verdict = (
        F.when(status.isNull(), "error")
        .when(status == 200, F.when(valid, "ok").otherwise("failed"))
        .when(status.isin(RETRYABLE), "retry")
        .otherwise("failed")
    )
    message = F.when(status == 200, F.when(~valid, "invalid answer")).otherwise(
        F.coalesce(F.concat(F.lit("HTTP "), status.cast("string")), "error"))
    rows = log.select(key, "attempt", verdict.alias("verdict"), message.alias("message"))
    one = F.struct("attempt", "verdict", "message")
    chosen = rows.groupBy(key).agg(
        F.coalesce(F.min_by(one, F.when(F.col("verdict") != "retry", F.col("attempt"))),
                   F.max_by(one, F.col("attempt"))).alias("v"),
        F.min("attempt").alias("first"),
    )
    return chosen.select(
        key,
        F.when(F.col("v.verdict") == "retry", "failed").otherwise(F.col("v.verdict")).alias("status"),
        (F.col("v.attempt") - F.col("first") + 1).alias("attempts"),
        F.col("v.message").alias("message"),
    )


def judge_responses(responses: DataFrame) -> DataFrame:
    """Outcome of every raw answer in column ``response``: adds outcome, error_class, error_path."""
    parsed = A.parse_answer(A.clean_answer(F.col("response")))
    return (
        responses.withColumn("_v", parsed)
        .withColumn("_j", A.validate_answer(F.col("_v")))
        .select(*responses.columns, "_j.*")
    )


def extraction_outcomes(responses: DataFrame, *keep: str) -> DataFrame:
    """Nested record per answered digest, with the outcome that decides its fate.

    ``keep``: the columns that name the digest, its date if none are given.

    ``ok``: the actions as given. ``failed``: counted as having actions, none
    kept, the note names the reason. ``error``: not to be stored; it stays pending.
    """
    parsed = A.parse_answer(A.clean_answer(F.col("response")))
    judged = responses.withColumn("_v", parsed).withColumn("_j", A.validate_answer(F.col("_v")))
    ok = F.col("_j.outcome") == "ok"
    none = F.array().cast(f"array<{ACTION_ELEMENT}>")
    actions = F.when(ok, A.answer_actions(F.col("_v"))).otherwise(none)
    return judged.select(
        *(keep or ["digest_date"]),
        F.when(ok, F.size(actions) > 0).otherwise(F.lit(True)).alias("has_enforcement_actions"),
        actions.alias("actions"),
        F.when(ok, A.answer_notes(F.col("_v")))
        .otherwise(F.concat(F.lit("Extraction failed: "), F.col("_j.error_class")))
        .alias("extraction_notes"),
        F.col("_j.outcome").alias("outcome"),
        F.col("_j.error_class").alias("error_class"),
        F.col("_j.error_path").alias("error_path"),
    )


def without_sections(texts: DataFrame, *keep: str) -> DataFrame:
    """Empty nested records for digests that the pre-filter rejects; ``keep``: more columns to carry."""
    return texts.where(~X.has_section(F.col("text"))).select(
        *keep, "digest_date", F.lit(False).alias("has_enforcement_actions"),
        F.array().cast(f"array<{ACTION_ELEMENT}>").alias("actions"),
        F.lit(NO_SECTIONS).alias("extraction_notes"),
    )


def extraction_stats(outcomes: DataFrame, skipped: DataFrame) -> DataFrame:
    """Counts of an extraction run by year, with a grand total in the row of year null.

    ``outcomes``: year, outcome, has_enforcement_actions, actions. ``skipped``:
    year of every digest that had a record before.
    """
    written = F.col("outcome").isin("ok", "failed")
    rows = outcomes.select(
        "year", F.lit(1).alias("total"), F.lit(0).alias("skipped"),
        written.cast("int").alias("processed"),
        (written & F.col("has_enforcement_actions")).cast("int").alias("with_actions"),
        F.when(written, F.size("actions")).otherwise(0).alias("total_actions"),
        (F.col("outcome") == "error").cast("int").alias("errors"),
        (F.col("outcome") == "failed").cast("int").alias("failed"),
    ).unionAll(skipped.select(
        "year", F.lit(0), F.lit(1), F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(0)))
    names = ["total", "skipped", "processed", "with_actions", "total_actions", "errors", "failed"]
    return rows.rollup("year").agg(*[F.sum(n).alias(n) for n in names])

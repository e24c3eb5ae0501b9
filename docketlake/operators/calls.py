"""Calls to a caller's extractor, in micro-batches, with retries that wait in state.

The prompts are a stream of files. Every micro-batch asks for the prompts of a few files
and for those whose waiting time is over, and stores its log before the next one begins: a
run that dies asks again for one batch at most. A prompt that is to be tried again waits as
a timer of its key, so it holds no core, and any number of them wait at the same time.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Callable, Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor

from docketlake.session import REQUIRED
from docketlake.sources.files import drop_folder, path_exists

# Workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values.
RETRYABLE = [503, 429, 500, 502, 504]
MAX_TRIES = 5
INITIAL_DELAY = 2.0
MAX_JITTER = 0.25

PROMPTS = "prompt_key STRING, prompt STRING"
CALL_LOG = "prompt_key STRING, attempt INT, http_status INT, response STRING, error STRING"
#: Prompts of a micro-batch, and seconds between two.
BATCH, PAUSE_S = 1000, 1.0


def ask_once(ask: Callable[[str], str], prompt: str) -> tuple[int | None, str | None, str | None]:
    """(status, answer, error) of one call."""
    try:
        return 200, ask(prompt), None
    except Exception as e:  # the log records whatever the client raised
        return getattr(e, "status_code", None), None, str(e)


def delay_s(key: str, attempt: int, initial: float) -> float:
    """Seconds to wait after a try; the jitter is a hash, so a replayed batch waits the same."""
    jitter = MAX_JITTER * (zlib.crc32(f"{key}/{attempt}".encode()) % 1000) / 1000
    return initial * 2 ** attempt * (1 + jitter)


class _Calls(StatefulProcessor):
    """One try per prompt and turn; what may be tried again is kept with a timer."""

    def __init__(self, make_client: Callable[[], Callable[[str], str]], max_tries: int, initial_delay: float):
        self.make_client, self.max_tries, self.initial_delay = make_client, max_tries, initial_delay

    def init(self, handle) -> None:
        self.handle, self.ask = handle, self.make_client()
        self.waiting = handle.getValueState("waiting", "prompt STRING, attempt INT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for n, row in enumerate(rows):
            if n == 0:   # a key has one prompt
                yield self._try(key, row.prompt, 0, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        prompt, attempt = self.waiting.get()
        yield self._try(key, prompt, attempt, timerValues)

    def _try(self, key, prompt: str, attempt: int, timers) -> Row:
        status, answer, error = ask_once(self.ask, prompt)
        again = status in RETRYABLE and attempt + 1 < self.max_tries
        if again:
            self.waiting.update((prompt, attempt + 1))
            # A timer that is due at once is never looked at again.
            wait = max(1, int(1000 * delay_s(key[0], attempt, self.initial_delay)))
            self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + wait)
        elif attempt:
            self.waiting.clear()
        return Row(prompt_key=key[0], attempt=attempt, http_status=status, response=answer, error=error, last=not again)

    def close(self) -> None:
        pass


def store_prompts(work: DataFrame, path: str, batch: int = BATCH) -> None:
    """Write (prompt_key, prompt) as files of at most ``batch`` prompts."""
    work.select(F.col("prompt_key").cast("string").alias("prompt_key"), "prompt").write.option(
        "maxRecordsPerFile", batch).parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The stored tries of a run."""
    schema = f"{CALL_LOG}, last BOOLEAN, batch BIGINT"
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def call_in_batches(spark: SparkSession, prompts: str, log: str, checkpoint: str,
                    make_client: Callable[[], Callable[[str], str]], max_tries: int = MAX_TRIES,
                    initial_delay: float | None = None, concurrency: int | None = None,
                    pause_s: float = PAUSE_S) -> None:
    """Ask for every prompt stored below ``prompts`` until it is answered or given up.

    ``make_client`` runs once per task and returns ``prompt -> answer``. An exception with a
    ``status_code`` in the retryable set is tried again after a growing delay, any other ends
    the tries. The tries go to ``log``, a folder per micro-batch; with the same ``checkpoint``
    a run that died goes on where its log ends. ``concurrency`` bounds the calls at a time.
    """
    total = spark.read.schema(PROMPTS).parquet(prompts).select("prompt_key").distinct().count()
    ended = {r.batch: r.n for r in read_log(spark, log).groupBy("batch").agg(
        F.count_if("last").alias("n")).collect()}   # one row per micro-batch of this run
    if sum(ended.values()) >= total:
        return
    session = spark.newSession()
    for key, value in REQUIRED.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.streaming.stateStore.providerClass",
                     "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    session.conf.set("spark.sql.shuffle.partitions", str(concurrency or spark.sparkContext.defaultParallelism))
    calls = (
        session.readStream.schema(PROMPTS).option("maxFilesPerTrigger", 1).parquet(prompts)
        .groupBy("prompt_key")
        .transformWithState(_Calls(make_client, max_tries, INITIAL_DELAY if initial_delay is None else initial_delay),
                            f"{CALL_LOG}, last BOOLEAN", "append", "processingTime")
    )

    def store(batch: DataFrame, number: int) -> None:
        path = f"{log}/batch={number}"
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)   # asks: once only
        n, last = session.read.schema(f"{CALL_LOG}, last BOOLEAN").parquet(path).agg(
            F.count("*"), F.count_if("last")).first()
        ended[number] = last
        if not n:
            drop_folder(session, path)

    query = (calls.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
             .trigger(processingTime=f"{pause_s} seconds").start())
    try:
        while sum(ended.values()) < total and not query.awaitTermination(0.1):
            pass
    finally:
        query.stop()

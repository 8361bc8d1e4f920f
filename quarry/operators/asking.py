"""Requests to a model, sent in batches; what comes back is appended to a store, and so are errors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.schemas import ANSWERS, COMPLETIONS

# Prompts that one call gets, and how often a request is sent before it is given up.
BATCH, ATTEMPTS = 32, 3

Complete = Callable[[list[str]], list[str | None]]


class AnswerStore:
    """Answers (task, request_id, response, error, attempt) in Parquet files that are only ever added to.

    A job that dies adds nothing, since Spark moves files in place when it commits; requests it had answered are then sent again.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        spark.createDataFrame([], ANSWERS).write.mode("append").parquet(path)

    def answers(self) -> DataFrame:
        return self.spark.read.schema(ANSWERS).parquet(self.path)

    def completions(self) -> DataFrame:
        """The answers as the other operators take them: (task, request_id, response)."""
        return self.answers().filter("response IS NOT NULL").select(*COMPLETIONS.fieldNames())

    def log(self) -> DataFrame:
        """(task, request_id, answered, attempts, last_error) of every request that was ever sent."""
        return (
            self.answers()
            .groupBy("task", "request_id")
            .agg(
                F.bool_or(F.col("response").isNotNull()).alias("answered"),
                F.max("attempt").alias("attempts"),
                F.max_by("error", F.when(F.col("error").isNotNull(), F.col("attempt"))).alias("last_error"),
            )
        )

    def open_requests(self, requests: DataFrame, task: str, attempts: int = ATTEMPTS) -> DataFrame:
        """Distinct (request_id, prompt, attempt) that are to be sent: neither answered nor given up."""
        known = self.log().filter(F.col("task") == task).select("request_id", "answered", "attempts")
        once = requests.groupBy("request_id").agg(F.min("prompt").alias("prompt"))
        sent = F.coalesce("attempts", F.lit(0))
        return (
            once.join(known, "request_id", "left")
            .filter(~F.coalesce("answered", F.lit(False)) & (sent < attempts))
            .select("request_id", "prompt", (sent + 1).alias("attempt"))
        )

    def ask(
        self, requests: DataFrame, task: str, complete: Complete, batch: int = BATCH, attempts: int = ATTEMPTS, tasks: int | None = None
    ) -> DataFrame:
        """Send what is open of ``requests(request_id, prompt)`` once, add what came to the store, and return the log of these requests.

        ``complete`` gets up to ``batch`` prompts and gives a response or None for each.  If it raises, or gives another
        number of responses, the requests of this call get the error, and no others.  ``tasks`` bounds the calls at one time.
        """

        def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for begin in range(0, len(frame), batch):
                    part = frame.iloc[begin : begin + batch]
                    try:
                        responses = complete(part["prompt"].tolist())
                        if len(responses) != len(part):
                            raise ValueError(f"{len(responses)} responses for {len(part)} prompts")
                        errors = [None if r is not None else "no response" for r in responses]
                    except Exception as error:  # of the model: its requests are told, the job goes on
                        responses, errors = [None] * len(part), [f"{type(error).__name__}: {error}"] * len(part)
                    yield pd.DataFrame(
                        {
                            "task": task,
                            "request_id": part["request_id"].to_numpy(),
                            "response": responses,
                            "error": errors,
                            "attempt": part["attempt"].to_numpy(),
                        }
                    )

        to_send = self.open_requests(requests, task, attempts)
        to_send = to_send if tasks is None else to_send.repartition(tasks)
        to_send.mapInPandas(send, ANSWERS).write.mode("append").parquet(self.path)
        return self.log().filter(F.col("task") == task).join(requests.select("request_id").distinct(), "request_id", "left_semi")

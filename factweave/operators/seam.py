"""The seam for model calls: requests join to recorded responses, so every query stays
reproducible; a provider may fill what is missing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def request_key(prompt_ref: str, text: str) -> F.Column:  # type: ignore[name-defined]
    return F.sha2(F.concat_ws("\n", prompt_ref, text), 256)


def recorded(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Requests (request_key, ..) with the last recorded response, null where there is
    none."""
    last = responses.groupBy("request_key").agg(F.max_by("response", "recorded_at").alias("response"))
    return requests.join(last, "request_key", "left")


def filled(requests: DataFrame, provider: Callable[[list[str]], list[str]]) -> DataFrame:
    """Responses of ``provider`` to requests (request_key, text), batch by batch on the
    executors."""

    def work(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame({"request_key": part["request_key"], "response": provider(part["text"].tolist())})

    return requests.select("request_key", "text").mapInPandas(work, "request_key string, response string")

"""The circuit breaker over a stream of attempts: state is a run length and a flag for each provider."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OUT = "provider string, tripped_at long"
STATE = "run long, tripped boolean"


def trips(attempts: DataFrame, threshold: int) -> DataFrame:
    """(provider, tripped_at) once for each provider whose consecutive errors reach the threshold; sticky from then on.

    attempts (seq, provider, outcome) is a streaming DataFrame. A skipped source
    neither adds to a run nor ends it. Rows of one micro-batch are taken in order of seq; state never grows beyond one row a
    provider.
    """
    import pandas as pd

    def step(key, frames, state) -> Iterator[pd.DataFrame]:
        run, tripped = state.get if state.exists else (0, False)
        rows = pd.concat(list(frames)).sort_values("seq")
        at = None
        for seq, outcome in zip(rows["seq"], rows["outcome"], strict=True):
            if tripped:
                break
            run = run + 1 if outcome == "error" else 0
            if run >= threshold:
                tripped, at = True, int(seq)
        state.update((int(run), bool(tripped)))
        if at is not None:
            yield pd.DataFrame({"provider": [key[0]], "tripped_at": [at]})

    grouped = attempts.select("provider", F.col("seq").cast("long").alias("seq"), "outcome").filter("outcome <> 'skipped'").groupBy("provider")
    return grouped.applyInPandasWithState(step, OUT, STATE, "append", "NoTimeout")

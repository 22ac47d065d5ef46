"""Python work that needs an expensive object once per task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


def map_with_setup(
    df: DataFrame, setup: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: str
) -> DataFrame:
    """Apply a per-batch function that ``setup`` builds once per task.

    For a language model or another helper that only Python has; whatever
    built-in functions can say should be said with them.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        worker = None
        for batch in batches:
            if worker is None:
                worker = setup()
            yield worker(batch)

    return df.mapInPandas(run, schema)

"""Map with a setup step (the rich-function ``open`` hook).

Most per-row maps are column expressions. When a map needs setup that is
too costly per row (load a model, compile patterns, open a client), run the
setup once per partition and the map over Arrow batches: ``mapInPandas``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame


def map_with_setup(df: DataFrame, setup: Callable[[], Any],
                   fn: Callable[[Any, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``fn(resource, batch) -> batch`` after ``setup()`` ran once in each task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = setup()
        for batch in batches:
            yield fn(resource, batch)
    return df.mapInPandas(run, schema)

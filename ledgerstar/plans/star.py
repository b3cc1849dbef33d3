"""The tables a view or report reads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Star:
    staging: DataFrame
    fact: DataFrame
    dim_date: DataFrame
    dim_store: DataFrame
    dim_product: DataFrame
    dim_category: DataFrame
    dim_vendor: DataFrame
    dim_packaging: DataFrame

    def dimension(self, name: str) -> DataFrame:
        return getattr(self, name)

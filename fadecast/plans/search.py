"""Parameter grids: enumeration, sampling, merging, choosing and storing."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fadecast.session import shared_path
from fadecast.sources.files import read_csv, write_csv

# Fixed value: seed of the random search.
SEED = 1502


@dataclass(frozen=True)
class ParamGrid:
    """Lists of values per parameter; names sorted, the last one fastest."""

    lists: Mapping[str, Sequence]

    @property
    def names(self) -> list[str]:
        return sorted(self.lists)

    @property
    def size(self) -> int:
        return math.prod(len(v) for v in self.lists.values())

    def _strides(self) -> dict[str, int]:
        out, s = {}, 1
        for name in reversed(self.names):
            out[name] = s
            s *= len(self.lists[name])
        return out

    def column(self, name: str, idx: str | Column) -> Column:
        c = F.col(idx) if isinstance(idx, str) else idx
        values = F.array(*[F.lit(v) for v in self.lists[name]])
        place = F.floor(c / self._strides()[name]) % len(self.lists[name])
        return F.get(values, place.cast("int"))

    def config(self, idx: int) -> dict:
        st = self._strides()
        return {"config_id": idx} | {
            n: self.lists[n][idx // st[n] % len(self.lists[n])] for n in self.names
        }

    def all_configs(self) -> list[dict]:
        return [self.config(i) for i in range(self.size)]

    def sample(self, spark: SparkSession, n_iter: int, seed: int = SEED) -> list[dict]:
        """``n_iter`` different configurations, the same ones for a seed.

        The driver keeps only the chosen numbers, at most ``n_iter``.
        """
        ids = (
            spark.range(self.size)
            .orderBy(F.xxhash64(F.lit(seed), "id"), "id")
            .limit(n_iter)
            .collect()
        )
        return [self.config(r["id"]) for r in ids]


def with_every_config(df: DataFrame, grid: ParamGrid) -> DataFrame:
    """Repeat each row (a series or a fold) for every configuration.

    The configurations are generated from their number in the row's own task.
    """
    d = df.withColumn(
        "config_id",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(grid.size - 1).cast("long"))),
    )
    return d.withColumns({n: grid.column(n, "config_id") for n in grid.names})


def merge_params(df: DataFrame, fixed: Mapping[str, object]) -> DataFrame:
    """Fixed parameters are added to each row and win over its own."""
    return df.withColumns({k: F.lit(v) for k, v in fixed.items()})


def attach_params(scores: DataFrame, configs: Sequence[dict]) -> DataFrame:
    """Add the parameters of each ``config_id`` to a score table."""
    out = scores
    for name in [n for n in configs[0] if n != "config_id"]:
        pairs = [F.lit(v) for c in configs for v in (c["config_id"], c[name])]
        lookup = F.create_map(*pairs)
        out = out.withColumn(name, lookup[F.col("config_id").cast("int")])
    return out


def tall(wide: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per parameter: ``key, value``."""
    d = wide.select(*[F.col(n).cast("double").alias(n) for n in names])
    return d.unpivot([], list(names), "key", "value")


def wide(tall_df: DataFrame, names: Sequence[str]) -> DataFrame:
    return tall_df.groupBy().pivot("key", list(names)).agg(F.first("value"))


def store_and_reload(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write a parameter table as CSV and read it back with its own schema."""
    path = shared_path(spark, name)
    write_csv(df, path)
    return read_csv(spark, path, df.schema)


def cast_params(df: DataFrame, ints: Sequence[str]) -> DataFrame:
    """Listed parameters to whole numbers, towards zero."""
    return df.withColumns({c: F.col(c).cast("long") for c in ints})

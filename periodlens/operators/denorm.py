"""Star denormalisation: fact ⟕ many code tables (J1), with per-period keep-first lookups.

Each dimension is declared once (key columns, carried columns).  Lookups are
trimmed and reduced to one row per key before the join, so the output row count always
equals the fact row count.  The join strategy is left to Catalyst's size estimates and AQE.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodlens.functions.text import trim_all
from periodlens.operators.profile import keep_first


@dataclass
class Dim:
    """One dimension of the star.

    fact_keys / dim_keys: equi-join columns (same length, same order).
    carry: dimension columns added to the fact (renamed via ``rename``).
    unique: the dimension key is known unique, skip the keep-first pass.
    order: column giving file order for keep-first (required unless ``unique``).
    """
    name: str
    df: DataFrame
    fact_keys: tuple
    dim_keys: tuple
    carry: tuple
    rename: dict = field(default_factory=dict)
    unique: bool = False
    order: str | None = None
    trim_keys: bool = True


def prepare_dim(dim: Dim) -> DataFrame:
    d = dim.df
    if dim.trim_keys:
        d = d.withColumns({k: trim_all(k) for k in dim.dim_keys
                           if dict(d.dtypes).get(k) == "string"})
    cols = list(dict.fromkeys([*dim.dim_keys, *dim.carry] + ([dim.order] if dim.order else [])))
    d = d.select(*cols)
    if not dim.unique:
        if dim.order is None:
            raise ValueError(f"dimension {dim.name}: keep-first needs an order column")
        d = keep_first(d, list(dim.dim_keys), dim.order)
    d = d.select(*dim.dim_keys, *dim.carry)
    return d.select(*[F.col(k).alias(f"__{dim.name}_{k}") for k in dim.dim_keys],
                    *[F.col(c).alias(dim.rename.get(c, c)) for c in dim.carry])


def denormalize(fact: DataFrame, dims) -> DataFrame:
    """Left-join every dimension onto ``fact`` in order; a dimension whose fact key columns are
    absent is skipped (the period lacks that code), as are carried columns already present."""
    out = fact
    for dim in dims:
        if not all(k in out.columns for k in dim.fact_keys):
            continue
        d = prepare_dim(dim)
        new_cols = [dim.rename.get(c, c) for c in dim.carry]
        clash = [c for c in new_cols if c in out.columns]
        if clash:
            raise ValueError(f"dimension {dim.name}: carried columns already on the fact: {clash}")
        cond = None
        for fk, dk in zip(dim.fact_keys, dim.dim_keys):
            e = F.col(fk) == F.col(f"__{dim.name}_{dk}")
            cond = e if cond is None else cond & e
        out = out.join(d, on=cond, how="left").drop(*[f"__{dim.name}_{k}" for k in dim.dim_keys])
    return out

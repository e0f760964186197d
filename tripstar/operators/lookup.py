"""Surrogate-key lookups: the generic form of the fact table's dimension joins."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstar.functions.coerce import ident


@dataclass(frozen=True)
class Lookup:
    """Replace a natural key of the fact rows (SQL expression ``key``) by a surrogate key.

    ``natural`` must be unique in ``dim``. A fact row without a match gets ``default``. Set
    ``bounded`` only for a dimension whose row count cannot grow with the data: it is then
    broadcast. Any other dimension is left to Catalyst, which broadcasts it if its measured
    size is under the session's threshold and otherwise sorts and merges, splitting hot keys.
    """

    dim: DataFrame
    natural: str
    surrogate: str
    key: str
    name: str
    default: int = 0
    bounded: bool = False


def star_lookup(facts: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Add one surrogate-key column per lookup; every fact row is kept exactly once.

    A lookup may use the result of an earlier one as its key. A miss stays NULL within such a chain,
    so it misses there too; the defaults come in at the end.
    """
    out = facts
    for i, lookup in enumerate(lookups):
        natural, surrogate = f"_natural_{i}", f"_surrogate_{i}"
        dim = lookup.dim.selectExpr(
            f"{ident(lookup.natural)} AS {natural}", f"{ident(lookup.surrogate)} AS {surrogate}"
        )
        if lookup.bounded:
            dim = F.broadcast(dim)
        out = (
            out.join(dim, F.expr(f"{lookup.key} = {natural}"), "left")
            .withColumn(lookup.name, F.expr(f"CAST({surrogate} AS BIGINT)"))
            .drop(natural, surrogate)
        )
    defaults = {x.name: F.expr(f"coalesce({ident(x.name)}, CAST({x.default} AS BIGINT))") for x in lookups}
    return out.withColumns(defaults)

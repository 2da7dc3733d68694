"""Surrogate keys that survive a reload (W7, J3, U6): hash keys, collision-checked, in a persisted key map."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arenaspark.session import shared_table

MAX_SALTS = 32  # rounds of rehashing; a 64-bit hash that still collides then is broken


def _same(a: str, b: str, cols: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols])


def _without(rows: DataFrame, others: DataFrame, cols: Sequence[str]) -> DataFrame:
    return rows.alias("l").join(others.alias("r"), _same("l", "r", cols), "left_anti")


def merge_key_map(known: DataFrame | None, names: DataFrame, natural: Sequence[str], key: str,
                  hash_of: Callable[..., Column] = F.xxhash64) -> DataFrame:
    """(natural..., key): every row of ``known`` as it is, and a key for each new name of ``names``.

    A new name's key is the hash of its natural key and a salt, salt 0 first. Of
    new names that share a hash the smallest keeps it; the others, and names
    whose hash is taken by a known one, are hashed again with the next salt. So a
    name's key never changes once given, keys are unique, and the same loads in
    the same order give the same keys. Nulls in the natural key are values of
    their own.
    """
    cols = list(natural)
    pending = names.select(*cols).distinct()
    done = None if known is None else known.select(*cols, key)
    if done is not None:
        pending = _without(pending, done, cols)
    for salt in range(MAX_SALTS):
        tried = pending.groupBy(hash_of(*cols, F.lit(salt)).alias(key)).agg(F.min(F.struct(*cols)).alias("w"))
        if done is not None:
            tried = tried.join(done.select(key), key, "left_anti")
        placed = shared_table(tried.select("w.*", key), "key-map")
        done = placed if done is None else done.unionByName(placed)
        pending = shared_table(_without(pending, placed, cols), "key-pending")
        if not pending.limit(1).count():
            return done
    raise RuntimeError(f"keys still collide after {MAX_SALTS} salts")

"""Entity resolution: canonical members from overlapping sources and
parent-scoped hierarchy lookups (PRJ-4/5, WIN-2, GEN-1/7, JN-9/15/16)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.functions.keys import match_key, normalize_text
from lakeward.operators.dedup import first_by
from lakeward.operators.ordering import asc, numeric_first


def apply_alias_map(df: DataFrame, name: str, aliases: DataFrame | None, out: str) -> DataFrame:
    """Replace a name by its canonical spelling when its match key is listed
    in ``aliases`` (alias, canonical)."""
    if aliases is None:
        return df.withColumn(out, F.col(name))
    a = aliases.select(match_key("alias").alias("__ak"), F.col("canonical").alias("__canon"))
    keyed = df.withColumn("__ak", match_key(name))
    return (keyed.join(a, "__ak", "left")
            .withColumn(out, F.coalesce("__canon", name)).drop("__ak", "__canon"))


def canonicalise_entities(sources: DataFrame, parent_keys: Sequence[str] = (),
                          aliases: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Resolve (source_priority, id, name[, parents]) rows that describe the
    same entity under different spellings and ids.

    name key = lower(NFC, trimmed, collapsed name) after the alias map;
    canonical id per key = numeric-looking ids first, then numerically, then
    source priority, then id text.  Returns (entities, id_map):
    entities(parents.., name_key, canonical_id, canonical_name, member_ids),
    id_map(parents.., id, canonical_id)."""
    s = apply_alias_map(sources, "name", aliases, "__resolved")
    s = s.withColumn("name_key", match_key("__resolved")) \
         .withColumn("__canon_name", normalize_text("__resolved")) \
         .filter(F.col("name_key").isNotNull())
    keys = [*parent_keys, "name_key"]
    best = first_by(s.select(*keys, "id", "source_priority", "__canon_name"), keys,
                    numeric_first("id") + [asc("source_priority"), asc("__canon_name")])
    members = s.select(*keys, "id").distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("member_ids"))
    entities = (best.join(members, keys)
                .select(*keys, F.col("id").alias("canonical_id"),
                        F.col("__canon_name").alias("canonical_name"), "member_ids"))
    id_map = (s.select(*keys, "id").distinct()
              .join(entities.select(*keys, "canonical_id"), keys)
              .select(*parent_keys, "id", "canonical_id"))
    return entities, id_map


def resolve_level(df: DataFrame, text_col: str, dim: DataFrame, dim_name: str, dim_id: str, out: str,
                  parent: tuple[str, str] | None = None, aliases: DataFrame | None = None) -> DataFrame:
    """One hierarchy level (JN-15/16): find the dim id whose normalised name
    equals the row's normalised text, within the row's already-resolved parent
    when ``parent=(row_col, dim_col)`` is given.  Cascade: direct name match,
    then alias spelling."""
    pk = [parent[0]] if parent else []
    d = dim.select(*([F.col(parent[1]).alias(parent[0])] if parent else []),
                   match_key(dim_name).alias("__mk"), F.col(dim_id).alias("__direct"))
    x = df.withColumn("__mk", match_key(text_col))
    x = x.join(d, [*pk, "__mk"], "left")
    if aliases is not None:
        a = aliases.select(match_key("alias").alias("__mk"), match_key("canonical").alias("__ck"))
        via = (a.join(d.withColumnRenamed("__mk", "__ck"), "__ck")
               .select(*pk, "__mk", F.col("__direct").alias("__alias")))
        x = x.join(via, [*pk, "__mk"], "left")
        return x.withColumn(out, F.coalesce("__direct", "__alias")).drop("__mk", "__direct", "__alias")
    return x.withColumnRenamed("__direct", out).drop("__mk")

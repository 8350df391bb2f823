"""Creature entities: nested JSON -> flat rows, species lookup, rarity, and a
legendary / regular branch with per-branch scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.functions.columns import title_case
from rillet.functions.rules import classify
from rillet.operators.combine import branch_columns
from rillet.sources.reshape import array_sizes, is_corrupt, parse_json, positional

ENTITY_SCHEMA = ("struct<id: bigint, name: string, height: bigint, weight: bigint, base_experience: bigint, "
                 "stats: array<struct<base_stat: bigint>>, types: array<struct<type: struct<name: string>>>, "
                 "species: struct<url: string>>")
SPECIES_SCHEMA = "struct<url: string, is_legendary: boolean, is_mythical: boolean, generation: struct<name: string>>"
# The base statistics in their order, and the value of a key that is absent.
STAT_NAMES = ["hp", "attack", "defense", "special_attack", "special_defense", "speed"]


def flatten(entities: DataFrame, text_col: str = "json") -> DataFrame:
    """Struct paths and positional array items with defaults. Texts that are no document are
    left out here; ``corrupt_records`` returns them."""
    e = parse_json(entities.filter(~is_corrupt(text_col, ENTITY_SCHEMA)), text_col, ENTITY_SCHEMA, "e").filter(F.col("e").isNotNull())
    cols = {n: positional("e.stats", i, "base_stat", 0) for i, n in enumerate(STAT_NAMES)}
    return e.select(
        F.col("e.id").alias("pokemon_id"), F.coalesce("e.name", F.lit("unknown")).alias("name"),
        *[F.coalesce(f"e.{n}", F.lit(0)).cast("long").alias(n) for n in ("height", "weight", "base_experience")],
        *[c.alias(n) for n, c in cols.items()],
        positional("e.types", 0, "type.name", "normal").alias("type_primary"),
        positional("e.types", 1, "type.name").alias("type_secondary"),
        *[c.alias(n) for n, c in array_sizes({"n_stats": "e.stats", "n_types": "e.types"}).items()],
        F.col("e.species.url").alias("species_url"))


def with_species(flat: DataFrame, species: DataFrame, text_col: str = "json") -> DataFrame:
    """Inner join on the species URL: an unresolved species drops the entity."""
    s = parse_json(species, text_col, SPECIES_SCHEMA, "s").select(
        F.col("s.url").alias("species_url"), F.coalesce("s.is_legendary", F.lit(False)).alias("is_legendary"),
        F.coalesce("s.is_mythical", F.lit(False)).alias("is_mythical"), F.coalesce("s.generation.name", F.lit("unknown")).alias("generation"))
    return flat.join(s, "species_url", "inner").drop("species_url")


def rarity() -> F.Column:
    t = F.col("total_stats")
    return classify([(F.col("is_mythical"), "mythical"), (F.col("is_legendary"), "legendary"),
                     (t >= 500, "rare"), (t >= 400, "uncommon")], "common")


def combat_role() -> F.Column:
    a, d = F.col("attack"), F.col("defense")
    return classify([((a > d) & (F.col("speed") >= 80), "sweeper"), ((d > a) & (F.col("hp") >= 80), "tank")],
                    "balanced")


def legendary_tier() -> F.Column:
    return classify([(F.col("is_mythical"), "mythical"), (F.col("total_stats") >= 680, "box_legendary")],
                    "sub_legendary")


def transform(df: DataFrame) -> DataFrame:
    total = None
    for n in STAT_NAMES:
        total = F.col(n) if total is None else total + F.col(n)
    out = df.withColumn("total_stats", total)
    return out.withColumns({"rarity": rarity(), "name": title_case("name")})


def branch(df: DataFrame) -> DataFrame:
    """Legendary and regular rows in one pass (each side's columns NULL on the other)."""
    legendary = (F.col("is_legendary") == True) | (F.col("is_mythical") == True)  # noqa: E712
    t = F.col("total_stats")
    return branch_columns(df, legendary, {
        "legendary_tier": (legendary_tier(), None),
        "power_score": (t * 1.5 + F.col("base_experience"), t + F.col("base_experience") * 0.5),
        "combat_role": (None, combat_role()),
    })


def flow_legendary(entities: DataFrame, species: DataFrame) -> DataFrame:
    return branch(transform(with_species(flatten(entities), species)))

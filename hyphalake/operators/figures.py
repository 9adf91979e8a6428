"""The tables that figures draw: points of quality metrics by state, and marginal histograms of a map."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def quality_points(rows: DataFrame, metrics: Sequence[str], excluded: DataFrame, species: str = "species", accession: str = "accession", passed: str = "passed", reference: str = "reference_type") -> DataFrame:
    """(species, accession, metric, state, value): every mark of the figure, long, without missing values.

    rows hold one genome each; excluded holds (species, accession) of genomes taken out by identity.  A genome is
    drawn once a state: as passed or filtered (where it is no reference, and filtered only if not excluded), as
    excluded, and as reference genome, proteome or both.
    """
    gone = F.broadcast(excluded.select(F.col(species).alias("_s"), F.col(accession).alias("_a")).distinct().withColumn("_out", F.lit(True)))
    out = F.coalesce("_out", F.lit(False))
    plain = F.col(reference).isNull()
    states = F.array_compact(F.array(F.when(F.col(passed) & plain, "passed"), F.when(~F.col(passed) & plain & ~out, "filtered"), F.when(out, "excluded"), F.when(F.col(reference).isin("genome", "proteome", "both"), F.concat(F.lit("reference "), F.col(reference)))))
    joined = rows.join(gone, (F.col(species) == F.col("_s")) & (F.col(accession) == F.col("_a")), "left").withColumn("state", F.explode(states))
    values = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]))
    return joined.select(species, accession, "state", values.alias("x")).select(species, accession, "x.metric", "state", "x.value").where("value is not null")


def map_marginals(places: DataFrame, species: str = "species", n_lon: int = 72, n_lat: int = 36) -> DataFrame:
    """(axis, species, bin, start, n): histograms of longitude and latitude by species over the whole globe; bins
    without a place are left out."""
    axes = (("lon", -180.0, 180.0, n_lon), ("lat", -90.0, 90.0, n_lat))
    cells = F.explode(F.array(*[F.when(F.col(c).between(low, high), F.struct(F.lit(c).alias("axis"), F.least(F.lit(n - 1), F.floor((F.col(c) - low) / (high - low) * n)).cast("int").alias("bin"), F.lit(low).alias("low"), F.lit((high - low) / n).alias("step"))) for c, low, high, n in axes]))
    each = places.select(species, cells.alias("x")).where("x is not null").select(species, "x.*")
    return each.groupBy("axis", species, "bin").agg((F.first("low") + F.col("bin") * F.first("step")).alias("start"), F.count(F.lit(1)).alias("n"))

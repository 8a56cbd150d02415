"""Release licence of a corpus from the licences of its sources, as one aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Licence classes.
SHARE_ALIKE = ("cc-by-sa-3.0", "cc-by-sa-4.0")
PERMISSIVE = ("apache-2.0", "cc-by-3.0", "cc-by-4.0", "mit", "odc-by-1.0")
PUBLIC_DOMAIN = ("cc0-1.0", "pd", "public-domain")
BLOCKED = ("cc-by-nc-4.0", "cc-by-nc-nd-4.0", "cc-by-nc-sa-4.0", "cc-by-nd-4.0")
UNRESOLVED = ("", "unknown", "unresolved")


class LicenseError(ValueError):
    pass


def unresolved(provenance: DataFrame) -> DataFrame:
    """Sources whose licence is still open; they block an export."""
    return provenance.filter(F.lower(F.coalesce("license", F.lit(""))).isin(*UNRESOLVED))


def resolution(provenance: DataFrame, *by: str) -> DataFrame:
    """outcome (blocked, conflict, unclassified, share_alike, public_domain, permissive) and license.

    Blocked licences are told before conflicts and these before unknown ones. Null and empty licences
    take no part; without any the outcome is permissive with an empty list.
    """
    rows = provenance.withColumn("id", F.lower(F.trim("license")))
    named = F.coalesce(F.col("license"), F.lit("")) != ""
    ids = F.collect_set(F.when(named, F.col("id"))).alias("ids")
    names = F.array_join(F.sort_array(F.collect_set(F.when(named, F.col("license")))), ", ").alias("names")
    alike = F.min(F.when(F.col("id").isin(*SHARE_ALIKE), F.col("license"))).alias("alike")
    got = rows.groupBy(*by).agg(ids, names, alike)
    among = lambda ls: F.size(F.array_intersect("ids", F.array(*map(F.lit, ls))))
    rest = F.size(F.array_except("ids", F.array(*map(F.lit, SHARE_ALIKE + PERMISSIVE + PUBLIC_DOMAIN + BLOCKED))))
    outcome = (
        F.when(among(BLOCKED) > 0, "blocked")
        .when(among(SHARE_ALIKE) > 1, "conflict")
        .when(rest > 0, "unclassified")
        .when(among(SHARE_ALIKE) == 1, "share_alike")
        .when((F.size("ids") > 0) & (among(PUBLIC_DOMAIN) == F.size("ids")), "public_domain")
        .otherwise("permissive")
    )
    name = F.when(F.col("outcome") == "share_alike", F.col("alike")).when(F.col("outcome") == "public_domain", "CC0-1.0").when(F.col("outcome") == "permissive", F.concat(F.lit("Multiple permissive licenses ("), "names", F.lit(")")))
    return got.withColumn("outcome", outcome).select(*by, "outcome", name.alias("license"))


def rationale(outcome: str, licence: str | None) -> str:
    """Why a corpus gets its licence, or none, in a sentence for the model card."""
    said = {
        "blocked": "a source forbids commercial use or derived works",
        "conflict": "two share-alike licences ask for different licences of the same work",
        "unclassified": "a source has a licence that isn't classified yet",
        "share_alike": f"{licence} asks that derived works carry it; the other sources only ask for credit, which the list of sources gives",
        "public_domain": "all sources are in the public domain",
        "permissive": "all sources allow any use that credits them",
    }
    return said[outcome]


def release_license(provenance: DataFrame) -> str:
    """The licence, or an error that says why there is none."""
    if (open_ := [r["source"] for r in unresolved(provenance).select("source").distinct().orderBy("source").collect()]):
        raise LicenseError(f"unresolved licences: {', '.join(open_)}")
    row = resolution(provenance).first()
    if row["license"] is None:
        raise LicenseError(f"{row['outcome']}: {rationale(row['outcome'], None)}")
    return row["license"]


def release(provenance: DataFrame) -> tuple[str, str]:
    """The licence of a release and why it is that one."""
    licence = release_license(provenance)
    return licence, rationale(resolution(provenance).first()["outcome"], licence)


def attributions(provenance: DataFrame, *by: str) -> DataFrame:
    """One line for each licensed source."""
    url = F.when(F.coalesce("url", F.lit("")) != "", F.concat(F.lit(" — "), "url")).otherwise("")
    return provenance.filter("coalesce(license, '') <> ''").select(*by, "source", F.concat("source", F.lit(" ("), "license", F.lit(")"), url).alias("line"))

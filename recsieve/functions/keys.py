"""Slugs and record keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recsieve.functions.text import bound


def slugify(c: Column) -> Column:
    """Lower case; all but a-z, 0-9, white space and hyphens dropped; runs of white space or hyphens are one hyphen."""
    s = F.regexp_replace(F.regexp_replace(F.lower(c), r"(?U)^\s+|\s+$", ""), r"(?U)[^a-z0-9\s-]", "")
    s = F.regexp_replace(F.regexp_replace(s, r"(?U)\s+", "-"), r"-+", "-")
    return F.regexp_replace(s, r"^-+|-+$", "")


def report_key(company: Column, amount: Column) -> Column:
    return F.concat(F.lit("fundraising-intel:v3:"), slugify(company), F.lit(":"), amount.cast("string"))


def legacy_key(company: Column, day: Column) -> Column:
    return F.concat(F.lit("fundraising-intel:"), slugify(company), F.lit(":"), F.date_format(day, "yyyy-MM-dd"))


def legacy_prefix(company: Column) -> Column:
    return F.concat(F.lit("fundraising-intel:"), slugify(company), F.lit(":"))


def pack_key(day: Column) -> Column:
    return F.concat(F.lit("signal-pack:v1:"), F.date_format(day, "yyyy-MM-dd"))


def outreach_key(company: Column, amount: Column) -> Column:
    return F.concat(F.lit("outreach-intel:"), slugify(company), F.lit(":"), amount.cast("string"))


def parse_key(key: Column) -> Column:
    """struct(scheme, slug, suffix) of a key; scheme `none` for others. A slug `v3` of a legacy key reads as the v3 scheme."""
    return bound(F.split(F.coalesce(key, F.lit("")), ":", -1), lambda p: bound(_scheme(p), lambda scheme: _parts(p, scheme)))


def _scheme(p: Column) -> Column:
    head, n = p[0], F.size(p)
    return (
        F.when((head == "fundraising-intel") & (n == 4) & (F.get(p, F.lit(1)) == "v3"), "v3").when((head == "fundraising-intel") & (n == 3), "legacy")
        .when((head == "signal-pack") & (n == 3), "pack").when((head == "outreach-intel") & (n == 3), "outreach").otherwise("none")
    )


def _parts(p: Column, scheme: Column) -> Column:
    slug = F.when(scheme == "v3", F.get(p, F.lit(2))).when(scheme.isin("legacy", "outreach"), F.get(p, F.lit(1)))
    return F.struct(scheme.alias("scheme"), slug.alias("slug"), F.when(scheme != "none", F.element_at(p, -1)).alias("suffix"))

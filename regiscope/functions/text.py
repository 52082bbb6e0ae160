"""String column functions: normalisation, dictionary standardisation,
recoding and boundary-name canonicalisation. All are built-in Spark
expressions (no Python UDF), so they stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize(c: ColumnOrName) -> Column:
    """Upper-case and trim."""
    return F.upper(F.trim(_col(c)))


def _collapse(mapping: Mapping[str, str] | Iterable[tuple[str, str]]) -> dict[str, str]:
    # A list of pairs may repeat a key; collapse it like a dict would (last wins)
    # so that create_map never sees a duplicated key.
    if isinstance(mapping, Mapping):
        return dict(mapping)
    out: dict[str, str] = {}
    for k, v in mapping:
        out[k] = v
    return out


def standardize(c: ColumnOrName, mapping) -> Column:
    """Look the normalised value up in a literal dictionary, pass it
    through unchanged when absent. Meant for dictionaries of up to a few
    hundred entries; larger ones go through ``standardize_join``."""
    raw = normalize(c)
    pairs = _collapse(mapping)
    if not pairs:
        return raw
    lit_map = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])
    return F.coalesce(lit_map[raw], raw)


def standardize_join(df: DataFrame, col: str, dictionary: DataFrame,
                     key: str = "variant", value: str = "standard",
                     out: str | None = None) -> DataFrame:
    """P2 for large dictionaries: a left join on the normalised value.

    The dictionary is deduplicated on its key first so the join can never
    fan out rows. Spark decides broadcast vs. shuffle from the dictionary's
    measured size (AQE), so no unchecked broadcast hint is given here.
    """
    out = out or col
    d = (dictionary.select(F.col(key).alias("__k"), F.col(value).alias("__v"))
         .groupBy("__k").agg(F.max("__v").alias("__v")))
    joined = df.withColumn("__raw", normalize(col)).join(
        d, F.col("__raw") == F.col("__k"), "left")
    return (joined.withColumn(out, F.coalesce(F.col("__v"), F.col("__raw")))
            .drop("__raw", "__k", "__v"))


def recode(c: ColumnOrName, from_value: str, to_value: str) -> Column:
    """One literal recoded, everything else normalised."""
    n = normalize(c)
    return F.when(n == F.lit(from_value), F.lit(to_value)).otherwise(n)


# Prefixes stripped from boundary names, applied once each,
# in this order; then "KEP. " is spelled out and any name containing
# "SERIBU" becomes "KEPULAUAN SERIBU".
NAME_PREFIXES = (
    "KOTA ADM. ", "KAB. ADM. ", "KOTA ADMINISTRASI ",
    "KABUPATEN ADMINISTRASI ", "KOTA ", "KABUPATEN ",
    "KAB. ", "ADM. ",
)
ABBREVIATION = ("KEP. ", "KEPULAUAN ")
ISLAND_MARKER = "SERIBU"
ISLAND_NAME = "KEPULAUAN SERIBU"


def _strip_ws(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def canonical_name(c: ColumnOrName) -> Column:
    """Canonical region key from a free-form boundary name; NULL -> ''."""
    s = _strip_ws(F.upper(_col(c)))
    # One anchored replacement per prefix: strips it once, only at the start,
    # and keeps the expression linear in the number of prefixes.
    for tok in NAME_PREFIXES:
        s = F.regexp_replace(s, "^" + tok.replace(".", r"\."), "")
    s = F.replace(s, F.lit(ABBREVIATION[0]), F.lit(ABBREVIATION[1]))
    s = F.when(s.contains(ISLAND_MARKER), F.lit(ISLAND_NAME)).otherwise(s)
    return F.coalesce(_strip_ws(s), F.lit(""))


def title_case(c: ColumnOrName) -> Column:
    """Title-case label, a capital after anything but a letter."""
    # initcap starts a word after a space only: a marked space opens the others
    opened = F.regexp_replace(F.lower(_col(c)), r"([^\p{L}\s])(?=\p{L})", "$1\u0001 ")
    return F.replace(F.initcap(opened), F.lit("\u0001 "), F.lit(""))
